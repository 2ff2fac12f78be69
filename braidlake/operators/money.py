"""Allocation of document totals, reversals, statements and roll-forward balances."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.dates import month_of


def share_of(
    amount: str, gross: str, reversal: str | None = None, scale: int = 12, money: str = "decimal(18,2)"
) -> Column:
    """amount / gross rounded to ``scale``: NULL for a gross of zero, 0 when ``reversal`` equals
    the amount. ``money`` is the type both are read as."""
    raw = F.round(F.try_divide(F.col(amount).cast(money), F.col(gross).cast(money)), scale)
    if reversal is not None:
        raw = F.when(F.col(reversal) == F.col(amount), F.lit(0)).otherwise(raw)
    return raw.cast(f"decimal(20,{scale})")


def spread(
    measures: Sequence[str], share: str, scale: int = 5, money: str = "decimal(17,2)"
) -> dict[str, Column]:
    """``alloc_<measure>``: the measure times the share, rounded to ``scale``.

    ``money`` is the type measures are read as. The default is the widest whose product with a
    share of twelve decimals is exact; larger totals need a share of fewer decimals.
    """
    return {
        f"alloc_{m}": F.round(F.col(m).cast(money) * F.col(share), scale).cast(
            f"decimal(30,{scale})"
        )
        for m in measures
    }


def allocate(
    docs: DataFrame,
    txns: DataFrame,
    keys: Sequence[str],
    amount: str,
    shares: Mapping[str, tuple[str, Sequence[str]]],
    reversal: str | None = None,
) -> DataFrame:
    """Spread document totals over the document's transactions.

    ``shares`` maps a share column to (gross column, measures it spreads): a document may have
    several bases, for example all transactions and those of one issuer. Documents hold one row
    per key, so only the transaction side can be skewed, and AQE splits a hot document.
    """
    joined = docs.join(txns, list(keys), "inner")
    shared = joined.withColumns(
        {name: share_of(amount, gross, reversal) for name, (gross, _) in shares.items()}
    )
    allocated: dict[str, Column] = {}
    for name, (_, measures) in shares.items():
        allocated |= spread(measures, name)
    return shared.withColumns(allocated)


def stack_signed(
    parts: Sequence[tuple[DataFrame, int, Mapping[str, object]]], signed: Sequence[str]
) -> DataFrame:
    """Stack transaction sets, multiplying the ``signed`` columns by each set's sign.

    The mapping of a set gives constant columns: a type tag, or sentinel keys for an issuer whose
    parties are unknown.
    """
    frames = [
        df.withColumns(
            {c: F.col(c) * sign for c in signed if sign != 1}
            | {c: F.lit(v) for c, v in constants.items()}
        )
        for df, sign, constants in parts
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


@dataclass(frozen=True)
class Part:
    """What a fact row feeds: the part's name, the rows that feed it, its value and its sign.

    ``columns`` replaces output columns for this part: the month of another date, a sentinel party, a
    type tag. Values are added up as they are unless ``unit`` is given: then each unit (a note, a
    payment) counts once within its keys, with its sum or its largest value (``per_unit``), or with
    nothing if a row of the same keys and unit meets ``unless``, be it one that feeds the part or not.
    """

    name: str
    when: Column
    value: Column
    sign: int = 1
    columns: Mapping[str, Column] = field(default_factory=dict)
    unit: Column | None = None
    per_unit: str = "sum"
    unless: Column | None = None


AMOUNT = "decimal(30,5)"


def fan_out(
    fact: DataFrame,
    parts: Sequence[Part],
    columns: Mapping[str, Column],
    tag: str = "part",
    value: str = "value",
    amount: str = AMOUNT,
    within: Sequence[str] = (),
) -> DataFrame:
    """One row for each part that a fact row feeds: ``columns``, the tag and the signed value.

    The fact is read once, however many parts there are: a row becomes an array with an entry per
    part, NULL where it does not feed it, and only the entries are kept. Parts with units add ``_unit``
    and ``_void``. Fact columns ``within`` stay beside the entries, so that rows dealt out by them still are.
    """
    units = any(p.unit is not None for p in parts)
    entries = []
    for p in parts:
        feeds = F.coalesce(p.when, F.lit(False))
        void = F.lit(False) if p.unless is None else F.coalesce(p.unless, F.lit(False))
        cells = [p.columns.get(c, own).alias(c) for c, own in columns.items()]
        cells += [F.lit(p.name).alias(tag), F.when(feeds, p.value * p.sign).cast(amount).alias(value)]
        if units:
            unit = F.lit(None).cast("string") if p.unit is None else p.unit.cast("string")
            cells += [unit.alias("_unit"), void.alias("_void")]
        entries.append(F.when(feeds | void, F.struct(*cells)))
    kept = [F.col(c).alias(f"_w{i}") for i, c in enumerate(within)]
    return fact.select(*kept, F.inline(F.array(*entries))).filter(F.col(tag).isNotNull())


def routed_statement(
    facts: Sequence[tuple[DataFrame, Sequence[Part], Mapping[str, Column]]],
    keys: Sequence[str],
    total: str = "movement",
    memo: Sequence[str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """Statement with a column per part and their sum; every fact is read once.

    ``facts`` holds (fact, its parts, its key columns). Part columns hold unsigned values, as
    ``movement_statement`` does; ``memo`` parts are shown and not added to the total. Units are settled by
    a grouping of their own before parts become columns; both add up before they shuffle, so a key with
    most of the rows costs no more than others.

    ``within`` names fact columns, such as the document, that all rows of a unit share. Units are then settled
    per value of them, and a fact that a join has dealt out by them is not shuffled again for it.
    """
    signs = {p.name: p.sign for _, parts, _ in facts for p in parts}
    rules = {p.name: p.per_unit for _, parts, _ in facts for p in parts if p.unit is not None}
    routed = []
    for fact, parts, columns in facts:
        rows = fan_out(
            fact, [Part(**{**vars(p), "sign": 1}) for p in parts], {k: columns[k] for k in keys}, "_part", "_v", within=within
        )
        if rules and "_unit" not in rows.columns:
            rows = rows.withColumns({"_unit": F.lit(None).cast("string"), "_void": F.lit(False)})
        routed.append(rows)
    stacked = reduce(lambda a, b: a.unionByName(b), routed)
    if rules:
        largest = F.col("_part").isin([n for n, rule in rules.items() if rule == "max"])
        # A row has its value in one of the two, the other stays NULL.
        unit = stacked.groupBy(*[f"_w{i}" for i in range(len(within))], *keys, "_part", "_unit").agg(
            F.sum(F.when(~largest, F.col("_v"))).alias("_sum"), F.max(F.when(largest, F.col("_v"))).alias("_max"),
            F.max("_void").alias("_void"),
        )
        settled = F.when(largest, F.col("_max")).otherwise(F.col("_sum"))
        stacked = unit.withColumn("_v", F.when(~F.col("_void"), settled)).filter("_v IS NOT NULL")
    zero = F.lit(0).cast("decimal(38,2)")
    out = stacked.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.when(F.col("_part") == n, F.col("_v"))).cast("decimal(38,2)"), zero).alias(n) for n in signs]
    )
    return out.withColumn(total, reduce(lambda a, b: a + b, [F.col(n) * s for n, s in signs.items() if n not in memo]))


def movement_statement(
    components: Mapping[str, tuple[DataFrame, str, int]],
    keys: Sequence[str],
    total: str = "movement",
) -> DataFrame:
    """Statement with one column per component and their signed sum.

    ``components`` maps a column name to (frame, amount column, sign). The frames are stacked and
    grouped once: the union of keys is the spine, and components a key lacks are 0.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.select(
                *keys, F.lit(name).alias("_part"), F.col(col).cast("decimal(38,2)").alias("_v")
            )
            for name, (df, col, _) in components.items()
        ],
    )
    out = stacked.groupBy(*keys).agg(
        *[
            F.coalesce(F.sum(F.when(F.col("_part") == n, F.col("_v"))), F.lit(0)).alias(n)
            for n in components
        ]
    )
    signed = [F.col(n) * sign for n, (_, _, sign) in components.items()]
    return out.withColumn(total, reduce(lambda a, b: a + b, signed))


def roll_forward(
    previous: DataFrame,
    movement: DataFrame,
    keys: Sequence[str],
    month: str = "month",
    closing: str = "closing",
    amount: str = "movement",
    opening: str = "opening",
) -> DataFrame:
    """Next month's balances: opening = previous closing, closing = opening + movement.

    ``previous`` holds one month of balances. A key with a balance and no movement is carried to
    the next month. The month is shifted first, so the full outer join stays an equi-join.
    """
    prev = previous.select(
        *keys, F.add_months(F.col(month), 1).alias(month), F.col(closing).alias("_open")
    )
    return prev.join(movement, [*keys, month], "full").select(
        *keys,
        month,
        F.coalesce("_open", F.lit(0)).alias(opening),
        F.coalesce(amount, F.lit(0)).alias(amount),
        (F.coalesce("_open", F.lit(0)) + F.coalesce(amount, F.lit(0))).alias(closing),
    )


def roll_forward_series(
    movement: DataFrame,
    keys: Sequence[str],
    last_month: dt.date | str,
    month: str = "month",
    amount: str = "movement",
    opening: str = "opening",
    closing: str = "closing",
) -> DataFrame:
    """Every month of the balance from the first movement to ``last_month``.

    Equal to applying ``roll_forward`` month after month, without a job per month: a running sum
    over the months that have movement (one row per key and month, so the window is bounded), and
    the quiet months in between filled in.
    """
    run = month_of(last_month)
    per_month = (
        movement.filter(F.col(month) <= F.lit(run))
        .groupBy(*keys, month)
        .agg(F.sum(amount).alias(amount))
    )
    order = Window.partitionBy(*keys).orderBy(month)
    total = F.sum(amount).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    until = F.coalesce(F.add_months(F.lead(month).over(order), -1), F.lit(run))
    spans = per_month.select(
        *keys,
        F.col(month).alias("_moved"),
        F.col(amount).alias("_amount"),
        total.alias("_total"),
        until.alias("_until"),
    )
    months = F.sequence("_moved", "_until", F.expr("INTERVAL 1 MONTH"))
    lines = spans.withColumn(month, F.explode(months))
    moved = F.when(F.col(month) == F.col("_moved"), F.col("_amount")).otherwise(F.lit(0))
    return lines.select(
        *keys,
        month,
        (F.col("_total") - moved).alias(opening),
        moved.alias(amount),
        F.col("_total").alias(closing),
    )


def late_movements(
    stored: DataFrame,
    late: DataFrame,
    keys: Sequence[str],
    last_month: dt.date | str,
    month: str = "month",
    amount: str = "movement",
    opening: str = "opening",
    closing: str = "closing",
) -> DataFrame:
    """The rows of a stored balance series that late movements change, as they should be.

    ``stored`` is a series as ``roll_forward_series`` gives it, one row per key and month up to ``last_month``;
    ``late`` are movements of any of its months or earlier ones that it does not hold. The late
    amounts of a month are added to its movement, and their running sum to the opening and closing
    balances of later months: the series of the late amounts alone is what has to be added. Only months from
    the first late one on are read. Rows that come out equal, where late amounts cancel out, are left
    out; months that the series lacks, before its first or of a new key, come as new rows. Merge the
    result into the table (``sources.merge``), which rewrites the months concerned.
    """
    rows = late.select(*keys, month, F.col(amount).alias("_late"))
    extra = roll_forward_series(rows, keys, last_month, month, "_late", "_open", "_close")
    held = stored.filter(F.col(month) >= late.agg(F.min(month)).scalar())
    both = extra.join(held.select(*keys, month, opening, amount, closing, F.lit(True).alias("_held")), [*keys, month], "left")
    moves = (F.col("_open") != 0) | (F.col("_late") != 0) | (F.col("_close") != 0)
    types = {f.name: f.dataType for f in stored.schema}
    added = {opening: "_open", amount: "_late", closing: "_close"}
    return both.filter(moves | F.col("_held").isNull()).select(
        *keys,
        month,
        *[(F.coalesce(F.col(c), F.lit(0)) + F.col(more)).cast(types[c]).alias(c) for c, more in added.items()],
    )


def blend_manual(
    computed: DataFrame,
    manual: DataFrame,
    document: Sequence[str],
    group: Sequence[str],
    amount: str,
    total: str = "total",
) -> DataFrame:
    """Computed and hand-entered amounts of the same documents: largest per document, then sums."""
    cols = [*dict.fromkeys([*document, *group]), amount]
    both = computed.select(*cols).unionByName(manual.select(*cols))
    per_doc = both.groupBy(*dict.fromkeys([*document, *group])).agg(F.max(amount).alias(amount))
    return per_doc.groupBy(*group).agg(F.sum(amount).alias(total))


def unexplained_adjustments(
    adjustments: DataFrame,
    alternatives: Sequence[tuple[DataFrame, Mapping[str, str]]],
    distinct: Sequence[str],
    amount: str,
    billed: str,
    group: Sequence[str],
    total: str = "adjustment",
) -> DataFrame:
    """Adjustments that neither a billed line nor another event accounts for.

    Each alternative is a frame and the columns that must be equal (adjustment column -> its
    column); an adjustment that meets any of them is dropped. "Not exists (k and (x or y))" is the
    same as "not exists (k and x) and not exists (k and y)", so every alternative is an anti-join
    on its own equality key: a document with very many lines never compares all its pairs.
    Amounts equal to the billed line count as 0.
    """
    left = adjustments
    for frame, on in alternatives:
        known = frame.select(*[F.col(e).alias(a) for a, e in on.items()]).distinct()
        left = left.join(known, list(on), "left_anti")
    value = F.when(F.col(amount) == F.col(billed), F.lit(0)).otherwise(
        F.coalesce(F.col(amount), F.lit(0))
    )
    rows = left.select(*dict.fromkeys([*distinct, *group, amount, billed])).distinct()
    return rows.groupBy(*group).agg(F.sum(value).alias(total))


def revenue_breakdown(
    base: DataFrame,
    parts: Mapping[str, tuple[DataFrame, Column]],
    keys: Sequence[str],
    total: str = "revenue",
) -> DataFrame:
    """Document with one summed column per part and their total; absent parts are 0.

    Each correlated sum becomes a conditional sum over the stacked parts, grouped once before
    the single join to the documents.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [
            df.select(
                *keys, F.lit(n).alias("_part"), value.cast("decimal(38,4)").alias("_v")
            )
            for n, (df, value) in parts.items()
        ],
    )
    sums = stacked.groupBy(*keys).agg(
        *[F.sum(F.when(F.col("_part") == n, F.col("_v"))).alias(n) for n in parts]
    )
    out = base.join(sums, list(keys), "left").withColumns(
        {n: F.coalesce(F.col(n), F.lit(0)) for n in parts}
    )
    return out.withColumn(total, reduce(lambda a, b: a + b, [F.col(n) for n in parts]))

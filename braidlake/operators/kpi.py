"""KPI facts with ratios, alerts and ranks, audit aggregates and rule-variant comparison."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.keys import all_equal, any_differs


@dataclass(frozen=True)
class KpiSpec:
    """What a KPI fact holds.

    ``sums``, ``distincts`` and ``means`` map output to input columns (amounts as decimals);
    ``ratios`` map an output to
    (numerator, denominator, factor) and are rounded half up to two decimals; ``alerts`` map an
    output to (column, threshold, label below it, label otherwise); ``rank`` is (output, columns
    of the group, column ranked from high to low).
    """

    dims: Sequence[str]
    sums: Mapping[str, str] = field(default_factory=dict)
    distincts: Mapping[str, str] = field(default_factory=dict)
    means: Mapping[str, str] = field(default_factory=dict)
    ratios: Mapping[str, tuple[str, str, int]] = field(default_factory=dict)
    alerts: Mapping[str, tuple[str, float, str, str]] = field(default_factory=dict)
    rank: tuple[str, Sequence[str], str] | None = None


def ratio(numerator: Column, denominator: Column, factor: int = 1, scale: int = 2) -> Column:
    """factor * numerator / denominator, rounded half up; NULL when the denominator is 0.

    Decimal types are chosen so that the quotient keeps 14 decimals before it is rounded.
    """
    top = numerator.cast("decimal(20,2)") * F.lit(factor).cast("decimal(3,0)")
    return F.round(F.try_divide(top, denominator.cast("decimal(18,2)")), scale)


def mean(col: Column, scale: int = 6) -> Column:
    """Average of amounts with up to four decimals, rounded half up; NULLs do not count."""
    return mean_of(F.sum(col), F.count(col), scale)


def mean_of(total: Column, count: Column, scale: int = 6) -> Column:
    """Average from a total and a count, which may have been added up in parts."""
    return F.round(F.try_divide(total.cast("decimal(22,4)"), count.cast("decimal(18,0)")), scale)


def kpi_gold(df: DataFrame, spec: KpiSpec) -> DataFrame:
    """Grouped KPIs, their ratios, alert labels and the rank of each row in its group.

    Distinct counts copy every row once per counted column. Facts are therefore first added up per
    dimensions and counted columns, with sums and counts for the means, and only that smaller table
    is copied.

    The rank window runs over the aggregated rows, a few per group, and breaks ties by the
    dimensions so that reruns agree.
    """
    counted = [c for c in dict.fromkeys(spec.distincts.values()) if c not in spec.dims]
    parts = df.groupBy(*spec.dims, *counted).agg(
        *[F.sum(c).alias(f"_s_{n}") for n, c in spec.sums.items()],
        *[F.sum(c).alias(f"_t_{n}") for n, c in spec.means.items()],
        *[F.count(c).alias(f"_c_{n}") for n, c in spec.means.items()],
        F.count(F.lit(1)).alias("_rows"),
    )
    types = {f.name: f.dataType for f in parts.schema.fields}
    out = parts.groupBy(*spec.dims).agg(
        *[F.sum(f"_s_{n}").cast(types[f"_s_{n}"]).alias(n) for n in spec.sums],
        *[F.count_distinct(F.col(c)).alias(n) for n, c in spec.distincts.items()],
        *[mean_of(F.sum(f"_t_{n}"), F.sum(f"_c_{n}")).alias(n) for n in spec.means],
    )
    out = out.withColumns(
        {n: ratio(F.col(a), F.col(b), k) for n, (a, b, k) in spec.ratios.items()}
    )
    if spec.rank:
        name, group, by = spec.rank
        window = Window.partitionBy(*group).orderBy(
            F.col(by).desc_nulls_last(), *[F.col(d) for d in spec.dims if d not in group]
        )
        out = out.withColumn(name, F.row_number().over(window))
    return out.withColumns(
        {
            n: F.when(F.col(c) < limit, low).otherwise(ok)
            for n, (c, limit, low, ok) in spec.alerts.items()
        }
    )


def audit(
    df: DataFrame, dims: Sequence[str], distinct: Mapping[str, str], sums: Mapping[str, str]
) -> DataFrame:
    """Distinct counts and totals per dimension, written next to a fact."""
    return df.groupBy(*dims).agg(
        *[F.count_distinct(F.col(c)).alias(n) for n, c in distinct.items()],
        *[F.sum(c).alias(n) for n, c in sums.items()],
    )


def compare_variants(
    a: DataFrame, b: DataFrame, keys: Sequence[str], measures: Sequence[str]
) -> DataFrame:
    """The same KPI under two rule sets: keys removed, added, changed or equal.

    Each measure comes out as ``<name>_a``, ``<name>_b`` and ``<name>_delta``. Keys a variant lacks
    (for example a dropped dimension) can be added as NULL columns first; NULL keys match.
    """
    left = a.select(*keys, *measures, F.lit(True).alias("_in")).alias("a")
    right = b.select(*keys, *measures, F.lit(True).alias("_in")).alias("b")
    both = left.join(
        right, all_equal([(F.col(f"a.{k}"), F.col(f"b.{k}")) for k in keys]), "full"
    )
    changed = any_differs([(F.col(f"a.{m}"), F.col(f"b.{m}")) for m in measures])
    state = (
        F.when(F.col("a._in").isNull(), "added")
        .when(F.col("b._in").isNull(), "removed")
        .when(changed, "changed")
        .otherwise("equal")
    )
    cols = []
    for m in measures:
        x, y = F.col(f"a.{m}"), F.col(f"b.{m}")
        delta = F.coalesce(y, F.lit(0)) - F.coalesce(x, F.lit(0))
        cols += [x.alias(f"{m}_a"), y.alias(f"{m}_b"), delta.alias(f"{m}_delta")]
    return both.select(
        *[F.coalesce(F.col(f"a.{k}"), F.col(f"b.{k}")).alias(k) for k in keys],
        state.alias("status"),
        *cols,
    )


def attribute_change(
    df: DataFrame,
    keys: Sequence[str],
    before: Mapping[str, Column],
    after: Mapping[str, Column],
    measures: Mapping[str, Column | tuple[Column, Column]],
    rule: str = "rule",
) -> DataFrame:
    """What each rule contributes to the difference between a KPI under two rule sets.

    A rule set names the conditions a row has to meet; a rule that one set lacks lets every row through
    there. Rules change one after the other, in the order of ``before`` and then of what ``after`` adds:
    ``<measure>_step`` is the difference that a rule makes once those listed before it have changed, so the steps
    add up to the whole difference, and ``<measure>_alone`` the one it makes if nothing else changes.
    A measure may be a pair, its expression under either set; what the new expression makes of the new
    rows comes last, as the rule ``measure``. ``n_gained`` and ``n_lost`` count the rows that a step lets in and turns away.

    The rows are read once: every row is tagged with the rules that it meets under either set, and all
    states are conditional sums of one grouping.
    """
    names = list(dict.fromkeys([*before, *after]))
    yes = F.lit(True)
    tags = {f"_b{i}": F.coalesce(before.get(n, yes), F.lit(False)) for i, n in enumerate(names)}
    tags |= {f"_a{i}": F.coalesce(after.get(n, yes), F.lit(False)) for i, n in enumerate(names)}
    pairs = {m: v if isinstance(v, tuple) else (v, v) for m, v in measures.items()}
    tagged = df.select(
        *keys, *[c.alias(n) for n, c in tags.items()],
        *[c.alias(f"_{side}_{m}") for m, (x, y) in pairs.items() for side, c in (("x", x), ("y", y))],
    )

    def kept(new: Sequence[int]) -> Column:
        return reduce(lambda a, b: a & b, [F.col(f"_a{i}" if i in new else f"_b{i}") for i in range(len(names))], yes)

    states = [kept(range(i)) for i in range(len(names) + 1)]
    sums = {}
    for m in pairs:
        total = lambda cond, side: F.coalesce(F.sum(F.when(cond, F.col(f"_{side}_{m}"))), F.lit(0))  # noqa: B023, E731
        sums |= {f"_{m}_{i}": total(state, "x") for i, state in enumerate(states)}
        sums |= {f"_{m}_o{i}": total(kept([i]), "x") for i in range(len(names))}
        sums[f"_{m}_end"] = total(states[-1], "y")
        sums[f"_{m}_fresh"] = total(states[0], "y")
    for i in range(len(names)):
        old, new = states[i], states[i + 1]
        sums |= {f"_g{i}": F.count(F.when(new & ~old, 1)), f"_l{i}": F.count(F.when(old & ~new, 1))}
    wide = tagged.groupBy(*keys).agg(*[c.alias(n) for n, c in sums.items()])

    rows = []
    for i, name in enumerate(names):
        cells = [F.lit(name).alias(rule)]
        for m in pairs:
            cells += [
                (F.col(f"_{m}_{i + 1}") - F.col(f"_{m}_{i}")).alias(f"{m}_step"),
                (F.col(f"_{m}_o{i}") - F.col(f"_{m}_0")).alias(f"{m}_alone"),
            ]
        rows.append(F.struct(*cells, F.col(f"_g{i}").alias("n_gained"), F.col(f"_l{i}").alias("n_lost")))
    if any(isinstance(v, tuple) for v in measures.values()):
        cells = [F.lit("measure").alias(rule)]
        for m in pairs:
            cells += [
                (F.col(f"_{m}_end") - F.col(f"_{m}_{len(names)}")).alias(f"{m}_step"),
                (F.col(f"_{m}_fresh") - F.col(f"_{m}_0")).alias(f"{m}_alone"),
            ]
        rows.append(F.struct(*cells, F.lit(0).cast("long").alias("n_gained"), F.lit(0).cast("long").alias("n_lost")))
    return wide.select(*keys, F.inline(F.array(*rows)))

"""Month windows, cohorts, stock and flow, effective dating and exception periods.

Anchors and run months are plain dates, so every operator turns them into literal bounds on the
raw date column before anything else: partition pruning and row-group skipping see them. Several
anchor months are served by one scan; a row is copied to the anchors it feeds (at most the number
of anchors) and everything after that is partial aggregation.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.dates import add_months, cohort_age, month_of, month_start, months_apart
from braidlake.functions.keys import all_equal


# First-level aggregate and the one that merges its results.
MERGEABLE = {
    "sum": (F.sum, F.sum),
    "count": (F.count, F.sum),
    "max": (F.max, F.max),
    "min": (F.min, F.min),
}


def _to_windows(
    df: DataFrame, date_col: str, windows: Sequence[tuple[dt.date, dt.date, dt.date]], anchor: str
) -> DataFrame:
    """Copy each row to every (anchor, first day, day after last) window that holds it."""
    low = min(lo for _, lo, _ in windows)
    high = max(hi for _, _, hi in windows)
    day = F.col(date_col)
    hits = [F.when((day >= F.lit(lo)) & (day < F.lit(hi)), F.lit(a)) for a, lo, hi in windows]
    inside = df.filter((day >= F.lit(low)) & (day < F.lit(high)))
    if len(hits) == 1:
        return inside.withColumn(anchor, F.lit(windows[0][0]))
    return inside.withColumn(anchor, F.explode(F.array(*hits))).filter(F.col(anchor).isNotNull())


def month_windows(
    anchors: Sequence[dt.date | str], width: int
) -> list[tuple[dt.date, dt.date, dt.date]]:
    """Windows of ``width`` whole months that end with the anchor month."""
    return [
        (month_of(a), add_months(a, 1 - width), add_months(a, 1)) for a in anchors
    ]


def day_windows(
    anchors: Sequence[dt.date | str], days: int = 40, end_day: int = 5
) -> list[tuple[dt.date, dt.date, dt.date]]:
    """Windows of ``days`` days that end on ``end_day`` of the month after the anchor."""
    out = []
    for a in anchors:
        stop = add_months(a, 1) + dt.timedelta(days=end_day)
        out.append((month_of(a), stop - dt.timedelta(days=days), stop))
    return out


def window_metrics(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    windows: Sequence[tuple[dt.date, dt.date, dt.date]],
    measures: Mapping[str, tuple[str, Column]] | None = None,
    entity: str | None = None,
    entity_flags: Mapping[str, Column] | None = None,
    anchor: str = "anchor_month",
) -> DataFrame:
    """Metrics of each window, one row per anchor and key.

    ``measures`` maps a name to ("sum" | "count" | "max" | "min", expression): aggregates that can
    be merged again. ``entity_flags`` count the distinct ``entity`` values for which a
    condition holds on at least one row. Conditions and measures may use the boolean column
    ``in_month`` (row falls in the anchor month itself).

    Distinct counts are two grouping steps over (key, anchor, entity), so any number of filtered
    counts costs one shuffle of one row per entity, with no row copied per count; and a hot key
    is spread over its entities before it meets in one group.
    """
    copied = _to_windows(df, date_col, windows, anchor).withColumn(
        "in_month", month_start(date_col) == F.col(anchor)
    )
    measures = dict(measures or {})
    first_level = [MERGEABLE[f][0](col).alias(n) for n, (f, col) in measures.items()]
    if entity is None:
        return copied.groupBy(anchor, *keys).agg(*first_level)
    flags = dict(entity_flags or {})
    per_entity = copied.groupBy(anchor, *keys, entity).agg(
        *[F.max(F.when(cond, 1).otherwise(0)).alias(n) for n, cond in flags.items()],
        *first_level,
    )
    seen = F.col(entity).isNotNull()
    return per_entity.groupBy(anchor, *keys).agg(
        *[F.sum(F.when(seen, F.col(n)).otherwise(0)).alias(n) for n in flags],
        *[MERGEABLE[f][1](n).alias(n) for n, (f, _) in measures.items()],
    )


def trailing_metrics(df, keys, date_col, anchors, width=3, **kw) -> DataFrame:
    """``window_metrics`` over whole months, e.g. three months to each anchor."""
    return window_metrics(df, keys, date_col, month_windows(anchors, width), **kw)


def trailing_days_metrics(df, keys, date_col, anchors, days=40, end_day=5, **kw) -> DataFrame:
    """``window_metrics`` over days that end early in the month after the anchor."""
    return window_metrics(df, keys, date_col, day_windows(anchors, days, end_day), **kw)


def trailing_max(
    monthly: DataFrame,
    keys: Sequence[str],
    month: str,
    anchors: Sequence[dt.date | str],
    width: int,
    values: Sequence[str],
    peaks: bool = False,
    anchor: str = "anchor_month",
) -> DataFrame:
    """Largest monthly value of each column in the window, as ``max_<column>``.

    ``peaks`` adds ``peak_<column>``: the month it happened in, the latest one on ties. The input
    holds one row per key and month.
    """
    copied = _to_windows(monthly, month, month_windows(anchors, width), anchor)
    best = copied.groupBy(anchor, *keys).agg(
        *[F.max(v).alias(f"max_{v}") for v in values],
        *[
            F.max(F.when(F.col(v).isNotNull(), F.struct(F.col(v), F.col(month)))).alias(f"_p_{v}")
            for v in values
            if peaks
        ],
    )
    if not peaks:
        return best
    return best.select(
        anchor,
        *keys,
        *[f"max_{v}" for v in values],
        *[F.col(f"_p_{v}")[month].alias(f"peak_{v}") for v in values],
    )


def dormant_count(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    date_col: str,
    anchors: Sequence[dt.date | str],
    idle_months: int = 3,
    name: str = "n_dormant",
    anchor: str = "anchor_month",
) -> DataFrame:
    """Entities whose last event, as known at the anchor, lies exactly ``idle_months`` back.

    Only ``idle_months`` + 1 months are read: an event in the first of them and none after.
    """
    copied = _to_windows(df, date_col, month_windows(anchors, idle_months + 1), anchor)
    last = copied.groupBy(anchor, *keys, entity).agg(F.max(date_col).alias("_last"))
    gone = last.filter(month_start("_last") == F.add_months(F.col(anchor), -idle_months))
    return gone.groupBy(anchor, *keys).agg(F.count(entity).alias(name))


def first_event_cohort(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    date_col: str,
    anchors: Sequence[dt.date | str],
    floor: dt.date | str | None = None,
    name: str = "n_first",
    anchor: str = "anchor_month",
) -> DataFrame:
    """Entities whose first event (from ``floor`` on) falls in the anchor month, per key."""
    if floor is not None:
        df = df.filter(F.col(date_col) >= F.lit(month_of(floor)))
    first = (
        df.filter(F.col(date_col) < F.lit(add_months(max(month_of(a) for a in anchors), 1)))
        .groupBy(*keys, entity)
        .agg(month_start(F.min(date_col)).alias(anchor))
    )
    return (
        first.filter(F.col(anchor).isin([month_of(a) for a in anchors]))
        .groupBy(anchor, *keys)
        .agg(F.count(entity).alias(name))
    )


def restrict_to_young(df: DataFrame, month: str, first: str, ages: Sequence[int], values):
    """Zero the values of rows whose cohort age is not in ``ages`` (for example 1 to 3)."""
    young = cohort_age(month, first).isin(list(ages))
    return df.withColumns(
        {v: F.when(young, F.coalesce(F.col(v), F.lit(0))).otherwise(F.lit(0)) for v in values}
    )


def per_anchor(
    df: DataFrame,
    keys: Sequence[str],
    anchors: Sequence[dt.date | str],
    measures: Mapping[str, Callable[[dt.date], Column]],
    anchor: str,
) -> DataFrame:
    """One pass that aggregates once per anchor side by side, then turns anchors into rows.

    ``measures`` map an output to a function of the anchor month that returns an aggregate.

    For windows without a lower bound, copying rows to anchors would multiply the whole history;
    conditional aggregates do not.
    """
    months = sorted({month_of(a) for a in anchors})
    wide = df.groupBy(*keys).agg(
        *[
            make(m).alias(f"_{n}_{i}")
            for i, m in enumerate(months)
            for n, make in measures.items()
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(m).alias(anchor), *[F.col(f"_{n}_{i}").alias(n) for n in measures]
            )
            for i, m in enumerate(months)
        ]
    )
    long = wide.select(*keys, F.explode(rows).alias("_r"))
    return long.select(F.col(f"_r.{anchor}"), *keys, *[F.col(f"_r.{n}") for n in measures])


def cumulative_distinct(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    date_col: str,
    anchors: Sequence[dt.date | str],
    name: str = "n_ever",
    anchor: str = "anchor_month",
) -> DataFrame:
    """Distinct entities seen up to the end of each anchor month.

    Each entity counts from its first date on, so the history is grouped once, not per anchor.
    """
    last = add_months(max(month_of(a) for a in anchors), 1)
    first = (
        df.filter((F.col(date_col) < F.lit(last)) & F.col(entity).isNotNull())
        .groupBy(*keys, entity)
        .agg(F.min(date_col).alias("_first"))
    )
    counts = per_anchor(
        first, keys, anchors,
        {name: lambda m: F.count(F.when(F.col("_first") < F.lit(add_months(m, 1)), 1))}, anchor,
    )
    return counts.filter(F.col(name) > 0)


def running_high(
    monthly: DataFrame,
    keys: Sequence[str],
    month: str,
    anchors: Sequence[dt.date | str],
    value: str,
    name: str = "high",
    anchor: str = "anchor_month",
) -> DataFrame:
    """All-time high of ``value`` up to each anchor, with the anchor's own value beside it."""
    last = add_months(max(month_of(a) for a in anchors), 1)
    out = per_anchor(
        monthly.filter(F.col(month) < F.lit(last)), keys, anchors,
        {
            name: lambda m: F.max(F.when(F.col(month) <= F.lit(m), F.col(value))),
            value: lambda m: F.max(F.when(F.col(month) == F.lit(m), F.col(value))),
        },
        anchor,
    )
    return out.filter(F.col(name).isNotNull())


def months_active(
    monthly: DataFrame,
    keys: Sequence[str],
    month: str,
    first_any: str,
    first: str,
    last: str,
    seed_month: str,
    seed: str,
    idle_limit: int = 12,
    floor: str = "2020-01-01",
    name: str = "months_active",
) -> DataFrame:
    """Number of months an entity has been active, starting again after a long pause.

    ``monthly`` holds one row per key and month with the first and last event dates as known in
    that month, and the counter (``seed``, at ``seed_month``) of the previous snapshot. The window
    is bounded by the months of one key.
    """
    window = Window.partitionBy(*keys).orderBy(month)
    now, seed_col = F.col(month), F.col(seed)
    active_now = month_start(last) == now
    last_before = month_start(F.lag(last).over(window))
    month_before = F.lag(month).over(window)
    idle = months_apart(now, F.coalesce(F.col(last).cast("date"), F.lit("2000-01-01").cast("date")))
    not_started = F.col(first).isNull() | (month_start(first) > now)
    before_counting = (F.col(first) < now) & (now < F.lit(floor).cast("date"))
    returns = active_now & (seed_col == 0) & (last_before != month_before)
    counted_on = F.coalesce(F.lag(seed, 1, 0).over(window), F.lit(0)) + months_apart(
        now, F.col(seed_month)
    )
    value = (
        F.when(not_started | (idle >= idle_limit) | before_counting, 0)
        .when(now == month_start(first_any), 1)
        .when(returns, 1)
        .when(now == F.col(seed_month), seed_col)
        .when(seed_col.isNull() & active_now, F.when(last_before.isNull(), 1).otherwise(2))
        .otherwise(counted_on)
    )
    return monthly.withColumn(name, value.cast("int"))


def stock_flow(
    monthly: DataFrame,
    keys: Sequence[str],
    month: str,
    stocks: Sequence[str],
    new: Mapping[str, str] | None = None,
) -> DataFrame:
    """Opening stock and signed flow of each closing stock.

    For a stock ``x``: ``bop_x`` is the closing stock of the key's previous row (0 at first),
    ``gain_x`` and ``churn_x`` are the positive and negative part of the change. When ``new``
    names a column of explained gains for ``x``, ``involuntary_x`` is the rest of the gain and
    ``net_churn_x`` is that rest plus the churn. One row per key and month.
    """
    window = Window.partitionBy(*keys).orderBy(month)
    opened = monthly.withColumns(
        {f"bop_{s}": F.coalesce(F.lag(s, 1, 0).over(window), F.lit(0)) for s in stocks}
    )
    change = {s: F.coalesce(F.col(s), F.lit(0)) - F.col(f"bop_{s}") for s in stocks}
    out = opened.withColumns(
        {f"gain_{s}": F.greatest(d, F.lit(0)) for s, d in change.items()}
        | {f"churn_{s}": F.least(d, F.lit(0)) for s, d in change.items()}
    )
    extra = {}
    for s, explained in (new or {}).items():
        rest = F.col(f"gain_{s}") - F.coalesce(F.col(explained), F.lit(0))
        extra[f"involuntary_{s}"] = rest
        extra[f"net_churn_{s}"] = rest + F.col(f"churn_{s}")
    return out.withColumns(extra) if extra else out


def suppress_in_periods(
    df: DataFrame,
    periods: DataFrame,
    key: str,
    month: str,
    kinds: Sequence[str],
    measures: Sequence[str],
    kind: str = "kind",
    start: str = "start_date",
    end: str = "end_date",
) -> DataFrame:
    """Flag rows inside half-open exception periods and set their measures to 0.

    Periods become one row per key and month with a flag per kind, so overlapping periods cannot
    multiply rows and the join needs an equality only. Adds ``in_<kind>`` columns.
    """
    first, stop = month_start(start), month_start(end)
    flags = (
        periods.filter(stop > first)
        .select(
            F.col(key).alias("_key"),
            F.col(kind).alias("_kind"),
            F.explode(
                F.sequence(first, F.add_months(stop, -1), F.expr("INTERVAL 1 MONTH"))
            ).alias("_month"),
        )
        .groupBy("_key", "_month")
        .agg(*[F.max(F.when(F.col("_kind") == k, 1)).alias(f"in_{k}") for k in kinds])
    )
    on = (df[key] == flags["_key"]) & (df[month] == flags["_month"])
    joined = df.join(flags, on, "left").withColumns(
        {f"in_{k}": F.coalesce(F.col(f"in_{k}"), F.lit(0)) for k in kinds}
    )
    hit = reduce(lambda a, b: a + b, [F.col(f"in_{k}") for k in kinds]) > 0
    return joined.withColumns(
        {m: F.when(hit, F.lit(0)).otherwise(F.col(m)) for m in measures}
    ).drop("_key", "_month")


def first_snapshot_of_month(
    df: DataFrame, date_col: str, month: str = "ref_month", keys: Sequence[str] = ()
) -> DataFrame:
    """Rows of the first snapshot date of each month (per key, if given), dated a month back."""
    starts = df.groupBy(
        *[F.col(k).alias(f"_k_{k}") for k in keys], month_start(date_col).alias("_m")
    ).agg(F.min(date_col).alias("_first"))
    on = all_equal([(df[k], starts[f"_k_{k}"]) for k in keys] + [(df[date_col], starts["_first"])])
    kept = df.join(starts, on, "left_semi")
    return kept.withColumn(month, F.add_months(month_start(date_col), -1))


def expand_effective(
    df: DataFrame,
    keys: Sequence[str],
    start: str,
    run_month: dt.date | str,
    first_month: dt.date | str | None = None,
    month: str = "month",
) -> DataFrame:
    """For each month up to ``run_month``, the rows in force: the newest start in or before it.

    A start counts from the first day of its month. Rows sharing the newest start are all kept.
    Only the newest start of each key and month can ever be in force, so the table is reduced to
    that first; each start is then copied to the months before the next one, which writes every
    (key, month) once instead of joining each row to all later months.
    """
    run = month_of(run_month)
    begun = df.filter(F.col(start) < F.lit(add_months(run, 1)))
    starts = begun.groupBy(*keys, month_start(start).alias("_from")).agg(
        F.max(start).alias("_start")
    )
    window = Window.partitionBy(*keys).orderBy("_from")
    until = F.coalesce(F.add_months(F.lead("_from").over(window), -1), F.lit(run))
    lines = starts.withColumn("_until", until)
    if first_month is not None:
        low = F.lit(month_of(first_month))
        lines = lines.withColumn("_from", F.greatest("_from", low)).filter("_from <= _until")
    lines = lines.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        "_start",
        F.explode(F.sequence("_from", "_until", F.expr("INTERVAL 1 MONTH"))).alias(month),
    )
    on = all_equal([(begun[k], lines[f"_k_{k}"]) for k in keys] + [(begun[start], lines["_start"])])
    return begun.join(lines, on, "inner").select(begun["*"], month)

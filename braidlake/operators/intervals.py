"""Histories with a start and an end, and runs of activity, without range joins.

A key may hold a large part of all rows, so nothing here orders a whole key in one task. Rows are cut
into slices of time; inside a slice a window runs in time order, and each slice is summed up in one row
(its last state, its first instant). Those rows, one per key and slice, are ordered per key and handed
back to the slices: what a slice has to know of earlier or later ones is one row.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.dates import add_months, month_of, month_start, months_apart
from braidlake.functions.keys import all_equal

SLICE = "_slice"


def carry(
    df: DataFrame, keys: Sequence[str], at: str, values: Mapping[str, Column], own: bool = True, ahead: bool = False
) -> DataFrame:
    """``df`` with the last non-NULL of each value up to a row, in the order of ``at`` within a key.

    ``df`` holds one row per key and instant and a column ``_slice`` that rises with ``at``. With ``own``
    false a row does not see itself; with ``ahead`` the order is turned round, so that it sees the next
    value instead of the last.
    """
    edge = 0 if own else -1
    order = F.desc(at) if ahead else F.asc(at)
    inside = Window.partitionBy(*keys, SLICE).orderBy(order).rowsBetween(Window.unboundedPreceding, edge)
    across = Window.partitionBy(*keys).orderBy(F.desc(SLICE) if ahead else F.asc(SLICE)).rowsBetween(Window.unboundedPreceding, -1)
    pick = F.min_by if ahead else F.max_by
    held = df.withColumns({f"_v_{n}": v for n, v in values.items()})
    ends = held.groupBy(*keys, SLICE).agg(
        *[pick(f"_v_{n}", F.when(F.col(f"_v_{n}").isNotNull(), F.col(at))).alias(f"_e_{n}") for n in values]
    )
    before = ends.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate([*keys, SLICE])],
        *[F.last(f"_e_{n}", ignorenulls=True).over(across).alias(f"_b_{n}") for n in values],
    )
    on = all_equal([(F.col(k), F.col(f"_k{i}")) for i, k in enumerate([*keys, SLICE])])
    local = held.withColumns({n: F.last(f"_v_{n}", ignorenulls=True).over(inside) for n in values})
    both = local.join(before, on, "left")
    return both.select(
        *[c for c in df.columns if c not in values], *[F.coalesce(n, f"_b_{n}").alias(n) for n in values]
    )


# ---- two histories ---------------------------------------------------------------------------


def _starts(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[Column], name: str) -> DataFrame:
    """One row per key and start: the state that begins there, with its end."""
    others = [c for c in df.columns if c not in (*keys, start, end)]
    begun = df.filter(F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(end) > F.col(start))))
    first = Window.partitionBy(*keys, start).orderBy(*order, F.desc_nulls_first(end), *[F.desc(c) for c in others])
    return begun.withColumn("_r", F.row_number().over(first)).filter("_r = 1").select(
        *keys, F.col(start).alias("_at"), F.struct(*others, F.col(end).alias("_end")).alias(name)
    )


def intersect_histories(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    start: str = "valid_from",
    end: str = "valid_to",
    how: str = "inner",
    left_order: Sequence[Column] = (),
    right_order: Sequence[Column] = (),
    slice_by: str = "year",
) -> DataFrame:
    """Maximal intervals [start, end) of a key in which both histories keep their values.

    In each history the row with the newest start is in force until its own end (open where NULL), or
    until a newer one starts; a row that a newer one has cut off does not come back. Rows with the
    same start are decided by the given orders, then by the later end. Rows without a start, or that end when they start,
    count for nothing. Value columns of the two sides must differ in name. ``how``: ``inner`` gives
    intervals with both in force, ``left`` those of the left history, ``full`` those of either.

    All starts and ends of both sides are the boundaries. At each, the last start of either side says what
    is in force from there on, and what was in force up to it; boundaries at which neither value
    changes are dropped, which leaves the maximal intervals. Rows are never paired.
    """
    a, b = _starts(left, keys, start, end, left_order, "_a"), _starts(right, keys, start, end, right_order, "_b")
    at_type = left.schema[start].dataType
    none_a, none_b = (F.lit(None).cast(x.schema[n].dataType) for x, n in ((a, "_a"), (b, "_b")))

    def boundaries(df: DataFrame, own: str) -> DataFrame:
        ends = df.select(*keys, F.col(f"{own}._end").alias("_at")).filter("_at IS NOT NULL")
        states = {"_a": none_a, "_b": none_b} | {own: F.col(own)}
        return df.select(*keys, "_at", *[v.alias(n) for n, v in states.items()]).unionByName(
            ends.select(*keys, "_at", none_a.alias("_a"), none_b.alias("_b"))
        )

    each = boundaries(a, "_a").unionByName(boundaries(b, "_b"))
    points = (
        each.groupBy(*keys, F.date_trunc(slice_by, F.col("_at")).alias(SLICE), F.col("_at").cast(at_type).alias("_at"))
        .agg(F.any_value("_a", True).alias("_a"), F.any_value("_b", True).alias("_b"))
    )
    states = carry(points, keys, "_at", {"_pa": F.col("_a"), "_pb": F.col("_b")}, own=False)

    def in_force(now: str, last: str, after: bool) -> Column:
        # after: a start at this instant counts, else what is in force up to it
        held = F.coalesce(F.col(now), F.col(last)) if after else F.col(last)
        stays = held["_end"].isNull() | ((held["_end"] > F.col("_at")) if after else (held["_end"] >= F.col("_at")))
        return F.when(held.isNotNull() & stays, held.dropFields("_end"))

    states = states.select(
        *keys, SLICE, "_at",
        *[in_force(n, f"_p{n[1:]}", True).alias(f"_now{n}") for n in ("_a", "_b")],
        *[in_force(n, f"_p{n[1:]}", False).alias(f"_was{n}") for n in ("_a", "_b")],
    )
    same = F.col("_now_a").eqNullSafe(F.col("_was_a")) & F.col("_now_b").eqNullSafe(F.col("_was_b"))
    kept = states.filter(~same).drop("_was_a", "_was_b")
    spans = carry(kept, keys, "_at", {"_until": F.col("_at")}, own=False, ahead=True)
    wanted = {
        "inner": F.col("_now_a").isNotNull() & F.col("_now_b").isNotNull(),
        "left": F.col("_now_a").isNotNull(),
        "full": F.col("_now_a").isNotNull() | F.col("_now_b").isNotNull(),
    }[how]
    values = [F.col(f"_now_a.{c}") for c in left.columns if c not in (*keys, start, end)]
    values += [F.col(f"_now_b.{c}") for c in right.columns if c not in (*keys, start, end)]
    return spans.filter(wanted).select(*keys, F.col("_at").alias(start), F.col("_until").alias(end), *values)


def months_in_force(
    intervals: DataFrame,
    run_month: dt.date | str,
    first_month: dt.date | str | None = None,
    start: str = "valid_from",
    end: str = "valid_to",
    month: str = "month",
) -> DataFrame:
    """Each interval once for every month whose last day it holds, up to ``run_month``.

    Intervals of a key that do not overlap give at most one row per month, so what is joined to monthly
    facts afterwards is an equality on key and month.
    """
    run = F.lit(month_of(run_month))
    low = month_start(start) if first_month is None else F.greatest(month_start(start), F.lit(month_of(first_month)))
    high = F.least(F.coalesce(F.add_months(month_start(end), -1), run), run)
    return (
        intervals.withColumns({"_low": low, "_high": high})
        .filter("_low <= _high")
        .withColumn(month, F.explode(F.sequence("_low", "_high", F.expr("INTERVAL 1 MONTH"))))
        .drop("_low", "_high")
    )


# ---- runs of activity ------------------------------------------------------------------------


def activity_runs(
    df: DataFrame,
    keys: Sequence[str],
    date_col: str,
    run_month: dt.date | str,
    idle_limit: int = 12,
    first_month: dt.date | str | None = None,
    month: str = "month",
    name: str = "months_active",
) -> DataFrame:
    """Months active of each key in every month of its history, from its first event to ``run_month``.

    A run starts with the first event, and again with the first one after ``idle_limit`` whole months
    without any; the counter is 1 in the month of the start and rises month by month, idle ones
    included, up to the month in which the pause reaches the limit; from there to the next start it is 0.
    Needs no counter of an earlier snapshot (``periods.months_active`` continues one): the whole history is
    read once, reduced to one row per key and month before it is shuffled. ``first_month`` limits the months returned, not those
    counted.

    A slice of a key tells the next one its last event and the start of its open run, and the one
    before its first month.
    """
    run = month_of(run_month)
    monthly = (
        df.filter(F.col(date_col) < F.lit(add_months(run, 1)))
        .groupBy(*keys, month_start(date_col).alias("_m"))
        .agg(F.max(F.col(date_col).cast("date")).alias("_last"))
        .withColumn(SLICE, F.year("_m"))
    )
    seen = carry(monthly, keys, "_m", {"_before": F.col("_last")}, own=False)
    paused = F.col("_before").isNull() | (months_apart(F.col("_m"), F.col("_before")) >= idle_limit)
    begun = carry(seen, keys, "_m", {"_start": F.when(paused, F.col("_m"))})
    spans = carry(begun, keys, "_m", {"_next": F.col("_m")}, own=False, ahead=True)
    until = F.coalesce(F.add_months("_next", -1), F.lit(run))
    low = F.col("_m") if first_month is None else F.greatest("_m", F.lit(month_of(first_month)))
    lines = (
        spans.withColumns({"_low": low, "_until": until})
        .filter("_low <= _until")
        .withColumn(month, F.explode(F.sequence("_low", "_until", F.expr("INTERVAL 1 MONTH"))))
    )
    idle = months_apart(F.col(month), F.col("_last"))
    count = F.months_between(F.col(month), F.col("_start")).cast("int") + 1
    return lines.select(*keys, month, F.when(idle >= idle_limit, 0).otherwise(count).alias(name))

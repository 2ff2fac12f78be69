"""Survivor selection, ranking, synthetic keys and uniqueness checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.functions.keys import all_equal


def latest_by(
    df: DataFrame, keys: Sequence[str], order: str | Sequence[Column], ties: str = "one"
) -> DataFrame:
    """Newest row per key.

    ``ties="one"`` keeps one survivor under ``order`` (a list of sort columns; end it with a
    unique one to be deterministic). The ``row_number() = 1`` filter becomes a group limit that
    runs before the shuffle, so a key that holds a third of the table still ships one row per
    task.

    ``ties="all"`` keeps every row on the newest value of the column named by ``order``. The
    maximum is pre-aggregated and joined back, so tied rows of a hot key are never gathered in
    one window; the skewed side of that join can be split.
    """
    if ties == "one":
        order = [F.col(order).desc_nulls_last()] if isinstance(order, str) else list(order)
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn("_rn", F.row_number().over(window)).filter("_rn = 1").drop("_rn")
    if ties != "all" or not isinstance(order, str):
        raise ValueError("ties='all' takes the name of one order column")
    newest = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.max(order).alias("_newest")
    )
    on = all_equal(
        [(df[k], newest[f"_k_{k}"]) for k in keys] + [(df[order], newest["_newest"])]
    )
    return df.join(newest, on, "left_semi")


def best_then_latest(df: DataFrame, keys: Sequence[str], status: str, ts: str) -> DataFrame:
    """Rows with the smallest status of their key, and among those the newest date (ties kept).

    Rows without a key or a status are dropped. A missing date loses to any date; when a key has
    only missing dates they match one another.
    """
    known = df.dropna(subset=[*keys, status])
    per_status = known.groupBy(*keys, status).agg(F.max(ts).alias("_ts"))
    best = per_status.groupBy(*[F.col(k).alias(f"_k_{k}") for k in keys]).agg(
        F.min(status).alias("_status"), F.min_by("_ts", status).alias("_ts")
    )
    on = all_equal(
        [(known[k], best[f"_k_{k}"]) for k in keys]
        + [(known[status], best["_status"]), (known[ts], best["_ts"])]
    )
    return known.join(best, on, "left_semi")


def rank_within(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    name: str = "row_number",
    slices: Sequence[tuple[str, Column, bool]] = (),
) -> DataFrame:
    """Position of every row inside its key.

    Without ``slices`` this is one window per key: right for keys with a known bound. When a key
    may hold a large part of the table, pass ``slices``: (name, expression, descending) triples
    that are coarser than ``order`` and sort the same way, for example the month of the date the
    rows are ordered by. Rows are then numbered inside (key, slice), and each slice starts at the
    number of rows in the slices before it, so no task sorts a whole hot key.
    """
    if not slices:
        window = Window.partitionBy(*keys).orderBy(*order)
        return df.withColumn(name, F.row_number().over(window))
    # Key and slice travel as one struct: structs with NULL fields are equal to each other, so the
    # join below needs no null-safe key and keeps the partitioning and order of the window.
    place = F.struct(*keys, *[expr.alias(f"_s_{n}") for n, expr, _ in slices])
    placed = df.withColumn("_at", place)
    counts = placed.groupBy("_at").agg(F.count(F.lit(1)).alias("_n"))
    slice_order = [
        F.col(f"_at._s_{n}").desc_nulls_last() if desc else F.col(f"_at._s_{n}").asc_nulls_first()
        for n, _, desc in slices
    ]
    before = (
        Window.partitionBy(*[F.col(f"_at.{k}") for k in keys])
        .orderBy(*slice_order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = counts.select("_at", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_at").orderBy(*order)
    numbered = placed.withColumn("_rn", F.row_number().over(inside))
    return numbered.join(starts, "_at", "inner").select(
        *df.columns, (F.col("_start") + F.col("_rn")).cast("bigint").alias(name)
    )


def synthetic_key(
    df: DataFrame,
    id_col: str,
    key_col: str,
    group: Sequence[str],
    prefix: str,
    collapse: bool = False,
) -> DataFrame:
    """Give rows without an identifier the key ``prefix`` + smallest id of their group.

    The grouping columns name the same person or company (for example name and dates). With
    ``collapse`` one row per group is returned, with the grouping columns only; otherwise every
    row is kept. Rows whose group holds a NULL have nothing to be grouped by and are dropped, as
    in the equality join this replaces.
    """
    known = df.filter(F.col(key_col).isNotNull())
    missing = df.filter(F.col(key_col).isNull())
    if collapse:
        made = missing.groupBy(*group).agg(
            F.concat(F.lit(prefix), F.min(id_col).cast("string")).alias(key_col)
        )
        return known.select(key_col, *group).unionByName(made).distinct()
    lowest = missing.groupBy(*group).agg(F.min(id_col).alias("_lowest"))
    made = (
        missing.drop(key_col)
        .join(lowest, list(group), "inner")
        .withColumn(key_col, F.concat(F.lit(prefix), F.col("_lowest").cast("string")))
    )
    return known.unionByName(made.select(*known.columns))


def prefer_direct(
    direct: DataFrame, indirect: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Direct records of a key, or its first indirect one when it has none.

    Ranking direct rows 1 and indirect rows from 2 and keeping the lowest rank per key means
    exactly this, without numbering every indirect row.
    """
    cols = direct.columns
    fallback = latest_by(indirect, keys, order).select(*cols)
    fallback = fallback.join(direct.select(*keys).distinct(), list(keys), "left_anti")
    return direct.distinct().unionByName(fallback.distinct())


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise with a few offending keys."""
    bad = duplicate_keys(df, keys).limit(5).collect()
    if bad:
        raise ValueError(f"duplicate keys on {list(keys)}: {[r.asDict() for r in bad]}")
    return df

"""Exact distinct counts from bitmaps.

The distinct values of a whole-number id are bits: 32,768 consecutive ids share one bitmap of 4 KB, so a
group's distinct ids are its bitmaps, however many rows it has. Tasks send on one bitmap per group and 32,768 ids
instead of one row per id, and bitmaps of parts (months, regions) give the count of any union of them by
OR, without going back to the rows.

This pays where groups are few and full. For very many small groups (a bitmap takes its 4 KB for one bit)
use ``periods.window_metrics`` or ``periods.cumulative_distinct``, which group twice.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.functions.dates import add_months, month_of
from braidlake.operators.periods import MERGEABLE
from braidlake.sources import lake


def dense_ids(df: DataFrame, entity: str, name: str = "entity_no") -> DataFrame:
    """(entity, number): whole numbers for the values of any column, as dense as tasks can hand them out.

    Staged, as the numbers must not change when a task runs again. Numbers are consecutive inside a
    task's part of the values, so bitmaps are full.
    """
    values = df.select(entity).filter(F.col(entity).isNotNull()).distinct()
    return lake.stage(values.withColumn(name, F.monotonically_increasing_id()), "dense_ids")


def partials(df: DataFrame, keys: Sequence[str | Column], entity: str | Column, bits: str = "bits") -> DataFrame:
    """(keys, bucket, bits): the distinct values of a whole-number column per group, 32,768 to a row."""
    id_ = (F.col(entity) if isinstance(entity, str) else entity).cast("long")
    names = [F.col(k) if isinstance(k, str) else k for k in keys]
    rows = df.select(*names, id_.alias("_id")).filter("_id IS NOT NULL")
    columns = [c for c in rows.columns if c != "_id"]
    return rows.groupBy(*columns, F.bitmap_bucket_number("_id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_id")).alias(bits)
    )


def merged(parts: DataFrame, keys: Sequence[str], name: str, bits: str = "bits") -> DataFrame:
    """Distinct counts of coarser groups: bitmaps of the same bucket are OR-ed, then counted."""
    united = parts.groupBy(*keys, "bucket").agg(F.bitmap_or_agg(bits).alias("_bits"))
    return united.groupBy(*keys).agg(F.sum(F.bitmap_count("_bits")).alias(name))


def windows(
    parts: DataFrame,
    keys: Sequence[str],
    month: str,
    anchors: Sequence[dt.date | str],
    widths: Mapping[str, int | None],
    anchor: str = "anchor_month",
    bits: str = "bits",
) -> DataFrame:
    """Distinct counts of trailing windows, all from one table of monthly partials.

    ``widths`` maps a column name to a number of months up to the anchor, NULL for the whole past. Each partial
    is read once; a bucket's bitmaps for all windows come from one grouping.
    """
    cells = {}
    for i, a in enumerate(anchors):
        for n, width in widths.items():
            low = F.lit(True) if width is None else F.col(month) >= F.lit(add_months(a, 1 - width))
            cells[f"{n}_{i}"] = low & (F.col(month) <= F.lit(month_of(a)))
    hit = reduce(lambda x, y: x | y, cells.values())
    united = parts.filter(hit).groupBy(*keys, "bucket").agg(
        *[F.bitmap_or_agg(F.when(cond, F.col(bits))).alias(n) for n, cond in cells.items()]
    )
    counts = united.groupBy(*keys).agg(
        *[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).alias(n) for n in cells]
    )
    rows = F.array(
        *[
            F.struct(F.lit(month_of(a)).alias(anchor), *[F.col(f"{n}_{i}").alias(n) for n in widths])
            for i, a in enumerate(anchors)
        ]
    )
    held = counts.select(*keys, F.inline(rows))
    return held.filter(reduce(lambda x, y: x | y, [F.col(n) > 0 for n in widths]))


def grouped(
    df: DataFrame,
    keys: Sequence[str],
    entity: str,
    flags: Mapping[str, Column],
    measures: Mapping[str, tuple[str, Column]] | None = None,
) -> DataFrame:
    """Several filtered distinct counts of one whole-number column beside ordinary aggregates, in one grouping.

    ``flags`` maps a name to the condition under which a row's ``entity`` counts; ``measures`` are as in
    ``periods.window_metrics``. The fact is grouped once, by key and bucket of 32,768 entities, with a bitmap per
    count; the few rows of a key are then merged. Rows without an entity count in the measures.
    """
    measures = dict(measures or {})
    id_ = F.col(entity).cast("long")
    bit = F.bitmap_bit_position(id_)
    first = df.groupBy(*keys, F.bitmap_bucket_number(id_).alias("_bucket")).agg(
        *[F.bitmap_construct_agg(F.when(cond & id_.isNotNull(), bit)).alias(n) for n, cond in flags.items()],
        *[MERGEABLE[f][0](col).alias(n) for n, (f, col) in measures.items()],
    )
    return first.groupBy(*keys).agg(
        *[F.sum(F.bitmap_count(n)).alias(n) for n in flags],
        *[MERGEABLE[f][1](n).alias(n) for n, (f, _) in measures.items()],
    )

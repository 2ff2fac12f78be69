"""Unions of sources with different shapes, and the bronze-silver-gold composition."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align_union(
    frames: Mapping[str, DataFrame],
    origin: str | None = "origin",
    columns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Stack frames by name, missing columns as NULL, tagged with where a row came from.

    ``columns`` (name -> type) fixes the output order and types; without it the columns appear in
    the order they are first seen. Duplicates are kept.
    """
    tagged = [
        df if origin is None else df.withColumn(origin, F.lit(name)) for name, df in frames.items()
    ]
    if columns is not None:
        tags = [origin] if origin else []
        tagged = [
            df.select(
                *[
                    (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                    for c, t in columns.items()
                ],
                *tags,
            )
            for df in tagged
        ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def rename_map(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Project and rename in one step: source name -> output name."""
    return df.select([F.col(a).alias(b) for a, b in names.items()])


def medallion(
    bronze: DataFrame,
    keep: Column | str,
    columns: Sequence[str],
    keys: Sequence[str],
    measures: Mapping[str, Column],
    derive: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> tuple[DataFrame, DataFrame]:
    """Silver (projected, filtered, derived rows) and gold (aggregates per key) of one input."""
    silver = derive(bronze.select(*columns).where(keep))
    gold = silver.groupBy(*keys).agg(*[m.alias(n) for n, m in measures.items()])
    return silver, gold

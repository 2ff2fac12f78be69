"""Golden records, source flags, exclusion rules and classification."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def golden_record(
    sources: Mapping[str, DataFrame],
    keys: Sequence[str],
    rules: Mapping[str, tuple[str, Sequence[str]]],
    present: bool = False,
) -> DataFrame:
    """One record per key from several sources, each with one row per key.

    ``rules`` maps an output column to (policy, sources in priority order):

    * ``first``: first non-null value;
    * ``owner``: the value of the first source that knows the key, even when it is NULL;
    * ``least`` / ``greatest``: smallest / largest value.

    All sources are stacked and grouped once, so N sources cost one shuffle instead of a key
    spine and N joins. ``present`` adds an ``in_<source>`` 0/1 column per source.
    """
    stacked = reduce(
        lambda a, b: a.unionByName(b, allowMissingColumns=True),
        [
            df.select(
                F.lit(name).alias("_source"),
                *keys,
                *[F.col(c) for c, (_, order) in rules.items() if name in order],
            )
            for name, df in sources.items()
        ],
    )
    wanted = [(c, s) for c, (_, order) in rules.items() for s in order]
    grouped = stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_source") == s, F.col(c))).alias(f"_{c}_{s}") for c, s in wanted],
        *[F.max(F.when(F.col("_source") == s, 1).otherwise(0)).alias(f"in_{s}") for s in sources],
    )

    def pick(col: str) -> Column:
        policy, order = rules[col]
        values = [F.col(f"_{col}_{s}") for s in order]
        if policy == "first":
            return F.coalesce(*values)
        if policy in ("least", "greatest"):
            return getattr(F, policy)(*values) if len(values) > 1 else values[0]
        if policy == "owner":
            chosen = F.when(F.col(f"in_{order[0]}") == 1, values[0])
            for s, v in zip(order[1:], values[1:]):
                chosen = chosen.when(F.col(f"in_{s}") == 1, v)
            return chosen
        raise ValueError(f"unknown policy {policy!r}")

    flags = [f"in_{s}" for s in sources] if present else []
    return grouped.select(*keys, *[pick(c).alias(c) for c in rules], *flags)


def source_flags(
    sources: Mapping[str, DataFrame], keys: Sequence[str], name: str = "sources"
) -> DataFrame:
    """Sorted, comma-separated list of the sources that know a key, and one 0/1 flag per source."""
    stacked = reduce(
        lambda a, b: a.unionByName(b),
        [df.select(*keys, F.lit(s).alias("_source")) for s, df in sources.items()],
    )
    flags = stacked.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_source") == s, 1).otherwise(0)).alias(f"flag_{s}") for s in sources]
    )
    listed = F.concat_ws(
        ", ", *[F.when(F.col(f"flag_{s}") == 1, F.lit(s)) for s in sorted(sources)]
    )
    return flags.withColumn(name, listed)


def exclude_internal(
    df: DataFrame,
    always: Sequence[Column],
    unless_kept: Sequence[Column],
    kept: DataFrame,
    on: Sequence[str],
) -> DataFrame:
    """Drop test and internal rows; the second group of rules is lifted for keys in ``kept``.

    A rule that cannot be decided (NULL) does not exclude.
    """

    def any_of(rules: Sequence[Column]) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(r, F.lit(False)) for r in rules], F.lit(False))

    flagged = df.filter(~any_of(always)).withColumn("_soft", any_of(unless_kept))
    payers = kept.select(*on).distinct().withColumn("_kept", F.lit(True))
    return (
        flagged.join(payers, list(on), "left")
        .filter(~F.col("_soft") | F.col("_kept").isNotNull())
        .select(*df.columns)
    )


def classify(
    df: DataFrame, table: DataFrame, on: Mapping[str, str], outputs: Mapping[str, object]
) -> DataFrame:
    """Attributes from a reference table; unmatched rows get the given default.

    ``on`` maps columns of ``df`` to columns of ``table``. This replaces long chains of OR
    branches: the list lives in a table, and a table of that size is broadcast by its statistics.
    """
    ref = table.select(
        *[F.col(r).alias(f"_k_{r}") for r in on.values()],
        *[F.col(c).alias(f"_v_{c}") for c in outputs],
    )
    cond = reduce(lambda a, b: a & b, [df[c] == ref[f"_k_{r}"] for c, r in on.items()])
    return df.join(ref, cond, "left").select(
        df["*"],
        *[
            (F.coalesce(F.col(f"_v_{c}"), F.lit(d)) if d is not None else F.col(f"_v_{c}")).alias(c)
            for c, d in outputs.items()
        ],
    )

"""Mixing sources to target weights by Poisson replication.

A source with mean repetition rate r gets each of its documents Poisson(r) times. The count of a
document is the inverse of the Poisson distribution at a number in (0, 1) that an MD5 of its doc_id
and the seed gives, so a rerun or a repeated task draws the same. Copies are then spread over all
partitions by a second hash and ordered by it inside each: a global shuffle.

A rate over ``PIECE`` is drawn as a sum of independent parts of at most ``PIECE``, so that the table
of the inverse stays exact in double precision.

Only built-in functions run. Per source one row is joined: the sources' table is written once, counted and
broadcast up to ``FEW_SOURCES`` rows, so texts are not shuffled by source; beyond that the adaptive
join splits a source with many rows. The one shuffle of texts is the global one, by the second hash.

Results for odd input: a NULL source is a source of its own; a NULL or empty text weighs nothing and
its source's rate applies to it as to others; a source without any text gets rate 0; rows with the
same doc_id (also NULL) draw the same count; other columns are carried along, and new columns get
underscores where their names are taken; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.llm.common import Staged, bind, free_name

PIECE = 16
FEW_SOURCES = 10_000  # rows of under 1 KB that may be broadcast
TERMS = 100  # the terms beyond are below 1e-40 for a mean of 16


def rates(docs: DataFrame, size: Column, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, rate): target shares follow the sources' sizes to the given power.

    ``epochs`` is the expected size of the result as a multiple of the input's.
    """
    totals = docs.groupBy(F.col("source").alias("source")).agg(F.sum(size).cast("double").alias("total"))
    whole = totals.agg(F.sum("total").alias("whole"), F.sum(F.pow("total", F.lit(power))).alias("weights"))
    share = F.pow("total", F.lit(power)) / F.col("weights")
    rate = F.when(F.col("total") > 0, F.lit(epochs) * share * F.col("whole") / F.col("total")).otherwise(0.0)
    return totals.join(F.broadcast(whole), how="inner").select("source", rate.alias("rate"))  # one row


def uniform(*parts: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of an MD5."""
    head = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts])), 1, 13)
    return (F.conv(head, 16, 10).cast("double") + 0.5) / F.lit(float(2**52))


def cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0 .. TERMS - 1, X being Poisson of the given mean."""
    start = F.exp(-mean)
    empty = F.struct(start.alias("p"), start.alias("c"), F.array(start).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        c = state["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(state["all"], F.array(c)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS - 1)), empty, step, lambda s: s["all"])


def mix(docs: DataFrame, by_source: DataFrame, seed: int) -> DataFrame:
    """Documents repeated by their counts: all columns, copy, n_copies and the shuffle key.

    ``by_source`` holds (source, rate) with one row per source.
    """
    copy, copies, order = (free_name(docs, n) for n in ("copy", "n_copies", "shuffle_key"))
    pieces = F.greatest(F.ceil(F.col("rate") / PIECE), F.lit(1)).cast("int")
    name, n_pieces, below = (free_name(docs, n) for n in ("rate_source", "rate_pieces", "rate_below"))
    table = by_source.select(F.col("source").alias(name), pieces.alias(n_pieces), cumulative(F.col("rate") / pieces).alias(below))
    table = Staged(table, "rates").df
    if table.count() <= FEW_SOURCES:
        table = F.broadcast(table)
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))

    def one_piece(n: Column, i: Column) -> Column:
        return n + bind(uniform(doc, F.lit(seed), F.lit("n"), i), lambda u: F.size(F.filter(below, lambda c: c < u)))

    drawn = F.aggregate(F.sequence(F.lit(1), F.col(n_pieces)), F.lit(0), one_piece)
    joined = docs.join(table, docs["source"].eqNullSafe(table[name]), "inner")
    # No filter on the count: pushed into the join it would be drawn twice.
    times = F.when(F.col(copies) > 0, F.sequence(F.lit(1), F.col(copies)))
    return (
        joined.withColumn(copies, drawn)
        .drop(name, n_pieces, below)
        .withColumn(copy, F.explode_outer(times))
        .filter(F.col(copy).isNotNull())
        .withColumn(order, F.md5(F.concat_ws(":", doc, F.col(copy).cast("string"), F.lit(f"{seed}:order"))))
        .repartition(F.col(order))
        .sortWithinPartitions(order)
    )

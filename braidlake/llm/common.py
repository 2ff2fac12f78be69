"""Shared pieces: staged tables, connected components, word hashes, bounded hit filters."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MASK = (1 << 64) - 1


# ---------------------------------------------------------------- staged tables
def shared_dir(spark: SparkSession) -> str:
    """Folder that driver and executors share.

    The cluster names it in ``spark.checkpoint.dir``. Where that is unset (tests), a folder in the
    warehouse is used, which every executor reaches as well.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    return (root or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staged").rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """Fresh path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop, fs = _fs(spark, path)
    fs.deleteOnExit(hadoop)
    return path


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def drop(spark: SparkSession, *paths: str) -> None:
    for path in paths:
        hadoop, fs = _fs(spark, path)
        fs.delete(hadoop, True)


class Staged:
    """A table written to the shared folder: cuts the lineage and outlives lost executors."""

    def __init__(self, df: DataFrame, name: str):
        self.spark, self.path = df.sparkSession, new_path(df.sparkSession, name)
        df.write.option("compression", "zstd").parquet(self.path)
        self.df = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        drop(self.spark, self.path)


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of finished jobs now.

    It does so once the driver's JVM has collected their handles, which in a job that stages its steps
    may be long after their last use.
    """
    spark.sparkContext._jvm.System.gc()


# ---------------------------------------------------------------- expressions
def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


# ---------------------------------------------------------------- connected components
FEW_LINKS = 200_000  # rows that one task handles without a shuffle


def components(edges: DataFrame, a: str = "a", b: str = "b", most_rounds: int = 60) -> Staged:
    """Union-find over a table of links: (node, root), root being the smallest node reachable.

    Alternates the large-star and small-star steps, each a grouping and a join on the node, until
    the links no longer change. Links stay in the shared folder between rounds and are never
    collected; a hub is pre-aggregated to its minimum before the shuffle. The minima are written
    before they are joined back, so both sides of the join are scans and a hub's links can be
    split. Nodes without a link are not in the result. Once a count has shown that there are few
    links, a bounded number, the same steps run in one partition, where they need no shuffle.
    """
    spark = edges.sparkSession
    now = Staged(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct(),
        "links",
    )
    seen = None
    for _ in range(most_rounds):
        stamp = now.df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if stamp == seen or stamp[0] == 0:
            break
        seen = stamp
        few, made = stamp[0] <= FEW_LINKS, []

        def packed(df: DataFrame, few=few) -> DataFrame:
            return df.coalesce(1) if few else df

        def kept(df: DataFrame, few=few, made=made) -> DataFrame:
            if few:
                return df
            made.append(Staged(df, "links"))
            return made[-1].df

        rows = packed(now.df)
        both = packed(rows.union(rows.select("v", "u")))
        low = kept(both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m")))
        # large star: every larger neighbour is linked to the smallest one
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = Staged(large.filter("u <> v").distinct(), "links")
        # small star: the smaller neighbours and the node itself are linked to the smallest one
        rows = packed(large.df)
        least = kept(rows.groupBy("u").agg(F.min("v").alias("m")))
        small = packed(
            rows.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(least.select("u", "m"))
            .filter("u <> v")
        ).distinct()
        old, now = now, Staged(small, "links")
        for table in (old, large, *made):
            table.drop()
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    # At rest every node points at its root.
    roots = now.df.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "node")
    own = now.df.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    out = Staged(roots.union(own), "roots")
    now.drop()
    return out


# ---------------------------------------------------------------- links inside buckets
Verify = Callable[[DataFrame], DataFrame]


def apart(bits: str, other: str) -> Column:
    """A number that the symmetric difference of two sets is not below: bits that one outline has alone."""
    return F.aggregate(F.zip_with(bits, other, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def connect(
    members: DataFrame, verify: Verify, alike: float, outline: Callable[[DataFrame], DataFrame], pivot_rounds: int = 3
) -> Staged:
    """Components (node, root) of the links that ``verify`` confirms between members of a bucket.

    ``members`` has (key, node, n): a node of set size n in bucket key, once each. ``verify`` turns
    pairs (a, b) into (a, b, linked, far), far being the exact Jaccard distance. Every member is
    compared with one pivot of its bucket, the node that meets the most others over all its
    buckets: of a text and its altered copies that is the text itself, which is like all of them
    though they may not be like each other. Buckets that then hold several components get
    further pivots. Last come all pairs of a bucket that lie in different components.

    Pairs are verified only if they can be linked by their sizes and outlines. ``outline`` turns nodes
    into (node, bits): a bit per element of the set at a hashed place, so every bit that only one
    of two sets has stands for elements that the other lacks. Sets just below the limit fail that, so they
    make no rows, however large the group of them; and no link inside a bucket is lost.
    """
    sizes = members.groupBy("key").agg(F.count("*").alias("met")).filter("met > 1")
    meets = members.join(sizes, "key").groupBy("node").agg(F.sum("met").alias("met"))
    # a fraction from the node itself settles ties
    weighed = members.join(meets.withColumn("met", F.col("met") + F.pmod(F.xxhash64("node"), F.lit(997)) / 1000), "node")
    first = Staged(
        weighed.groupBy("key")
        .agg(
            F.max_by("node", "met").alias("pivot"), F.max_by("n", "met").alias("first_n"),
            F.min("node").alias("m"), F.max("node").alias("x"),
        )
        .filter("m <> x").select("key", "pivot", "first_n"),
        "pivots",
    )
    held = Staged(members.join(first.df, "key"), "members")
    first.drop()

    def sized(n: str, other: str) -> Column:
        return F.least(n, other) >= alike * F.greatest(n, other) - 1e-9

    pairs = held.df.filter((F.col("node") != F.col("pivot")) & sized("n", "first_n"))
    tables = [Staged(verify(pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()), "verified")]
    judged = tables[0].df
    roots = components(judged.filter("linked"))
    shapes = None
    for step in range(1, pivot_rounds + 2):
        here = Staged(
            held.df.join(roots.df, "node", "left").withColumn("root", F.coalesce("root", "node")), "rooted"
        )
        several = Staged(
            here.df.groupBy("key").agg(F.min("root").alias("m"), F.max("root").alias("x")).filter("m <> x").select("key"),
            "unsettled",
        )
        tables.append(several)
        if not several.df.limit(1).count():
            here.drop()
            break  # every bucket lies in one component
        unsettled = here.df.join(several.df, "key", "left_semi")
        if shapes is None:  # later rounds have no other nodes
            shapes = Staged(outline(unsettled.select("node").distinct()), "outlines").df
        known = judged.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        bits = unsettled.join(shapes, "node")
        most = (1 - alike) / (1 + alike)  # of the sizes' sum: the largest symmetric difference of linked sets

        def linkable(n: str, other: str, own: str, others: str) -> Column:
            return sized(n, other) & (apart(own, others) <= most * (F.col(n) + F.col(other)) + 1e-9)

        if step <= pivot_rounds:
            draw = F.xxhash64("node", F.lit(step))
            chosen = unsettled.groupBy("key").agg(*[F.min_by(c, draw).alias(f"p_{c}") for c in ("node", "root", "n")])
            chosen = chosen.join(shapes.select(F.col("node").alias("p_node"), F.col("bits").alias("p_bits")), "p_node")
            pairs = (
                bits.join(chosen, "key").filter("root <> p_root")
                .filter(linkable("n", "p_n", "bits", "p_bits"))
                .select(F.least("p_node", "node").alias("a"), F.greatest("p_node", "node").alias("b"))
            )
        else:
            mine = bits.select("key", "node", "root", "n", "bits")
            other = mine.select("key", *[F.col(c).alias(f"o_{c}") for c in ("node", "root", "n", "bits")])
            pairs = (
                mine.join(other, "key")
                .filter((F.col("node") < F.col("o_node")) & (F.col("root") != F.col("o_root")))
                .filter(linkable("n", "o_n", "bits", "o_bits"))
                .select(F.col("node").alias("a"), F.col("o_node").alias("b"))
            )
        fresh = Staged(pairs.distinct().join(known, ["a", "b"], "left_anti"), "pairs")
        here.drop()
        if fresh.df.limit(1).count():
            tables.append(Staged(verify(fresh.df), "verified"))
            judged = judged.union(tables[-1].df)
            if tables[-1].df.filter("linked").limit(1).count():
                roots.drop()
                roots = components(judged.filter("linked"))
        fresh.drop()
    for table in (held, *tables):
        table.drop()
    return roots


def possible_hits(
    df: DataFrame, column: str, keys: DataFrame, key: str, bits: int = 1 << 23, how: str = "left_semi"
) -> DataFrame:
    """Rows of ``df`` whose 64-bit ``column`` may be among ``keys``; no hit is lost, few others stay.

    A bit set of fixed size, in rows of 64 bits: at most ``bits`` / 64 rows (131,072, a few MB)
    whatever the number of keys, so it can always be broadcast. With very many keys everything
    passes, which costs shuffle and no result: an exact join follows. With ``how="left_anti"`` the
    other rows: certainly no hits.
    """
    bit = F.pmod(F.col(key), F.lit(bits))
    table = (
        keys.select(bit.alias("_bit"))
        .groupBy(F.expr("_bit div 64").alias("_word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(_bit % 64 as int)))").alias("_mask"))
    )
    own = F.pmod(F.col(column), F.lit(bits))
    held = (F.floor(own / 64) == F.col("_word")) & (F.getbit(F.col("_mask"), (own % 64).cast("int")) == 1)
    return df.join(F.broadcast(table), held, how)


# ---------------------------------------------------------------- Python kernels
def words_of(text: str | None) -> list[bytes]:
    """Runs of anything but space, tab, line feed, vertical tab, form feed, carriage return."""
    return text.encode().split() if text else []


def hash_words(words: list[bytes]) -> np.ndarray:
    """64-bit keyed hash of every word, the same in every process."""
    if not words:
        return np.zeros(0, np.uint64)
    held = np.empty(len(words), dtype=object)
    held[:] = words
    return pd.util.hash_array(held, categorize=False)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


class Powers:
    """Powers of BASE and of its inverse, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            n = max(n, 2 * len(self.up))
            self.up = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, BASE)])
            self.down = np.multiply.accumulate(np.r_[np.uint64(1), np.full(n - 1, INVERSE)])
        return self.up, self.down


POWERS = Powers()


def prefix_hash(hashes: np.ndarray) -> np.ndarray:
    """Running polynomial sums; ``span_hash`` reads the hash of any span from them."""
    up, _ = POWERS.get(len(hashes) + 1)
    out = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of the words [start, end), the same wherever those words stand."""
    _, down = POWERS.get(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start])


OUTLINE_WORDS = 64  # of 64 bits each


def outlines(sets: list[np.ndarray]) -> pa.Array:
    """An array of OUTLINE_WORDS words per set of hashes, with a bit per element."""
    out = np.zeros((len(sets), OUTLINE_WORDS), np.uint64)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    flat = mix(np.concatenate(sets)) if sets else np.zeros(0, np.uint64)
    word = (flat >> np.uint64(6)) % np.uint64(OUTLINE_WORDS)
    np.bitwise_or.at(out, (row, word.astype(np.int64)), np.uint64(1) << (flat & np.uint64(63)))
    at = pa.array(np.arange(0, out.size + 1, OUTLINE_WORDS, dtype=np.int32))
    return pa.ListArray.from_arrays(at, pa.array(out.ravel().view(np.int64)))


def windows_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    starts = np.arange(n)
    return span_hash(prefix_hash(hashes), starts, starts + width)


def slices(batch: pa.RecordBatch, column: str, most: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of at most ``most`` bytes of text (one row at least)."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch[column]), 0).to_numpy()
    total = np.cumsum(sizes)
    start = 0
    while start < len(sizes):
        base = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, base + most, side="right")))
        yield batch.slice(start, end - start)
        start = end


def map_text(df: DataFrame, column: str, schema: T.StructType, work, most: int = 8_000_000) -> DataFrame:
    """mapInArrow over pieces of bounded text size; ``work(batch) -> RecordBatch | None``."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                for part in slices(batch, column, most):
                    out = work(part)
                    if out is not None:
                        yield out

    return df.mapInArrow(run, schema)


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, with underscores until no column has that name in any case."""
    taken = {c.lower() for c in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted

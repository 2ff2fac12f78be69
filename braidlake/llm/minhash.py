"""Near-duplicate documents by fast similarity sketching, banding and exact verification.

A document's set is its distinct word shingles. The sketch has one coordinate per bin: in every
round each shingle is hashed to a bin and leaves its value there, later rounds counting as larger,
until no bin is empty; after as many rounds as bins, round i looks at bin i alone, which fills it
for certain. The share of equal coordinates then estimates the Jaccard similarity with the
concentration of independent minima, at the cost of a few rounds for large sets.

Bands of coordinates propose links. In a band's bucket members are compared with a pivot first, on
their full sets; members already connected need no further comparison, and what is left between
components of a bucket is compared pair by pair unless the sizes or outlines (a bit per element) of the sets
rule a link out. So a group of thousands of copies costs about one
comparison per member, and no link between members of one bucket is lost. With 32 bands of 5 a pair at
the limit of 0.8 shares a bucket with probability 1 - 3e-6.

Documents with the same set are one class from the start. All tables between the steps stay in
Spark; nothing about documents is collected.

Results for odd input: NULL, empty and blank texts have no shingles and are linked with nothing; a
text with fewer words than a shingle has its whole sequence as the one shingle; texts of any length
count in full; a repeated row belongs to the class of its text; rows without a doc_id take part, but
never name a component; other columns are not read by ``near_duplicates`` and are carried along by
``keep_one``; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.llm.common import (
    Staged,
    connect,
    free_name,
    hash_words,
    map_text,
    mix,
    outlines,
    possible_hits,
    windows_hash,
)

EMPTY = np.uint64((1 << 64) - 1)
LOW = np.uint64(0xFFFFFFFF)


@dataclass(frozen=True)
class Settings:
    words: int = 5
    percent: int = 80  # least similarity, as 100 * intersection >= percent * union
    bands: int = 32
    rows: int = 5
    pivot_rounds: int = 3

    @property
    def bins(self) -> int:
        return self.bands * self.rows


# ---------------------------------------------------------------- sets and sketches
def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles; A-Z are read as a-z."""
    return shingle_sets([text], width)[0]


def shingle_sets(texts: list[str | None], width: int) -> list[np.ndarray]:
    split = [t.encode().lower().split() if t else [] for t in texts]
    hashes = hash_words([w for words in split for w in words])
    out, at = [], 0
    for words in split:
        own = hashes[at : at + len(words)]
        at += len(words)
        # Sequences of different lengths get different hashes.
        out.append(np.unique(windows_hash(own, min(width, len(own))) ^ np.uint64(min(width, len(own)))) if len(own) else own)
    return out


def round_seeds(n: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch(values: np.ndarray, bins: int, seeds: np.ndarray) -> np.ndarray:
    """Fast similarity sketch of a non-empty set; ``seeds`` has one seed for each of 2 x bins rounds."""
    out = np.full(bins, EMPTY)
    width = np.uint64(bins)
    at_once = max(1, math.ceil(1.2 * bins * math.log(bins) / len(values)))
    i = 0
    while i < bins:
        rounds = np.arange(i, min(bins, i + at_once), dtype=np.uint64)
        h = mix(values[None, :] ^ seeds[i : i + len(rounds), None])
        spot = ((h >> np.uint64(32)) * width) >> np.uint64(32)
        np.minimum.at(out, spot.ravel().astype(np.int64), ((rounds[:, None] << np.uint64(32)) | (h & LOW)).ravel())
        i += len(rounds)
        if not (out == EMPTY).any():
            return out
    for b in np.flatnonzero(out == EMPTY):
        h = mix(values ^ seeds[bins + b])
        out[b] = (np.uint64(bins + b) << np.uint64(32)) | (h & LOW).min()
    return out


def band_keys(sketched: np.ndarray, s: Settings) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    factors = round_seeds(s.rows) | np.uint64(1)
    keys = (mix(sketched).reshape(s.bands, s.rows) * factors).sum(axis=1)
    return mix(keys + round_seeds(s.bands))


SIGNED = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("mark", T.LongType()),
        T.StructField("n_shingles", T.LongType()),
        T.StructField("digest", T.BinaryType()),
        T.StructField("bands", T.ArrayType(T.LongType())),
    ]
)


def signed(docs: DataFrame, s: Settings) -> DataFrame:
    """(doc_id, mark, n_shingles, digest of the set, band keys); mark is a hash of the text."""
    seeds = round_seeds(2 * s.bins)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch["text"].to_pylist(), s.words)
        digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
        bands = [band_keys(sketch(x, s.bins, seeds), s).view(np.int64) if len(x) else None for x in sets]
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                batch["mark"],
                pa.array([len(x) for x in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            names=SIGNED.names,
        )

    text = F.col("text").cast("string")
    return map_text(
        docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text")), "text", SIGNED, work
    )


# ---------------------------------------------------------------- verification
PAIR = T.StructType(
    [T.StructField("a", T.LongType()), T.StructField("b", T.LongType()), T.StructField("linked", T.BooleanType()), T.StructField("far", T.DoubleType())]
)


def verify(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b, linked, far): every pair judged on its full sets; far is the Jaccard distance."""

    def work(batches):
        last, held = None, None
        for batch in batches:
            linked, far = [], []
            for a, ta, tb in zip(batch["a"].to_pylist(), batch["ta"], batch["tb"]):
                if a != last or held is None:
                    last, held = a, shingle_set(ta.as_py(), s.words)
                other = shingle_set(tb.as_py(), s.words)
                both = len(np.intersect1d(held, other, assume_unique=True))
                union = len(held) + len(other) - both
                linked.append(100 * both >= s.percent * union)
                far.append(1 - both / union)
            yield pa.RecordBatch.from_arrays(
                [batch["a"], batch["b"], pa.array(linked, pa.bool_()), pa.array(far, pa.float64())], names=PAIR.names
            )

    with_b = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
    with_a = with_b.join(texts.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a")
    return with_a.select("a", "b", "ta", "tb").mapInArrow(work, PAIR)


def outlined(nodes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(node, bits): the outline of every node's set."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = shingle_sets(batch["text"].to_pylist(), s.words)
        return pa.RecordBatch.from_arrays([batch["node"], outlines(sets)], names=["node", "bits"])

    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("bits", T.ArrayType(T.LongType()))])
    return map_text(texts.join(nodes, "node", "left_semi").select("node", "text"), "text", schema, work)


# ---------------------------------------------------------------- grouping
def near_duplicates(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """Per row: doc_id, mark, n_shingles, component_id, kept.

    component_id is the smallest doc_id among all documents that can be reached over links, kept
    says whether it is the row's own.
    """
    rows = Staged(signed(docs, s).withColumn("uid", F.monotonically_increasing_id()), "signed")
    classes = Staged(
        rows.df.filter("digest is not null").groupBy("digest").agg(F.min("uid").alias("node"), F.min("doc_id").alias("least_doc")),
        "classes",
    )
    nodes = rows.df.select(F.col("uid").alias("node"), F.col("n_shingles").alias("n"), "bands").join(
        classes.df.select("node"), "node"
    )
    keys = nodes.select("node", "n", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("node").alias("m"), F.max("node").alias("x")).filter("m <> x").select("key")
    members = Staged(possible_hits(keys, "key", shared, "key").join(shared, "key", "left_semi"), "bands")

    text = F.col("text").cast("string")
    needed = rows.df.select(F.col("uid").alias("node"), "doc_id", "mark").join(
        members.df.select("node").distinct(), "node"
    )
    listed = docs.select(F.col("doc_id").cast("long").alias("d"), F.xxhash64(text).alias("m"), text.alias("text"))
    found = possible_hits(listed, "m", needed, "mark").join(
        needed, F.col("d").eqNullSafe(F.col("doc_id")) & (F.col("m") == F.col("mark"))
    )
    texts = Staged(found.groupBy("node").agg(F.first("text").alias("text")), "texts")  # repeated rows: once

    roots = connect(
        members.df,
        lambda pairs: verify(pairs, texts.df, s),
        s.percent / 100,
        lambda left: outlined(left, texts.df, s),
        s.pivot_rounds,
    )
    members.drop()
    texts.drop()
    whole = classes.df.join(roots.df, "node", "left").withColumn("root", F.coalesce("root", "node"))
    named = whole.groupBy("root").agg(F.min("least_doc").alias("component_id"))
    by_class = Staged(whole.join(named, "root").select("digest", "component_id"), "components")
    roots.drop()
    classes.drop()
    joined = rows.df.select("doc_id", "mark", "n_shingles", "digest").join(by_class.df, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.withColumn("component_id", component).select(
        "doc_id", "mark", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def keep_one(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """One document of each component, with all its columns; repeated rows come once."""
    judged = Staged(near_duplicates(docs, s), "judged")
    d, m = free_name(docs, "near_doc"), free_name(docs, "near_mark")
    own = F.col("doc_id").cast("long")
    key: tuple[Column, ...] = (own, F.xxhash64(F.col("text").cast("string")))
    listed = docs.withColumns({d: key[0], m: key[1]})

    def on(table: DataFrame) -> Column:
        return listed[d].eqNullSafe(table["doc_id"]) & (listed[m] == table["mark"])

    lost = judged.df.filter("not kept").select("doc_id", "mark").distinct()
    rest = listed.join(lost, on(lost), "left_anti")
    twice = judged.df.filter("kept and n_shingles > 0").groupBy("doc_id", "mark").count().filter("count > 1").drop("count")
    if twice.limit(1).count():
        again = rest.join(twice, rest[d].eqNullSafe(twice["doc_id"]) & (rest[m] == twice["mark"]), "left_semi")
        alone = rest.join(twice, rest[d].eqNullSafe(twice["doc_id"]) & (rest[m] == twice["mark"]), "left_anti")
        rest = alone.union(again.dropDuplicates([d, m]))
    return rest.drop(d, m)

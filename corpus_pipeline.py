"""A training corpus from raw documents, in stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braidlake.llm import bpe, line_dedup, minhash, mixing, quality
from braidlake.llm.common import Staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SEED = 17


def good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that fail the base rules or stand far from their language go."""
    return quality.keep(docs.select(COLUMNS), quality.references(docs))


def fresh_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: near-copies of a line go; so do documents of which no word is left by that."""
    out = line_dedup.dedup(docs.select(COLUMNS))
    text = F.col("text")
    left = text.rlike(r"[^\x20\x09-\x0D]")
    return out.filter((F.col("n_removed") == 0) | left).withColumn("n_chars", F.length(text).cast("long")).select(COLUMNS)


def one_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on shingles of five words: one document of each component stays."""
    return minhash.keep_one(docs.select(COLUMNS))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing: sources are repeated or thinned towards the square root of their sizes, then shuffled."""
    docs = docs.select(COLUMNS)
    return mixing.mix(docs, mixing.rates(docs, F.length("text")), SEED).select(COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: every document's ids, and a digest of the bytes that they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.digests(docs, path, public_tokenizers.PATTERN)


STAGES = [
    ("quality rules", good),
    ("line dedup", fresh_lines),
    ("MinHash near-dedup", one_each),
    ("mixing", mixed),
    ("byte-level BPE", tokens),
]

# The last stage merges bytes by a table of 50,000 ranks, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over <sf_dir>/documents.parquet; each result but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = Staged(stage(spark, docs, sf_dir), name.replace(" ", "-")).df
    return STAGES[-1][1](spark, docs, sf_dir)

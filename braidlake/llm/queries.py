"""The registered queries of this package and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from braidlake.llm import licenses, twins
from braidlake.llm.licenses import NOTICES

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, read) -> DataFrame``; ``read(table)`` loads a table of the folder."""

    def register(fn):
        def run(spark: SparkSession, root: str) -> DataFrame:
            return fn(spark, lambda table: spark.read.parquet(f"{root}/{table}.parquet"))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_token_files")
def _token_files(spark, read):
    from braidlake.llm import token_files

    return token_files.round_trip(read("documents"), tokenizer_file("byte_bpe_50k.json"), end_id=2)


@query("op8_byte_bpe")
def _byte_bpe(spark, read):
    import public_tokenizers

    from braidlake.llm import bpe

    return bpe.digests(read("documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op2_quality")
def _quality(spark, read):
    from braidlake.llm import quality

    docs = read("documents")
    return quality.judge(docs, quality.references(docs))


@query("op5_minhash", twins.NEAR)
def _minhash(spark, read):
    from braidlake.llm import minhash

    return minhash.near_duplicates(read("documents"), minhash.Settings(words=4)).drop("mark")


@query("op9_mixing", twins.MIX)
def _mixing(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import mixing

    docs = read("documents")
    mixed = mixing.mix(docs, mixing.rates(docs, F.length("text")), seed=17)
    return mixed.select("doc_id", "source", "copy", "n_copies", "shuffle_key", F.md5("text").alias("text_md5"))


@query("op3_line_dedup", twins.LINES)
def _line_dedup(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import line_dedup

    out = line_dedup.dedup(read("documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


@query("op6_debruijn", twins.REPEATS)
def _debruijn(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import debruijn

    out = debruijn.remove(read("documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op4_ann_tree")
def _ann(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import ann_tree

    return ann_tree.search(read("embeddings"), F.col("id") % 20 == 0)


URL_RULES = (
    "allow org/",
    "block example.org/es/",
    "block example.org/en/1",
    "allow com/fr/",
    "block com/de/",
)


@query("op7_url_filter", twins.URLS)
def _urls(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import url_filter

    pages = read("pages")
    return url_filter.judge(pages, url_filter.rules(*URL_RULES), block_list(pages))


def block_list(pages: DataFrame) -> DataFrame:
    """A list such as others publish: half of the pages (by a hash of the URL) in another spelling of the
    same address, and as many addresses again that no page has."""
    from pyspark.sql import functions as F

    url = F.col("url")
    spelled = F.regexp_replace(url, r"(?i)^([a-z]+://)(?:www\.)?", "$1www.")
    tracked = F.when(url.rlike("[?#]"), spelled).otherwise(F.concat(spelled, F.lit("?utm_source=list")))
    nowhere = F.regexp_replace(url, "^([^:]*://[^/?#]*)", F.concat(F.lit("$1/nowhere-"), F.md5(url)))
    half = F.substring(F.md5(url), 1, 1) < "8"
    return pages.filter(half).select(tracked.alias("url")).union(pages.select(nowhere.alias("url")))


@query("op10_licenses", twins.licenses_sql(NOTICES))
def _licenses(spark, read):
    return licenses.scan(read("documents")).select("doc_id", "license", "containment")


@query("op11_whitening")
def _whitening(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import whitening

    # The exact deviation has up to 38 digits; beyond a long it is NULL here.
    return whitening.whiten(read("embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


@query("op12_va_file", twins.NEAREST)
def _va_file(spark, read):
    from pyspark.sql import functions as F

    from braidlake.llm import va_file

    return va_file.search(read("embeddings"), F.col("id") % 50 == 0)


@query("op13_divergence", twins.DIVERGENCE)
def _divergence(spark, read):
    from braidlake.llm import divergence

    return divergence.audit(read("documents"))

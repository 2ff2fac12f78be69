"""Repeated passages by compaction of a token de Bruijn graph.

The edges of the graph are the windows of ``window`` words; neighbours in a text overlap by all but one
word. Edges are first compacted inside each document: a run of windows that share their minimizer
(the smallest hash of ``anchor`` words in a window, which the window alone determines) is one path
without branches, about 20 edges long, named by a hash of its words.

1. Paths are grouped by content. All edges of a path that also occurs in a smaller doc_id are repeated.
2. A minimizer with several different paths is where texts part or meet. Only there are paths taken
   apart into single edges, wherever they stand in their smallest document, and edges grouped by content.
3. Repeated paths and edges carry the coordinates of their source, the smallest document with the same
   words. Where text and source coordinates advance together there is no branch: neighbours compact
   into one long span.
4. Each span is compared with its source by a 128-bit digest of the words themselves, read at both
   coordinates, before anything is removed.

Every equal pair of windows has the same minimizer, so no repeat is missed; grouping by content
emits no pairs, however often a passage occurs.

Results for odd input: NULL, empty and blank texts have no words; texts of any length count in full;
documents with a NULL doc_id have no order, lose nothing and are no source; rows with the same doc_id
do not count as each other's source; repeated rows give repeated rows; other columns are not read;
an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.llm.common import Staged, hash_words, map_text, possible_hits, prefix_hash, span_hash

LOW = np.uint64(0xFFFFFFFF)
HIGH = np.uint64(0xFFFFFFFF00000000)


@dataclass(frozen=True)
class Settings:
    window: int = 50
    anchor: int = 10


def _text_rows(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), text.alias("text"))


def _schema(text: str) -> T.StructType:
    return T.StructType.fromDDL(text)


# ---------------------------------------------------------------- 1. edges, compacted to paths
PATHS = "path long, minimizer long, doc_id long, mark long, start int, n int"


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every run of ``width`` values, by doubling."""
    held, have = values, 1
    while 2 * have <= width:
        held = np.minimum(held[:-have], held[have:])
        have *= 2
    rest = width - have
    return np.minimum(held[: len(held) - rest], held[rest:]) if rest else held


def paths_of(split: list[list[bytes]], s: Settings) -> tuple[np.ndarray, ...]:
    """(document index, start, edges, path hash, minimizer hash) of the paths of several texts."""
    sizes = np.array([len(w) for w in split])
    ends = np.cumsum(sizes)
    total = int(sizes.sum())
    none = np.zeros(0, np.int64)
    if total < s.window:
        return none, none, none, none, none
    prefix = prefix_hash(hash_words([w for words in split for w in words]))
    at = np.arange(total - s.anchor + 1)
    anchors = span_hash(prefix, at, at + s.anchor)
    # hash in the high half, position in the low one: the leftmost of equal ones wins
    place = (anchors & HIGH) | at.astype(np.uint64)
    chosen = (sliding_min(place, s.window - s.anchor + 1) & LOW).astype(np.int64)
    starts = np.arange(total - s.window + 1)
    doc = np.repeat(np.arange(len(split)), sizes)[: len(starts)]
    inside = starts + s.window <= ends[doc]
    starts, doc, chosen = starts[inside], doc[inside], chosen[inside]
    if not len(starts):
        return none, none, none, none, none
    first = np.flatnonzero(np.append(True, (chosen[1:] != chosen[:-1]) | (doc[1:] != doc[:-1])))
    n = np.diff(np.append(first, len(starts)))
    begin = starts[first]
    hashes = span_hash(prefix, begin, begin + n + s.window - 1)
    local = begin - (ends - sizes)[doc[first]]
    return doc[first], local, n, hashes.view(np.int64), anchors[chosen[first]].view(np.int64)


def paths(docs: DataFrame, s: Settings) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        split = [t.encode().split() if t else [] for t in batch["text"].to_pylist()]
        doc, start, n, path, minimizer = paths_of(split, s)
        at = pa.array(doc)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(path), pa.array(minimizer), batch["doc_id"].take(at), batch["mark"].take(at),
                pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)),
            ],
            names=["path", "minimizer", "doc_id", "mark", "start", "n"],
        )

    return map_text(_text_rows(docs).filter("doc_id is not null"), "text", _schema(PATHS), work)


# ---------------------------------------------------------------- 2. edges at branches
EDGES = "edge long, doc_id long, mark long, start int"


def at_places(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts of the documents in ``wanted`` (doc_id, mark, ...), once each, with its columns."""
    rows = possible_hits(_text_rows(docs), "mark", wanted, "mark")
    return rows.join(wanted, ["doc_id", "mark"]).dropDuplicates(["doc_id", "mark"])


def edges(docs: DataFrame, branching: DataFrame, s: Settings) -> DataFrame:
    """Every edge of the given paths (doc_id, mark, start, n)."""
    listed = branching.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("start", "n")).alias("at"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = [[], [], []]
        for i, (text, at) in enumerate(zip(batch["text"].to_pylist(), batch["at"].to_pylist())):
            prefix = prefix_hash(hash_words(text.encode().split()))
            begin = np.array([x["start"] for x in at])
            n = np.array([x["n"] for x in at])
            starts = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out[0].append(span_hash(prefix, starts, starts + s.window).view(np.int64))
            out[1].append(np.full(len(starts), i))
            out[2].append(starts.astype(np.int32))
        row = pa.array(np.concatenate(out[1]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(out[0])), batch["doc_id"].take(row), batch["mark"].take(row), pa.array(np.concatenate(out[2]))],
            names=["edge", "doc_id", "mark", "start"],
        )

    return map_text(at_places(docs, listed), "text", _schema(EDGES), work)


# ---------------------------------------------------------------- 3. sources and spans
def with_source(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose content also stands in a smaller document, with the coordinates there."""
    source = (
        rows.groupBy(key)
        .agg(
            F.min("doc_id").alias("src_doc"), F.max("doc_id").alias("last"),
            F.min_by("mark", "doc_id").alias("src_mark"), F.min_by("start", "doc_id").alias("src_start"),
        )
        .filter("src_doc < last").drop("last")
    )
    return possible_hits(rows, key, source, key).join(source, key).filter("doc_id > src_doc")


def spans(repeated: DataFrame) -> DataFrame:
    """Repeats that follow each other in text and source alike, joined into spans."""
    order = Window.partitionBy("doc_id", "mark").orderBy("start")

    def before(c: str) -> Column:
        return F.lag(c).over(order)

    moved = (
        (F.col("start") != before("start") + before("n"))
        | (F.col("src_doc") != before("src_doc"))
        | (F.col("src_mark") != before("src_mark"))
        | (F.col("src_start") != before("src_start") + before("n"))
    )
    return (
        repeated.repartition("doc_id", "mark")
        .dropDuplicates(["doc_id", "mark", "start"])
        .withColumn("new", F.coalesce(moved, F.lit(True)).cast("int"))
        .withColumn("run", F.sum("new").over(order))
        .groupBy("doc_id", "mark", "run", "src_doc", "src_mark")
        .agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.min("src_start").alias("src_start"))
        .drop("run")
    )


# ---------------------------------------------------------------- 4. verification
def verified(docs: DataFrame, found: DataFrame, s: Settings) -> DataFrame:
    """Spans whose words are those at the source, by digests taken at both places."""
    numbered = Staged(found.withColumn("span", F.monotonically_increasing_id()), "spans")
    here = numbered.df.select("span", F.lit(0).alias("side"), "doc_id", "mark", "start", "n")
    there = numbered.df.select("span", F.lit(1), "src_doc", "src_mark", "src_start", "n")
    # A popular source would gather all its spans in one row: equal reads are made once.
    reads = here.union(there).groupBy("doc_id", "mark", "start", "n").agg(F.max("side").alias("side"))
    listed = reads.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "n")).alias("at"))
    extra = s.window - 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, starts, counts, digests = [], [], [], []
        for i, (text, at) in enumerate(zip(batch["text"].to_pylist(), batch["at"].to_pylist())):
            words = text.encode().split()
            for x in at:
                rows.append(i)
                starts.append(x["start"])
                counts.append(x["n"])
                content = b" ".join(words[x["start"] : x["start"] + x["n"] + extra])
                digests.append(hashlib.blake2b(content, digest_size=16).digest())
        row = pa.array(rows, pa.int64())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"].take(row), batch["mark"].take(row), pa.array(starts, pa.int32()), pa.array(counts, pa.int32()), pa.array(digests, pa.binary())],
            names=["doc_id", "mark", "start", "n", "digest"],
        )

    read = Staged(
        map_text(at_places(docs, listed), "text", _schema("doc_id long, mark long, start int, n int, digest binary"), work),
        "digests",
    )
    source = read.df.toDF("src_doc", "src_mark", "src_start", "n", "src_digest")
    return (
        numbered.df.join(read.df, ["doc_id", "mark", "start", "n"])
        .join(source, ["src_doc", "src_mark", "src_start", "n"])
        .filter("digest = src_digest")
        .select("doc_id", "mark", "start", "n", "src_doc", "src_start")
    )


def repeated_spans(docs: DataFrame, s: Settings = Settings()) -> Staged:
    """(doc_id, mark, start, n, src_doc, src_start): n windows from word ``start`` on are repeats.

    ``mark`` is xxhash64 of the text; the words covered are start .. start + n + window - 2.
    """
    all_paths = Staged(paths(docs, s), "paths")
    by_path = with_source(all_paths.df, "path")
    # One document stands for all that share a path; where a minimizer has several, look closer.
    distinct = Staged(
        all_paths.df.groupBy("path").agg(
            F.min("doc_id").alias("doc_id"), F.max("doc_id").alias("last"), F.min("minimizer").alias("minimizer")
        ),
        "distinct",
    )
    branches = (
        distinct.df.groupBy("minimizer")
        .agg(F.count("*").alias("paths"), F.min("doc_id").alias("lo"), F.max("last").alias("hi"))
        .filter("paths > 1 and lo < hi").select("minimizer")
    )
    branching = Staged(
        possible_hits(distinct.df, "minimizer", branches, "minimizer")
        .join(branches, "minimizer", "left_semi").select("path", "doc_id"),
        "branching",
    )
    # That document may hold the path several times; each occurrence can be a repeat of its own.
    places = possible_hits(all_paths.df, "path", branching.df, "path").join(branching.df, ["path", "doc_id"])
    single = Staged(edges(docs, places.select("doc_id", "mark", "start", "n"), s), "edges")
    columns = ["doc_id", "mark", "start", "n", "src_doc", "src_mark", "src_start"]
    repeated = by_path.select(*columns).union(
        with_source(single.df, "edge").withColumn("n", F.lit(1)).select(*columns)
    )
    out = Staged(verified(docs, spans(repeated), s), "repeats")
    for table in (all_paths, distinct, branching, single):
        table.drop()
    return out


def remove(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, n_words, n_removed, kept): kept has the words that stay, joined by one space."""
    found = repeated_spans(docs, s).df
    listed = found.groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "n")).alias("at"))
    extra = s.window - 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n_words, n_removed, kept = [], [], []
        for text, at in zip(batch["text"].to_pylist(), batch["at"].to_pylist()):
            words = text.encode().split() if text else []
            n = len(words)
            if at:
                edge = np.zeros(n + 1, np.int64)
                start = np.array([x["start"] for x in at])
                np.add.at(edge, start, 1)
                np.add.at(edge, start + np.array([x["n"] for x in at]) + extra, -1)
                words = [words[i] for i in np.flatnonzero(np.cumsum(edge)[:n] == 0).tolist()]
            n_words.append(n)
            n_removed.append(n - len(words))
            kept.append(b" ".join(words).decode())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept"],
        )

    schema = _schema("doc_id long, n_words long, n_removed long, kept string")
    rows = _text_rows(docs)
    no_spans = F.lit(None).cast("array<struct<start:int,n:int>>")
    hit = possible_hits(rows, "mark", listed, "mark").join(listed, ["doc_id", "mark"], "left")
    rest = possible_hits(rows, "mark", listed, "mark", how="left_anti").withColumn("at", no_spans)
    columns = ["doc_id", "text", "at"]
    return map_text(hit.select(*columns).union(rest.select(*columns)), "text", schema, work)

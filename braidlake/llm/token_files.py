"""Token-id files: ids ranked by frequency, byte-aligned, control bytes apart from the data.

A folder holds ``shard-*.tok`` files in ascending document order and two small Parquet tables,
``ranks`` (rank -> id, the most frequent id first) and ``manifest`` (one row per shard).

A shard is a run of blocks. A block holds whole documents::

    n_docs, n_values, n_bytes    3 x uint32, little-endian
    doc_ids                      n_docs x int64 (the smallest int64 stands for NULL)
    counts                       n_docs x uint32, values of each document
    control                      ceil(n_values / 4) bytes, 2 bits a value: its bytes less one
    data                         n_bytes bytes, each value's 1 to 4 bytes, little-endian

A value is the rank of an id, so that the commonest 256 ids take one byte. Decoding looks the four
lengths of a control byte up in a 256 x 4 table and gathers all bytes of a block with numpy.

Writers name a file after their task attempt; only the names in ``manifest``, which Spark commits,
count. A lost or repeated task leaves at most a file that nobody reads.

Results for odd input: a NULL text counts as empty and gives the end id alone; a document longer
than a block gets a block of its own; NULL doc_ids come first; repeated doc_ids are ordered by their
ids, repeated rows are all written; other columns are not read; an empty table gives no shard.
"""

from __future__ import annotations

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.llm.common import Staged, drop, map_text, new_path, slices

NULL_ID = np.iinfo(np.int64).min
BLOCK_VALUES = 1 << 18
CACHED_CHARS = 64
CACHED_PIECES = 1_000_000  # entries; a full cache is emptied
STOPS = ".,;:!?"

# A space or line feed before something that is not white space starts a pre-token of this tokenizer
# family, whatever stands before it.
PIECES = re.compile(r"(?=[ \n]\S)")
BLANK_AFTER = re.compile(r" (?=\s|\Z)")
NEWLINE = re.compile(r"\n(?=\S)")


# ---------------------------------------------------------------- encoding with the library
class TextEncoder:
    """Whole texts through the ``tokenizers`` library, piece by piece with a bounded cache.

    Pieces end before a space or line feed that is followed by something else, where a pre-token always
    starts, so the ids of a text are those of its pieces in a row. A piece that starts with one space
    is named by what follows it, one that starts with one line feed by itself, any other by itself with a space in
    front; no piece of the first kind starts with white space, so names are unambiguous. A batch looks
    each of its names up once. New pieces are joined again and encoded as one text; the number of bytes
    of each id tells where a piece ends. Texts that hold the string of an added token, and all texts of a
    tokenizer whose pre-tokens end elsewhere, are encoded whole.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        # Where these stand in a text the library reads one id; blanks before them are split otherwise.
        self.added = sorted({t.content for t in self.tokenizer.get_added_tokens_decoder().values()} - {""})
        self.by_pieces = splits_at_spaces(json.loads(self.tokenizer.to_str()))
        if self.by_pieces and hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)  # it is asked for no piece twice
        self.pieces: dict[str, bytes] = {}
        size = self.tokenizer.get_vocab_size()
        # every character of a byte-level token stands for one byte
        self.sizes = np.array([len(self.tokenizer.id_to_token(i) or "") for i in range(size)])
        self.n_ids = size

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _join(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of pieces from the library; named as in ``encode_all``."""
        out = {k: self._encode(k[1:]).tobytes() for k in keys if k[0] == " "}
        plain = [k for k in keys if k[0] != " "]
        for start in range(0, len(plain), 4000):
            part = plain[start : start + 4000]
            part = [k if k[0] == "\n" else " " + k for k in part]
            ids = self._encode("".join(part))
            ends = np.cumsum(self.sizes[ids])
            at = np.cumsum([len(k.encode()) for k in part])
            cuts = (4 * (np.searchsorted(ends, at) + 1)).tolist()
            flat = ids.tobytes()
            out.update((k, flat[a:b]) for k, a, b in zip(plain[start : start + 4000], [0, *cuts], cuts))
        return out

    def _new(self, keys: set[str]) -> dict[str, bytes]:
        """Ids of pieces that the cache lacks.

        Letters followed by stops end a pre-token there, so such a piece is put together from the
        ids of its letters and those of the stops, which are pieces too.
        """
        parts, whole = {}, set()
        for k in keys:
            if not k.isalpha():
                stem = k.rstrip(STOPS)
                if stem != k and stem.isalpha():
                    # " ." names the stops as they stand after letters
                    parts[k] = stem, " " + k[len(stem) :]
                    continue
            whole.add(k)
        known = self.pieces
        whole.update(x for two in parts.values() for x in two if x not in known)
        out = self._join(whole)
        for k, (stem, tail) in parts.items():
            out[k] = (out.get(stem) or known[stem]) + (out.get(tail) or known[tail])
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit bytes."""
        out, first, rest = [b""] * len(texts), {}, [None] * len(texts)
        for i, t in enumerate(texts):
            if not t:
                continue
            if not self.by_pieces or any(x in t for x in self.added):
                out[i] = self._encode(t).tobytes()
            elif BLANK_AFTER.search(t):
                first[i] = [_name(p) for p in PIECES.split(t) if p]
            else:
                head, space, rest[i] = NEWLINE.sub(" \n", t).partition(" ")
                first[i] = [" " + head] if head else []  # nothing before a space at the start
                if not space:
                    rest[i] = None
        # The other names of all texts, numbered by Arrow.
        split = pa.compute.split_pattern(pa.array(rest, pa.string()), " ")
        coded = split.flatten().dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        held = list(map(self.pieces.get, names))
        fresh = {k for k, ids in zip(names, held) if not ids}
        fresh.update(k for ks in first.values() for k in ks if k not in self.pieces)
        new = self._new(fresh) if fresh else {}
        held = [ids or new[k] for k, ids in zip(names, held)]
        flat, ends = gather(held, coded.indices.to_numpy())
        known = self.pieces.get
        spans = ends[split.offsets.to_numpy()].tolist()
        for i, ks in first.items():
            out[i] = b"".join([known(k) or new[k] for k in ks]) + flat[spans[i] : spans[i + 1]].tobytes()
        if len(self.pieces) + len(new) > CACHED_PIECES:
            self.pieces.clear()
        self.pieces.update((k, v) for k, v in new.items() if len(k) <= CACHED_CHARS)
        return out


def _name(piece: str) -> str:
    if piece[0] in " \n" and piece[1:2].strip():
        return piece[1:] if piece[0] == " " else piece
    return " " + piece


def gather(values: list[bytes], codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``values[c]`` for all codes in a row, and where those of every code start and the last end."""
    ids = np.frombuffer(b"".join(values), "<u4")
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    starts = np.cumsum(sizes) - sizes
    ends = np.append(0, np.cumsum(sizes[codes]))
    at = np.repeat((starts[codes] - ends[:-1]).astype(np.int32), sizes[codes])
    at += np.arange(len(at), dtype=np.int32)
    return ids[at], ends


def splits_at_spaces(spec: dict) -> bool:
    """True for byte-level tokenizers without a normalizer, whose pattern starts a pre-token at such a space."""
    steps = spec.get("pre_tokenizer") or {}
    plain = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
    return bool(plain and spec.get("normalizer") is None and spec["model"].get("type") == "BPE")


@lru_cache(maxsize=1)
def text_encoder(path: str) -> TextEncoder:
    return TextEncoder(path)


# ---------------------------------------------------------------- the coding
LENGTHS = np.array([[((c >> 2 * i) & 3) + 1 for i in range(4)] for c in range(256)], np.uint8)


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes of 32-bit values."""
    values = np.ascontiguousarray(values, "<u4")
    sizes = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    quads = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    quads[: len(values)] = sizes - 1
    quads = quads.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    held = np.arange(4, dtype=np.uint8) < sizes[:, None]
    return control.astype(np.uint8).tobytes(), values.view(np.uint8).reshape(-1, 4)[held].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The values back: lengths from the table, then every byte put in its place at once."""
    sizes = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    held = np.arange(4, dtype=np.uint8) < sizes[:, None]
    out = np.zeros((n, 4), np.uint8)
    out[held] = np.frombuffer(data, np.uint8)
    return out.reshape(-1).view("<u4")


def block(docs: list[int], counts: list[int], values: np.ndarray) -> bytes:
    control, data = pack(values)
    return b"".join(
        (
            np.array([len(docs), len(values), len(data)], "<u4").tobytes(),
            np.array(docs, "<i8").tobytes(),
            np.array(counts, "<u4").tobytes(),
            control,
            data,
        )
    )


def read_blocks(stream) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc_ids, counts, values) of each block of an open shard."""
    while head := stream.read(12):
        n_docs, n, n_bytes = np.frombuffer(head, "<u4").tolist()
        docs = np.frombuffer(stream.read(8 * n_docs), "<i8")
        counts = np.frombuffer(stream.read(4 * n_docs), "<u4")
        control = stream.read(-(-n // 4))
        yield docs, counts, unpack(control, stream.read(n_bytes), n)


def open_path(path: str, mode: str):
    """A stream on any file system pyarrow knows, by URI."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1) if path.startswith("file:") else f"file://{path}")
    if mode == "rb":
        return system.open_input_stream(name)
    system.create_dir(name.rpartition("/")[0], recursive=True)
    return system.open_output_stream(name)


# ---------------------------------------------------------------- jobs
ENCODED = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("ids", T.BinaryType())])
MANIFEST = "shard int, path string, first_doc long, last_doc long, n_docs long, n_tokens long, n_bytes long"


def _squeeze(ids: bytes) -> bytes:
    """Ids for the staged table and the shuffle: 16-bit where they fit, then zstd."""
    values = np.frombuffer(ids, "<u4")
    wide = bool(len(values)) and int(values.max()) > 0xFFFF
    raw = values.astype("<u4" if wide else "<u2").tobytes()
    return bytes([wide]) + len(raw).to_bytes(4, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _loosen(blob: bytes) -> np.ndarray:
    raw = pa.decompress(blob[5:], int.from_bytes(blob[1:5], "little"), codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u4" if blob[0] else "<u2")


def encode(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """(doc_id, ids) with ids squeezed for a shuffle; ``end_id`` closes every document."""
    tail = b"" if end_id is None else end_id.to_bytes(4, "little")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        coded = text_encoder(tokenizer).encode_all(batch["text"].to_pylist())
        blobs = [_squeeze(ids + tail) for ids in coded]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(blobs, pa.binary())], names=["doc_id", "ids"])

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "text", ENCODED, work)


def frequencies(encoded: DataFrame) -> DataFrame:
    """(id, n) over all documents; each task sends one row per id it has seen."""

    def work(batches):
        total = np.zeros(0, np.int64)
        for batch in batches:
            for part in slices(batch, "ids", 1 << 20):
                more = np.bincount(np.concatenate([_loosen(blob) for blob in part["ids"].to_pylist()]), minlength=len(total))
                more[: len(total)] += total
                total = more
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], names=["id", "n"])

    return encoded.select("ids").mapInArrow(work, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int | None = None) -> None:
    """Encode every document and write the folder.

    Three passes: encode into a staged table, count ids (one row per id of the vocabulary reaches
    the driver, so its size is bounded), then sort by doc_id with a range shuffle, put ranks for ids
    and write one shard per task.
    """
    spark = docs.sparkSession
    staged = Staged(encode(docs, tokenizer, end_id), "encoded")
    order = [r["id"] for r in frequencies(staged.df).orderBy(F.desc("n"), "id").collect()]
    spark.createDataFrame(
        pd.DataFrame({"rank": np.arange(len(order)), "id": np.array(order, np.int64)}), "rank long, id long"
    ).coalesce(1).write.parquet(f"{folder}/ranks")
    rank_of = np.zeros(max(order, default=0) + 1, "<u4")
    rank_of[np.array(order, np.int64)] = np.arange(len(order))
    ranks = spark.sparkContext.broadcast(rank_of)  # at most one entry per id of the vocabulary

    def put(batches):
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        path = f"{folder}/shard-{shard:06d}-{uuid.uuid4().hex}.tok"
        stream, n_docs, n_tokens, n_bytes, first, last = None, 0, 0, 0, None, None
        doc_ids, counts, parts, held = [], [], [], 0

        def flush():
            nonlocal stream, doc_ids, counts, parts, held, n_bytes
            stream = stream or open_path(path, "wb")
            out = block(doc_ids, counts, np.concatenate(parts))
            stream.write(out)
            n_bytes += len(out)
            doc_ids, counts, parts, held = [], [], [], 0

        for batch in batches:
            for doc, blob in zip(batch["doc_id"].to_pylist(), batch["ids"].to_pylist()):
                values = ranks.value[_loosen(blob)]
                if held and held + len(values) > BLOCK_VALUES:
                    flush()
                doc_ids.append(NULL_ID if doc is None else doc)
                counts.append(len(values))
                parts.append(values)
                held += len(values)
                first, last = doc if n_docs == 0 else first, doc
                n_docs, n_tokens = n_docs + 1, n_tokens + len(values)
        if n_docs:
            flush()
            stream.close()
            yield pa.RecordBatch.from_pylist(
                [dict(shard=shard, path=path, first_doc=first, last_doc=last, n_docs=n_docs, n_tokens=n_tokens, n_bytes=n_bytes)],
                schema=pa.schema(
                    [("shard", pa.int32()), ("path", pa.string())]
                    + [(c, pa.int64()) for c in ("first_doc", "last_doc", "n_docs", "n_tokens", "n_bytes")]
                ),
            )

    # The digest splits and orders what shares a doc_id.
    ordered = (
        staged.df.withColumn("tie", F.xxhash64("ids"))
        .repartitionByRange(F.col("doc_id").asc_nulls_first(), "tie")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "tie")
        .select("doc_id", "ids")
    )
    ordered.mapInArrow(put, MANIFEST).write.parquet(f"{folder}/manifest")
    staged.drop()
    ranks.unpersist()


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the folder, from its files: doc_id, start, n_tokens, ids_crc32, ids.

    ``ids`` is dropped by the optimiser's column pruning only where the caller does not select it;
    use ``read_digests`` when the ids themselves are not wanted.
    """
    return _read(spark, folder, with_ids=True)


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """As ``read``, without the ids."""
    return _read(spark, folder, with_ids=False)


def _read(spark: SparkSession, folder: str, with_ids: bool) -> DataFrame:
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").collect()
    id_of = spark.sparkContext.broadcast(np.array([r["id"] for r in ranks], "<u4"))
    shards = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    # One row per shard: the sum before each is taken over the manifest, not over documents.
    before = F.sum("n_tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    n = max(1, shards.count())
    shards = shards.withColumn("base", F.coalesce(before, F.lit(0))).select("path", "base")
    names = ["doc_id", "start", "n_tokens", "ids_crc32"] + ["ids"] * with_ids
    types = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids binary" * with_ids

    def work(batches):
        for batch in batches:
            for path, base in zip(batch["path"].to_pylist(), batch["base"].to_pylist()):
                with open_path(path, "rb") as stream:
                    for docs, counts, values in read_blocks(stream):
                        ids = id_of.value[values].tobytes()
                        ends = np.cumsum(counts, dtype=np.int64)
                        starts = ends - counts
                        spans = [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                        columns = [
                            pa.array(docs, pa.int64(), mask=docs == NULL_ID),
                            pa.array(base + starts, pa.int64()),
                            pa.array(counts.astype(np.int64)),
                            pa.array([zlib.crc32(s) for s in spans], pa.int64()),
                        ] + [pa.array(spans, pa.binary())] * with_ids
                        base += len(values)
                        yield pa.RecordBatch.from_arrays(columns, names=names)

    # dealt out in turn: a hash of the paths would leave some tasks without a shard
    return shards.repartitionByRange(n, "path").mapInArrow(work, types)


def round_trip(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Write the files to the shared folder and read the digests of every document back."""
    spark = docs.sparkSession
    folder = new_path(spark, "tokens")
    write(docs, folder, tokenizer, end_id)
    return read_digests(spark, folder)


def delete(spark: SparkSession, folder: str) -> None:
    drop(spark, folder)

"""Byte-level BPE encoding and decoding with a bitmap queue of merge ranks.

``RankQueue`` keeps, for every merge rank, a bucket of positions in the linked list of parts. Two
levels of bit sets tell which buckets hold anything, so that the lowest rank is found by two
find-first-set steps whatever the length of the text. An entry whose pair has changed since it was
queued is skipped when it comes up. Encoding a pre-token of n bytes therefore costs O(n log n) at
worst, also when it has a million bytes.

Results for odd input: a NULL text counts as empty and gives no ids and empty bytes; texts of any
length are encoded whole; repeated rows give repeated rows; other columns are not read, so their
names do not matter; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braidlake.llm.common import map_text

CACHED_CHARS = 64  # longer pieces are encoded each time, so that the cache stays small
CACHED_PIECES = 500_000  # entries of the cache; a full one is emptied
SLICE_BYTES = 2_000_000  # of text encoded at a time: what is new in it is held several times over

# A space before something that is not white space always starts a pre-token, whatever precedes it.
PIECES = re.compile(r"(?= \S)")
BLANK_AFTER = re.compile(r" (?=\s|\Z)")


def piece_keys(text: str) -> list[str]:
    """The pieces of a text, each ending before such a space.

    A piece that starts with one space is named by what follows it, any other by itself with a
    space in front; the former never starts with white space, so names are unambiguous.
    """
    if BLANK_AFTER.search(text):
        return [key_of(p) for p in PIECES.split(text) if p]
    keys = text.split(" ")
    keys[0] = " " + keys[0]
    return keys


def key_of(piece: str) -> str:
    return piece[1:] if piece[0] == " " and piece[1:2].strip() else " " + piece


def piece_of(key: str) -> str:
    return key[1:] if key[0] == " " else " " + key


class RankQueue:
    """Smallest (rank, position) first; positions of one rank from left to right."""

    def __init__(self):
        self.buckets: dict[int, list[int]] = {}
        self.top = 0  # bit h: some bucket of ranks [256 h, 256 h + 256) holds positions
        self.leaf: dict[int, int] = {}  # h -> bit set of those ranks

    def push(self, rank: int, at: int) -> None:
        bucket = self.buckets.get(rank)
        if bucket:
            heapq.heappush(bucket, at)
            return
        self.buckets[rank] = [at]
        high = rank >> 8
        self.leaf[high] = self.leaf.get(high, 0) | 1 << (rank & 255)
        self.top |= 1 << high

    def pop(self) -> tuple[int, int] | None:
        if not self.top:
            return None
        high = (self.top & -self.top).bit_length() - 1
        bits = self.leaf[high]
        rank = high << 8 | (bits & -bits).bit_length() - 1
        bucket = self.buckets[rank]
        at = heapq.heappop(bucket)
        if not bucket:
            del self.buckets[rank]
            bits &= bits - 1
            if bits:
                self.leaf[high] = bits
            else:
                del self.leaf[high]
                self.top &= self.top - 1
        return rank, at


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the lowest-ranked neighbouring pair is joined until none is left."""
    n = len(piece)
    if n == 1 or piece in ranks:
        return [ranks[piece]]
    after = list(range(1, n + 1))  # end of the part that starts here = start of the next one
    before = list(range(-1, n - 1))
    pair: list[int | None] = [ranks.get(piece[i : i + 2]) for i in range(n)]
    pair[n - 1] = None
    queue = RankQueue()
    push, pop, get = queue.push, queue.pop, ranks.get
    for i, rank in enumerate(pair):
        if rank is not None:
            push(rank, i)
    while (found := pop()) is not None:
        rank, i = found
        if pair[i] != rank:
            continue  # stale: the pair here has changed
        gone = after[i]
        end = after[gone]
        after[i] = end
        pair[gone] = None
        if end < n:
            before[end] = i
            pair[i] = new = get(piece[i : after[end]])
            if new is not None:
                push(new, i)
        else:
            pair[i] = None
        left = before[i]
        if left >= 0:
            pair[left] = new = get(piece[left:end])
            if new is not None:
                push(new, left)
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i : after[i]]])
        i = after[i]
    return out


class PairTable:
    """Rank of the join of two ids, looked up for whole arrays."""

    def __init__(self, ranks: dict[bytes, int]):
        keys, values = [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        order = np.argsort(np.array(keys, np.int64))
        self.keys = np.append(np.array(keys, np.int64)[order], np.iinfo(np.int64).max)
        self.values = np.append(np.array(values, np.int64)[order], -1)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """-1 where the two do not join, or one of them is -1 (a border)."""
        key = left << 32 | right
        at = np.searchsorted(self.keys, key)
        return np.where((self.keys[at] == key) & (right >= 0), self.values[at], -1)


def merge_many(pieces: list[bytes], table: PairTable, bytes_to_ids: np.ndarray) -> list[bytes]:
    """``merge`` for many short pre-tokens at once, with one queue for all of them.

    Their parts lie in one linked list with a border between pre-tokens, over which nothing joins.
    Each step takes the lowest rank and joins its leftmost pair in every pre-token that has one;
    further pairs of that rank go back into the bucket, as a join may have made a lower rank
    beside them. Ids come as little-endian 32-bit bytes.
    """
    sizes = np.array([len(p) for p in pieces])
    slots = int(sizes.sum()) + len(pieces) + 1
    data = np.frombuffer(b"".join([b"\0" + p for p in pieces]) + b"\0", np.uint8)
    borders = np.append(np.concatenate([[0], np.cumsum(sizes + 1)[:-1]]), slots - 1)
    ids = bytes_to_ids[data].copy()
    ids[borders] = -1
    owner = np.repeat(np.arange(len(pieces) + 1), np.append(sizes + 1, 1))
    after = np.arange(1, slots + 1)
    before = np.arange(-1, slots - 1)
    pair = np.full(slots, -1)
    pair[:-1] = table(ids[:-1], ids[1:])

    buckets: dict[int, list[np.ndarray]] = {}
    leaf: dict[int, int] = {}
    top = 0

    def push(ranks: np.ndarray, spots: np.ndarray) -> None:
        nonlocal top
        keep = ranks >= 0
        ranks, spots = ranks[keep], spots[keep]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        ranks, spots = ranks[order], spots[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        starts = [0, *cuts.tolist()]
        for rank, start, end in zip(ranks[starts].tolist(), starts, [*starts[1:], len(ranks)]):
            bucket = buckets.get(rank)
            if bucket is None:
                buckets[rank] = [spots[start:end]]
                high = rank >> 8
                leaf[high] = leaf.get(high, 0) | 1 << (rank & 255)
                top |= 1 << high
            else:
                bucket.append(spots[start:end])

    push(pair, np.arange(slots))
    while top:
        high = (top & -top).bit_length() - 1
        bits = leaf[high]
        rank = high << 8 | (bits & -bits).bit_length() - 1
        found = buckets.pop(rank)
        leaf[high] = bits = bits & (bits - 1)
        if not bits:
            top &= top - 1
        spots = found[0] if len(found) == 1 else np.concatenate(found)
        spots = spots[pair[spots] == rank]  # the others are stale
        if len(spots) > 1:
            spots = np.unique(spots)
            whose = owner[spots]
            first = np.append(True, whose[1:] != whose[:-1])
            if not first.all():
                rest = spots[~first]
                push(np.full(len(rest), rank), rest)
                spots = spots[first]
        if not len(spots):
            continue
        gone = after[spots]
        end = after[gone]
        ids[spots] = rank
        after[spots] = end
        before[end] = spots
        pair[gone] = -1
        left = before[spots]
        both = np.concatenate([spots, left])
        new = table(ids[both], ids[np.concatenate([end, spots])])
        pair[both] = new
        push(new, both)
    # A slot that was joined to the part before it is skipped by the links of its neighbours.
    live = np.zeros(slots, bool)
    live[1:] = after[before[1:]] == np.arange(1, slots)
    live[borders] = False
    flat = ids[live].astype("<u4").tobytes()
    counts = np.bincount(owner[live], minlength=len(pieces))[: len(pieces)]
    ends = (4 * np.cumsum(counts)).tolist()
    return [flat[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class Encoder:
    """Text to ids (as little-endian 32-bit bytes) and back, for one file of ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.find = regex.compile(pattern).findall
        self.pieces: dict[str, bytes] = {}
        vocabulary = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            vocabulary[rank] = token
        self.joined = np.frombuffer(b"".join(vocabulary), np.uint8)
        self.sizes = np.array([len(t) for t in vocabulary])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.table = PairTable(self.ranks)
        self.bytes_to_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)

    def _merge(self, words: list[str]) -> dict[str, bytes]:
        """Ids of pre-tokens by their names; those of a token's own bytes need no merging."""
        out, short, coded = {}, [], []
        for word in words:
            piece = piece_of(word).encode()
            rank = self.ranks.get(piece)
            if rank is not None:
                out[word] = rank.to_bytes(4, "little")
            elif len(piece) > CACHED_CHARS:
                out[word] = np.array(merge(piece, self.ranks), dtype="<u4").tobytes()
            else:
                short.append(word)
                coded.append(piece)
        if short:
            out.update(zip(short, merge_many(coded, self.table, self.bytes_to_ids)))
        return out

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text. What is new to the cache is merged in one go.

        A pre-token is named like a piece, and most pieces are one, so both lie in one cache.
        """
        keys = [piece_keys(t) if t else [] for t in texts]
        held = [list(map(self.pieces.get, ks)) for ks in keys]
        fresh: set[str] = set()
        for ks, found in zip(keys, held):
            if not all(found):
                fresh.update(k for k, ids in zip(ks, found) if not ids)
        if not fresh:
            return [b"".join(found) for found in held]
        parts = {k: [key_of(w) for w in self.find(piece_of(k))] for k in fresh}
        more = self._merge(list({w for ws in parts.values() for w in ws} - self.pieces.keys()))
        words, known = self.pieces.get, more.get
        more.update([(k, b"".join([known(w) or words(w) for w in ws])) for k, ws in parts.items() if len(ws) != 1])
        out = [
            b"".join(found) if all(found) else b"".join([i or more[k] for k, i in zip(ks, found)])
            for ks, found in zip(keys, held)
        ]
        if len(self.pieces) + len(more) > CACHED_PIECES:
            self.pieces.clear()
        self.pieces.update((k, v) for k, v in more.items() if len(k) <= CACHED_CHARS)
        return out

    def decode_all(self, coded: list[bytes]) -> list[bytes]:
        """Bytes of every document: each id's bytes are copied from one joined vocabulary."""
        ids = np.frombuffer(b"".join(coded), "<u4")
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.starts[ids] - (ends - sizes), sizes)
        flat = self.joined[shift + np.arange(len(shift))].tobytes()
        cuts = np.append(0, ends)[np.cumsum([0] + [len(c) // 4 for c in coded])].tolist()
        return [flat[a:b] for a, b in zip(cuts, cuts[1:])]


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """One encoder per Python worker and file; its caches are kept from task to task."""
    return Encoder(path, pattern)


SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): ids of the whole text as little-endian 32-bit integers."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(path, pattern)
        ids = e.encode_all(batch["text"].to_pylist())
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(ids, pa.binary())], names=["doc_id", "ids"]
        )

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "text", SCHEMA, work, SLICE_BYTES)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, bytes) from (doc_id, ids)."""
    schema = T.StructType([SCHEMA[0], T.StructField("bytes", T.BinaryType())])

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(path, pattern)
        out = e.decode_all([i or b"" for i in batch["ids"].to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(out, pa.binary())], names=["doc_id", "bytes"]
        )

    return map_text(encoded.select("doc_id", "ids"), "ids", schema, work, SLICE_BYTES)


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoded and decoded in one pass.

    The ids and the decoded bytes of a document are hashed where they are made, so only 150 bytes
    per document leave the Python worker.
    """
    schema = T.StructType(
        [
            SCHEMA[0],
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
    )

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        e = encoder(path, pattern)
        ids = e.encode_all(batch["text"].to_pylist())
        sha = hashlib.sha256
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"],
                pa.array([len(i) // 4 for i in ids], pa.int64()),
                pa.array([sha(i).hexdigest() for i in ids], pa.string()),
                pa.array([sha(d).hexdigest() for d in e.decode_all(ids)], pa.string()),
            ],
            schema=pa.schema(
                [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
            ),
        )

    return map_text(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), "text", schema, work, SLICE_BYTES)

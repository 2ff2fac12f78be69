"""Source divergence audit: how far the term shares of each source stand from other sources and its language.

Terms are runs of letters and of characters beyond ASCII; a language keeps those of enough of its
documents. Each source gives every kept term a smoothed share p in billionths, and two shares differ
by f(p, q) = floor((p - q)^2 / (p + q)). All of it is whole numbers.

Sums over all kept terms for all pairs of sources are a product of sparse matrices, added up row by
row (Gustavson): a source goes through its terms, reads from the term-major index which peers have
each, and adds to a dense accumulator with a cell per peer. No pair of postings becomes a row. Cells
hold what differs from the baseline of a pair that has a term in neither source; with p0 the share of
a source without the term,

    sum f(p, q) = V f(p0, q0) + sum over terms of the one  [f(p, q0) - f(p0, q0)]
                              + sum over terms of the other [f(p0, q) - f(p0, q0)]
                              + sum over common terms       [f(p, q) - f(p, q0) - f(p0, q) + f(p0, q0)].

The index is cut into slices of terms of a language, and the sources into blocks, so that a task holds
a bounded number of entries and of accumulator cells; a slice sends on at most two rows per pair of
sources. So neither a language with most of the documents nor a word of every source makes a large
task.

Results for odd input: NULL text, language or source is read as ''; an empty text has no term; texts
of any length count in full, in pieces cut between terms; repeated rows count as documents of their
own; a source alone in its language has no ``pair`` row, and one without kept terms no ``term`` row;
doc_id is not read, so its NULLs and repeats make no difference; other columns are not read; an empty
table gives an empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.llm.common import Staged, slices

BILLION = 1_000_000_000


@dataclass(frozen=True)
class Settings:
    least_documents: int = 10
    top_terms: int = 10
    held_terms: int = 200_000  # distinct terms a task holds before it sends them on
    piece_bytes: int = 4_000_000  # of a text split into terms at once
    slice_postings: int = 20_000  # least entries of a slice; more where the pairs of sources are more
    most_postings: int = 2_000_000
    cells: int = 4_000_000  # accumulator cells that a task holds


# ---------------------------------------------------------------- terms
# Bytes of a term as they are (A-Z in lower case), all others as a blank.
LETTERS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256)
)
BREAK = re.compile(rb"[^A-Za-z\x80-\xff]")


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """The text in pieces of about ``most`` bytes, none cut inside a term."""
    at = 0
    while len(text) - at > most:
        found = BREAK.search(text, at + most)
        if found is None:
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:] if at else text


def count_terms(docs: DataFrame, s: Settings) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents; a group's row with term '' marks that it occurs."""
    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]

    def send(held):
        groups = [(lang, source, term, n, seen[term]) for (lang, source), (all_, seen) in held.items() for term, n in all_.items()]
        groups += [(lang, source, b"", 0, 0) for lang, source in held]
        lang, source, term, n, d = zip(*groups)
        terms = pa.array(term, pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays(
            [pa.array(lang), pa.array(source), terms, pa.array(n, pa.int64()), pa.array(d, pa.int64())],
            names=["lang", "source", "term", "n", "docs"],
        )

    def work(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}
        size = 0
        for whole in batches:
            for batch in slices(whole, "text") if whole.num_rows else ():
                texts = batch["text"].cast(pa.binary()).to_pylist()
                for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), texts):
                    every, seen = held.setdefault((lang, source), (Counter(), Counter()))
                    before, own = len(every), set()
                    for piece in pieces(text, s.piece_bytes):
                        words = piece.translate(LETTERS).split()
                        every.update(words)
                        own.update(words)
                    seen.update(own)
                    size += len(every) - before
                    if size > s.held_terms:
                        yield send(held)
                        held, size = {}, 0
        if held:
            yield send(held)

    parts = docs.select(columns).mapInArrow(work, "lang string, source string, term string, n long, docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---------------------------------------------------------------- shares and their difference
def quotient(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def share(count: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), in whole numbers too wide for a long."""
    above = (count + 2).cast("decimal(20,0)") * F.lit(BILLION).cast("decimal(10,0)")
    return F.lit(1) + quotient(above, (total + 2 * kept).cast("decimal(20,0)"))


def gap(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / (p + q)); shares are at most 10^9 + 1, so a long holds the square."""
    return quotient((p - q) * (p - q), p + q)


def gaps(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


# ---------------------------------------------------------------- row accumulation
def accumulate(terms: np.ndarray, rows: np.ndarray, p: np.ndarray, base: np.ndarray, own: np.ndarray) -> np.ndarray:
    """Sums above the baseline over one slice of postings: a row for each source of ``own``, a cell per peer.

    Posting i says that source ``rows[i]`` has term ``terms[i]`` with share ``p[i]``; ``base`` holds the
    share p0 of every source. What a source's terms add alone is in its own row for every peer; what
    common terms add is in the row of the source with the smaller number. So the sum for a pair is
    that of its two cells.
    """
    out = np.zeros((len(own), len(base)), np.int64)
    order = np.lexsort((rows, terms))  # the term-major index, sources rising
    terms, peers, held = terms[order], rows[order], p[order]
    end = np.searchsorted(terms, terms, side="right")  # of the term's postings
    by_source = np.argsort(peers, kind="stable")
    bounds = np.searchsorted(peers[by_source], np.arange(len(base) + 1))
    for acc, g in zip(out, own):
        mine = by_source[bounds[g] : bounds[g + 1]]
        shares, times = np.unique(held[mine], return_counts=True)  # equal shares are taken together
        step = max(1, 1_000_000 // len(base))
        for at in range(0, len(shares), step):
            some, often = shares[at : at + step, None], times[at : at + step, None]
            acc += ((gaps(some, base) - gaps(base[g], base)) * often).sum(axis=0)
        many = end[mine] - mine - 1  # peers with larger numbers that have the term, next in the index
        step = np.cumsum(many) // 1_000_000  # bounds what is read from the index at once
        for part in np.unique(step[many > 0]):
            at, n = mine[step == part], many[step == part]
            p_own = np.repeat(held[at], n)
            place = np.repeat(at + 1 - (np.cumsum(n) - n), n) + np.arange(len(p_own))
            other, p_other = peers[place], held[place]
            more = gaps(p_own, p_other) - gaps(p_own, base[other]) - gaps(base[g], p_other) + gaps(base[g], base[other])
            np.add.at(acc, other, more)
    return out


def pair_sums(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, g, h, value) for all pairs g < h of sources of a language, g and h being their numbers."""

    def places(upto: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(upto) - 1))

    left = postings.select(
        "lang", F.pmod("term_no", F.col("slices")).cast("int").alias("slice"), places("blocks").alias("block"), "term_no", "no", "p"
    )
    # new names, as the postings have been joined to the same table
    own = [F.col(c).alias(c) for c in ("lang", "no", "p0", "kept", "blocks")]
    right = groups.withColumn("slice", places("slices")).select("slice", places("blocks").alias("block"), *own)

    def add_up(key, some: pa.Table, sources: pa.Table) -> pa.Table:
        if not sources.num_rows:
            raise ValueError("postings of a language without sources")
        lang, piece, block = (k.as_py() for k in key)
        no = sources["no"].to_numpy()
        order = np.argsort(no)  # numbers run from 0 in each language
        base, kept, blocks = sources["p0"].to_numpy()[order], sources["kept"][0].as_py(), sources["blocks"][0].as_py()
        own = np.arange(block, len(base), blocks)
        out = accumulate(some["term_no"].to_numpy(), some["no"].to_numpy(), some["p"].to_numpy(), base, own)
        if piece == 0:
            for acc, g in zip(out, own):
                acc[g + 1 :] += kept * gaps(base[g], base[g + 1 :])
        g, h = np.repeat(own, len(base)), np.tile(np.arange(len(base)), len(own))
        other = g != h
        g, h = g[other], h[other]
        return pa.table(
            {
                "lang": pa.array([lang] * len(g), pa.string()),
                "g": pa.array(np.minimum(g, h), pa.int32()),
                "h": pa.array(np.maximum(g, h), pa.int32()),
                "value": out.ravel()[other],
            }
        )

    place = ["lang", "slice", "block"]
    sums = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(add_up, "lang string, g int, h int, value long")
    return sums.groupBy("lang", "g", "h").agg(F.sum("value").alias("value"))


# ---------------------------------------------------------------- the audit
def term_index(counts: DataFrame, s: Settings) -> DataFrame:
    """(lang, term, term_no, total, postings): the kept terms, each with the sources that have it."""
    each = counts.filter("term <> ''").groupBy("lang", "term")
    held = each.agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("postings")
    )
    return held.filter(F.col("docs") >= s.least_documents).drop("docs").withColumn("term_no", F.monotonically_increasing_id())


def source_table(counts: DataFrame, index: DataFrame, s: Settings) -> DataFrame:
    """One row per (lang, source): its number, totals and share of a term it lacks, and the cuts of its language."""
    by_lang = index.groupBy("lang").agg(
        F.count("*").alias("kept"), F.sum("total").alias("lang_total"), F.sum(F.size("postings")).alias("entries")
    )
    by_source = index.select("lang", F.inline("postings")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    number = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    n = F.col("n_sources")
    size = F.greatest(F.lit(s.slice_postings), F.least(n * n, F.lit(s.most_postings)))
    return (
        counts.filter("term = ''").select("lang", "source")
        .withColumn("no", number)
        .withColumn("n_sources", F.count("*").over(Window.partitionBy("lang")))
        .join(by_source, ["lang", "source"], "left")
        .join(by_lang, "lang", "left")
        .na.fill(0, ["kept", "total", "lang_total", "entries"])
        .withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0), F.col("total"), F.greatest("kept", F.lit(1)))).otherwise(F.lit(1)))
        .withColumn("slices", F.greatest(F.lit(1), F.ceil(F.col("entries") / size)).cast("int"))
        .withColumn("blocks", F.ceil(n * n / s.cells).cast("int"))
    )


def audit(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(lang, source, part, item, value, rank): every other source (``pair``) and the leading terms (``term``)."""
    counts = Staged(count_terms(docs, s), "term-counts")
    index = Staged(term_index(counts.df, s), "term-index").df
    groups = Staged(source_table(counts.df, index, s), "sources").df
    counts.drop()
    postings = (
        index.select("lang", "term", "term_no", F.col("total").alias("in_lang"), F.inline("postings"))
        .join(groups, ["lang", "source"])
        .withColumn("p", share(F.col("n"), F.col("total"), F.col("kept")))
    )

    sums = pair_sums(postings, groups)
    both = F.inline(F.array(F.struct(F.col("g").alias("no"), F.col("h").alias("other")), F.struct(F.col("h").alias("no"), F.col("g").alias("other"))))
    named = groups.select("lang", "no", "source")
    peers = named.select("lang", F.col("no").alias("other"), F.col("source").alias("item"))
    pairs = sums.select("lang", "value", both).join(named, ["lang", "no"]).join(peers, ["lang", "other"])

    q = share(F.col("in_lang"), F.col("lang_total"), F.col("kept"))
    terms = postings.withColumn("q", q).filter("p > q").select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item"))
    columns = ["lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")]
    ranked = pairs.withColumn("rank", F.row_number().over(order)).withColumn("part", F.lit("pair")).select(*columns)
    first = terms.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= s.top_terms)
    return ranked.union(first.withColumn("part", F.lit("term")).select(*columns))

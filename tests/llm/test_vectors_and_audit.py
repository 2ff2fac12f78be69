"""Whitening, exact search and the divergence audit against plain Python."""

import math
import random
import re
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus_fixture as fx  # noqa: E402

from braidlake.llm import divergence, va_file, whitening  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int, n int, q int, whitened string, slice int"
EXTRA = (1, 2, 3, "w", 4)


def vectors(n=400, d=12, seed=5):
    """Clustered vectors, copies of one of them, repeated rows, repeated ids and everything odd."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((6, d)) * 0.4
    data = (centres[rng.integers(0, 6, n)] + rng.standard_normal((n, d)) * np.linspace(0.05, 0.5, d)).astype(np.float32)
    data[n // 2 : n // 2 + n // 3] = data[0]  # a third are copies
    rows = [(i, [float(c) for c in v], *EXTRA) for i, v in enumerate(data)]
    rows += [rows[3], rows[50], (3, rows[4][1], *EXTRA), (None, rows[5][1], *EXTRA)]
    odd = [None, [], [1.0] * (d - 1), [None] * d, [float("nan")] * d, [float("inf")] + [0.0] * (d - 1), [1e30] + [0.0] * (d - 1)]
    rows += [(1000 + 50 * i, v, *EXTRA) for i, v in enumerate(odd)]
    rows += [(2000, [0.0] * d, *EXTRA)]
    random.Random(seed).shuffle(rows)
    return rows, d


def fine(rows, d, most=1e20):
    return [
        r for r in rows
        if r[1] is not None and len(r[1]) == d and all(c is not None and math.isfinite(c) and abs(c) <= most for c in r[1])
    ]


# ---- 11: whitening
def test_counts_are_those_of_the_spectrum():
    rng = np.random.default_rng(1)
    for d in (1, 2, 3, 9, 40):
        a = rng.standard_normal((d, d))
        a = a + a.T  # indefinite: needs pivots of two
        e = np.linalg.eigvalsh(a)
        for s in [*rng.uniform(e[0] - 1, e[-1] + 1, 30), (e[0] + e[-1]) / 2]:
            assert whitening.above(a, s) == (e > s).sum()
    hollow = np.array([[0.0, 1.0], [1.0, 0.0]])
    assert whitening.above(hollow, 0.0) == 1 and whitening.above(np.zeros((3, 3)), 0.0) == 0


@pytest.mark.parametrize("kind", ["spread", "close", "equal", "flat"])
def test_leading_components_of_any_spectrum(kind):
    rng = np.random.default_rng(2)
    d = 24
    e = {
        "spread": 2.0 ** -np.arange(d),
        "close": 1 + 1e-7 * np.arange(d)[::-1],
        "equal": np.r_[[5.0] * 4, [1.0] * 20],
        "flat": np.r_[[3.0, 2.0], np.zeros(d - 2)],
    }[kind]
    q, _ = np.linalg.qr(rng.standard_normal((d, d)))
    a = (q * e) @ q.T
    a = (a + a.T) / 2
    values, axes = whitening.leading(a, 8)
    assert len(values) == (2 if kind == "flat" else 8)
    assert np.allclose(values, np.sort(e)[::-1][: len(values)], rtol=1e-11)
    assert np.abs(axes @ axes.T - np.eye(len(values))).max() < 1e-12
    assert np.abs(a @ axes.T - axes.T * values).max() < 1e-12 * e.max()


def test_sums_are_exact_over_the_whole_range():
    rng = np.random.default_rng(3)
    for most in (5, 2**22, 2**50):
        y = rng.integers(-most, most, (300, 4))
        wide = y.astype(object)
        assert (whitening.products(y) == wide.T @ wide).all() and (whitening.column_sums(y) == wide.sum(axis=0)).all()
        rest = [int(x) for x in rng.integers(0, 300, 4)]
        assert whitening.deviations(y, 300, rest) == [sum((300 * int(a) - r) ** 2 for a, r in zip(v, rest)) for v in y]


def test_whitening_equals_plain_algebra(spark):
    rows, d = vectors()
    out = whitening.whiten(spark.createDataFrame(rows, VECTORS).repartition(5))
    some = fine(rows, d)
    x = np.floor(np.array([r[1] for r in some]) * 1024).astype(np.int64) + 100_000
    n = len(x)
    e, v = np.linalg.eigh(np.cov(x.T, bias=True))
    e, v = e[::-1], v[:, ::-1]
    white = (x - x.mean(axis=0)) @ v[:, :8] / np.sqrt(e[:8])
    exact = ((n * x.astype(object) - x.sum(axis=0)) ** 2).sum(axis=1)
    got = defaultdict(list)
    for r in out.collect():
        got[r["component"]].append(r)
        assert r["n"] == n and abs(r["identity_error"]) < 1e-9
        assert r["explained"] == pytest.approx(e[r["component"] - 1] / e.sum(), rel=1e-9)
    assert sorted(got) == list(range(1, 9))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], round(r[2], 6))
    for c, found in got.items():
        want = sorted(((r[0], int(a), float(w)) for r, a, w in zip(some, exact, white[:, c - 1])), key=key)
        here = sorted(((r["vec_id"], int(r["deviation"]), r["whitened"]) for r in found), key=key)
        back = sorted(((r["vec_id"], int(r["deviation"]), -r["whitened"]) for r in found), key=key)
        assert [h[:2] for h in here] == [w[:2] for w in want]
        near = lambda one: np.allclose([x[2] for x in one], [x[2] for x in want], atol=1e-8)
        assert near(here) or near(back)


def test_whitening_of_few_or_equal_vectors(spark):
    df = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert whitening.whiten(df([])).count() == 0
    assert whitening.whiten(df([(1, None)])).count() == 0
    assert whitening.whiten(df([(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    two = whitening.whiten(df([(1, [0.0, 0.0]), (2, [1.0, 0.0])])).collect()
    assert [(r["component"], abs(r["whitened"]), int(r["deviation"])) for r in two] == [(1, pytest.approx(1), 1024**2)] * 2
    wide = whitening.whiten(df([(1, [2.0**40, 1.0]), (2, [-(2.0**40), 0.0]), (3, [0.5, 0.25])])).collect()
    assert max(int(r["deviation"]) for r in wide) > 2**63 and {r["n"] for r in wide} == {3}


# ---- 12: exact search
def nearest(rows, d, every, k, scale=256):
    some = {(r[0], tuple(math.floor(scale * c) for c in r[1])) for r in fine(rows, d, va_file.LARGEST) if r[0] is not None}
    out = []
    for q in some:
        if q[0] % every == 0:
            scores = sorted((-sum(a * b for a, b in zip(q[1], p[1])), p[0]) for p in some if p != q)
            out += [(q[0], i + 1, p, -score) for i, (score, p) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize(
    "s",
    [
        va_file.Settings(),
        va_file.Settings(bits=1, first=6, slice_rows=60, slice_queries=7),  # coarse: most slices stay open
        va_file.Settings(bits=8, k=30, slice_rows=100),
    ],
)
def test_search_is_exact(spark, s):
    rows, d = vectors()
    df = spark.createDataFrame(rows, VECTORS).repartition(5)
    out = va_file.search(df, F.col("id") % 10 == 0, s)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in out.collect()) == nearest(rows, d, 10, s.k)


def test_search_with_few_vectors(spark):
    df = lambda rows: spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    asked = F.col("id") % 50 == 0
    assert va_file.search(df([]), asked).count() == 0
    assert va_file.search(df([(0, None), (50, [])]), asked).count() == 0
    assert va_file.search(df([(0, [1.0])]), asked).count() == 0
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (0, [0.0, 1.0]), (7, [0.5, 0.5]), (100, [-1.0, 0.0])]
    assert sorted(tuple(r) for r in va_file.search(df(rows), asked).collect()) == nearest(rows, 2, 50, 5)


def test_bounds_hold():
    rng = np.random.default_rng(4)
    for bits in (1, 3, 8):
        v, q = rng.integers(-300, 300, (200, 7)), rng.integers(-300, 300, (20, 7))
        low, high = v.min(axis=0), v.max(axis=0)
        grid = va_file.Grid(low, (high - low) // (1 << bits) + 1)
        middle, slack = grid.bounds(q, grid.cells(v).astype(np.int64))
        assert (np.abs(2 * (q @ v.T) - middle) <= slack[:, None]).all()


# ---- 13: divergence
TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def audit(rows, least, top):
    words = [(r[2] or "", r[3] or "", [t.translate(LOWER) for t in TERM.findall(r[1] or "")]) for r in rows]
    groups, seen, counts = defaultdict(set), defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in words:
        groups[lang].add(source)
        seen[lang].update(set(terms))
        counts[lang, source].update(terms)
        counts[lang, None].update(terms)
    out = []
    for lang, sources in groups.items():
        kept = [t for t, n in seen[lang].items() if n >= least]

        def shares(source):
            one = counts[lang, source]
            total = sum(one[t] for t in kept)
            return {t: 1 + 10**9 * (one[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(s) for s in [*sources, None]}
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], p[None][t])) for t in kept if counts[lang, s][t] and p[s][t] > p[None][t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(found[:most])]
    return sorted(out)


def audited():
    rng = random.Random(9)
    rows = fx.documents()
    for i in range(150):
        n = rng.choice([0, 3, 20, 60])
        text = " ".join(rng.choice(["The", "the", "of", "Été", "été", "漢字", "x1y", "don't", "naïve-ly", "w%d" % rng.randrange(30)]) for _ in range(n))
        source = "hot" if rng.random() < 0.4 else rng.choice(["a", "b", "ü", "z", None, ""])
        rows.append((i, text, rng.choice(["en", "en", "de", "xx", ""]), source, 0, "m", 1, "k", 1, *fx.MORE))
    rows.append((1, "alone", "only", "one", 0, "m", 1, "k", 1, *fx.MORE))
    return rows


@pytest.mark.parametrize(
    "s",
    [
        divergence.Settings(),
        divergence.Settings(least_documents=2, top_terms=3, held_terms=5, piece_bytes=40, slice_postings=7, cells=9),
        divergence.Settings(least_documents=10_000),
    ],
)
def test_audit_equals_plain_counts(spark, s):
    rows = audited()
    out = divergence.audit(spark.createDataFrame(rows, fx.SCHEMA).repartition(5), s)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    want = audit(rows, s.least_documents, s.top_terms)
    assert sorted(tuple(r) for r in out.collect()) == want and len(want) > 20


def test_audit_of_nothing(spark):
    assert divergence.audit(spark.createDataFrame([], fx.SCHEMA)).count() == 0
    rows = [(1, None, None, None, 0, "m", 1, "k", 1, *fx.MORE), (2, "", "", "s", 0, "m", 1, "k", 1, *fx.MORE)]
    out = divergence.audit(spark.createDataFrame(rows, fx.SCHEMA)).collect()
    assert sorted(tuple(r) for r in out) == [("", "", "pair", "s", 0, 1), ("", "s", "pair", "", 0, 1)]


def test_shares_beyond_a_long(spark):
    df = spark.createDataFrame([(10**13, 3 * 10**13, 10**6)], "n long, total long, kept long")
    p = df.select(divergence.share(F.col("n"), F.col("total"), F.col("kept")).alias("p")).first()["p"]
    assert p == 1 + 10**9 * (10**13 + 2) // (3 * 10**13 + 2 * 10**6)


def test_pieces_cut_between_terms():
    text = ("añb 漢字漢字 x-y " * 50).encode()
    for most in (1, 3, 17, 10_000):
        words = [w for p in divergence.pieces(text, most) for w in p.translate(divergence.LETTERS).split()]
        assert words == text.translate(divergence.LETTERS).split()

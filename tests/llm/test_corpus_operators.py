import hashlib
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import corpus_fixture as fx  # noqa: E402

from braidlake.llm import (  # noqa: E402
    ann_tree,
    bpe,
    common,
    debruijn,
    licenses,
    line_dedup,
    minhash,
    mixing,
    quality,
    token_files,
    url_filter,
)

public_tokenizers = pytest.importorskip("public_tokenizers")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
ROWS = fx.documents()


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "d")
    spark.createDataFrame(ROWS, fx.SCHEMA).repartition(5).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], fx.SCHEMA)


def got(df, *cols):
    return sorted([tuple(r) for r in df.select(*cols).collect()], key=fx.key)


# ---- 1 and 8: tokens
def test_token_files_read_back_what_the_library_encodes(docs, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(JSON)
    ids = [(r[0], t.encode(r[1] or "", add_special_tokens=False).ids + [2]) for r in ROWS]
    out = token_files.round_trip(docs, JSON, 2).collect()
    assert sorted([(r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out], key=fx.key) == sorted(
        [(d, len(i), zlib.crc32(np.array(i, "<u4").tobytes())) for d, i in ids], key=fx.key
    )
    ordered = sorted(out, key=lambda r: r["start"])
    at = 0
    for r in ordered:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in ordered] == sorted([r[0] for r in ROWS], key=lambda x: (x is not None, x))
    assert token_files.round_trip(empty, JSON, 2).count() == 0


def test_added_tokens_are_read_as_the_library_reads_them():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(JSON), token_files.TextEncoder(JSON)
    assert e.added and e.by_pieces
    rng = random.Random(5)
    texts = ["".join(rng.choice(["a", " ", "b c", *e.added, "\n", "é", ". "]) for _ in range(rng.randint(0, 12))) for _ in range(400)]
    texts += [f"a {e.added[0]} b", e.added[0], f" {e.added[0]}", None]
    for text, ids in zip(texts, e.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == t.encode(text or "", add_special_tokens=False).ids, text


def test_lines_are_cut_apart_and_blanks_read_as_the_library_reads_them():
    from tokenizers import Tokenizer

    t, e = Tokenizer.from_file(JSON), token_files.TextEncoder(JSON)
    rng = random.Random(7)
    parts = ["a", "bc.", "don't", " ", " ", "\n", "\n", "\t", "\r", "\x1c", "\x85", "\u3000", "漢", "12", "!?", "’"]
    texts = [["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(3)] for _ in range(1500)]
    for some in texts:
        for text, ids in zip(some, e.encode_all(some)):
            assert np.frombuffer(ids, "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text
    e.pieces.clear()
    e.encode_all([f"line {i}.\nnext line" for i in range(50)])
    assert not [k for k in e.pieces if "\n" in k[1:]]  # no piece joins the words on both sides of a line's end


def test_bpe_holds_a_word_once():
    e = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    words = ["word" + "".join(chr(97 + i // 26**k % 26) for k in range(3)) for i in range(3000)]
    e.encode_all([" ".join(words)])
    caches = [c for c in vars(e).values() if isinstance(c, dict) and c is not e.ranks]
    assert sum(map(len, caches)) <= len(words)


def test_coding_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 3, 4, 5, 1000):
        values = (2 ** rng.uniform(0, 32, n)).astype("<u4")
        assert (token_files.unpack(*token_files.pack(values), n) == values).all()


def test_bpe_equals_tiktoken(docs, empty):
    import tiktoken

    e = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    want = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=e.ranks, special_tokens={})
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  \n\té漢'st1!\x1c\x85<|endoftext|>") for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += ["ab" * 5000, "a" * 5000, "aaab" * 12]
    for text, ids in zip(texts, e.encode_all(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == want.encode_ordinary(text)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    rows = []
    for r in ROWS:
        ids = want.encode_ordinary(r[1] or "")
        rows.append((r[0], len(ids), sha(np.array(ids, "<u4").tobytes()), sha((r[1] or "").encode())))
    assert got(bpe.digests(docs, RANKS, public_tokenizers.PATTERN), "*") == sorted(rows, key=fx.key)
    back = bpe.decode(bpe.encode(docs, RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert sorted((r["doc_id"] is not None, bytes(r["bytes"])) for r in back.collect()) == sorted(
        (r[0] is not None, (r[1] or "").encode()) for r in ROWS
    )
    assert bpe.digests(empty, RANKS, public_tokenizers.PATTERN).count() == 0


def test_one_piece_and_many_pieces_merge_alike():
    e = bpe.Encoder(RANKS, public_tokenizers.PATTERN)
    rng = random.Random(4)
    pieces = ["".join(rng.choice("thaneri") for _ in range(rng.randint(2, 30))).encode() for _ in range(400)]
    many = bpe.merge_many(pieces, e.table, e.bytes_to_ids)
    for p, ids in zip(pieces, many):
        if p not in e.ranks:
            assert np.frombuffer(ids, "<u4").tolist() == bpe.merge(p, e.ranks)


# ---- 2: quality
def test_quality_counts_and_guards(docs, empty):
    rules = quality.Rules(min_reference_words=500)
    refs = quality.references(docs, rules)
    out = quality.judge(docs, refs, rules)
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert got(out, "doc_id", *cols) == sorted([(r[0], *fx.base_counts(r[1])) for r in ROWS], key=fx.key)
    short = out.filter("n_words < 50 and word_distance is not null").count()
    assert short == 0 and out.filter("base_failed and kept").count() == 0
    kept = quality.keep(docs, refs, rules)
    assert kept.columns == docs.columns
    assert got(kept, "doc_id") == got(out.filter("kept"), "doc_id")
    assert quality.references(empty) == {} and quality.judge(empty, {}).count() == 0


def test_distance_is_a_distance():
    p, q = np.array([0.5, 0.5, 0.0]), np.array([0.0, 0.0, 1.0])
    assert quality.distance(p, p) == 0 and quality.distance(p, q) == pytest.approx(1)
    assert quality.distance(p, q) == quality.distance(q, p)


# ---- 3: lines
def test_line_dedup_equals_brute_force(docs, empty):
    out = line_dedup.dedup(docs)
    assert got(out, "doc_id", "text") == sorted(fx.lines_kept(ROWS), key=fx.key)
    assert set(docs.columns) < set(out.columns) and {"n_lines_", "n_removed"} <= set(out.columns)
    assert line_dedup.dedup(empty).count() == 0


def test_lines_that_share_a_hash_are_told_apart(spark, docs):
    """With a first hash of two bits every line clashes: equal lines go, different ones never do by it."""
    out = {(r["doc_id"], r["n_chars"]): r["text"] for r in line_dedup.dedup(docs, line_dedup.Settings(node_bits=2)).collect()}
    equal = fx.lines_kept(ROWS, alike=1.0)
    for (doc, text), row in zip(equal, ROWS):
        mine = out[doc, row[4]]
        if text is None:
            assert mine is None
        else:
            lost = Counter(text.split("\n")) - Counter(mine.split("\n"))
            fuzzy = dict(fx.lines_kept(ROWS)).get(doc)
            assert not lost - (Counter(text.split("\n")) - Counter((fuzzy or "").split("\n"))), doc


def test_short_lines_and_single_words(spark):
    rows = [(1, "Read more\nalpha beta gamma delta epsilon zeta eta theta"), (2, "Read more\n \nother"), (3, "Read more\n\nok\n \nok")]
    rows += [(4, "alpha beta gamma delta epsilon zeta eta thetas")]
    out = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "doc_id", "text", "n_removed") == [
        (1, rows[0][1], 0), (2, " \nother", 1), (3, "\nok\n ", 2), (4, "", 1),
    ]


def test_long_lines_and_scripts_without_spaces(spark):
    han = "".join(chr(0x4E00 + i) for i in range(300))
    rows = [(1, han, "en"), (2, han[:150] + "x" + han[151:], "en"), (3, "z" * 50_000, "en"), (4, "z" * 50_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = line_dedup.dedup(df)
    assert got(out, "doc_id", "n_removed") == [(1, 0), (2, 1), (3, 0), (4, 1)]


def test_lines_with_few_breaks_meet(spark):
    rng = random.Random(8)
    rows = []
    for i in range(0, 40, 2):
        runs = ["".join(chr(rng.randrange(0x4E00, 0x9FA5)) for _ in range(23)) for _ in range(10)]
        rows.append((i, ",".join(runs)))
        rows.append((i + 1, ",".join(runs[:5]) + "x" + ",".join(runs[5:])))
    out = line_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got(out, "doc_id", "text") == sorted(fx.lines_kept(rows), key=fx.key)
    assert got(out, "n_removed") == [(0,)] * 20 + [(1,)] * 20


def test_shingles_are_read_by_position_and_not_by_search(spark):
    texts = ["short", "eightlet", "ninelette", "\U0001F600" * 9 + "\u6f22\u5b57", "abcdefgh" * 400, "x" * 5000]
    lines = spark.createDataFrame(list(enumerate(texts)), "node long, line string")
    each = line_dedup.each_shingle(lines, 8)
    assert "regexp" not in each._jdf.queryExecution().executedPlan().toString()
    rows = each.groupBy("node").agg(F.sort_array(F.collect_list("h")).alias("hs"))
    arrays = lines.select("node", F.sort_array(line_dedup.shingles(F.col("line"), 8)).alias("hs"))
    assert rows.exceptAll(arrays).count() == arrays.exceptAll(rows).count() == 0
    want = [(i, max(1, len(t) - 7), len({t[k : k + 8] for k in range(max(1, len(t) - 7))})) for i, t in enumerate(texts)]
    assert got(rows.select("node", F.size("hs").alias("n"), F.size(F.array_distinct("hs")).alias("d")), "node", "n", "d") == want


def test_buckets_of_the_same_nodes_are_one(spark):
    buckets = {10: [1, 2], 11: [2, 1], 12: [1, 2, 3], 13: [3, 2, 1], 14: [2, 3], 15: [1, 3]}
    rows = [(node, key) for key, nodes in buckets.items() for node in nodes]
    left = line_dedup.unlike_buckets(spark.createDataFrame(rows, "node long, key long"))
    assert got(left, "key", "node") == [(10, 1), (10, 2), (12, 1), (12, 2), (12, 3), (14, 2), (14, 3), (15, 1), (15, 3)]


# ---- 4: neighbours
def test_tree_search_recall_and_odd_vectors(spark):
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(20, 16))
    data = (centers[rng.integers(0, 20, 1500)] + 0.6 * rng.normal(size=(1500, 16))).astype(np.float32)
    data[100:400] = data[100]  # many equal vectors
    frame = pd.DataFrame({"vec_id": np.arange(1500), "embedding": list(data)})
    odd = [(5000, None), (5020, [0.0] * 16), (5040, [float("nan")] * 16), (5060, [None] + [1.0] * 15), (5080, [1.0])]
    df = spark.createDataFrame(
        [(int(i), [float(x) for x in v]) for i, v in zip(frame["vec_id"], frame["embedding"])] + odd,
        "vec_id long, embedding array<float>",
    )
    s = ann_tree.Settings(sample_rows=800, leaf_rows=40, slice_rows=64)
    out = ann_tree.search(df, F.col("id") % 20 == 0, s).toPandas()
    want = ann_tree.brute_force(frame, 20, 20)
    assert len(out) == len(want) and set(out["query_id"]) == set(want["query_id"])
    merged = out.merge(want, on=["query_id", "vec_id"], suffixes=("", "_w"))
    assert len(merged) / len(want) >= 0.9
    assert np.allclose(merged["score"], merged["score_w"], rtol=0, atol=1e-9)
    one = out[out["query_id"] == 120].sort_values("rank")
    assert (one["score"].diff().dropna() <= 0).all() and 120 not in set(one["vec_id"])
    few = ann_tree.search(df.filter("vec_id < 5"), F.col("id") % 20 == 0, s)
    assert few.count() == 4
    assert ann_tree.search(df.filter("vec_id < 0"), F.col("id") % 20 == 0, s).count() == 0


# ---- 5: near duplicates
@pytest.mark.parametrize("width", [4, 5])
def test_near_duplicates_equal_brute_force(docs, width):
    counts, roots = fx.near_components(ROWS, width)
    want = [(r[0], n, c, r[0] == c) for r, n, c in zip(ROWS, counts, roots)]
    out = minhash.near_duplicates(docs, minhash.Settings(words=width))
    assert got(out, "doc_id", "n_shingles", "component_id", "kept") == sorted(want, key=fx.key)


def test_one_document_of_each_group_stays(docs, empty):
    _, roots = fx.near_components(ROWS, 5)
    out = minhash.keep_one(docs)
    assert out.columns == docs.columns
    want = {r[0] for r, c in zip(ROWS, roots) if r[0] is not None and r[0] == c}
    ids = [r["doc_id"] for r in out.select("doc_id").collect()]
    assert set(ids) == want and len(ids) == len(want)  # the repeated row comes once
    assert minhash.near_duplicates(empty).count() == 0 and minhash.keep_one(empty).count() == 0


def test_sketch_estimates_and_fills():
    rng = np.random.default_rng(6)
    seeds = minhash.round_seeds(320)
    for n in (1, 2, 7, 500):
        x = rng.integers(0, 2**63, n).astype(np.uint64)
        assert (minhash.sketch(x, 160, seeds) != minhash.EMPTY).all()
    errors = []
    for _ in range(40):
        x = rng.integers(0, 2**63, 900).astype(np.uint64)
        a, b = x[:800], x[100:]  # similarity 7/9
        errors.append((minhash.sketch(a, 160, seeds) == minhash.sketch(b, 160, seeds)).mean() - 7 / 9)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    found = common.components(spark.createDataFrame(edges, "a long, b long")).df.collect()
    assert {r["node"]: r["root"] for r in found} == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


# ---- 6: repeats
def test_repeats_equal_brute_force(docs, empty):
    out = debruijn.remove(docs)
    want = fx.repeats_removed(ROWS)
    assert got(out, "doc_id", "n_words", "n_removed", "kept") == sorted(want, key=fx.key)
    assert sum(r[2] for r in want) > 200
    assert debruijn.remove(empty).count() == 0


def test_a_passage_twice_in_one_document(spark):
    rng = random.Random(7)
    text = lambda n: ["w%d" % rng.randrange(10**9) for _ in range(n)]
    rows = []
    for i in range(0, 20, 2):
        passage = text(55)
        x = text(40) + passage + text(40)
        rows.append((i, " ".join(text(30) + passage + text(30))))
        rows.append((i + 1, " ".join(text(10) + x + text(60) + x + text(10))))
    out = debruijn.remove(spark.createDataFrame(rows, "doc_id long, text string"))
    want = fx.repeats_removed(rows)
    assert got(out, "doc_id", "n_words", "n_removed", "kept") == sorted(want, key=fx.key)
    assert [r[2] for r in want] == [0, 110] * 10


# ---- 7: URLs
def test_url_rules_and_list(spark):
    rows = [
        (1, "http://A.Example.org/es/x"), (2, "http://x.org/es/"), (3, "https://example.org/en/17?q=1"),
        (4, "no scheme"), (5, None), (6, "http://b.com/de/1#f"), (7, "http://notexample.orgx/es/"),
        (8, "http://www.Bad.net:80/p/?utm_source=a"), (9, "http://bad.net/p"), (10, "http://good.net/p"), (10, "http://good.net/p"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    listed = spark.createDataFrame([("https://bad.net/p/",), ("https://bad.net/p",), (None,)], "url string")
    rule_list = url_filter.rules("allow org/", "block example.org/es/", "block example.org/en/1", "allow com/fr/", "block com/de/")
    out = url_filter.judge(pages, rule_list, listed)
    assert got(out, "page_id", "host", "path", "rule", "verdict") == sorted(
        [
            (1, "a.example.org", "/es/x", "example.org/es/", "block"), (2, "x.org", "/es/", "org/", "allow"),
            (3, "example.org", "/en/17", "example.org/en/1", "block"), (4, "", "", None, "allow"),
            (5, "", "", None, "allow"), (6, "b.com", "/de/1", "com/de/", "block"),
            (7, "notexample.orgx", "/es/", None, "allow"), (8, "www.bad.net:80", "/p/", None, "block"),
            (9, "bad.net", "/p", None, "block"), (10, "good.net", "/p", None, "allow"), (10, "good.net", "/p", None, "allow"),
        ],
        key=fx.key,
    )
    assert url_filter.judge(pages, rule_list, listed.limit(0)).filter("listed").count() == 0
    assert url_filter.judge(pages.limit(0), rule_list, listed).count() == 0


def test_block_list_spells_addresses_otherwise(spark):
    from braidlake.llm.queries import block_list

    urls = ["http://a.com", "https://WWW.b.org/x/", "http://c.net/p?q=1#f", "http://d.io/#t", "no scheme", None, "http://e.fr:80/i?utm_a=1"]
    pages = spark.createDataFrame([(u,) for u in urls], "url string")
    listed = block_list(pages).select("url", url_filter.canonical(F.col("url")).alias("c")).collect()
    own = {r["c"] for r in pages.select(url_filter.canonical(F.col("url")).alias("c")).collect()}
    half = [u for u in urls if u and hashlib.md5(u.encode()).hexdigest()[0] < "8"]
    assert len(listed) == len(half) + len(urls) and half
    known = [r for r in listed if "nowhere" not in (r["url"] or "")]
    assert {r["c"] for r in known} <= own and not ({r["url"] for r in known} - {None, "no scheme"}) & set(urls)
    assert not {r["c"] for r in listed if "nowhere" in (r["url"] or "")} & own


def test_bloom_filter_lets_few_others_through(spark):
    keys = spark.range(4000).selectExpr("concat('k', id) AS k")
    blocks = url_filter.blocks_for(4000)
    bits = url_filter.bloom(keys, "k", blocks)
    others = spark.range(20000).selectExpr("concat('other', id) AS k")
    held = url_filter._block(F.col("k"), blocks) == F.col("block")
    for w in range(url_filter.WORDS):
        held = held & (F.getbit(F.col(f"w{w}"), url_filter._bit(F.col("k"), w)) == 1)
    assert others.join(bits, held, "left_semi").count() < 100  # under half a percent


def test_bloom_filter_loses_no_key(spark):
    keys = spark.range(3000).selectExpr("concat('k', id) AS k")
    bits = url_filter.bloom(keys, "k", 8)  # far too small: nearly everything passes, no key is lost
    held = url_filter._block(F.col("k"), 8) == F.col("block")
    for w in range(url_filter.WORDS):
        held = held & (F.getbit(F.col(f"w{w}"), url_filter._bit(F.col("k"), w)) == 1)
    assert keys.join(bits, held, "left_semi").count() == 3000 and bits.count() == 8


# ---- 9: mixing
def test_mixing_follows_the_rates(spark, empty):
    docs = spark.range(4000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 4 = 0 THEN 'a' WHEN id % 4 = 1 THEN NULL ELSE 'b' END AS source", "'t' AS text", "1 AS copy"
    )
    rates = spark.createDataFrame([("a", 2.5), (None, 40.0), ("b", 0.0)], "source string, rate double")
    out = mixing.mix(docs, rates, seed=1).groupBy("source").agg(
        F.count("*").alias("n"), F.countDistinct("doc_id", "copy_").alias("pairs"), F.max("n_copies").alias("most")
    )
    found = {r["source"]: r for r in out.collect()}
    assert set(found) == {"a", None}
    assert abs(found["a"]["n"] / 1000 - 2.5) < 0.2 and abs(found[None]["n"] / 1000 - 40) < 1
    assert found["a"]["pairs"] == found["a"]["n"] and found["a"]["most"] > 5
    assert mixing.mix(empty, mixing.rates(empty, F.length("text")), 1).count() == 0


def test_mixing_shuffles_texts_once_and_draws_once(spark, docs):
    out = mixing.mix(docs, mixing.rates(docs, F.length("text")), 1)
    assert set(docs.columns) < set(out.columns)
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("aggregate(sequence") == 1
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in plan


def test_poisson_counts_have_the_right_shape(spark):
    docs = spark.range(20000).selectExpr("id AS doc_id", "'a' AS source")
    rates = spark.createDataFrame([("a", 1.0)], "source string, rate double")
    counts = Counter(r["n_copies"] for r in mixing.mix(docs, rates, 3).select("doc_id", "n_copies").distinct().collect())
    for k, share in ((1, 0.3679), (2, 0.1839), (3, 0.0613)):
        assert abs(counts[k] / 20000 - share) < 0.012


def test_rates_reach_the_target_shares(docs):
    rates = {r["source"]: r["rate"] for r in mixing.rates(docs, F.length("text")).collect()}
    sizes = Counter()
    for r in ROWS:
        sizes[r[3]] += len(r[1] or "")
    whole, weights = sum(sizes.values()), sum(n**0.5 for n in sizes.values())
    for source, n in sizes.items():
        assert rates[source] == pytest.approx(n**0.5 / weights * whole / n)


def test_branchwise_minima_are_those_of_all_constants_and_few_a_shingle(spark):
    s = line_dedup.Settings()
    inner, pairs = line_dedup.branched(s.bands * s.rows)
    assert len(inner) == 9 and len({t ^ inner[j] for t, j in pairs}) == s.bands * s.rows
    rows = [(n, "".join(chr(97 + (i * i + n) % (3 + n % 20)) for i in range(8 + n))) for n in range(80)]
    lines = spark.createDataFrame(rows, "node long, line string")
    hashes = line_dedup.each_shingle(lines, s.chars).groupBy("node").agg(F.collect_list("h").alias("hs")).collect()
    least = [[r["node"]] + [min(h ^ t ^ inner[j] for h in r["hs"]) for t, j in pairs] for r in hashes]
    least = spark.createDataFrame(least, "node long, " + ", ".join(f"m{i} long" for i in range(len(pairs))))
    keys = [F.xxhash64(F.lit(b), *[f"m{i}" for i in range(b * s.rows, (b + 1) * s.rows)]) for b in range(s.bands)]
    want = least.select("node", F.array_distinct(F.array(*keys)).alias("bands"))
    assert line_dedup.bands(lines, s).exceptAll(want).count() == 0
    assert want.count() == len(rows)


# ---- 10: licenses
def test_license_windows_without_a_template_pair_are_not_sketched(spark):
    s = licenses.Settings()
    notice = licenses.NOTICES["MIT"]
    rows = [(0, "one two three " * 50), (1, "one two three " * 50 + notice + " four five six" * 50), (2, None), (3, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = licenses.templates(spark, {"MIT": notice}, s)[0].select(F.col("shingles").alias("known"))
    text = F.col("text")
    both = df.join(known).select(
        "doc_id", licenses.sketched(text, s).alias("w"), licenses.sketched(text, s, F.col("known")).alias("x")
    )
    kept = {r["doc_id"]: (r["w"], r["x"]) for r in both.collect()}
    assert [len(kept[i][1]["first"]) if kept[i][1] and kept[i][1]["first"] else 0 for i in (0, 2, 3)] == [0, 0, 0]
    w, x = kept[1]
    assert 0 < len(x["first"]) < 6 < len(w["first"]) and set(x["keys"]) <= set(w["keys"])


def test_license_notices_are_found(spark, empty):
    filler = "thand ering onst ble tion " * 20
    texts = [(i, f"{filler}\n{n}\n{filler}") for i, n in enumerate(licenses.NOTICES.values())]
    odd = [(90, None), (91, ""), (92, "?!"), (93, "mit"), (94, filler), (95, "Released under the MIT License"), (95, "Released under the MIT License")]
    odd += [(96, filler * 400 + "licensed UNDER the apache-license, version 2.0 " + filler)]
    df = spark.createDataFrame(texts + odd, "doc_id long, text string")
    out = licenses.scan(df)
    want = [(i, name) for i, name in enumerate(licenses.NOTICES)] + [(95, "MIT"), (96, "Apache-2.0")]
    found = got(out, "doc_id", "license")
    assert set(found) - set(want) == set() and set(want) - set(found) == set() and len(found) == len(want)
    assert out.filter("containment < 0.92").count() == 0
    assert licenses.scan(empty).count() == 0

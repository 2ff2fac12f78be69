"""Near-duplicate lines by MinHash over the whole corpus, in built-in functions only.

Two lines are linked if the Jaccard similarity of their character shingles (every run of ``chars``
characters; a shorter line is its own shingle) is at least ``alike``. The signature of a line has
the minima of all its shingles' hashes, each under an exclusive-or with a constant of its own, so the chance of
a common minimum is the similarity itself: with 18 bands of 4 a pair at 0.8 is missed with
probability (1 - 0.8^4)^18 = 7.6e-5. Minima are taken branch by branch of the hashes' top bits, see ``branched``.
Each distinct line is sketched once. All shingles decide in the end.

Equal lines are one class from the start, told apart by two 64-bit hashes; of different lines that share
the first hash by chance only those with the smaller second one are compared with others. Links become
components by ``components``; of each component the line with the smallest (doc_id, text hash, line number) stays.

Every line with a word takes part: one that is shorter than a shingle is like its equals only. Lines
without a word stay, since layout repeats by nature.

Results for odd input: NULL and empty texts come back as they are; texts and lines of any length count
in full; repeated rows keep and lose the same lines; NULL doc_ids come first in the order; other
columns are carried along, and the counts get underscores where their names are taken; an empty
table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braidlake.llm.common import OUTLINE_WORDS, Staged, bind, connect, free_name, possible_hits, release

SPACE = " \t\n\x0b\f\r"
BRANCH_BITS = 3


@dataclass(frozen=True)
class Settings:
    chars: int = 8
    alike: float = 0.8
    bands: int = 18
    rows: int = 4
    pivot_rounds: int = 2
    node_bits: int = 64  # of the first hash; fewer in tests


def constants(n: int) -> list[int]:
    """Signed 64-bit constants, one for each permutation (splitmix64 of 1, 2, ...)."""
    out = []
    for i in range(1, n + 1):
        z = i * 0x9E3779B97F4A7C15 % 2**64
        z = (z ^ z >> 30) * 0xBF58476D1CE4E5B9 % 2**64
        z = (z ^ z >> 27) * 0x94D049BB133111EB % 2**64
        z ^= z >> 31
        out.append(z - 2**64 if z >= 2**63 else z)
    return out


def spelled(line: Column) -> Column:
    """A line with four bytes a character, so that a shingle is read by position at no search."""
    return F.encode(line, "UTF-32")


def starts(wide: Column, chars: int) -> Column:
    """Where the shingles of a ``spelled`` line start; a shorter line is its own shingle."""
    return F.sequence(F.lit(1), F.greatest(F.length(wide) - 4 * chars + 1, F.lit(1)), F.lit(4))


def each_shingle(lines: DataFrame, chars: int) -> DataFrame:
    """(node, h): a hash of every shingle of (node, line), repeated ones included.

    Shingles are rows, which is compiled code, where array functions are interpreted.
    """
    rows = lines.select("node", spelled(F.col("line")).alias("wide"))
    rows = rows.select("node", "wide", F.explode(starts(F.col("wide"), chars)).alias("at"))
    return rows.select("node", F.xxhash64(F.substr("wide", F.col("at"), F.lit(4 * chars))).alias("h"))


def shingles(line: Column, chars: int) -> Column:
    """Hashes of all shingles of a line, repeated ones included."""
    return bind(spelled(line), lambda w: F.transform(starts(w, chars), lambda at: F.xxhash64(F.substr(w, at, F.lit(4 * chars)))))


def branched(n: int) -> tuple[list[int], list[tuple[int, int]]]:
    """A few constants d, and ``n`` pairs (t, j) of which each t XOR d[j] is a permutation's constant.

    The t differ in the top bits only. The minimum under t XOR d lies in one branch of hashes with equal
    top bits, and t does not reorder a branch, so minima under the few d within every branch give those
    under all n. The d differ in their next four bits, which pick other hashes of a branch. The pairs are
    shuffled, so that bands of a short line, whose branches hold one hash or none, combine different ones.
    """
    below, few = 60 - BRANCH_BITS, -(-n >> BRANCH_BITS)
    drawn = constants(100 + (few << BRANCH_BITS))
    inner = [(j * 7 % 16) << below | drawn[j] % (1 << below) for j in range(few)]
    top = [t << 64 - BRANCH_BITS for t in range(1 << BRANCH_BITS)]
    pairs = [(t - 2**64 if t >= 2**63 else t, j) for j in range(few) for t in top]
    return inner, [pairs[i] for i in sorted(range(len(pairs)), key=drawn[100:].__getitem__)][:n]


def bands(lines: DataFrame, s: Settings) -> DataFrame:
    """(node, bands): the band keys of every distinct (node, line), lines dealt by node before.

    Every shingle meets the constants of its branch only; see ``branched``.
    """
    inner, pairs = branched(s.bands * s.rows)
    each = each_shingle(lines, s.chars).withColumn("branch", F.shiftrightunsigned("h", 64 - BRANCH_BITS))
    inside = each.groupBy("node", "branch").agg(
        *[F.min(F.col("h").bitwiseXOR(F.lit(d))).alias(f"w{j}") for j, d in enumerate(inner)]
    )
    least = inside.groupBy("node").agg(
        *[F.min(F.col(f"w{j}").bitwiseXOR(F.lit(t))).alias(f"m{i}") for i, (t, j) in enumerate(pairs)]
    )
    keys = [F.xxhash64(F.lit(b), *[f"m{i}" for i in range(b * s.rows, (b + 1) * s.rows)]) for b in range(s.bands)]
    return least.select("node", F.array_distinct(F.array(*keys)).alias("bands"))


def outlined(nodes: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(node, bits): a bit per shingle of every node's line.

    A shingle meets the words of its group only.
    """
    each = each_shingle(texts.join(nodes, "node", "left_semi").select("node", "line"), s.chars)
    word, bit = F.pmod(F.shiftright("h", 6), F.lit(OUTLINE_WORDS)), F.expr("shiftleft(1L, cast(h & 63 as int))")
    each = each.select("node", F.shiftright(word, 3).alias("group"), word.bitwiseAND(F.lit(7)).alias("word"), bit.alias("bit"))
    groups = each.groupBy("node", "group").agg(*[F.bit_or(F.when(F.col("word") == i, F.col("bit"))).alias(f"b{i}") for i in range(8)])
    words = groups.groupBy("node").agg(
        *[F.coalesce(F.max(F.when(F.col("group") == i // 8, F.col(f"b{i % 8}"))), F.lit(0).cast("long")).alias(f"b{i}") for i in range(OUTLINE_WORDS)]
    )
    return words.select("node", F.array(*[f"b{i}" for i in range(OUTLINE_WORDS)]).alias("bits"))


def hashed(line: Column, s: Settings) -> tuple[Column, Column]:
    """The two hashes of a line."""
    first = F.xxhash64(line)
    if s.node_bits < 64:
        first = F.pmod(first, F.lit(1 << s.node_bits))
    return first, F.xxhash64(F.lit("second"), line)


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, no, line) of every line with a word."""
    text = F.col("text").cast("string")
    return (
        docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("mark"), F.posexplode(F.split(text, "\n")).alias("no", "line"))
        .filter(F.btrim("line", F.lit(SPACE)) != "")
    )


def verify(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b, linked, far) from all shingles of both lines."""
    one, other = (texts.select(F.col("node").alias(x), F.col("line").alias(f"l{x}"), F.col("n").alias(f"n{x}")) for x in "ab")
    both = pairs.join(other, "b").join(one, "a")
    common = F.size(F.array_intersect(shingles(F.col("la"), s.chars), shingles(F.col("lb"), s.chars)))
    like = bind(common, lambda c: c / (F.col("na") + F.col("nb") - c))
    judged = bind(like, lambda j: F.struct((j >= s.alike).alias("linked"), (1 - j).alias("far")))
    return both.select("a", "b", F.inline(F.array(judged)))


def unlike_buckets(members: DataFrame) -> DataFrame:
    """(node, key) without the buckets that hold the same nodes as another one.

    Alike lines meet in most of their bands, and each further bucket of the same nodes has the same pairs. Buckets
    are the same if their sizes and two sums over hashes of their nodes are.
    """
    mixed = [F.xxhash64(F.lit(i), "node").cast("decimal(20,0)") for i in range(2)]
    sums = [F.sum(m).alias(f"sum{i}") for i, m in enumerate(mixed)]
    buckets = members.groupBy("key").agg(F.count("*").alias("met"), *sums)
    kept = buckets.groupBy("met", "sum0", "sum1").agg(F.min("key").alias("key")).select("key")
    return members.join(kept, "key", "left_semi").select("node", "key")


def removed(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """(doc_id, mark, mask): a character per line of the document, '1' where the line goes."""
    found = lines_of(docs)
    node, check = hashed(F.col("line"), s)
    named = found.select("doc_id", "mark", "no", node.alias("node"), check.alias("check"), "line")
    rows = Staged(named.drop("line"), "lines")
    place = F.struct("doc_id", "mark", "no")
    classes = Staged(
        rows.df.groupBy("node", "check").agg(F.min(place).alias("first"), F.count("*").alias("times")), "classes"
    )
    # Lines that share a first hash: the one with the smallest second hash stands for the node.
    clash = classes.df.groupBy("node").agg(F.min("check").alias("least"), F.max("check").alias("x")).filter("least <> x")
    clash = Staged(clash.select("node", "least"), "clashes")

    def of_nodes(lines: DataFrame) -> DataFrame:
        return lines.groupBy("node").agg(F.min_by("line", "check").alias("line"))

    long_ones = named.filter(F.length("line") >= s.chars).select("node", "check", "line")
    sketches = Staged(bands(of_nodes(long_ones), s), "sketches")
    release(docs.sparkSession)
    # A node has a key once, so a key that is there twice has two nodes.
    band_rows = sketches.df.select("node", F.explode("bands").alias("key"))
    shared = Staged(band_rows.groupBy("key").agg(F.count("*").alias("met")).filter("met > 1").select("key"), "shared")
    release(docs.sparkSession)
    every = Staged(possible_hits(band_rows, "key", shared.df, "key").join(shared.df, "key", "left_semi"), "bands")
    shared.drop()
    sketches.drop()
    members = Staged(unlike_buckets(every.df), "bands")
    every.drop()
    wanted = Staged(members.df.select("node").distinct(), "wanted")
    texts = of_nodes(possible_hits(long_ones, "node", wanted.df, "node")).join(wanted.df, "node", "left_semi")
    texts = Staged(texts.withColumn("n", F.size(F.array_distinct(shingles(F.col("line"), s.chars)))), "texts")
    release(docs.sparkSession)
    roots = connect(
        members.df.join(texts.df.select("node", "n"), "node"),
        lambda pairs: verify(pairs, texts.df, s),
        s.alike,
        lambda left: outlined(left, texts.df, s),
        s.pivot_rounds,
    )
    for table in (members, texts, wanted):
        table.drop()
    release(docs.sparkSession)
    # A line that does not stand for its node is a component of its own with its equals.
    alone = F.when(F.col("check") != F.col("least"), F.col("check"))
    rooted = (
        classes.df.join(clash.df, "node", "left").withColumn("alone", alone)
        .join(roots.df, "node", "left")
        .withColumn("root", F.when(F.col("alone").isNull(), F.coalesce("root", "node")).otherwise(F.col("node")))
        .withColumn("alone", F.coalesce("alone", F.lit(0).cast("long")))
        .select("node", "check", "first", "times", "root", "alone")
    )
    stays = rooted.groupBy("root", "alone").agg(F.min("first").alias("stays"), F.sum("times").alias("times")).filter("times > 1")
    doomed = Staged(rooted.drop("times").join(stays, ["root", "alone"]).select("node", "check", "stays"), "doomed")
    gone = (
        possible_hits(rows.df.select("doc_id", "mark", "no", "node", "check"), "node", doomed.df, "node")
        .join(doomed.df, ["node", "check"])
        .filter(~place.eqNullSafe(F.col("stays")))
        .groupBy("doc_id", "mark")
        .agg(F.sort_array(F.collect_set("no")).alias("at"))
    )
    before = lambda i: F.when(i == 0, -1).otherwise(F.get("at", i - 1))
    mask = F.transform("at", lambda x, i: F.concat(F.repeat(F.lit("0"), x - before(i) - 1), F.lit("1")))
    out = Staged(gone.select("doc_id", "mark", F.array_join(mask, "").alias("mask")), "masks")
    for table in (rows, classes, clash, roots, doomed):
        table.drop()
    release(docs.sparkSession)
    return out.df


def dedup(docs: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The documents without the lines that go, and the counts n_lines and n_removed."""
    d, m, k = (free_name(docs, n) for n in ("line_doc", "line_mark", "line_mask"))
    masks = removed(docs, s).select(F.col("doc_id").alias(d), F.col("mark").alias(m), F.col("mask").alias(k))
    n_lines, n_removed = free_name(docs, "n_lines"), free_name(docs, "n_removed")
    text = F.col("text").cast("string")
    joined = docs.join(masks, F.col("doc_id").cast("long").eqNullSafe(F.col(d)) & (F.xxhash64(text) == F.col(m)), "left")
    bits = F.encode(k, "US-ASCII")
    split = F.split(text, "\n")
    kept = F.filter(split, lambda _, i: ~F.substr(bits, i + 1, F.lit(1)).eqNullSafe(F.lit(b"1")))
    return (
        joined.withColumn(n_lines, F.coalesce(F.size(split), F.lit(0)))
        .withColumn(n_removed, F.coalesce(F.length(F.translate(k, "0", "")), F.lit(0)))
        .withColumn("text", F.when(F.col(k).isNull(), text).otherwise(F.array_join(kept, "\n")))
        .drop(d, m, k)
    )

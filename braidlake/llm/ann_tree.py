"""Approximate nearest neighbours by inner product: a k-means tree searched best bin first.

The tree is fitted on a bounded sample (``sample_rows``). Every vector is then indexed: it goes down the
tree to its leaf in Spark tasks. A query keeps the nodes it has seen in a priority queue and visits
leaves best first. How many leaves it visits is calibrated: the true neighbours of some
queries are found by comparing them with all rows in blocks, and the number of leaves is widened
until the mean recall on them reaches ``recall``.

Equal vectors are stored once with their smallest ids: with ties going to the smaller id, no more
than ``k`` + 1 of them can be asked for. Leaves and the queries that visit them are cut into slices,
and each pair of slices is one block product, so neither a full leaf nor a popular one grows a task.

Results for odd input: vectors that are NULL, of another length than most, zero, or that hold a NULL
or a number that is not finite take no part, neither as query nor as candidate; rows with a NULL id
take no part; a repeated id counts once as a candidate and once as a query; with fewer candidates than
``k`` all of them are returned; other columns are not read; an empty table gives an empty table.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.llm.common import Staged


@dataclass(frozen=True)
class Settings:
    k: int = 20
    sample_rows: int = 20_000  # bound of what the tree is fitted on
    branching: int = 8
    leaf_rows: int = 80  # sample rows below which a node is not split
    calibration_queries: int = 256
    recall: float = 0.97
    slice_rows: int = 4_096  # rows or queries of one block product
    seed: int = 7


# ---------------------------------------------------------------- the tree
@dataclass
class Tree:
    """Node i has the centroids of its children and their numbers; a leaf has none."""

    centroids: list[np.ndarray | None] = field(default_factory=list)
    children: list[list[int]] = field(default_factory=list)
    leaf: list[int] = field(default_factory=list)  # number of the leaf, -1 inside
    n_leaves: int = 0

    def leaves_of(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf that each vector falls in, by the nearest child on every level."""
        out = np.zeros(len(vectors), np.int64)
        todo = [(0, np.arange(len(vectors)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if self.centroids[node] is None:
                out[rows] = self.leaf[node]
                continue
            child = nearest(vectors[rows], self.centroids[node])
            todo += [(c, rows[child == i]) for i, c in enumerate(self.children[node])]
        return out

    def visit(self, query: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves for a query, the best bin coming first."""
        queue, seen = [(0.0, 0)], []
        while queue and len(seen) < most:
            _, node = heapq.heappop(queue)
            held = self.centroids[node]
            if held is None:
                seen.append(self.leaf[node])
                continue
            for score, child in zip((held @ query).tolist(), self.children[node]):
                heapq.heappush(queue, (-score, child))
        return seen


def nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ centroids.T - 0.5 * (centroids**2).sum(axis=1), axis=1)


def fit(sample: np.ndarray, s: Settings) -> Tree:
    """Hierarchical k-means over the sample."""
    rng, tree = np.random.default_rng(s.seed), Tree()

    def add(rows: np.ndarray) -> int:
        node = len(tree.leaf)
        tree.centroids.append(None)
        tree.children.append([])
        tree.leaf.append(-1)
        if len(rows) > s.leaf_rows:
            data = sample[rows]
            centroids = data[rng.choice(len(data), s.branching, replace=False)]
            for _ in range(8):
                part = nearest(data, centroids)
                centroids = np.stack(
                    [data[part == i].mean(axis=0) if (part == i).any() else centroids[i] for i in range(len(centroids))]
                )
            part = nearest(data, centroids)
            used = np.unique(part)
            if len(used) > 1:
                tree.centroids[node] = centroids[used]
                tree.children[node] = [add(rows[part == i]) for i in used]
                return node
        tree.leaf[node] = tree.n_leaves
        tree.n_leaves += 1
        return node

    add(np.arange(len(sample)))
    return tree


# ---------------------------------------------------------------- Spark steps
def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an array column of equal lengths, in double precision."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.float64)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v")).filter(
        "id is not null and v is not null and size(v) > 0"
    )
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    fine = rows.filter(finite & F.exists(v, lambda x: x != 0))
    lengths = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1)
    return fine.join(F.broadcast(lengths.select("n")), F.size("v") == F.col("n"), "left_semi")  # one row


def best(df: DataFrame, by: str, order: list[Column], k: int, name: str = "r") -> DataFrame:
    """The first ``k`` rows of each key; tasks keep no more than that before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col(name) <= k)


def search(vectors: DataFrame, queries: Column, s: Settings = Settings(), id_col="vec_id", vec_col="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that ``queries``, a condition on ``id``, selects."""
    spark = vectors.sparkSession
    rows = Staged(usable(vectors, id_col, vec_col), "vectors")
    distinct = Staged(
        rows.df.distinct()
        .withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id")))
        .filter(F.col("r") <= s.k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "distinct",
    )
    sample = distinct.df.orderBy(F.xxhash64("v")).limit(s.sample_rows).select("v").toArrow()["v"].combine_chunks()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit(matrix(sample), s)
    shared = spark.sparkContext.broadcast(tree)  # its size follows sample_rows, not the table

    def place(batches):
        for batch in batches:
            leaves = shared.value.leaves_of(matrix(batch["v"]))
            yield pa.RecordBatch.from_arrays([pa.array(leaves), batch["v"], batch["ids"]], names=["leaf", "v", "ids"])

    index = Staged(distinct.df.select("v", "ids").mapInArrow(place, "leaf long, v array<double>, ids array<long>"), "index")
    asked = rows.df.filter(queries).select("id", "v").distinct()
    wanted = Staged(asked.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    leaves = calibrate(index.df, wanted.df, tree, s)
    found = probe(index.df, wanted.df, shared, leaves, s)

    # Each query takes the answers of its vector, without itself.
    named = asked.join(wanted.df, "v").select(F.col("id").alias("query_id"), "q")
    answers = named.join(found, "q").filter("vec_id <> query_id")
    return best(answers, "query_id", [F.desc("score"), F.asc("vec_id")], s.k, "rank").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )


def calibrate(index: DataFrame, wanted: DataFrame, tree: Tree, s: Settings) -> int:
    """Leaves to visit: the fewest that give the calibration queries the recall asked for."""
    some = wanted.orderBy(F.xxhash64("v")).limit(s.calibration_queries).toArrow()
    if not some.num_rows:
        return 1
    asked = matrix(some["v"].combine_chunks())
    k = s.k + 1

    def work(batches):
        held = None  # best scores and leaves so far, for every query
        for batch in batches:
            leaf = np.tile(batch["leaf"].to_numpy(), (len(asked), 1))
            score = asked @ matrix(batch["v"]).T
            if held is not None:
                score, leaf = np.hstack([held[0], score]), np.hstack([held[1], leaf])
            if score.shape[1] > k:
                top = np.argpartition(-score, k - 1, axis=1)[:, :k]
                score, leaf = np.take_along_axis(score, top, 1), np.take_along_axis(leaf, top, 1)
            held = score, leaf
        if held is not None:
            n = held[0].shape[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(len(asked)), n)), pa.array(held[0].ravel()), pa.array(held[1].ravel())],
                names=["q", "score", "leaf"],
            )

    near = index.select("leaf", "v").mapInArrow(work, "q long, score double, leaf long")
    true = best(near, "q", [F.desc("score")], k).toPandas()
    order = [tree.visit(v, tree.n_leaves) for v in asked]
    ranks = [{leaf: i for i, leaf in enumerate(o)} for o in order]
    at = np.array([ranks[q][leaf] for q, leaf in zip(true["q"], true["leaf"])])
    visits = 1
    while (at < visits).mean() < s.recall and visits < tree.n_leaves:
        visits = min(tree.n_leaves, math.ceil(visits * 1.15))
    return visits


def probe(index: DataFrame, wanted: DataFrame, shared, leaves: int, s: Settings) -> DataFrame:
    """(q, vec_id, score): the best rows of the visited leaves for each query vector."""
    k = s.k + 1

    def route(batches):
        for batch in batches:
            vectors = matrix(batch["v"])
            visited = [shared.value.visit(v, leaves) for v in vectors]
            row = pa.array(np.repeat(np.arange(len(visited)), [len(x) for x in visited]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for one in visited for x in one], pa.int64()), batch["q"].take(row), batch["v"].take(row)],
                names=["leaf", "q", "v"],
            )

    routed = Staged(wanted.select("q", "v").mapInArrow(route, "leaf long, q long, v array<double>"), "routed")

    def parts(df: DataFrame, name: str) -> DataFrame:  # one row per leaf
        return df.groupBy("leaf").agg(F.ceil(F.count("*") / s.slice_rows).cast("int").alias(name))

    # One row per leaf, of which there are at most sample_rows.
    cuts = F.broadcast(parts(index, "n_i").join(parts(routed.df, "n_q"), "leaf"))

    def cells(df: DataFrame, key: str, own: str, other: str) -> DataFrame:
        mine = F.pmod(F.xxhash64(key), F.col(own)).cast("int")
        return (
            df.join(cuts, "leaf")
            .withColumn("mine", mine)
            .withColumn("theirs", F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        )

    left = cells(index.withColumn("key", F.xxhash64("v")), "key", "n_i", "n_q").select(
        "leaf", F.col("mine").alias("si"), F.col("theirs").alias("sq"), "v", "ids"
    )
    right = cells(routed.df, "q", "n_q", "n_i").select("leaf", F.col("theirs").alias("si"), F.col("mine").alias("sq"), "q", "v")

    def block(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not len(rows) or not len(asked):
            q, score, ids = np.zeros(0, np.int64), np.zeros(0), pa.array([], pa.list_(pa.int64()))
        else:
            scores = matrix(asked["v"].combine_chunks()) @ matrix(rows["v"].combine_chunks()).T
            n = min(k, scores.shape[1])
            if n < scores.shape[1]:
                # all that reach the k-th best score, so that ties are left to the ids
                limit = -np.partition(-scores, n - 1, axis=1)[:, n - 1 : n]
                i, j = np.nonzero(scores >= limit)
            else:
                i, j = np.nonzero(np.ones_like(scores, bool))
            q, score, ids = asked["q"].to_numpy()[i], scores[i, j], rows["ids"].combine_chunks().take(pa.array(j))
        return pa.table({"q": pa.array(q, pa.int64()), "score": pa.array(score), "ids": ids})

    place = ["leaf", "si", "sq"]
    scored = left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(block, "q long, score double, ids array<long>")
    first = best(scored.withColumn("least", F.get("ids", F.lit(0))), "q", [F.desc("score"), F.asc("least")], k)
    each = first.select("q", "score", F.explode("ids").alias("vec_id"))
    # Two different ids never share a vector twice, but one id may stand in two vectors.
    each = each.groupBy("q", "vec_id").agg(F.max("score").alias("score"))
    return best(each, "q", [F.desc("score"), F.asc("vec_id")], k).select("q", "vec_id", "score")


def brute_force(vectors: pd.DataFrame, k: int, every: int) -> pd.DataFrame:
    """Exact answers of a small table, for measuring recall."""
    m = np.stack(vectors["embedding"].to_numpy()).astype(np.float64)
    ids = vectors["vec_id"].to_numpy()
    out = []
    for i in np.flatnonzero(ids % every == 0):
        score = m @ m[i]
        score[ids == ids[i]] = -np.inf
        order = np.lexsort((ids, -score))[: min(k, (ids != ids[i]).sum())]
        out.append(pd.DataFrame({"query_id": ids[i], "rank": np.arange(1, len(order) + 1), "vec_id": ids[order], "score": score[order]}))
    return pd.concat(out) if out else pd.DataFrame(columns=["query_id", "rank", "vec_id", "score"])

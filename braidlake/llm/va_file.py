"""Exact nearest neighbours by inner product with a vector-approximation file.

Components are cut to a whole-number grid. The file keeps, for every different vector, the cell that
each of its components falls in (``bits`` bits a dimension) next to the exact vector. A search has
two steps:

1. all cells are scanned in blocks against the queries. A cell bounds the score from both sides; per
   query and slice of the file the ``first`` vectors with the highest upper bounds are kept, as far as
   they reach the k-th lower bound, with the highest upper bound left behind;
2. the exact vectors of those are read, best bound first; that gives a k-th score. Where a slice left
   behind a bound that reaches it, the exact vectors of that slice whose bounds do are read as well.
   After that no vector is left whose bound reaches the k-th score: the result is certain.

Upper and lower bound are the product with the middle of the cells, plus and minus half the cells'
widths times the query's absolute values, so a block is one matrix product in whole numbers.

The queries are a stated set that is compared with all rows, in blocks: rows and queries are cut into
slices, every pair of slices is one task's work, and it sends on a bounded number of rows per query.
Equal vectors are stored once with their ``k`` + 1 smallest ids (with ties going to the smaller id, no
more can be asked for), and equal queries are asked once, so copies cost nothing.

Results for odd input: vectors that are NULL or empty, of another length than most, or that hold a NULL, a
number that is not finite or one beyond 2^18 (the scores would not fit a long) take no part, neither as
query nor as candidate; zero vectors do. Rows with a NULL id take no part. Rows that repeat an id with
the same grid vector count once; an id with several vectors is a row for each, as query and as candidate,
and only the query's own row is left out. With fewer candidates than ``k`` all are returned; other columns are
not read; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braidlake.llm.common import Staged

LARGEST = 2.0**18


@dataclass(frozen=True)
class Settings:
    k: int = 5
    scale: int = 256  # components become floor(scale * x)
    bits: int = 6  # of a cell number, at most 8
    first: int = 16  # vectors of a slice that are read at once for a query; at least k + 1
    slice_rows: int = 8_192
    slice_queries: int = 1_024


@dataclass(frozen=True)
class Grid:
    """Equal cells of each dimension: cell c of dimension i holds low[i] + c * width[i] and the next width[i] - 1 numbers."""

    low: np.ndarray
    width: np.ndarray

    def cells(self, v: np.ndarray) -> np.ndarray:
        return ((v - self.low) // self.width).astype(np.uint8)

    def bounds(self, queries: np.ndarray, cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(twice the score with the cells' middles, twice the slack to either side of it)."""
        middle = 2 * (self.low + cells * self.width) + self.width - 1
        return product(queries, middle), (np.abs(queries) * (self.width - 1)).sum(axis=1)


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a b' of whole numbers; through floating point where that is exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def matrix(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


# ---------------------------------------------------------------- the file
def usable(vectors: DataFrame, scale: int, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors that take part, on the whole-number grid."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("c"))
    fits = F.forall("c", lambda x: x.isNotNull() & (F.abs(x) <= LARGEST))  # NaN is above every number
    fine = rows.filter("id is not null and c is not null and size(c) > 0").filter(fits)
    fine = fine.select("id", F.transform("c", lambda x: F.floor(x * scale).cast("int")).alias("v"))
    lengths = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1)
    return fine.join(F.broadcast(lengths.select("n")), F.size("v") == F.col("n"), "left_semi")  # one row


def fit_grid(points: DataFrame, bits: int) -> Grid | None:
    """Cells over the range of each dimension; the ranges are added up in tasks."""

    def work(batches):
        low = high = None
        for batch in batches:
            v = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
            if len(v):
                low = v.min(axis=0) if low is None else np.minimum(low, v.min(axis=0))
                high = v.max(axis=0) if high is None else np.maximum(high, v.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(len(low), dtype=np.int32)), pa.array(low), pa.array(high)], names=["i", "low", "high"]
            )

    parts = points.select("v").mapInArrow(work, "i int, low int, high int")
    rows = parts.groupBy("i").agg(F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()  # a row a dimension
    if not rows:
        return None
    low, high = (np.array([r[c] for r in rows], np.int64) for c in ("low", "high"))
    return Grid(low, (high - low) // (1 << bits) + 1)


def best(df: DataFrame, by: str | list[str], order: list[Column], k: int, name: str = "r") -> DataFrame:
    """The first ``k`` rows of each key; tasks keep no more than that before the shuffle."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col(name) <= k)


@dataclass(frozen=True)
class VaFile:
    """``table``: (point, slice, cells, v, ids) of the different vectors; a scan reads the columns it needs."""

    table: DataFrame
    grid: Grid
    slices: int


def build(rows: DataFrame, s: Settings) -> VaFile | None:
    """The file of all vectors of ``rows`` (id, v)."""
    ids = (
        rows.distinct()
        .withColumn("r", F.row_number().over(Window.partitionBy("v").orderBy("id")))
        .filter(F.col("r") <= s.k + 1)
        .groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    )
    points = Staged(ids, "points")
    grid = fit_grid(points.df, s.bits)
    if grid is None:
        points.drop()
        return None
    slices = -(-points.df.count() // s.slice_rows)

    def cells(batches):
        for batch in batches:
            if batch.num_rows:
                v = batch["v"].flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                coded = pa.array([c.tobytes() for c in grid.cells(v)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch["v"], batch["ids"], coded], names=["v", "ids", "cells"])

    coded = points.df.mapInArrow(cells, "v array<int>, ids array<long>, cells binary")
    coded = coded.withColumn("point", F.monotonically_increasing_id()).withColumn(
        "slice", F.pmod(F.xxhash64("v"), F.lit(slices)).cast("int")
    )
    file = Staged(coded, "va-file")
    points.drop()
    return VaFile(file.df, grid, slices)


# ---------------------------------------------------------------- the search
NONE = -(1 << 62)  # below every bound


def scan(file: VaFile, queries: DataFrame, s: Settings) -> DataFrame:
    """(q, slice, points, uppers, lowers, rest): per query and slice the first vectors by bound, and the bound left behind."""
    grid, width = file.grid, len(file.grid.low)
    n_q = -(-queries.count() // s.slice_queries)
    left = file.table.select("point", "cells", "slice", F.explode(F.sequence(F.lit(0), F.lit(n_q - 1))).alias("part"))
    right = queries.select(
        "q", "v", F.pmod(F.xxhash64("v"), F.lit(n_q)).cast("int").alias("part"),
        F.explode(F.sequence(F.lit(0), F.lit(file.slices - 1))).alias("slice"),
    )
    first, k = max(s.first, s.k + 1), s.k + 1

    def block(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and asked.num_rows:
            cells = np.frombuffer(b"".join(rows["cells"].to_pylist()), np.uint8).reshape(-1, width).astype(np.int64)
            points, q, v = rows["point"].to_numpy(), asked["q"].to_numpy(), matrix(asked["v"]).astype(np.int64)
            for at in range(0, len(q), 128):
                score, slack = grid.bounds(v[at : at + 128], cells)
                m = min(first, score.shape[1])
                order = np.argpartition(-score, m - 1, axis=1)[:, :m] if m < score.shape[1] else np.tile(np.arange(m), (len(score), 1))
                top = np.take_along_axis(score, order, 1)
                if m < score.shape[1]:
                    np.put_along_axis(score, order, 2 * NONE, 1)
                    rest = score.max(axis=1) + slack
                else:
                    rest = np.full(len(score), NONE)
                # a lower bound of the k-th score of this slice
                floor = -np.partition(-top, k - 1, axis=1)[:, k - 1] - slack if m >= k else np.full(len(score), NONE)
                for i in range(len(score)):
                    stay = top[i] + slack[i] >= floor[i]
                    # bounds hold for twice the score: halves go up and down to whole numbers
                    found.append(
                        (
                            q[at + i],
                            points[order[i][stay]],
                            (top[i][stay] + slack[i]) // 2,
                            -((slack[i] - top[i][stay]) // 2),
                            rest[i] // 2 if rest[i] > NONE else NONE,
                        )
                    )
        names = ["q", "slice", "points", "uppers", "lowers", "rest"]
        q, points, upper, lower, rest = zip(*found) if found else ((), (), (), (), ())
        longs = pa.list_(pa.int64())
        return pa.table(
            [
                pa.array(q, pa.int64()), pa.array([key[0].as_py()] * len(q), pa.int32()),
                pa.array(points, longs), pa.array(upper, longs), pa.array(lower, longs), pa.array(rest, pa.int64()),
            ],
            names=names,
        )

    place = ["slice", "part"]
    schema = "q long, slice int, points array<long>, uppers array<long>, lowers array<long>, rest long"
    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(block, schema)


def inner_product(a: str, b: str) -> Column:
    each = F.zip_with(a, b, lambda x, y: x.cast("long") * y)
    return F.aggregate(each, F.lit(0).cast("long"), lambda total, x: total + x)


def read_first(file: VaFile, queries: DataFrame, scanned: DataFrame, s: Settings) -> DataFrame:
    """(q, slice, point, score, ids): exact scores of the scanned vectors that reach the k-th lower bound over all slices."""
    some = scanned.select("q", "slice", F.inline(F.arrays_zip("points", "uppers", "lowers")))
    order = [F.desc("lowers"), F.asc("points")]
    floor = best(some, "q", order, s.k + 1).filter(F.col("r") == s.k + 1).select("q", F.col("lowers").alias("floor"))
    near = some.join(floor, "q", "left").filter(F.col("floor").isNull() | (F.col("uppers") >= F.col("floor")))
    exact = near.select("q", F.col("points").alias("point")).join(file.table.select("point", "slice", "v", "ids"), "point")
    asked = queries.select("q", F.col("v").alias("w"))
    return exact.join(asked, "q").select("q", "slice", "point", inner_product("v", "w").alias("score"), "ids")


def read_rest(file: VaFile, queries: DataFrame, open_: DataFrame, s: Settings) -> DataFrame:
    """(q, slice, point, score, ids) of every vector of an open (q, slice, least) whose bound reaches ``least``.

    The best ``k`` + 1 of each slice are sent on; the slice's queries are cut into parts.
    """
    grid, k = file.grid, s.k + 1
    wanted = open_.join(queries, "q")
    cuts = open_.groupBy("slice").agg(F.ceil(F.count("*") / s.slice_queries).cast("int").alias("parts"))
    left = file.table.join(cuts, "slice").select(
        "slice", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "point", "cells", "v", "ids"
    )
    right = wanted.join(cuts, "slice").select(
        "slice", F.pmod(F.xxhash64("q"), F.col("parts")).cast("int").alias("part"), "q", F.col("v").alias("w"), "least"
    )

    def block(key, rows: pa.Table, asked: pa.Table) -> pa.Table:
        q, score, row = [], [], []
        if rows.num_rows and asked.num_rows:
            exact, w = matrix(rows["v"]).astype(np.int64), matrix(asked["w"]).astype(np.int64)
            cells, least = grid.cells(exact).astype(np.int64), asked["least"].to_numpy()
            smallest = rows["ids"].combine_chunks().values.to_numpy()[rows["ids"].combine_chunks().offsets.to_numpy()[:-1]]
            for at in range(0, len(w), 128):
                bound, slack = grid.bounds(w[at : at + 128], cells)
                for i in range(len(bound)):
                    near = np.flatnonzero((bound[i] + slack[i]) // 2 >= least[at + i])
                    value = product(w[at + i : at + i + 1], exact[near])[0]
                    order = np.lexsort((smallest[near], -value))[:k]
                    q += [asked["q"][at + i].as_py()] * len(order)
                    score.append(value[order])
                    row.append(near[order])
        row = np.concatenate(row) if row else np.zeros(0, np.int64)
        score = np.concatenate(score) if score else np.zeros(0, np.int64)
        return pa.table(
            {
                "q": pa.array(q, pa.int64()),
                "slice": pa.array([key[0].as_py()] * len(q), pa.int32()),
                "point": rows["point"].combine_chunks().take(pa.array(row)),
                "score": score,
                "ids": rows["ids"].combine_chunks().take(pa.array(row)),
            }
        )

    place = ["slice", "part"]
    schema = "q long, slice int, point long, score long, ids array<long>"
    return left.groupBy(*place).cogroup(right.groupBy(*place)).applyInArrow(block, schema)


RESULT = "query_id long, rank int, vec_id long, score long"


def search(vectors: DataFrame, queries: Column, s: Settings = Settings(), id_col="vec_id", vec_col="embedding") -> DataFrame:
    """(query_id, rank, vec_id, score) for the rows that ``queries``, a condition on ``id``, selects."""
    rows = Staged(usable(vectors, s.scale, id_col, vec_col), "grid")
    file = build(rows.df, s)
    if file is None:
        return vectors.sparkSession.createDataFrame([], RESULT)
    # A query is known by the number of its vector in the file.
    asked = rows.df.filter(queries).distinct()
    named = Staged(asked.join(file.table.select("point", "v"), "v").select(F.col("id").alias("query_id"), F.col("point").alias("q"), "v"), "asked").df
    wanted = Staged(named.select("q", "v").distinct(), "queries").df

    scanned = Staged(scan(file, wanted, s), "scanned").df
    found = Staged(read_first(file, wanted, scanned, s), "read").df
    order = [F.desc("score"), F.asc(F.get("ids", F.lit(0)))]
    kth = best(found, "q", order, s.k + 1).filter(F.col("r") == s.k + 1).select("q", "score")
    left_behind = scanned.filter(F.col("rest") > NONE).select("q", "slice", "rest").join(kth, "q", "left")
    least = F.coalesce("score", F.lit(NONE))
    open_ = Staged(left_behind.withColumn("least", least).filter("rest >= least").select("q", "slice", "least"), "open").df
    every = found.union(read_rest(file, wanted, open_, s)).dropDuplicates(["q", "point"])

    # Each row with the query's vector takes its answers, without itself.
    answers = best(every, "q", order, s.k + 1).select("q", "point", "score", F.explode("ids").alias("vec_id"))
    answers = best(answers, "q", [F.desc("score"), F.asc("vec_id")], s.k + 1).drop("r")
    others = named.drop("v").join(answers, "q").filter("vec_id <> query_id or point <> q")
    return best(others, ["query_id", "q"], [F.desc("score"), F.asc("vec_id")], s.k, "rank").select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"
    )

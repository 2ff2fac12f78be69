"""Whitening embeddings by spectrum slicing of their covariance.

Every entry becomes an integer of a fixed grid. Tasks add up counts, sums and products of the entries
as exact integers, centred on the rounded mean before they are multiplied, so the covariance does not
depend on how the rows are dealt out or on repeated tasks. Only that matrix, whose size follows the
length of the vectors and not their number, is decomposed in one place:

* the inertia of an LDL' factorisation of V - s I counts the eigenvalues above s (Sylvester);
  halving intervals by such counts leaves each leading eigenvalue alone in one;
* Rayleigh quotient iteration, started in that interval, converges cubically to its eigenvector; a
  result outside the interval sends the search back to halving;
* counts just below and above the result certify which number it has.

A second pass over the rows projects them. The covariance of the projections is taken from the staged
result and compared with the identity.

Results for odd input: vectors that are NULL or empty, of another length than most (the longer ones
where two lengths are equally frequent), or that hold a NULL, a number that is not finite or one beyond
2^40 take no part. Rows with a NULL id and repeated rows count like others. Equal eigenvalues give
some orthonormal basis of their space. A direction whose variance is below 1e-10 of the total is none
(double precision does not tell it from zero): constant vectors have no component and so no rows. An
exact deviation that 38 digits cannot hold is NULL. Other columns are not read; an empty table gives
an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braidlake.llm.common import Staged

SCALE, OFFSET = 1024, 100_000  # x = floor(SCALE * c) + OFFSET
LARGEST = 2.0**40  # of an entry, so that x stays an exact integer
DIGIT = 20  # bits; products of digits over CHUNK rows are exact in double precision
CHUNK = 4096
FLAT = 1e-10  # share of the total variance below which a direction has none
EPS = float(np.finfo(float).eps)


# ---------------------------------------------------------------- exact sums inside tasks
def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v) of the vectors with entries that all lie on the grid."""
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    fits = F.forall("v", lambda c: c.isNotNull() & (F.abs(c) <= LARGEST))  # NaN is above every number
    return rows.filter(F.col("v").isNotNull() & (F.size("v") > 0) & fits)


def grid(batch: pa.RecordBatch, only: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) for each length of vector in the batch, or for one length only."""
    vectors = batch["v"]
    lengths = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
    for n in np.unique(lengths) if only is None else [only]:
        rows = np.flatnonzero(lengths == n)
        if len(rows):
            flat = vectors.take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False)
            yield rows, np.floor(flat * SCALE).astype(np.int64).reshape(len(rows), n) + OFFSET


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums of each column, as Python integers."""
    high = x >> 32
    return high.sum(axis=0).astype(object) * (1 << 32) + (x - (high << 32)).sum(axis=0).astype(object)


def products(y: np.ndarray) -> np.ndarray:
    """y' y as Python integers: digits of 20 bits go through floating-point products that stay exact."""
    out = np.zeros((y.shape[1], y.shape[1]), dtype=object)
    for at in range(0, len(y), CHUNK):
        rest, digits = y[at : at + CHUNK], []
        while rest.any() or not digits:
            low = ((rest + (1 << DIGIT - 1)) & ((1 << DIGIT) - 1)) - (1 << DIGIT - 1)
            digits.append(low.astype(np.float64))
            rest = (rest - low) >> DIGIT
        for a, left in enumerate(digits):
            for b, right in enumerate(digits):
                out += (left.T @ right).astype(np.int64).astype(object) << (DIGIT * (a + b))
    return out


def whole(values) -> pa.Array:
    """Decimals of 38 digits; what does not fit is NULL."""
    return pa.array([Decimal(v) if abs(v) < 10**38 else None for v in values], pa.decimal128(38, 0))


def sums(rows: DataFrame) -> DataFrame:
    """(len, i, n, s): rows and sum of entry i over the vectors of each length."""

    def work(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for found, x in grid(batch):
                one = held.setdefault(x.shape[1], [0, np.zeros(x.shape[1], dtype=object)])
                one[0] += len(found)
                one[1] = one[1] + column_sums(x)
        for length, (n, s) in held.items():
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(length, length, np.int32)),
                    pa.array(np.arange(length, dtype=np.int32)),
                    pa.array(np.full(length, n, np.int64)),
                    whole(s),
                ],
                names=["len", "i", "n", "s"],
            )

    parts = rows.select("v").mapInArrow(work, "len int, i int, n long, s decimal(38,0)")
    return parts.groupBy("len", "i").agg(F.sum("n").alias("n"), F.sum("s").cast("decimal(38,0)").alias("s"))


def centred_products(rows: DataFrame, middle: np.ndarray) -> DataFrame:
    """(i, j, p): sums of (x_i - middle_i) (x_j - middle_j) for i <= j."""
    d = len(middle)
    upper = np.triu_indices(d)

    def work(batches):
        total = None
        for batch in batches:
            for _, x in grid(batch, d):
                part = products(x - middle)
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0].astype(np.int32)), pa.array(upper[1].astype(np.int32)), whole(total[upper])],
                names=["i", "j", "p"],
            )

    parts = rows.select("v").mapInArrow(work, "i int, j int, p decimal(38,0)")
    return parts.groupBy("i", "j").agg(F.sum("p").cast("decimal(38,0)").alias("p"))


# ---------------------------------------------------------------- slicing the spectrum
def above(v: np.ndarray, shift: float) -> int:
    """Number of eigenvalues of ``v`` above ``shift``: positive pivots of LDL' of v - shift I.

    Pivots are single where the largest diagonal entry is large enough, else pairs, which have one
    eigenvalue of each sign.
    """
    a = v - shift * np.eye(len(v))
    count = 0
    while len(a):
        diagonal = np.abs(np.diag(a))
        p = int(diagonal.argmax())
        off = np.abs(a - np.diag(np.diag(a)))
        r, s = np.unravel_index(int(off.argmax()), off.shape)
        if diagonal[p] == 0 and off[r, s] == 0:
            return count  # what is left is zero
        if diagonal[p] >= 0.64 * off[r, s]:
            rest = np.delete(np.arange(len(a)), p)
            count += a[p, p] > 0
            a = a[np.ix_(rest, rest)] - np.outer(a[rest, p], a[rest, p]) / a[p, p]
        else:
            rest = np.delete(np.arange(len(a)), [r, s])
            pair, side = a[np.ix_([r, s], [r, s])], a[np.ix_(rest, [r, s])]
            count += 1
            a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(pair, side.T)
        a = (a + a.T) / 2
    return int(count)


def refine(v: np.ndarray, low: float, high: float, found: list[np.ndarray], seed: int) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration from the middle of an interval, across from the vectors found before."""
    rng = np.random.default_rng(seed)
    basis = np.array(found).reshape(len(found), len(v))

    def across(x):
        for _ in range(2):
            x = x - basis.T @ (basis @ x)
        return x / np.linalg.norm(x)

    x, shift = across(rng.standard_normal(len(v))), (low + high) / 2
    size = np.abs(v).max()
    for step in range(40):
        try:
            y = np.linalg.solve(v - shift * np.eye(len(v)), x)
        except np.linalg.LinAlgError:  # the shift is an eigenvalue to the last bit
            y = np.linalg.solve(v - (shift + 4 * EPS * size) * np.eye(len(v)), x)
        x = across(y)
        value = float(x @ v @ x)
        if np.linalg.norm(v @ x - value * x) <= 4 * EPS * len(v) * size and step > 1:
            break
        if step >= 1:  # the first two steps keep to the interval
            shift = value
    return value, x


def leading(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` largest eigenvalues above ``FLAT`` of the trace, falling, and their unit eigenvectors as rows."""
    total = float(np.trace(v))
    if not total > 0:
        return np.zeros(0), np.zeros((0, len(v)))
    a = v / total
    slack = 16 * len(a) * EPS * np.abs(a).sum(axis=1).max()
    known = {FLAT: above(a, FLAT), float(np.abs(a).sum(axis=1).max()) + slack: 0}

    def count(s: float) -> int:
        if s not in known:
            known[s] = above(a, s)
        return known[s]

    values, vectors = [], []
    for number in range(1, min(k, known[FLAT]) + 1):
        while True:
            low = max(s for s, c in known.items() if c >= number)
            high = min(s for s, c in known.items() if c < number)
            if known[low] - known[high] > 1 and high - low > slack:
                count((low + high) / 2)
                continue
            value, vector = refine(a, low, high, vectors, number)
            if low - slack <= value <= high + slack:
                break
            if high - low <= slack:
                raise RuntimeError(f"eigenvalue {number} was not found in its interval")
            count((low + high) / 2)
        if count(value + slack) >= number or count(value - slack) < number:
            raise RuntimeError(f"the counts do not certify eigenvalue {number}")
        values.append(value * total)
        vectors.append(vector * np.sign(vector[np.abs(vector).argmax()]))
    return np.array(values), np.array(vectors).reshape(len(vectors), len(v))


# ---------------------------------------------------------------- the operator
@dataclass(frozen=True)
class Whitening:
    """What the fit list says: its size, its mean (middle + rest / n) and the leading components."""

    n: int
    middle: np.ndarray  # rounded mean, whole numbers
    rest: list[int]  # S - n * middle
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray  # one unit vector a row


def covariance(n: int, rest: list[int], p: dict[tuple[int, int], int]) -> np.ndarray:
    """(n P - r r') / n^2, each entry rounded once."""
    d = len(rest)
    v = np.zeros((d, d))
    for (i, j), value in p.items():
        v[i, j] = v[j, i] = (n * value - rest[i] * rest[j]) / (n * n)
    return v


def fit(vectors: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> Whitening | None:
    """Mean and components over all vectors that take part; None where there is none."""
    rows = usable(vectors, id_col, vec_col)
    added = Staged(sums(rows), "sums")  # one row per length and entry
    most = added.df.filter("i = 0").orderBy(F.desc("n"), F.desc("len")).first()
    if most is None:
        added.drop()
        return None
    total = [int(r["s"]) for r in added.df.filter(F.col("len") == most["len"]).orderBy("i").collect()]
    added.drop()
    n = most["n"]
    middle = [s // n for s in total]
    rest = [s - n * m for s, m in zip(total, middle)]
    p = {(r["i"], r["j"]): int(r["p"]) for r in centred_products(rows, np.array(middle, np.int64)).collect()}
    v = covariance(n, rest, p)
    values, vectors_ = leading(v, k)
    return Whitening(n, np.array(middle, np.int64), rest, float(np.trace(v)), values, vectors_)


def deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int]:
    """sum over entries of (n y - rest)^2 for each row, exact."""
    largest = int(np.abs(y).max(initial=0))
    if largest * max(largest, n) * y.shape[1] < 1 << 62:
        r = np.array(rest, np.int64)
    else:
        y, r = y.astype(object), np.array(rest, dtype=object)
    squares, mixed = (y * y).sum(axis=1).tolist(), (y * r).sum(axis=1).tolist()
    own = sum(x * x for x in rest)
    return [n * n * a - 2 * n * b + own for a, b in zip(squares, mixed)]


def transform(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(id, deviation, whitened): one row per vector that takes part, ``whitened`` with an entry per component."""
    n, middle, rest = model.n, model.middle, model.rest
    mean = np.array([r / n for r in rest])
    axes = (model.components / np.sqrt(model.eigenvalues)[:, None]).T
    k = axes.shape[1]

    def work(batches):
        for batch in batches:
            for found, x in grid(batch, len(middle)):
                y = x - middle
                flat = pa.array(((y - mean) @ axes).ravel())
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(y) * k + 1, k, dtype=np.int32)), flat)
                ids = batch["id"].take(pa.array(found))
                yield pa.RecordBatch.from_arrays([ids, whole(deviations(y, n, rest)), lists], names=["id", "deviation", "whitened"])

    return usable(vectors, id_col, vec_col).mapInArrow(work, "id long, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, k: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` less the identity, centred as it is added up."""
    w = [F.get("whitened", F.lit(i)) for i in range(k)]
    off = [F.abs(F.covar_pop(w[i], w[j]) - (1.0 if i == j else 0.0)) for i in range(k) for j in range(i, k)]
    return whitened.agg(F.array_max(F.array(*off)).alias("e")).first()["e"]


SCHEMA = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)


def whiten(vectors: DataFrame, k: int = 8, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """One row per vector and component: vec_id, component (from 1), n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, k, id_col, vec_col)
    if model is None or not len(model.eigenvalues):
        return vectors.sparkSession.createDataFrame([], SCHEMA)
    done = Staged(transform(vectors, model, id_col, vec_col), "whitened").df
    error = identity_error(done, len(model.eigenvalues))
    share = F.array(*[F.lit(float(e / model.trace)) for e in model.eigenvalues])
    return done.select("id", "deviation", F.posexplode("whitened").alias("at", "value")).select(
        F.col("id").alias("vec_id"),
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        F.col("value").alias("whitened"),
        F.get(share, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )

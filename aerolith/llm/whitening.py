"""Embedding whitening from a bit-sliced scatter matrix.

Entries become integers, x = floor(SCALE * c) + SHIFT. The fit list holds each distinct integer vector once. Its
scatter is counted, not multiplied: a block of rows shifts every dimension by the block's minimum, packs each bit plane of each
dimension across its rows into 64-bit words, and the cross-product of two dimensions is the sum over pairs of
planes of 2^(a + b) times the number of ones in the AND of the two planes. The shifts are added back, so
blocks give exact integer sums of x_i * x_j; Spark adds them up as decimals, the driver centres the d x d result as
integers (n * sum(x_i x_j) - sum(x_i) * sum(x_j)), and only then turns it into doubles for ``eigh``.

A task sends d * (d + 1) / 2 sums whatever its rows, and the driver holds d x d of them. Copies of one vector meet
map-side in the distinct, so a vector that a third of all rows share is one row per task. The deviation of
whitened's covariance from the identity is measured by a second pass over the fit list.

Defined results: rows whose vector is null or holds a null or non-finite entry are dropped; if lengths differ, the commonest
length (the longer of equals) is kept and rows of other lengths are dropped; entries beyond 2^53 / SCALE count as that bound; an
empty table, or vectors without entries, give no rows; null and repeated ids pass through, a row for each;
``whitened`` is null on components without variance (the rank is below their number) and ``explained`` is 0 there, or
null if nothing varies; ``deviation`` is null where no long holds it; the sign of a component makes its entry of largest
size positive; extra columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith.llm.common import stored, table

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: largest size of a scaled entry
BOUND = float(2**53)
#: rows whose planes are packed together
BLOCK_ROWS = 8192
#: words of planes that are ANDed at a time
AND_WORDS = 1 << 20
#: an eigenvalue below this part of the largest is rounding
RANK_EPS = 1e-12


def integers(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id and x, the integer vector, of every row with a whole vector of the commonest length."""
    c = F.col(vector_col).cast("array<double>")
    d = rows.select(F.col(id_col).alias("vec_id"), c.alias("c"))
    whole = F.col("c").isNotNull() & F.forall("c", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    x = F.transform("c", lambda v: F.floor(F.greatest(F.least(v * SCALE, F.lit(BOUND)), F.lit(-BOUND))) + SHIFT)
    d = d.where(whole).select("vec_id", x.alias("x"))
    width = d.groupBy(F.size("x").alias("width")).count().agg(F.max_by("width", F.struct("count", "width"))).first()[0]
    return d.where(F.size("x") == F.lit(width or 0)).where(F.size("x") > 0)


def planes(y: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of non-negative integers (rows x dimensions): words per plane, the dimension and the bit of each plane."""
    rows, dims = y.shape
    words, dim, bit = [], [], []
    room = -rows % 64
    for j in range(dims):
        for b in range(int(y[:, j].max()).bit_length()):
            ones = (y[:, j] >> b & 1).astype(np.uint8)
            words.append(np.packbits(np.pad(ones, (0, room))).view(np.uint64))
            dim.append(j), bit.append(b)
    return np.array(words, np.uint64).reshape(len(words), -(-rows // 64)), np.array(dim, np.int64), np.array(bit, np.int64)


def scatter(x: np.ndarray) -> np.ndarray:
    """Exact sums of x_i * x_j over the rows, as an object array of integers; the last row and column are the sums of x, its corner the rows."""
    rows, dims = x.shape
    low = x.min(axis=0)
    words, dim, bit = planes(x - low)
    total = [[0] * (dims + 1) for _ in range(dims + 1)]
    step = max(1, AND_WORDS // max(1, words.size))
    weight = [1 << int(b) for b in bit]
    ends = np.searchsorted(dim, np.arange(dims + 1))
    cross = np.zeros((len(words), len(words)), np.int64)
    for p in range(0, len(words), step):
        both = words[p:p + step, None, :] & words[None, p:, :]
        cross[p:p + step, p:] = np.bitwise_count(both).sum(axis=2, dtype=np.int64)
    bits = [weight[ends[j]:ends[j + 1]] for j in range(dims)]
    # sums of the shifted entries: a plane ANDed with itself is its number of ones
    sums = [sum(w * int(cross[p, p]) for p, w in zip(range(ends[j], ends[j + 1]), bits[j])) for j in range(dims)]
    big = np.array(weight, object)
    upper = np.triu(cross) + np.triu(cross, 1).T
    starts = [int(e) for e in ends[:-1]]
    filled = [j for j in range(dims) if ends[j + 1] > ends[j]]
    if filled:
        at = [starts[j] for j in filled]
        if 2 * int(bit.max()) + rows.bit_length() + 2 * 6 < 62:  # the weighted sums of a pair fit a long
            w = big.astype(np.int64)
            part = np.add.reduceat(np.add.reduceat(upper * w[:, None] * w[None, :], at, axis=0), at, axis=1)
        else:
            part = np.add.reduceat(np.add.reduceat(upper.astype(object) * big[:, None] * big[None, :], at, axis=0), at, axis=1)
        for a, i in enumerate(filled):
            for b, j in enumerate(filled):
                total[i][j] = int(part[a, b])
    base = [int(v) for v in low]
    for i in range(dims):
        for j in range(dims):
            total[i][j] += base[i] * sums[j] + base[j] * sums[i] + rows * base[i] * base[j]
        total[i][dims] = total[dims][i] = sums[i] + rows * base[i]
    total[dims][dims] = rows
    return np.array(total, object)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1).astype(np.int64) if len(column) else np.empty((0, 0), np.int64)


def _scatters(batches):
    total = None
    for b in batches:
        x = _matrix(b.column("x"))
        for a in range(0, len(x), BLOCK_ROWS):
            part = scatter(x[a:a + BLOCK_ROWS])
            total = part if total is None else total + part
    if total is not None:
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array([str(v) for v in total[i, j]])], names=["i", "j", "v"])


class Whitening:
    """Rows and sums of the fit list, components (columns) and eigenvalues by falling eigenvalue, trace of the covariance."""

    def __init__(self, total: list[list[int]], components: int):
        d = len(total) - 1
        self.n, self.sums = total[d][d], total[d][:d]
        centred = [[self.n * total[i][j] - self.sums[i] * self.sums[j] for j in range(d)] for i in range(d)]
        square = self.n * self.n
        cov = np.array([[centred[i][j] / square for j in range(d)] for i in range(d)])  # quotients of integers, rounded once
        value, vector = np.linalg.eigh(cov)
        value, vector = value[::-1][:components], vector[:, ::-1][:, :components]
        top = np.abs(vector).argmax(axis=0)
        self.vector = vector * np.where(vector[top, np.arange(vector.shape[1])] < 0, -1.0, 1.0)
        self.trace = sum(centred[i][i] for i in range(d)) / square
        self.value = np.where(value > RANK_EPS * max(float(value[0]), 0.0), value, 0.0) if self.trace > 0 else np.zeros(len(value))

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN on components without variance."""
        # n * x - S in integers, so that the mean costs no digits; split where no long holds it
        whole = np.array([s // self.n for s in self.sums], object).astype(np.int64)
        part = np.array([(s % self.n) / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            w = ((x - whole).astype(np.float64) - part) @ self.vector / np.sqrt(self.value)
        w[:, self.value == 0] = np.nan
        return w

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - S)^2, None beyond a long."""
        far = [max(abs(self.n * int(hi) - s), abs(self.n * int(lo) - s)) for hi, lo, s in zip(x.max(axis=0), x.min(axis=0), self.sums)]
        if sum(f * f for f in far) < 2**63 and max(map(abs, self.sums)) < 2**63 and self.n * int(np.abs(x).max()) < 2**63:
            y = self.n * x - np.array(self.sums, np.int64)
            return (y * y).sum(axis=1).tolist()
        y = self.n * x.astype(object) - np.array(self.sums, object)
        return [v if v < 2**63 else None for v in (y * y).sum(axis=1)]


def fit(distinct: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of a list of integer vectors ``x``; None if it is empty."""
    cells = (distinct.select("x").mapInArrow(_scatters, "i int, j int, v string")
             .groupBy("i", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v")).collect())
    if not cells:
        return None
    d = max(r["i"] for r in cells) + 1
    total = [[0] * d for _ in range(d)]
    for r in cells:
        total[r["i"]][r["j"]] = total[r["j"]][r["i"]] = int(r["v"])
    return Whitening(total, components)


def _products(model: Whitening):
    def run(batches):
        k = len(model.value)
        total, sums = np.zeros((k, k)), np.zeros(k)
        for b in batches:
            if b.num_rows:
                w = model.project(_matrix(b.column("x")))
                total += w.T @ w
                sums += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel().tolist()]), pa.array([sums.tolist()])], names=["products", "sums"])
    return run


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list less the identity, over components with variance."""
    some = np.flatnonzero(model.value > 0)
    if not len(some):
        return None
    k = len(model.value)
    parts = distinct.select("x").mapInArrow(_products(model), "products array<double>, sums array<double>")
    both = parts.select(F.concat("products", "sums").alias("v")).select(F.posexplode("v").alias("at", "v")).groupBy("at").agg(F.sum("v").alias("v")).collect()
    flat = np.array([r["v"] for r in sorted(both, key=lambda r: r["at"])])
    mean = flat[k * k:] / model.n
    cov = flat[:k * k].reshape(k, k) / model.n - np.outer(mean, mean)
    return float(np.abs((cov - np.eye(k))[np.ix_(some, some)]).max())


OUT = "vec_id {id}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _rows(model: Whitening, error: float | None, schema: pa.Schema):
    explained = [float(v) / model.trace if model.trace > 0 else None for v in model.value]

    def run(batches):
        k = len(model.value)
        for b in batches:
            x = _matrix(b.column("x"))
            if not len(x):
                continue
            m = len(x)
            w = model.project(x).ravel()
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                pa.array(np.full(m * k, model.n, np.int64)), pa.array([v for v in model.deviation(x) for _ in range(k)], pa.int64()),
                pa.array(w, mask=np.isnan(w)), pa.array(explained * m, pa.float64()), pa.array([error] * (m * k), pa.float64())], names=schema)
    return run


def whiten(rows: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each remaining vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    kept = integers(rows, id_col, vector_col)
    out = OUT.format(id=kept.schema["vec_id"].dataType.simpleString())
    distinct = stored(kept.select("x").distinct(), "distinct-vectors")
    model = fit(distinct, components)
    if model is None:
        return rows.sparkSession.createDataFrame([], out)
    error = identity_error(distinct, model)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    return kept.mapInArrow(_rows(model, error, names), out)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first 16 whitened components."""
    return whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {"op11_embedding_whitening": op11_embedding_whitening}
SQL: dict[str, str] = {}

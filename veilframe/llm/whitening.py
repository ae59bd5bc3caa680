"""Whitening of embeddings: exact covariances by polarisation, principal components, projected rows.

Entries become integers, floor(scale * c). Over the distinct vectors, n times a vector less the sum of all is an integer vector
centred exactly. Its squares are added for every dimension and for the sum of every two dimensions; as
Var(a + b) - Var(a) - Var(b) = 2 Cov(a, b), these exact sums give every covariance without rounding before the last division.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.session import materialise

SCALE = 256
LIMB = 32  # bits: a sum is sent as six longs, that many bits apart
LIMBS = 6
ROWS = 2048  # rows whose pair sums are made at a time


class Model(NamedTuple):
    """A fixed size for a dimension: n and sums of the fit list, components as rows, their eigenvalues and shares."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None


def whole_numbers(embedding: Column, scale: int = SCALE) -> Column:
    """floor(scale * c) of every entry as long."""
    return F.transform(embedding, lambda c: F.floor(c.cast("double") * F.lit(float(scale))))


def usable(embedding: Column) -> Column:
    """Whether a vector is there and all its entries are finite; NaN orders above infinity."""
    return F.coalesce(F.forall(embedding, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(math.inf))), F.lit(False))


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x array<long>) of all usable rows whose vector has the commonest length (of several, the greatest).

    Null vectors, vectors with null or non-finite entries and vectors of another length are left out; rows that repeat stay.
    """
    return _integers(rows, id_col, vector_col, scale)[0]


def _integers(rows: DataFrame, id_col: str, vector_col: str, scale: int) -> tuple[DataFrame, int]:
    good = rows.filter(usable(F.col(vector_col))).select(F.col(id_col).alias("id"), whole_numbers(F.col(vector_col), scale).alias("x"))
    sizes = rows.filter(usable(F.col(vector_col))).groupBy(F.size(vector_col).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = sizes.d if sizes else 0
    return good.filter(F.size("x") == d), d


def _limbs(total: int) -> list[int]:
    return [total >> LIMB * i & (1 << LIMB) - 1 for i in range(LIMBS - 1)] + [total >> LIMB * (LIMBS - 1)]


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exact: int64 while all pair sums fit, Python integers beyond."""
    most = max((abs(int(v)) for v in (x.max(), x.min())), default=0) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < 1 << 60:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def square_sums(u: np.ndarray) -> list[int]:
    """Exact column sums of u squared."""
    if u.dtype == object:
        return [int(v) for v in (u * u).sum(0)]
    most = max(abs(int(u.max())), abs(int(u.min()))) if u.size else 0
    if most * most * len(u) < 1 << 63:
        return (u * u).sum(0).tolist()
    p, q = u >> np.int64(31), u & np.int64((1 << 31) - 1)  # u = p * 2^31 + q, |p| <= 2^30
    return [a + (b << 32) + (c << 62) for a, b, c in zip(exact_sums(q * q), exact_sums(p * q), exact_sums(p * p))]


def exact_sums(v: np.ndarray) -> list[int]:
    """Column sums of int64 that may not fit int64 together."""
    low, high = v & np.int64(0xFFFFFFFF), v >> np.int64(32)
    return [a + (b << 32) for a, b in zip(low.sum(0).tolist(), high.sum(0).tolist())]


def pair_places(d: int) -> tuple[np.ndarray, np.ndarray]:
    return np.triu_indices(d, 1)


def _collect(sums: DataFrame, size: int) -> list[int]:
    """Python integers of (u, l0, l1, ...) rows added up; `size` rows whatever the number of vectors."""
    out = [0] * size
    for r in sums.groupBy("u").agg(*[F.sum(f"l{i}").alias(f"l{i}") for i in range(LIMBS)]).collect():
        out[r.u] = sum(r[f"l{i}"] << LIMB * i for i in range(LIMBS))
    return out


LIMB_SCHEMA = "u int, " + ", ".join(f"l{i} long" for i in range(LIMBS))


def _limb_batch(totals: list[int]) -> pa.RecordBatch:
    cols = list(zip(*[_limbs(t) for t in totals]))
    return pa.RecordBatch.from_arrays([pa.array(range(len(totals)), pa.int32()), *[pa.array(c, pa.int64()) for c in cols]],
                                      names=["u", *[f"l{i}" for i in range(LIMBS)]])


def moments(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows of `x` and their exact sum per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * (d + 1)
        for batch in batches:
            x = _matrix(batch, d)
            totals = [a + b for a, b in zip(totals, [*exact_sums(x), len(x)])]
        yield _limb_batch(totals)
    *sums, n = _collect(fit.select("x").mapInArrow(run, LIMB_SCHEMA), d + 1)
    return n, sums


def polarised(fit: DataFrame, d: int, n: int, sums: list[int]) -> list[int]:
    """Exact sums of the squared centred value, for every dimension and then for every pair sum (a < b, by a)."""
    size = d + d * (d - 1) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [0] * size
        for batch in batches:
            x = _matrix(batch, d)
            for lo in range(0, len(x), ROWS):
                z = np.asfortranarray(centred(x[lo:lo + ROWS], n, sums))
                # the sums of dimension i and each later one, in the order of pair_places()
                new = square_sums(z) + [s for i in range(d - 1) for s in square_sums(z[:, i + 1:] + z[:, i:i + 1])]
                totals = [t + s for t, s in zip(totals, new)]
        yield _limb_batch(totals)
    return _collect(fit.select("x").mapInArrow(run, LIMB_SCHEMA), size)


def covariance(squares: list[int], d: int, n: int) -> np.ndarray:
    """Covariances from the sums of polarised(), each rounded once: squares of n-fold values over n values make n^3."""
    out = np.zeros((d, d))
    for i in range(d):
        out[i, i] = squares[i] / n ** 3
    for k, (i, j) in enumerate(zip(*[p.tolist() for p in pair_places(d)])):
        out[i, j] = out[j, i] = (squares[d + k] - squares[i] - squares[j]) / (2 * n ** 3)
    return out


def project(x: np.ndarray, m: Model) -> tuple[list[int | None], np.ndarray]:
    """Per row the exact sum of its squared n-fold deviations (None beyond a long), and its whitened components."""
    z = centred(x, m.n, m.sums)
    if z.dtype != object and (not z.size or int(np.abs(z).max()) ** 2 * z.shape[1] < 1 << 63):
        far = (z * z).sum(1).tolist()
    else:
        far = [t if t < 1 << 63 else None for t in ((z.astype(object) ** 2).sum(1)).tolist()]
    with np.errstate(divide="ignore", invalid="ignore"):
        return far, (z / m.n).astype(np.float64) @ m.components.T / np.sqrt(m.values)


def fit(vectors: DataFrame, d: int, k: int = 4) -> Model | None:
    """The model of at most k components of the distinct `x` of vectors, which all have d entries; None without rows.

    What reaches the driver is one row per dimension and pair, whatever the number of vectors. Components without
    any variance have eigenvalue 0 and are not whitened.
    """
    distinct = materialise(vectors.select("x").distinct(), "vectors")
    n, sums = moments(distinct, d)
    if not n or not d:
        return None
    v = covariance(polarised(distinct, d, n, sums), d, n)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes.T[::-1][:k]
    trace = float(np.trace(v))
    values = np.where(values > trace * d * np.finfo(float).eps, values, 0.0)
    lead = np.abs(axes).argmax(1)
    axes = axes * np.sign(axes[np.arange(len(axes)), lead])[:, None]  # one sign for all rows, the same in every run
    m = Model(n, sums, axes, values, values / trace if trace else values, None)
    return m._replace(identity_error=_identity_error(distinct, m, d))


def _identity_error(fit: DataFrame, m: Model, d: int) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity, over components with variance."""
    live = int((m.values > 0).sum())
    if not live:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # counts, means and co-moments of the task, merged batch by batch, centred before multiplying
        n, mean, co = 0, np.zeros(live), np.zeros((live, live))
        for batch in batches:
            if batch.num_rows:
                w = project(_matrix(batch, d), m)[1][:, :live]
                own = w.mean(0)
                c, step = w - own, own - mean
                co += c.T @ c + np.outer(step, step) * (n * len(w) / (n + len(w)))
                mean += step * (len(w) / (n + len(w)))
                n += len(w)
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([mean.tolist()]), pa.array([co.reshape(-1).tolist()])], names=["n", "mean", "co"])

    tasks = fit.select("x").mapInArrow(run, "n long, mean array<double>, co array<double>").filter("n > 0")
    total = F.sum("n")
    at = lambda i: F.get("mean", F.lit(i))
    mean = tasks.agg(*[(F.sum(F.col("n") * at(i)) / total).alias(f"m{i}") for i in range(live)]).first()
    row = tasks.agg(*[((F.sum(F.get("co", F.lit(i * live + j))) + F.sum(F.col("n") * (at(i) - mean[i]) * (at(j) - mean[j]))) / total).alias(f"c{i}_{j}")
                      for i in range(live) for j in range(live)]).first()
    return float(np.abs(np.array(row).reshape(live, live) - np.eye(live)).max())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 4, scale: int = SCALE) -> DataFrame:
    """(id, component int, n, deviation long, whitened, explained, identity_error double): k rows per usable row, fewer below k dimensions.

    deviation is the sum over dimensions of (n * x - S)^2, null if it does not fit a long; whitened is the projection of x less
    the mean of the fit list, over the root of the eigenvalue, null for a component without variance (as for a single
    distinct vector); explained is its share of the trace. The fit list holds each distinct x once. Tables without a usable
    row give none; see integer_vectors for the rows that are left out. Other columns of rows are not read.
    """
    good, d = _integers(rows, id_col, vector_col, scale)
    schema = T.StructType([
        T.StructField("id", good.schema["id"].dataType), T.StructField("component", T.IntegerType()),
        *[T.StructField(c, T.LongType()) for c in ("n", "deviation")],
        *[T.StructField(c, T.DoubleType()) for c in ("whitened", "explained", "identity_error")]])
    m = fit(good, d, k) if d else None
    if m is None:
        return good.sparkSession.createDataFrame([], schema)
    of = len(m.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            far, w = project(_matrix(batch, d), m)
            r = batch.num_rows
            each = pa.array(np.repeat(np.arange(r), of))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").take(each), pa.array(np.tile(np.arange(1, of + 1), r), pa.int32()), pa.array([m.n] * (r * of), pa.int64()),
                 pa.array(far, pa.int64()).take(each), pa.array(w.reshape(-1), mask=np.tile(m.values == 0, r)),
                 pa.array(np.tile(m.explained, r)), pa.array([m.identity_error] * (r * of), pa.float64())], names=schema.names)
    return good.mapInArrow(run, schema)

"""Vector similarity and exact nearest-neighbour ranks without an all-pairs table."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordering import row_index
from veilframe.session import materialise

def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    return dot(a, b) / (F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


_QUERY_ROWS = 1024  # rows of one distance matrix inside a task
PIVOTS = 16


def _block_rows(n: int, cores: int, most: int) -> int:
    """Rows of a block: at most `most`, few enough to keep all cores busy, at least 500 where there are as many."""
    blocks = max(1, -(-n // most), min(-(-n // 500), round(cores ** 0.5)))
    return max(1, -(-n // blocks))


def _distances(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Euclidean distances, summed dimension by dimension so that both engines agree on near ties."""
    out = np.zeros((len(q), len(t)))
    for d in range(q.shape[1]):
        out += np.square(q[:, d][:, None] - t[:, d][None, :])
    return np.sqrt(out)


def _pair_distances(q: np.ndarray, t: np.ndarray, at: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """_distances() of the pairs `at` only, summed in the same order."""
    out = np.zeros(len(at[0]))
    for d in range(q.shape[1]):
        out += np.square(q[at[0], d] - t[at[1], d])
    return np.sqrt(out)


def _rough_squares(q: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances by one matrix product, and per query what they are off at most, with a wide margin.

    Only pairs within that margin of a bound need their distance to the last bit. Infinite targets are infinitely far.
    """
    qn, tn = np.square(q).sum(axis=1), np.square(t).sum(axis=1)
    out = q @ t.T
    out *= -2
    out += qn[:, None]
    out += tn[None, :]
    out[:, np.isinf(tn)] = np.inf
    return out, 1e-11 * (qn + tn[np.isfinite(tn)].max(initial=0))


def _matrix(column) -> np.ndarray:
    return np.stack([np.asarray(v, dtype=np.float64) for v in column])


class Blocks(NamedTuple):
    """Vectors in blocks of like ones, and per block its size and how near and far its members are from each pivot.

    The bounds are 2 x PIVOTS + 1 numbers per block, one block being thousands of vectors.
    """
    rows: DataFrame
    sizes: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def least(self, block: int) -> np.ndarray:
        """What no distance between this block's members and those of each block is below, by the triangle inequality."""
        apart = np.maximum(self.low - self.high[block], self.low[block] - self.high).max(axis=1)
        return np.maximum(apart - 1e-9 * (1 + self.high.max(axis=1)), 0)

    def most(self, block: int) -> np.ndarray:
        return (self.high + self.high[block]).min(axis=1) * (1 + 1e-9)


def blocks_of(df: DataFrame, key: str, vector: str, block_rows: int) -> Blocks:
    """Rows of df ordered by their nearest pivot and the distance to it, cut into blocks of equal size, in a column `block`.

    Pivots are the PIVOTS rows with the smallest hash of their key.
    """
    pivots = _matrix(r[0] for r in df.orderBy(F.xxhash64(key), key).limit(PIVOTS).select(vector).collect())

    def near(batches):
        for batch in batches:
            d = _distances(_matrix(batch.column(vector).to_pylist()), pivots) if batch.num_rows else np.zeros((0, len(pivots)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(d.argmin(axis=1) if len(d) else [], pa.int32()), pa.array(list(d), pa.list_(pa.float64()))],
                names=[*batch.schema.names, "_cell", "_d"])
    schema = df.select("*", F.lit(0).alias("_cell"), F.array(F.lit(0.0)).alias("_d")).schema
    placed = df.mapInArrow(near, schema).withColumn("_r", F.array_min("_d"))
    rows = row_index(placed, ["_cell", "_r", key], "_idx").withColumn("block", F.floor(F.col("_idx") / block_rows).cast("int"))
    rows = materialise(rows.drop("_cell", "_r", "_idx"), "blocks")
    each = range(len(pivots))
    stats = rows.groupBy("block").agg(F.count(F.lit(1)).alias("n"), F.array(*[F.min(F.get("_d", F.lit(j))) for j in each]).alias("low"),
                                      F.array(*[F.max(F.get("_d", F.lit(j))) for j in each]).alias("high")).orderBy("block").collect()
    return Blocks(rows.drop("_d"), np.array([r.n for r in stats]), np.array([r.low for r in stats]), np.array([r.high for r in stats]))


def _blockwise(queries: DataFrame, blocks: Blocks, needed: dict[int, list[int]], key: str, vector: str, label: str, fn, schema: str) -> DataFrame:
    """fn(queries, targets, vectors of both) for every needed pair of blocks; a task holds two blocks of vectors.

    Rows go only to the pairs that need them. Each pair returns one row per query, never one per pair of rows. Target columns
    are named t_key and t_label.
    """
    spark = queries.sparkSession
    pairs = [(q, t) for q, ts in needed.items() for t in ts]
    # a row per block, not per vector
    table = spark.createDataFrame(pairs, "qb int, tb int").cache()
    q = queries.withColumnRenamed("block", "qb").join(F.broadcast(table.groupBy("qb").agg(F.collect_list("tb").alias("_t"))), "qb").withColumn("tb", F.explode("_t")).drop("_t")
    t = blocks.rows.select(F.col(key).alias("t_key"), F.col(vector).alias("t_vec"), F.col(label).alias("t_label"), F.col("block").alias("t_tb"))
    t = t.join(F.broadcast(table.groupBy(F.col("tb").alias("t_tb")).agg(F.collect_list("qb").alias("_q"))), "t_tb").withColumn("t_qb", F.explode("_q")).drop("_q")

    def run(qs: pd.DataFrame, ts: pd.DataFrame) -> pd.DataFrame:
        if qs.empty or ts.empty:
            return pd.DataFrame(columns=[c.split()[0] for c in schema.split(", ")])
        left, right = _matrix(qs[vector]), _matrix(ts["t_vec"])
        return pd.concat([
            fn(qs.iloc[i:i + _QUERY_ROWS], ts, left[i:i + _QUERY_ROWS], right)
            for i in range(0, len(qs), _QUERY_ROWS)], ignore_index=True)

    return q.groupBy("qb", "tb").cogroup(t.groupBy("t_qb", "t_tb")).applyInPandas(run, schema)


class Ranks(NamedTuple):
    """(key, rank), and how many pairs of blocks there were and were skipped in the two passes over other blocks."""
    rows: DataFrame
    pairs: int
    skipped: int


def ranked_matches(df: DataFrame, key: str, vector: str, label: str, block_rows: int = 20_000) -> Ranks:
    """Exact rank of the nearest same-label neighbour among all others, 0 without one (ties by key).

    Vectors are put into blocks of like ones by their distances to pivots. A block is first searched in itself; a pair
    of blocks is looked at for nearer neighbours only if the triangle inequality lets some be as near as the farthest neighbour so far, and
    for the rank only if it neither lies wholly behind nor wholly before the neighbours. Blocks that bounds cannot tell apart (as
    with vectors in many dimensions without clusters) are all compared, which is the quadratic work the ranks stand for.
    """
    df = df.select(key, vector, label).where(F.col(vector).isNotNull())
    n = df.count()
    if not n:
        return Ranks(df.select(key, F.lit(0).cast("long").alias("rank")), 0, 0)
    blocks = blocks_of(df, key, vector, _block_rows(n, df.sparkSession.sparkContext.defaultParallelism, block_rows))
    all_blocks = range(len(blocks.sizes))

    def nearest(qs, ts, q, t):
        codes = pd.factorize(pd.concat([qs[label], ts["t_label"]], ignore_index=True))[0]
        q_code, t_code, q_key, t_key = codes[:len(qs)], codes[len(qs):], qs[key].to_numpy(), ts["t_key"].to_numpy()
        found = [np.zeros((2, 0), dtype=np.int64)]
        for code in np.unique(q_code[q_code >= 0]):
            rows, cols = np.flatnonzero(q_code == code), np.flatnonzero(t_code == code)
            if len(cols):
                rough, off = _rough_squares(q[rows], t[cols])
                rough[q_key[rows][:, None] == t_key[cols][None, :]] = np.inf
                least = rough.min(axis=1)
                x, y = np.nonzero((rough <= (least + 2 * off)[:, None]) & np.isfinite(least)[:, None])
                found.append(np.stack([rows[x], cols[y]]))
        x, y = np.concatenate(found, axis=1)
        out = pd.DataFrame({key: q_key[x], "block": qs["qb"].to_numpy()[x], "d": _pair_distances(q, t, (x, y)), "near": t_key[y], "_x": x})
        # the first of equal distances has the smallest key
        return out.sort_values(["d", "near"]).drop_duplicates("_x").drop(columns="_x")

    found_schema = f"{key} long, block int, d double, near long"
    inside = materialise(_blockwise(blocks.rows, blocks, {b: [b] for b in all_blocks}, key, vector, label, nearest, found_schema), "nearest")
    reach = {r.block: r.d for r in inside.groupBy("block").agg(F.max("d").alias("d"), F.count(F.lit(1)).alias("n")).collect() if r.n == blocks.sizes[r.block]}
    wanted = {b: [int(t) for t in np.flatnonzero(blocks.least(b) <= reach.get(b, np.inf)) if t != b] for b in all_blocks}
    outside = _blockwise(blocks.rows, blocks, wanted, key, vector, label, nearest, found_schema)
    near = inside.union(outside).groupBy(key, "block").agg(F.min(F.struct("d", "near")).alias("b")).select(key, "block", "b.d", "b.near")
    near = materialise(near, "nearest")
    span = {r.block: (r.lo, r.hi) for r in near.groupBy("block").agg(F.min("d").alias("lo"), F.max("d").alias("hi")).collect()}

    def before(qs, ts, q, t):
        d, near_key, q_key, t_key = qs["d"].to_numpy(), qs["near"].to_numpy(), qs[key].to_numpy(), ts["t_key"].to_numpy()
        rough, off = _rough_squares(q, t)
        rough[q_key[:, None] == t_key[None, :]] = np.inf
        surely = rough < (np.square(d) - off)[:, None]
        x, y = np.nonzero((rough <= (np.square(d) + off)[:, None]) & ~surely)
        dist = _pair_distances(q, t, (x, y))
        first = (dist < d[x]) | ((dist == d[x]) & (t_key[y] < near_key[x]))
        return pd.DataFrame({key: q_key, "n": surely.sum(axis=1) + np.bincount(x[first], minlength=len(qs))})

    counted, whole = {}, []
    for b, (lo, hi) in span.items():
        least, most = blocks.least(b), blocks.most(b)
        ahead = (most < lo) & (np.arange(len(most)) != b)  # every one of them comes before every neighbour
        counted[b] = [int(t) for t in np.flatnonzero((least <= hi) & ~ahead)]
        whole.append((b, int(blocks.sizes[ahead].sum())))
    spark = df.sparkSession
    queries = blocks.rows.join(near.drop("block"), key)
    part = _blockwise(queries, blocks, counted, key, vector, label, before, f"{key} long, n long").groupBy(key).agg(F.sum("n").alias("n"))
    plus = F.broadcast(spark.createDataFrame(whole, "block int, _ahead long"))  # a row per block
    ranks = near.join(plus, "block").join(part, key, "left").select(
        F.col(key).alias("_k"), (F.coalesce("n", F.lit(0)) + F.col("_ahead") + 1).cast("long").alias("rank"))
    out = df.select(key).join(ranks, F.col(key) == F.col("_k"), "left").select(key, F.coalesce("rank", F.lit(0).cast("long")).alias("rank"))
    total = 2 * len(blocks.sizes) * (len(blocks.sizes) - 1)
    looked = sum(map(len, wanted.values())) + sum(len([t for t in ts if t != b]) for b, ts in counted.items())
    return Ranks(out, total, total - looked)


def first_match_rank(df: DataFrame, key: str, vector: str, label: str, block_rows: int = 20_000) -> DataFrame:
    """(key, rank) of ranked_matches()."""
    return ranked_matches(df, key, vector, label, block_rows).rows


def mrr(df: DataFrame, key: str, vector: str, label: str, **kw) -> DataFrame:
    ranks = first_match_rank(df, key, vector, label, **kw)
    return ranks.agg(F.avg(F.when(F.col("rank") > 0, 1.0 / F.col("rank")).otherwise(0.0)).alias("mrr"))

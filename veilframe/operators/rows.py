"""Row operators over an explicit 0-based row index column: shard, slice, repeat, batch, pad, split.

Lists have an order, DataFrames do not, so every operator takes the index made by
ordering.row_index and returns a new one where it changes the row set.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

IDX = "row_idx"


def div(a: Column, b) -> Column:
    return F.floor(a / F.lit(b)).cast("long")


def seeded(seed: int, *cols: Column) -> Column:
    """Order key that depends only on the seed and the row's own key, so retries agree."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


# shard, skip, select -----------------------------------------------------------------------

def shard_id(idx: Column, n: int, k: int, contiguous: bool) -> Column:
    """Contiguous: the first n mod k shards hold one row more. Strided: index mod k."""
    if not contiguous:
        return F.pmod(idx, F.lit(k)).cast("long")
    q, r = divmod(n, k)
    big = r * (q + 1)
    return F.when(idx < big, div(idx, q + 1)).otherwise(r + div(idx - big, max(q, 1)))


def shard(df: DataFrame, k: int, index: int, contiguous: bool = False) -> DataFrame:
    if not 0 <= index < k:
        raise ValueError("shard index must lie in [0, num_shards)")
    n = df.count() if contiguous else 0
    return df.where(shard_id(F.col(IDX), n, k, contiguous) == index)


def shard_padded(df: DataFrame, k: int) -> DataFrame:
    """Every shard equally long: where the last round is short, the last row is reused."""
    n = df.count()
    own = df.withColumn("shard", F.pmod(IDX, F.lit(k)).cast("long"))
    missing = -n % k
    if not missing or not n:
        return own
    extra = (df.where(F.col(IDX) == n - 1)
             .withColumn("shard", F.explode(F.sequence(F.lit(k - missing).cast("long"), F.lit(k - 1).cast("long")))))
    return own.unionByName(extra)


def skip(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col(IDX) >= n)


def slice_rows(df: DataFrame, start: int = 0, end: int | None = None, step: int = 1) -> DataFrame:
    out = df.where((F.col(IDX) >= start) & (F.pmod(F.col(IDX) - start, F.lit(step)) == 0))
    return out if end is None else out.where(F.col(IDX) < end)


def select_rows(df: DataFrame, positions: DataFrame) -> DataFrame:
    """positions(new_idx, row_idx): duplicates and order are kept in new_idx."""
    return positions.join(df, IDX)


def reorder(df: DataFrame, permutation: DataFrame) -> DataFrame:
    """permutation(row_idx, new_idx) -> the same rows with row_idx replaced by new_idx."""
    return df.join(permutation, IDX).drop(IDX).withColumnRenamed("new_idx", IDX)


# repeat, chunk, fold -----------------------------------------------------------------------

def repeat(df: DataFrame, times: int, interleave: bool = True) -> DataFrame:
    """aabb (interleave) or abab (tiled)."""
    n = None if interleave else df.count()
    r = F.explode(F.sequence(F.lit(0), F.lit(times - 1)))
    out = df.withColumn("_r", r)
    new = F.col(IDX) * times + F.col("_r") if interleave else F.col("_r") * F.lit(n) + F.col(IDX)
    return out.withColumn(IDX, new.cast("long")).drop("_r")


def chunk(df: DataFrame, k: int) -> DataFrame:
    """k equal chunks; the row count must divide."""
    n = df.count()
    if n % k:
        raise ValueError(f"{n} rows do not divide into {k} chunks")
    return df.withColumn("chunk", div(F.col(IDX), max(n // k, 1)))


def micro_batches(df: DataFrame, size: int) -> DataFrame:
    return df.withColumn("batch", div(F.col(IDX), size))


def fold(df: DataFrame, m: int, cols: list[str]) -> DataFrame:
    """m consecutive rows become one row of arrays (groups hold exactly m rows)."""
    item = F.struct(IDX, *cols)
    out = df.groupBy(div(F.col(IDX), m).alias("fold")).agg(F.sort_array(F.collect_list(item)).alias("_g"))
    return out.select("fold", *[F.col("_g")[c].alias(c) for c in cols])


def unfold(df: DataFrame, m: int, cols: list[str]) -> DataFrame:
    zipped = F.arrays_zip(*[F.col(c) for c in cols])
    return df.select("fold", F.posexplode(zipped).alias("_p", "_v")).select(
        (F.col("fold") * m + F.col("_p")).cast("long").alias(IDX), *[F.col("_v")[c].alias(c) for c in cols])


def columns_consistent(cols: list[str]) -> Column:
    """True when all array columns are equally long; a non-array column fails at analysis."""
    first = F.size(cols[0])
    ok = F.lit(True)
    for c in cols[1:]:
        ok = ok & (F.size(c) == first)
    return ok


def require_consistent(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumn(cols[0], F.when(columns_consistent(cols), F.col(cols[0]))
                         .otherwise(F.raise_error(F.lit("columns differ in length"))))


def rename(df: DataFrame, old: list[str], new: list[str]) -> DataFrame:
    if len(old) != len(new):
        raise ValueError("old and new names differ in number")
    return df.withColumnsRenamed(dict(zip(old, new)))


def union_columns(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """1:1 column union of row-aligned tables; shared columns must agree (NaN equals NaN)."""
    shared = [c for c in right.columns if c in left.columns and c != key]
    r = right.select(key, *[F.col(c).alias(f"_r_{c}") if c in shared else F.col(c)
                            for c in right.columns if c != key])
    out = left.join(r, key)
    for c in shared:
        out = out.withColumn(c, F.when(F.col(c).eqNullSafe(F.col(f"_r_{c}")), F.col(c)).otherwise(
            F.raise_error(F.concat(F.lit(f"column {c} differs at "), F.col(key).cast("string")))))
    return out.drop(*[f"_r_{c}" for c in shared])


# order, batch, sample ----------------------------------------------------------------------

def shuffle_key(seed: int, buffer: int | None = None) -> list[Column]:
    """Order columns of a seeded shuffle, global or within consecutive buffers."""
    key = [seeded(seed, F.col(IDX)), F.col(IDX)]
    return key if buffer is None else [div(F.col(IDX), buffer), *key]


def batches(df: DataFrame, size: int, drop_last: bool = False) -> DataFrame:
    out = df.withColumn("batch", div(F.col(IDX), size))
    return out.where(F.col("batch") < df.count() // size) if drop_last else out


def distributed_batches(df: DataFrame, size: int, ranks: int, consumed: int = 0) -> DataFrame:
    """Global batches of size*ranks after `consumed` rows, each cut into one slice per rank."""
    at = F.col(IDX) - consumed
    whole = size * ranks
    return (df.where(F.col(IDX) >= consumed)
            .withColumn("step", div(at, whole))
            .withColumn("rank", div(F.pmod(at, F.lit(whole)), size)))


def epochs(df: DataFrame, mini_batch: int, n_epochs: int) -> DataFrame:
    n = df.count()
    if n % mini_batch:
        raise ValueError("the row count must be a multiple of the mini-batch size")
    return (df.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_epochs - 1).cast("long"))))
            .withColumn("batch", div(F.col(IDX), mini_batch)))


def pad_to_multiple(df: DataFrame, m: int) -> DataFrame:
    """Append leading rows, cyclically, until the row count is a multiple of m."""
    n = df.count()
    missing = -n % m
    if not n or not missing:
        return df.withColumn("padded", F.lit(0))
    rounds = F.explode(F.sequence(F.lit(0), F.lit((missing - 1) // n)))
    extra = (df.withColumn("_c", rounds).withColumn(IDX, F.lit(n) + F.col("_c") * n + F.col(IDX))
             .where(F.col(IDX) < n + missing).drop("_c"))
    return df.withColumn("padded", F.lit(0)).unionByName(extra.withColumn("padded", F.lit(1)))


def unpad(df: DataFrame, n: int) -> DataFrame:
    return df.where(F.col(IDX) < n)


def split_bounds(ratios: str, n: int) -> list[int]:
    """Where train, valid and test end, from '949,50,1' or '8/1/1'; the train part takes what rounding leaves over.

    Parts beyond the third do not count, missing ones are empty.
    """
    weights = np.zeros(3)
    given = re.split("[,/]", ratios)[:3]
    weights[:len(given)] = given
    if weights.sum() <= 0:
        raise ValueError("the split ratios must sum to more than 0")
    valid, test = np.rint(weights[1:] / weights.sum() * n).astype(int).tolist()
    return [0, n - test - valid, n - test, n]


def split_by_ratio(df: DataFrame, ratios: str, names=("train", "valid", "test")) -> DataFrame:
    bounds = split_bounds(ratios, df.count())
    label = F.lit(None).cast("string")
    for name, lo, hi in zip(names, bounds, bounds[1:]):
        label = F.when((F.col(IDX) >= lo) & (F.col(IDX) < hi), name).otherwise(label)
    return df.withColumn("split", label)


def top_k(df: DataFrame, by: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """First k rows per group. Spark keeps only k rows per group and task before the shuffle."""
    w = Window.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)

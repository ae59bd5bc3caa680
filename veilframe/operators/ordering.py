"""Global order without a single-task window: row index and running aggregates in two passes.

Pass one range-partitions the rows and writes them with their partition number and position;
pass two adds, per partition, the totals of the partitions before it. Only one row per
partition is ever handled centrally.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.session import materialise

_POS_BITS = 33  # layout of monotonically_increasing_id: partition << 33 | row


def ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows range-partitioned and sorted on `order` (must be a total order), as _part and _pos."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mid", F.monotonically_increasing_id())
    )
    return (
        materialise(placed, "ranged")
        .withColumn("_part", F.shiftright("_mid", _POS_BITS))
        .withColumn("_pos", F.col("_mid").bitwiseAND(F.lit((1 << _POS_BITS) - 1)))
        .drop("_mid")
    )


def row_index(df: DataFrame, order: Sequence[str | Column], name: str = "row_idx") -> DataFrame:
    """0-based position of every row in the total order `order`."""
    rows = ranged(df, order)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        rows.groupBy("_part").count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    )
    return (
        rows.join(F.broadcast(offsets), "_part")  # one row per partition
        .withColumn(name, F.col("_off") + F.col("_pos"))
        .drop("_part", "_pos", "_off")
    )


def running(
    df: DataFrame,
    order: Sequence[str],
    aggs: dict[str, tuple[str, str]],
    by: Sequence[str] = (),
    inclusive: bool = True,
    placed: bool = False,
    keep_place: bool = False,
) -> DataFrame:
    """Running sum, max or min along `order`, optionally within groups `by`.

    aggs maps output name -> (kind, column), kind in sum/max/min/count. (by, order) must be a
    total order. A group larger than one partition is spread over several: its earlier
    partitions contribute a carried value, so no task holds more than one range partition.
    keep_place leaves the placement columns in; a second pass in the same order takes placed=True
    and needs no new range shuffle.
    """
    fns = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.count}
    rows = df if placed else ranged(df, [*by, *order])
    by = list(by)
    if by:
        group = F.struct(*[F.col(c) for c in by])
        edges = rows.groupBy("_part").agg(F.min(group).alias("lo"), F.max(group).alias("hi"))
        # only a partition's first or last group can reach into another one
        edge_groups = (
            edges.select("_part", F.explode(F.array("lo", "hi")).alias("g"))
            .select("_part", *[F.col("g")[c].alias(c) for c in by]).distinct()
        )
        cond = rows["_part"] == edge_groups["_part"]
        for c in by:
            cond = cond & rows[c].eqNullSafe(edge_groups[c])
        head = rows.join(F.broadcast(edge_groups), cond, "left_semi")
    else:
        head = rows
    totals = head.groupBy("_part", *by).agg(
        *[fns[kind](c).alias(f"_t_{name}") for name, (kind, c) in aggs.items()]
    )
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    merge = {"sum": F.sum, "max": F.max, "min": F.min, "count": F.sum}
    carry = totals.select(
        F.col("_part").alias("_cp"),
        *[F.col(c).alias(f"_by_{c}") for c in by],
        *[merge[kind](f"_t_{name}").over(earlier).alias(f"_c_{name}")
          for name, (kind, _) in aggs.items()],
    )
    on = rows["_part"] == carry["_cp"]
    for c in by:
        on = on & rows[c].eqNullSafe(carry[f"_by_{c}"])
    joined = rows.join(F.broadcast(carry), on, "left")  # at most two rows per partition
    inside = Window.partitionBy("_part", *by).orderBy("_pos").rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1)
    out = joined
    for name, (kind, c) in aggs.items():
        local, carried = fns[kind](c).over(inside), F.col(f"_c_{name}")
        if kind in ("sum", "count"):
            value = F.coalesce(local, F.lit(0)) + F.coalesce(carried, F.lit(0))
        else:
            value = (F.greatest if kind == "max" else F.least)(local, carried)
        out = out.withColumn(name, value)
    place = [] if keep_place else ["_part", "_pos"]
    extra = [*place, "_cp", *[f"_by_{c}" for c in by], *[f"_c_{n}" for n in aggs]]
    return out.drop(*extra)


def row_index_by_id(df: DataFrame, id_col: str, name: str = "row_idx", width: int = 65_536,
                    max_buckets: int = 1_000_000) -> DataFrame:
    """row_index for a unique, dense integer id, without writing the rows.

    Ids fall into buckets of `width` values, so no bucket holds more than `width` rows; only one
    count per bucket is summed centrally. Sparse ids (too many buckets) use row_index.
    """
    lo, hi = df.agg(F.min(id_col), F.max(id_col)).first()
    if lo is not None and (hi - lo) // width >= max_buckets:
        return row_index(df, [id_col], name)
    rows = df.withColumn("_b", F.floor((F.col(id_col) - F.lit(lo or 0)) / width))
    before = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("_b").count().select(
        F.col("_b"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_b").orderBy(id_col)
    return (rows.join(offsets, "_b")
            .withColumn(name, F.col("_off") + F.row_number().over(inside) - 1)
            .drop("_b", "_off"))

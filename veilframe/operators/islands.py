"""Span union over long tables, for span sets too large to hold in one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.operators.ordering import running
from veilframe.session import materialise

LARGE = 200_000  # rows of a group beyond which it is spread over partitions


def islands(df: DataFrame, by: list[str], start: str, end: str, tie: list[str],
            label: str | None = None, priority: Column | None = None, large: int = LARGE) -> DataFrame:
    """Disjoint unions of overlapping [start, end) per group; touching spans stay apart.

    With `label`, an island takes the label of its member with the lowest priority value, the
    earliest one on ties. Groups are counted first: those of up to `large` rows are walked by a window each, after one exchange;
    in larger ones running values are carried across range partitions, so a group may be larger than a partition.
    """
    rows = df.withColumn("_prio", priority if priority is not None else F.lit(0))
    rows = rows.withColumn("_neg", -F.col(end))
    order = [start, "_prio", "_neg", *tie]
    hot = materialise(df.groupBy(*by).count().where(F.col("count") > large).select(*by), "hot")
    same = lambda: [rows[c].eqNullSafe(hot[c]) for c in by]
    if hot.isEmpty():
        numbered = _walked(rows, by, order, start, end)
    else:
        numbered = _walked(rows.join(hot, same(), "left_anti"), by, order, start, end).unionByName(
            _carried(rows.join(hot, same(), "left_semi"), by, order, start, end))
    aggs = [F.min(start).alias(start), F.max(end).alias(end), F.count("*").alias("members")]
    if label:
        aggs.append(F.min_by(label, F.struct("_prio", start, "_neg", *tie)).alias(label))
    return numbered.groupBy(*by, "island").agg(*aggs)


def _opens(start: str) -> Column:
    return (F.col("_reach").isNull() | (F.col(start) >= F.col("_reach"))).cast("long")


def _walked(rows: DataFrame, by: list[str], order: list[str], start: str, end: str) -> DataFrame:
    group = Window.partitionBy(*by).orderBy(*order)
    reach = rows.withColumn("_reach", F.max(end).over(group.rowsBetween(Window.unboundedPreceding, -1)))
    return reach.withColumn("island", F.sum(_opens(start)).over(group.rowsBetween(Window.unboundedPreceding, 0)))


def _carried(rows: DataFrame, by: list[str], order: list[str], start: str, end: str) -> DataFrame:
    reach = running(rows, order, {"_reach": ("max", end)}, by=by, inclusive=False, keep_place=True)
    numbered = running(reach.withColumn("_open", _opens(start)), order, {"island": ("sum", "_open")}, by=by, placed=True)
    return numbered.drop("_open")

"""Label maps, label checks, predicates and split rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordering import row_index
from veilframe.operators.rows import IDX
from veilframe.session import small


def discover_labels(df: DataFrame, label: str, order: str) -> DataFrame:
    """(label, id): ids by first appearance, numbered over partitions after a pre-aggregated groupBy."""
    first = df.groupBy(label).agg(F.min(order).alias("_first"))
    return row_index(first, ["_first", label], "id").select(label, "id")


def to_ids(df: DataFrame, label: str, mapping: DataFrame, out: str) -> DataFrame:
    """Scalar label -> id; an unknown label fails the job."""
    joined = df.join(small(mapping), label, "left")
    bad = F.raise_error(F.concat(F.lit("unknown label "), F.col(label)))
    return joined.withColumn(out, F.when(F.col(label).isNotNull() & F.col("id").isNull(), bad)
                             .otherwise(F.col("id"))).drop("id")


def list_to_ids(labels: Column, mapping: dict[str, int]) -> Column:
    """Label array (or array of level arrays through transform) -> id array."""
    m = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.transform(labels, lambda x: m[x])


def unknown_labels(df: DataFrame, label: str, known: list[str]) -> DataFrame:
    """Labels outside the given map with their counts."""
    return (df.where(~F.col(label).isin(known)).groupBy(F.col(label).alias("label"))
            .agg(F.count("*").alias("n_rows")))


def multi_hot(labels: Column, all_labels: list[str]) -> Column:
    return F.transform(F.array(*[F.lit(x) for x in all_labels]),
                       lambda x: F.array_contains(labels, x).cast("double"))


def split_by_pairs(df: DataFrame, listed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key pair is listed go to dev, the rest to train."""
    dev = listed.select(*keys).distinct().withColumn("_dev", F.lit(True))
    return (df.join(dev, keys, "left")
            .withColumn("split", F.when(F.col("_dev"), "dev").otherwise("train")).drop("_dev"))


def indexed(df: DataFrame, order: list[str]) -> DataFrame:
    """The rows of a test file with their running number in the order of the file, from 0, as column `index`."""
    return row_index(df, order, "index")


def drop_invalid(df: DataFrame, label: str, marker: str = "-") -> DataFrame:
    return df.where(F.col(label) != marker)


def exclude_intervals(df: DataFrame, intervals: list[tuple[int, int]]) -> DataFrame:
    """Drop rows whose 1-based step lies in a closed interval; intervals come from configuration."""
    keep = F.lit(True)
    for lo, hi in intervals:
        if not (isinstance(lo, int) and isinstance(hi, int) and 1 <= lo <= hi):
            raise ValueError(f"bad interval {lo}..{hi}")
        keep = keep & ~(F.col(IDX) + 1).between(lo, hi)
    return df.where(keep)


def above(probs: Column, limit: float) -> Column:
    """Positions and probabilities above the limit, as array<struct<pos,p>>."""
    tagged = F.transform(probs, lambda p, i: F.struct(i.alias("pos"), p.alias("p")))
    return F.filter(tagged, lambda x: x["p"] > limit)


def oriented_preference(df: DataFrame) -> DataFrame:
    """Preference rows (src, tgt, response, sort): validity flag and chosen/rejected by larger sort."""
    ok = ((F.size("src") == F.size("tgt") + 1) & (F.size("response") == 2) & (F.size("sort") == 2)
          & F.forall("response", lambda r: F.trim(r) != "")
          & (F.element_at("sort", 1) != F.element_at("sort", 2)))
    swap = F.element_at("sort", 2) > F.element_at("sort", 1)
    first, second = F.element_at("response", 1), F.element_at("response", 2)
    return (df.withColumn("valid", F.coalesce(ok, F.lit(False)))
            .withColumn("chosen", F.when(swap, second).otherwise(first))
            .withColumn("rejected", F.when(swap, first).otherwise(second)))


def valid_triple(query: Column, positives: Column, negatives: Column) -> Column:
    """Retrieval triple check: non-blank query and, when negatives exist, no blank passage."""
    filled = lambda arr: (F.size(arr) > 0) & ~F.exists(arr, lambda p: F.trim(p) == "")
    return F.coalesce((F.trim(query) != "") & filled(positives)
                      & ((F.size(negatives) == 0) | filled(negatives)), F.lit(False))


def symmetric_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in exactly one of two sets, with the side they come from."""
    only = lambda a, b, side: a.exceptAll(b).withColumn("side", F.lit(side))
    left, right = left.distinct(), right.distinct()
    return only(left, right, "left").unionByName(only(right, left, "right"))

"""Run telemetry, latency, throughput, ranking and capacity reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordering import running
from veilframe.session import materialise


def running_metric(df: DataFrame, value: str, by: list[str] = ()) -> DataFrame:
    """count, mean and max; missing values are no zeros."""
    return df.groupBy(*by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"))


def rollup_samples(rows: DataFrame, sample: str, phase: str, round_: str, value: str) -> DataFrame:
    """Overall, per phase and per round, on one row per sample (device rows repeat the host values)."""
    one = rows.select(sample, phase, round_, value).dropDuplicates([sample])
    return one.groupingSets([[], [F.col(phase)], [F.col(round_)]], F.col(phase), F.col(round_)).agg(
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"))


def per_device(rows: DataFrame, device: str, value: str, status: str) -> DataFrame:
    return rows.groupBy(device).agg(F.count(value).alias("count"), F.avg(value).alias("mean"),
                                    F.max(value).alias("max"), F.count_if(F.col(status) == "ok").alias("ok"),
                                    F.count_if(F.col(status) != "ok").alias("not_ok"))


def throughput(rows: DataFrame, by: list[str], records: str, seconds: str) -> DataFrame:
    """Sum of records over sum of seconds, null without time."""
    return rows.groupBy(*by).agg(F.sum(records).alias("records"), F.sum(seconds).alias("seconds"),
                                 (F.sum(records) / F.nullif(F.sum(seconds), F.lit(0.0))).alias("records_per_second"))


def stage_other(wall: Column, *stages: Column) -> Column:
    total = stages[0]
    for s in stages[1:]:
        total = total + s
    return F.greatest(F.lit(0.0), wall - total)


def latency(rows: DataFrame, by: str, value: str, large: int = 1_000_000) -> DataFrame:
    """count, mean, max, p50, p95 per group, interpolated between the two neighbouring ranks at any size.

    Groups are counted first. Those of up to `large` values keep a count per value while they are aggregated; larger ones are
    ranked by running counts that share a group out over partitions. A group without values has null quantiles;
    `approximate` is always false.
    """
    hot = materialise(rows.groupBy(by).agg(F.count(value).alias("n")).where(F.col("n") > large).select(by), "hot")
    if hot.isEmpty():
        return _aggregated(rows, by, value)
    same = rows[by].eqNullSafe(hot[by])
    return _aggregated(rows.join(hot, same, "left_anti"), by, value).unionByName(_ranked(rows.join(hot, same, "left_semi"), by, value))


def _aggregated(rows: DataFrame, by: str, value: str) -> DataFrame:
    q = F.percentile(value, F.array(F.lit(0.5), F.lit(0.95)))
    return rows.groupBy(by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"), q.alias("_q")).select(
        by, "count", "mean", "max", F.col("_q")[0].alias("p50"), F.col("_q")[1].alias("p95"), F.lit(False).alias("approximate"))


def _ranked(rows: DataFrame, by: str, value: str) -> DataFrame:
    base = rows.groupBy(by).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    steps = rows.where(F.col(value).isNotNull()).groupBy(by, value).agg(F.count(F.lit(1)).alias("_n"))
    ranks = running(steps, [value, by], {"_to": ("sum", "_n")}, by=[by]).join(base.select(by, "count"), by)
    held = ranks.select(by, F.col(value).alias("_v"), (F.col("_to") - F.col("_n")).alias("_from"), "_to", "count")

    def at(share: float):
        place = (F.col("count") - 1) * F.lit(share)
        low = F.floor(place)
        pick = lambda r: F.max(F.when((F.col("_from") <= r) & (r < F.col("_to")), F.col("_v")))
        a, b = pick(low), pick(F.least(low + 1, F.col("count") - 1))
        return a + (b - a) * F.max(place - low)

    found = held.groupBy(by).agg(at(0.5).alias("p50"), at(0.95).alias("p95"))
    return base.join(found, by, "left").select(by, "count", "mean", "max", "p50", "p95", F.lit(False).alias("approximate"))


def rank_configs(runs: DataFrame, config: list[str], repeats: int, same: list[str]) -> DataFrame:
    """Configurations with every repeat present, valid and on equal data, by median rate.

    Medians run only over groups that passed, which hold exactly `repeats` rows.
    """
    checked = runs.groupBy(*config).agg(
        F.count("*").alias("n"), F.bool_and("valid").alias("ok"), F.countDistinct(F.struct(*same)).alias("kinds"))
    good = checked.where((F.col("n") == repeats) & F.col("ok") & (F.col("kinds") == 1)).select(*config)
    ranked = runs.join(good, config, "left_semi").groupBy(*config).agg(
        F.median("records_per_second").alias("records_per_second"),
        F.median("chars_per_second").alias("chars_per_second"), F.max("peak_rss").alias("peak_rss"))
    return ranked.orderBy(F.desc("records_per_second"), *config)


def best_per_device(ranked: DataFrame, device: str, others: list[str]) -> DataFrame:
    order = F.struct("records_per_second", *[-F.col(c) for c in others])
    return ranked.groupBy(device).agg(F.max_by(F.struct(*others, "records_per_second"), order).alias("b")).select(device, "b.*")


def capacity(speed: Column, history: int = 0, daily: int = 0, days: float = 30, hours: float = 20,
             utilization: float = 0.8) -> Column:
    """Records per node and day, and nodes for history, daily volume and both (null without volume)."""
    if min(days, hours, utilization) <= 0 or hours > 24 or utilization > 1 or min(history, daily) < 0:
        raise ValueError("capacity parameters out of range")
    per_day = speed * 3600 * hours * utilization
    known = history or daily
    nodes = lambda volume: F.ceil(F.lit(float(volume)) / per_day) if known else F.lit(None).cast("long")
    return F.struct(per_day.alias("records_per_node_per_day"), nodes(history / days).alias("nodes_history"),
                    nodes(daily).alias("nodes_daily"), nodes(history / days + daily).alias("nodes_both"))


def workers(speed: Column, target: int, hours: float | None, headroom: float, peak_rss: Column | None = None) -> Column:
    """Concurrent workers for a target volume under a deadline, with headroom; memory scales with them."""
    if not 0 <= headroom < 1:
        raise ValueError("headroom must lie in [0, 1)")
    seconds = F.lit(float(target)) / (speed * (1 - headroom))
    n = F.greatest(F.lit(1), F.ceil(seconds / (hours * 3600))) if hours else F.lit(1).cast("long")
    rss = F.lit(None).cast("long") if peak_rss is None else F.ceil(peak_rss * n / (1 - headroom))
    return F.struct((seconds / 3600).alias("hours_one_worker"), n.alias("workers"), rss.alias("total_rss"))

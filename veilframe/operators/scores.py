"""Reward statistics: group-relative scores, masked moments, advantages, penalties."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let, scan


def group_advantage(df: DataFrame, group: str, reward: str, eps: float = 1e-6) -> DataFrame:
    """(r - mean) / (std + eps) per group; a group of one has mean 0 and std 1.

    Group moments are pre-aggregated and joined back, so a hot group is never gathered in one task.
    """
    stats = df.groupBy(group).agg(F.count("*").alias("_n"), F.avg(reward).alias("_mean"),
                                  F.stddev_samp(reward).alias("_std"))
    single = F.col("_n") == 1
    mean = F.when(single, 0.0).otherwise(F.col("_mean"))
    std = F.when(single, 1.0).otherwise(F.col("_std"))
    return (df.join(stats, group).withColumn("advantage", (F.col(reward) - mean) / (std + eps))
            .drop("_n", "_mean", "_std"))


def valid_groups(df: DataFrame, group: str, reward: str, n: int, threshold: float) -> DataFrame:
    """Rows of groups with exactly n members and population variance above the threshold."""
    good = df.groupBy(group).agg(F.count("*").alias("n"), F.var_pop(reward).alias("v")) \
             .where((F.col("n") == n) & (F.col("v") > threshold)).select(group)
    return df.join(good, group, "left_semi")


def masked_moments(df: DataFrame, value: Column, mask: Column) -> DataFrame:
    """One row: masked mean and Bessel-corrected variance over all rows."""
    m = F.when(mask == 1, value)
    return df.agg(F.count(m).alias("n"), F.avg(m).alias("mean"), F.var_samp(m).alias("var"))


def whiten(df: DataFrame, value: str, mask: str, out: str, shift_mean: bool = True) -> DataFrame:
    """(value - mean) / sqrt(var + 1e-8) with the moments of the masked rows."""
    moments = masked_moments(df, F.col(value), F.col(mask)).select("mean", "var")
    z = (F.col(value) - F.col("mean")) / F.sqrt(F.col("var") + 1e-8)
    z = z if shift_mean else z + F.col("mean")
    return df.join(F.broadcast(moments)).withColumn(out, z).drop("mean", "var")  # one row


def gae(rewards: Column, values: Column, mask: Column, gamma: float, lam: float) -> Column:
    """array<struct<advantage,ret>> per position of one trajectory (reverse recurrence)."""
    step = F.arrays_zip(F.zip_with(rewards, mask, lambda r, m: (r * m).cast("double")).alias("r"),
                        F.zip_with(values, mask, lambda v, m: (v * m).cast("double")).alias("v"))
    out_type = "array<struct<advantage:double,ret:double>>"
    zero = F.struct(F.lit(0.0).alias("next"), F.lit(0.0).alias("last"), F.array().cast(out_type).alias("out"))

    def back(acc, x):
        adv = x["r"] + gamma * acc["next"] - x["v"] + gamma * lam * acc["last"]
        one = F.array(F.struct(adv.alias("advantage"), (adv + x["v"]).alias("ret")))
        return F.struct(x["v"].alias("next"), adv.alias("last"), F.concat(acc["out"], one).alias("out"))

    return F.reverse(scan(F.reverse(step), zero, ["next", "last"], out_type, back))


def discounted_returns(rewards: Column, eos_mask: Column, gamma: float) -> Column:
    """Discounted return per position; the running value is multiplied by the end mask."""
    zero = F.struct(F.lit(0.0).alias("run"), F.array().cast("array<double>").alias("out"))

    def back(acc, x):
        ret = x["r"] + gamma * acc["run"]
        return F.struct((ret * x["m"]).alias("run"), F.concat(acc["out"], F.array(ret)).alias("out"))

    step = F.zip_with(rewards, eos_mask, lambda r, m: F.struct(r.cast("double").alias("r"), m.cast("double").alias("m")))
    return F.reverse(scan(F.reverse(step), zero, ["run"], "array<double>", back))


def kl_rewards(log_probs: Column, ref_log_probs: Column, mask: Column, score: Column,
               kl_coeff: float, clip: float) -> Column:
    """-kl * (logp - ref) per token, plus the clipped score at the last valid position."""
    kl = F.zip_with(log_probs, ref_log_probs, lambda a, b: -kl_coeff * (a - b))
    valid = F.filter(F.transform(mask, lambda m, i: F.when(m == 1, i)), lambda i: i.isNotNull())
    last = F.coalesce(F.array_max(valid), F.lit(0))
    clipped = F.greatest(F.least(score, F.lit(clip)), F.lit(-clip))
    return let(F.struct(last.alias("at"), clipped.alias("score")), lambda s: F.transform(
        kl, lambda k, i: k + F.when(i == s["at"], s["score"]).otherwise(0.0)))


def overlong_penalty(length: Column, max_len: int, buffer: int, factor: float) -> Column:
    return F.least(F.lit(0.0), -(length - F.lit(max_len - buffer)) / F.lit(buffer) * factor)

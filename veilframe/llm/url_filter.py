"""URL filters by path-template trees.

Per host, paths grow into a tree level by level. At each level rare segments, and branches whose labels do not differ
from their parent's, merge into a wildcard. Templates are then judged by the share of good labels, smoothed towards
their host and that towards all pages. The tree is built on counts of distinct paths, not on pages, and has as many levels as
the paths that can still be told apart.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.session import materialise

DEPTH = 4  # levels that the SQL spells out; the tree has no such limit
MIN_PAGES = 20
Z = 3.0
PRIOR = 5.0
PURITY = 0.5
ABC, abc = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    action: str  # allow or block
    host: str
    path: str


def host(url: Column) -> Column:
    """What stands between the first :// and the next / ? # or the end, A-Z lower-cased; empty for none and for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), ABC, abc)


def path(url: Column) -> Column:
    """What follows the host up to ? # or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(rules: list[Rule], host_col: str = "host", path_col: str = "path") -> tuple[Column, Column]:
    """(rule string, action) of the longest rule that fits, else null; equally long ones in order of their text.

    Rules are part of the plan: lists of some hundreds, stated by whoever runs the filter.
    """
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = ((F.col(host_col) == r.host) | F.endswith(F.col(host_col), F.lit("." + r.host))) & F.startswith(F.col(path_col), F.lit(r.path))
        text, action = F.when(fits, r.host + r.path).otherwise(text), F.when(fits, r.action).otherwise(action)
    return text, action


def segments(path_col: Column) -> Column:
    """Non-empty path segments with runs of digits, and long hexadecimal names, generalised."""
    plain = F.regexp_replace(path_col, "[0-9a-fA-F]{16,}", "{h}")
    return F.filter(F.split(F.regexp_replace(plain, "[0-9]+", "{n}"), "/", -1), lambda s: s != "")


def templates(paths: DataFrame, min_pages: int = MIN_PAGES, z: float = Z, prior: float = PRIOR) -> DataFrame:
    """(host, segs, template, purity) for a table (host, segs, n, good, bad) of distinct paths.

    A segment stays itself if at least min_pages pages have it and the good share of its labels lies more than z
    standard errors from its parent's; all others of the parent become *. A level costs two written tables; levels at which every
    parent that may be told apart has one child are skipped, as that child's share is its parent's. The descent ends where no
    parent has min_pages pages and labels of both kinds, as nothing below it can stay itself.
    """
    now, level = paths.withColumn("template", F.lit("")), 0
    tot = [F.sum(c).alias(c) for c in ("n", "good", "bad")]
    done = [now.filter(F.size("segs") == 0)]
    while True:
        alike = _common_levels(now.filter(F.size("segs") > level), level, min_pages)
        if alike:
            now = now.filter(F.size("segs") > level).withColumn("template", F.concat("template", F.repeat(
                F.lit("/*"), F.least(F.lit(alike), F.size("segs") - level))))
            level += alike
            done.append(now.filter(F.size("segs") <= level))
        now = now.filter(F.size("segs") > level).withColumn("_seg", F.get("segs", F.lit(level)))
        child = now.groupBy("host", "template", "_seg").agg(*tot)
        parent = child.groupBy("host", "template").agg(F.sum("n").alias("pn"), F.sum("good").alias("pg"), F.sum("bad").alias("pb"))
        parent = parent.filter((F.col("pn") >= min_pages) & (F.col("pg") > 0) & (F.col("pb") > 0))
        share = F.col("pg") / (F.col("pg") + F.col("pb"))
        labelled = F.col("good") + F.col("bad")
        own = (F.col("n") >= min_pages) & (labelled > 0) & ((F.col("good") - labelled * share) * (F.col("good") - labelled * share)
                                                            > z * z * labelled * share * (1 - share)) & (share * (1 - share) > 0)
        open_ = materialise(child.join(parent, ["host", "template"]).select("host", "template", "_seg", F.coalesce(own, F.lit(False)).alias("_stays")), "level")
        if open_.isEmpty():
            break
        kept = open_.filter("_stays").select("host", "template", "_seg", F.col("_seg").alias("_own"))
        now = materialise(now.join(kept, ["host", "template", "_seg"], "left").withColumn(
            "template", F.concat("template", F.lit("/"), F.coalesce("_own", F.lit("*")))).drop("_seg", "_own"), "level")
        level += 1
        done.append(now.filter(F.size("segs") == level))
    rest = now.drop("_seg").withColumn("template", F.concat("template", F.repeat(F.lit("/*"), F.size("segs") - level)))
    now = reduce(DataFrame.unionByName, done, rest)
    now = materialise(now, "templates")
    total = now.agg(F.sum("good").alias("good"), F.sum("bad").alias("bad")).select(
        F.coalesce(F.col("good") / F.nullif(F.col("good") + F.col("bad"), F.lit(0)), F.lit(1.0)).alias("_all"))
    hosts = now.groupBy("host").agg(F.sum("good").alias("hg"), F.sum("bad").alias("hb")).crossJoin(total).select(  # one row
        "host", ((F.col("hg") + prior * F.col("_all")) / (F.col("hg") + F.col("hb") + prior)).alias("_host"))
    pure = now.groupBy("host", "template").agg(F.sum("good").alias("tg"), F.sum("bad").alias("tb")).join(hosts, "host").select(
        "host", "template", ((F.col("tg") + prior * F.col("_host")) / (F.col("tg") + F.col("tb") + prior)).alias("purity"))
    return now.select("host", "segs", "template").join(pure, ["host", "template"])


def _common_levels(paths: DataFrame, level: int, min_pages: int) -> int:
    """How many levels from `level` on all paths of each parent agree on, over the parents that have min_pages pages and both labels."""
    rest = F.slice("segs", F.lit(level + 1), F.size("segs"))
    ends = paths.groupBy("host", "template").agg(F.sum("n").alias("n"), F.sum("good").alias("good"), F.sum("bad").alias("bad"), F.min(rest).alias("a"), F.max(rest).alias("b"))
    ends = ends.filter((F.col("n") >= min_pages) & (F.col("good") > 0) & (F.col("bad") > 0) & (F.col("a") != F.col("b")))
    shorter = F.least(F.size("a"), F.size("b"))
    differ = F.array_min(F.filter(F.sequence(F.lit(0), shorter - 1), lambda i: F.get("a", i) != F.get("b", i)))
    return ends.agg(F.min(F.coalesce(differ, shorter))).first()[0] or 0


def judge(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", label_col: str = "label",
          purity: float = PURITY, **params) -> DataFrame:
    """(id, host, path, rule, verdict, template, purity), one row per row of pages.

    label_col holds 1 for a good page, 0 for a bad one, null for none. The verdict is the action of the rule that fits,
    else block where the template's purity is below `purity`. A null url, or one without ://, has an empty host and path and is
    judged with the others of that kind. Without any label nothing is blocked but by rules.
    """
    p = pages.select(F.col(id_col).alias("id"), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"),
                     F.col(label_col).cast("int").alias("label")).withColumn("segs", segments(F.col("path")))
    paths = p.groupBy("host", "segs").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == 1).alias("good"),
                                          F.count_if(F.col("label") == 0).alias("bad"))
    found = templates(materialise(paths, "paths"), **params)
    text, action = matching_rule(rules)
    verdict = F.coalesce(action, F.when(F.col("purity") < purity, "block").otherwise("allow"))
    return p.join(found, ["host", "segs"], "left").select("id", "host", "path", text.alias("rule"), verdict.alias("verdict"), "template", "purity")

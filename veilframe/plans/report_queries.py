"""Queries over telemetry and capacity reports, and over augmentation."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe.functions import text as T
from veilframe.operators import augment as A
from veilframe.operators import corpus as C
from veilframe.operators import telemetry as M
from veilframe.plans.metric_queries import rounded
from veilframe.plans.registry import query
from veilframe.plans.text_queries import W, docs
from veilframe.session import materialise, table


def events(spark, sf):
    return table(spark, sf, "events").withColumn("day", F.dayofmonth("ts").cast("long"))


EV = "WITH ev AS (SELECT *, day(ts)::BIGINT AS day FROM events) "


@query("running_metric", "SELECT event_type, count(v) AS count, round(avg(v), 6) AS mean, max(v) AS max FROM (SELECT event_type, CASE WHEN user_id % 5 > 0 THEN value END AS v FROM events) GROUP BY 1")
def running_metric(spark, sf):
    e = events(spark, sf).withColumn("v", F.when(F.col("user_id") % 5 > 0, F.col("value")))
    return rounded(M.running_metric(e, "v", ["event_type"]))


@query("telemetry_rollup", EV + "SELECT event_type, day, count(value) AS count, round(avg(value), 6) AS mean, max(value) AS max FROM ev GROUP BY GROUPING SETS ((), (event_type), (day))")
def telemetry_rollup(spark, sf):
    """Two device rows per sample repeat the host value; they count once."""
    rows = events(spark, sf).withColumn("device", F.explode(F.array(F.lit(0), F.lit(1))))
    return rounded(M.rollup_samples(rows, "event_id", "event_type", "day", "value"))


@query("telemetry_devices", """SELECT d AS device, count(v) AS count, round(avg(v), 6) AS mean, max(v) AS max, count(*) FILTER (s = 'ok') AS ok, count(*) FILTER (s <> 'ok') AS not_ok
 FROM (SELECT d, CASE WHEN event_type <> 'error' THEN value * (d + 1) END AS v, CASE WHEN event_type = 'error' THEN 'failed' ELSE 'ok' END AS s FROM events, (SELECT unnest([0, 1]) AS d)) GROUP BY 1""")
def telemetry_devices(spark, sf):
    rows = events(spark, sf).withColumn("device", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = rows.withColumn("v", F.when(F.col("event_type") != "error", F.col("value") * (F.col("device") + 1)))
    return rounded(M.per_device(rows.withColumn("s", F.when(F.col("event_type") == "error", "failed").otherwise("ok")), "device", "v", "s"))


@query("weighted_throughput", "SELECT source, sum(n_chars)::BIGINT AS records, round(sum(doc_id % 7), 6)::DOUBLE AS seconds, round(sum(n_chars) / nullif(sum(doc_id % 7), 0), 6) AS records_per_second FROM documents GROUP BY 1")
def weighted_throughput(spark, sf):
    d = table(spark, sf, "documents").withColumn("sec", (F.col("doc_id") % 7).cast("double"))
    return rounded(M.throughput(d, ["source"], "n_chars", "sec"))


@query("latency_by_type", """SELECT event_type, count(value) AS count, round(avg(value), 6) AS mean, max(value) AS max, round(quantile_cont(value, 0.5), 6) AS p50,
 round(quantile_cont(value, 0.95), 6) AS p95, false AS approximate FROM events GROUP BY event_type""")
def latency_by_type(spark, sf):
    """Five groups whose size grows with the table, a fifth of all rows each."""
    return rounded(M.latency(table(spark, sf, "events"), "event_type", "value"))


@query("latency_summary", EV + "SELECT day, count(value) AS count, round(avg(value), 6) AS mean, max(value) AS max, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95, false AS approximate FROM ev GROUP BY day")
def latency_summary(spark, sf):
    return rounded(M.latency(events(spark, sf), "day", "value"))


RUNS = """WITH runs AS (SELECT 'd' || o_custkey % 5 AS device, o_custkey // 5 AS batch, o_totalprice AS rps, o_totalprice * 3 AS cps, o_orderkey AS rss, o_orderstatus <> 'P' AS valid, o_custkey % 2 AS chars, o_orderkey FROM orders),
 g AS (SELECT device, batch FROM runs GROUP BY 1, 2 HAVING count(*) = 8 AND (bool_and(valid) OR device < 'd3') AND count(DISTINCT chars) = 1) """


def runs(spark, sf):
    o = table(spark, sf, "orders")
    device = F.concat(F.lit("d"), (F.col("o_custkey") % 5).cast("string"))
    return o.select(device.alias("device"), F.floor(F.col("o_custkey") / 5).alias("batch"),
                    F.col("o_totalprice").alias("records_per_second"), (F.col("o_totalprice") * 3).alias("chars_per_second"),
                    F.col("o_orderkey").alias("peak_rss"), ((F.col("o_orderstatus") != "P") | (device < "d3")).alias("valid"),
                    (F.col("o_custkey") % 2).alias("chars"))


RANKED = RUNS + ", k AS (SELECT device, batch, round(median(rps), 4) AS records_per_second, round(median(cps), 4) AS chars_per_second, max(rss) AS peak_rss FROM runs JOIN g USING (device, batch) GROUP BY 1, 2) "


@query("rank_configs", RANKED + "SELECT * FROM k")
def rank_configs(spark, sf):
    return rounded(M.rank_configs(runs(spark, sf), ["device", "batch"], 8, ["chars"]), 4)


@query("best_config", RANKED + "SELECT device, batch, records_per_second FROM k QUALIFY row_number() OVER (PARTITION BY device ORDER BY records_per_second DESC, batch) = 1")
def best_config(spark, sf):
    return M.best_per_device(rounded(M.rank_configs(runs(spark, sf), ["device", "batch"], 8, ["chars"]), 4), "device", ["batch"])


@query("capacity", """SELECT c_custkey, round(s * 3600 * 20 * 0.8, 4) AS per_day, ceil(1e12 / 30 / (s * 3600 * 20 * 0.8))::BIGINT AS nodes_history, ceil(1e9 / (s * 3600 * 20 * 0.8))::BIGINT AS nodes_daily,
 ceil((1e12 / 30 + 1e9) / (s * 3600 * 20 * 0.8))::BIGINT AS nodes_both, greatest(1, ceil(36000 / (s * 0.5) / 3600))::BIGINT AS workers FROM (SELECT c_custkey, (1 + abs(c_acctbal))::DOUBLE AS s FROM customer)""")
def capacity(spark, sf):
    speed = 1 + F.abs("c_acctbal")
    c = table(spark, sf, "customer").select("c_custkey", M.capacity(speed, 10**12, 10**9).alias("c"), M.workers(speed, 36_000, 1, 0.5).alias("w"))
    return c.select("c_custkey", F.round("c.records_per_node_per_day", 4).alias("per_day"), "c.nodes_history", "c.nodes_daily", "c.nodes_both", "w.workers")


@query("stage_other", "SELECT event_id, round(greatest(0, value - (user_id + 1.5)), 6)::DOUBLE AS other FROM events")
def stage_other(spark, sf):
    return events(spark, sf).select("event_id", F.round(M.stage_other(F.col("value"), F.col("user_id").cast("double"), F.lit(1.5)), 6).alias("other"))


# augmentation ------------------------------------------------------------------------------

STOP = ["été", "à"]
AUG = f"""WITH t AS (SELECT doc_id, {W} AS w FROM documents), e AS (SELECT doc_id, w, list_filter(range(1, len(w) + 1), lambda i: w[i] NOT IN ('été', 'à') AND NOT regexp_matches(w[i], '[0-9]') AND NOT regexp_full_match(w[i], '[A-Za-z]+')) AS el FROM t),
 n AS (SELECT *, CASE WHEN len(w) = 0 THEN 0 ELSE least(greatest(least(ceil(len(w) * 0.1), 10), 1), floor(len(el) * 0.3)) END::BIGINT AS n FROM e),
 c AS (SELECT doc_id, w, n, list_transform(list_sort(list_transform(el, lambda i: md5('5:' || doc_id || ':' || (i - 1)) || ':' || i))[1:n], lambda s: string_split(s, ':')[2]::BIGINT) AS chosen FROM n) """


def chosen(spark, sf):
    t = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("w")).withColumn("el", A.eligible(F.col("w"), STOP))
    n = A.how_many(F.size("w"), F.size("el"))
    return t.withColumn("n", n).withColumn("chosen", A.choose(F.col("el"), F.col("n"), F.col("doc_id"), 5))


def md5_of(col):
    return F.md5(F.array_join(col, " ")).alias("md5")


@query("augment_eligible", AUG + "SELECT doc_id, len(list_filter(chosen, lambda i: i > 0))::BIGINT AS n, array_to_string(list_sort(list_transform(chosen, lambda i: i - 1)), ',') AS chosen FROM c")
def augment_eligible(spark, sf):
    c = chosen(spark, sf)
    return c.select("doc_id", F.size("chosen").cast("long").alias("n"), F.array_join(F.transform("chosen", lambda i: i.cast("string")), ",").alias("chosen"))


@query("augment_delete", AUG + "SELECT doc_id, md5(array_to_string(list_filter(w, lambda x, i: NOT list_contains(chosen, i)), ' ')) AS md5 FROM c")
def augment_delete(spark, sf):
    return chosen(spark, sf).select("doc_id", md5_of(A.delete(F.col("w"), F.col("chosen"))))


@query("augment_swap", AUG + """, p AS (SELECT doc_id, w, list_filter(range(1, len(w)), lambda i: w[i] NOT IN ('été', 'à') AND NOT regexp_full_match(w[i], '[0-9]+|[A-Za-z]+') AND w[i + 1] NOT IN ('été', 'à') AND NOT regexp_full_match(w[i + 1], '[0-9]+|[A-Za-z]+')) AS el FROM t),
 s AS (SELECT doc_id, w, CASE WHEN len(el) >= 4 THEN string_split(list_sort(list_transform(el, lambda i: md5('6:' || doc_id || ':' || (i - 1)) || ':' || i))[1], ':')[2]::BIGINT ELSE 0 END AS i FROM p)
 SELECT doc_id, md5(array_to_string(CASE WHEN i = 0 THEN w ELSE w[1:i - 1] || [w[i + 1], w[i]] || w[i + 2:] END, ' ')) AS md5 FROM s""")
def augment_swap(spark, sf):
    t = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("w")).withColumn("el", A.eligible_pairs(F.col("w"), STOP))
    one = A.how_many(F.size("w"), F.size("el"), fixed=1)
    t = t.withColumn("at", A.choose(F.col("el"), one, F.col("doc_id"), 6))
    return t.select("doc_id", md5_of(A.swap(F.col("w"), F.col("at"))))


def dictionary(spark, sf):
    w = docs(spark, sf).select(F.explode(T.words(F.col("text"))).alias("token")).distinct()
    return w.where(F.col("token").contains("é")).select("token", F.array(F.translate("token", "é", "e")).alias("options"))


@query("augment_substitute", AUG + "SELECT doc_id, md5(array_to_string(list_transform(w, lambda x, i: CASE WHEN list_contains(chosen, i) THEN replace(x, 'é', 'e') ELSE x END), ' ')) AS md5 FROM c")
def augment_substitute(spark, sf):
    out = A.change(chosen(spark, sf).select("doc_id", "w", "chosen"), "doc_id", "w", "chosen", dictionary(spark, sf), 21, "new")
    return out.select("doc_id", md5_of(F.col("new")))


COIN = "(('0x' || substr(md5('22:' || doc_id || ':' || (i - 1)), 1, 8))::BIGINT / 4294967296.0 < 0.5)"


@query("augment_insert", AUG + f"""SELECT doc_id, md5(array_to_string(list_transform(w, lambda x, i: CASE WHEN list_contains(chosen, i) AND contains(x, 'é') THEN
 CASE WHEN {COIN} THEN replace(x, 'é', 'e') || ' ' || x ELSE x || ' ' || replace(x, 'é', 'e') END ELSE x END), ' ')) AS md5 FROM c""")
def augment_insert(spark, sf):
    out = A.change(chosen(spark, sf).select("doc_id", "w", "chosen"), "doc_id", "w", "chosen", dictionary(spark, sf), 21, "new", insert=True)
    return out.select("doc_id", md5_of(F.col("new")))


@query("augment_random", AUG + "SELECT doc_id, len(w)::BIGINT AS words, (SELECT count(DISTINCT u) FROM (SELECT unnest(w) AS u FROM t))::BIGINT AS vocab FROM c")
def augment_random(spark, sf):
    """Chosen tokens replaced by random vocabulary words: lengths stay, every new word is known."""
    c = materialise(chosen(spark, sf).select("doc_id", "w", "chosen"), "chosen")
    vocab = materialise(c.select(F.explode("w").alias("token")).distinct(), "vocabulary")
    picked = c.select(F.explode(F.transform("chosen", lambda i: F.get("w", i))).alias("token"))
    out = materialise(A.change(c, "doc_id", "w", "chosen", A.random_dictionary(picked, vocab, 8), 21, "new").select("doc_id", "new"), "new")
    both = out.select(F.explode("new").alias("token")).distinct().union(vocab).distinct().agg(F.count("*").alias("vocab"))
    return out.select("doc_id", F.size("new").cast("long").alias("words")).join(F.broadcast(both))


@query("augment_tfidf", AUG + "SELECT doc_id, n AS picked FROM c WHERE n > 0")
def augment_tfidf(spark, sf):
    """Positions drawn in proportion to TF-IDF; every draw is an eligible position, none twice."""
    at = F.explode(F.transform("el", lambda i: F.struct(i.alias("pos"), F.get("w", i).alias("token"))))
    pos = materialise(chosen(spark, sf).select("doc_id", "n", at.alias("x")).select("doc_id", "n", "x.*"), "positions")
    weights = C.tf_idf(pos, "doc_id", "token").select("doc_id", "token", "tfidf")
    out = A.weighted_choice(pos.join(weights, ["doc_id", "token"]), "doc_id", "pos", "tfidf", "n", 31)
    return out.where(F.size("positions") > 0).select("doc_id", F.size(F.array_distinct("positions")).cast("long").alias("picked"))


@query("augment_variants", f"""WITH t AS (SELECT conv_id, turn, {W} AS w FROM conversations), v AS (SELECT conv_id, turn, w, v, string_split(list_sort(list_transform(range(1, len(w) + 1), lambda i: md5('6:' || conv_id || ':' || turn || '-' || v || ':' || (i - 1)) || ':' || i))[1], ':')[2]::BIGINT AS i FROM t, (SELECT unnest(range(3)) AS v) WHERE len(w) > 0)
 SELECT conv_id, turn, count(DISTINCT array_to_string(list_filter(w, lambda x, k: k <> i), ' ')) AS kinds FROM v GROUP BY 1, 2""")
def augment_variants(spark, sf):
    """Three single deletions per text; equal results count once."""
    c = table(spark, sf, "conversations").select("conv_id", "turn", F.concat_ws(":", "conv_id", "turn").alias("id"), T.words(F.col("text")).alias("w")).where(F.size("w") > 0)
    v = A.variants(c, "id", 3)
    at = A.choose(F.sequence(F.lit(0), F.size("w") - 1), F.lit(1), F.col("vkey"), 6)
    v = v.withColumn("new", F.array_join(A.delete(F.col("w"), at), " ")).withColumn("old", F.array_join("w", " "))
    return A.distinct_variants(v, "id", "new", "old").groupBy("conv_id", "turn").agg(F.count("*").alias("kinds"))

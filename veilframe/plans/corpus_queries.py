"""Queries over corpus preparation: vocabulary, TF-IDF, samples, blends, packs, masks."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veilframe.functions import text as T
from veilframe.operators import corpus as C
from veilframe.operators.ordering import row_index_by_id
from veilframe.plans.registry import query
from veilframe.plans.text_queries import IDS, W, docs, ids
from veilframe.session import fresh_path, materialise, table

TOK = f"WITH w AS (SELECT doc_id, unnest({W}) AS token FROM documents) "
SIZED = f"""WITH t AS (SELECT doc_id, {IDS} AS ids FROM documents), s AS (SELECT doc_id, ids, len(ids)::BIGINT AS n,
 coalesce(sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM t) """


def tokens(spark, sf):
    return docs(spark, sf).select("doc_id", F.explode(T.words(F.col("text"))).alias("token"))


def corpus(spark, sf):
    return docs(spark, sf).select("doc_id", ids().alias("tokens"))


@query("vocab_build", TOK + """, c AS (SELECT token, count(*) AS freq FROM w GROUP BY 1 HAVING count(*) >= 3),
 r AS (SELECT token, freq, row_number() OVER (ORDER BY freq DESC, token) + 1 AS id FROM c)
 SELECT token, freq, id FROM r UNION ALL SELECT * FROM (VALUES ('[PAD]', 0, 0), ('[UNK]', 0, 1))""")
def vocab_build(spark, sf):
    return C.build_vocab(tokens(spark, sf), "token", min_freq=3, special=["[PAD]", "[UNK]"])


@query("tf_idf", TOK + """, c AS (SELECT doc_id, token, count(*) AS n FROM w GROUP BY 1, 2),
 d AS (SELECT token, count(*) AS df FROM c GROUP BY 1), t AS (SELECT doc_id, sum(n) AS total FROM c GROUP BY 1)
 SELECT doc_id, round(sum(n / total * ln((SELECT count(*) FROM t) / df)), 5) AS mass,
 round(max(n / total * ln((SELECT count(*) FROM t) / df)), 6) AS top FROM c JOIN d USING (token) JOIN t USING (doc_id) GROUP BY doc_id""")
def tf_idf(spark, sf):
    # the texts are moved once, before they are tokens
    words = docs(spark, sf).repartition("doc_id").select("doc_id", F.explode(T.words(F.col("text"))).alias("token"))
    t = C.tf_idf(words, "doc_id", "token")
    return t.groupBy("doc_id").agg(F.round(F.sum("tfidf"), 5).alias("mass"), F.round(F.max("tfidf"), 6).alias("top"))


@query("corpus_totals", SIZED + """SELECT count(DISTINCT doc_id) * 2 AS docs, 2 * count(*) AS items, 2 * sum(n)::BIGINT AS tokens, round(avg(n), 6) AS avg_tokens FROM s""")
def corpus_totals(spark, sf):
    """Two shard files written and merged."""
    c = corpus(spark, sf)
    one = materialise(c.withColumn("mask", F.transform("tokens", lambda x: F.lit(1).cast("byte"))), "corpus")
    two = materialise(one.withColumn("doc_id", F.col("doc_id") + 10_000_000_000), "corpus")
    t = C.corpus_totals(one.unionByName(two))
    return t.withColumn("avg_tokens", F.round("avg_tokens", 6))


@query("corpus_slice", SIZED + "SELECT doc_id, array_to_string(ids[6:15], ',') AS part FROM s")
def corpus_slice(spark, sf):
    part = F.transform(F.slice("tokens", 6, 10), lambda x: x.cast("string"))
    return corpus(spark, sf).select("doc_id", F.array_join(part, ",").alias("part"))


@query("token_offsets", SIZED + "SELECT doc_id, start FROM s")
def token_offsets(spark, sf):
    c = corpus(spark, sf).select("doc_id", F.size("tokens").cast("long").alias("n"))
    return C.token_offsets(c, ["doc_id"], "n").select("doc_id", "start")


@query("causal_samples", SIZED + """, f AS (SELECT start + i - 1 AS pos, ids[i] AS id, doc_id FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM s)),
 x AS (SELECT (SELECT (sum(n) - 1) // 256 FROM s)::BIGINT AS m), p AS (SELECT pos // 256 AS sample, pos, id, doc_id FROM f UNION ALL
 SELECT pos // 256 - 1, pos, id, doc_id FROM f WHERE pos % 256 = 0 AND pos > 0)
 SELECT sample::BIGINT AS sample, md5(string_agg(id, ',' ORDER BY pos)) AS md5, count(*) AS n, count(DISTINCT doc_id) AS docs FROM p, x WHERE sample < m GROUP BY 1""")
def causal_samples(spark, sf):
    s = C.assemble_samples(corpus(spark, sf), ["doc_id"], "doc_id", "tokens", 256)
    return s.select("sample", F.md5(F.array_join(F.transform("tokens", lambda x: x.cast("string")), ",")).alias("md5"),
                    F.size("tokens").cast("long").alias("n"), F.size("docs").cast("long").alias("docs"))


@query("epochs_needed", SIZED + """, z AS (SELECT sum(n)::BIGINT AS total FROM s)
 SELECT total AS tokens, ((5000 * 256 + 1 + total - 1) // total)::BIGINT AS epochs FROM z""")
def epochs_needed(spark, sf):
    t = corpus(spark, sf).agg(F.sum(F.size("tokens")).alias("tokens"))
    return t.withColumn("epochs", F.lit(C.epochs_needed(5000, 256, t.first().tokens)).cast("long"))


@query("separate_last_epoch", SIZED + """, z AS (SELECT sum(n)::BIGINT AS t FROM s), e AS (SELECT t, (5000 * 256 + t) // t AS e FROM z)
 SELECT e::BIGINT AS epochs, (e > 1 AND 5000 - ((e - 1) * t - 1) // 256 < floor(0.8 * ((t - 1) // 256))) AS apart FROM e""")
def separate_last_epoch(spark, sf):
    total = corpus(spark, sf).agg(F.sum(F.size("tokens")).alias("tokens"))
    tokens = total.first().tokens
    epochs = C.epochs_needed(5000, 256, tokens)
    return total.select(F.lit(epochs).cast("long").alias("epochs"), F.lit(C.separate_last_epoch(epochs, tokens, 256, 5000)).alias("apart"))


@query("epoch_order", """SELECT doc_id, e AS epoch, row_number() OVER (ORDER BY e = 2, md5('7:' || e || ':' || doc_id), doc_id, e) - 1 AS position
 FROM documents, (SELECT unnest(range(3)) AS e)""")
def epoch_order(spark, sf):
    o = C.epoch_order(docs(spark, sf), "doc_id", 3, 7, separate_last=True)
    return o.select("doc_id", F.col("epoch").cast("long").alias("epoch"), "position")


@query("blend", """WITH z AS (SELECT count(*) // 2 AS size FROM documents), s AS (SELECT lang AS source, list(doc_id ORDER BY doc_id) AS ids,
 CASE lang WHEN 'en' THEN 0.5 WHEN 'fr' THEN 0.3 ELSE 0.2 END::DOUBLE AS w FROM documents WHERE lang IN ('en', 'fr', 'de') GROUP BY lang),
 k AS (SELECT source, ids, w, size, unnest(range(0, (ceil(size * w * 1.005) + 20)::BIGINT)) AS k FROM s, z)
 SELECT source, ids[k % len(ids) + 1] AS doc_id, row_number() OVER (ORDER BY (k + 0.5) / w, source, k) - 1 AS position FROM k QUALIFY position < any_value(size) OVER ()""")
def blend(spark, sf):
    """Half as many rows as there are documents; French and German have fewer than their share and are read again."""
    d = table(spark, sf, "documents").select("doc_id", "lang")
    parts = {x: d.where(F.col("lang") == x) for x in ("en", "fr", "de")}
    return C.blend(parts, {"en": 5, "fr": 3, "de": 2}, d.count() // 2, "doc_id").select("source", "doc_id", "position")


@query("budget_batches", """WITH RECURSIVE l AS (SELECT lang AS file, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS line_no, n_chars AS size FROM documents),
 r AS (SELECT file, line_no, size AS used, 1 AS rows, 0 AS batch FROM l WHERE line_no = 1 UNION ALL
 SELECT l.file, l.line_no, CASE WHEN r.rows >= 8 OR r.used + l.size > 200000 THEN l.size ELSE r.used + l.size END,
 CASE WHEN r.rows >= 8 OR r.used + l.size > 200000 THEN 1 ELSE r.rows + 1 END,
 CASE WHEN r.rows >= 8 OR r.used + l.size > 200000 THEN r.batch + 1 ELSE r.batch END FROM r JOIN l ON l.file = r.file AND l.line_no = r.line_no + 1)
 SELECT file, line_no, batch::BIGINT AS batch FROM r""")
def budget_batches(spark, sf):
    from veilframe.operators.ordering import running
    d = table(spark, sf, "documents").select(F.col("lang").alias("file"), "doc_id", F.col("n_chars").alias("size"), F.lit(1).alias("one"))
    lines = running(d, ["doc_id"], {"line_no": ("sum", "one")}, by=["file"])
    return C.budget_batches(lines, "file", "line_no", "size", 8, 200_000).select("file", "line_no", "batch")


@query("greedy_packs", f"""WITH t AS (SELECT doc_id, len({IDS})::BIGINT AS n FROM documents)
 SELECT count(*) AS rows_seen, count(*) FILTER (n <= 2048) AS packed, 0::BIGINT AS over_full, (sum(n) FILTER (n <= 2048))::BIGINT AS tokens FROM t""")
def greedy_packs(spark, sf):
    """Every fitting document lies in one pack and no pack exceeds its length; a thousand documents are packed together."""
    d = row_index_by_id(docs(spark, sf).select("doc_id", F.size(T.words(F.col("text"))).alias("n")), "doc_id")
    d = d.withColumn("batch", F.floor(F.col("row_idx") / 1000))
    p = C.greedy_packs(d, "row_idx", "n", 2048, "batch").join(d.drop("batch"), "row_idx")
    packs = p.groupBy("batch", "pack").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    kept = F.col("pack").isNotNull()
    return packs.agg(F.sum("rows").alias("rows_seen"), F.sum(F.when(kept, F.col("rows"))).alias("packed"),
                     F.count_if(kept & (F.col("n") > 2048)).alias("over_full"), F.sum(F.when(kept, F.col("n"))).alias("tokens"))


@query("assemble_packs", f"""WITH t AS (SELECT doc_id, {IDS} AS ids FROM documents), p AS (SELECT doc_id // 4 AS pack, doc_id, ids FROM t)
 SELECT pack, sum(len(ids))::BIGINT AS n, array_to_string(list(len(ids) ORDER BY doc_id), ',') AS lengths,
 sum(coalesce(list_sum(ids), 0))::BIGINT AS total FROM p GROUP BY pack""")
def assemble_packs(spark, sf):
    c = corpus(spark, sf).select(F.floor(F.col("doc_id") / 4).alias("pack"), "doc_id", F.col("tokens").alias("ids"))
    a = C.assemble_packs(c.withColumn("labels", F.col("ids")), ["pack"], "doc_id", "ids", "labels")
    total = F.aggregate("labels", F.lit(0), lambda s, x: s + x)
    return a.select("pack", F.size("input_ids").cast("long").alias("n"),
                    F.array_join(F.transform("segment_lengths", lambda x: x.cast("string")), ",").alias("lengths"), total.cast("long").alias("total"))


@query("balanced_partitions", """WITH r AS (SELECT n_chars, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS k FROM documents)
 SELECT CASE WHEN (k // 8) % 2 = 0 THEN k % 8 ELSE 7 - k % 8 END::BIGINT AS part, count(*) AS n, sum(n_chars)::BIGINT AS chars FROM r GROUP BY 1""")
def balanced_partitions(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    p = C.balanced_partitions(d, "doc_id", "n_chars", 8)
    return p.groupBy(F.col("part").cast("long").alias("part")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


@query("differenced_partitions", """WITH r AS (SELECT doc_id // 256 AS step, n_chars, row_number() OVER (PARTITION BY doc_id // 256 ORDER BY n_chars DESC, doc_id) - 1 AS k FROM documents),
 p AS (SELECT step, CASE WHEN (k // 8) % 2 = 0 THEN k % 8 ELSE 7 - k % 8 END AS part, sum(n_chars) AS chars, count(*) AS n FROM r GROUP BY 1, 2)
 SELECT step, sum(n)::BIGINT AS items, sum(chars)::BIGINT AS chars, count(*) AS parts, (max(chars) - min(chars))::BIGINT AS deal_spread, true AS no_worse FROM p GROUP BY 1""")
def differenced_partitions(spark, sf):
    """Eight parts of every 256 documents, never more uneven than the serpentine deal."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars", F.floor(F.col("doc_id") / 256).alias("step"))
    deal = Window.partitionBy("step").orderBy(F.desc("n_chars"), "doc_id")  # 256 rows at most
    k = F.row_number().over(deal) - 1
    d = d.withColumn("dealt", F.when(F.floor(k / 8) % 2 == 0, k % 8).otherwise(7 - k % 8))
    p = C.differenced_partitions(d, ["step"], "doc_id", "n_chars", 8, equal=False)
    spread = lambda part: p.groupBy("step", part).agg(F.sum("n_chars").alias("c"), F.count("*").alias("n")).groupBy("step").agg(
        F.sum("n").alias("items"), F.sum("c").alias("chars"), F.count("*").alias("parts"), (F.max("c") - F.min("c")).alias("spread"))
    both = spread("part").join(spread("dealt").select("step", F.col("spread").alias("deal_spread")), "step")
    return both.select("step", "items", "chars", "parts", "deal_spread", (F.col("spread") <= F.col("deal_spread")).alias("no_worse"))


@query("group_negatives", """WITH c AS (SELECT c_custkey, c_nationkey % 6 AS n FROM customer)
 SELECT c_custkey, CASE WHEN n = 0 THEN 0 ELSE 7 END::BIGINT AS picked, least(n, 7)::BIGINT AS kinds FROM c""")
def group_negatives(spark, sf):
    """Seven negatives from pools of 0 to 5; every pool member is used."""
    n = (F.col("c_nationkey") % 6).cast("int")
    c = table(spark, sf, "customer").select("c_custkey", F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>")).alias("neg"))
    g = C.group_negatives(c, "c_custkey", "neg", 8, 5)
    return g.select("c_custkey", F.size("selected").cast("long").alias("picked"), F.size(F.array_distinct("selected")).cast("long").alias("kinds"))


U = "(('0x' || substr(md5({s} || ':' || doc_id || ':' || (i - 1)), 1, 8))::BIGINT / 4294967296.0)"


@query("mask_tokens", f"""WITH t AS (SELECT doc_id, {IDS} AS ids FROM documents), e AS (SELECT doc_id, ids[i] AS x, i FROM (SELECT *, unnest(range(1, len(ids) + 1)) AS i FROM t)),
 u AS (SELECT *, ({U.format(s=3)} < 0.15 AND x NOT IN (1, 2)) AS c, {U.format(s=4)} AS how FROM e)
 SELECT doc_id, count(*) FILTER (c) AS selected, count(*) FILTER (c AND how < 0.8) AS masked, count(*) FILTER (c AND how >= 0.9) AS kept FROM u GROUP BY doc_id""")
def mask_tokens(spark, sf):
    c = corpus(spark, sf)
    m = c.select("doc_id", "tokens", C.mask_tokens(F.col("tokens"), F.col("doc_id"), [1, 2], 0.15, -1, 0, 3).alias("m"))
    e = m.select("doc_id", F.explode("m").alias("x"))
    label, new = F.col("x.label"), F.col("x.input")
    # vocab 0 makes every random replacement 0, an id no token has
    return e.groupBy("doc_id").agg(F.count_if(label != -100).alias("selected"), F.count_if(new == -1).alias("masked"),
                                   F.count_if((label != -100) & (new == label)).alias("kept"))


@query("whole_word_mask", f"""SELECT doc_id, greatest(1, round(2 * len({W}) * 0.15))::BIGINT // 2 AS words FROM documents""")
def whole_word_mask(spark, sf):
    """Every word split in two pieces: the quota fills with whole pairs only."""
    w = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("w"))
    pieces = F.flatten(F.transform("w", lambda x: F.array(x, F.concat(F.lit("##"), x))))
    out = w.select("doc_id", pieces.alias("p")).select("doc_id", "p", C.whole_word_mask(F.col("p"), F.col("doc_id"), 0.15, 11, 1_000_000).alias("at"))
    whole = F.size(F.filter("at", lambda i: i % 2 == 0))
    return out.select("doc_id", F.when(whole * 2 == F.size("at"), whole).cast("long").alias("words"))

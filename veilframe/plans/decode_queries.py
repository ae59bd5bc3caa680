"""Queries over decoding: segments, spans, n-best, votes, top-k, offsets, pooling."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe.functions import text as T
from veilframe.operators import decode as D
from veilframe.operators.rows import top_k
from veilframe.plans.registry import query
from veilframe.plans.text_queries import W, docs
from veilframe.session import table

# one tag per word by its length: 1-3 B, 4-6 I, more O
TAGS = f"""WITH w AS (SELECT doc_id, {W} AS ws FROM documents), e AS (SELECT doc_id, ws[i] AS w, i FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w)),
 t AS (SELECT doc_id, w, i, CASE WHEN length(w) <= 3 THEN 'B' WHEN length(w) <= 6 THEN 'I' ELSE 'O' END AS tag FROM e) """


def tagged(spark, sf):
    w = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("ws"))
    tag = F.transform("ws", lambda x: F.when(F.length(x) <= 3, "B").when(F.length(x) <= 6, "I").otherwise("O"))
    return w.select("doc_id", "ws", tag.alias("tags"))


@query("tag_segments", TAGS + """, s AS (SELECT *, sum(CASE WHEN i = 1 OR tag <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM t)
 SELECT doc_id, min(i) - 1 AS start, max(i) AS "end", first(tag ORDER BY i) AS label FROM s GROUP BY doc_id, seg""")
def tag_segments(spark, sf):
    s = tagged(spark, sf).select("doc_id", F.explode(D.segments(F.col("tags"))).alias("s"))
    return s.select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"), "s.label")


@query("suffix_tag_segments", TAGS + """, s AS (SELECT *, sum(CASE WHEN i = 1 OR tag <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM t),
 g AS (SELECT doc_id, seg, first(tag ORDER BY i) AS label FROM s GROUP BY doc_id, seg) SELECT doc_id, label, count(*) AS n FROM g GROUP BY 1, 2""")
def suffix_tag_segments(spark, sf):
    t = tagged(spark, sf)
    tags = F.transform("tags", lambda x: F.concat(x, F.when(x == "I", "-I").otherwise("-B")))
    s = t.select("doc_id", F.explode(D.suffix_segments(tags)).alias("s"))
    return s.groupBy("doc_id", "s.label").agg(F.count("*").alias("n"))


@query("bio_spans", TAGS + """, s AS (SELECT *, sum(CASE WHEN tag <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM t)
 SELECT doc_id, min(i) - 1 AS start, max(i) - 1 AS "end" FROM s WHERE seg > 0 GROUP BY doc_id, seg HAVING first(tag ORDER BY i) = 'B'""")
def bio_spans(spark, sf):
    s = tagged(spark, sf).select("doc_id", F.explode(D.bio_spans(F.col("tags"))).alias("s"))
    return s.select("doc_id", F.col("s.start").cast("long").alias("start"), F.col("s.end").cast("long").alias("end"))


@query("span_pairing", """WITH o AS (SELECT DISTINCT l_orderkey AS k, l_partkey AS pos, 0 AS kind FROM lineitem WHERE l_returnflag = 'R' UNION
 SELECT DISTINCT l_orderkey, l_partkey + 50, 1 FROM lineitem WHERE l_returnflag = 'A'),
 w AS (SELECT *, min(CASE WHEN kind = 1 THEN pos END) OVER (PARTITION BY k ORDER BY pos, kind ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM o)
 SELECT k, max(pos) AS start, e AS "end" FROM w WHERE kind = 0 AND e IS NOT NULL GROUP BY k, e""")
def span_pairing(spark, sf):
    li = table(spark, sf, "lineitem")
    pos = lambda flag, c: F.collect_set(F.when(F.col("l_returnflag") == flag, c))  # lines of one order
    g = li.groupBy(F.col("l_orderkey").alias("k")).agg(pos("R", F.col("l_partkey")).alias("s"), pos("A", F.col("l_partkey") + 50).alias("e"))
    p = g.select("k", F.explode(D.pair_spans(F.col("s"), F.col("e"))).alias("p"))
    return p.select("k", "p.start", "p.end")


@query("token_at_offset", """WITH o AS (SELECT doc_id, lower(text) AS t, n_chars // 2 AS o FROM documents)
 SELECT doc_id, CASE WHEN regexp_matches(substr(t, o + 1, 1), '[0-9a-zà-ÿ]') THEN len(regexp_extract_all(substr(t, 1, o + 1), '[0-9a-zà-ÿ]+')) - 1 ELSE -1 END::BIGINT AS tok FROM o""")
def token_at_offset(spark, sf):
    from veilframe.functions.spans import regex_spans
    d = docs(spark, sf, "n_chars").withColumn("t", F.lower("text"))
    d = d.select("doc_id", "n_chars", regex_spans(F.col("t"), "[0-9a-zà-ÿ]+", "", "raw").alias("sp"))
    return d.select("doc_id", D.token_at(F.col("sp"), F.floor(F.col("n_chars") / 2)).cast("long").alias("tok"))


LOGITS = """WITH l AS (SELECT vec_id, i - 1 AS pos, embedding[i]::DOUBLE AS s, embedding[65 - i]::DOUBLE AS e FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)),
 st AS (SELECT vec_id, pos, s FROM l QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, pos) <= 8),
 en AS (SELECT vec_id, pos, e FROM l QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY e DESC, pos) <= 8),
 p AS (SELECT st.vec_id, st.pos AS start, en.pos AS "end", s + e AS score FROM st JOIN en USING (vec_id) WHERE en.pos >= st.pos AND en.pos - st.pos + 1 <= 30),
 b AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, start, "end") AS rank FROM p QUALIFY rank <= 5) """


def logits(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    e = v.select("vec_id", F.posexplode(F.arrays_zip(F.col("v").alias("s"), F.reverse("v").alias("e"))).alias("pos", "x"))
    return e.select("vec_id", F.lit(0).alias("win"), F.col("pos").cast("long").alias("pos"),
                    F.col("x.s").alias("start_logit"), F.col("x.e").alias("end_logit"))


@query("n_best", LOGITS + """SELECT vec_id, start, "end", rank, round(exp(score) / sum(exp(score)) OVER (PARTITION BY vec_id), 6) AS probability FROM b""")
def n_best(spark, sf):
    b = D.n_best(logits(spark, sf), "vec_id", "win", 8, 30, 5)
    return b.select("vec_id", "start", "end", F.col("rank").cast("long").alias("rank"), F.round("probability", 6).alias("probability"))


@query("null_answers", LOGITS + """, z AS (SELECT vec_id, s + e AS null_score FROM l WHERE pos = 0)
 SELECT vec_id, round(null_score - score, 6) AS score_diff, null_score - score > -0.3 AS is_null FROM b JOIN z USING (vec_id) WHERE rank = 1""")
def null_answers(spark, sf):
    lg = logits(spark, sf)
    null = lg.where("pos = 0").select("vec_id", (F.col("start_logit") + F.col("end_logit")).alias("null_score"))
    a = D.with_null_answers(D.n_best(lg, "vec_id", "win", 8, 30, 5), null, "vec_id", -0.3)
    return a.select("vec_id", F.round("score_diff", 6).alias("score_diff"), "is_null")


@query("top_positions", """SELECT vec_id, i - 1 AS pos, round(embedding[i]::DOUBLE, 6) AS score FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)
 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) <= 4""")
def top_positions(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.explode(D.top_positions(F.col("embedding"), 4)).alias("x"))
    return e.select("vec_id", F.col("x.pos").cast("long").alias("pos"), F.round(F.col("x.score").cast("double"), 6).alias("score"))


@query("best_paths", """WITH a AS (SELECT vec_id, i - 1 AS p, embedding[i]::DOUBLE AS s FROM (SELECT *, unnest(range(1, 33)) AS i FROM embeddings) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) <= 3),
 b AS (SELECT vec_id, i - 33 AS p, embedding[i]::DOUBLE AS s FROM (SELECT *, unnest(range(33, 65)) AS i FROM embeddings) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY embedding[i] DESC, i) <= 3)
 SELECT vec_id, a.p || '-' || b.p AS path, round(a.s + b.s, 6) AS score FROM a JOIN b USING (vec_id) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY a.s + b.s DESC, a.p, b.p) <= 3""")
def best_paths(spark, sf):
    half = lambda lo: F.transform(F.slice("embedding", lo, 32), lambda x: x.cast("double"))
    paths = D.best_paths([D.top_positions(half(1), 3), D.top_positions(half(33), 3)], 3)
    e = table(spark, sf, "embeddings").select("vec_id", F.explode(paths).alias("x"))
    return e.select("vec_id", F.array_join(F.transform("x.path", lambda p: p.cast("string")), "-").alias("path"), F.round("x.score", 6).alias("score"))


@query("max_context", """WITH d AS (SELECT doc_id, (n_chars // 2)::BIGINT AS pos, n_chars FROM documents), s AS (SELECT *, unnest(range(0, greatest(n_chars - 100, 0) + 1, 50)) AS start FROM d),
 z AS (SELECT doc_id, pos, start // 50 AS w, start, least(100, n_chars - start) AS len FROM s WHERE start <= pos AND pos < start + least(100, n_chars - start))
 SELECT doc_id, first(w ORDER BY least(pos - start, start + len - 1 - pos) + 0.01 * len DESC, w)::BIGINT AS w FROM z GROUP BY doc_id""")
def max_context(spark, sf):
    n = F.col("n_chars").cast("int")
    starts = F.sequence(F.lit(0), F.greatest(n - 100, F.lit(0)), F.lit(50))
    spans = F.transform(starts, lambda s: F.struct(s.alias("start"), F.least(F.lit(100), n - s).alias("length")))
    d = docs(spark, sf, "n_chars").select("doc_id", D.max_context(spans, F.floor(n / 2).cast("int")).cast("long").alias("w"))
    return d.where("w is not null")


@query("rebase_offsets", """WITH c AS (SELECT doc_id, i AS chunk, substr(text, i * 300 + 1, 300) AS c FROM (SELECT doc_id, text, unnest(range((greatest(length(text), 1) + 299) // 300)) AS i FROM documents)),
 b AS (SELECT *, coalesce(sum(length(c)) OVER (PARTITION BY doc_id ORDER BY chunk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM c)
 SELECT doc_id, (instr(c, '.') - 1 + base)::BIGINT AS start, (instr(c, '.') + base)::BIGINT AS "end" FROM b WHERE instr(c, '.') > 0""")
def rebase_offsets(spark, sf):
    c = docs(spark, sf).select("doc_id", F.posexplode(T.chunks(F.col("text"), 300)).alias("chunk", "c"))
    items = c.withColumn("at", F.instr("c", ".")).where("at > 0").select(
        "doc_id", "chunk", (F.col("at") - 1).cast("long").alias("start"), F.col("at").cast("long").alias("end"))
    sizes = c.select("doc_id", "chunk", F.length("c").cast("long").alias("n"))
    return D.rebase(sizes, "doc_id", "chunk", "n", items).select("doc_id", "start", "end")


@query("softmax_argmax", """SELECT vec_id, list_position(embedding, list_max(embedding))::BIGINT - 1 AS label,
 round(1 / list_sum(list_transform(embedding, lambda x: exp(x::DOUBLE - list_max(embedding)::DOUBLE))), 6) AS p FROM embeddings""")
def softmax_argmax(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return e.select("vec_id", D.argmax(F.col("v")).alias("label"), F.round(F.array_max(D.softmax(F.col("v"))), 6).alias("p"))


@query("sigmoid_labels", """SELECT vec_id, count(*) FILTER (1 / (1 + exp(-embedding[i]::DOUBLE)) > 0.55) AS labels FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings) GROUP BY vec_id""")
def sigmoid_labels(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return e.select("vec_id", F.size(D.sigmoid_labels(F.col("v"), 0.55)).cast("long").alias("labels"))


@query("chunk_vote", """WITH t AS (SELECT user_id, event_type, count(*) AS n, sum(value) AS p FROM events GROUP BY 1, 2)
 SELECT user_id, event_type, n AS votes, round(p / n, 4) AS probability FROM t QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, p DESC, event_type DESC) = 1""")
def chunk_vote(spark, sf):
    return D.vote(table(spark, sf, "events"), "user_id", "event_type", "value").withColumn("probability", F.round("probability", 4))


@query("pool_vectors", """WITH x AS (SELECT label, vec_id, i, embedding[i]::DOUBLE AS v FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings))
 SELECT label, i::BIGINT - 1 AS dim, round(avg(v), 6) AS mean, round(max(v), 6) AS max, round(first(v ORDER BY vec_id), 6) AS first, round(sum(v) / sqrt(count(*)), 6) AS mean_sqrt_len FROM x GROUP BY 1, 2""")
def pool_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    out = None
    for how in ("mean", "max", "first", "mean_sqrt_len"):
        p = D.pool(e, "label", "vec_id", "embedding", how, 64).select("label", F.posexplode("pooled").alias("dim", how))
        p = p.select("label", F.col("dim").cast("long").alias("dim"), F.round(how, 6).alias(how))
        out = p if out is None else out.join(p, ["label", "dim"])
    return out


@query("label_word_scores", """WITH w AS (SELECT user_id, event_type, event_id % 2 AS mask, event_id % 3 AS word, avg(value) / 100 AS s FROM events GROUP BY 1, 2, 3, 4),
 m AS (SELECT user_id, event_type, mask, max(s) AS s FROM w GROUP BY 1, 2, 3), l AS (SELECT user_id, event_type, exp(sum(ln(s))) AS s FROM m GROUP BY 1, 2)
 SELECT user_id, event_type, round(s, 4) AS score, round(exp(s) / sum(exp(s)) OVER (PARTITION BY user_id), 4) AS probability FROM l""")
def label_word_scores(spark, sf):
    e = table(spark, sf, "events").select("user_id", "event_type", (F.col("event_id") % 3).alias("word"), (F.col("event_id") % 2).alias("mask"), "value")
    s = D.label_scores(e.withColumn("value", F.col("value") / 100), "user_id", "event_type", "word", "mask", "value", words="max", masks="product")
    return s.select("user_id", "event_type", F.round("score", 4).alias("score"), F.round("probability", 4).alias("probability"))

"""Queries over evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe.functions import text as T
from veilframe.operators import decode as D
from veilframe.operators import metrics as M
from veilframe.plans.decode_queries import TAGS, tagged
from veilframe.plans.registry import query
from veilframe.plans.text_queries import W, docs
from veilframe.session import table


def rounded(df, n=6):
    return df.select(*[F.round(c, n).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def turns(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", T.words(F.col("text")).alias("cand"))
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("cand").alias("ref"))
    return c.join(nxt, ["conv_id", "turn"]).withColumn("id", F.concat_ws("-", "conv_id", "turn"))


PAIRS = f"""WITH c AS (SELECT conv_id, turn, {W} AS cand FROM conversations),
 p AS (SELECT a.conv_id, a.turn, a.cand, b.cand AS ref FROM c a JOIN c b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1) """
GRAMS = """ g AS (SELECT conv_id, turn, k, unnest(list_transform(range(1, greatest(len(cand) - k + 2, 1)), lambda i: array_to_string(cand[i:i + k - 1], ' '))) AS gram FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)),
 h AS (SELECT conv_id, turn, k, unnest(list_transform(range(1, greatest(len(ref) - k + 2, 1)), lambda i: array_to_string(ref[i:i + k - 1], ' '))) AS gram FROM p, (SELECT unnest([1, 2, 3, 4]) AS k)),
 gc AS (SELECT conv_id, turn, k, gram, count(*) AS n FROM g GROUP BY ALL), hc AS (SELECT conv_id, turn, k, gram, count(*) AS n FROM h GROUP BY ALL),
 m AS (SELECT gc.k, sum(gc.n) AS total, sum(least(gc.n, coalesce(hc.n, 0))) AS hit FROM gc LEFT JOIN hc USING (conv_id, turn, k, gram) GROUP BY gc.k),
 l AS (SELECT sum(len(cand)) AS c, sum(len(ref)) AS r FROM p) """


@query("bleu_4", PAIRS + "," + GRAMS + """SELECT round(exp(least(1 - any_value(r) / any_value(c), 0)) * exp(sum(ln(CASE WHEN hit = 0 THEN 2.2250738585072014e-308 ELSE hit / total END) / 4)), 6) AS bleu FROM m, l""")
def bleu_4(spark, sf):
    return rounded(M.bleu(turns(spark, sf).withColumn("refs", F.array("ref")), "cand", "refs"))


@query("bleu_yes_no_bonus", PAIRS + "," + GRAMS + """, mb AS (SELECT gc.k, sum(least(gc.n, coalesce(hc.n, 0))) FILTER (conv_id % 2 = 0) AS b FROM gc LEFT JOIN hc USING (conv_id, turn, k, gram) GROUP BY gc.k)
 SELECT round(exp(least(1 - any_value(r) / any_value(c), 0)) * exp(sum(ln(CASE WHEN hit + 0.5 * b = 0 THEN 2.2250738585072014e-308 ELSE (hit + 0.5 * b) / (total + 0.5 * b) END) / 4)), 6) AS bleu FROM m JOIN mb USING (k), l""")
def bleu_yes_no_bonus(spark, sf):
    """Labelled n-grams count again where candidate and reference carry the same answer label."""
    t = turns(spark, sf).withColumn("refs", F.array("ref")).withColumn("yes", F.lit("Yes"))
    t = t.withColumn("ref_labels", F.array(F.when(F.col("conv_id") % 2 == 0, "Yes").otherwise("No")))
    return rounded(M.bleu(t, "cand", "refs", bonus=("yes", "ref_labels"), alpha=0.5))


def rouge_sql(k):
    gr = lambda c: f"list_distinct(list_transform(range(1, greatest(len({c}) - {k} + 2, 1)), lambda i: array_to_string({c}[i:i + {k} - 1], ' ')))"
    return PAIRS + f"SELECT round(sum(len(list_intersect({gr('cand')}, {gr('ref')}))) / sum(len({gr('ref')})), 6) AS rouge FROM p"


@query("rouge_1", rouge_sql(1))
def rouge_1(spark, sf):
    return rounded(M.rouge_n(turns(spark, sf), "cand", "ref", 1))


@query("rouge_2", rouge_sql(2))
def rouge_2(spark, sf):
    return rounded(M.rouge_n(turns(spark, sf), "cand", "ref", 2))


HALF = f"""WITH h AS (SELECT doc_id, len({W})::DOUBLE AS r, ((len({W}) + 1) // 2)::DOUBLE AS c FROM documents WHERE len({W}) > 0) """


def halves(spark, sf):
    w = docs(spark, sf, "lang").select("doc_id", "lang", T.words(F.col("text")).alias("ref")).where(F.size("ref") > 0)
    return w.withColumn("cand", F.filter("ref", lambda x, i: i % 2 == 0))


@query("rouge_l", HALF + "SELECT round(avg((1 + 1.44) * (c / r) / (c / r + 1.44)), 6) AS rouge_l FROM h")
def rouge_l(spark, sf):
    """Candidate: every second word of the reference, so precision is 1 and recall is known."""
    return rounded(M.rouge_l(halves(spark, sf), "doc_id", "cand", "ref"))


@query("rouge_l_bonus", HALF + "SELECT round(avg((1 + 1.44) * ((c + 3) / (r + 3)) / ((c + 3) / (r + 3) + 1.44)), 6) AS rouge_l FROM h")
def rouge_l_bonus(spark, sf):
    return rounded(M.rouge_l(halves(spark, sf).withColumn("x", F.lit(3.0)), "doc_id", "cand", "ref", bonus="x"))


@query("distinct_2", f"""WITH w AS (SELECT {W} AS w FROM conversations), g AS (SELECT unnest(list_transform(range(1, greatest(len(w), 1)), lambda i: w[i] || ' ' || w[i + 1])) AS g FROM w)
 SELECT round(count(DISTINCT g) / count(g), 6) AS "distinct" FROM g""")
def distinct_2(spark, sf):
    c = table(spark, sf, "conversations").select(T.words(F.col("text")).alias("w"))
    return rounded(M.distinct_n(c, "w", 2))


@query("distinct_3_corpus", f"""WITH w AS (SELECT {W} AS w FROM documents), g AS (SELECT unnest(list_transform(range(1, greatest(len(w) - 1, 1)), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS g FROM w)
 SELECT round(count(DISTINCT g) / count(g), 6) AS "distinct" FROM g""")
def distinct_3_corpus(spark, sf):
    return rounded(M.distinct_n(docs(spark, sf).select(T.words(F.col("text")).alias("w")), "w", 3))


@query("chunk_f1", TAGS + """, u AS (SELECT doc_id, i, w, tag, CASE WHEN i % 5 = 0 THEN 'O' ELSE tag END AS ptag FROM t),
 sg AS (SELECT doc_id, tag, i, sum(CASE WHEN tag <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM u),
 sp AS (SELECT doc_id, ptag, i, sum(CASE WHEN ptag <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY i) AS seg FROM u),
 g AS (SELECT doc_id, min(i) AS s, max(i) AS e FROM sg WHERE seg > 0 GROUP BY doc_id, seg HAVING first(tag ORDER BY i) = 'B'),
 p AS (SELECT doc_id, min(i) AS s, max(i) AS e FROM sp WHERE seg > 0 GROUP BY doc_id, seg HAVING first(ptag ORDER BY i) = 'B'),
 c AS (SELECT (SELECT count(*) FROM g) AS ng, (SELECT count(*) FROM p) AS np, (SELECT count(*) FROM (SELECT * FROM g INTERSECT SELECT * FROM p)) AS h)
 SELECT round(h / np, 6) AS precision, round(h / ng, 6) AS recall, round(2 * (h / np) * (h / ng) / (h / np + h / ng), 6) AS f1 FROM c""")
def chunk_f1(spark, sf):
    t = tagged(spark, sf)
    t = t.withColumn("ptags", F.transform("tags", lambda x, i: F.when((i + 1) % 5 == 0, "O").otherwise(x)))
    t = t.select(D.bio_spans(F.col("tags")).alias("g"), D.bio_spans(F.col("ptags")).alias("p"))
    return rounded(M.prf(t, M.same_spans(F.col("g"), F.col("p")), F.size("p"), F.size("g")))


@query("span_f1", """WITH v AS (SELECT vec_id, i - 1 AS pos, embedding[i] AS a, embedding[65 - i] AS b FROM (SELECT *, unnest(range(1, 65)) AS i FROM embeddings)),
 o AS (SELECT vec_id, 0 AS side, pos, 0 AS kind FROM v WHERE a > 0.1::FLOAT UNION ALL SELECT vec_id, 0, pos, 1 FROM v WHERE b > 0.1::FLOAT UNION ALL
 SELECT vec_id, 1, pos, 0 FROM v WHERE a > 0.12::FLOAT UNION ALL SELECT vec_id, 1, pos, 1 FROM v WHERE b > 0.12::FLOAT),
 w AS (SELECT *, min(CASE WHEN kind = 1 THEN pos END) OVER (PARTITION BY vec_id, side ORDER BY pos, kind ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS e FROM o),
 s AS (SELECT vec_id, side, max(pos) AS s, e FROM w WHERE kind = 0 AND e IS NOT NULL GROUP BY vec_id, side, e),
 n AS (SELECT vec_id, greatest(count(*) FILTER (kind = 0), count(*) FILTER (kind = 1)) AS n FROM o WHERE side = 0 GROUP BY 1),
 c AS (SELECT (SELECT sum(n) FROM n) AS ng, (SELECT count(*) FROM s WHERE side = 1) AS np, (SELECT count(*) FROM (SELECT vec_id, s, e FROM s WHERE side = 0 INTERSECT SELECT vec_id, s, e FROM s WHERE side = 1)) AS h)
 SELECT round(h / np, 6) AS precision, round(h / ng, 6) AS recall, round(2 * (h / np) * (h / ng) / (h / np + h / ng), 6) AS f1 FROM c""")
def span_f1(spark, sf):
    v = table(spark, sf, "embeddings").withColumn("rev", F.reverse("embedding"))
    over = lambda c, t: F.filter(F.transform(c, lambda x, i: F.when(x > F.lit(t).cast("float"), i)), lambda i: i.isNotNull())
    s = v.select(over("embedding", 0.1).alias("gs"), over("rev", 0.1).alias("ge"), over("embedding", 0.12).alias("ps"), over("rev", 0.12).alias("pe"))
    s = s.select(D.pair_spans(F.col("gs"), F.col("ge")).alias("g"), D.pair_spans(F.col("ps"), F.col("pe")).alias("p"),
                 F.greatest(F.size("gs"), F.size("ge")).alias("n"))
    return rounded(M.prf(s, M.same_spans(F.col("g"), F.col("p")), F.size("p"), F.col("n")))


PRED = """WITH x AS (SELECT l.quality AS g, CAST(d.n_chars > 500 AS INT) AS p FROM labels l JOIN documents d USING (doc_id)),
 c AS (SELECT count(*) FILTER (g = 1 AND p = 1)::DOUBLE AS tp, count(*) FILTER (g = 0 AND p = 1)::DOUBLE AS fp, count(*) FILTER (g = 0 AND p = 0)::DOUBLE AS tn, count(*) FILTER (g = 1 AND p = 0)::DOUBLE AS fn FROM x) """


def quality(spark, sf):
    return table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "n_chars"), "doc_id").select(
        "doc_id", F.col("quality").alias("g"), (F.col("n_chars") > 500).cast("int").alias("p"))


@query("accuracy_f1", PRED + """, r AS (SELECT (tp + tn) / (tp + fp + tn + fn) AS a, tp / (tp + fp) AS p, tp / (tp + fn) AS r FROM c)
 SELECT round(a, 6) AS accuracy, round(p, 6) AS precision, round(r, 6) AS recall, round(2 * p * r / (p + r), 6) AS f1, round((a + 2 * p * r / (p + r)) / 2, 6) AS acc_and_f1 FROM r""")
def accuracy_f1(spark, sf):
    return rounded(M.accuracy_f1(quality(spark, sf), F.col("g"), F.col("p")))


@query("matthews", PRED + """SELECT tp::BIGINT AS tp, fp::BIGINT AS fp, tn::BIGINT AS tn, fn::BIGINT AS fn, round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) AS mcc,
 CASE WHEN tp * fp * tn * fn = 0 THEN 0 ELSE round((tp * tn - fp * fn) / sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 6) END AS mcc_ref FROM c""")
def matthews(spark, sf):
    return rounded(M.matthews(quality(spark, sf), F.col("g"), F.col("p")))


@query("pearson", "SELECT round(corr(l_quantity, l_extendedprice), 6) AS pearson FROM lineitem")
def pearson(spark, sf):
    return rounded(M.pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"))


@query("spearman", """WITH r AS (SELECT row_number() OVER (ORDER BY o_totalprice, o_orderkey) AS a, row_number() OVER (ORDER BY o_custkey, o_orderkey) AS b, count(*) OVER () AS n FROM orders)
 SELECT round(1 - 6 * sum(((a - b) * (a - b))::DOUBLE) / any_value(n::DOUBLE * (n::DOUBLE * n - 1)), 6) AS spearman FROM r""")
def spearman(spark, sf):
    return rounded(M.spearman(table(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_custkey"), "o_totalprice", "o_custkey", "o_orderkey"))


LABELS = """WITH x AS (SELECT l_returnflag AS g, CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_quantity > 25 THEN 'R' ELSE 'A' END ELSE 'N' END AS p FROM lineitem),
 ls AS (SELECT g AS label FROM x UNION SELECT p FROM x),
 c AS (SELECT label, count(*) FILTER (g = label AND p = label) AS tp, count(*) FILTER (g <> label AND p = label) AS fp, count(*) FILTER (g = label AND p <> label) AS fn FROM x, ls GROUP BY 1),
 q AS (SELECT *, CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END AS precision, CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END AS recall FROM c),
 f AS (SELECT *, CASE WHEN precision + recall = 0 THEN 0 ELSE 2 * precision * recall / (precision + recall) END AS f1 FROM q) """


def flags(spark, sf):
    p = F.when(F.col("l_linestatus") == "F", F.when(F.col("l_quantity") > 25, "R").otherwise("A")).otherwise("N")
    return table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("g"), p.alias("p"))


@query("per_label", LABELS + "SELECT label, tp, fp, fn, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1 FROM f")
def per_label(spark, sf):
    return rounded(M.per_label(flags(spark, sf), "g", "p"))


@query("f1_report", LABELS + """SELECT round(avg(precision), 6) AS macro_precision, round(avg(recall), 6) AS macro_recall, round(avg(f1), 6) AS macro_f1,
 round(sum(precision * (tp + fn)) / sum(tp + fn), 6) AS weighted_precision, round(sum(recall * (tp + fn)) / sum(tp + fn), 6) AS weighted_recall, round(sum(f1 * (tp + fn)) / sum(tp + fn), 6) AS weighted_f1,
 round(sum(tp) / sum(tp + fp), 6) AS micro_precision, round(sum(tp) / sum(tp + fn), 6) AS micro_recall, round(sum(tp) / sum(tp + fn), 6) AS micro_f1 FROM f""")
def f1_report(spark, sf):
    return rounded(M.averages(M.per_label(flags(spark, sf), "g", "p")))


@query("subset_accuracy", "SELECT round(avg(CAST(quality = (toxic = 0)::INT AS INT)), 6) AS accuracy FROM labels WHERE quality <> -100")
def subset_accuracy(spark, sf):
    l = table(spark, sf, "labels")
    return rounded(M.subset_accuracy(l, F.col("quality"), (F.col("toxic") == 0).cast("int"), ignore=-100))


@query("perplexity", "SELECT round(exp(sum(value / 100) / sum(1 + event_id % 3)), 6) AS perplexity FROM events")
def perplexity(spark, sf):
    return rounded(M.perplexity(table(spark, sf, "events"), F.col("value") / 100, 1 + F.col("event_id") % 3))


SEQ = """WITH x AS (SELECT vec_id, list_transform(embedding, lambda v: (v > {g}::FLOAT)::INT) AS g, list_transform(embedding, lambda v: (v > {p}::FLOAT)::INT) AS p FROM embeddings),
 c AS (SELECT count(*) FILTER (list_contains(g, 1) AND g = p) AS tp, count(*) FILTER (list_contains(g, 1) AND g <> p) AS fn, count(*) FILTER (NOT list_contains(g, 1) AND g <> p) AS fp FROM x)
 SELECT tp, fn, fp, round(tp / nullif(tp + fp, 0), 6) AS precision, round(tp / nullif(tp + fn, 0), 6) AS recall,
 CASE WHEN tp = 0 THEN 0 ELSE round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) END AS f1 FROM c"""


def sequences(spark, sf):
    over = lambda t: F.transform("embedding", lambda v: (v > F.lit(t).cast("float")).cast("int"))
    return table(spark, sf, "embeddings").select(over(0.3).alias("g"), over(0.29).alias("p"))


@query("detection_f1", SEQ.format(g=0.3, p=0.29))
def detection_f1(spark, sf):
    return rounded(M.correction_f1(sequences(spark, sf), F.col("g"), F.col("p")))


@query("correction_f1", SEQ.format(g=0.3, p=0.29))
def correction_f1(spark, sf):
    """Corrected ids agree wherever a position is flagged, so only the flags decide."""
    s = sequences(spark, sf).withColumn("fix", F.transform("g", lambda x, i: i + 7))
    return rounded(M.correction_f1(s, F.col("g"), F.col("p"), F.col("fix"), F.col("fix")))


# answers: gold = every part name, prediction = the name with article, punctuation or another word
ANS = """WITH a AS (SELECT p_partkey AS id, string_split(p_name, ' ') AS g, CASE p_size % 4 WHEN 0 THEN [string_split(p_name, ' ')[1]] WHEN 1 THEN ['x', 'y'] ELSE string_split(p_name, ' ') END AS p, p_partkey % 3 > 0 AS has, (p_partkey * 37 % 101) / 101.0::DOUBLE AS na FROM part),
 s AS (SELECT id, has, na, CASE WHEN has THEN (g = p)::INT::DOUBLE ELSE 0.0 END AS exact, CASE WHEN NOT has THEN 0.0 WHEN p = ['x', 'y'] THEN 0.0 ELSE 2.0 * len(p) / (len(p) + len(g)) END::DOUBLE AS f1 FROM a),
 r AS (SELECT id, has, na, CASE WHEN na > 0.8 THEN (NOT has)::INT::DOUBLE ELSE exact END AS exact, CASE WHEN na > 0.8 THEN (NOT has)::INT::DOUBLE ELSE f1 END AS f1 FROM s) """


def answers(spark, sf):
    name, first = F.col("p_name"), F.substring_index("p_name", " ", 1)
    pred = F.when(F.col("p_size") % 4 == 0, first).when(F.col("p_size") % 4 == 1, "x, y").otherwise(F.concat(F.lit("The "), name, F.lit(".")))
    a = table(spark, sf, "part").select(
        F.col("p_partkey").alias("id"), pred.alias("pred"), (F.col("p_partkey") % 3 > 0).alias("has_answer"),
        F.when(F.col("p_partkey") % 3 > 0, F.array("p_name")).otherwise(F.array().cast("array<string>")).alias("golds"),
        ((F.col("p_partkey") * 37 % 101) / 101.0).alias("na"))
    s = a.withColumn("s", M.answer_scores(F.col("pred"), F.col("golds")))
    return s.select("id", "has_answer", "na", "s.exact", "s.f1")


@query("answer_report", ANS + "SELECT CASE has WHEN true THEN 'HasAns' WHEN false THEN 'NoAns' END AS part, round(100 * avg(exact), 6) AS exact, round(100 * avg(f1), 6) AS f1, count(*) AS total FROM r GROUP BY ROLLUP (has)")
def answer_report(spark, sf):
    return rounded(M.answer_report(answers(spark, sf).withColumn("na_prob_above", F.col("na") > 0.8)))


@query("missing_predictions", "SELECT (SELECT count(*) FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)) AS matched, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS missing")
def missing_predictions(spark, sf):
    d = table(spark, sf, "documents").select("doc_id")
    l = table(spark, sf, "labels").select("doc_id", F.lit(1).alias("hit"))
    return d.join(l, "doc_id", "left").agg(F.count("hit").alias("matched"), F.count_if(F.col("hit").isNull()).alias("missing"))


@query("best_threshold", ANS + """, t AS (SELECT na, sum(CASE WHEN has THEN f1 ELSE -1 END) OVER (ORDER BY na, id ROWS UNBOUNDED PRECEDING) AS cum FROM s)
 SELECT round(100 * (greatest(max(cum), 0) + (SELECT count(*) FROM s WHERE NOT has)) / (SELECT count(*) FROM s), 6) AS best_score,
 round(CASE WHEN max(cum) > 0 THEN first(na ORDER BY cum DESC, na) ELSE 0 END, 6) AS best_threshold FROM t""")
def best_threshold(spark, sf):
    a = answers(spark, sf).withColumn("answered", F.lit(True))
    return rounded(M.best_threshold(a, "na", "id", "f1", "has_answer", "answered"))


@query("char_answer_report", """WITH x AS (SELECT length(replace(p_name, ' ', ''))::DOUBLE AS n FROM part)
 SELECT round(exp(1 - sum(n) / sum(n - 1)), 6) AS bleu, round(avg((1 + 1.44) * ((n - 1) / n) / ((n - 1) / n + 1.44)), 6) AS rouge_l FROM x""")
def char_answer_report(spark, sf):
    """Predictions that lack the last character and differ in white space."""
    p = table(spark, sf, "part").select("p_partkey", F.col("p_name").alias("gold"), F.concat(
        F.lit("\t"), F.expr("substring(p_name, 1, length(p_name) - 1)"), F.lit(" ")).alias("pred"))
    return rounded(M.char_answer_report(p, "p_partkey", "pred", "gold"))


@query("feature_regroup", """WITH f AS (SELECT doc_id, unnest(range((greatest(length(text), 1) + 999) // 1000)) AS w FROM documents) SELECT doc_id, lang, count(*) AS windows FROM f JOIN documents USING (doc_id) GROUP BY 1, 2""")
def feature_regroup(spark, sf):
    """Windows back to their example (1:N), counts pre-aggregated before the join."""
    f = docs(spark, sf).select("doc_id", F.explode(T.chunks(F.col("text"), 1000)))
    n = f.groupBy("doc_id").agg(F.count("*").alias("windows"))
    return table(spark, sf, "documents").select("doc_id", "lang").join(n, "doc_id")

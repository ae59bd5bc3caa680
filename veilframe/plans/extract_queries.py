"""Queries over taxonomy, relations, lexicons, triples and annotation conversion."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe.functions import text as T
from veilframe.functions.fold import let
from veilframe.functions.spans import regex_spans
from veilframe.operators import annotation as N
from veilframe.operators import extract as X
from veilframe.operators import lexicon as L
from veilframe.plans.registry import query
from veilframe.plans.text_queries import W, docs
from veilframe.session import table

EDGES = """WITH RECURSIVE e AS (SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer UNION ALL SELECT 's' || s_suppkey, 'n' || s_nationkey FROM supplier
 UNION ALL SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION ALL SELECT 'r' || r_regionkey, 'world' FROM region) """


def edges(spark, sf):
    t = lambda n, a, x, b, y: table(spark, sf, n).select(F.concat(F.lit(a), F.col(x).cast("string")).alias("child"),
                                                         F.concat(F.lit(b), F.col(y).cast("string")).alias("parent"))
    out = t("customer", "c", "c_custkey", "n", "c_nationkey").unionByName(t("supplier", "s", "s_suppkey", "n", "s_nationkey"))
    out = out.unionByName(t("nation", "n", "n_nationkey", "r", "n_regionkey"))
    return out.unionByName(table(spark, sf, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("child"), F.lit("world").alias("parent")))


@query("taxonomy_closure", EDGES + """, a AS (SELECT child, parent AS ancestor FROM e UNION SELECT a.child, e.parent FROM a JOIN e ON a.ancestor = e.child) SELECT * FROM a""")
def taxonomy_closure(spark, sf):
    return X.closure(edges(spark, sf))


DEEP = """WITH RECURSIVE e AS (SELECT DISTINCT o_orderkey AS child, o_orderkey // 2 AS parent FROM orders WHERE o_orderkey > 1)"""


def deep_edges(spark, sf):
    """A binary tree over order numbers, about 14 levels deep at the smallest scale."""
    o = table(spark, sf, "orders").where("o_orderkey > 1")
    return o.select(F.col("o_orderkey").alias("child"), F.floor(F.col("o_orderkey") / 2).alias("parent")).distinct()


@query("taxonomy_closure_deep", DEEP + """, a AS (SELECT child, parent AS ancestor FROM e UNION SELECT a.child, e.parent FROM a JOIN e ON a.ancestor = e.child)
 SELECT child, count(*) AS ancestors, min(ancestor) AS top FROM a GROUP BY child""")
def taxonomy_closure_deep(spark, sf):
    return X.closure(deep_edges(spark, sf)).groupBy("child").agg(F.count("*").alias("ancestors"), F.min("ancestor").alias("top"))


@query("taxonomy_paths_deep", DEEP + """, r AS (SELECT DISTINCT parent AS id FROM e WHERE parent NOT IN (SELECT child FROM e)),
 p AS (SELECT id, id::VARCHAR AS path FROM r UNION ALL SELECT e.child, p.path || '/' || e.child FROM p JOIN e ON e.parent = p.id) SELECT * FROM p""")
def taxonomy_paths_deep(spark, sf):
    e = deep_edges(spark, sf)
    return X.paths(e.select(F.col("child").alias("id")).union(e.select("parent")).distinct(), e)


@query("taxonomy_paths", EDGES + """, p AS (SELECT 'world' AS id, 'world' AS path UNION ALL SELECT e.child, p.path || '/' || e.child FROM p JOIN e ON e.parent = p.id) SELECT * FROM p""")
def taxonomy_paths(spark, sf):
    e = edges(spark, sf)
    nodes = e.select(F.col("child").alias("id")).union(e.select("parent")).distinct()
    return X.paths(nodes, e)


@query("term_linking", """SELECT c_custkey AS key, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE lower(c_mktsegment) END AS item,
 'b-' || c_mktsegment AS found, CASE WHEN c_custkey % 2 = 0 THEN 'b-' || c_mktsegment END AS termid FROM customer WHERE c_nationkey < 20""")
def term_linking(spark, sf):
    """Segments as terms of two node kinds; lower-case items hit only an alias and stay unlinked."""
    c = table(spark, sf, "customer")
    seg = c.select("c_mktsegment").distinct()
    node = lambda p, kind: seg.select(F.concat(F.lit(p), "c_mktsegment").alias("id"), F.col("c_mktsegment").alias("term"),
                                      F.array(F.lower("c_mktsegment")).alias("alias"), F.lit(kind).alias("termtype"),
                                      F.array().cast("array<string>").alias("subtype"), F.lit("cb").alias("base"), F.lit("term").alias("node_type"))
    nodes = node("a-", "branch").unionByName(node("b-", "segment"))
    reach = nodes.select("id", F.col("termtype").alias("type")).union(nodes.where("termtype = 'branch'").select("id", F.lit("segment")))
    items = c.select(F.col("c_custkey").alias("key"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")).otherwise(F.lower("c_mktsegment")).alias("item"),
                     F.when(F.col("c_nationkey") < 20, "segment").otherwise("other").alias("target_type"))
    return X.link_terms(items, nodes, reach)


def entities(spark, sf):
    """Orders as entities of their customer."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("doc"), F.col("o_orderpriority").alias("label"),
        F.concat(F.col("o_orderstatus"), F.col("o_orderkey").cast("string")).alias("text"),
        F.col("o_orderkey").alias("start"), (F.col("o_orderkey") + 2).alias("end"))


def relations(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("doc"), F.col("o_orderkey").alias("from_id"), (F.col("o_orderkey") + 1).alias("to_id"),
                    F.col("o_orderstatus").alias("type"))


ENT = """WITH ent AS (SELECT o_orderkey AS id, o_custkey AS doc, o_orderpriority AS label, o_orderstatus || o_orderkey AS text FROM orders),
 rel AS (SELECT f.doc, f.id AS from_id, t.id AS to_id, left(f.text, 1) AS predicate, f.text AS subject, t.text AS object FROM ent f JOIN ent t ON t.id = f.id + 1) """


def full_relations(spark, sf):
    r = X.with_entities(relations(spark, sf), entities(spark, sf).select("id", "text", "label"))
    return r.select("doc", "from_id", "to_id", F.col("type").alias("predicate"), F.col("subject_text").alias("subject"), F.col("object_text").alias("object"))


@query("relation_entities", ENT + "SELECT * FROM rel")
def relation_entities(spark, sf):
    return full_relations(spark, sf)


@query("stage_prompts", ENT + "SELECT DISTINCT c_custkey AS doc, c_name, text || '的状态' AS prompt FROM customer JOIN ent ON ent.doc = c_custkey")
def stage_prompts(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("doc"), "c_name")
    e = entities(spark, sf).select("doc", F.col("text").alias("entity"))
    return X.expand_prompts(c, e, "doc", "状态").select("doc", "c_name", "prompt")


@query("assemble_relations", """WITH l2 AS (SELECT l_orderkey AS id, count(*) AS n, sum(l_partkey)::BIGINT AS parts FROM lineitem GROUP BY 1)
 SELECT c_custkey, count(o_orderkey) AS orders, coalesce(sum(n), 0)::BIGINT AS lines, coalesce(sum(parts), 0)::BIGINT AS parts FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN l2 ON l2.id = o_orderkey GROUP BY 1""")
def assemble_relations(spark, sf):
    """Three schema levels nested bottom-up: customer -> orders -> lines."""
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey", "l_suppkey")
    o = X.assemble(table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")), li, ["o_orderkey"], ["l_partkey", "l_suppkey"], "lines")
    c = X.assemble(table(spark, sf, "customer").select("c_custkey"), o, ["c_custkey"], ["o_orderkey", "lines"], "orders")
    total = lambda f: F.coalesce(F.aggregate("orders", F.lit(0).cast("long"), lambda a, x: a + f(x)), F.lit(0))
    n = total(lambda x: F.greatest(F.coalesce(F.size(x["lines"]), F.lit(0)), F.lit(0)))
    parts = total(lambda x: F.aggregate(F.coalesce(x["lines"], F.array().cast("array<struct<l_partkey:bigint,l_suppkey:bigint>>")), F.lit(0).cast("long"), lambda a, y: a + y["l_partkey"]))
    return c.select("c_custkey", F.coalesce(F.greatest(F.size("orders"), F.lit(0)), F.lit(0)).cast("long").alias("orders"), n.alias("lines"), parts.alias("parts"))


@query("aspect_opinions", """SELECT o_orderkey, count(l_partkey) AS opinions, min(l_partkey) AS first FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey AND l_returnflag = 'R' GROUP BY 1""")
def aspect_opinions(spark, sf):
    """Every aspect keeps all its opinions; aspects without one stay."""
    op = table(spark, sf, "lineitem").where("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"), "l_partkey")
    a = X.assemble(table(spark, sf, "orders").select("o_orderkey"), op, ["o_orderkey"], ["l_partkey"], "opinions")
    n = F.coalesce(F.greatest(F.size("opinions"), F.lit(0)), F.lit(0))
    return a.select("o_orderkey", n.cast("long").alias("opinions"), F.get(F.col("opinions.l_partkey"), F.lit(0)).alias("first"))


@query("decode_relations", """WITH s AS (SELECT DISTINCT l_orderkey AS doc, l_linenumber AS a, l_linenumber + 1 AS b FROM lineitem),
 h AS (SELECT l_orderkey AS doc, l_returnflag AS p, l_linenumber AS s, l_linenumber % 4 + 1 AS o, max(l_discount) AS prob FROM lineitem WHERE l_quantity > 25 GROUP BY 1, 2, 3, 4),
 t AS (SELECT l_orderkey AS doc, l_returnflag AS p, l_linenumber + 1 AS s, l_linenumber % 4 + 2 AS o, max(l_tax) AS prob FROM lineitem WHERE l_quantity < 40 GROUP BY 1, 2, 3, 4)
 SELECT h.doc, h.p AS predicate, h.s, h.o, round(h.prob * t.prob, 6) AS probability FROM s x JOIN s y USING (doc) JOIN h ON h.doc = x.doc AND h.s = x.a AND h.o = y.a JOIN t ON t.doc = h.doc AND t.p = h.p AND t.s = x.b AND t.o = y.b""")
def decode_relations(spark, sf):
    li = table(spark, sf, "lineitem").withColumnRenamed("l_orderkey", "doc").withColumn("n", F.col("l_linenumber"))
    spans = li.select("doc", F.col("n").alias("start"), (F.col("n") + 1).alias("end")).distinct()
    scores = lambda cond, shift, prob: li.where(cond).groupBy("doc", F.col("l_returnflag").alias("predicate"), (F.col("n") + shift).alias("s"),
                                                             (F.col("n") % 4 + 1 + shift).alias("o")).agg(F.lit(1.0).alias("score"), F.max(prob).alias("prob"))
    r = X.decode_relations(spans, scores("l_quantity > 25", 0, "l_discount"), scores("l_quantity < 40", 1, "l_tax"), "doc")
    return r.select("doc", "predicate", "s", "o", F.round("probability", 6).alias("probability"))


@query("relation_groups", ENT + "SELECT predicate || '类' AS relation_type, count(*) AS n FROM rel GROUP BY 1")
def relation_groups(spark, sf):
    r = full_relations(spark, sf)
    p = r.select(X.prompt(F.col("subject"), F.concat("predicate", F.lit("类"))).alias("prompt"))
    return X.relation_groups(p).groupBy("relation_type").agg(F.count("*").alias("n"))


# lexicon: part names occur in generated sentences
LEX = """WITH t AS (SELECT o_orderkey AS doc, 'a ' || p_name || ' or big ' || p_type || p_name AS text FROM orders JOIN part ON p_partkey = o_orderkey % (SELECT count(*) FROM part)) """


def lexicon_texts(spark, sf):
    p = table(spark, sf, "part")
    n = p.count()
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("doc"), (F.col("o_orderkey") % n).alias("p_partkey"))
    return o.join(p, "p_partkey").select("doc", F.concat(F.lit("a "), "p_name", F.lit(" or big "), "p_type", "p_name").alias("text"), "p_name", "p_type")


def lexicon(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.col("p_name").alias("phrase")).union(p.select(F.substring_index("p_name", " ", 1))).distinct()


LEX_OUT = LEX + """, w AS (SELECT DISTINCT p_name AS phrase FROM part UNION SELECT DISTINCT string_split(p_name, ' ')[1] FROM part), ls AS (SELECT DISTINCT length(phrase) AS n FROM w),
 h AS (SELECT doc, i - 1 AS s, max(i - 1 + n) AS e FROM (SELECT doc, text, unnest(range(1, length(text) + 1)) AS i FROM t), ls WHERE i + n - 1 <= length(text) AND substr(text, i, n) IN (SELECT phrase FROM w) GROUP BY 1, 2),
 r AS (SELECT *, max(e) OVER (PARTITION BY doc ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM h)
 SELECT doc, s::BIGINT AS start, e::BIGINT AS "end" FROM r WHERE reach IS NULL OR e > reach"""


@query("lexicon_matches", LEX_OUT)
def lexicon_matches(spark, sf):
    m = L.lexicon_matches(lexicon_texts(spark, sf), "text", lexicon(spark, sf)).select("doc", F.explode("matches").alias("m"))
    return m.select("doc", F.col("m.start").cast("long").alias("start"), F.col("m.end").cast("long").alias("end"))


@query("lexicon_join", LEX_OUT)
def lexicon_join(spark, sf):
    """The same matches as rows; the longest of each start are found along texts of any length."""
    m = L.lexicon_join(lexicon_texts(spark, sf), "doc", "text", lexicon(spark, sf))
    return L.keep_forward(m, "doc").select("doc", F.col("start").cast("long").alias("start"), F.col("end").cast("long").alias("end"))


@query("lexicon_detector", LEX + """SELECT doc, replace(text, p_name, '[地址已脱敏]') AS redacted FROM t JOIN part ON p_partkey = doc % (SELECT count(*) FROM part)""")
def lexicon_detector(spark, sf):
    from veilframe.operators.redact import redact
    names = table(spark, sf, "part").select(F.col("p_name").alias("phrase"), F.lit("地址").alias("type")).distinct()
    out = redact(lexicon_texts(spark, sf).select("doc", "text"), detector=L.lexicon_detector(names))
    return out.select("doc", "redacted")


@query("override_tags", """SELECT c_custkey, 'B-x I-x B-y I-y I-y' || repeat(' O', length(c_mktsegment) - 5) AS tags FROM customer""")
def override_tags(spark, sf):
    c = table(spark, sf, "customer")
    tags = F.transform(F.sequence(F.lit(1), F.length("c_mktsegment")), lambda i: F.lit("O"))
    m = F.array(F.struct(F.lit(0).alias("start"), F.lit(5).alias("end"), F.array(F.lit("x"), F.lit("y")).alias("tags"), F.array(F.lit(0), F.lit(2)).alias("offsets")))
    return c.select("c_custkey", F.array_join(X.override_tags(tags, m), " ").alias("tags"))


# DuckDB's levenshtein counts bytes, so accented letters become single unused capitals first
ASCII = "translate(w, 'àáâãäåæçèéêëìíîïðñòóôõö÷øùúûüýþÿ', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!#$%&*')"


@query("fuzzy_terms", f"""WITH w AS (SELECT DISTINCT unnest({W}) AS w FROM documents), t AS (SELECT DISTINCT unnest({W}) AS w FROM benchmark)
 SELECT t.w AS query, w.w AS term, levenshtein(t.a, w.a)::BIGINT AS distance FROM (SELECT w, {ASCII} AS a FROM t) t JOIN (SELECT w, {ASCII} AS a FROM w) w
 ON abs(length(t.a) - length(w.a)) <= 2 AND levenshtein(t.a, w.a) <= 2""")
def fuzzy_terms(spark, sf):
    q = table(spark, sf, "benchmark").select(F.explode(T.words(F.col("text"))).alias("query"))
    t = docs(spark, sf).select(F.explode(T.words(F.col("text"))).alias("term"))
    return X.near_terms(q, t).select("query", "term", F.col("distance").cast("long").alias("distance"))


TRIGGERS = ["and", "der", "les", "con", "the"]


@query("mine_triples", f"""WITH w AS (SELECT doc_id, {W} AS ws FROM documents), e AS (SELECT doc_id, ws[i] AS w, i - 1 AS i FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w)),
 x AS (SELECT *, max(CASE WHEN length(w) = 7 THEN i END) OVER b AS head, max(CASE WHEN length(w) = 1 THEN i END) OVER b AS lo, max(CASE WHEN length(w) = 5 THEN i END) OVER b AS lt,
 min(CASE WHEN length(w) = 1 THEN i END) OVER a AS hi, min(CASE WHEN length(w) = 5 THEN i END) OVER a AS rt FROM e WINDOW b AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), a AS (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
 y AS (SELECT doc_id, i, head, CASE WHEN rt IS NOT NULL AND (hi IS NULL OR rt < hi) THEN rt WHEN lt > head THEN lt END AS tail, CASE WHEN rt IS NOT NULL AND (hi IS NULL OR rt < hi) THEN 'HGT' ELSE 'HTG' END AS src
 FROM x WHERE w IN ('and', 'der', 'les', 'con', 'the') AND head IS NOT NULL AND (lo IS NULL OR head > lo))
 SELECT doc_id, src, head::BIGINT AS head_pos, i::BIGINT AS trigger_pos, tail::BIGINT AS tail_pos FROM y WHERE tail IS NOT NULL""")
def mine_triples(spark, sf):
    """Seven-letter words as heads, five-letter words as tails, one-letter words as stops."""
    w = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("w"))
    tag = lambda x: F.when(F.length(x) == 7, "H").when(F.length(x) == 5, "T").when(F.length(x) == 1, "S").otherwise("O")
    items = F.transform("w", lambda x: F.struct(F.when(F.length(x) == 1, "。").otherwise(x).alias("item"), tag(x).alias("tag")))
    t = X.mine_triples(w.select("doc_id", items.alias("items")), "doc_id", "items",
                       [{"group": "g", "head": "H", "triggers": TRIGGERS, "tails": ["T"], "reverse": False}])
    return t.select("doc_id", "src", *[F.col(c).cast("long").alias(c) for c in ("head_pos", "trigger_pos", "tail_pos")])


@query("mine_relations", f"""WITH w AS (SELECT doc_id, {W} AS ws FROM documents), e AS (SELECT doc_id, ws[i] AS w, i - 1 AS i, length(ws[i]) AS n, len(ws) AS size FROM (SELECT *, unnest(range(1, len(ws) + 1)) AS i FROM w)),
 x AS (SELECT *, lead(i) OVER (PARTITION BY doc_id, n = 7 ORDER BY i) AS next_head FROM e),
 h AS (SELECT doc_id, i, w, size, coalesce(next_head, size) AS next_head FROM x WHERE n = 7),
 t AS (SELECT h.doc_id, h.i, h.w, h.size, min(e.i) AS trig FROM h JOIN e ON e.doc_id = h.doc_id AND e.i > h.i AND e.i < h.next_head AND e.w = 'the' GROUP BY ALL),
 r AS (SELECT t.*, min(e.i) FILTER (e.n = 1 OR e.n = 7) AS stop, min(e.i) FILTER (e.n = 5) AS tail FROM t LEFT JOIN e ON e.doc_id = t.doc_id AND e.i > t.trig GROUP BY ALL)
 SELECT doc_id, i::BIGINT AS head_pos, w AS head, min(tail)::BIGINT AS tail_pos FROM r WHERE trig + 2 < size AND tail IS NOT NULL AND (stop IS NULL OR tail < stop) GROUP BY ALL""")
def mine_relations(spark, sf):
    """Seven-letter words as heads, 'the' as trigger, the next five-letter word behind it as tail; one-letter words are stops."""
    w = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("w"))
    tag = lambda x: F.when(F.length(x) == 7, "H_x").when(F.length(x) == 5, "T_y").otherwise("O")
    items = F.transform("w", lambda x: F.struct(F.when(F.length(x) == 1, "。").otherwise(x).alias("item"), tag(x).alias("tag")))
    found = X.mine_relations(w.select("doc_id", items.alias("items")), "doc_id", "items", [
        {"head_role": "H", "group": "g", "trig_word": ["the"], "trig_type": "trigger", "tail_role": [{"main": ["T"]}], "reverse": False}])
    # of a head's relations the one whose trigger is the first word 'the' behind it, with no other head between
    first = found.where("src = 'HGT'").select("doc_id", F.col("head.pos").cast("long").alias("head_pos"), F.col("head.item").alias("head"),
                                              F.col("triggers")[0]["pos"].alias("trig"), F.col("tails")[0]["pos"].cast("long").alias("tail_pos"))
    # numbers before each place, and behind the last, of the words that end it
    ends = F.array_compact(F.transform("w", lambda x, i: F.when((F.length(x) == 7) | (x == "the"), i)))
    runs = let(ends, lambda e: F.zip_with(F.concat(F.array(F.lit(-1)), e), F.concat(e, F.array(F.size("w"))), lambda a, b: b - a))
    before = w.select("doc_id", F.flatten(F.transform(runs, lambda n, i: F.array_repeat(i, n))).alias("before"))
    upto = lambda place: F.get("before", F.least(place.cast("int"), F.size("before") - 1))
    return first.join(before, "doc_id").where(upto(F.col("trig")) == upto(F.col("head_pos") + 1)).select("doc_id", "head_pos", "head", "tail_pos")


@query("pair_cosine", """SELECT a.vec_id, round(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) / (sqrt(list_dot_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_dot_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[]))), 6) AS cosine
 FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def pair_cosine(spark, sf):
    from veilframe.operators.vectors import cosine
    e = table(spark, sf, "embeddings").select("vec_id", "embedding")
    nxt = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return e.join(nxt, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("cosine"))


@query("nearest_rank", """WITH d AS (SELECT a.vec_id, b.vec_id AS other, a.label = b.label AS same, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) AS rank FROM d)
 SELECT e.vec_id, coalesce(min(rank) FILTER (same), 0) AS rank FROM embeddings e LEFT JOIN r USING (vec_id) GROUP BY 1""")
def nearest_rank(spark, sf):
    """Rank of the first same-label neighbour of every vector, over all vectors."""
    from veilframe.operators.vectors import first_match_rank
    return first_match_rank(table(spark, sf, "embeddings"), "vec_id", "embedding", "label").select("vec_id", "rank")


@query("mean_reciprocal_rank", """WITH d AS (SELECT a.vec_id, b.vec_id AS other, a.label = b.label AS same, list_distance(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
 r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, other) AS rank FROM d), m AS (SELECT vec_id, min(rank) FILTER (same) AS rank FROM r GROUP BY 1)
 SELECT round(avg(coalesce(1 / rank, 0)), 6) AS mrr FROM m""")
def mean_reciprocal_rank(spark, sf):
    from veilframe.operators.vectors import mrr
    return mrr(table(spark, sf, "embeddings"), "vec_id", "embedding", "label").select(F.round("mrr", 6).alias("mrr"))


# annotation --------------------------------------------------------------------------------

@query("class_examples", """SELECT c_custkey, c_mktsegment AS answer, length(c_mktsegment)::BIGINT AS n, 1::BIGINT AS found FROM customer""")
def class_examples(spark, sf):
    """The negative offsets cut the answer out of the prompt again."""
    c = table(spark, sf, "customer")
    options = N.label_list(c, "c_mktsegment")
    ex = N.class_example(F.col("c_name"), F.col("c_mktsegment"), options, "segment", F.col("c_custkey"), 3)
    e = c.select("c_custkey", ex.alias("x"))
    cut = F.substring(F.col("x.prompt"), F.length("x.prompt") + F.col("x.start") + 2, F.col("x.end") - F.col("x.start"))
    return e.select("c_custkey", F.col("x.answer").alias("answer"), (F.col("x.end") - F.col("x.start")).cast("long").alias("n"), (cut == F.col("x.answer")).cast("long").alias("found"))


@query("class_labels", "SELECT o_orderkey, o_orderstatus AS label, CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END AS class FROM orders")
def class_labels(spark, sf):
    raw = F.when(F.col("o_orderkey") % 2 == 0, F.concat_ws("##", "o_orderstatus", "o_orderpriority")).otherwise(F.col("o_orderstatus"))
    label, cls = N.split_class_label(raw)
    return table(spark, sf, "orders").select("o_orderkey", label.alias("label"), cls.alias("class"))


@query("entity_prompts", ENT + "SELECT doc, label, count(*) AS n, string_agg(text, ',' ORDER BY id) AS texts FROM ent GROUP BY 1, 2")
def entity_prompts(spark, sf):
    g = N.entity_prompts(entities(spark, sf), "doc", "label")
    return g.select("doc", "label", F.size("spans").cast("long").alias("n"), F.array_join(F.col("spans.text"), ",").alias("texts"))


@query("relation_prompts", ENT + "SELECT doc, subject || '的' || predicate AS prompt, string_agg(object, ',' ORDER BY object) AS objects FROM rel GROUP BY 1, 2")
def relation_prompts(spark, sf):
    g = N.relation_prompts(full_relations(spark, sf), "doc")
    return g.select("doc", "prompt", F.array_join("objects", ",").alias("objects"))


@query("neg_entities", ENT + """, h AS (SELECT doc, label FROM ent GROUP BY 1, 2), ls AS (SELECT DISTINCT label FROM ent), p AS (SELECT doc, count(*) AS pos FROM h GROUP BY 1),
 m AS (SELECT p.doc, pos, ls.label, row_number() OVER (PARTITION BY p.doc ORDER BY md5('9:' || p.doc || ':' || ls.label)) AS k, count(*) OVER (PARTITION BY p.doc) AS neg FROM p, ls WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.doc = p.doc AND h.label = ls.label))
 SELECT doc, label FROM m WHERE ceil(neg / pos) <= 1 OR k <= pos""")
def neg_entities(spark, sf):
    return N.entity_negatives(entities(spark, sf), "doc", "label", 1, 9)


@query("full_negatives", ENT + """, ps AS (SELECT DISTINCT predicate FROM rel), s AS (SELECT DISTINCT doc, text FROM ent)
 SELECT doc, text || '的' || predicate AS prompt FROM s, ps WHERE (doc, text || '的' || predicate) NOT IN (SELECT doc, subject || '的' || predicate FROM rel)""")
def full_negatives(spark, sf):
    return N.full_negatives(entities(spark, sf), full_relations(spark, sf), "doc")


@query("neg_relations", ENT + """, p AS (SELECT doc, count(DISTINCT subject || '的' || predicate) AS pos FROM rel GROUP BY 1), h AS (SELECT doc, count(DISTINCT label) AS have FROM ent GROUP BY 1),
 z AS (SELECT doc, pos, (SELECT count(DISTINCT label) FROM ent) - have AS lack FROM p JOIN h USING (doc))
 SELECT doc, (least(pos, pos) + pos + least(lack, pos) + (3 * pos - pos - pos - least(lack, pos)))::BIGINT AS negatives FROM z""")
def neg_relations(spark, sf):
    """Three negatives per positive prompt, however small the single pools are."""
    n = N.relation_negatives(full_relations(spark, sf), entities(spark, sf), "doc", 3, 4)
    return n.groupBy("doc").agg(F.count("*").alias("negatives"))


def _drawn(seed: int, *key: str) -> str:
    return f"('0x' || substr(md5(concat_ws(':', '{seed}', {', '.join(key)})), 1, 12))::BIGINT"


def _walk(start: str, t: str, size: str) -> str:
    step = "1"
    for prime in (7919, 104_729, 999_983, 1_000_003, 15_485_863):
        step = f"CASE WHEN {size} % {prime} <> 0 THEN {prime} ELSE {step} END"
    return f"(({start}) % {size} + {t} * ({step})) % {size}"


#: Regions as documents: nations are subjects, suppliers objects; every second supplier is near, the others in.
SUPPLY = """WITH a AS (SELECT n_regionkey AS doc, n_name AS subject, CASE WHEN s_suppkey % 2 = 0 THEN 'near' ELSE 'in' END AS predicate, s_name AS object FROM supplier JOIN nation ON s_nationkey = n_nationkey),
 ent AS (SELECT DISTINCT doc, subject AS text, 'nation' AS label FROM a UNION SELECT doc, object, 'supplier' FROM a UNION SELECT n_regionkey, n_name, 'land' || n_regionkey FROM nation),
 rel AS (SELECT * FROM a), """


def supply(spark, sf):
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    rel = s.select(F.col("n_regionkey").alias("doc"), F.col("n_name").alias("subject"),
                   F.when(F.col("s_suppkey") % 2 == 0, "near").otherwise("in").alias("predicate"), F.col("s_name").alias("object"))
    n = table(spark, sf, "nation")
    ent = (rel.select("doc", F.col("subject").alias("text"), F.lit("nation").alias("label"))
           .union(rel.select("doc", "object", F.lit("supplier")))
           .union(n.select("n_regionkey", "n_name", F.concat(F.lit("land"), F.col("n_regionkey").cast("string")))).distinct())
    return rel, ent


def _negatives_sql(ratio: int, seed: int) -> str:
    """The three pools listed in full, their drawn order as a permutation of what a document lacks."""
    own = {2: "golden", 3: "labelled"}
    pools = ["""p1 AS (SELECT doc, 1 AS pool, row_number() OVER (PARTITION BY doc ORDER BY md5('%d:' || doc || ':' || object || '的' || predicate), object || '的' || predicate) - 1 AS t,
 object || '的' || predicate AS prompt FROM rel)""" % seed]
    for i, values in ((2, "names"), (3, "labels")):
        item = "text" if i == 2 else "label"
        other, make = ("ps", f"x.{item} || '的' || o") if i == 2 else ("ss", f"o || '的' || x.{item}")
        pools.append(f"""x{i} AS (SELECT d.doc, d.{other} AS choice, v.{item}, v.idx, row_number() OVER (PARTITION BY d.doc ORDER BY v.idx) - 1 AS j, count(*) OVER (PARTITION BY d.doc) AS size
 FROM d, {values} v WHERE NOT EXISTS (SELECT 1 FROM {own[i]} g WHERE g.doc = d.doc AND g.{item} = v.{item})),
 t{i} AS (SELECT doc, t, {_walk(_drawn(seed + i, 'doc'), 't', 'size')} AS j FROM (SELECT doc, size, unnest(range(size)) AS t FROM (SELECT DISTINCT doc, size FROM x{i}))),
 p{i} AS (SELECT doc, {i} AS pool, t, {make} AS prompt FROM (SELECT x.*, t.t, x.choice[{_drawn(seed + 10 + i, 'x.doc', 'x.idx')} % len(x.choice) + 1] AS o FROM x{i} x JOIN t{i} t USING (doc, j)) x)""")
    return SUPPLY + f"""d AS (SELECT doc, count(DISTINCT subject || '的' || predicate) AS pos, list_sort(list(DISTINCT predicate)) AS ps, list_sort(list(DISTINCT subject)) AS ss FROM rel GROUP BY 1),
 names AS (SELECT text, row_number() OVER (ORDER BY text) - 1 AS idx FROM (SELECT DISTINCT text FROM ent)),
 labels AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS idx FROM (SELECT DISTINCT label FROM ent)),
 golden AS (SELECT DISTINCT doc, subject AS text FROM rel), labelled AS (SELECT DISTINCT doc, label FROM ent),
 {', '.join(pools)},
 q AS (SELECT * FROM p1 UNION ALL SELECT * FROM p2 UNION ALL SELECT * FROM p3),
 z AS (SELECT doc, pool, count(*) AS size, any_value(pos) AS pos, CASE WHEN {ratio} = -1 OR ceil(count(*) / any_value(pos)) <= {ratio // 3} THEN count(*) ELSE any_value(pos) * {max(ratio // 3, 0)} END AS n FROM q JOIN d USING (doc) GROUP BY 1, 2),
 l AS (SELECT doc, any_value(pos) AS pos, sum(n) AS n, sum(size - n) AS rest, coalesce(sum(size - n) FILTER (pool = 1), 0) AS l1, coalesce(sum(size - n) FILTER (pool = 2), 0) AS l2 FROM z GROUP BY 1),
 m AS (SELECT doc, l1, l2, {_walk(_drawn(seed + 4, 'doc'), 't', 'rest')} AS a FROM (SELECT *, unnest(range(least(greatest(pos * {ratio} - n, 0), rest)::BIGINT)) AS t FROM l)),
 e AS (SELECT doc, CASE WHEN a < l1 THEN 1 WHEN a < l1 + l2 THEN 2 ELSE 3 END AS pool, CASE WHEN a < l1 THEN a WHEN a < l1 + l2 THEN a - l1 ELSE a - l1 - l2 END AS k FROM m)
 SELECT doc, pool, prompt FROM q JOIN z USING (doc, pool) WHERE t < n UNION ALL
 SELECT doc, pool, prompt FROM q JOIN z USING (doc, pool) JOIN e USING (doc, pool) WHERE t = n + k"""


@query("neg_relations_all", _negatives_sql(-1, 4))
def neg_relations_all(spark, sf):
    """Ratio -1: everything of all three pools, whatever their size."""
    return N.relation_negatives(*supply(spark, sf), "doc", -1, 4)


@query("neg_relations_drawn", _negatives_sql(7, 4))
def neg_relations_drawn(spark, sf):
    """Two negatives per positive prompt from each pool, and one more from what is left."""
    return N.relation_negatives(*supply(spark, sf), "doc", 7, 4)

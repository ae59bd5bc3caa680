"""Queries of the numbered operators over whole tables, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm import (
    decontaminate,
    fill_middle,
    knn_quality,
    licenses,
    line_dedup,
    packing,
    quality_rules,
    repeats,
    simhash,
    token_counts,
    token_files,
    url_filter,
    whitening,
)
from veilframe.session import fresh_path, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql.strip()
        return fn
    return add


@query("op5_simhash_near_dedup")
def op5(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
                        F.col("component").alias("component_id"))


def word_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@query("op4_best_fit_packing")
def op4(spark, sf):
    found = packing.pack_documents(table(spark, sf, "documents"), word_tokenizer(), carry={"ids_crc32": F.crc32("ids")})
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


@query("op10_quality_rules")
def op10(spark, sf):
    return quality_rules.quality(table(spark, sf, "documents")).withColumnRenamed("id", "doc_id")


LINES = r"""WITH l AS (SELECT doc_id, u.i - 1 AS line, u.t AS t FROM (SELECT doc_id, unnest(list_transform(string_split(coalesce(text, ''), chr(10)),
  lambda x, i: {'i': i, 't': x})) AS u FROM documents)),
 w AS (SELECT doc_id, line, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM l),
 s AS (SELECT doc_id, line, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM w),
 c AS (SELECT s, min((doc_id, line)) AS f FROM s WHERE len(s) > 0 GROUP BY s),
 e AS (SELECT s, f, unnest(s) AS x FROM c),
 p AS (SELECT a.s, a.f, b.s AS o, count(*) AS n FROM e a JOIN e b ON a.x = b.x AND b.f < a.f GROUP BY ALL),
 m AS (SELECT DISTINCT s FROM p WHERE 9 * n >= 4 * (len(s) + len(o))),
 r AS (SELECT w.doc_id, w.line, w.t, coalesce((w.doc_id, w.line) <> c.f OR m.s IS NOT NULL, false) AS gone FROM w JOIN s USING (doc_id, line)
  LEFT JOIN c ON c.s = s.s LEFT JOIN m ON m.s = s.s)
 """


@query("op9_line_dedup", LINES + """SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
 sha256(coalesce(string_agg(t, chr(10) ORDER BY line) FILTER (NOT gone), '')) AS kept_sha256 FROM r GROUP BY doc_id""")
def op9(spark, sf):
    found = line_dedup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op8_benchmark_decontamination")
def op8(spark, sf):
    found = decontaminate.find(table(spark, sf, "documents"), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), F.col("item").alias("item_id"), "start", "end", "edits")


@query("op6_suffix_array_dedup")
def op6(spark, sf):
    found = repeats.remove_repeats(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"),
                        (F.col("n_removed") > 0).alias("repeats"))


@query("op7_quality_classifier")
def op7(spark, sf):
    docs = table(spark, sf, "documents")
    model = knn_quality.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return knn_quality.score(docs, model).withColumnRenamed("id", "doc_id")


def _license_sql() -> str:
    """The scan in SQL, from the same tables of sentences and rules."""
    q = lambda t: "'" + t.replace("'", "''") + "'"
    ws = "[ \\t\\n\\f]"
    norm = ("regexp_replace(regexp_replace(regexp_replace(lower(x), '[^a-z0-9.,+/-]+', ' ', 'g'), '^[ .,/-]+|[ .,;:/-]+$', '', 'g'), ' +', ' ', 'g')")
    known = "MAP {" + ", ".join(f"{q(licenses._plain(v))}: {q(k)}" for k, v in licenses.SENTENCES.items()) + "}"
    seq = "array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '')"
    for licence, rule in licenses.RULES:
        seq = f"replace({seq}, {q(''.join(f'<{x}>' for x in rule))}, {q('{' + licence + '}')})"
    cut = f"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(chr(10) || regexp_replace(coalesce(text, ''), '\\r\\n?', chr(10), 'g'),
      '\\n' || {q(licenses.LEADERS)}, chr(10), 'g'), '([.;:!?]){ws}+', '\\1' || chr(1), 'g'), '\\n[ \\t]*\\n', chr(1), 'g'), '(?i)\\n({licenses.HEADS})', chr(1) || '\\1', 'g')"""
    return f"""WITH s AS (SELECT doc_id, string_split({cut}, chr(1)) AS s FROM documents),
 i AS (SELECT doc_id, list_filter(list_transform(s, lambda x: {known}[{norm}]), lambda y: y IS NOT NULL) AS ids FROM s)
 SELECT doc_id, array_to_string(ids, ',') AS sentence_ids, array_to_string(regexp_extract_all({seq}, '\\{{([^}}]*)\\}}', 1), ',') AS licences FROM i"""


@query("op1_license_scan", _license_sql())
def op1(spark, sf):
    found = licenses.scan(table(spark, sf, "documents"))
    return found.select(F.col("id").alias("doc_id"), F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"))


URL_RULES = [url_filter.Rule("block", "net", "/"), url_filter.Rule("allow", "example.net", "/en/"),
             url_filter.Rule("block", "example.com", "/de/"), url_filter.Rule("allow", "org", "/fr/")]


def _url_sql() -> str:
    """The tree in SQL, level by level."""
    segs = "list_filter(string_split(regexp_replace(regexp_replace(path, '[0-9a-fA-F]{16,}', '{h}', 'g'), '[0-9]+', '{n}', 'g'), '/'), lambda s: s <> '')"
    abc = f"translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), '{url_filter.ABC}', '{url_filter.abc}')"
    out = f"""WITH l AS (SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END) AS label FROM labels GROUP BY 1),
 u AS (SELECT page_id, {abc} AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
  try_cast(nullif(regexp_extract(url, '^[^?#]*/([0-9]+)[^/?#]*/?([?#]|$)', 1), '') AS BIGINT) AS doc_id FROM pages),
 p AS (SELECT page_id, host, path, label, {segs} AS segs FROM u LEFT JOIN l USING (doc_id)),
 t0 AS (SELECT host, segs, count(*) AS n, count(*) FILTER (label = 1) AS good, count(*) FILTER (label = 0) AS bad, '' AS template FROM p GROUP BY 1, 2)"""
    for d in range(url_filter.DEPTH):
        out += f""",
 c{d} AS (SELECT host, template, segs[{d + 1}] AS seg, sum(n) AS n, sum(good) AS good, sum(bad) AS bad FROM t{d} WHERE len(segs) > {d} GROUP BY ALL),
 h{d} AS (SELECT host, template, sum(good) / nullif(sum(good) + sum(bad), 0) AS share FROM c{d} GROUP BY ALL),
 k{d} AS (SELECT host, template, seg FROM c{d} JOIN h{d} USING (host, template) WHERE n >= {url_filter.MIN_PAGES} AND good + bad > 0 AND share * (1 - share) > 0
  AND (good - (good + bad) * share) * (good - (good + bad) * share) > {url_filter.Z * url_filter.Z} * (good + bad) * share * (1 - share)),
 t{d + 1} AS (SELECT t.host, t.segs, t.n, t.good, t.bad, CASE WHEN len(t.segs) > {d} THEN t.template || '/' || coalesce(k.seg, '*') ELSE t.template END AS template
  FROM t{d} t LEFT JOIN k{d} k ON k.host = t.host AND k.template = t.template AND k.seg = t.segs[{d + 1}])"""
    text, action = "NULL", "NULL"
    for r in sorted(URL_RULES, key=lambda r: (len(r.host + r.path), r.host + r.path)):
        fits = f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
        text, action = f"CASE WHEN {fits} THEN '{r.host + r.path}' ELSE {text} END", f"CASE WHEN {fits} THEN '{r.action}' ELSE {action} END"
    return out + f""",
 t AS (SELECT host, segs, good, bad, template || CASE WHEN len(segs) > {url_filter.DEPTH} THEN '/**' ELSE '' END AS template FROM t{url_filter.DEPTH}),
 a AS (SELECT coalesce(sum(good) / nullif(sum(good) + sum(bad), 0), 1) AS a FROM t),
 h AS (SELECT host, (sum(good) + {url_filter.PRIOR} * any_value(a)) / (sum(good) + sum(bad) + {url_filter.PRIOR}) AS r FROM t, a GROUP BY host),
 x AS (SELECT host, template, (sum(good) + {url_filter.PRIOR} * any_value(r)) / (sum(good) + sum(bad) + {url_filter.PRIOR}) AS purity FROM t JOIN h USING (host) GROUP BY 1, 2)
 SELECT page_id, host, path, {text} AS rule, coalesce({action}, CASE WHEN purity < {url_filter.PURITY} THEN 'block' ELSE 'allow' END) AS verdict, template, round(purity, 6) AS purity
 FROM p JOIN t USING (host, segs) JOIN x USING (host, template)"""


@query("op2_url_filter", _url_sql())
def op2(spark, sf):
    """A page's label is that of the document whose number ends its path: good, if of quality and not toxic."""
    labels = spark.read.parquet(f"{sf}/labels.parquet").groupBy("doc_id").agg(
        F.min(F.when((F.col("quality") == 1) & (F.col("toxic") == 0), 1).otherwise(0)).alias("label"))
    number = F.regexp_extract("url", "^[^?#]*/([0-9]+)[^/?#]*/?([?#]|$)", 1)
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", F.when(number != "", number.try_cast("long")).alias("doc_id"))
    found = url_filter.judge(pages.join(labels, "doc_id", "left"), URL_RULES)
    return found.withColumnRenamed("id", "page_id").withColumn("purity", F.round("purity", 6))


EDIT_MASKS = {r"[\w.+-]+@[\w-]+\.[\w.]+": "[EMAIL]", r"\+?\d[\d() -]{6,}\d": "[NUMBER]", r"([#*$%&|<>])\1{2,}": r" "}


@query("op3_token_counts")
def op3(spark, sf):
    """Token counts of all documents before and after masking addresses and numbers and taking out runs of signs."""
    import public_tokenizers as t

    docs = table(spark, sf, "documents").select("doc_id", "text")
    done = token_counts.mask_and_count(docs, t.path("byte_bpe_50k.tiktoken"), t.PATTERN, EDIT_MASKS)
    return done.select("doc_id", "n_tokens_before", "n_edits", "n_reencoded", F.col("n_tokens").alias("n_tokens_after"),
                       F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


@query("op11_embedding_whitening")
def op11(spark, sf):
    return whitening.whiten(table(spark, sf, "embeddings")).withColumnRenamed("id", "vec_id")


@query("op12_token_files")
def op12(spark, sf):
    """All documents' ids written as token files in the shared folder, and what is read back from them."""
    import public_tokenizers

    path = fresh_path(spark, "tokens")
    token_files.write_tokens(table(spark, sf, "documents"), path, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.read_documents(spark, path, checksums=True).withColumnRenamed("id", "doc_id")


@query("op13_fill_in_middle")
def op13(spark, sf):
    found = fill_middle.fill_in_middle(table(spark, sf, "documents"))
    restored = fill_middle.restore(F.col("output"), F.col("form"))
    return found.select(F.col("id").alias("doc_id"), "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"),
                        F.sha2("output", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256"))

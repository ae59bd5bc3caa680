"""Queries over sources and sinks. File-based ones write the table out in the shared folder first."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from veilframe.operators.redact import redact
from veilframe.plans.registry import query
from veilframe.session import fresh_path, materialise, table
from veilframe.sources import readers as R
from veilframe.sources import text as X
from veilframe.streaming import redact as ST

SOURCE_OF = r"source=([^/]+)/"
LINES = """WITH l AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents) """


def staged_files(spark, sf):
    """The documents as one text folder per source, lines as records."""
    path = fresh_path(spark, "texts")
    table(spark, sf, "documents").select("source", "text").write.partitionBy("source").text(path)
    return path


def lines_of(df, file, order, text):
    """Table rows as the lines of a text file per group."""
    return df.select(F.col(file).cast("string").alias("file"), order.alias("line_no"), text.alias("text"))


@query("text_scan", LINES + """SELECT source, count(*) AS records,
 count(*) FILTER (trim(line, ' ' || chr(9) || chr(13)) = '') AS blank_records,
 sum(length(line) + 1)::BIGINT AS chars FROM l GROUP BY source""")
def text_scan(spark, sf):
    lines = X.scan(spark, staged_files(spark, sf))
    return (X.summary(lines).withColumn("source", F.regexp_extract("file", SOURCE_OF, 1))
            .groupBy("source").agg(F.sum("records").alias("records"),
                                   F.sum("blank_records").alias("blank_records"), F.sum("chars").alias("chars")))


@query("line_numbers", LINES + "SELECT source, count(*) AS lines, (count(*) * (count(*) + 1) / 2)::BIGINT AS line_no_sum FROM l GROUP BY source")
def line_numbers(spark, sf):
    """Line numbers of every file run from 1 to its record count."""
    lines = X.scan(spark, staged_files(spark, sf)).withColumn("source", F.regexp_extract("file", SOURCE_OF, 1))
    per_file = lines.groupBy("source", "file").agg(F.count("*").alias("n"), F.sum("line_no").alias("s"))
    return per_file.groupBy("source").agg(
        F.sum("n").alias("lines"),
        # several files per source: compare with the sum a single file would have
        (F.sum(F.col("s") - F.col("n") * (F.col("n") + 1) / 2).cast("long")
         + (F.sum("n") * (F.sum("n") + 1) / 2).cast("long")).alias("line_no_sum"))


@query("discover_inputs", "SELECT DISTINCT source, 0::BIGINT AS excluded FROM documents WHERE source <> 'src3'")
def discover_inputs(spark, sf):
    path = staged_files(spark, sf)
    found = X.discover(spark, path, exclude=["source=src3"])
    return found.groupBy(F.regexp_extract("file", SOURCE_OF, 1).alias("source")).agg(
        F.count_if(F.col("file").contains("source=src3/")).alias("excluded"))


@query("input_signature", "SELECT 0::BIGINT AS changed_without_write, count(DISTINCT source) > 0 AS changed_after_write FROM documents")
def input_signature(spark, sf):
    path = staged_files(spark, sf)
    before = materialise(X.discover(spark, path), "signature")
    same = X.changed(before, X.discover(spark, path)).agg(F.count("*").alias("changed_without_write"))
    same = materialise(same, "signature")
    table(spark, sf, "documents").select("source", "text").write.mode("append").partitionBy("source").text(path)
    grown = X.changed(before, X.discover(spark, path)).agg((F.count("*") > 0).alias("changed_after_write"))
    return same.join(F.broadcast(grown))  # two single rows


@query("redacted_files", """WITH RECURSIVE l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents),
 r AS (SELECT source, line, regexp_extract_all(line, '[0-9]{7,}') AS runs FROM l),
 g AS (SELECT source, sum(length(line) + 1)::BIGINT AS chars, count(*) AS records,
 coalesce(sum(list_sum(list_transform(runs, lambda x: length(x)))), 0)::BIGINT AS stars_added FROM r GROUP BY source)
 SELECT g.source, records, chars, stars_added + (SELECT sum(length(regexp_replace(line, '[^*]', '', 'g')))::BIGINT FROM l WHERE l.source = g.source) AS stars FROM g""")
def redacted_files(spark, sf):
    """Scan, redact, publish every input under its relative path, read the published files back."""
    path, out = staged_files(spark, sf), fresh_path(spark, "redacted")
    X.write_text(redact(X.scan(spark, path)), out, path, "redacted")
    back = spark.read.option("recursiveFileLookup", "true").text(out)
    return back.groupBy(F.regexp_extract("_metadata.file_path", r"source=([^/]+)/", 1).alias("source")).agg(
        F.count("*").alias("records"), F.sum(F.length("value") + 1).alias("chars"),
        F.sum(F.length(F.regexp_replace("value", "[^*]", ""))).alias("stars"))


DOC_LINES = LINES + """, m AS (SELECT doc_id, count(*) AS records, sum(length(line) + 1)::BIGINT AS chars,
 count(*) FILTER (trim(line, ' ' || chr(9) || chr(13)) = '') AS blank_records, max(length(line) + 1) AS max_len FROM l GROUP BY doc_id) """


def doc_manifest(spark, sf):
    """Every document as one file of lines."""
    d = table(spark, sf, "documents")
    lines = d.select(F.col("doc_id").alias("file"), F.posexplode(F.split("text", "\n")).alias("line_no", "text"))
    lines = lines.withColumn("eol", F.lit("\n")).withColumn("failed", F.length("text") + 1 > 2000)
    return X.summary(lines)


@query("manifest", DOC_LINES + """SELECT doc_id AS file, CASE WHEN max_len > 2000 THEN 'failed' ELSE 'ok' END AS status,
 records, blank_records, chars, max_len AS max_record_chars,
 CASE WHEN max_len > 2000 THEN 'RecordTooLong' END AS error_type FROM m""")
def manifest(spark, sf):
    return doc_manifest(spark, sf)


@query("manifest_totals", DOC_LINES + """SELECT doc_id AS file, count(*) AS files, sum(records)::BIGINT AS records,
 sum(blank_records)::BIGINT AS blank_records, sum(chars)::BIGINT AS chars, max(max_len) AS max_record_chars
 FROM m GROUP BY ROLLUP (doc_id)""")
def manifest_totals(spark, sf):
    return X.rollup(doc_manifest(spark, sf))


@query("skip_done", DOC_LINES + "SELECT doc_id AS file FROM m WHERE max_len > 2000 OR chars = 0")
def skip_done(spark, sf):
    inputs = table(spark, sf, "documents").select(F.col("doc_id").alias("file"))
    return X.pending(inputs, doc_manifest(spark, sf))


@query("output_collisions", """WITH d AS (SELECT 'out/' || source AS dest, count(*) AS n FROM documents GROUP BY 1)
 SELECT dest, CASE WHEN n > 1 THEN 'second output' ELSE 'protected' END AS reason FROM d WHERE n > 1 OR dest = 'out/src0'""")
def output_collisions(spark, sf):
    d = table(spark, sf, "documents").select(F.concat_ws("/", F.lit("in"), "source", "doc_id").alias("file"), "source")
    return X.check_outputs(d, F.concat(F.lit("out/"), "source"), ["out/src0"])


@query("stream_directory", """WITH l AS (SELECT source, unnest(string_split(text, chr(10))) AS line FROM documents)
 SELECT source, count(*) AS records, sum(length(line) + 1)::BIGINT AS chars FROM l GROUP BY source""")
def stream_directory(spark, sf):
    """Incremental run over a directory; a second run on unchanged input must add nothing."""
    path, out = staged_files(spark, sf), fresh_path(spark, "stream")
    first = ST.run_directory(spark, path, out)
    both = first.union(ST.run_directory(spark, path, out))
    return both.groupBy(F.regexp_extract("input", SOURCE_OF, 1).alias("source")).agg(
        F.sum("records").alias("records"), F.sum("chars").alias("chars"))


@query("stream_records", """WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[0-9]{7,}')) AS run FROM documents)
 SELECT doc_id, sum(length(run))::BIGINT AS masked FROM r GROUP BY doc_id""")
def stream_records(spark, sf):
    """Unbounded record stream through the same column functions, written exactly once."""
    schema = table(spark, sf, "documents").schema
    src = fresh_path(spark, "docs")
    table(spark, sf, "documents").write.parquet(src)
    out = ST.redact_stream(spark.readStream.schema(schema).parquet(src), fresh_path(spark, "redacted"))
    rows = spark.read.parquet(out)
    stars = lambda c: F.length(F.regexp_replace(c, "[^*]", ""))
    return rows.select("doc_id", (stars("redacted") - stars("text")).cast("long").alias("masked")).where("masked > 0")


# readers -----------------------------------------------------------------------------------

@query("read_json_lines", "SELECT doc_id AS id, lang, n_chars FROM documents")
def read_json_lines(spark, sf):
    d = table(spark, sf, "documents")
    lines = lines_of(d, "source", F.col("doc_id"), F.to_json(F.struct("lang", "n_chars", "text")))
    return R.json_lines(lines, "lang string, n_chars long, text string").select("id", "lang", "n_chars")


@query("read_nested_qa", """SELECT conv_id || '-' || turn AS id, role AS question, length(text)::BIGINT AS answer_chars,
 (turn % 2 = 1) AS is_impossible FROM conversations""")
def read_nested_qa(spark, sf):
    c = table(spark, sf, "conversations")
    qas = F.array(F.struct(
        F.concat_ws("-", "conv_id", "turn").alias("id"), F.col("role").alias("question"),
        (F.col("turn") % 2 == 1).alias("is_impossible"),
        F.array(F.struct(F.col("text"), F.lit(0).alias("answer_start"))).alias("answers")))
    paragraphs = F.array(F.struct(F.col("text").alias("context"), qas.alias("qas")))
    docs = c.select(F.to_json(F.struct(F.array(F.struct(F.col("role").alias("title"), paragraphs.alias("paragraphs"))).alias("data"))).alias("j"))
    parsed = docs.select(F.from_json("j", R.QA_SCHEMA).alias("x")).select("x.*")
    return R.nested_qa(parsed, single_answer=True).select(
        "id", "question", F.length(F.element_at("answers", 1)).cast("long").alias("answer_chars"), "is_impossible")


@query("read_tsv", """SELECT c_nationkey::VARCHAR AS file, c_mktsegment AS label, c_name AS text FROM
 (SELECT *, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS line FROM customer) WHERE line > 1""")
def read_tsv(spark, sf):
    c = table(spark, sf, "customer")
    line = F.row_number().over(Window.partitionBy("c_nationkey").orderBy("c_custkey"))
    lines = lines_of(c, "c_nationkey", line, F.concat_ws("\t", "c_mktsegment", "c_custkey", "c_name"))
    return R.tsv(lines, {"label": 0, "text": 2}, header=1).select("file", "label", "text")


@query("read_tagged_tsv", """SELECT p_partkey, len(string_split(p_name, ' '))::BIGINT AS n_tokens,
 upper(string_split(p_name, ' ')[2]) AS second_tag FROM part""")
def read_tagged_tsv(spark, sf):
    p = table(spark, sf, "part")
    sep = lambda c: F.regexp_replace(c, " ", "\u0002")
    lines = lines_of(p, "p_brand", F.col("p_partkey"), F.concat_ws("\t", sep("p_name"), sep(F.upper("p_name"))))
    return R.tagged_tsv(lines).select(F.col("line_no").alias("p_partkey"), F.size("tokens").cast("long").alias("n_tokens"),
                                      F.get("labels", F.lit(1)).alias("second_tag"))


@query("read_column_blocks", """WITH l AS (SELECT l_orderkey, l_partkey, row_number() OVER (PARTITION BY l_linenumber
 ORDER BY l_orderkey, l_partkey, l_suppkey) AS line, l_linenumber AS file, l_returnflag AS tok FROM lineitem),
 b AS (SELECT *, sum(CASE WHEN tok = 'R' THEN 1 ELSE 0 END) OVER (PARTITION BY file ORDER BY line)::BIGINT AS block FROM l)
 SELECT file::VARCHAR AS file, block, count(*) AS n, md5(string_agg(tok || '/' || l_partkey, ' ' ORDER BY line)) AS body
 FROM b WHERE tok <> 'R' GROUP BY 1, 2""")
def read_column_blocks(spark, sf):
    """lineitem as column files, one per line number; returned items stand for the blank lines."""
    li = table(spark, sf, "lineitem")
    order = F.struct("l_orderkey", "l_partkey", "l_suppkey")
    text = F.when(F.col("l_returnflag") == "R", "").otherwise(F.concat_ws(" ", "l_returnflag", "l_partkey"))
    blocks = R.column_blocks(lines_of(li, "l_linenumber", order, text), {"tok": 0, "tag": 1})
    pairs = F.zip_with("tok", "tag", lambda a, b: F.concat_ws("/", a, b))
    return blocks.select("file", "block", F.size("tok").cast("long").alias("n"),
                         F.md5(F.array_join(pairs, " ")).alias("body"))


@query("zip_parallel", """SELECT s.item_id AS line_no, md5(trim(s.text)) AS source, md5(trim(t.text)) AS target
 FROM benchmark s JOIN documents t ON s.item_id = t.doc_id""")
def zip_parallel(spark, sf):
    b = lines_of(table(spark, sf, "benchmark"), "item_id", F.col("item_id"), F.col("text"))
    d = lines_of(table(spark, sf, "documents"), "doc_id", F.col("doc_id"), F.col("text"))
    return R.zip_lines(b, d).select("line_no", F.md5("source").alias("source"), F.md5("target").alias("target"))


@query("zip_languages", """SELECT o_orderkey AS line_no, upper(o_orderpriority) || '|' || lower(o_orderpriority) AS both_texts FROM orders WHERE o_orderstatus <> 'P'""")
def zip_languages(spark, sf):
    o = table(spark, sf, "orders")
    one = lines_of(o, "o_custkey", F.col("o_orderkey"), F.upper("o_orderpriority"))
    two = lines_of(o.where("o_orderstatus <> 'P'"), "o_custkey", F.col("o_orderkey"), F.lower("o_orderpriority"))
    z = R.zip_languages({"en": one, "fr": two})
    return z.select("line_no", F.concat_ws("|", F.col("translations")["en"], F.col("translations")["fr"]).alias("both_texts"))


@query("read_directory_labelled", """SELECT CASE lang WHEN 'en' THEN 'pos' ELSE 'neg' END AS label, md5(first(string_split(text, chr(10))[1] ORDER BY doc_id)) AS text
 FROM documents GROUP BY lang = 'en', lang, source QUALIFY row_number() OVER (PARTITION BY lang = 'en', source ORDER BY min(doc_id)) = 1""")
def read_directory_labelled(spark, sf):
    """One file per label and source, documents in id order; only its first line is read."""
    path = fresh_path(spark, "labelled")
    d = table(spark, sf, "documents").select("doc_id", "lang", "source", "text")
    for label, cond in (("pos", "lang = 'en'"), ("neg", "lang <> 'en'")):
        (d.where(cond).repartition("source").sortWithinPartitions("source", "doc_id").select("source", "text")
         .write.partitionBy("source").text(f"{path}/{label}"))
    return R.directory_labelled(X.scan(spark, path), ["pos", "neg"]).select("label", F.md5("text").alias("text"))


@query("read_xml_articles", "SELECT p_partkey::VARCHAR AS id, p_type AS label, p_name || ' ' || p_brand AS text FROM part")
def read_xml_articles(spark, sf):
    path = fresh_path(spark, "xml")
    (table(spark, sf, "part").select(
        F.col("p_partkey").alias("_id"), F.col("p_type").alias("_hyperpartisan"), F.array("p_name", "p_brand").alias("p"))
     .write.option("rootTag", "articles").option("rowTag", "article").xml(path))
    return R.xml_articles(spark, path)


@query("read_first_tab", "SELECT c_custkey AS line_no, c_mktsegment AS label, c_name || chr(9) || c_nationkey AS text FROM customer")
def read_first_tab(spark, sf):
    c = table(spark, sf, "customer")
    lines = lines_of(c, "c_nationkey", F.col("c_custkey"), F.concat_ws("\t", "c_mktsegment", "c_name", "c_nationkey"))
    return R.first_tab(lines).select("line_no", "label", "text")


@query("read_hierarchical", """SELECT p_partkey AS line_no, p_name AS sentence, 2::BIGINT AS n_levels, p_type AS top, p_brand || ';' || p_size AS second FROM part""")
def read_hierarchical(spark, sf):
    p = table(spark, sf, "part")
    text = F.concat_ws("\t", "p_name", F.concat(F.lit(" "), "p_type"), F.concat_ws(",", "p_brand", "p_size"))
    h = R.hierarchical_labels(lines_of(p, "p_brand", F.col("p_partkey"), text))
    return h.select("line_no", "sentence", F.size("levels").cast("long").alias("n_levels"),
                    F.col("levels")[0][0].alias("top"), F.array_join(F.col("levels")[1], ";").alias("second"))


@query("sentence_term", """SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN -1 WHEN l_returnflag = 'A' THEN -2
 ELSE l_quantity::INT END AS label FROM lineitem""")
def sentence_term(spark, sf):
    meta = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", F.to_json(F.struct(
        (F.col("l_returnflag") == "R").alias("life"), (F.col("l_returnflag") == "A").alias("death"),
        F.col("l_quantity").cast("int").alias("months"))).alias("j"))
    m = meta.withColumn("m", F.from_json("j", "life boolean, death boolean, months int"))
    return m.select("l_orderkey", "l_partkey", "l_suppkey",
                    R.sentence_term(F.col("m.life"), F.col("m.death"), F.col("m.months")).alias("label"))


@query("linked_stories", """WITH keep AS (SELECT page_id, url FROM pages WHERE page_id % 2 = 0),
 l AS (SELECT p.page_id, p.url, generate_subscripts(string_split(d.text, chr(10)), 1) AS n,
 lower(trim(unnest(string_split(d.text, chr(10))))) AS t FROM pages p JOIN documents d ON p.page_id = d.doc_id WHERE p.url IN (SELECT url FROM keep)),
 k AS (SELECT url, page_id, n, CASE WHEN right(t, 1) IN ('.', '!', '?', '''', '`', '"', '’', '”', ')') THEN t ELSE t || ' .' END AS t
 FROM l WHERE t <> '')
 SELECT sha1(url) AS stem, md5(string_agg(t, ' ' ORDER BY page_id, n)) AS article, '' AS highlights FROM k GROUP BY url""")
def linked_stories(spark, sf):
    """Stories named by the SHA-1 of their page url; only every second url is listed."""
    pages = table(spark, sf, "pages").select("page_id", "url")
    d = table(spark, sf, "documents").select(F.col("doc_id").alias("page_id"), "text")
    lines = pages.join(d, "page_id").select(
        F.concat(F.sha1("url"), F.lit(".story")).alias("file"), "page_id",
        F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    lines = lines.select("file", F.struct("page_id", "pos").alias("line_no"), "text")
    out = R.linked_stories(pages.where("page_id % 2 = 0"), lines)
    return out.select("stem", F.md5("article").alias("article"), "highlights")


@query("bioes_tags", """SELECT c_custkey, string_agg(CASE WHEN i < 2 THEN CASE i WHEN 0 THEN 'B-x' ELSE 'E-x' END
 WHEN i = 4 THEN 'S-z' WHEN i BETWEEN 5 AND 7 THEN CASE i WHEN 5 THEN 'B-y' WHEN 7 THEN 'E-y' ELSE 'I-y' END ELSE 'O' END, ' ' ORDER BY i) AS tags
 FROM (SELECT c_custkey, unnest(range(length(c_mktsegment))) AS i FROM customer) GROUP BY 1""")
def bioes_tags(spark, sf):
    sp = lambda a, b, t: F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(t).alias("type"))
    spans = F.array(sp(5, 8, "y"), sp(0, 1, "w"), sp(0, 2, "x"), sp(4, 5, "z"))
    c = table(spark, sf, "customer")
    return c.select("c_custkey", F.array_join(R.bioes_tags(F.col("c_mktsegment"), spans), " ").alias("tags"))


@query("entity_bi_tags", """SELECT p_partkey, repeat('O', instr(p_name, 'widget') - 1) || 'BIIIII' AS tags FROM part WHERE contains(p_name, 'widget')""")
def entity_bi_tags(spark, sf):
    p = table(spark, sf, "part").withColumn("tags", R.entity_bi_tags(F.col("p_name"), F.lit("widget")))
    return p.where("tags is not null").select("p_partkey", F.array_join("tags", "").alias("tags"))


@query("annotation_export", """SELECT o_orderkey AS id, 'entity' AS kind, 0::BIGINT AS start, length(o_orderstatus)::BIGINT AS "end", o_orderstatus AS label FROM orders
 UNION ALL SELECT o_orderkey, 'choice', NULL, NULL, o_orderpriority FROM orders UNION ALL SELECT o_orderkey, 'relation', NULL, NULL, 'of' FROM orders""")
def annotation_export(spark, sf):
    o = table(spark, sf, "orders")
    null = lambda t: F.lit(None).cast(t)
    value = lambda s, e, labels, choices: F.struct(
        s.cast("int").alias("start"), e.cast("int").alias("end"), F.col("o_orderstatus").alias("text"),
        labels.alias("labels"), choices.alias("choices"))
    item = lambda id_, kind, labels, v: F.struct(
        F.lit(id_).alias("id"), F.lit(kind).alias("type"), F.lit("a").alias("from_id"), F.lit("b").alias("to_id"),
        labels.alias("labels"), v.alias("value"))
    none = null("array<string>")
    items = F.array(
        item("a", "labels", none, value(F.lit(0), F.length("o_orderstatus"), F.array("o_orderstatus"), none)),
        item("b", "choices", none, value(null("int"), null("int"), none, F.array("o_orderpriority"))),
        item("c", "relation", F.array(F.lit("of")), value(null("int"), null("int"), none, none)))
    doc = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.struct(F.col("o_orderpriority").alias("text")).alias("data"),
                             F.array(F.struct(items.alias("result"))).alias("annotations")))
    rows = o.select(F.from_json(doc, R.EXPORT_SCHEMA).alias("x")).select("x.*")
    return R.annotation_export(rows).select("id", "kind", F.col("start").cast("long").alias("start"),
                                            F.col("end").cast("long").alias("end"), "label")


@query("vocabulary_file", "SELECT c_name AS token, row_number() OVER (ORDER BY c_custkey) - 1 AS id FROM customer")
def vocabulary_file(spark, sf):
    """Save a vocabulary as text sorted by id, load it back with ids from the line order."""
    path = fresh_path(spark, "vocab")
    table(spark, sf, "customer").repartitionByRange(1, "c_custkey").sortWithinPartitions("c_custkey") \
        .select("c_name").write.text(path)
    return R.vocabulary(X.scan(spark, path)).select("token", "id")


@query("tag_lexicon", "SELECT DISTINCT replace(p_name, ' ', '') AS phrase, 'n|' AS tags, '0|' || instr(p_name, ' ') - 1 AS offsets FROM part")
def tag_lexicon(spark, sf):
    p = table(spark, sf, "part").select("p_name").distinct()
    lines = lines_of(p, "p_name", F.lit(1), F.regexp_replace("p_name", " ", "/n "))
    lex = R.tag_lexicon(lines)
    return lex.select("phrase", F.array_join("tags", "|").alias("tags"),
                      F.array_join(F.transform("offsets", lambda x: x.cast("string")), "|").alias("offsets"))


@query("augment_file_column", """SELECT c_custkey AS line_no, c_nationkey || '#' || v || '#' || c_custkey AS text FROM customer,
 LATERAL (SELECT unnest([upper(c_mktsegment), lower(c_mktsegment)]) AS v)""")
def augment_file_column(spark, sf):
    c = table(spark, sf, "customer")
    lines = lines_of(c, "c_nationkey", F.col("c_custkey"), F.concat_ws("#", "c_nationkey", "c_mktsegment", "c_custkey"))
    picked = R.separated_column(lines, "#", 1).withColumn(
        "variant", F.explode(F.array(F.upper("sequence"), F.lower("sequence"))))
    return picked.select("line_no", R.rebuild_column(F.col("parts"), 1, F.col("variant"), "#").alias("text"))


@query("load_splits", """SELECT CASE WHEN c_nationkey < 10 THEN 'train' ELSE 'dev' END AS split, c_mktsegment AS label, count(*) AS n
 FROM customer GROUP BY 1, 2""")
def load_splits(spark, sf):
    c = table(spark, sf, "customer")
    lines = lines_of(c, "c_nationkey", F.col("c_custkey") + 2, F.concat_ws("\t", "c_mktsegment", "c_name"))
    both = R.load_layout("sentiment_tsv", {"train": lines.where("cast(file as int) < 10"),
                                           "dev": lines.where("cast(file as int) >= 10")})
    return both.groupBy("split", "label").agg(F.count("*").alias("n"))


@query("load_declared_layouts", """SELECT 'pair_jsonl' AS layout, c_custkey AS line_no, c_mktsegment AS label, c_name AS first FROM customer
 UNION ALL SELECT 'translation_jsonl', c_custkey, NULL, c_name FROM customer UNION ALL SELECT 'keyword_jsonl', c_custkey, c_mktsegment, c_name || '|' || c_mktsegment FROM customer
 UNION ALL SELECT 'similarity_tsv', c_custkey, c_nationkey::VARCHAR, c_name FROM customer UNION ALL SELECT 'acceptability_tsv', c_custkey, c_nationkey::VARCHAR, c_name FROM customer""")
def load_declared_layouts(spark, sf):
    """Customers written in five layouts and read by their declared schemas."""
    c = table(spark, sf, "customer")
    name, segment, nation = F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey").cast("string")
    blank = F.lit("-")
    rows = {
        "pair_jsonl": (F.to_json(F.struct(name.alias("sentence1"), segment.alias("sentence2"), segment.alias("label"))), "label", "sentence1"),
        "translation_jsonl": (F.to_json(F.struct(F.create_map(F.lit("en"), name, F.lit("de"), segment).alias("translation"))), None, "translation['en']"),
        "keyword_jsonl": (F.to_json(F.struct(name.alias("abst"), F.array(name, segment).alias("keyword"), segment.alias("label"))),
                          "label", "array_join(keyword, '|')"),
        "similarity_tsv": (F.concat_ws("\t", F.col("c_custkey").cast("string"), *[blank] * 6, name, segment, nation), "score", "sentence1"),
        "acceptability_tsv": (F.concat_ws("\t", blank, nation, blank, name), "label", "sentence"),
    }
    out = None
    for layout, (text, label, first) in rows.items():
        number = F.col("c_custkey") + 2  # the first line of files with a header is line 1
        lines = c.select(F.lit("f").alias("file"), number.alias("line_no"), text.alias("text"))
        got = R.load_layout(layout, {"train": lines}).select(
            F.lit(layout).alias("layout"), (F.col("line_no" if layout.endswith("tsv") else "id") - 2).alias("line_no"), (F.col(label).cast("string") if label else F.lit(None).cast("string")).alias("label"),
            F.expr(first).alias("first"))
        out = got if out is None else out.unionByName(got)
    return out

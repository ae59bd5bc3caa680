"""Readers for common annotation and benchmark layouts.

Each reader takes lines(file, line_no, text) as made by sources.text.scan, or a path for the
multi-line formats, and returns a DataFrame with an explicit schema.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions.fold import let
from veilframe.operators.ordering import running


def require_rows(df: DataFrame) -> DataFrame:
    if df.isEmpty():
        raise ValueError("the source holds no rows")
    return df


def json_lines(lines: DataFrame, schema: str) -> DataFrame:
    """One JSON object per line; the line number is the surrogate id."""
    return lines.select("file", F.col("line_no").alias("id"),
                        F.from_json("text", schema).alias("_j")).select("file", "id", "_j.*")


QA_SCHEMA = ("data array<struct<title:string,paragraphs:array<struct<context:string,"
             "qas:array<struct<id:string,question:string,is_impossible:boolean,"
             "answers:array<struct<text:string,answer_start:int>>>>>>>>")


def nested_qa(docs: DataFrame, single_answer: bool = False) -> DataFrame:
    """data -> paragraphs -> qas -> answers, one row per question, from a QA_SCHEMA frame."""
    out = (docs.select(F.explode("data").alias("d"))
           .select("d.title", F.explode("d.paragraphs").alias("p"))
           .select("title", "p.context", F.explode("p.qas").alias("q"))
           .select("q.id", "title", "context", "q.question",
                   F.transform("q.answers", lambda a: a["text"]).alias("answers"),
                   F.transform("q.answers", lambda a: a["answer_start"]).alias("answer_starts"),
                   F.coalesce("q.is_impossible", F.lit(False)).alias("is_impossible")))
    return out.where(F.size("answers") == 1) if single_answer else out


def read_nested_qa(spark: SparkSession, path: str, single_answer: bool = False) -> DataFrame:
    return nested_qa(spark.read.schema(QA_SCHEMA).option("multiLine", "true").json(path), single_answer)


def choice_label(answer: Column, choices: Column) -> Column:
    """0-based position of the answer in the choices."""
    return F.array_position(choices, answer) - 1


def tsv(lines: DataFrame, columns: dict[str, int], header: int = 0) -> DataFrame:
    """Columns picked by position; the first `header` lines of every file are dropped."""
    parts = F.split("text", "\t", -1)
    picked = [F.get(parts, F.lit(i)).alias(name) for name, i in columns.items()]
    return lines.where(F.col("line_no") > header).select("file", "line_no", *picked)


def tagged_tsv(lines: DataFrame) -> DataFrame:
    """tokens<TAB>tags, both joined by U+0002."""
    parts = F.split("text", "\t", -1)
    return lines.select("file", "line_no", F.split(F.get(parts, F.lit(0)), "\u0002").alias("tokens"),
                        F.split(F.get(parts, F.lit(1)), "\u0002").alias("labels"))


def column_blocks(lines: DataFrame, columns: dict[str, int], sep: str = " ") -> DataFrame:
    """Blank-line separated blocks of columns -> one row of arrays per block; empty blocks vanish."""
    blank = F.trim("text") == ""
    flagged = lines.select("file", "line_no", "text", blank.cast("long").alias("_blank"))
    numbered = running(flagged, ["line_no"], {"block": ("sum", "_blank")}, by=["file"])
    parts = F.split("text", sep, -1)
    item = F.struct("line_no", *[F.get(parts, F.lit(i)).alias(n) for n, i in columns.items()])
    out = (numbered.where("_blank = 0").groupBy("file", "block")
           .agg(F.sort_array(F.collect_list(item)).alias("_g")))
    return out.select("file", "block", *[F.col("_g")[n].alias(n) for n in columns])


def zip_lines(source: DataFrame, target: DataFrame) -> DataFrame:
    """Two parallel files joined by line; pairs blank on both sides are dropped."""
    s = source.select("line_no", F.trim("text").alias("source"))
    t = target.select("line_no", F.trim("text").alias("target"))
    return s.join(t, "line_no").where("source <> '' or target <> ''")


def zip_languages(by_language: dict[str, DataFrame]) -> DataFrame:
    """Aligned files -> line_no, translations map<language, text>; lines missing in one are dropped."""
    rows = None
    for lang, lines in by_language.items():
        part = lines.select("line_no", F.lit(lang).alias("lang"), "text")
        rows = part if rows is None else rows.unionByName(part)
    grouped = rows.groupBy("line_no").agg(F.map_from_entries(F.sort_array(
        F.collect_list(F.struct("lang", "text")))).alias("translations"))  # one entry per language
    return grouped.where(F.size("translations") == len(by_language))


def directory_labelled(lines: DataFrame, labels: list[str]) -> DataFrame:
    """First line of every file below .../<label>/."""
    label = F.regexp_extract("file", "/(" + "|".join(labels) + ")/", 1)
    return lines.where("line_no = 1").select("file", label.alias("label"), "text").where("label <> ''")


def xml_articles(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("_id", "_hyperpartisan", "_VALUE")]
                          + [T.StructField("p", T.ArrayType(T.StringType()))])
    docs = spark.read.option("rowTag", "article").schema(schema).xml(path)
    return docs.select(F.col("_id").alias("id"), F.col("_hyperpartisan").alias("label"),
                       F.coalesce(F.array_join("p", " "), F.col("_VALUE")).alias("text"))


def first_tab(lines: DataFrame) -> DataFrame:
    """label<TAB>text, cut at the first tab; lines without one are dropped."""
    pattern = r"^([^\t]*)\t([\s\S]*)$"
    return lines.where(F.col("text").contains("\t")).select(
        "file", "line_no", F.regexp_extract("text", pattern, 1).alias("label"),
        F.regexp_extract("text", pattern, 2).alias("text"))


def hierarchical_labels(lines: DataFrame) -> DataFrame:
    """text<TAB>level1<TAB>level2...: every level a comma list."""
    parts = F.split("text", "\t", -1)
    levels = F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda x: F.split(F.trim(x), ","))
    return lines.select("file", "line_no", F.get(parts, F.lit(0)).alias("sentence"), levels.alias("levels"))


def sentence_term(life: Column, death: Column, months: Column) -> Column:
    """Prison term label: life -1, death -2, else months."""
    return F.when(life, -1).when(death, -2).otherwise(months)


def linked_stories(urls: DataFrame, story_lines: DataFrame, marker: str = "@highlight") -> DataFrame:
    """Stories whose file stem is the SHA-1 of a listed url, split into article and highlights.

    A highlight is a line behind a marker line, up to the next marker; lines that end without
    final punctuation get a period.
    """
    wanted = urls.select(F.sha1("url").alias("stem")).distinct()
    stem = F.regexp_extract("file", r"([0-9a-f]{40})\.\w+$", 1)
    lines = (story_lines.withColumn("stem", stem).join(wanted, "stem", "left_semi")
             .withColumn("text", F.lower(F.trim("text"))).where("text <> ''"))
    # fixed values: line endings that need no period
    ends = [".", "!", "?", "...", "'", "`", '"', "’", "”", ")"]
    needs = ~F.substring("text", -1, 1).isin([e[-1] for e in ends]) & ~F.col("text").contains(marker)
    lines = lines.withColumn("text", F.when(needs, F.concat("text", F.lit(" ."))).otherwise(F.col("text")))
    is_marker = F.col("text").startswith(marker)
    tagged = running(lines.withColumn("_m", is_marker.cast("long")).select("stem", "line_no", "text", "_m"),
                     ["line_no"], {"_seen": ("sum", "_m")}, by=["stem"])
    body = tagged.where("_m = 0")
    joined = lambda cond: F.array_join(F.transform(F.sort_array(F.collect_list(
        F.when(cond, F.struct("line_no", "text")))), lambda x: x["text"]), " ")
    return body.groupBy("stem").agg(joined(F.col("_seen") == 0).alias("article"),
                                    joined(F.col("_seen") > 0).alias("highlights"))


def bioes_tags(text: Column, spans: Column) -> Column:
    """array<struct<start,end,type>> (end exclusive) -> one BIOES tag per character.

    Where spans share characters the one that starts first wins, the longer one on equal starts.
    """
    ranked = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), (-s["end"]).alias("neg"), s["end"].alias("end"), s["type"].alias("type"))))

    def tag(spans_, pos):
        hit = F.get(F.filter(spans_, lambda s: (s["start"] <= pos) & (pos < s["end"])), F.lit(0))
        kind = (F.when(hit["end"] - hit["start"] == 1, "S-").when(pos == hit["start"], "B-")
                .when(pos == hit["end"] - 1, "E-").otherwise("I-"))
        return F.when(hit.isNull(), "O").otherwise(F.concat(kind, hit["type"]))

    positions = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)) \
                 .otherwise(F.array().cast("array<int>"))
    return let(ranked, lambda r: F.transform(positions, lambda p: tag(r, p)))


def entity_bi_tags(text: Column, entity: Column) -> Column:
    """B/I/O per character for the first occurrence of an entity; null when it does not occur."""
    at = F.instr(text, entity)
    tags = let(F.struct(at.alias("lo"), (at + F.length(entity)).alias("hi")), lambda e: F.transform(
        F.sequence(F.lit(1), F.length(text)), lambda p: F.when(p == e["lo"], "B").when(
            (p > e["lo"]) & (p < e["hi"]), "I").otherwise("O")))
    return F.when((at > 0) & (F.length(entity) > 0), tags)


ANNOTATION_SCHEMA = ("id long, text string, entities array<struct<id:long,start_offset:int,end_offset:int,"
                     "label:string>>, relations array<struct<id:long,from_id:long,to_id:long,type:string>>")
EXPORT_SCHEMA = ("id long, data struct<text:string>, annotations array<struct<result:array<struct<"
                 "id:string,type:string,from_id:string,to_id:string,labels:array<string>,value:struct<"
                 "start:int,end:int,text:string,labels:array<string>,choices:array<string>>>>>>")


def annotation_export(rows: DataFrame) -> DataFrame:
    """Labelling-tool export -> long table: kind entity / relation / choice, one row each."""
    items = (rows.select("id", F.col("data.text").alias("text"), F.explode("annotations").alias("a"))
             .select("id", "text", F.explode("a.result").alias("r")))
    kind = F.when(F.col("r.type") == "labels", "entity").when(F.col("r.type") == "choices", "choice") \
            .otherwise("relation")
    return items.select(
        "id", "text", kind.alias("kind"), F.col("r.id").alias("item_id"),
        F.col("r.value.start").alias("start"), F.col("r.value.end").alias("end"),
        F.coalesce(F.get("r.value.labels", F.lit(0)), F.get("r.labels", F.lit(0)),
                   F.get("r.value.choices", F.lit(0))).alias("label"),
        F.col("r.from_id").alias("from_id"), F.col("r.to_id").alias("to_id"))


def vocabulary(lines: DataFrame) -> DataFrame:
    """One token per line; the id is the line order from 0."""
    return lines.select(F.col("text").alias("token"), (F.col("line_no") - 1).alias("id"))


def tag_lexicon(lines: DataFrame) -> DataFrame:
    """`word/tag word/tag` lines -> phrase, tags, word offsets in the phrase; untagged words get ''."""
    units = F.filter(F.split(F.trim("text"), r"\s+"), lambda u: u != "")
    word = lambda u: F.regexp_replace(u, "/[^/]*$", "")
    words, tags = F.transform(units, word), F.transform(
        units, lambda u: F.when(u.contains("/"), F.substring_index(u, "/", -1)).otherwise(""))
    offsets = let(words, lambda ws: F.transform(ws, lambda w, i: F.aggregate(
        F.slice(ws, F.lit(1), i), F.lit(0), lambda acc, x: acc + F.length(x))))
    return lines.where(F.trim("text") != "").select(
        F.array_join(words, "").alias("phrase"), tags.alias("tags"), offsets.alias("offsets"))


def separated_column(lines: DataFrame, sep: str, column: int) -> DataFrame:
    """Pick one separated column for augmentation; `parts` keeps the row for rebuild_column."""
    parts = F.split("text", sep, -1)
    return lines.select("file", "line_no", parts.alias("parts"), F.get(parts, F.lit(column)).alias("sequence"))


def rebuild_column(parts: Column, column: int, variant: Column, sep: str) -> Column:
    return F.array_join(F.transform(parts, lambda p, i: F.when(i == column, variant).otherwise(p)), sep)


# Named datasets: name -> (reader of lines, split names). Local files resolve by split name.
LAYOUTS = {
    "sentiment_tsv": (lambda ls: tsv(ls, {"label": 0, "text": 1}, header=1), ("train", "dev", "test")),
    "sentence_pairs_tsv": (lambda ls: tsv(ls, {"sentence1": 0, "sentence2": 1, "labels": 2}),
                           ("train", "dev", "test")),
    "tagged_tokens": (lambda ls: tagged_tsv(ls.where("line_no > 1")), ("train", "dev", "test")),
    "column_blocks": (lambda ls: column_blocks(ls, {"tokens": 0, "tags": 1}), ("train", "dev", "test")),
    "topic_lines": (first_tab, ("train", "dev", "test")),
    "hierarchical": (hierarchical_labels, ("train", "dev", "test")),
    "generation_jsonl": (lambda ls: json_lines(ls, "content string, summary string"), ("train", "dev")),
    "instruction_jsonl": (lambda ls: json_lines(ls, "instruction string, input string, output string"),
                          ("train",)),
    "prompt_jsonl": (lambda ls: json_lines(ls, "prompt string, response string"), ("train", "test")),
}
# fixed values: schemas of public benchmark layouts, JSON lines and columns of tab-separated files with one header row (none for the first)
_JSON = {
    "pair_jsonl": "sentence1 string, sentence2 string, label string",
    "topic_jsonl": "sentence string, label string, label_desc string, keywords string",
    "keyword_jsonl": "abst string, keyword array<string>, label string",
    "coreference_jsonl": "target struct<span1_text: string, span1_index: int, span2_text: string, span2_index: int>, text string, label string",
    "cloze_jsonl": "content array<string>, candidates array<string>, groupID long",
    "dialogue_choice_jsonl": "context array<string>, question string, choice array<string>, answer string",
    "translation_jsonl": "translation map<string, string>",
}
_TSV = {
    "acceptability_tsv": {"source": 0, "label": 1, "sentence": 3},
    "paraphrase_tsv": {"label": 0, "id1": 1, "id2": 2, "sentence1": 3, "sentence2": 4},
    "question_pairs_tsv": {"id": 0, "sentence1": 3, "sentence2": 4, "label": 5},
    "similarity_tsv": {"index": 0, "sentence1": 7, "sentence2": 8, "score": 9},
    "entailment_tsv": {"index": 0, "sentence1": 1, "sentence2": 2, "label": 3},
}
LAYOUTS |= {name: (lambda ls, schema=schema: json_lines(ls, schema), ("train", "dev", "test")) for name, schema in _JSON.items()}
LAYOUTS |= {name: (lambda ls, cols=cols, header=int(name != "acceptability_tsv"): tsv(ls, cols, header=header), ("train", "dev", "test"))
            for name, cols in _TSV.items()}


def load_layout(name: str, lines_by_split: dict[str, DataFrame], read=None) -> DataFrame:
    """Rows of every given split with a `split` column; unknown names, splits and empty sources fail.

    `read`, a function from a table of lines to a table of rows, stands for a layout that is not listed; it takes any split.
    """
    if read is None and name not in LAYOUTS:
        raise ValueError(f"unknown dataset layout {name}")
    reader, splits = (read, None) if read else LAYOUTS[name]
    out = None
    for split, lines in lines_by_split.items():
        if splits is not None and split not in splits:
            raise ValueError(f"{name} has no split {split}")
        part = reader(require_rows(lines)).withColumn("split", F.lit(split))
        out = part if out is None else out.unionByName(part)
    return out

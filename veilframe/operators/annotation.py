"""Annotated data -> training rows, with negative sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordering import row_index
from veilframe.operators.rows import seeded
from veilframe.session import materialise

CHUNK = 1 << 16  # indices that one row offers at a time


def label_list(df: DataFrame, column: str, most: int = 10_000) -> list[str]:
    """The label set as a list, for class_example's options, which are part of every prompt; refused beyond `most`."""
    labels = [r[0] for r in df.select(column).distinct().limit(most + 1).collect()]
    if len(labels) > most:
        raise ValueError(f"more than {most} options in a prompt")
    return sorted(labels)


def numbered(values: DataFrame, column: str) -> DataFrame:
    """(column, idx): distinct values that are not null with their numbers in order, from 0."""
    return materialise(row_index(values.select(column).where(F.col(column).isNotNull()).distinct(), [column], "idx"), "numbered")


def unranked(have: Column, j: Column) -> Column:
    """The j-th number, from 0, that is not in the sorted array `have`; its place is found by halving."""
    halvings = F.sequence(F.lit(1), F.length(F.bin(F.size(have))))

    def step(at, _):
        mid = F.floor((at["lo"] + at["hi"]) / 2).cast("int")
        free = F.get(have, mid) - mid <= j  # false behind the last
        more = at["lo"] < at["hi"]
        return F.struct(F.when(more & free, mid + 1).otherwise(at["lo"]).alias("lo"), F.when(more & ~free, mid).otherwise(at["hi"]).alias("hi"))
    return j + F.aggregate(halvings, F.struct(F.lit(0).alias("lo"), F.size(have).alias("hi")), step)["lo"]


def drawn(seed: int, *key: Column) -> Column:
    """A whole number of 48 bits from the md5 of the key."""
    return F.conv(F.substring(seeded(seed, *key), 1, 12), 16, 10).cast("long")


def stride(size: Column) -> Column:
    """A prime that does not divide size."""
    step = F.lit(1)
    for prime in (7919, 104_729, 999_983, 1_000_003, 15_485_863):
        step = F.when(size % prime != 0, F.lit(prime)).otherwise(step)
    return step


def walk(start: Column, t: Column, size: Column, step: Column) -> Column:
    """The t-th of a permutation of the numbers below size, from its start by its stride."""
    return F.pmod(F.pmod(start, size) + t * step, size)


def in_chunks(rows: DataFrame, n: Column, name: str) -> DataFrame:
    """Every row once for each chunk of the numbers below n, which it holds as an array."""
    most = F.floor((n - 1) / CHUNK)
    of = rows.where(n > 0).withColumn("_chunk", F.explode(F.sequence(F.lit(0).cast("long"), most)))
    first = F.col("_chunk") * CHUNK
    return of.withColumn(name, F.sequence(first, F.least(first + CHUNK, n) - 1)).drop("_chunk")


def counted(rows: DataFrame, n: Column, name: str = "t") -> DataFrame:
    """Every row once for each number below n, in chunks, so that no row holds them all."""
    return in_chunks(rows, n, name).withColumn(name, F.explode(name))


def class_example(text: Column, label: Column, options: list[str], prefix: str, key: Column, seed: int) -> Column:
    """Prompt with shuffled options; answer offsets count back from the prompt's end (negative)."""
    mixed = F.array_sort(F.transform(F.array(*[F.lit(o) for o in options]), lambda o: F.struct(
        seeded(seed, key, o).alias("h"), o.alias("o"))))["o"]
    prompt = F.concat(F.lit(prefix + "["), F.array_join(mixed, ","), F.lit("]"))
    # the label's last occurrence, found from the reversed prompt
    end = -(F.instr(F.reverse(prompt), F.reverse(label)) - 1)
    return F.struct(text.alias("content"), prompt.alias("prompt"), label.alias("answer"),
                    (end - F.length(label) - 1).alias("start"), (end - 1).alias("end"))


def split_class_label(label: Column) -> tuple[Column, Column]:
    """'label##class' -> label, class (null without one)."""
    parts = F.split(label, "##")
    return parts[0], F.get(parts, F.lit(1))


def entity_prompts(entities: DataFrame, doc: str, label: str) -> DataFrame:
    """(doc, label) -> sorted spans."""
    return entities.groupBy(doc, label).agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "text"))).alias("spans"))


def relation_prompts(relations: DataFrame, doc: str, chinese: bool = True) -> DataFrame:
    """relations(doc, subject, predicate, object) -> (doc, prompt, sorted objects)."""
    from veilframe.operators.extract import prompt
    p = relations.withColumn("prompt", prompt(F.col("subject"), F.col("predicate"), chinese))
    return p.groupBy(doc, "prompt").agg(F.sort_array(F.collect_list("object")).alias("objects"))


def entity_negatives(entities: DataFrame, doc: str, label: str, ratio: int, seed: int) -> DataFrame:
    """Prompts of labels a document lacks.

    All of them while ceil(negatives / positives) <= ratio or ratio = -1, else ratio * positives,
    drawn by hash. Positives are the document's distinct labels. Runs inside one row per document,
    whose arrays are bounded by the label set; that set travels as a table of one row.
    """
    per_doc = entities.groupBy(doc).agg(F.collect_set(label).alias("_have"))
    every = entities.agg(F.sort_array(F.collect_set(label)).alias("_all"))
    missing = F.array_except("_all", "_have")
    order = F.array_sort(F.transform(missing, lambda x: F.struct(seeded(seed, F.col(doc), x).alias("h"), x.alias("x"))))["x"]
    n_pos = F.size("_have")
    whole = F.lit(ratio == -1) | (F.ceil(F.size(missing) / n_pos) <= ratio)
    picked = F.when(whole, missing).otherwise(F.slice(order, F.lit(1), F.greatest(n_pos * ratio, F.lit(0))))
    return per_doc.crossJoin(F.broadcast(every)).select(doc, F.explode(picked).alias(label))  # one row


def full_negatives(entities: DataFrame, relations: DataFrame, doc: str, chinese: bool = True) -> DataFrame:
    """Every subject of a document with every predicate of the relations that is not a prompt already.

    Subjects meet the predicates, numbered, on their numbers; nothing is paired within a document.
    """
    from veilframe.operators.extract import prompt
    subjects = entities.select(doc, F.col("text").alias("subject")).distinct()
    predicates = numbered(relations, "predicate")
    every = counted(subjects, F.lit(predicates.count()).cast("long"), "idx").join(predicates, "idx")
    every = every.withColumn("prompt", prompt(F.col("subject"), F.col("predicate"), chinese))
    have = relations.select(doc, prompt(F.col("subject"), F.col("predicate"), chinese).alias("prompt")).distinct()
    return every.join(have, [doc, "prompt"], "left_anti").select(doc, "prompt")


def relation_negatives(relations: DataFrame, entities: DataFrame, doc: str, ratio: int, seed: int, chinese: bool = True) -> DataFrame:
    """(doc, pool, prompt): negative relation prompts per document from three pools, ratio // 3 * positives of each.

    Pools: 1, prompts with subject and object exchanged; 2, entities of the corpus that are no subject of the document, with one
    of its predicates; 3, its subjects with a label of the corpus that it does not have. A pool that has no more, or ratio = -1, gives
    all. What is missing to ratio * positives is filled from what is left of the pools together. Items are drawn without
    replacement by number: what a document lacks is numbered without being listed, a permutation of the numbers is walked, and
    only chosen ones meet their entity or label. Predicates and subjects are drawn per item. Documents without relations have none.
    """
    from veilframe.operators.extract import prompt
    make = lambda s, p: prompt(s, p, chinese)
    c = F.col
    names, labels = numbered(entities, "text"), numbered(entities, "label")
    named = relations.join(names.select(c("text").alias("subject"), "idx"), "subject", "left")
    per_doc = named.groupBy(doc).agg(
        F.size(F.collect_set(make(c("subject"), c("predicate")))).cast("long").alias("pos"),
        F.sort_array(F.collect_set("predicate")).alias("predicates"), F.sort_array(F.collect_set("subject")).alias("subjects"),
        F.sort_array(F.collect_list(F.struct(seeded(seed, c(doc), make(c("object"), c("predicate"))).alias("h"),
                                             make(c("object"), c("predicate")).alias("prompt"))))["prompt"].alias("inverse"),
        F.sort_array(F.collect_set(F.when(c(doc).isNotNull(), c("idx")))).alias("own_names"))
    have = (entities.select(doc, "label").distinct().join(labels, "label")
            .groupBy(doc).agg(F.sort_array(F.collect_list("idx")).alias("own_labels")))
    none = F.array().cast("array<bigint>")
    rows = (per_doc.join(have, doc, "left").withColumns({"own_labels": F.coalesce("own_labels", none)})
            .withColumns({"size1": F.size("inverse").cast("long"), "size2": F.lit(names.count()) - F.size("own_names"),
                          "size3": F.lit(labels.count()) - F.size("own_labels")}))
    for i in (1, 2, 3):
        size = c(f"size{i}")
        whole = F.lit(ratio == -1) | (F.ceil(size / c("pos")) <= ratio // 3)
        rows = rows.withColumn(f"n{i}", F.when(whole, size).otherwise(F.greatest(c("pos") * (ratio // 3), F.lit(0))))
    left = [c(f"size{i}") - c(f"n{i}") for i in (1, 2, 3)]
    more = F.least(F.greatest(c("pos") * ratio - c("n1") - c("n2") - c("n3"), F.lit(0)), sum(left, F.lit(0)))
    rows = rows.withColumns({"more": more, "left1": left[0], "left2": left[1], "left3": left[2]})
    # the starts and strides of the walks once a document
    sizes = {2: c("size2"), 3: c("size3"), 4: c("left1") + c("left2") + c("left3")}
    rows = rows.withColumns({f"start{i}": drawn(seed + i, c(doc)) for i in sizes}).withColumns({f"step{i}": stride(n) for i, n in sizes.items()})
    rows = materialise(rows, "pools")
    walked = lambda i, t: walk(c(f"start{i}"), t, sizes[i], c(f"step{i}"))
    # a number below all that is left names a pool and a place behind what was taken of it
    before = {1: F.lit(0), 2: c("left1"), 3: c("left1") + c("left2")}

    def places(i: int) -> DataFrame:
        """What is chosen of pool i: a row a document and chunk, with its places as an array, so that only these are exploded."""
        at = F.filter(F.transform("t", lambda t: walked(4, t)), lambda a: (a >= before[i]) & (a < before[i] + c(f"left{i}")))
        rest = in_chunks(rows, c("more"), "t").withColumn("t", F.transform(at, lambda a: c(f"n{i}") + a - before[i]))
        return in_chunks(rows, c(f"n{i}"), "t").unionByName(rest)

    def numbers(i: int, own: str, values: str, name: str) -> DataFrame:
        idx = places(i).select(doc, values, F.transform("t", lambda t: unranked(c(own), walked(i, t))).alias("idx"))
        one_of = lambda x: F.get(values, (drawn(seed + 10 + i, c(doc), x) % F.size(values)).cast("int"))
        return idx.select(doc, F.explode(F.transform("idx", lambda x: F.struct(x.alias("idx"), one_of(x).alias(name)))).alias("x")).select(doc, "x.*")

    pool = lambda i: F.lit(i).alias("pool")
    inverse = places(1).select(doc, F.explode(F.transform("t", lambda t: F.get("inverse", t.cast("int")))).alias("prompt")).select(doc, pool(1), "prompt")
    other = numbers(2, "own_names", "predicates", "predicate").join(names, "idx").select(doc, pool(2), make(c("text"), c("predicate")).alias("prompt"))
    lacking = numbers(3, "own_labels", "subjects", "subject").join(labels, "idx").select(doc, pool(3), make(c("subject"), c("label")).alias("prompt"))
    return inverse.unionByName(other).unionByName(lacking)

"""What a plan carries, writes and compares: work that must not grow faster than its rows."""

import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veilframe.functions import fold
from veilframe.operators import annotation as N
from veilframe.operators import augment as A
from veilframe.operators import corpus as C
from veilframe.operators import metrics as M
from veilframe.plans import load

DOCS = [(1, "été déjà vu là-bas où ça brûle"), (2, "maïs noël çà et là forêt zéro"), (3, None), (4, ""), (5, "abc def")]


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def carried(df) -> list[tuple[set, set]]:
    """(columns a Generate copies to each of its rows, columns it makes)."""
    names = lambda text: set(re.findall(r"(\w+)#\d+", text))
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [(names(kept), names(made)) for kept, made in re.findall(r"Generate\nInput.*\nArguments: .*, \[([^\[\]]*)\], \w+, \[([^\[\]]*)\]", text)]


@pytest.fixture
def tables(spark, tmp_path):
    spark.createDataFrame([(i, t, "fr", "s", None if t is None else len(t)) for i, t in DOCS], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_relation_negatives_explode_numbers_without_the_arrays(spark):
    relations = spark.createDataFrame([(d, f"s{i}", f"p{i % 2}", f"o{i}") for d in (1, 2) for i in range(5 * d)], "doc int, subject string, predicate string, object string")
    entities = relations.select("doc", F.col("subject").alias("text"), F.lit("a").alias("label")).union(
        spark.createDataFrame([(3, f"x{i}", f"l{i}") for i in range(40)], "doc int, text string, label string"))
    got = N.relation_negatives(relations, entities, "doc", 3, 4)
    assert [(r.doc, r["count"]) for r in got.groupBy("doc").count().orderBy("doc").collect()] == [(1, 15), (2, 30)]
    found = carried(got)
    assert found
    arrays = {"own_names", "own_labels", "inverse"}
    assert not [kept & arrays for kept, made in found if made != {"_chunk"} and kept & arrays]


def test_unranked_is_the_number_that_is_not_there(spark):
    have = [0, 1, 4, 9, 10, 11, 30]
    free = [x for x in range(60) if x not in have]
    rows = spark.createDataFrame([(have, j) for j in range(40)] + [([], 7)], "have array<bigint>, j long")
    got = [r[0] for r in rows.select(N.unranked(F.col("have"), F.col("j"))).collect()]
    assert got == free[:40] + [7]


def test_changes_explode_tokens_without_their_text(spark):
    rows = spark.createDataFrame([(1, ["a", "b", "c", "b"], [0, 1, 3]), (2, [], []), (3, None, None), (4, ["c", "d"], [0]), (5, ["b"], [0, 0])],
                                 "k int, w array<string>, at array<int>")
    words = spark.createDataFrame([("a", ["x"]), ("b", ["y"])], "token string, options array<string>")
    got = A.change(rows, "k", "w", "at", words, 1, "new")
    assert {r.k: r.new for r in got.collect()} == {1: ["x", "y", "c", "y"], 2: [], 3: None, 4: ["c", "d"], 5: ["y"]}
    assert all("w" not in kept for kept, _ in carried(got))
    both = {r.k: r.new for r in A.change(rows, "k", "w", "at", words, 1, "new", insert=True).collect()}
    assert sorted(both[1]) == sorted(["a", "x", "b", "y", "c", "b", "y"]) and both[1].index("c") == 4


@pytest.mark.parametrize("name", ["augment_substitute", "augment_random", "augment_tfidf"])
def test_augmentation_reads_tokens_it_has_written(spark, tables, name):
    """Tokens and draws are made once; the plan of the result reads them from the work folder."""
    got = load().QUERIES[name](spark, tables)
    assert name == "augment_tfidf" or got.count() == len(DOCS)
    assert "regexp_extract_all" not in plan(got)


def test_tf_idf_moves_rows_of_one_document_once(spark):
    rows = [(1, "a"), (1, "a"), (1, "b"), (2, "a"), (None, "b"), (None, None), (2, None)]
    tokens = spark.createDataFrame(rows, "d int, t string")
    got = C.tf_idf(tokens, "d", "t")
    assert sorted((r.d, r.t, round(r.tf, 6), round(r.idf, 6)) for r in got.collect()) == [
        (1, "a", 0.666667, 0.405465), (1, "b", 0.333333, 0.405465), (2, "a", 0.5, 0.405465)]
    assert "Exchange hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString().replace("hashpartitioning(d#", "")


def test_blocks_of_a_fold_are_short():
    assert fold._BLOCK <= 64


def test_numbered_keeps_nulls_last(spark):
    rows = spark.createDataFrame([(["b", None, "a", "b"],), ([],), (None,)], "x array<string>")
    assert [r[0] for r in rows.select(M.numbered(F.col("x"))).collect()] == [["a#0", "b#0", "b#1", "b#2"], [], None]


def test_draws_are_not_sorted_by_a_lambda(spark):
    rows = spark.createDataFrame([(1, [3, 1, 2], ["a", "##b", "c"])], "k int, p array<int>, w array<string>")
    got = rows.select(C.whole_word_mask(F.col("w"), F.col("k"), 0.9, 1).alias("m"), A.choose(F.col("p"), F.lit(3), F.col("k"), 1).alias("c"))
    assert "array_sort(transform" not in plan(got)
    assert [sorted(got.first().m), got.first().c] == [[0, 1, 2], [1, 2, 3]]


def test_spans_are_looked_up(spark):
    spans = lambda *s: [dict(start=a, end=b) for a, b in s]
    rows = [(spans((1, 2), (3, 4), (3, 4), (12, 3)), spans((3, 4), (1, 23), (12, 3))), (spans(), spans((1, 1))), (None, spans((1, 1)))]
    df = spark.createDataFrame(rows, "a array<struct<start:int,end:int>>, b array<struct<start:int,end:int>>")
    assert [r[0] for r in df.select(M.same_spans(F.col("a"), F.col("b"))).collect()] == [2, 0, None]


def test_bonus_numbers_the_grams_once(spark):
    t = spark.createDataFrame([(["a", "b", "a"], [["a", "a", "b"], ["b"]], "Yes", ["No", "Yes"]), (["a"], [["a"]], "No", ["No"])],
                              "c array<string>, r array<array<string>>, l string, rl array<string>")
    x = t.select(M.bleu_counts(F.col("c"), F.col("r"), 1, F.col("l"), F.col("rl")).alias("x")).select("x.*")
    assert [tuple(r) for r in x.collect()] == [(3, 1, 3), (1, 1, 1)]
    assert plan(x).count("sort_array") <= 4


def test_map_batched_makes_no_python_texts(spark, tables):

    got = load().QUERIES["map_batched"](spark, tables)
    assert sorted(map(tuple, got.collect())) == [(i, None if t is None else 2 * len(t)) for i, t in DOCS]
    assert "MapInArrow" in plan(got)


def test_directory_workers_hold_little(tmp_path):
    """What stream_directory's Python workers hold: 4 bytes a position, about 1 MB of a file at a time, ranges cut without a list of names."""
    import numpy as np
    import pyarrow as pa

    from veilframe.functions.detect import normalise_one
    from veilframe.sources.publish import _runs
    from veilframe.sources.ranges import RangeReader

    norm, at = normalise_one("é①２ ﬁ" * 1000)
    assert norm == "é12 fi" * 1000 and at.dtype == np.int32 and at.nbytes == 4 * len(norm)
    assert at[:6].tolist() == [0, 1, 2, 3, 4, 4]

    path, size = tmp_path / "a.txt", 0
    with open(path, "w") as f:
        for i in range(40_000):
            size += f.write(f"{i:099d}\n")
    reader = RangeReader({"path": str(tmp_path), "kind": "records", "split": str(64 << 20)})
    batches = [b for p in reader.partitions() for b in reader.read(p)]
    assert sum(b.num_rows for b in batches) == 40_000 and max(sum(map(len, b.column("text").to_pylist())) for b in batches) <= 1 << 20

    rows = pa.RecordBatch.from_pydict({"file": ["a", "a", "a", "b", "b"], "block": [0, 0, 7, 7, 7]})
    assert [(k, p.num_rows) for k, p in _runs(rows)] == [(("a", 0), 2), (("a", 7), 1), (("b", 7), 2)]
    assert [*_runs(rows.slice(0, 0))] == [] and [(k, p.num_rows) for k, p in _runs(rows.slice(0, 1))] == [(("a", 0), 1)]

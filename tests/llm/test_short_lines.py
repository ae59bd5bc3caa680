"""Lines of few shingles: the same set in lines of other words, against the query's SQL and brute force."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.check import compare
from tests.llm.test_dedup import line_sets
from veilframe.llm import line_dedup


def periodic_rows():
    rng = random.Random(11)
    rows = [(0, "- - - - - -\n- - - - - - - -\na b a b a b\na b a b a b a"), (1, "b a b a b a\n- - - -\n- - -\n-\nb a"), (2, None), (3, "c c c c c")]
    for i in range(4, 150):
        parts = []
        for _ in range(rng.randint(0, 5)):
            circle, at, n = rng.choice(["-", "ab", "abc", "aab", "abcd", "abcde", "abcdefgh"]), rng.randrange(8), rng.randint(1, 16)
            parts.append(" ".join((circle * 25)[at:at + n]) + rng.choice(["", " z", "  "]))
        rows.append((i, "\n".join(parts)))
    return rows


def test_lines_of_periodic_words_against_the_sql(spark, tmp_path):
    df = spark.createDataFrame(periodic_rows(), "doc_id long, text string")
    df.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    got = entry.queries()["op9_line_dedup"](spark, str(tmp_path)).toPandas()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert compare(got, con.execute(entry.oracle_sql()["op9_line_dedup"]).df()) == ""


@pytest.mark.parametrize("num,den", [(4, 5), (9, 10), (1, 1), (1, 2)])
def test_lines_of_periodic_words(spark, num, den):
    rows = periodic_rows()
    sets = list(line_sets(rows))
    want = {}
    for k, (i, n, s) in enumerate(sets):
        if s and any(o and den * len(s & o) >= num * len(s | o) for _, _, o in sets[:k]):
            want.setdefault(i, set()).add(n)
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string"), num=num, den=den).collect()
    assert {r.doc_id: r.n_removed for r in got} == {i: len(want.get(i, ())) for i, _ in rows}


def test_the_order_of_tokens_is_counted_over_every_line(spark, monkeypatch):
    seen, sketch = [], line_dedup.rarity_sketch
    monkeypatch.setattr(line_dedup, "rarity_sketch", lambda lines, k: seen.append(lines.count()) or sketch(lines, k))
    df = spark.range(120_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("line number "), F.col("id").cast("string"), F.lit("\n \nend")).alias("text"))
    line_dedup.removals(df)
    assert seen == [240_000]


def test_lines_move_once(spark):
    """All lines meet their classes in one shuffle, not in one for the classes and one to look them up; copied rows stay one document."""
    import io
    from contextlib import redirect_stdout

    text = "one two three four five six seven eight\nalone in here"
    df = spark.createDataFrame([(2, text), (2, text), (None, text), (1, text + "\ntail of it"), (3, "one two three four five six seven eight nine")],
                               "doc_id long, text string")
    gone = line_dedup.removals(df)
    with redirect_stdout(io.StringIO()) as plan:
        gone.explain()
    # before, the classes were made by an aggregation that shuffled a row per line beside the shuffle of the lines themselves
    assert "partial_min(struct(id" not in plan.getvalue() and "Window [count(1)" in plan.getvalue()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_removed, r.text) for r in line_dedup.dedup_lines(df).collect())
    assert got == [(False, 0, 0, text), (True, 1, 2, "tail of it"), (True, 2, 2, ""), (True, 2, 2, ""), (True, 3, 1, "")]

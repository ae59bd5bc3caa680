import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import SCHEMA, SF, messy_rows
from veilframe.llm import fill_middle
from veilframe.llm.queries import QUERIES


def plain_python(i, text):
    """The contract, by string operations."""
    text = text or ""
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[8 * k:8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(m in text for m in fill_middle.MARKERS) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    pre, mid, suf = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", a, b - a, f"<P>{pre}<S>{suf}<M>{mid}"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_equals_string_operations(spark, sample):
    got = collections.Counter(tuple(r) for r in QUERIES["op13_fill_in_middle"](spark, SF).collect())
    want = collections.Counter()
    for i, t in sample:
        n, form, a, b, out = plain_python(i, t)
        want[i, n, form, a, b, sha(out), sha(t or "")] += 1
    assert got == want
    assert {k[2] for k in want} == {"plain", "psm", "spm"}


def test_odd_rows(spark, messy, empty):
    rows = [(100 + k, t) for k, t in enumerate(["<P>", "a<S>b", "<M", "<", "><P", "日本語" * 50, "a<\n>S<P" * 9, "x" * 20000 + "語" * 20000 + "é" * 7])]
    docs = messy.unionByName(spark.createDataFrame(rows, "doc_id long, text string"), allowMissingColumns=True)
    found = fill_middle.fill_in_middle(docs).withColumn("restored", fill_middle.restore(F.col("output"), F.col("form"))).collect()
    want = collections.Counter((i, *plain_python(i, t), t or "") for i, t in [r[:2] for r in messy_rows()] + rows)
    assert collections.Counter(tuple(r) for r in found) == want
    assert fill_middle.fill_in_middle(empty).collect() == []
    assert SCHEMA.startswith("doc_id long")


def test_index_gives_every_offset():
    rng = random.Random(4)
    alphabets = ["ab c", "aé", "a語\U0001f600", "語"]
    for _ in range(60):
        text = "".join("".join(rng.choices(rng.choice(alphabets), k=rng.randint(1, 3000))) for _ in range(rng.randint(0, 6)))
        data = text.encode()
        index = fill_middle.RankIndex.fit(fill_middle.boundaries(data))
        want = np.cumsum([0, *[len(c.encode()) for c in text]])
        assert index.size == len(want)
        assert [index.offset(k) for k in range(index.size)] == want.tolist()
        lines = np.diff(np.r_[index.first, index.size])
        assert (np.abs(index.differs.astype(int)) <= fill_middle.ERROR + 1).all() and lines.min() >= 1
    ascii_only = fill_middle.RankIndex.fit(fill_middle.boundaries(b"x" * 100_000))
    assert len(ascii_only.first) == 2 and not len(ascii_only.differs)  # the text and its end


def test_blocks_of_a_long_text(monkeypatch):
    monkeypatch.setattr(fill_middle, "BLOCK", 1000)
    text = ("aé語" * 900).encode()
    index = fill_middle.RankIndex.fit(fill_middle.boundaries(text))
    assert [index.offset(k) for k in range(index.size)] == np.cumsum([0, *[1, 2, 3] * 900]).tolist()


def test_words_as_units_and_other_shares(spark, messy):
    found = (fill_middle.fill_in_middle(messy, unit=r"\S+", plain_percent=0, spm_percent=100)
             .withColumn("restored", fill_middle.restore(F.col("output"), F.col("form"))).collect())
    assert collections.Counter((r.id, r.restored) for r in found) == collections.Counter((i, t or "") for i, t in [r[:2] for r in messy_rows()])
    assert {r.form for r in found if r.output} == {"spm"}
    for r in found:
        if r.form == "spm":
            assert r.n == max(1, len(r.restored.split()))
            middle, prefix = r.output.split("<M>")[1], r.output.split("<P>")[1].split("<M>")[0]
            if r.restored.split() and r.prefix_units:
                assert len(prefix.split()) == r.prefix_units and len(middle.split()) == r.middle_units


def test_markers_that_overlap_are_refused(spark, messy):
    for markers in [("ab", "bc", "x"), ("a", "ab", "x"), ("aa", "b", "c"), ("a", "a", "b"), ("", "a", "b")]:
        with pytest.raises(ValueError):
            fill_middle.fill_in_middle(messy, markers=markers)

"""Licences, URLs, token counts, quality and decontamination: brute force, fixtures and edge cases."""

import collections
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tests.check import compare, oracle
from tests.llm.conftest import SF, messy_rows
from veilframe.llm import decontaminate, knn_quality, licenses, quality_rules, token_counts, url_filter
from veilframe.llm.queries import EDIT_MASKS

ONE = ["op1_license_scan", "op2_url_filter", "op9_line_dedup"]


@pytest.mark.parametrize("name", ONE)
def test_query_against_its_sql(spark, name):
    got = entry.queries()[name](spark, SF).toPandas()
    assert compare(got, oracle(SF, entry.oracle_sql()[name])) == ""


def test_licenses(spark, messy, empty):
    bsd = "\n".join("# " + licenses.SENTENCES[s][0].upper() + licenses.SENTENCES[s][1:] + "." for s in ("BSDRedist", "BSDSource", "BSDBinary"))
    texts = {
        1: "Some words\nReleased under the MIT License.\nMore. All Rights Reserved!",
        2: "// Licensed under the Apache License, Version 2.0 (the \"License\");\n// you may not use this file except in\n// compliance with the License.\n",
        3: bsd, 4: bsd + "\n# " + licenses.SENTENCES["BSDEndorse"] + ".",
        5: "It is not released under the MIT license, they say.", 6: None, 7: "",
        8: "Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", 9: "the above copyright notice " * 4000,
    }
    df = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, licences string")
    got = {r.id: r.licences for r in licenses.scan(df).collect()}
    assert got == {1: ["MIT", "LicenseRef-AllRightsReserved"], 2: ["Apache-2.0"], 3: ["BSD-2-Clause"], 4: ["BSD-3-Clause"], 5: [], 6: [], 7: [],
                   8: ["CC-BY-NC-4.0"] * 2, 9: []}
    assert licenses.scan(messy).count() == len(messy_rows()) and licenses.scan(empty).count() == 0


def test_every_known_sentence_has_a_hint():
    for s in licenses.SENTENCES.values():
        assert re.search(licenses.HINT, s), s
    assert {x for _, rule in licenses.RULES for x in rule} <= set(licenses.SENTENCES)


URLS = [
    ("https://Blog.Example.NET/en/5?x=1", "blog.example.net", "/en/5", "example.net/en/", "allow"),
    ("https://example.net/de/5", "example.net", "/de/5", "net/", "block"),
    ("http://notexample.net/en/", "notexample.net", "/en/", "net/", "block"),
    ("http://a.example.com/de/", "a.example.com", "/de/", "example.com/de/", "block"),
    ("http://a.example.com/de", "a.example.com", "/de", None, "allow"),
    ("http://x.org/fr/1#top", "x.org", "/fr/1", "org/fr/", "allow"),
    ("http://net", "net", "", None, "allow"), ("ftp://a.net/", "a.net", "/", "net/", "block"),
    ("http://É.net/", "É.net", "/", "net/", "block"), ("no scheme/net/", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("a://b://c.net/x", "b:", "//c.net/x", None, "allow"),
]


def test_url_rules(spark):
    from veilframe.llm.queries import URL_RULES

    df = spark.createDataFrame([(n, u[0], None, "x") for n, u in enumerate(URLS)], "page_id long, url string, label int, host string")
    got = {r.id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, URL_RULES).collect()}
    assert got == {n: u[1:] for n, u in enumerate(URLS)}
    assert url_filter.judge(df.limit(0), URL_RULES).count() == 0


def test_url_templates_merge_and_reject(spark):
    rng = random.Random(1)
    rows = []
    for n in range(300):
        rows.append((f"http://a.com/shop/item{rng.randrange(10**6)}/view", 1))
        rows.append((f"http://a.com/news/{rng.choice(['x', 'y', 'z'])}{n}/", 1))
        rows.append((f"http://a.com/spam/{'0123456789abcdef' * 2}{n}", 0))
    df = spark.createDataFrame([(n, u, y) for n, (u, y) in enumerate(rows)], "page_id long, url string, label int").repartition(4)
    got = url_filter.judge(df, []).collect()
    assert {r.template for r in got} == {"/shop/*/*", "/news/*", "/spam/*"} or {r.template for r in got} == {"/*/*/*", "/*/*", "/spam/*"}
    assert {r.verdict for r in got if r.path.startswith("/spam")} == {"block"}
    assert {r.verdict for r in got if not r.path.startswith("/spam")} == {"allow"}


@pytest.fixture(scope="module")
def counts():
    import public_tokenizers as t

    return token_counts.counter(t.path("byte_bpe_50k.tiktoken"), t.PATTERN), t


def test_edits_keep_counts_exact(counts, sample):
    c, _ = counts
    rng = random.Random(3)
    letters = "ab 's tll\n  12!?é"
    some = lambda n: "".join(rng.choice(letters) for _ in range(n))
    for trial in range(500):
        text = some(rng.randrange(400)) if trial % 2 else (rng.choice(sample)[1] or "")[:2500]
        tree = token_counts.Tree.from_bytes(token_counts.Tree.of(text, c).to_bytes())
        assert tree.tokens == len(c.encoding.encode_ordinary(text))
        edits = []
        for _ in range(rng.randrange(1, 6)):
            at = rng.randrange(len(text) + 1)
            edits.append({"start": at, "end": min(len(text), at + rng.choice([0, 1, 3, 50])), "text": some(rng.choice([0, 1, 2, 9]))})
        new, again = token_counts.carry_out(text, edits, tree, c)
        assert tree.tokens == len(c.encoding.encode_ordinary(new)) and tree.sums[1, 0] == len(new)
        if len(text) > 2000:
            assert again < 400


def test_token_counts_on_messy_documents(spark, messy, empty, counts):
    c, t = counts
    vocabulary = t.path("byte_bpe_50k.tiktoken")
    edits = F.expr("CASE WHEN line % 3 = 0 THEN NULL WHEN line % 3 = 1 THEN array(named_struct('start', 0, 'end', 2, 'text', 'zz'), "
                   "named_struct('start', 1, 'end', 3, 'text', 'overlaps'), named_struct('start', 900000, 'end', 900001, 'text', 'outside')) "
                   "ELSE array(named_struct('start', 3, 'end', 3, 'text', CAST(NULL AS STRING))) END")
    done = token_counts.apply_edits(token_counts.index(messy, vocabulary, t.PATTERN).withColumn("edits", edits), vocabulary, t.PATTERN).collect()
    assert len(done) == len(messy_rows())
    for r in done:
        old = messy_rows()[r.line][1]
        want = old if r.line % 3 != 1 or len(old or "") < 2 else "zz" + old[2:]
        assert r.text == want and r.n_tokens == len(c.encoding.encode_ordinary(want or ""))
    assert token_counts.index(empty, vocabulary, t.PATTERN).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_edits_far_apart_and_in_long_words(counts, seed):
    """Windows of an edit end inside words, at other edits and at the end of the text."""
    c, _ = counts
    rng = random.Random(seed)
    text = "".join(rng.choice(["a" * rng.randint(1, 900), " ", "\n", "7" * rng.randint(1, 300), "日本", " the", "  \t "]) for _ in range(rng.randint(1, 60)))
    edits, at = [], 0
    while at < len(text):
        end = min(len(text), at + rng.randint(0, 12))
        edits.append({"start": at, "end": end, "text": rng.choice([None, "", "[X]", "b" * 400, " ", "\n\n"])})
        at = end + rng.choice([1, 9, 40, 700])
    tree = token_counts.Tree.of(text, c)
    new, _ = token_counts.carry_out(text, edits, tree, c)
    want, done = [], 0
    for e in edits:
        want += [text[done:e["start"]], e["text"] or ""]
        done = e["end"]
    assert new == "".join([*want, text[done:]])
    fresh = token_counts.Tree.of(new, c)
    assert tree.tokens == fresh.tokens
    flat = lambda t: [(int(a), int(b)) for length, tokens in t.leaves for a, b in zip(length, tokens)]
    assert flat(tree) == flat(fresh)


def test_masks_and_counts_in_one_pass(spark, messy, empty, counts):
    _, t = counts
    vocabulary, rules = t.path("byte_bpe_50k.tiktoken"), {r"[ab]{3,}": "[AB]", r"\w+h\b": "[H]", r"#\*\$": " "}
    by_steps = token_counts.apply_edits(token_counts.index(messy, vocabulary, t.PATTERN).withColumn("n_tokens_before", F.col("n_tokens")).withColumn(
        "edits", token_counts.masks("text", rules)), vocabulary, t.PATTERN).withColumn("n_edits", F.size("edits").cast("long"))
    names = ["doc_id", "line", "text", "n_tokens_before", "n_edits", "n_reencoded", "n_tokens", "id"]
    got = token_counts.mask_and_count(messy, vocabulary, t.PATTERN, rules)
    key = lambda r: r.line
    assert sorted(got.select(names).collect(), key=key) == sorted(by_steps.select(names).collect(), key=key)
    assert token_counts.mask_and_count(empty, vocabulary, t.PATTERN, rules).count() == 0
    dense = ("a@b.cc " * 20_000)
    found = token_counts.matches(dense, [(regex.compile(p), m) for p, m in EDIT_MASKS.items()])
    assert len(found) == 20_000


def test_quality_model_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = {r.id: r for r in knn_quality.score(docs, knn_quality.fit(docs, labels)).collect()}
    held = [(got[i].score, got[i].predicted, q) for i, q in duckdb.sql("SELECT doc_id, quality FROM '/root/testdata/sf0.01/labels.parquet'").fetchall()
            if got[i].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert sum(p == q for _, p, q in held) / len(held) > 0.95
    pairs = [(a, b) for a, _, x in held if x == 1 for b, _, y in held if y == 0]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.95


def test_votes_against_cosines_of_all_vectors(spark, sample):
    """Scores from the definition: every labelled vector's cosine, the nearest ones' labels weighted by it."""
    docs = spark.createDataFrame(sample, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in sample], "doc_id long, quality int")
    model = knn_quality.fit(docs, labels, neighbours=7)
    got = {r.id: r.score for r in knn_quality.score(docs, model).collect()}
    compared = 0
    for i, t in sample:
        row, term, n = knn_quality.counts([(t or "").encode()])
        weights, _ = knn_quality._weights(row, term, n, model.idf, 1)
        x = sum((w * model.axes[k] for w, k in zip(weights, term)), np.zeros(model.axes.shape[1]))
        size = np.linalg.norm(x)
        cosine = [float(x @ v) / size if size else 0.0 for v in model.vectors]
        ranked = sorted(range(len(cosine)), key=lambda k: -cosine[k])
        best = ranked[:7]
        if cosine[ranked[6]] - cosine[ranked[7]] < 1e-4:
            continue  # copies: which of equal neighbours votes is open
        compared += 1
        vote = [max(cosine[k], 0) ** 4 * model.weights[k] for k in best]
        want = sum(v * model.labels[k] for v, k in zip(vote, best)) / sum(vote) if sum(vote) > 1e-9 else model.prior
        assert abs(got[i] - want) < 1e-3
    assert len(model.labels) > 100 and len(got) == len(sample) and compared > len(sample) // 2


def test_repeated_ids_teach_one_text(spark):
    rows = [(1, f"good words {k} of a text") for k in range(50)] + [(2, "bad bad # # #"), (3, "more good words"), (5, "# # bad")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (5, 0)], "doc_id long, quality int")
    a, b = (knn_quality.fit(d, labels, per_class=2) for d in (docs, docs.repartition(5)))
    assert len(a.labels) == len(b.labels) <= 4 and np.allclose(a.vectors, b.vectors)


def test_quality_model_edge_cases(spark, messy, empty):
    labels = spark.createDataFrame([(1, 1), (1, 0), (10, 1), (12, 0), (None, 1), (19, None), (13, 7)], "doc_id long, quality int")
    got = knn_quality.score(messy, knn_quality.fit(messy, labels)).collect()
    assert len(got) == len(messy_rows()) and all(0 <= r.score <= 1 for r in got)
    none = knn_quality.fit(messy, labels.limit(0))
    assert {r.score for r in knn_quality.score(messy, none).collect()} == {0.5}
    assert knn_quality.score(empty, knn_quality.fit(empty, labels)).count() == 0


def distance(a, b):
    """Fewest edits between a and any part of b."""
    row = [0] * (len(b) + 1)
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_passages_within_the_edit_budget_are_found(sample):
    rng = random.Random(5)
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()[:12]
    index = decontaminate.build(items)
    plain = lambda t: "".join(map(chr, decontaminate.codes(t)))
    texts = [t for _, t in sample if t and len(t) > 300]
    for _ in range(40):
        n = rng.randrange(len(items))
        text = items[n][1]
        part = list(text)
        for _ in range(rng.randrange(0, len(text) * 8 // 100 + 4)):
            at = rng.randrange(len(part))
            part[at:at + rng.randrange(2)] = rng.choice(["", "x", "y", "  "])
        base = rng.choice(texts)[:500]
        at = rng.randrange(len(base))
        doc = base[:at] + "".join(part).upper() + base[at:]
        least = distance(plain(text), plain(doc))
        found = [x for x in decontaminate.scan(index, [doc]) if x[1] == n]
        assert bool(found) == (least <= int(len(text) * 0.08))
        if found:
            assert min(x[4] for x in found) == least


def test_decontamination_edge_cases(spark, messy, empty):
    rows = messy_rows()
    items = spark.createDataFrame([(1, rows[0][1][:200]), (1, rows[0][1][:200]), (2, None), (3, ""), (4, "ab"), (5, rows[15][1][-90:])], "item_id long, text string")
    got = decontaminate.find(messy, items).collect()
    held = {n for n, r in enumerate(rows) if r[1] and (rows[0][1][:200] in r[1] or rows[15][1][-90:] in r[1])}
    assert {r.id for r in got if r.item == 5} == {rows[n][0] for n in held if rows[15][1][-90:] in rows[n][1]}
    clean = decontaminate.drop_contaminated(messy, items)
    assert clean.columns == messy.columns
    assert sorted(r.line for r in clean.collect()) == [n for n in range(len(rows)) if n not in held]
    one = decontaminate.drop_contaminated(messy, items, block_chars=1)  # a block per item
    assert sorted(r.line for r in one.collect()) == [n for n in range(len(rows)) if n not in held]
    assert decontaminate.find(empty, items).count() == 0 and decontaminate.find(messy, items.limit(0)).count() == 0


def statistics(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    repeat = {j for i, t in enumerate(zip(w, w[1:], w[2:])) if seen[t] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeat)


def test_quality_statistics(spark, messy, empty):
    got = collections.Counter(tuple(r) for r in quality_rules.quality(messy).select("id", *quality_rules.BASE, "base_failed").collect())
    want = collections.Counter()
    for i, t in [r[:2] for r in messy_rows()]:
        s = statistics(t)
        want[i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]] += 1
    assert got == want
    assert quality_rules.quality(empty).count() == 0
    kept = quality_rules.keep_good(messy)
    assert kept.columns == messy.columns and all(statistics(r.text)[0] >= 50 for r in kept.collect())


def concentration(x, h, start, steps=60):
    """Concentration steps in floating point, as a check of the estimates."""
    def moments(rows, factor):
        m = rows.mean(axis=0)
        return m, factor * ((rows - m).T @ (rows - m)) / len(rows) + np.diag(np.square(quality_rules.FLOORS))
    m, c = start
    for _ in range(steps):
        d = np.floor(np.log1p(np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c), x - m)) * 2048)
        m, c = moments(x[d <= np.quantile(d, h)], quality_rules.CONSISTENCY)
    return m, c


def test_outliers_against_numpy(spark):
    rng = np.random.default_rng(8)
    x = rng.multivariate_normal([5, 0.2, 0.3, 0.4], np.diag([0.2, 0.1, 0.1, 0.05]) ** 2 + 0.004, 600)
    x[:90] += [3, 0.8, 0, 0]
    q = np.rint(x * quality_rules.SCALE).astype(int)
    df = spark.createDataFrame([(7, *map(int, r)) for r in q], "_group long, _x0 long, _x1 long, _x2 long, _x3 long").repartition(5)
    est = quality_rules.estimates(df)
    got = sorted(r.d for r in df.join(est, "_group").select(quality_rules.distance().alias("d")).collect())
    z = q / quality_rules.SCALE
    quart = np.quantile(z, [0.25, 0.5, 0.75], axis=0)
    floor = np.diag(np.square(quality_rules.FLOORS))
    starts = [(quart[1], np.diag(((quart[2] - quart[0]) / 1.349) ** 2) + floor), (z.mean(axis=0), np.cov(z.T, bias=True) + floor)]
    m, c = min((concentration(z, quality_rules.COVERAGE, s) for s in starts), key=lambda e: np.linalg.det(e[1]))
    want = sorted(np.einsum("ij,jk,ik->i", z - m, np.linalg.inv(c), z - m))
    assert np.allclose(got, want, rtol=1e-6)
    assert sum(d > quality_rules.CUTOFF for d in got) >= 90 and math.isclose(quality_rules.CONSISTENCY, 1.4859, rel_tol=1e-3)

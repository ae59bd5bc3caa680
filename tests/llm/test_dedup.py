"""SimHash groups, repeated byte strings and similar lines against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.llm.conftest import messy_rows
from veilframe.llm import components, line_dedup, repeats, simhash


def fingerprint(text, k=3):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    parts = [" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or ([" ".join(w)] if w else [])
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(rows, radius=3):
    """Per row the smallest id reachable, None if no row of the component has an id."""
    fp = [fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    near = [[j for j in range(len(rows)) if bin(fp[i] ^ fp[j]).count("1") <= radius] for i in range(len(rows))]
    while True:
        new = [min(label[j] for j in near[i]) for i in range(len(rows))]
        if new == label:
            break
        label = new
    first = {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            first[g] = min(first.get(g, i), i)
    return [(i, f, first.get(g)) for (i, _), f, g in zip(rows, fp, label)]


def same(a, b):
    return collections.Counter(map(repr, a)) == collections.Counter(map(repr, b))


@pytest.mark.parametrize("bucket", [2048, 2])
def test_simhash_groups(spark, messy, bucket):
    rows = [r[:2] for r in messy_rows()]
    got = [(r.id, r.fingerprint % (1 << 64), r.component) for r in simhash.near_duplicates(messy, bucket=bucket).collect()]
    assert same(got, groups(rows))


def test_simhash_keeps_one_of_each_group(spark, messy, empty):
    want = groups([r[:2] for r in messy_rows()])
    kept = simhash.keep_one(messy).collect()
    assert len(kept) == len({(c, None if c is not None else f) for _, f, c in want})
    assert {r.doc_id for r in kept} >= {c for _, _, c in want if c is not None}
    assert simhash.keep_one(messy).columns == messy.columns
    assert simhash.keep_one(empty).count() == 0


def test_masks_cover_every_pair_within_the_radius():
    of = simhash.masks(list(range(64)), 3)
    rng = random.Random(1)
    for _ in range(3000):
        flips = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not m & flips for m in of)
        top = rng.choice([m for m in of if not m & flips])
        assert any(not m & flips for m in simhash.finer(top, 3))


def test_components_of_a_path_and_a_star(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, i) for i in range(101, 400)] + [(500, 500)]
    rng.shuffle(edges)
    got = {r.node: r.root for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**{i: 1 for i in range(1, 61)}, **{i: 100 for i in range(100, 400)}}


def covered(rows, length):
    count = collections.Counter()
    data = [(i, (t or "").encode()) for i, t in rows]
    for _, b in data:
        count.update(b[p:p + length] for p in range(len(b) - length + 1))
    for i, b in data:
        flag = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if count[b[p:p + length]] > 1:
                flag[p:p + length] = b"\1" * length
        kept = bytes(x for x, f in zip(b, flag) if not f)
        yield i, len(b), sum(flag), len(re.findall(b"\1+", bytes(flag))), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("group", [20000, 2])
def test_repeats(spark, messy, empty, group):
    got = [(r.id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest())
           for r in repeats.remove_repeats(messy, length=60, gram=12, group=group).collect()]
    assert same(got, covered([r[:2] for r in messy_rows()], 60))
    assert repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("group", [20000, 2])
def test_groups_of_repeats(spark, messy, empty, group):
    """Occurrences of a group are the same bytes, all of them are there, and together they are what is removed."""
    rows = [r[:2] for r in messy_rows() if r[0] is not None]
    docs = spark.createDataFrame(rows, "doc_id long, text string").distinct()
    data = {}
    for i, t in set(rows):
        data.setdefault(i, []).append((t or "").encode())
    found = collections.defaultdict(set)
    for r in repeats.groups(docs, length=60, gram=12, group=group).collect():
        found[r.group].add((r.id, r.start, r.end))
    cover = collections.defaultdict(set)
    for name, places in found.items():
        (size,) = {e - s for _, s, e in places}
        assert size >= 60
        texts = [{b[s:e] for b in data[i] if len(b) >= e} for i, s, e in places]
        assert set.intersection(*texts), name
        if all(len(data[i]) == 1 for i, _, _ in places):
            (text,) = set.intersection(*texts)
            everywhere = {(i, p, p + size) for i, bs in data.items() for b in bs for p in range(len(b) - size + 1) if b[p:p + size] == text}
            if all(len(data[i]) == 1 for i, _, _ in everywhere):
                assert places == everywhere
        for i, s, e in places:
            cover[i] |= set(range(s, e))
    removed = {r.id: r.n_removed for r in repeats.remove_repeats(docs, length=60, gram=12, group=group).collect()}
    for i, bs in data.items():
        if len(bs) == 1:
            assert len(cover[i]) == removed[i]
    assert len(found) > 3 and repeats.groups(empty).count() == 0


def test_planted_passages_go_whole(spark):
    """Every passage of 400 bytes or more that occurs twice is removed, whatever stands around it; shorter ones stay."""
    rng = random.Random(12)
    words = lambda n: " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))
    passages = [words(n) for n in (52, 60, 75, 90, 140)]
    texts = [words(40) + " " + p + " " + words(30) for p in passages for _ in range(2)] + [passages[-1], words(200)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept = {r.id: bytes(r.kept).decode() for r in repeats.remove_repeats(docs).collect()}
    for k, p in enumerate(passages):
        for i in (2 * k, 2 * k + 1):
            assert (p in kept[i]) == (len(p) < 400) and (len(p) < 400 or p[:20] not in kept[i])
    assert kept[10] == "" and kept[11] == texts[11] and sum(len(p) < 400 for p in passages) >= 1


def test_one_of_linked_rows_without_ids_stays(spark):
    rows = [(0, "some text of several words"), (None, ""), (None, None), (None, "other words that stand alone here"), (None, "other words that stand alone here")]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is None, r.text or "") for r in kept) == [(False, "some text of several words"), (True, ""), (True, "other words that stand alone here")]


def test_one_rare_token_in_many_lines(spark):
    """Lines that share one token only meet at it and stay; with a similar line among them that one goes."""
    n = 3000
    lines = spark.range(n).select(F.col("id").alias("doc_id"), F.concat(
        F.lit("the very same five words "), F.array_join(F.transform(F.sequence(F.lit(1), F.lit(12)), lambda i: F.concat(F.lit("w"), F.hash("id", i).cast("string"))), " ")).alias("text"))
    more = lines.limit(1).select((F.col("doc_id") + n).alias("doc_id"), F.concat("text", F.lit(" end")).alias("text"))
    got = line_dedup.dedup_lines(lines.union(more)).where("n_removed > 0").collect()
    assert [r.doc_id for r in got] == [n]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=6), st.text("ab", max_size=6)), min_size=2, max_size=7), st.integers(2, 8))
def test_maximal_repeats_reach_every_pair(contexts, least):
    lefts = [a.encode() for a, _ in contexts]
    rights = [b.encode() for _, b in contexts]
    common = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    want = []
    for i in range(len(contexts)):
        ok = [(common(lefts[i], lefts[j]), common(rights[i], rights[j])) for j in range(len(contexts)) if j != i]
        ok = [(a, b) for a, b in ok if b > 0 and a + b >= least]
        want.append((max((a for a, _ in ok), default=0), max((b for _, b in ok), default=0)))
    found = [(0, 0)] * len(contexts)
    for members, left, right in repeats.maximal_repeats(lefts, rights, least):
        assert len({(lefts[m][:left], rights[m][:right]) for m in members}) == 1
        for m in members:
            found[m] = max(found[m][0], left), max(found[m][1], right)
    assert found == want


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(4)
    text = rng.integers(97, 100, 5000, np.uint8).tobytes()
    at, *_ = repeats.anchors(text, 100, 10)
    for p in range(0, 4900, 37):
        inside = at[(at >= p) & (at <= p + 90)]
        alone, *_ = repeats.anchors(text[p:p + 100], 100, 10)
        assert alone[0] + p in inside


def line_sets(rows):
    for i, t in rows:
        for n, line in enumerate((t or "").split("\n")):
            w = re.findall(r"[^\x20\x09-\x0D]+", line)
            yield i, n, frozenset(" ".join(w[j:j + 5]) for j in range(len(w) - 4)) or (frozenset([" ".join(w)]) if w else frozenset())


def test_similar_lines(spark, empty):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(30)]
    lines = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(60)]
    rows = []
    for i in range(80):
        parts = []
        for _ in range(rng.randint(0, 6)):
            w = rng.choice(lines).split(" ")
            if rng.random() < 0.6:
                w[rng.choice([0, -1])] = rng.choice(words)
            parts.append(rng.choice(["", " ", "\t"]) + " ".join(w))
        rows.append((i, None if i % 20 == 3 else "\n".join(parts)))
    rows += [(5, rows[5][1])]  # a repeated row is the same document
    sets = sorted({(i, n, s) for i, n, s in line_sets(rows)}, key=lambda x: x[:2])
    gone = collections.defaultdict(set)
    for k, (i, n, s) in enumerate(sets):
        if s and any(o and 5 * len(s & o) >= 4 * len(s | o) for _, _, o in sets[:k]):
            gone[i].add(n)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, n_removed string")
    got = {r.doc_id: r for r in line_dedup.dedup_lines(df).collect()}
    for i, t in rows:
        want = t if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i])
        assert got[i].text == want and got[i].n_removed == len(gone[i]) and got[i].n_lines == (t or "").count("\n") + 1
    assert sum(map(len, gone.values())) > 50


def test_line_dedup_on_messy_documents(spark, messy, empty):
    out = line_dedup.dedup_lines(messy).collect()
    assert len(out) == len(messy_rows())
    assert set(messy.columns) - {"n_lines"} <= set(out[0].asDict())
    by = {(r.doc_id, r.line): r for r in out}
    assert by[3, 7].text is None and by[2, 3].text is not None
    assert by[2, 1].text == "" and by[2, 2].text == ""  # copies of row 1, whose id is smaller; null ids come first
    assert line_dedup.dedup_lines(empty).count() == 0

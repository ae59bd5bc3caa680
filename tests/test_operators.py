import math
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.functions import arrays as A
from veilframe.functions import text as T
from veilframe.operators import corpus, decode, extract, metrics, rows, telemetry, vectors
from veilframe.operators.islands import islands
from veilframe.operators.ordering import row_index, row_index_by_id, running


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first().x


def ints(xs):
    return F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<int>")


def test_running_with_a_hot_group(spark):
    rng = random.Random(1)
    data = [("hot" if rng.random() < 0.6 else f"g{rng.randrange(5)}", i, rng.randrange(9)) for i in range(500)]
    for parts in (1, 17):
        df = spark.createDataFrame(data, "g string, i long, v long").repartition(parts)
        got = {r.i: (r.s, r.m) for r in running(df, ["i"], {"s": ("sum", "v"), "m": ("max", "v")}, by=["g"], inclusive=False).collect()}
        seen = {}
        for g, i, v in data:
            before = seen.setdefault(g, [])
            assert got[i] == (sum(before), max(before) if before else None)
            before.append(v)


def test_row_index(spark):
    df = spark.range(1000).withColumn("k", F.md5(F.col("id").cast("string")))
    got = [r.row_idx for r in row_index(df, ["k"]).orderBy("k").collect()]
    assert got == list(range(1000))
    got = row_index_by_id(df.where("id % 3 = 0"), "id", width=64).orderBy("id").collect()
    assert [r.row_idx for r in got] == list(range(334))


def test_islands_touching_and_labels(spark):
    spans = [("d", 1, 4, "b", 1), ("d", 3, 6, "a", 0), ("d", 6, 8, "c", 2), ("e", 0, 1, "x", 0)]
    df = spark.createDataFrame(spans, "doc string, s int, e int, label string, p int")
    got = islands(df, ["doc"], "s", "e", ["label"], "label", F.col("p")).orderBy("doc", "s").collect()
    assert [(r.doc, r.s, r.e, r.label, r.members) for r in got] == [("d", 1, 6, "a", 2), ("d", 6, 8, "c", 1), ("e", 0, 1, "x", 1)]


def test_islands_of_hot_and_ordinary_groups(spark):
    rng = random.Random(3)
    spans = [(None if d == 3 else f"g{d}", s, s + rng.randrange(1, 9), rng.choice("abc"), i)
             for d in range(5) for i, s in enumerate(rng.randrange(60 * (20 if d == 0 else 1)) for _ in range(400 if d == 0 else 20))]
    df = spark.createDataFrame(spans, "doc string, s int, e int, label string, i int").repartition(6)
    prio = F.when(F.col("label") == "b", 0).otherwise(1)
    ways = [sorted(map(str, islands(df, ["doc"], "s", "e", ["i"], "label", prio, large).collect())) for large in (1000, 100, 0)]
    assert ways[0] == ways[1] == ways[2] and len(ways[0]) > 50


def test_rows_validation(spark):
    df = row_index(spark.range(10).toDF("k"), ["k"])
    with pytest.raises(ValueError):
        rows.chunk(df, 3)
    with pytest.raises(ValueError):
        rows.rename(df, ["k"], ["a", "b"])
    assert rows.split_bounds("949,50,1", 1000) == [0, 949, 999, 1000]


def test_array_goldens(spark):
    assert one(spark, A.eos_mask(ints([0, 0, 2, 42, 3, 5, 1, 0, 0]), [1])) == [1] * 7 + [0] * 2
    df = spark.createDataFrame([(0, [1, 2, 3, 4]), (0, [5, 6, 7]), (0, [8, 9])], "b int, a array<int>")
    got = sorted(r.a for r in A.pad_batch(df, "b", {"a": 0}).collect())
    assert got == [[1, 2, 3, 4], [5, 6, 7, 0], [8, 9, 0, 0]]


def test_span_pairing(spark):
    pairs = lambda s, e: {(x.start, x.end) for x in one(spark, decode.pair_spans(ints(s), ints(e)))}
    gold, pred = pairs([1, 2, 10], [4, 12]), pairs([2, 10], [4, 11])
    assert gold == {(2, 4), (10, 12)} and len(gold & pred) == 1


def test_lcs_and_substring_against_brute_force():
    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [0]
            for j, y in enumerate(b):
                new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
            row = new
        return row[-1]
    rng = random.Random(3)
    for _ in range(200):
        a = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        b = "".join(rng.choice("abc") for _ in range(rng.randrange(12)))
        assert T.lcs_len(a, b) == lcs(a, b)
        best = max((n for n in range(len(a) + 1) for i in range(len(a) - n + 1) if a[i:i + n] in b), default=0)
        end, n = T.common_substring(a, b)
        assert n == best and a[end - n:end] in b


def test_near_terms_against_brute_force(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 7))) for _ in range(60)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    got = {(r.query, r.term): r.distance for r in extract.near_terms(df.select(F.col("w").alias("query")), df.select(F.col("w").alias("term"))).collect()}

    def dist(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]
    assert got == {(a, b): dist(a, b) for a in words for b in words if dist(a, b) <= 2}


def test_joined_tails_and_reverse(spark):
    items = [("李", "P"), ("的", "w"), ("父亲", "w"), ("王", "P2"), ("和", "w"), ("赵", "P2"), ("。", "w"), ("父亲", "w")]
    df = spark.createDataFrame([(1, items)], "id int, items array<struct<item:string,tag:string>>")
    conf = {"group": "亲属", "head": "P", "triggers": ["父亲"], "tails": ["P2"], "reverse": False}
    got = extract.mine_triples(df, "id", "items", [conf]).orderBy("tail_pos").collect()
    assert [(r.head, r.tail, r.src) for r in got] == [("李", "王", "HGT"), ("李", "赵", "HGT")]
    back = extract.mine_triples(df, "id", "items", [conf | {"reverse": True}]).orderBy("head_pos").collect()
    assert [(r.head, r.tail, r.src) for r in back] == [("王", "李", "REVERSE"), ("赵", "李", "REVERSE")]


def test_greedy_packs(spark):
    df = spark.createDataFrame([(i, n, "a") for i, n in enumerate([6, 5, 3, 4, 9, 2])], "i long, n long, batch string")
    got = [r.pack for r in corpus.greedy_packs(df, "i", "n", 8, "batch").orderBy("i").collect()]
    assert got == [0, 1, 1, 2, None, 2]


def test_block_split_keeps_ranks(spark):
    rng = random.Random(5)
    data = [(i, [rng.random() for _ in range(3)], rng.randrange(4)) for i in range(120)]
    df = spark.createDataFrame(data, "k long, v array<double>, label int")
    ranks = lambda rows_: {r.k: r["rank"] for r in vectors.first_match_rank(df, "k", "v", "label", block_rows=rows_).collect()}
    many = ranks(30)
    for k, v, label in data:
        order = sorted((sum((a - b) ** 2 for a, b in zip(v, w)), j, lab) for j, w, lab in data if j != k)
        assert many[k] == next(i for i, (_, _, lab) in enumerate(order, 1) if lab == label)


def test_closure_and_paths_of_any_depth(spark):
    chain = spark.createDataFrame([(i + 1, i) for i in range(12)], "child long, parent long")
    assert extract.closure(chain).count() == 12 * 13 // 2
    nodes = spark.createDataFrame([(i,) for i in range(13)], "id long")
    assert max(r.path.count("/") for r in extract.paths(nodes, chain).collect()) == 12
    loop = spark.createDataFrame([(1, 2), (2, 1)], "child long, parent long")
    assert sorted((r.child, r.ancestor) for r in extract.closure(loop).collect()) == [(1, 1), (1, 2), (2, 1), (2, 2)]


def test_label_scores_of_any_size(spark):
    df = spark.createDataFrame([(1, "a", 0, 0, 800.0, 0), (1, "b", 0, 0, 801.0, 0), (1, "b", 0, 0, -5.0, 1)],
                               "row int, label string, word int, mask int, score double, token int")
    got = {r.label: r for r in decode.label_scores(df, "row", "label", "word", "mask", "score", token="first").collect()}
    assert abs(got["b"].probability - 1 / (1 + math.exp(-1))) < 1e-9 and abs(got["a"].log_probability + 1.3132616875) < 1e-9
    got = {r.label: r.score for r in decode.label_scores(df, "row", "label", "word", "mask", "score", token="product").collect()}
    assert got == {"a": 800.0, "b": -4005.0}


def test_blend_repeats_a_short_source(spark):
    data = {"long": spark.range(500), "short": spark.range(1000, 1031)}
    got = corpus.blend(data, {"long": 1, "short": 1}, 200, "id").collect()
    assert len(got) == 200 and sum(r.source == "short" for r in got) == 100
    with pytest.raises(ValueError):
        corpus.blend({"none": spark.range(0)}, {"none": 1}, 5, "id")


def test_latency_of_a_large_group(spark):
    df = spark.range(5000).selectExpr("'a' AS g", "CAST(id * id AS DOUBLE) AS v").union(spark.createDataFrame([("none", None)], "g string, v double"))
    ways = [{r.g: r for r in telemetry.latency(df, "g", "v", large).collect()} for large in (1_000_000, 4999, 0)]
    round_all = lambda got: {g: [None if v is None else round(v, 6) if isinstance(v, float) else v for v in r[1:]] for g, r in got.items()}
    assert round_all(ways[0]) == round_all(ways[1]) == round_all(ways[2])
    got = ways[1]
    assert (got["a"].p50, round(got["a"].p95, 2), got["none"].p50) == (6247500.5, 22553475.95, None)


def test_report_fixtures(spark):
    df = spark.createDataFrame([("a", float(v)) for v in (1, 2, 3, 4)], "g string, v double")
    r = telemetry.latency(df, "g", "v").first()
    assert (r["mean"], r.p50, round(r.p95, 9), r.approximate) == (2.5, 2.5, 3.85, False)
    c = one(spark, telemetry.capacity(F.lit(10.0)))
    assert c.records_per_node_per_day == 576000 and c.nodes_both is None
    assert one(spark, telemetry.capacity(F.lit(10.0), 1_152_000, 1000, days=2)).nodes_both == 2
    with pytest.raises(ValueError):
        telemetry.capacity(F.lit(10.0), utilization=2)
    assert one(spark, telemetry.workers(F.lit(200 / 30), 36000, 1, 0.5)).workers == 3
    nulls = spark.createDataFrame([(None,), (2.0,), (6.0,)], "v double")
    r = telemetry.running_metric(nulls, "v").first()
    assert (r["count"], r["mean"], r["max"]) == (2, 4.0, 6.0)


def test_ranking_needs_complete_valid_equal_runs(spark):
    run = lambda d, rate, valid=True, chars=5: (d, 1, rate, rate * 9, 100, valid, chars)
    data = [run("a", 2.0), run("a", 4.0), run("b", 9.0), run("c", 5.0), run("c", 5.0, False), run("d", 6.0), run("d", 6.0, chars=7)]
    df = spark.createDataFrame(data, "device string, batch int, records_per_second double, chars_per_second double, peak_rss int, valid boolean, chars int")
    got = telemetry.rank_configs(df, ["device", "batch"], 2, ["chars"]).collect()
    assert [(r.device, r.records_per_second) for r in got] == [("a", 3.0)]


def test_char_answer_scores(spark):
    df = spark.createDataFrame([(1, "abcd", "abcd"), (2, "abcd", "abxd")], "k int, p string, g string")
    r = metrics.char_answer_report(df, "k", "p", "g").first()
    assert 0 < r.bleu < 1 and 0.5 < r.rouge_l < 1


def test_answer_scores(spark):
    s = one(spark, metrics.answer_scores(F.lit("The red cat"), F.array(F.lit("a red dog"), F.lit("cat"))))
    assert (s.exact, round(s.f1, 6)) == (0.0, round(2 / 3, 6))


def spread(lengths, parts, k):
    sums = [0] * k
    for n, p in zip(lengths, parts):
        sums[p] += n
    return max(sums) - min(sums)


def test_largest_differencing(spark):
    assert spread([8, 7, 6, 5, 4], corpus.differenced([8, 7, 6, 5, 4], 2, False), 2) == 2  # the method's well-known example
    rng = random.Random(8)
    for _ in range(60):
        k = rng.randint(1, 5)
        lengths = [rng.choice([0, 1, rng.randrange(1, 500)]) for _ in range(k * rng.randint(1, 12))]
        equal = corpus.differenced(lengths, k, True)
        assert sorted(equal.count(p) for p in range(k)) == [len(lengths) // k] * k
        assert len(corpus.differenced(lengths, k, False)) == len(lengths)
    with pytest.raises(ValueError):
        corpus.differenced([1, 2, 3], 2, True)
    rows = [(s, i, rng.randrange(1, 4000), "x") for s in range(6) for i in range(24)]
    df = spark.createDataFrame(rows, "step int, i int, n int, part string").drop("part")
    for equal in (True, False):
        got = corpus.differenced_partitions(df, ["step"], "i", "n", 4, equal).collect()
        assert sorted((r.step, r.i, r.n) for r in got) == sorted(r[:3] for r in rows)
        dealt = {(r.step, r.i): r.part for s in range(6) for r in corpus.balanced_partitions(df.where(F.col("step") == s), "i", "n", 4).collect()}
        for s in range(6):
            of = [r for r in got if r.step == s]
            mine = spread([r.n for r in of], [r.part for r in of], 4)
            assert mine <= spread([r.n for r in of], [dealt[s, r.i] for r in of], 4) and {r.part for r in of} == set(range(4))
            if equal:
                assert sorted(sum(r.part == p for r in of) for p in range(4)) == [6] * 4


def test_ranks_skip_far_blocks(spark):
    import numpy as np
    rng = np.random.default_rng(4)
    for clusters, least in ((12, 0.5), (1, 0.0)):
        x = rng.normal(size=(900, 5)) + 40 * rng.normal(size=(clusters, 5))[rng.integers(0, clusters, 900)]
        labels = rng.integers(0, 4, 900)
        labels[7] = 99  # alone with its label
        x[20:30] = x[20]  # ties
        df = spark.createDataFrame([(i, v.tolist(), int(c)) for i, (v, c) in enumerate(zip(x, labels))], "k long, v array<double>, l int").repartition(5)
        got = vectors.ranked_matches(df, "k", "v", "l", block_rows=60)
        d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        want = {}
        for i in range(900):
            order = sorted((j for j in range(900) if j != i), key=lambda j: (d[i, j], j))
            want[i] = next((r for r, j in enumerate(order, 1) if labels[j] == labels[i]), 0)
        assert {r.k: r.rank for r in got.rows.collect()} == want
        assert got.skipped / got.pairs >= least
    assert vectors.first_match_rank(df.limit(0), "k", "v", "l").count() == 0


def test_closure_of_a_tree_writes_a_row_per_node_not_per_pair(spark, monkeypatch):
    rows, write = [], extract.materialise

    def counted(df, label="step"):
        out = write(df, label)
        rows.append(out.count())
        return out
    monkeypatch.setattr(extract, "materialise", counted)
    chain = spark.createDataFrame([(i, i + 1) for i in range(30)], "child long, parent long")
    assert extract.closure(chain).distinct().count() == 30 * 31 // 2
    assert sum(rows) <= 4 * 30


def test_closure_of_trees_with_twins_cycles_and_nulls(spark):
    rng = random.Random(5)
    edges = [(i, rng.randrange(i)) for i in range(1, 40)] + [(30, 2), (35, 3), (35, 3), (50, 51), (51, 50), (52, 51), (60, 61), (61, None), (None, 7)]
    want, new = set(edges), set(edges)
    while new:
        new = {(c, q) for c, a in new for p, q in edges if a is not None and p == a} - want
        want |= new
    df = spark.createDataFrame(edges, "child long, parent long")
    got = [tuple(r) for r in extract.closure(df).collect()]
    assert set(got) == want and len([x for x in got if None not in x]) == len([x for x in want if None not in x])


def test_rough_squares_are_within_their_margin():
    rng = np.random.default_rng(4)
    q, t = rng.normal(size=(50, 64)) * 1e3, rng.normal(size=(60, 64))
    t[:10] = q[:10] + 1e-7
    t[11] = np.inf
    with np.errstate(invalid="ignore"):
        rough, off = vectors._rough_squares(q, t)
        exact = vectors._distances(q, t)
    fine = np.arange(60) != 11
    assert (np.abs(rough[:, fine] - exact[:, fine] ** 2) <= off[:, None]).all() and np.isinf(rough[:, 11]).all()
    x, y = np.nonzero(np.ones((50, 60)))
    assert (vectors._pair_distances(q, t, (x, y)) == exact.ravel()).all()


def test_ranks_with_near_ties_copies_and_missing_labels(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(12, 8))
    v = np.concatenate([base, base, base + 1e-9, rng.normal(size=(20, 8)), np.round(rng.normal(size=(40, 8)))])
    label = [None if i % 11 == 0 else int(i % 3) for i in range(len(v))]
    want = {}
    for i in range(len(v)):
        order = sorted((float(vectors._distances(v[i:i + 1], v[j:j + 1])[0, 0]), j) for j in range(len(v)) if j != i)
        want[i] = next((n for n, (_, j) in enumerate(order, 1) if label[i] is not None and label[j] == label[i]), 0)
    df = spark.createDataFrame([(i, v[i].tolist(), label[i]) for i in range(len(v))], "k long, v array<double>, l int")
    for size in (20, 500):
        assert {r.k: r["rank"] for r in vectors.first_match_rank(df, "k", "v", "l", block_rows=size).collect()} == want


def test_common_substring_of_a_long_run_of_one_character():
    text, begun = "a" * 12_000, time.process_time()
    assert T.common_substring(text, text) == (12_000, 12_000)
    assert T.common_substring("xbay" + "cab", "zcabbay") == (4, 3)
    assert time.process_time() - begun < 5


def test_mask_tokens_draws_once_a_token(spark):
    df = spark.range(3).select(corpus.mask_tokens(F.sequence(F.lit(1), F.lit(50)), F.col("id"), [1, 2], 0.15, -1, 0, 3).alias("m"))
    assert df._jdf.queryExecution().optimizedPlan().toString().count("md5(") <= 3

"""Estimates of sources with few rows."""

import numpy as np

from veilframe.llm import quality_rules as q


def measured(spark, parts):
    """parts: (source, language, array of vectors)."""
    rows = [(False, own, lang, *map(int, np.rint(x * q.SCALE))) for own, lang, xs in parts for x in xs]
    return spark.createDataFrame(rows, "base_failed boolean, _own long, _lang long, " + ", ".join(f"_x{i} long" for i in range(4))).repartition(3)


def cloud(seed, at, n, sd=0.05):
    return np.random.default_rng(seed).normal(at, sd, (n, 4))


def far(spark, parts, **params):
    """Squared distances by source."""
    m = measured(spark, parts)
    out = {}
    for r in m.join(q.fit(m, **params), "_own").select("_own", q.distance().alias("d")).collect():
        out.setdefault(r._own, []).append(r.d)
    return out


A, B = [5, 0.2, 0.3, 0.4], [7, 0.9, 0.9, 0.9]


def test_small_sources_are_measured_against_their_own(spark):
    stray = cloud(3, B, 4)
    got = far(spark, [(1, 50, np.vstack([cloud(1, A, 36), stray])), (2, 50, cloud(2, B, 70)), (3, 51, cloud(4, A, 2)), (4, 52, cloud(5, B, 1)), (5, 53, cloud(6, A, 300))])
    assert sum(d > q.CUTOFF for d in got[1]) == 4  # like the language's other source, not like their own
    assert all(max(got[n]) <= q.CUTOFF for n in (2, 3, 4, 5)) and max(got[4]) == 0


def test_no_step_at_the_size_where_a_source_stands_alone(spark):
    other = (2, 50, cloud(2, B, 90, 0.3))
    xs = cloud(1, A, 101)
    by = {n: far(spark, [(1, 50, xs[:n]), other])[1] for n in (99, 100, 101)}
    for n in (99, 100):
        a, b = np.sort(by[n]), np.sort(by[n + 1])[:n]
        assert np.median(np.abs(a - b) / b) < 0.1


def test_large_sources_stand_alone(spark):
    xs = cloud(1, A, 150)
    alone, among = far(spark, [(1, 50, xs)])[1], far(spark, [(1, 50, xs), (2, 50, cloud(2, B, 20))])[1]
    assert np.array_equal(np.sort(alone), np.sort(among))


def test_small_sources_of_junk_do_not_vouch_for_themselves(spark):
    junk = [5, 1.5, 0.3, 0.4]
    parts = [(1, 50, cloud(1, A, 400))] + [(10 + n, 50, cloud(n, junk, n, 0.01)) for n in (1, 2, 3, 5, 10)]
    got = far(spark, parts)
    assert all(min(got[10 + n]) > q.CUTOFF for n in (1, 2, 3, 5, 10)) and np.mean(np.array(got[1]) <= q.CUTOFF) > 0.99


def test_small_sources_among_differing_ones_stay(spark):
    places = np.random.default_rng(7).normal(A, 0.4, (12, 4))
    got = far(spark, [(k, 50, cloud(k, p, 200 if k < 10 else 4)) for k, p in enumerate(places)])
    assert all(max(got[k]) <= q.CUTOFF for k in (10, 11))

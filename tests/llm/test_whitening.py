from fractions import Fraction

import duckdb
import numpy as np
import pytest

from tests.llm.conftest import SF
from veilframe.llm import whitening
from veilframe.llm.queries import QUERIES


def brute(rows, k=4):
    """n, exact deviations, eigenvalues over their trace and whitened rows from the definition, without polarisation."""
    x = {i: [int(np.floor(256 * float(c))) for c in v] for i, v in rows}
    fit = [list(t) for t in {tuple(v) for v in x.values()}]
    n, d = len(fit), len(fit[0])
    sums = [sum(c) for c in zip(*fit)]
    z = np.array([[n * c - s for c, s in zip(v, sums)] for v in fit], object)
    v = np.array([[float(Fraction(int(c), n ** 3)) for c in r] for r in z.T.dot(z)])
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1][:k], axes.T[::-1][:k]
    mean = np.array([s / n for s in sums])
    far = {i: sum((n * c - s) ** 2 for c, s in zip(r, sums)) for i, r in x.items()}
    white = {i: (np.array(r) - mean) @ axes.T / np.sqrt(values) for i, r in x.items()}
    return n, far, white, values / np.trace(v)


def compare(got, rows, k=4):
    n, far, white, explained = brute(rows, k)
    seen = {}
    for r in got:
        assert r.n == n and r.deviation == far[r.id] and abs(r.explained - explained[r.component - 1]) < 1e-9 and r.identity_error < 1e-9
        seen.setdefault(r.component, {})[r.id] = r.whitened
    assert sorted(seen) == list(range(1, k + 1))
    for c, w in seen.items():
        ours, theirs = np.array([w[i] for i in sorted(w)]), np.array([white[i][c - 1] for i in sorted(white)])
        sign = np.sign(ours @ theirs)
        assert np.abs(ours - sign * theirs).max() < 1e-7


def test_query_equals_the_definition(spark):
    rows = duckdb.sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    got = QUERIES["op11_embedding_whitening"](spark, SF).withColumnRenamed("vec_id", "id").collect()
    assert len(got) == 4 * len(rows)
    compare(got, rows)


def frame(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, i, "x", 1) for i, v in rows], f"vec_id long, embedding array<{kind}>, n long, id string, x int")


def test_odd_rows(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(np.float32(c)) for c in rng.normal(size=6) * [1, 2, 3, 4, 5, 6] + 40]) for i in range(60)]
    good += [(100 + i, good[3][1]) for i in range(30)]  # copies count once in the fit list
    nan, inf = float("nan"), float("inf")
    odd = [(200, None), (201, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (202, [nan] * 6), (203, [inf] + [0.0] * 5), (204, [0.0] * 5 + [-inf]), (205, []), (206, [1.0]), (None, [nan] * 6)]
    compare(whitening.whiten(frame(spark, good + odd)).collect(), good)
    assert whitening.whiten(frame(spark, [])).collect() == [] and whitening.whiten(frame(spark, odd[:5])).collect() == []


def test_large_entries_stay_exact(spark):
    rng = np.random.default_rng(3)
    for scale in (1e6, 1e10, 1e14):
        rows = [(i, [float(c) for c in rng.normal(size=3) * [1, 3, 9] * scale]) for i in range(40)]
        n, far, _, explained = brute(rows, 3)
        for r in whitening.whiten(frame(spark, rows, "double")).collect():
            assert r.deviation == (far[r.id] if far[r.id] < 1 << 63 else None)
            assert abs(r.explained - explained[r.component - 1]) < 1e-9


def test_no_variance(spark):
    got = whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in got] == [(1, 0, None, 0.0, None)] * 4
    line = whitening.whiten(frame(spark, [(i, [float(i), 2.0 * i]) for i in range(9)])).collect()
    assert {(r.component, r.whitened is None) for r in line} == {(1, False), (2, True)}


@pytest.mark.parametrize("u", [[[3, -4], [5, 6]], [[(1 << 59) - 1, -(1 << 60)], [1 << 45, -(1 << 33) - 7]]])
def test_square_sums(u):
    want = [sum(c * c for c in col) for col in zip(*u)]
    assert whitening.square_sums(np.array(u, np.int64)) == want == whitening.square_sums(np.array(u, object))
    totals = [want[0], -want[1]]
    parts = [whitening._limbs(t) for t in totals]
    assert [sum(v << whitening.LIMB * i for i, v in enumerate(p)) for p in parts] == totals

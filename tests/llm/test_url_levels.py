"""Template trees on deep paths, against brute force."""

import collections
import random

from veilframe.llm import url_filter


def brute(paths):
    """Template per (host, segs) of {(host, segs): (n, good, bad)}."""
    template = dict.fromkeys(paths, "")
    for level in range(max(len(s) for _, s in paths)):
        child, parent = collections.defaultdict(lambda: [0, 0, 0]), collections.defaultdict(lambda: [0, 0, 0])
        for (h, s), x in paths.items():
            if len(s) > level:
                for t in (child[h, template[h, s], s[level]], parent[h, template[h, s]]):
                    t[:] = [a + b for a, b in zip(t, x)]
        old = dict(template)
        for h, s in paths:
            if len(s) > level:
                n, good, bad = child[h, old[h, s], s[level]]
                _, pg, pb = parent[h, old[h, s]]
                share = pg / (pg + pb) if pg + pb else 0
                stays = n >= url_filter.MIN_PAGES and 0 < share < 1 and (good - (good + bad) * share) ** 2 > url_filter.Z ** 2 * (good + bad) * share * (1 - share)
                template[h, s] += "/" + (s[level] if stays else "*")
    return template


def frame(spark, rows):
    return spark.createDataFrame([(n, u, y) for n, (u, y) in enumerate(rows)], "page_id long, url string, label int").repartition(4)


def test_a_split_at_the_sixth_level(spark):
    rows = [(f"http://a.com/a/b/c/d/e/{part}/{'xyz'[n % 3]}{part}/{n}", label) for n in range(60) for part, label in (("spam", 0), ("docs", 1))]
    got = {r.path.split("/")[6]: (r.template, r.verdict) for r in url_filter.judge(frame(spark, rows), []).collect()}
    assert got == {"spam": ("/*/*/*/*/*/spam/*/*", "block"), "docs": ("/*/*/*/*/*/docs/*/*", "allow")}


def test_deep_paths_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(1500):
        segs = [rng.choice("abc") for _ in range(rng.choice([0, 1, 3, 6, 7, 9]))]
        bad = "".join(segs).count("a") + (len(segs) > 6 and segs[6] == "b") * 5
        rows.append((f"http://{rng.choice(['x.org', 'y.org'])}/" + "/".join(segs), rng.choice([None, int(rng.random() * 6 > bad)])))
    rows.append(("http://x.org/" + "q/" * 300, 0))
    paths = collections.defaultdict(lambda: [0, 0, 0])
    for u, y in rows:
        h, _, p = u[7:].partition("/")
        x = paths[h, tuple(s for s in p.split("/") if s)]
        x[:] = x[0] + 1, x[1] + (y == 1), x[2] + (y == 0)
    want = brute(paths)
    got = {(r.host, tuple(s for s in r.path.split("/") if s)): r.template for r in url_filter.judge(frame(spark, rows), []).collect()}
    assert got == want and any(t.count("/") > 5 and not t.endswith("/*/*/*") for t in want.values())


def test_common_levels_are_skipped(spark, monkeypatch):
    """A deep common path costs no tables: the descent goes to where paths part at once, and the templates are as without skipping."""
    common = "/".join(f"p{'abcdefghij'[k % 10]}{'x' * k}" for k in range(25))
    rows = [(f"http://h.com/{common}/{part}/{'uvw'[n % 3]}", label) for n in range(40) for part, label in (("spam", 0), ("docs", 1))]
    rows += [(f"http://h.com/{common}", 1), (f"http://h.com/{common.split('/')[0]}", 0), ("http://i.com/" + "z/" * 40, 1)]
    labels = []
    monkeypatch.setattr(url_filter, "materialise", lambda df, label="step", real=url_filter.materialise: labels.append(label) or real(df, label))
    got = {r.path.split("/")[26]: r.verdict for r in url_filter.judge(frame(spark, rows), []).collect() if r.path.count("/") > 26 and r.host == "h.com"}
    assert got == {"spam": "block", "docs": "allow"} and labels.count("level") < 12
    monkeypatch.setattr(url_filter, "_common_levels", lambda *_: 0)
    slow = {(r.path, r.template) for r in url_filter.judge(frame(spark, rows[-30:]), []).collect()}
    monkeypatch.undo()
    assert slow == {(r.path, r.template) for r in url_filter.judge(frame(spark, rows[-30:]), []).collect()}

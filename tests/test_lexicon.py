import random

from pyspark.sql import functions as F

from veilframe.operators import extract, lexicon
from veilframe.operators.redact import redact


def brute(text, phrases):
    """Longest phrase per start, kept when it ends behind everything kept before."""
    out, reach = [], 0
    for s in range(len(text)):
        e = max((s + len(p) for p in phrases if p and text.startswith(p, s)), default=0)
        if e > reach:
            reach = e
            out.append((s, e))
    return out


def test_matches_against_brute_force(spark):
    rng = random.Random(2)
    some = lambda n: "".join(rng.choice("ab日\U0001f600 ") for _ in range(n))
    phrases = sorted({some(rng.randint(1, 7)) for _ in range(40)})
    texts = [some(rng.randint(0, 60)) for _ in range(60)] + ["", None, "x" * 50]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc long, text string").repartition(4)
    table = spark.createDataFrame([(p,) for p in [*phrases, phrases[0], "", None]], "phrase string")
    got = {r.doc: [(m.start, m.end) for m in r.matches] for r in lexicon.lexicon_matches(docs, "text", table).collect()}
    want = {i: brute(t or "", phrases) for i, t in enumerate(texts)}
    assert got == want
    rows = lexicon.keep_forward(lexicon.lexicon_join(docs, "doc", "text", table), "doc").collect()
    assert {(r.doc, r.start, r.end) for r in rows} == {(i, *m) for i, ms in want.items() for m in ms}
    none = lexicon.lexicon_matches(docs, "text", table.limit(0))
    assert none.count() == len(texts) and none.where(F.size("matches") > 0).isEmpty()


def test_two_million_phrases(spark):
    table = spark.range(2_000_000).select(F.concat(F.lit("p"), F.col("id").cast("string"), F.lit("q")).alias("phrase"))
    f = lexicon.build_filter(table)
    assert f.bits <= lexicon.MOST_BITS and f.lengths == list(range(3, 10))
    text = "".join(f" p{n}q" for n in range(0, 3_000_000, 997)) + " p12 p13qp14q"
    docs = spark.createDataFrame([(1, text)], "doc long, text string")
    m = lexicon.lexicon_matches(docs, "text", table).first().matches
    assert len(m) == len(range(0, 2_000_000, 997)) + 2
    a, *_ = lexicon.passing(["z" * 200_000], f)
    assert len(a) < 7 * 200_000 * 0.05  # few substrings that are no phrases pass


def test_detector_on_a_table_of_phrases(spark):
    table = spark.createDataFrame([("Ann Lee", "地址"), ("Ann", "人名"), ("Ann", "人名")], "phrase string, type string")
    docs = spark.createDataFrame([(1, "of Ann Lee, 12345678"), (2, None), (3, " ")], "doc long, text string")
    got = {r.doc: r.redacted for r in redact(docs, detector=lexicon.lexicon_detector(table)).collect()}
    assert got == {1: "of [地址已脱敏], ********", 2: "", 3: " "}


def pieces(w, vocab, unk="[UNK]"):
    out, at = [], 0
    while at < len(w):
        mark = "##" if at else ""
        end = next((e for e in range(len(w), at, -1) if mark + w[at:e] in vocab), None)
        if end is None:
            return [unk]
        out.append(mark + w[at:end])
        at = end
    return out


def test_sub_words_against_brute_force(spark):
    rng = random.Random(5)
    vocab = sorted({rng.choice(["", "##"]) + "".join(rng.choice("abc#") for _ in range(rng.randint(1, 4))) for _ in range(60)} | {"##", "#"})
    words = sorted({"".join(rng.choice("abc#") for _ in range(rng.randint(1, 12))) for _ in range(300)} | {"x", "ab" * 60})
    table = spark.createDataFrame([(v,) for v in vocab], "token string")
    rows = spark.createDataFrame([(w, i) for i, w in enumerate(words)] + [("", -1), (None, -2), (words[0], -3)], "word string, n long").repartition(3)
    got = {r.n: r.pieces for r in lexicon.sub_words(rows, table, max_chars=100).collect()}
    want = {i: pieces(w, set(vocab) - {"##"}) if len(w) <= 100 else ["[UNK]"] for i, w in enumerate(words)}
    for i, w in enumerate(words):
        if "##" not in w:  # a token of the mark alone begins a word only
            assert got[i] == want[i], w
    assert got[-1] == [] and got[-2] is None and got[-3] == got[0]


def test_sub_words_goldens_and_a_large_vocabulary(spark):
    small = spark.createDataFrame([("un",), ("##aff",), ("##able",)], "token string")
    words = spark.createDataFrame([("unaffable",), ("xyz",), ("un",)], "word string")
    assert {r.word: r.pieces for r in lexicon.sub_words(words, small).collect()} == {
        "unaffable": ["un", "##aff", "##able"], "xyz": ["[UNK]"], "un": ["un"]}
    large = spark.range(3_000_000).select(F.concat(F.when(F.col("id") % 2 == 0, "##").otherwise(""), F.hex("id")).alias("token"))
    words = spark.createDataFrame([("FFF2C6C0",), ("1",), ("2",), ("3ZZ",)], "word string")
    got = {r.word: r.pieces for r in lexicon.sub_words(words, large).collect()}
    assert got["1"] == ["1"] and got["2"] == ["[UNK]"] and got["3ZZ"] == ["[UNK]"] and "".join(p.removeprefix("##") for p in got["FFF2C6C0"]) == "FFF2C6C0"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_near_terms_of_all_lengths(spark):
    rng = random.Random(6)
    a = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 9))) for _ in range(120)})
    b = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(0, 9))) for _ in range(120)})
    q = spark.createDataFrame([(w,) for w in [*a, a[3], None]], "query string")
    t = spark.createDataFrame([(w,) for w in [*b, None]], "term string")
    for d in (1, 2):
        got = {(r.query, r.term): r.distance for r in extract.near_terms(q, t, d).collect()}
        assert got == {(x, y): n for x in a for y in b if (n := distance(x, y)) <= d}


def test_many_short_words_meet_only_near_ones(spark):
    n = 1000
    letter = lambda c: F.decode(F.unhex(F.hex(c.cast("long") + 0x4E00)), "UTF-16BE")
    words = spark.range(n * n).select(F.concat(letter(F.col("id") / n), letter(F.col("id") % n)).alias("term"))
    assert words.distinct().count() == n * n
    q = words.filter(F.xxhash64("term") % 50_000 == 0).withColumnRenamed("term", "query")
    k = q.count()
    got = extract.near_terms(q, words, 1)
    assert k > 5 and got.count() == k * (2 * (n - 1) + 1)

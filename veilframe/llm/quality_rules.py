"""Quality rules with robust multivariate outliers, in DataFrame functions only.

Statistics of a text are array expressions in its own row. Per language and source a minimum-covariance-determinant
estimate is found by concentration steps: aggregate, measure, keep the closest part, repeat. Statistic vectors
are fixed-point integers, so sums are exact and do not depend on how rows are dealt to tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.llm.common import has_word, words
from veilframe.session import materialise

SYMBOLS = r"[#*$%&|<>]"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
SCALE = 4096
#: Least standard deviation of each transformed statistic: log word length, symbol, duplicate-line and repeated-word shares.
FLOORS = (0.05, 0.04, 0.08, 0.08)
COVERAGE = 0.75  # share of a group's rows that the estimate is fitted to
#: For 4 dimensions: 0.75 / P(chi2_6 <= chi2_4's 0.75 quantile), so that the estimate is consistent for normal data.
CONSISTENCY = 0.75 / (1 - math.exp(-5.38527 / 2) * (1 + 5.38527 / 2 + (5.38527 / 2) ** 2 / 2))
STEPS = 50  # at most; a dozen do as a rule
CUTOFF = 30.0  # squared Mahalanobis distance; chi2_4 exceeds 30 once in 200,000
_D = range(len(FLOORS))
_PAIRS = [(i, j) for i in _D for j in range(i + 1)]


def statistics(text: Column) -> dict[str, Column]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines of a whole text; a null text is empty.

    n_repeat_words counts the words in 3-word windows that occur twice or more in the text, the first included.
    """
    text = F.coalesce(text, F.lit(""))
    counted = let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        _repeated(w).cast("long").alias("n_repeat_words")))
    lines = let(F.filter(F.split(text, "\n", -1), has_word), lambda x: F.struct(
        F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    return {"_w": counted, "_l": lines, "n_symbols": F.regexp_count(text, F.lit(SYMBOLS)).cast("long")}


def _repeated(w: Column) -> Column:
    hashes = F.when(F.size(w) >= 3, F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(
        F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))).otherwise(F.array().cast("array<bigint>"))
    return let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(_covered(h)))


def _covered(h: Column) -> Column:
    """Words under a repeated window: hashes sorted with their position in the low bits, neighbours compared in full."""
    def by_bits(bits):
        low = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
        packed = F.transform(h, lambda x, i: F.call_function("shiftleft", F.call_function("shiftright", x, bits), bits).bitwiseOR(i.cast("long")))
        return let(F.sort_array(packed), lambda s: let(low, lambda m: _spread(s, m)))

    def _spread(s, m):
        full = lambda x: F.get(h, x.bitwiseAND(m).cast("int"))
        hits = F.array_compact(F.transform(s, lambda x, i: F.when(
            F.coalesce(full(F.get(s, i - 1)) == full(x), F.lit(False)) | F.coalesce(full(F.get(s, i + 1)) == full(x), F.lit(False)),
            x.bitwiseAND(m))))
        return let(hits, lambda p: F.size(F.array_distinct(F.concat(p, F.transform(p, lambda x: x + 1), F.transform(p, lambda x: x + 2)))))

    return let(F.ceil(F.log2(F.size(h) + 1)).cast("int"), by_bits)


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
            extra: list[Column] | None = None) -> DataFrame:
    """(id, base statistics, base_failed, _own, _lang, _x0.._x3): one row per row, any nulls allowed.

    _own and _lang name the row's group and its language; the transformed statistics are smoothed so that
    short texts do not stray: a log mean word length and three arcsine roots of shares.
    """
    got = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"),
                      *[c.alias(n) for n, c in statistics(F.col(text_col)).items()], *(extra or []))
    names = [c for c in got.columns if c not in ("_w", "_l")]
    got = got.select(*names, "_w.n_words", "_w.word_chars", "_w.n_repeat_words", "_l.n_lines", "_l.n_dup_lines")
    share = lambda a, b, prior: F.asin(F.sqrt(F.least(F.lit(1.0), F.col(a) / (F.col(b) + prior))))
    x = [F.log((F.col("word_chars") + 500.0) / (F.col("n_words") + 100.0)), share("n_symbols", "word_chars", 200.0),
         share("n_dup_lines", "n_lines", 4.0), share("n_repeat_words", "n_words", 100.0)]
    return got.select(
        "*", ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        F.xxhash64(F.lit("source"), F.col("lang").isNull(), "lang", F.col("source").isNull(), "source").alias("_own"),
        F.xxhash64(F.lit("lang"), F.col("lang").isNull(), "lang").alias("_lang"),
        *[F.round(c * SCALE).cast("long").alias(f"_x{i}") for i, c in enumerate(x)]).drop("lang", "source", "n_lines")


def groups(measured: DataFrame) -> DataFrame:
    """(_own, _lang, n): how many rows each source of a language has."""
    return materialise(measured.groupBy("_own", "_lang").agg(F.count(F.lit(1)).alias("n")), "groups")


def estimates(vectors: DataFrame, steps: int = STEPS) -> DataFrame:
    """(_group, _m0.., _l00..): location and Cholesky factor per group of (_group, _x0..).

    From two starts, quartiles and plain moments, each step refits on the COVERAGE share of the rows that
    lie closest (ties at the border included), until the estimates of all groups stand (after `steps` at the latest); of the two the
    smaller determinant wins. A least deviation per dimension
    keeps groups whose rows agree exactly from having no spread. Distances are ranked on a fixed fine
    grid, so the exact quantile needs bounded memory whatever the size of a group.
    """
    quart = vectors.groupBy("_group").agg(*[F.percentile(f"_x{i}", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(f"q{i}") for i in _D])
    robust = quart.select("_group", F.lit(0).alias("_start"), *[(F.col(f"q{i}")[1] / SCALE).alias(f"_m{i}") for i in _D], *[
        (((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / SCALE / 1.349) ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in _PAIRS])
    plain = _moments(vectors.withColumn("_start", F.lit(1)), 1.0)
    now = materialise(_cholesky(robust.unionByName(plain)), "estimates")
    for _ in range(steps):
        away = vectors.join(now, "_group").withColumn("_bin", F.floor(F.log1p(distance()) * 2048))
        # two rows a group, written, so that a large group's rows need not move to them
        near = materialise(away.groupBy("_group", "_start").agg(F.percentile("_bin", COVERAGE).alias("_edge")), "near")
        close = away.join(near, ["_group", "_start"]).filter(F.col("_bin") <= F.col("_edge"))
        before, now = now, materialise(_cholesky(_moments(close, CONSISTENCY)), "estimates")
        both = now.select("_group", "_start", "_det").join(before.select("_group", "_start", F.col("_det").alias("_was")), ["_group", "_start"])
        if both.filter(F.abs(F.col("_det") - F.col("_was")) > F.col("_was") * 1e-9).isEmpty():
            break
    cols = [c for c in now.columns if c not in ("_group", "_start", "_det")]
    best = now.groupBy("_group").agg(F.min(F.struct("_det", "_start", *cols)).alias("b"))
    return best.select("_group", *[F.col(f"b.{c}").alias(c) for c in cols])


def _moments(rows: DataFrame, factor: float) -> DataFrame:
    big = lambda c: F.sum(c.cast("decimal(20,0)"))
    got = rows.groupBy("_group", "_start").agg(
        F.count(F.lit(1)).alias("n"), *[big(F.col(f"_x{i}")).alias(f"s{i}") for i in _D],
        *[big(F.col(f"_x{i}") * F.col(f"_x{j}")).alias(f"p{i}{j}") for i, j in _PAIRS])
    d = lambda c: F.col(c).cast("double")
    return got.select("_group", "_start", *[(d(f"s{i}") / d("n") / SCALE).alias(f"_m{i}") for i in _D], *[
        ((d(f"p{i}{j}") - d(f"s{i}") * d(f"s{j}") / d("n")) / d("n") / SCALE / SCALE * factor).alias(f"c{i}{j}") for i, j in _PAIRS])


def _cholesky(params: DataFrame, floors: tuple[float, ...] = FLOORS) -> DataFrame:
    out = params
    for i in _D:
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}")
            for k in range(j):
                rest = rest - F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}")
            # c is positive semi-definite, so what is left of a diagonal is at least the floor, but for rounding
            out = out.withColumn(f"_l{i}{j}", F.sqrt(F.greatest(rest, F.lit(0.0)) + floors[i] ** 2) if i == j else rest / F.col(f"_l{j}{j}"))
    det = F.col("_l00") * F.col("_l11") * F.col("_l22") * F.col("_l33")
    return out.withColumn("_det", det).drop(*[f"c{i}{j}" for i, j in _PAIRS])


def distance() -> Column:
    """Squared Mahalanobis distance of _x to _m under the factor _l, by forward substitution."""
    y: list[Column] = []
    for i in _D:
        rest = F.col(f"_x{i}") / F.lit(float(SCALE)) - F.col(f"_m{i}")
        for k in range(i):
            rest = rest - F.col(f"_l{i}{k}") * y[k]
        y.append(rest / F.col(f"_l{i}{i}"))
    total = y[0] * y[0]
    for c in y[1:]:
        total = total + c * c
    return total


def _shrunk(of: DataFrame, est: DataFrame, min_rows: int) -> DataFrame:
    """(_own, estimate columns): each source's own estimate, which below min_rows rows leans on its language's the more the fewer they are.

    The language has the mean location of its sources, their mean covariance and the one between their locations; a source of
    n rows counts n times there, below min_rows n^2 / min_rows times, so that a few odd rows move neither. A location
    needs fewer rows than a covariance: of m = n / min_rows its own share is 1 - (1 - m)^5, and what it takes from the
    language brings the covariance between sources with it.
    """
    cols = [f"_l{i}{j}" for i, j in _PAIRS]
    product = lambda i, j: sum((F.col(f"_l{i}{k}") * F.col(f"_l{j}{k}") for k in range(1, j + 1)), F.col(f"_l{i}0") * F.col(f"_l{j}0"))
    part = F.least(F.lit(1.0), F.col("n") / F.lit(float(max(min_rows, 1))))
    own = (of.join(est.withColumnRenamed("_group", "_own"), "_own").withColumn("_part", part).withColumn("_weight", F.col("n") * F.col("_part"))
           .select("*", *[product(i, j).alias(f"_v{i}{j}") for i, j in _PAIRS]))
    own = materialise(own, "sources")
    exact = lambda c: F.sum(F.round(c * F.col("_weight") * 1e9).cast("decimal(34,0)")).cast("double") / 1e9 / F.sum(
        F.round(F.col("_weight") * 1e6).cast("decimal(28,0)")).cast("double") * 1e6
    centre = own.groupBy("_lang").agg(*[exact(F.col(f"_m{i}")).alias(f"_c{i}") for i in _D], *[exact(F.col(f"_v{i}{j}")).alias(f"_w{i}{j}") for i, j in _PAIRS])
    apart = own.join(centre, "_lang").groupBy("_lang").agg(*[
        exact((F.col(f"_m{i}") - F.col(f"_c{i}")) * (F.col(f"_m{j}") - F.col(f"_c{j}"))).alias(f"_b{i}{j}") for i, j in _PAIRS])
    share, lean = F.col("_part"), F.pow(1 - F.col("_part"), F.lit(5.0))
    at = lambda i: F.when(F.abs(F.col(f"_c{i}") - F.col(f"_m{i}")) < 1e-6, F.col(f"_m{i}")).otherwise(F.col(f"_c{i}"))  # noqa: E731  but for rounding
    mixed = own.join(materialise(centre.join(apart, "_lang"), "languages"), "_lang").select(
        "_own", "n", *[(F.col(f"_m{i}") + lean * (at(i) - F.col(f"_m{i}"))).alias(f"_m{i}") for i in _D],
        *[F.col(c).alias(f"_own{c}") for c in cols],
        *[(share * F.col(f"_v{i}{j}") + (1 - share) * F.col(f"_w{i}{j}") + lean * F.col(f"_b{i}{j}")).alias(f"c{i}{j}") for i, j in _PAIRS])
    mixed = _cholesky(mixed, (0.0,) * len(FLOORS))  # both have the least deviations in them
    return mixed.select("_own", *[f"_m{i}" for i in _D], *[
        F.when(F.col("n") >= min_rows, F.col(f"_own{c}")).otherwise(F.col(c)).alias(c) for c in cols])


def fit(measured: DataFrame, min_rows: int = 100, steps: int = STEPS) -> DataFrame:
    """(_own, estimate columns) from all measured rows that pass the base rules.

    Every source of a language is estimated by itself, whatever its size. Below min_rows rows its location and covariance lean on those
    of its language, which allow for the differences between sources, the more the fewer rows it has.
    """
    sound = measured.filter(~F.col("base_failed"))
    vectors = materialise(sound.select(F.col("_own").alias("_group"), *[f"_x{i}" for i in _D]), "vectors")
    return materialise(_shrunk(groups(sound), estimates(vectors, steps), min_rows), "estimates")


def judge(measured: DataFrame, fitted: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """Adds kept: false where the base rules fail, else whether the distance is at most the cutoff."""
    far = F.coalesce(distance() > cutoff, F.lit(False))
    return (measured.join(fitted, "_own", "left").withColumn("kept", ~F.col("base_failed") & ~far))


def quality(docs: DataFrame, min_rows: int = 100, cutoff: float = CUTOFF, **columns) -> DataFrame:
    """(id, base statistics, base_failed, kept), one row per row of docs; repeated rows repeat, an empty table gives none.

    Texts that are null or blank have no words and fail the base rules. A null language or source is a
    group like any other.
    """
    measured = materialise(measure(docs, **columns), "measured")
    return judge(measured, fit(measured, min_rows), cutoff).select("id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, min_rows: int = 100, cutoff: float = CUTOFF, **columns) -> DataFrame:
    """The rows of docs that pass, with all their columns.

    Estimates are fitted on the narrow table of statistics; the texts are then judged in place, without
    being shuffled for the verdicts.
    """
    fitted = fit(materialise(measure(docs, **columns), "measured"), min_rows)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return judge(measure(docs, extra=[whole], **columns), fitted, cutoff).filter("kept").select("_row.*")

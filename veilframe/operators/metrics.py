"""Evaluation metrics. Per-row work stays in array expressions, corpus sums are plain aggregates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.functions.text import lcs_length, ngrams, normalise_answer, squeeze
from veilframe.operators.ordering import row_index, running

SMALLEST = 2.2250738585072014e-308  # fixed value: stands in for a zero n-gram precision


def ratio(a: Column, b: Column) -> Column:
    return F.when(b == 0, 0.0).otherwise(a / b)


def f1(p: Column, r: Column) -> Column:
    return F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))


def numbered(items: Column) -> Column:
    """A multiset as a set: the k-th copy of an item becomes item#k, so intersections count copies.

    Sorted, equal items stand in runs; each run is counted from its start.
    """
    def of_runs(s, starts):
        def run(at, j):
            return F.transform(F.sequence(F.lit(0), F.coalesce(F.get(starts, j + 1), F.size(s)) - at - 1),
                               lambda k: F.concat_ws("#", F.get(s, at), k.cast("string")))
        return F.flatten(F.transform(starts, run))

    def of_sorted(s):
        starts = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return F.when(F.size(s) == 0, s).otherwise(let(starts, lambda b: of_runs(s, b)))
    # nulls last
    return let(items, lambda x: let(F.concat(F.sort_array(F.array_compact(x)), F.filter(x, lambda v: v.isNull())), of_sorted))


# n-gram metrics ----------------------------------------------------------------------------

def bleu_counts(cand: Column, refs: Column, n: int, label: Column | None = None,
                ref_labels: Column | None = None) -> Column:
    """struct<hit, labelled, total>: clipped matches, those with references of the same answer label, candidate n-grams.

    The n-grams are numbered once for both counts; without labels `labelled` is null.
    """
    hits = lambda mine, theirs: F.size(F.array_intersect(mine, F.flatten(theirs)))
    total = F.greatest(F.size(cand) - n + 1, F.lit(0))
    mine, theirs = numbered(ngrams(cand, n)), F.transform(refs, lambda r: numbered(ngrams(r, n)))
    if ref_labels is None:
        return F.struct(hits(mine, theirs).alias("hit"), F.lit(None).cast("int").alias("labelled"), total.alias("total"))
    same = lambda t: F.zip_with(t, ref_labels, lambda grams, lab: F.when(grams.isNull() | lab.eqNullSafe(label), grams).otherwise(F.array().cast("array<string>")))
    return let(mine, lambda m: let(theirs, lambda t: F.struct(
        hits(m, t).alias("hit"), hits(m, same(t)).alias("labelled"), total.alias("total"))))


def closest_length(cand: Column, refs: Column) -> Column:
    return F.array_min(F.transform(refs, lambda r: F.struct(
        F.abs(F.size(cand) - F.size(r)).alias("gap"), F.size(r).alias("n"))))["n"]


def bleu(pairs: DataFrame, cand: str, refs: str, n: int = 4, bonus: tuple[str, str] | None = None,
         alpha: float = 1.0, by: list[str] = ()) -> DataFrame:
    """Corpus BLEU over rows (candidate tokens, array of reference token arrays).

    bonus = (label column, reference labels column) adds labelled n-gram matches, weighted alpha, to
    matches and candidates alike.
    """
    c, r = F.col(cand), F.col(refs)
    labels = [F.col(x) for x in bonus] if bonus else []
    counts = [bleu_counts(c, r, k, *labels).alias(f"_n{k}") for k in range(1, n + 1)]
    parts = {"m": lambda x: x["hit"], "t": lambda x: x["total"]} | ({"b": lambda x: alpha * x["labelled"]} if bonus else {})
    sums = pairs.select(*by, F.size(c).alias("_c"), closest_length(c, r).alias("_r"), *counts).groupBy(*by).agg(
        F.sum("_c").alias("_c"), F.sum("_r").alias("_r"),
        *[F.sum(of(F.col(f"_n{k}"))).alias(f"_{p}{k}") for k in range(1, n + 1) for p, of in parts.items()])
    logs = F.lit(0.0)
    for k in range(1, n + 1):
        m, t = F.col(f"_m{k}").cast("double"), F.col(f"_t{k}").cast("double")
        if bonus:
            m, t = m + F.col(f"_b{k}"), t + F.col(f"_b{k}")
        p = F.when((t == 0) | (m == 0), F.lit(SMALLEST)).otherwise(m / t)
        logs = logs + F.ln(p) / n
    brevity = F.exp(F.least(1 - F.col("_r") / F.col("_c"), F.lit(0.0)))
    return sums.select(*by, (brevity * F.exp(logs)).alias("bleu"))


def rouge_n(pairs: DataFrame, cand: str, ref: str, n: int) -> DataFrame:
    """Recall over distinct n-grams, summed over rows."""
    mine, theirs = F.array_distinct(ngrams(F.col(cand), n)), F.array_distinct(ngrams(F.col(ref), n))
    rows = pairs.select(F.size(F.array_intersect(mine, theirs)).alias("hit"), F.size(theirs).alias("all"))
    return rows.agg((F.sum("hit") / F.sum("all")).alias("rouge"))


def rouge_l_rows(pairs: DataFrame, key: str, cand: str, ref: str, gamma: float = 1.2,
                 bonus: str | None = None) -> DataFrame:
    """F score per key over one row per (candidate, reference); bonus is added to all three lengths."""
    extra = F.col(bonus) if bonus else F.lit(0.0)
    rows = pairs.select(key, lcs_length(F.col(cand), F.col(ref)).alias("_l"), F.size(cand).alias("_c"),
                        F.size(ref).alias("_r"), extra.alias("_x"))
    part = lambda n: F.when(F.col(n) + F.col("_x") > 0, (F.col("_l") + F.col("_x")) / (F.col(n) + F.col("_x"))).otherwise(0.0)
    best = rows.groupBy(key).agg(F.max(part("_c")).alias("p"), F.max(part("_r")).alias("r"))
    g2 = gamma * gamma
    score = F.when((F.col("p") != 0) & (F.col("r") != 0),
                   (1 + g2) * F.col("p") * F.col("r") / (F.col("r") + g2 * F.col("p"))).otherwise(0.0)
    return best.withColumn("rouge_l", score)


def rouge_l(pairs: DataFrame, key: str, cand: str, ref: str, **kw) -> DataFrame:
    return rouge_l_rows(pairs, key, cand, ref, **kw).agg(F.avg("rouge_l").alias("rouge_l"))


def distinct_n(df: DataFrame, tokens: str, n: int, approximate: bool = False) -> DataFrame:
    """Distinct n-grams over all n-grams."""
    grams = df.select(F.explode(ngrams(F.col(tokens), n)).alias("g"))
    kinds = F.approx_count_distinct("g") if approximate else F.countDistinct("g")
    return grams.agg((kinds / F.count("g")).alias("distinct"))


def same_spans(a: Column, b: Column) -> Column:
    """How many spans (start, end) stand in both arrays, each counted once.

    As text: arrays of structs would be compared pair by pair, texts are looked up.
    """
    keys = lambda spans: F.transform(spans, lambda s: F.concat_ws(":", F.coalesce(s["start"].cast("string"), F.lit("-")), F.coalesce(s["end"].cast("string"), F.lit("-"))))
    return F.size(F.array_intersect(keys(a), keys(b)))


# classification ----------------------------------------------------------------------------

def prf(df: DataFrame, hit: Column, predicted: Column, gold: Column) -> DataFrame:
    """Precision, recall and F1 from per-row counts."""
    s = df.agg(F.sum(hit).alias("h"), F.sum(predicted).alias("p"), F.sum(gold).alias("g"))
    s = s.select(ratio(F.col("h"), F.col("p")).alias("precision"), ratio(F.col("h"), F.col("g")).alias("recall"))
    return s.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def confusion(df: DataFrame, gold: Column, pred: Column) -> DataFrame:
    one = lambda g, p: F.count_if((gold == g) & (pred == p))
    return df.agg(one(1, 1).alias("tp"), one(0, 1).alias("fp"), one(0, 0).alias("tn"), one(1, 0).alias("fn"))


def accuracy_f1(df: DataFrame, gold: Column, pred: Column) -> DataFrame:
    c = confusion(df, gold, pred)
    acc = (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("tn") + F.col("fn"))
    c = c.select(acc.alias("accuracy"), ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                 ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))
    c = c.withColumn("f1", f1(F.col("precision"), F.col("recall")))
    return c.withColumn("acc_and_f1", (F.col("accuracy") + F.col("f1")) / 2)


def matthews(df: DataFrame, gold: Column, pred: Column) -> DataFrame:
    """mcc, and mcc_ref which is 0 whenever one of the four counts is 0."""
    c = confusion(df, gold, pred)
    tp, fp, tn, fn = [F.col(x).cast("double") for x in ("tp", "fp", "tn", "fn")]
    den = F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn))
    c = c.withColumn("mcc", F.when(den == 0, 0.0).otherwise((tp * tn - fp * fn) / den))
    return c.withColumn("mcc_ref", F.when((tp == 0) | (fp == 0) | (tn == 0) | (fn == 0), 0.0).otherwise(F.col("mcc")))


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(F.coalesce(F.nanvl(F.corr(a, b), F.lit(0.0)), F.lit(0.0)).alias("pearson"))


def spearman(df: DataFrame, a: str, b: str, key: str) -> DataFrame:
    """1 - 6 sum d^2 / (n (n^2 - 1)) over ordinal ranks, ties by key; two distributed rankings."""
    rank = lambda c, name: row_index(df.select(key, c), [c, key], name).select(key, name)
    d = rank(a, "ra").join(rank(b, "rb"), key).select((F.col("ra") - F.col("rb")).cast("double").alias("d"))
    s = d.agg(F.sum(F.col("d") * F.col("d")).alias("d2"), F.count("*").cast("double").alias("n"))
    return s.select((1 - 6 * F.col("d2") / (F.col("n") * (F.col("n") * F.col("n") - 1))).alias("spearman"))


def per_label(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Confusion counts per label of a single-label task, from one (gold, pred) count table."""
    pairs = df.groupBy(F.col(gold).cast("string").alias("g"), F.col(pred).cast("string").alias("p")).agg(F.count("*").alias("n"))
    hit = F.col("g") == F.col("p")
    sides = pairs.select(F.explode(F.array(
        F.struct(F.col("g").alias("label"), F.when(hit, F.col("n")).otherwise(0).alias("tp"),
                 F.lit(0).cast("long").alias("fp"), F.when(hit, 0).otherwise(F.col("n")).alias("fn")),
        F.struct(F.col("p").alias("label"), F.lit(0).cast("long").alias("tp"),
                 F.when(hit, 0).otherwise(F.col("n")).alias("fp"), F.lit(0).cast("long").alias("fn")))).alias("s")).select("s.*")
    c = sides.groupBy("label").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    c = c.withColumn("precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))) \
         .withColumn("recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return c.withColumn("f1", f1(F.col("precision"), F.col("recall")))


def averages(counts: DataFrame) -> DataFrame:
    """Micro, macro and weighted averages of a per_label table."""
    s = counts.withColumn("support", F.col("tp") + F.col("fn")).agg(
        F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"),
        *[F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")],
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}")
          for c in ("precision", "recall", "f1")])
    s = s.withColumn("micro_precision", ratio(F.col("tp"), F.col("tp") + F.col("fp"))) \
         .withColumn("micro_recall", ratio(F.col("tp"), F.col("tp") + F.col("fn")))
    return s.withColumn("micro_f1", f1(F.col("micro_precision"), F.col("micro_recall"))).drop("tp", "fp", "fn")


def subset_accuracy(df: DataFrame, gold: Column, pred: Column, ignore=None) -> DataFrame:
    """Share of rows whose prediction equals the gold value (label arrays as sets)."""
    rows = df if ignore is None else df.where(gold != ignore)
    return rows.agg(F.avg((gold == pred).cast("double")).alias("accuracy"))


def perplexity(df: DataFrame, cross_entropy: Column, n_words: Column) -> DataFrame:
    return df.agg(F.exp(F.sum(cross_entropy) / F.sum(n_words)).alias("perplexity"))


def correction_f1(df: DataFrame, gold_flags: Column, pred_flags: Column,
                  gold_fix: Column | None = None, pred_fix: Column | None = None) -> DataFrame:
    """Sequence-level detection F1, or correction F1 when the corrected ids are given."""
    has_error = F.exists(gold_flags, lambda x: x == 1)
    if gold_fix is None:
        right = gold_flags == pred_flags
    else:
        times = lambda a, b: F.zip_with(a, b, lambda x, y: x * y)
        right = times(pred_fix, pred_flags) == times(gold_flags, gold_fix)
    s = df.agg(F.count_if(has_error & right).alias("tp"), F.count_if(has_error & ~right).alias("fn"),
               F.count_if(~has_error & (gold_flags != pred_flags)).alias("fp"))
    p, r = F.col("tp") / F.nullif(F.col("tp") + F.col("fp"), F.lit(0)), F.col("tp") / F.nullif(F.col("tp") + F.col("fn"), F.lit(0))
    return s.withColumn("precision", p).withColumn("recall", r).withColumn(
        "f1", F.when(F.col("tp") == 0, 0.0).otherwise(2 * p * r / (p + r)))


# answers -----------------------------------------------------------------------------------

def answer_scores(pred: Column, golds: Column) -> Column:
    """struct<exact, f1>: best over the gold answers after normalisation; no gold means ''."""
    tokens = lambda a: F.filter(F.split(a, " "), lambda t: t != "")
    norm_golds = F.filter(F.transform(golds, normalise_answer), lambda g: g != "")
    norm_golds = F.when(F.size(norm_golds) == 0, F.array(F.lit(""))).otherwise(norm_golds)

    def score(p, g):
        a, b = tokens(p), tokens(g)
        same = F.size(F.array_intersect(numbered(a), numbered(b)))
        f = F.when((F.size(a) == 0) | (F.size(b) == 0), (F.size(a) == F.size(b)).cast("double")) \
             .when(same == 0, 0.0).otherwise(2.0 * same / (F.size(a) + F.size(b)))
        return F.struct((p == g).cast("double").alias("exact"), f.alias("f1"))

    def best(p):
        return let(F.transform(norm_golds, lambda g: score(p, g)), lambda s: F.struct(
            F.array_max(F.transform(s, lambda x: x["exact"])).alias("exact"),
            F.array_max(F.transform(s, lambda x: x["f1"])).alias("f1")))

    return let(normalise_answer(pred), best)


def answer_report(scored: DataFrame) -> DataFrame:
    """Rows (exact, f1, has_answer, na_prob_above) -> totals, HasAns and NoAns in one pass.

    A question whose no-answer probability is above the threshold counts as answered ''.
    """
    value = lambda c: F.when(F.col("na_prob_above"), (~F.col("has_answer")).cast("double")).otherwise(F.col(c))
    flat = scored.select(value("exact").alias("exact"), value("f1").alias("f1"),
                         F.when(F.col("has_answer"), "HasAns").otherwise("NoAns").alias("part"))
    return flat.rollup("part").agg((100 * F.avg("exact")).alias("exact"), (100 * F.avg("f1")).alias("f1"),
                                   F.count("*").alias("total"))


def best_threshold(df: DataFrame, prob: str, key: str, score: str, has_answer: str, answered: str) -> DataFrame:
    """No-answer threshold with the highest total score; ordering by (prob, key).

    Starting from all questions unanswered, each question in order of probability adds its score,
    -1 when it should have stayed unanswered, or nothing.
    """
    delta = F.when(F.col(has_answer), F.col(score)).when(F.col(answered), -1.0).otherwise(0.0)
    rows = df.select(key, prob, delta.alias("_d"))
    base = df.agg(F.count_if(~F.col(has_answer)).alias("base"), F.count("*").alias("n")).first()
    cum = running(rows, [prob, key], {"cum": ("sum", "_d")})
    best = cum.agg(F.max_by(F.struct("cum", prob), F.struct("cum", -F.col(prob))).alias("b"))
    better = F.coalesce(F.col("b.cum") > 0, F.lit(False))
    return best.select(
        (100 * (F.when(better, F.col("b.cum")).otherwise(0.0) + base.base) / base.n).alias("best_score"),
        F.when(better, F.col("b")[prob]).otherwise(0.0).alias("best_threshold"))


def char_answer_report(pairs: DataFrame, key: str, pred: str, gold: str) -> DataFrame:
    """BLEU-4 and ROUGE-L over normalised characters."""
    chars = lambda c: F.filter(F.split(squeeze(F.col(c)), ""), lambda x: x != "")
    p = pairs.select(key, chars(pred).alias("_p"), chars(gold).alias("_g"))
    p = p.withColumn("_refs", F.array("_g"))
    return bleu(p, "_p", "_refs").join(rouge_l(p, key, "_p", "_g"))  # two single rows

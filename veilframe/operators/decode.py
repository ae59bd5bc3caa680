"""From scores and tags to answers: segments, spans, n-best, votes, top-k, offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.operators.ordering import running
from veilframe.operators.rows import top_k


def _positions(arr: Column, keep) -> Column:
    marked = F.transform(arr, lambda x, i: F.when(keep(x, i), i))
    return F.filter(marked, lambda i: i.isNotNull())


def _followed(points: Column, last: Column) -> Column:
    """Each position with its successor (the last one with `last`)."""
    return let(points, lambda p: F.zip_with(
        p, F.concat(F.slice(p, F.lit(2), F.size(p)), F.array(last)),
        lambda a, b: F.struct(a.alias("start"), b.alias("end"))))


def _pairs(points: Column, last: Column) -> Column:
    return F.filter(_followed(points, last), lambda s: s["start"].isNotNull())


def segments(tags: Column) -> Column:
    """array<struct<start,end,label>>: B, S and O open a segment, anything else continues one.

    The label is what follows the last '-' of the opening tag.
    """
    def cut(t):
        opens = _positions(t, lambda x, i: (i == 0) | F.substring(x, 1, 1).isin("B", "S", "O"))
        return F.transform(_pairs(opens, F.size(t)), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.substring_index(F.get(t, s["start"]), "-", -1).alias("label")))
    return let(tags, cut)


def suffix_segments(tags: Column) -> Column:
    """The same for tags with a position suffix: X-B opens, X-I continues, the label is X."""
    def cut(t):
        opens = _positions(t, lambda x, i: (i == 0) | ~x.endswith("-I"))
        return F.transform(_pairs(opens, F.size(t)), lambda s: F.struct(
            s["start"].alias("start"), s["end"].alias("end"),
            F.regexp_replace(F.get(t, s["start"]), "-[BIS]$", "").alias("label")))
    return let(tags, cut)


def bio_spans(tags: Column) -> Column:
    """array<struct<start,end>> (end inclusive) of B I* runs; an I without B is ignored."""
    def cut(t):
        breaks = _positions(t, lambda x, i: ~x.startswith("I"))
        runs = F.filter(_pairs(breaks, F.size(t)), lambda s: F.get(t, s["start"]).startswith("B"))
        return F.transform(runs, lambda s: F.struct(s["start"].alias("start"), (s["end"] - 1).alias("end")))
    return let(tags, cut)


def pair_spans(starts: Column, ends: Column) -> Column:
    """Each start goes to the nearest end at or behind it; each end keeps its largest start.

    In the sorted union an end closes a span exactly when a start stands directly before it.
    """
    tag = lambda arr, k: F.transform(arr, lambda p: F.struct(p.alias("pos"), F.lit(k).alias("kind")))
    merged = F.array_sort(F.array_distinct(F.concat(tag(starts, 0), tag(ends, 1))))
    shifted = let(merged, lambda m: F.zip_with(m, F.slice(m, F.lit(2), F.size(m)), lambda a, b: F.struct(
        a["pos"].alias("start"), b["pos"].alias("end"), a["kind"].alias("a"), b["kind"].alias("b"))))
    closed = F.filter(shifted, lambda s: (s["a"] == 0) & (s["b"] == 1))
    return F.transform(closed, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))


def token_at(token_spans: Column, offset: Column) -> Column:
    """First token whose [start, end) holds the character offset, else -1."""
    hits = _positions(token_spans, lambda s, i: (s["start"] <= offset) & (offset < s["end"]))
    return F.coalesce(F.get(hits, F.lit(0)), F.lit(-1))


def n_best(logits: DataFrame, question: str, window: str, k: int, max_len: int, n: int) -> DataFrame:
    """n best answers per question from rows (question, window, pos, start_logit, end_logit).

    At most k starts meet k ends per window, so the join is bounded by k * k rows.
    """
    by = [question, window]
    starts = top_k(logits, by, [F.desc("start_logit"), F.asc("pos")], k).select(
        *by, F.col("pos").alias("start"), "start_logit")
    ends = top_k(logits, by, [F.desc("end_logit"), F.asc("pos")], k).select(
        *by, F.col("pos").alias("end"), "end_logit")
    spans = (starts.join(ends, by)
             .where((F.col("end") >= F.col("start")) & (F.col("end") - F.col("start") + 1 <= max_len))
             .withColumn("score", F.col("start_logit") + F.col("end_logit")))
    best = top_k(spans, [question], [F.desc("score"), F.asc(window), F.asc("start"), F.asc("end")], n)
    top = best.groupBy(question).agg(F.max("score").alias("_top"), F.collect_list("score").alias("_all"))  # n rows
    out = best.join(top, question)
    total = F.aggregate("_all", F.lit(0.0), lambda a, s: a + F.exp(s - F.col("_top")))
    return out.withColumn("probability", F.exp(F.col("score") - F.col("_top")) / total).drop("_top", "_all")


def with_null_answers(best: DataFrame, null_scores: DataFrame, question: str, threshold: float) -> DataFrame:
    """Best answer per question, or none when the null score beats it by more than the threshold."""
    first = best.where(F.col("rank") == 1)
    diff = F.col("null_score") - F.col("score")
    return (first.join(null_scores, question).withColumn("score_diff", diff)
            .withColumn("is_null", diff > threshold))


def top_positions(scores: Column, k: int, largest: bool = True) -> Column:
    """array<struct<pos,score>> of the k best entries, ties by position."""
    keyed = F.transform(scores, lambda s, i: F.struct(
        (-s if largest else s).alias("key"), i.alias("pos"), s.alias("score")))
    return F.transform(F.slice(F.array_sort(keyed), 1, k), lambda x: F.struct(
        x["pos"].alias("pos"), x["score"].alias("score")))


def best_paths(levels: list[Column], k: int) -> Column:
    """k best index paths over per-level candidate arrays, by summed score (at most k kept per level)."""
    paths = F.transform(levels[0], lambda c: F.struct(c["score"].alias("score"), F.array(c["pos"]).alias("path")))
    for level in levels[1:]:
        grown = F.flatten(F.transform(paths, lambda p: F.transform(level, lambda c: F.struct(
            (p["score"] + c["score"]).alias("score"), F.concat(p["path"], F.array(c["pos"])).alias("path")))))
        ordered = F.array_sort(F.transform(grown, lambda p: F.struct(
            (-p["score"]).alias("neg"), p["path"].alias("path"), p["score"].alias("score"))))
        paths = F.transform(F.slice(ordered, 1, k), lambda p: F.struct(
            p["score"].alias("score"), p["path"].alias("path")))
    return paths


def max_context(spans: Column, pos: Column) -> Column:
    """Index of the window that shows a position with most context: min(left, right) + 0.01 * length."""
    scored = F.transform(spans, lambda s, i: F.struct(
        (F.least(pos - s["start"], s["start"] + s["length"] - 1 - pos) + 0.01 * s["length"]).alias("score"),
        (-i).alias("neg"), (s["start"] <= pos).alias("lo"), (pos < s["start"] + s["length"]).alias("hi")))
    return -F.array_max(F.filter(scored, lambda s: s["lo"] & s["hi"]))["neg"]


def rebase(chunks: DataFrame, doc: str, chunk: str, length: str, items: DataFrame) -> DataFrame:
    """Shift item start and end by the length of all earlier chunks of the same document."""
    base = running(chunks.select(doc, chunk, length), [chunk], {"base": ("sum", length)}, by=[doc], inclusive=False)
    return (items.join(base.select(doc, chunk, "base"), [doc, chunk])
            .withColumn("start", F.col("start") + F.col("base"))
            .withColumn("end", F.col("end") + F.col("base")).drop("base"))


def softmax(scores: Column) -> Column:
    shifted = let(scores, lambda a: let(F.array_max(a), lambda top: F.transform(a, lambda s: F.exp(s - top))))
    total = lambda e: F.aggregate(e, F.lit(0.0), lambda a, y: a + y)
    return let(shifted, lambda e: let(total(e), lambda t: F.transform(e, lambda x: x / t)))


def argmax(scores: Column) -> Column:
    return F.array_position(scores, F.array_max(scores)) - 1


def sigmoid_labels(scores: Column, threshold: float) -> Column:
    probs = F.transform(scores, lambda s: 1 / (1 + F.exp(-s)))
    return F.transform(_positions(probs, lambda p, i: p > threshold), lambda i: i)


def vote(df: DataFrame, doc: str, option: str, prob: str) -> DataFrame:
    """Option with most chunk votes, then the larger probability sum; its mean probability."""
    tally = df.groupBy(doc, option).agg(F.count("*").alias("n"), F.sum(prob).alias("p"))
    best = tally.groupBy(doc).agg(F.max_by(F.struct(option, "n", "p"), F.struct("n", "p", option)).alias("b"))
    return best.select(doc, F.col("b")[option].alias(option), F.col("b.n").alias("votes"),
                       (F.col("b.p") / F.col("b.n")).alias("probability"))


def best_candidate(df: DataFrame, prompt: str, idx: str, score: str, unfinished: Column, repeats: Column) -> DataFrame:
    """Highest scored candidate per prompt; unfinished or repeating ones lose 1000 points."""
    adjusted = F.col(score) - F.when(unfinished | repeats, 1000.0).otherwise(0.0)
    best = df.withColumn("_a", adjusted).groupBy(prompt).agg(
        F.max_by(F.struct(idx, "_a"), F.struct("_a", -F.col(idx))).alias("b"))
    return best.select(prompt, F.col("b")[idx].alias(idx), F.col("b._a").alias(score))


def pool(df: DataFrame, doc: str, order: str, vector: str, how: str, dims: int) -> DataFrame:
    """Mean, max, first or mean/sqrt(n) pooling of token vectors, one aggregate per dimension."""
    v = lambda i: F.col(vector)[i].cast("double")
    each = {
        "mean": lambda i: F.avg(v(i)), "max": lambda i: F.max(v(i)),
        "first": lambda i: F.min_by(v(i), order),
        "mean_sqrt_len": lambda i: F.sum(v(i)) / F.sqrt(F.count(v(i))),
    }[how]
    return df.groupBy(doc).agg(F.array(*[each(i) for i in range(dims)]).alias("pooled"))


def label_scores(df: DataFrame, row: str, label: str, word: str, mask: str, score: str,
                 token: str = "mean", words: str = "mean", masks: str = "mean", order: str = "token") -> DataFrame:
    """Token scores -> word -> mask position -> label, then softmax and log per row.

    `first` takes the score of the smallest `order` (a token position), for the token step only.
    """
    agg = {"mean": F.avg, "max": F.max, "sum": F.sum, "product": F.product, "first": lambda c: F.min_by(c, order)}
    per_word = df.groupBy(row, label, mask, word).agg(agg[token](score).alias("s"))
    per_mask = per_word.groupBy(row, label, mask).agg(agg[words]("s").alias("s"))
    per_label = per_mask.groupBy(row, label).agg(agg[masks]("s").alias("score"))
    top = per_label.groupBy(row).agg(F.max("score").alias("_top"))
    shifted = per_label.join(top, row).withColumn("_over", F.col("score") - F.col("_top"))
    norm = shifted.groupBy(row).agg(F.sum(F.exp("_over")).alias("_sum"))
    return (shifted.join(norm, row).withColumn("probability", F.exp("_over") / F.col("_sum"))
            .withColumn("log_probability", F.col("_over") - F.ln("_sum")).drop("_top", "_over", "_sum"))

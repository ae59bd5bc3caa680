"""Token-corpus operators: vocabulary, TF-IDF, offsets, sample assembly, blending, packing, masking."""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.fold import let, scan
from veilframe.operators.ordering import row_index, running
from veilframe.operators.rows import seeded, top_k
from veilframe.session import materialise, small


def build_vocab(tokens: DataFrame, token: str, min_freq: int = 1, max_size: int | None = None,
                special: list[str] = ()) -> DataFrame:
    """(token, freq, id): special tokens first, then by frequency descending and token.

    max_size counts ordinary tokens only. The order is a range partition over distinct tokens.
    """
    counts = (tokens.where(~F.col(token).isin(list(special))) if special else tokens) \
        .groupBy(F.col(token).alias("token")).agg(F.count("*").alias("freq")).where(F.col("freq") >= min_freq)
    ranked = row_index(counts, [F.desc("freq"), F.asc("token")], "id")
    if max_size is not None:
        ranked = ranked.where(F.col("id") < max_size)
    ranked = ranked.select("token", "freq", (F.col("id") + len(special)).alias("id"))
    if not special:
        return ranked
    head = [(t, 0, i) for i, t in enumerate(special)]
    return tokens.sparkSession.createDataFrame(head, "token string, freq long, id long").unionByName(ranked)


def tf_idf(tokens: DataFrame, doc: str, token: str) -> DataFrame:
    """(doc, token, tf, idf, tfidf): tf over the document's tokens, idf = ln(N / df).

    The counts are written once, with their document's total. Rows that are partitioned by doc before are not moved again for
    that; the frequencies come to them by broadcast when a count proves them few.
    """
    counts = tokens.groupBy(doc, token).agg(F.count("*").alias("n"))
    counts = materialise(counts.withColumn("total", F.sum("n").over(Window.partitionBy(doc))), "counts")
    df = materialise(counts.groupBy(token).agg(F.count("*").alias("df")), "frequencies")
    n_docs = counts.groupBy(doc).agg(F.count("*")).agg(F.count("*").alias("docs"))
    return (counts.where(F.col(doc).isNotNull()).join(small(df), token).join(F.broadcast(n_docs))  # one row
            .select(doc, token, (F.col("n") / F.col("total")).alias("tf"),
                    F.ln(F.col("docs") / F.col("df")).alias("idf"))
            .withColumn("tfidf", F.col("tf") * F.col("idf")))


# token corpus ------------------------------------------------------------------------------

def corpus_totals(corpus: DataFrame, tokens: str = "tokens", doc: str = "doc_id") -> DataFrame:
    size = F.size(tokens)
    return corpus.agg(F.countDistinct(doc).alias("docs"), F.count("*").alias("items"),
                      F.sum(size).alias("tokens"), F.avg(size).alias("avg_tokens"))


def epochs_needed(samples: int, seq_len: int, tokens_per_epoch: int) -> int:
    """Smallest E with floor((E*T - 1) / L) >= samples."""
    return -(-(samples * seq_len + 1) // tokens_per_epoch)


def token_offsets(corpus: DataFrame, order: list[str], size: str) -> DataFrame:
    """First global token position of every document."""
    return running(corpus, order, {"start": ("sum", size)}, inclusive=False)


def assemble_samples(corpus: DataFrame, order: list[str], doc: str, tokens: str, seq_len: int) -> DataFrame:
    """Samples of seq_len + 1 tokens across document boundaries; neighbours share one token.

    `order` must tell all rows apart. Every document computes the samples it reaches, so there is no range join: it
    explodes into its pieces and a sample collects at most seq_len + 1 tokens.
    """
    sized = corpus.withColumn("_n", F.size(tokens).cast("long")).where("_n > 0")
    total = sized.agg(F.sum("_n")).first()[0] or 0
    n_samples = max((total - 1) // seq_len, 0)
    # the prefix sum runs on the order and the sizes; the tokens themselves meet only their offset
    light = sized.select(*order, "_n")
    starts = token_offsets(light, order, "_n").drop("_n")
    same = [sized[c].eqNullSafe(starts[c]) for c in order]
    placed = sized.join(starts, same).select(sized["*"], "start")
    lo = F.greatest(F.ceil((F.col("start") - seq_len) / seq_len), F.lit(0)).cast("long")
    hi = F.least(F.floor((F.col("start") + F.col("_n") - 1) / seq_len), F.lit(n_samples - 1)).cast("long")
    pieces = (placed.withColumn("_lo", lo).withColumn("_hi", hi).where("_lo <= _hi")
              .select(doc, tokens, "start", F.explode(F.sequence("_lo", "_hi")).alias("sample")))
    first = F.greatest(F.col("sample") * seq_len - F.col("start"), F.lit(0))
    last = F.least((F.col("sample") + 1) * seq_len - F.col("start"), F.size(tokens).cast("long") - 1)
    cut = pieces.select("sample", "start", doc, F.slice(
        F.col(tokens), (first + 1).cast("int"), (last - first + 1).cast("int")).alias("part"))
    g = cut.groupBy("sample").agg(F.sort_array(F.collect_list(F.struct("start", doc, "part"))).alias("_g"))
    return g.select("sample", F.flatten(F.col("_g")["part"]).alias("tokens"), F.col("_g")[doc].alias("docs"))


def epoch_order(docs: DataFrame, doc: str, epochs: int, seed: int, separate_last: bool) -> DataFrame:
    """Document order over several epochs, shuffled; the last epoch may be shuffled apart."""
    rows = docs.select(doc).withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    segment = (F.col("epoch") == epochs - 1) if separate_last and epochs > 1 else F.lit(False)
    rows = rows.withColumn("segment", segment.cast("int"))
    return row_index(rows, [F.col("segment"), seeded(seed, F.col("epoch"), F.col(doc)), F.col(doc), F.col("epoch")],
                     "position")


def separate_last_epoch(epochs: int, tokens_per_epoch: int, seq_len: int, samples: int) -> bool:
    """True when the last of several epochs supplies less than 80 % of a full epoch's samples."""
    filled = lambda e: (e * tokens_per_epoch - 1) // seq_len  # noqa: E731  whole samples in e epochs
    return epochs > 1 and samples < filled(epochs - 1) + filled(1) * 4 // 5


def blend(sources: dict[str, DataFrame], weights: dict[str, float], size: int, key: str) -> DataFrame:
    """Weighted interleave of datasets to `size` rows; row k of a source stands at (k + 0.5) / weight.

    Each source is asked for ceil(size * w * 1.005) + 20 rows, so rounding cannot starve the blend. A source with fewer
    rows is read again from its start, as often as needed; one without rows is an error.
    """
    total = sum(weights.values())
    out = None
    for name, df in sources.items():
        w = weights[name] / total
        want = int(-(-size * w * 1.005 // 1)) + 20
        have = df.count()
        if not have:
            raise ValueError(f"blend source {name} has no rows")
        rows = row_index(df.select(key), [key], "k").where(F.col("k") < want)
        if have < want:
            again = F.explode(F.sequence(F.lit(0), F.lit(-(-want // have) - 1)))
            rows = rows.select(key, "k", again.alias("_epoch")).select(key, (F.col("k") + F.col("_epoch") * have).alias("k")).where(F.col("k") < want)
        rows = rows.withColumn("source", F.lit(name)).withColumn("at", (F.col("k") + 0.5) / F.lit(w))
        out = rows if out is None else out.unionByName(rows)
    placed = row_index(out, ["at", "source", "k"], "position")
    return placed.where(F.col("position") < size).drop("at")


# batching and packing ----------------------------------------------------------------------

def budget_batches(lines: DataFrame, file: str, order: str, size: str, max_rows: int, max_size: int,
                   span: int = 100_000) -> DataFrame:
    """Batches limited by rows and total size; a single over-size row is an error. Returns (file, order, batch).

    `order` numbers a file's rows without gaps. Filling is sequential, but a batch spans at most max_rows rows: every span
    of consecutive rows says, for each of its first max_rows rows as the start of a batch, where in the next span
    the batches come out and how many there are. Neighbouring tables are put together two by two in rounds, the entries are handed down
    the same way, then every span fills in its batches; no task holds more than two tables. Batches cross spans, so the span
    does not show in the result.
    """
    span = max(span, max_rows)

    def ahead(sizes: np.ndarray, own: int) -> np.ndarray:
        """For each own row, the row after the batch that starts at it."""
        if (sizes > max_size).any():
            raise ValueError("a single row exceeds the batch size")
        total = np.concatenate([[0], np.cumsum(sizes)])
        fits = np.searchsorted(total, total[:own] + max_size, "right") - 1
        return np.minimum(fits, np.arange(own) + max_rows)

    def table(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        own = int((~pdf["halo"]).sum())
        after = ahead(pdf[size].to_numpy(np.int64), own)
        out, n = np.zeros(own, np.int64), np.zeros(own, np.int64)
        for i in range(own - 1, -1, -1):
            inside = after[i] < own
            out[i], n[i] = (out[after[i]], n[after[i]] + 1) if inside else (after[i] - own, 1)
        return pd.DataFrame({file: pdf[file].iloc[:1], "span": pdf["span"].iloc[:1], "out": [out[:max_rows]], "n": [n[:max_rows]]})

    def through(t, entry: int, batch: int) -> tuple[int, int]:
        """Where a batch that starts at `entry` comes out behind a span, and the number it has there."""
        return (int(t.out[entry]), batch + int(t.n[entry])) if entry < len(t.out) else (entry - len(t.out), batch)

    def compose(pdf: pd.DataFrame) -> pd.DataFrame:
        """The table of two neighbouring spans as one."""
        first, *second = pdf.sort_values("span").itertuples(index=False)
        ends = [through(second[0], int(o), int(n)) if second else (int(o), int(n)) for o, n in zip(first.out, first.n)]
        return pd.DataFrame({file: [getattr(first, file)], "span": [first.span // 2], "out": [[o for o, _ in ends]], "n": [[n for _, n in ends]]})

    def split(pdf: pd.DataFrame) -> pd.DataFrame:
        """Entry and first batch of two neighbouring spans, from those of the two as one."""
        rows, entry, batch = [], int(pdf["entry"].iloc[0]), int(pdf["first"].iloc[0])
        for t in pdf.sort_values("span").itertuples(index=False):
            rows.append((getattr(t, file), t.span, entry, batch))
            entry, batch = through(t, entry, batch)
        return pd.DataFrame(rows, columns=[file, "span", "entry", "first"])

    def fill(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        own = pdf[~pdf["halo"]]
        after = ahead(pdf[size].to_numpy(np.int64), len(own))
        starts, at = np.zeros(len(own), np.int64), int(own["entry"].iloc[0])
        while at < len(own):
            starts[at] = 1
            at = int(after[at])
        return own.assign(batch=int(own["first"].iloc[0]) - 1 + np.cumsum(starts))[[file, order, "batch"]]

    at = F.floor((F.col(order) - F.col("_low")) / span)
    light = lines.select(F.col(file).cast("string").alias(file), F.col(order).cast("long").alias(order), F.col(size).cast("long").alias(size))
    low = light.groupBy(file).agg(F.min(order).alias("_low"))
    light = light.join(low, file).withColumn("_span", at).withColumn("_in", F.col(order) - F.col("_low") - F.col("_span") * span)
    # the first max_rows rows of a span also follow the span before it
    halo = F.when((F.col("_span") > 0) & (F.col("_in") < max_rows), F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    rows = light.select(file, order, size, "_span", F.explode(halo).alias("halo")).select(
        file, order, size, "halo", (F.col("_span") - F.col("halo").cast("int")).alias("span"))
    schema = f"{file} string, span long, out array<long>, n array<long>"
    levels = [materialise(rows.groupBy(file, "span").applyInPandas(table, schema), "spans")]
    while not levels[-1].where("span > 0").isEmpty():  # half as many spans per round
        pairs = levels[-1].withColumn("_pair", F.floor(F.col("span") / 2))
        levels.append(materialise(pairs.groupBy(file, "_pair").applyInPandas(compose, schema), "spans"))
    entries = levels[-1].select(file, "span", F.lit(0).cast("long").alias("entry"), F.lit(0).cast("long").alias("first"))
    for level in reversed(levels[:-1]):
        parts = level.withColumn("_pair", F.floor(F.col("span") / 2)).join(entries.withColumnRenamed("span", "_pair"), [file, "_pair"])
        entries = materialise(parts.groupBy(file, "_pair").applyInPandas(split, f"{file} string, span long, entry long, first long"), "entries")
    return rows.join(entries, [file, "span"]).groupBy(file, "span").applyInPandas(fill, f"{file} string, {order} long, batch long")


def greedy_packs(rows: DataFrame, idx: str, length: str, max_len: int, batch: str) -> DataFrame:
    """Each row goes to the pack with most room, else opens a new one, among the rows of a batch.

    Packing is sequential by rule, so the caller names the batches that are packed together (`batch`, a column); a
    batch is one task's work on two integers per row. Rows longer than max_len get a null pack. Returns (idx, batch, pack).
    """
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(idx)
        heap, packs, opened = [(-max_len, 0)], [], 0
        for n in pdf[length]:
            if n > max_len:
                packs.append(None)
                continue
            if n > -heap[0][0]:
                opened += 1
                heapq.heappush(heap, (-max_len, opened))
            room, p = heapq.heappop(heap)
            packs.append(p)
            heapq.heappush(heap, (room + n, p))
        return pdf.assign(pack=pd.array(packs, dtype="Int64"))[[idx, batch, "pack"]]

    light = rows.select(F.col(idx).cast("long").alias(idx), F.col(length).cast("long").alias(length), F.col(batch).cast("string").alias(batch))
    return light.groupBy(batch).applyInPandas(pack, f"{idx} long, {batch} string, pack long")


def assemble_packs(rows: DataFrame, pack: list[str], idx: str, ids: str, labels: str) -> DataFrame:
    """Concatenated ids and labels per pack, with segment lengths for the block-diagonal mask.

    A pack holds at most max_len tokens, so the group is bounded by construction.
    """
    g = rows.groupBy(*pack).agg(F.sort_array(F.collect_list(F.struct(idx, ids, labels))).alias("_g"))
    lengths = F.transform(F.col("_g")[ids], lambda x: F.size(x))
    starts = F.transform(lengths, lambda n, i: F.aggregate(
        F.slice(lengths, F.lit(1), i), F.lit(0), lambda a, x: a + x))
    return g.select(*pack, F.flatten(F.col("_g")[ids]).alias("input_ids"),
                    F.flatten(F.col("_g")[labels]).alias("labels"),
                    lengths.alias("segment_lengths"), starts.alias("segment_starts"))


def balanced_partitions(rows: DataFrame, idx: str, length: str, k: int) -> DataFrame:
    """Length-balanced parts of equal size (within one): serpentine deal in order of length."""
    ranked = row_index(rows, [F.desc(length), F.asc(idx)], "_rank")
    turn, at = F.floor(F.col("_rank") / k), F.pmod("_rank", F.lit(k))
    return ranked.withColumn("part", F.when(turn % 2 == 0, at).otherwise(k - 1 - at)).drop("_rank")


def differenced(lengths: list[int], k: int, equal: bool) -> list[int]:
    """Part of each item by largest differencing: partial divisions into k sums, of which the two most uneven are put together
    large on small, until one is left.

    equal starts from k items of neighbouring size at a time, so all parts get as many.
    """
    order = sorted(range(len(lengths)), key=lambda i: (lengths[i], i))
    if equal and len(order) % k:
        raise ValueError(f"{len(order)} items do not make {k} parts of equal size")
    start = [order[i:i + k] for i in range(0, len(order), k)] if equal else [[i] for i in order]
    # a division: (sum, number of items, tree of items) of each part, largest first
    heap = []
    for turn, items in enumerate(start):
        parts = sorted([(lengths[i], 1, i) for i in items] + [(0, 0, None)] * (k - len(items)), key=lambda x: x[:2], reverse=True)
        heap.append((parts[-1][0] - parts[0][0], turn, parts))
    heapq.heapify(heap)
    turn = len(heap)
    while len(heap) > 1:
        one, other = heapq.heappop(heap)[2], heapq.heappop(heap)[2]
        parts = sorted(((a + c, n + m, (x, y)) for (a, n, x), (c, m, y) in zip(one, reversed(other))), key=lambda x: x[:2], reverse=True)
        heapq.heappush(heap, (parts[-1][0] - parts[0][0], turn, parts))
        turn += 1
    out = [0] * len(lengths)
    for part, (_, _, tree) in enumerate(heap[0][2] if heap else []):
        stack = [tree]
        while stack:
            x = stack.pop()
            if isinstance(x, tuple):
                stack += x
            elif x is not None:
                out[x] = part
    return out


def differenced_partitions(rows: DataFrame, step: list[str], idx: str, length: str, k: int, equal: bool = True) -> DataFrame:
    """Length-balanced parts of every step's items, in a column `part`: by largest differencing, or the serpentine deal where that is
    more even, so the spread of the sums is never above the deal's.

    A step is what is trained on at a time, so it fits a task. equal needs steps of a multiple of k items; else parts differ in size and
    none is empty if a step has k items.
    """
    schema = rows.withColumn("part", F.lit(0)).schema

    def divide(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(idx)
        lengths = group[length].astype("int64").tolist()
        parts = differenced(lengths, k, equal)
        deal = [0] * len(lengths)
        for rank, i in enumerate(sorted(range(len(lengths)), key=lambda i: (-lengths[i], i))):
            turn, at = divmod(rank, k)
            deal[i] = at if turn % 2 == 0 else k - 1 - at

        def spread(of):
            sums = [0] * k
            for p, n in zip(of, lengths):
                sums[p] += n
            return max(sums) - min(sums)
        filled = len(set(parts)) == min(k, len(lengths))
        return group.assign(part=parts if filled and spread(parts) <= spread(deal) else deal)
    return rows.groupBy(*step).applyInPandas(divide, schema)


def group_negatives(rows: DataFrame, key: str, negatives: str, group: int, seed: int) -> DataFrame:
    """group - 1 negatives per row: short pools are taken whole as often as they fit, the rest drawn."""
    want, n = group - 1, F.size(negatives)
    drawn = F.array_sort(F.transform(F.col(negatives), lambda x, i: F.struct(
        seeded(seed, F.col(key), i).alias("h"), x.alias("x"))))["x"]
    whole = F.floor(F.lit(want) / F.greatest(n, F.lit(1))).cast("int")
    rest = F.slice(drawn, F.lit(1), F.lit(want) - whole * n)
    filled = F.concat(F.flatten(F.array_repeat(F.col(negatives), whole)), rest)
    mixed = F.array_sort(F.transform(filled, lambda x, i: F.struct(
        seeded(seed + 1, F.col(key), i).alias("h"), x.alias("x"))))["x"]
    return rows.withColumn("selected", F.when(n == 0, F.col(negatives))
                           .when(n >= want, F.slice(drawn, 1, want)).otherwise(mixed))


# masking -----------------------------------------------------------------------------------

def unit(seed: int, *cols: Column) -> Column:
    """Uniform number in [0, 1) from the md5 of the key; the same on every retry and engine."""
    return F.conv(F.substring(seeded(seed, *cols), 1, 8), 16, 10).cast("double") / 2.0**32


def mask_tokens(ids: Column, key: Column, specials: list[int], p: float, mask_id: int, vocab: int,
                seed: int) -> Column:
    """array<struct<input,label>>: selected tokens become mask (80 %), random (10 %) or stay (10 %).

    Labels are -100 where nothing was selected.
    """
    def marked(x, i, chosen, how):
        random_id = F.floor(unit(seed + 2, key, i) * vocab).cast("int")
        new = F.when(~chosen, x).when(how < 0.8, F.lit(mask_id)).when(how < 0.9, random_id).otherwise(x)
        return F.struct(new.alias("input"), F.when(chosen, x).otherwise(F.lit(-100)).alias("label"))

    def one(x, i):
        # the draws once a token, the second for selected ones only
        return let(~x.isin(specials) & (unit(seed, key, i) < p), lambda chosen: let(
            F.when(~chosen, F.lit(1.0)).otherwise(unit(seed + 1, key, i)), lambda how: marked(x, i, chosen, how)))
    return F.transform(ids, one)


def whole_word_mask(pieces: Column, key: Column, p: float, seed: int, max_predictions: int = 512) -> Column:
    """Masked piece positions; '##' pieces join the word before them, words fill up to max(1, round(n*p)).

    Words come in hash order; one that would exceed the quota is passed over.
    """
    return let(pieces, lambda w: _pick_words(w, key, p, seed, max_predictions))


def _pick_words(pieces: Column, key: Column, p: float, seed: int, max_predictions: int) -> Column:
    n = F.size(pieces)
    quota = F.least(F.lit(max_predictions), F.greatest(F.lit(1), F.round(n * p).cast("int")))
    special = lambda x: x.isin("[CLS]", "[SEP]")
    # a word begins at a piece without '##', or at the first piece; special tokens only end words
    marks = F.filter(F.transform(pieces, lambda x, i: F.when(
        special(x) | ~x.startswith("##") | (i == 0), F.struct(i.alias("at"), (~special(x)).alias("word")))),
        lambda m: m.isNotNull())
    spans = let(marks, lambda m: F.filter(F.zip_with(
        m, F.concat(F.transform(F.slice(m, F.lit(2), F.size(m)), lambda x: x["at"]), F.array(n)),
        lambda a, end: F.struct(a["at"].alias("at"), end.alias("end"), a["word"].alias("word"))),
        lambda s: s["word"]))
    shuffled = F.sort_array(F.transform(spans, lambda s: F.struct(
        seeded(seed, key, s["at"]).alias("h"), s["at"].alias("at"), s["end"].alias("end"))))
    out_type = "array<struct<at:int,end:int>>"
    zero = F.struct(F.lit(0).alias("used"), F.array().cast(out_type).alias("out"))

    def step(acc, s):
        size = s["end"] - s["at"]
        fits = acc["used"] + size <= quota
        word = F.array(F.struct(s["at"].alias("at"), s["end"].alias("end")))
        return F.struct(F.when(fits, acc["used"] + size).otherwise(acc["used"]).alias("used"),
                        F.when(fits, F.concat(acc["out"], word)).otherwise(acc["out"]).alias("out"))

    words = scan(shuffled, zero, ["used"], out_type, step)
    return F.flatten(F.transform(words, lambda w: F.sequence(w["at"], w["end"] - 1)))

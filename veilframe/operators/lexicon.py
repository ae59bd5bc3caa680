"""Lexicon matching and sub-words for lexicons of any size: nothing of the lexicon reaches the driver or a task whole.

Substrings of a text are hashed at every place, one pass per phrase length, and looked up in a Bloom filter of fixed most size; what
passes meets the phrases in an equi join, so matches are exact. Sub-words descend a trie level by level, each level a join.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.session import materialise

MOST_BITS = 27  # of the filter, as a power of two: 16 MB; more phrases let more substrings pass, none is lost
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_MIX = np.uint64(0xBF58476D1CE4E5B9)
FOUND = "array<struct<start:int,end:int>>"


class Filter(NamedTuple):
    """Bits set for the phrases' hashes, and the lengths that occur; of bounded size."""
    words: np.ndarray
    bits: int
    lengths: list[int]


def code_points(text: str) -> np.ndarray:
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    c = (c + np.uint64(1)) * _MIX
    return c ^ (c >> np.uint64(29))


def prefix_sums(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of c[i] * base^i up to every place, and base^-i, modulo 2^64."""
    up, back = np.full(len(c), _BASE), np.full(len(c) + 1, _BACK)
    if len(c):
        up[0] = 1
    back[0] = 1
    total = np.zeros(len(c) + 1, np.uint64)
    np.cumsum(c * np.multiply.accumulate(up), out=total[1:])
    return total, np.multiply.accumulate(back)


def substring_hashes(sums: np.ndarray, back: np.ndarray, start: np.ndarray | slice, end: np.ndarray | slice, n) -> np.ndarray:
    h = (sums[end] - sums[start]) * back[start] + np.atleast_1d(n).astype(np.uint64) * _BASE
    h ^= h >> np.uint64(32)
    h *= _MIX
    return h ^ (h >> np.uint64(29))


def places(h: np.ndarray, bits: int) -> list[np.ndarray]:
    """Three bit numbers of a hash."""
    mask = np.uint64((1 << bits) - 1)
    return [h & mask, h >> np.uint64(64 - bits), (h * _BASE) >> np.uint64(64 - bits)]


def _distinct(lexicon: DataFrame, *more: str) -> DataFrame:
    return lexicon.filter("phrase <> ''").select("phrase", *more).distinct()


def build_filter(phrases: DataFrame) -> Filter:
    """The filter of a table of distinct phrases, built by one job; at most 2^MOST_BITS bits and a row per length reach the driver."""
    sizes = phrases.groupBy(F.length("phrase").alias("n")).agg(F.count(F.lit(1)).alias("k")).collect()
    bits = min(MOST_BITS, max(10, (12 * sum(r.k for r in sizes)).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("phrase").to_pylist()
            if not texts:
                continue
            ends = np.cumsum([len(t) for t in texts])
            starts = np.r_[0, ends[:-1]]
            sums, back = prefix_sums(code_points("".join(texts)))
            at = np.concatenate(places(substring_hashes(sums, back, starts, ends, ends - starts), bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["w", "b"])
    rows = phrases.select("phrase").mapInArrow(run, "w long, b long").groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    words = np.zeros(max(1, 1 << bits >> 6), np.int64)
    words[rows.column("w").to_numpy()] = rows.column("b").to_numpy()
    return Filter(words.view(np.uint64), bits, sorted(r.n for r in sizes))


def passing(texts: list[str], f: Filter) -> tuple[np.ndarray, np.ndarray, np.ndarray, str]:
    """(starts, ends, numbers of the text) of the substrings that the filter lets pass, as places in the texts joined, and these; in
    time linear in the texts for each phrase length. No substring crosses texts."""
    joined = "".join(texts)
    sizes = np.array([len(t) for t in texts], np.int64)
    owner = np.repeat(np.arange(len(texts)), sizes)
    until = np.repeat(np.cumsum(sizes), sizes)
    sums, back = prefix_sums(code_points(joined))
    starts, ends = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for n in f.lengths:
        size = len(sums) - n
        if size <= 0:
            break
        h = substring_hashes(sums, back, slice(0, size), slice(n, n + size), n)
        at = np.flatnonzero(np.arange(n, n + size) <= until[:size])
        for p in places(h, f.bits):
            here = p[at]
            at = at[(f.words[(here >> np.uint64(6)).astype(np.int64)] >> (here & np.uint64(63))) & np.uint64(1) == 1]
        starts.append(at)
        ends.append(at + n)
    a = np.concatenate(starts)
    return a, np.concatenate(ends), owner[a], joined


def candidates(docs: DataFrame, key: str, text: str, f: Filter) -> DataFrame:
    """(key, start, end, phrase): the substrings of each text that may be phrases."""
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text")).filter("_text IS NOT NULL")
    schema = rows.select(F.col("_key").alias(key), F.lit(0).alias("start"), F.lit(0).alias("end"), F.col("_text").alias("phrase")).schema
    shared = docs.sparkSession.sparkContext.broadcast(f)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column("_key"), batch.column("_text").to_pylist()
            lo = 0
            while lo < len(texts):  # about a million characters at a time
                hi, held = lo, 0
                while hi < len(texts) and (hi == lo or held + len(texts[hi]) <= 1 << 20):
                    held += len(texts[hi])
                    hi += 1
                a, b, of, joined = passing(texts[lo:hi], shared.value)
                begin = np.cumsum([0, *[len(t) for t in texts[lo:hi]]])[of]
                for i in range(0, len(a), 1 << 17):
                    s, e, o = a[i:i + (1 << 17)], b[i:i + (1 << 17)], of[i:i + (1 << 17)]
                    first = begin[i:i + (1 << 17)]
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(o + lo)), pa.array(s - first, pa.int32()), pa.array(e - first, pa.int32()),
                         pa.array([joined[x:y] for x, y in zip(s.tolist(), e.tolist())], pa.string())], names=schema.names)
                lo = hi
    return rows.mapInArrow(run, schema)


def lexicon_join(docs: DataFrame, key: str, text: str, lexicon: DataFrame, *more: str) -> DataFrame:
    """(key, start, end, more columns of the lexicon) of all phrase occurrences, for lexicons of any size.

    A place meets each of its phrases once; filter with keep_forward. A phrase that stands in most texts is one row of the lexicon's
    side, so a hot phrase splits on the texts' side.
    """
    phrases = _distinct(lexicon, *more)
    found = candidates(docs, key, text, build_filter(phrases.select("phrase").distinct()))
    return found.join(phrases, "phrase").select(key, "start", "end", *more).distinct()


def keep_forward(matches: DataFrame, key: str) -> DataFrame:
    """Longest match per start, kept when it ends behind all earlier ones."""
    from veilframe.operators.ordering import running
    longest = matches.groupBy(key, "start").agg(F.max("end").alias("end"))
    seen = running(longest, ["start"], {"_reach": ("max", "end")}, by=[key], inclusive=False)
    return seen.where(F.col("_reach").isNull() | (F.col("end") > F.col("_reach"))).drop("_reach")


def forward(found: Column, extra: str = "") -> Column:
    """The matches of one text as keep_forward() keeps them, in order; structs of start, end and the fields of `extra` (DDL)."""
    # by start, and of one start the longest first: a match stays if it ends behind all before it
    ordered = F.transform(F.array_sort(F.transform(found, lambda m: F.struct(m["start"].alias("start"), (-m["end"]).alias("back"), m.alias("m")))), lambda x: x["m"])
    kind = f"array<struct<start:int,end:int{extra}>>"
    return F.aggregate(ordered, F.struct(F.lit(0).alias("reach"), F.array().cast(kind).alias("kept")), lambda acc, m: F.when(
        m["end"] > acc["reach"], F.struct(m["end"].alias("reach"), F.array_append(acc["kept"], m).alias("kept"))).otherwise(acc), lambda acc: acc["kept"])


def lexicon_matches(docs: DataFrame, text: str, lexicon: DataFrame, out: str = "matches", *more: str) -> DataFrame:
    """Add the lexicon phrases found in each text as array<struct<start, end>> (with more columns of the lexicon, if named).

    Texts are written once, with a number per row, and meet their matches on it; only texts that hold a candidate have any.
    Null texts have none.
    """
    rows = materialise(docs.withColumn("_row", F.monotonically_increasing_id()), "texts")
    found = lexicon_join(rows, "_row", text, lexicon, *more)
    extra = "".join(f",{c}:{lexicon.schema[c].dataType.simpleString()}" for c in more)
    lists = found.groupBy("_row").agg(F.collect_list(F.struct("start", "end", *more)).alias(out)).withColumn(out, forward(F.col(out), extra))
    none = F.array().cast(f"array<struct<start:int,end:int{extra}>>")
    return rows.join(lists, "_row", "left").withColumn(out, F.coalesce(out, none)).drop("_row")


def lexicon_detector(lexicon: dict[str, str] | DataFrame):
    """Entity detector for redact(): a table (phrase, type), or a small dict of them."""
    def detect(df: DataFrame, text: str) -> DataFrame:
        table = df.sparkSession.createDataFrame(list(lexicon.items()), "phrase string, type string") if isinstance(lexicon, dict) else lexicon
        one = table.groupBy("phrase").agg(F.min("type").alias("type"))
        found = lexicon_matches(df, text, one, "_m", "type")
        return found.withColumn("entities", F.transform("_m", lambda m: F.struct(m["type"].alias("type"), m["start"].alias("start"), m["end"].alias("end")))).drop("_m")
    return detect


# sub-words ---------------------------------------------------------------------------------

def sub_words(counts: DataFrame, vocab: DataFrame, word: str = "word", unk: str = "[UNK]", max_chars: int = 100) -> DataFrame:
    """Greedy longest-match pieces of distinct words against a vocabulary table (token), as a column `pieces`.

    Tokens that begin with ## go on inside a word. The vocabulary is a trie held as a table of its prefixes: every place of a
    word descends it one character per level, a join on the prefix, and drops out where the trie ends; the longest token
    it passed counts. Then each word goes from token to token. Words over max_chars, or with a place that no
    token fits, are [unk]; an empty word has no pieces, a null one null.
    """
    tokens = vocab.select("token").filter("token <> ''").distinct()
    inner = F.startswith("token", F.lit("##")) & (F.length("token") > 2)
    # the mark tells the two tries apart; a token that begins a word may itself begin with ##
    trie = tokens.select(F.lit("^").alias("root"), F.col("token").alias("t")).union(
        tokens.filter(inner).select(F.lit("#"), F.expr("substring(token, 3)")))
    nodes = materialise(trie.select("root", "t", F.explode(F.sequence(F.lit(1), F.length("t"))).alias("depth")).select(
        "depth", F.concat("root", F.substring("t", F.lit(1), F.col("depth"))).alias("node"), (F.col("depth") == F.length("t")).alias("whole"))
        .groupBy("depth", "node").agg(F.bool_or("whole").alias("whole")), "trie")
    words = counts.select(F.col(word).alias("_w")).filter((F.length("_w") > 0) & (F.length("_w") <= max_chars)).distinct()
    alive = words.select("_w", F.explode(F.sequence(F.lit(0), F.length("_w") - 1)).alias("start"))
    ends, depth = None, 0
    while True:
        depth += 1
        here = F.concat(F.when(F.col("start") == 0, "^").otherwise("#"), F.substring("_w", F.col("start") + 1, F.lit(depth)))
        reach = alive.filter(F.col("start") + depth <= F.length("_w")).select("_w", "start", here.alias("node"))
        alive = materialise(reach.join(nodes.filter(F.col("depth") == depth).select("node", "whole"), "node").select("_w", "start", "whole"), "level")
        hit = alive.filter("whole").select("_w", "start", F.lit(depth).alias("n"))
        ends = hit if ends is None else ends.union(hit)
        if alive.isEmpty():
            break
    longest = ends.groupBy("_w", "start").agg(F.max("n").alias("n")).groupBy("_w").agg(
        F.map_from_entries(F.collect_list(F.struct("start", "n"))).alias("_next"))

    def walk(w: Column, following: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

        def step(acc, _):
            n = F.try_element_at(following, acc["at"])
            piece = F.concat(F.when(acc["at"] > 0, "##").otherwise(""), F.substring(w, acc["at"] + 1, n))
            return F.when((acc["at"] >= F.length(w)) | n.isNull(), acc).otherwise(
                F.struct((acc["at"] + n).alias("at"), F.array_append(acc["out"], piece).alias("out")))
        done = F.aggregate(F.sequence(F.lit(1), F.length(w)), start, step)
        return let(done, lambda d: F.when(d["at"] == F.length(w), d["out"]).otherwise(F.array(F.lit(unk))))

    pieces = longest.select(F.col("_w"), walk(F.col("_w"), F.col("_next")).alias("pieces"))
    none = F.when(F.length(word) == 0, F.array().cast("array<string>")).when(F.col(word).isNotNull(), F.array(F.lit(unk)))
    return counts.join(pieces, F.col(word) == F.col("_w"), "left").drop("_w").withColumn("pieces", F.coalesce("pieces", none))

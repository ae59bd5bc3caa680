"""Exact removal of byte strings of a least length that occur more than once, by common-prefix interval trees.

A full suffix array of all texts cannot be sorted in one place, so suffixes are sampled by content: in every
window of `length` bytes the smallest hash of a short gram is an anchor. Equal windows have their anchors at the
same place, so any repeat shares an anchor. Anchored suffixes of one gram form an enhanced suffix array of their own:
a stack scan over the common prefixes of the sorted suffixes gives the interval tree, a second one over what stands
to the left of the members tests that a group cannot be extended, and so yields maximal repeats with all occurrences.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import KEY, row_key, runs, utf8
from veilframe.session import materialise

LENGTH = 400
GRAM = 50
GROUP = 20_000  # contexts of one gram that a task holds; larger groups are counted per window instead
_CTX = ["c1", "c2"]
_PART = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(12345).integers(1, 1 << 63, 256, dtype=np.uint64)
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(14, n.bit_length())
    if size not in _POWERS:
        up, down = np.full(size, _BASE), np.full(size, _BACK)
        up[0] = down[0] = 1
        _POWERS[size] = np.multiply.accumulate(up), np.multiply.accumulate(down)
    return _POWERS[size]


def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of the gram at every place, from prefix sums of a polynomial."""
    up, down = _powers(len(data))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[:len(data)], out=total[1:])
    n = len(data) - gram + 1
    h = (total[gram:] - total[:n]) * down[:n]
    h ^= h >> np.uint64(31)
    h *= _BASE
    return h ^ (h >> np.uint64(29))


def anchors(text: bytes, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(place, hash, nearest, farthest): the leftmost smallest gram of every window of `length` bytes, and how many bytes
    before it the windows start whose anchor it is."""
    width = length - gram + 1
    at, hashes, near, far = [], [], [], []
    for lo in range(0, len(text) - length + 1, _PART):
        h = gram_hashes(np.frombuffer(text[lo:lo + _PART + length - 1], np.uint8), gram)
        # the place in the low bits breaks ties to the left and says where the smallest stands
        tagged = (h >> np.uint64(24) << np.uint64(24)) | np.arange(len(h), dtype=np.uint64)
        pad = -len(tagged) % width
        rows = np.r_[tagged, np.full(pad, np.uint64(0xFFFFFFFFFFFFFFFF))].reshape(-1, width)
        ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
        behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
        n = len(tagged) - width + 1
        best = (np.minimum(behind[:n], ahead[width - 1:width - 1 + n]) & np.uint64(0xFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, best[1:] != best[:-1]])
        last = np.r_[first[1:], n] - 1
        place = best[first]
        at.append(place + lo)
        hashes.append(h[place])
        near.append(place - last)
        far.append(place - first)
    at, hashes, near, far = (np.concatenate(x) for x in (at, hashes, near, far))
    new = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])  # windows of two pieces may have one anchor
    return at[new], hashes[new], np.minimum.reduceat(near, new), far[new]


def _occurrences(length: int, gram: int):
    out = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("h", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()),
                     ("pos", pa.int32()), ("left", pa.int32()), ("right", pa.int32()), ("near", pa.int32()), ("far", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy() for c in KEY)
            rows, found, digests, sizes = [], [], [], []
            for row in range(batch.num_rows):
                text = batch.column("text")[row].as_py()
                if len(text) < length:
                    continue
                found.append(anchors(text, length, gram))
                at = found[-1][0]
                rows.append(np.full(len(at), row))
                sizes.append(np.full(len(at), len(text)))
                reach = length - gram
                digests += [blake2b(text[max(0, a - reach):a + length], digest_size=16, salt=min(a, reach).to_bytes(4, "little")).digest()
                            for a in at.tolist()]
            if rows:
                r, n, at, h, near, far = (np.concatenate(x) for x in (rows, sizes, *zip(*found)))
                d = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                cols = [k1[r], k2[r], h.view(np.int64), d[:, 0], d[:, 1], at.astype(np.int32),
                        np.minimum(at, length - gram).astype(np.int32), np.minimum(n - at, length).astype(np.int32),
                        near.astype(np.int32), far.astype(np.int32)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], schema=out)
    return run


def _common(a: bytes, b: bytes) -> int:
    lo, hi = 0, min(len(a), len(b))
    if a[:hi] == b[:hi]:
        return hi
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if a[lo:mid] == b[lo:mid]:
            lo = mid
        else:
            hi = mid
    return lo


def intervals(common: list[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, last) of every common-prefix interval of two or more sorted entries, children first.

    common[i] is what entries i and i + 1 share; intervals of depth 0 are left out.
    """
    stack: list[tuple[int, int]] = []
    for i, depth in enumerate([*common, 0]):
        first = i
        while stack and stack[-1][0] > depth:
            top, first = stack.pop()
            yield top, first, i
        if depth > 0 and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def maximal_repeats(lefts: list[bytes], rights: list[bytes], least: int) -> Iterator[tuple[list[int], int, int]]:
    """(members, left, right): all groups of two or more contexts that share `left` bytes before and `right` bytes from the anchor
    on, at least `least` together, and cannot be extended on either side without losing a member.

    lefts are reversed, so that both sides are prefixes.
    """
    order = sorted(range(len(rights)), key=rights.__getitem__)
    common = [_common(rights[a], rights[b]) for a, b in zip(order, order[1:])]
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    most = max(map(len, lefts), default=0)
    for right, lo, hi in intervals(common):
        if right + most < least:
            continue
        members = sorted(order[lo:hi + 1], key=lefts.__getitem__)
        shared = [_common(lefts[a], lefts[b]) for a, b in zip(members, members[1:])]
        if right >= least and min(shared) == 0:
            yield members, 0, right
        for left, a, b in intervals(shared):
            if left + right < least:
                continue
            group = members[a:b + 1]
            if len(group) < hi - lo + 1:  # in a child interval it shares more to the right and is found there
                at = rank[group]
                if min(common[at.min():at.max()]) > right:
                    continue
            yield group, left, right


def extents(lefts: list[bytes], rights: list[bytes], least: int) -> list[tuple[int, int]]:
    """Per context, how far to the left and right of its anchor bytes are covered by repeats of at least `least` bytes."""
    if len(rights) == 2:
        right, left = _common(*rights), _common(*lefts)
        return [(left, right) if left + right >= least else (0, 0)] * 2
    out = [(0, 0)] * len(rights)
    for members, left, right in maximal_repeats(lefts, rights, least):
        for m in members:
            out[m] = max(out[m][0], left), max(out[m][1], right)
    return out


def _extents(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["h"]):
            h = t.column("h").to_numpy()
            c1, c2 = (t.column(c).to_numpy() for c in _CTX)
            left, text = t.column("left").to_pylist(), t.column("context").to_pylist()
            cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]).tolist() + [len(h)]
            ext = []
            for a, b in zip(cut, cut[1:]):
                ext += extents([text[i][left[i] - 1::-1] if left[i] else b"" for i in range(a, b)],
                               [text[i][left[i]:] for i in range(a, b)], length)
            e = np.array(ext, np.int32).reshape(-1, 2)
            keep = e.sum(axis=1) > 0
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in (c1, c2, e[:, 0], e[:, 1])], names=[*_CTX, "left", "right"])
    return run


def _windows(length: int):
    """(h, g1, g2, c1, c2, l): a digest of every window that has its anchor in a context of a very large group, l bytes before it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                left, text = batch.column("left")[i].as_py(), batch.column("context")[i].as_py()
                each = range(batch.column("near")[i].as_py(), batch.column("far")[i].as_py() + 1)
                d = np.frombuffer(b"".join(blake2b(text[left - n:left - n + length], digest_size=16).digest() for n in each), np.int64).reshape(-1, 2)
                h, *same = [np.full(len(d), batch.column(c)[i].as_py()) for c in ("h", *_CTX)]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (h, d[:, 0], d[:, 1], *same, np.array(each, np.int32))],
                                                 names=["h", "g1", "g2", *_CTX, "l"])
    return run


def _contexts(length: int, gram: int):
    out = pa.schema([("h", pa.int64()), ("size", pa.int64()), ("c1", pa.int64()), ("c2", pa.int64()), ("left", pa.int32()), ("near", pa.int32()),
                     ("far", pa.int32()), ("context", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for i in range(batch.num_rows):
                text = batch.column("text")[i].as_py()
                for a in batch.column("wanted")[i].as_py():
                    lo = a["pos"] - a["left"]
                    rows.append((a["h"], a["size"], a["c1"], a["c2"], a["left"], a["near"], a["far"], text[lo:a["pos"] + length]))
                    held += len(rows[-1][-1])
                if rows and (held > 1 << 24 or i == batch.num_rows - 1):
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), out)], schema=out)
                    rows, held = [], 0
    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), utf8(text_col).alias("text"))


def _prepared(keyed: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Places of anchors whose gram occurs again; their distinct contexts, how often each occurs and one place of it; the grams with
    several contexts, and whether one of these occurs once."""
    found = materialise(keyed.select(*KEY, "text").mapInArrow(
        _occurrences(length, gram), "k1 long, k2 long, h long, c1 long, c2 long, pos int, left int, right int, near int, far int"), "anchors")
    again = materialise(found.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("h"), "again")
    found = materialise(found.join(again, "h"), "repeated")
    ctx = materialise(found.groupBy(*_CTX).agg(
        F.count(F.lit(1)).alias("n"), F.min("h").alias("h"), F.min(F.struct("k1", "k2", "pos", "left", "right", "near", "far")).alias("at")), "contexts")
    by_gram = ctx.groupBy("h").agg(F.count(F.lit(1)).alias("size"), F.min("n").alias("rare")).filter("size > 1")
    return found, ctx, by_gram


def _texts(keyed: DataFrame, ctx: DataFrame, of: DataFrame, length: int, gram: int) -> DataFrame:
    """One text of every context of the given grams; the documents' exchange is shared by all uses in a plan."""
    wanted = (ctx.join(of.select("h", "size"), "h").groupBy("at.k1", "at.k2")
              .agg(F.collect_list(F.struct("h", "size", *_CTX, "at.pos", "at.left", "at.near", "at.far")).alias("wanted")))
    rows = keyed.join(wanted, (F.col(KEY[0]) == F.col("k1")) & (F.col(KEY[1]) == F.col("k2"))).select(*KEY, "id", "text", "wanted")
    return rows.mapInArrow(_contexts(length, gram), "h long, size long, c1 long, c2 long, left int, near int, far int, context binary")


def _repeated_windows(texts: DataFrame, length: int, ctx: DataFrame | None = None) -> DataFrame:
    """(h, l, g1, g2, c1, c2): windows of `length` bytes, l before the anchor, that several contexts of a gram have in common; with ctx
    also those of a context that occurs again.

    Every window has one anchor, so this makes a row per byte at most.
    """
    each = texts.select("h", *_CTX, "left", "near", "far", "context").mapInArrow(
        _windows(length), "h long, g1 long, g2 long, c1 long, c2 long, l int")
    same = ["h", "l", "g1", "g2"]  # a window around two anchors is one place, so grams do not mix
    if ctx is not None:
        each = each.join(ctx.select(*_CTX, "n"), _CTX)
    many = F.count(F.lit(1)) if ctx is None else F.sum("n")
    twice = each.groupBy(*same).agg(many.alias("n")).filter("n > 1").select(*same)
    return each.join(twice, same, "left_semi")


def spans(keyed: DataFrame, length: int = LENGTH, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """(k1, k2, spans array<struct<start, end>>): byte ranges of each document that repeats cover, not merged.

    keyed is (_k1, _k2, id, text binary). Contexts that are equal as a whole settle by their count; only one text of
    each distinct context that shares its gram with another is fetched and compared.
    """
    found, ctx, by_gram = _prepared(keyed, length, gram)
    by_gram = by_gram.filter("rare = 1")
    usual = (_texts(keyed, ctx, by_gram.filter(F.col("size") <= group), length, gram).select("h", *_CTX, "left", "context")
             .repartition("h").sortWithinPartitions("h").mapInArrow(_extents(length), "c1 long, c2 long, left int, right int"))
    ext = usual.union(ctx.filter("n > 1").select(*_CTX, "at.left", "at.right"))
    large = by_gram.filter(F.col("size") > group)
    if not large.isEmpty():
        windows = _repeated_windows(_texts(keyed, ctx, large, length, gram), length)
        ext = ext.union(windows.groupBy(*_CTX).agg(F.max("l").alias("left"), (length - F.min("l")).alias("right")))
    # moved once more by another key, and used, so that the join has exchanges of its own and a hot context's places can be split over tasks
    ext = ext.groupBy(*_CTX).agg(F.max("left").alias("el"), F.max("right").alias("er")).repartition(_CTX[1]).select(
        *_CTX, F.greatest("el", F.lit(0)).alias("el"), F.greatest("er", F.lit(0)).alias("er"))
    return found.select(*_CTX, "k1", "k2", "pos").join(ext, _CTX).groupBy("k1", "k2").agg(F.collect_list(
        F.struct((F.col("pos") - F.col("el")).alias("start"), (F.col("pos") + F.col("er")).alias("end"))).alias("spans"))


def _groups(length: int):
    """(group, c1, c2, left, right): the members of every maximal repeat of two or more contexts of a gram that holds a window whose
    anchor the gram is; a repeat that holds none is found at another anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["h"]):
            h = t.column("h").to_numpy()
            c1, c2 = (t.column(c).to_numpy() for c in _CTX)
            left, near, far, text = (t.column(c).to_pylist() for c in ("left", "near", "far", "context"))
            cut = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]).tolist() + [len(h)]
            for a, b in zip(cut, cut[1:]):
                found = maximal_repeats([text[i][left[i] - 1::-1] if left[i] else b"" for i in range(a, b)],
                                        [text[i][left[i]:] for i in range(a, b)], length)
                for members, before, after in found:
                    one, m = members[0] + a, np.array(members) + a
                    if max(near[one], length - after) > min(far[one], before):
                        continue
                    name = blake2b(text[one][left[one] - before:left[one] + after], digest_size=16, salt=before.to_bytes(4, "little")).hexdigest()
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(m)), pa.array(c1[m]), pa.array(c2[m]), *[pa.array(np.full(len(m), x, np.int32)) for x in (before, after)]],
                        names=["group", *_CTX, "left", "right"])
    return run


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
           group: int = GROUP) -> DataFrame:
    """(group string, id, start, end long): repeats of `length` bytes and more with all their occurrences.

    Occurrences of a group are the same bytes, all of them are there, and as far as `length` bytes around an anchor tell they cannot all
    be extended on a side; a longer repeat gives a group per anchor in it, nested repeats are groups of their own. Every byte
    that remove_repeats() removes lies in a group. A gram of more than `group` contexts is not put into one task: its
    groups are all windows of exactly `length` bytes that occur again.
    """
    keyed = _keyed(docs, id_col, text_col)
    found, ctx, by_gram = _prepared(keyed, length, gram)
    small = (_texts(keyed, ctx, by_gram.filter(F.col("size") <= group), length, gram).select("h", *_CTX, "left", "near", "far", "context")
             .repartition("h").sortWithinPartitions("h").mapInArrow(_groups(length), "group string, c1 long, c2 long, left int, right int"))
    large = by_gram.filter(F.col("size") > group)
    if not large.isEmpty():
        windows = _repeated_windows(_texts(keyed, ctx, large, length, gram), length, ctx)
        small = small.union(windows.select(F.concat_ws("-", F.lit("w"), "l", "g1", "g2"), *_CTX, "l", (length - F.col("l")).alias("right")))
    out = materialise(small, "groups")
    # a context that occurs again is a repeat by itself, unless others have it too
    alone = (ctx.filter("n > 1").join(large.select("h"), "h", "left_anti").select(*_CTX, "at.left", "at.right")
             .join(out.select(*_CTX, "left", "right"), [*_CTX, "left", "right"], "left_anti"))
    every = out.union(alone.select(F.concat_ws("-", F.lit("c"), *_CTX), *_CTX, "left", "right"))
    placed = found.select(*_CTX, "k1", "k2", "pos").join(every, _CTX)
    named = placed.join(keyed.select(*KEY, "id"), (F.col(KEY[0]) == F.col("k1")) & (F.col(KEY[1]) == F.col("k2")))
    return named.select("group", "id", (F.col("pos") - F.col("left")).cast("long").alias("start"), (F.col("pos") + F.col("right")).cast("long").alias("end"))


def _merge(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    new = np.r_[True, starts[1:] > ends[:-1]]
    return starts[new], ends[np.r_[new[1:], True]]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans_ = batch.column("spans")
        removed, runs_, kept = [], [], []
        for i in range(batch.num_rows):
            text, s = batch.column("text")[i].as_py(), spans_[i]
            if not s.is_valid or not len(s):
                removed.append(0)
                runs_.append(0)
                kept.append(text)
                continue
            flat = s.values
            a, b = _merge(flat.field("start").to_numpy(), flat.field("end").to_numpy())
            removed.append(int((b - a).sum()))
            runs_.append(len(a))
            kept.append(b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), len(text)])))
        size = [len(k) + r for k, r in zip(kept, removed)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(runs_, pa.int64()), pa.array(kept, pa.binary())],
            names=["id", "n_bytes", "n_removed", "n_spans", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                   group: int = GROUP) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans long, kept binary): one row per row of docs.

    Every byte that a string of `length` bytes covers which also starts elsewhere, in the same or another document,
    is removed from the UTF-8 text; strings are judged on the input. A null text is empty, texts shorter than `length`
    stay whole, repeated rows repeat each other and go as a whole. What is left may end inside a character.
    """
    keyed = _keyed(docs, id_col, text_col)
    of = spans(keyed, length, gram, group)
    joined = keyed.join(of, (F.col(KEY[0]) == F.col("k1")) & (F.col(KEY[1]) == F.col("k2")), "left").select(*KEY, "id", "text", "spans")
    schema = docs.select(F.col(id_col).alias("id"), *[F.lit(0).cast("long").alias(c) for c in ("n_bytes", "n_removed", "n_spans")],
                         _empty().alias("kept")).schema
    return joined.mapInArrow(_cut, schema)


def _empty() -> Column:
    return F.lit("").cast("binary")

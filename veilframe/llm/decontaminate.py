"""Benchmark decontamination by the q-gram lemma and banded alignment.

A passage of n characters that occurs with at most k edits shares at least n - q + 1 - k q of its q-grams with
the place where it occurs, on diagonals that differ by at most k. Regions of a text with enough q-grams of
any item are found first, then items by counts in overlapping diagonal bands, and what is left is aligned.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Q = 8
EDITS = 0.08  # edits a passage may have, as a share of its characters
BLOCK_CHARS = 8_000_000  # of items that one pass over the texts carries
_CHUNK = 1 << 18
_WALL = 0x110000  # no character: separates texts
_MIX = np.uint64(0x9E3779B97F4A7C15)


def codes(text: str) -> np.ndarray:
    """Code points, lower-cased one to one, every white-space or control character as a blank, so places stay as they are."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    out = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    out[(out <= 32) | (out == 0xA0)] = 32
    return out


def grams(c: np.ndarray, q: int) -> np.ndarray:
    """A 64-bit hash of the q-gram at every place."""
    n = len(c) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = c[:n].astype(np.uint64)
    for j in range(1, q):
        out *= _MIX
        out += c[j:j + n]
    out *= _MIX
    out ^= out >> np.uint64(29)
    return out


@dataclass
class Index:
    """The q-grams of a block of items; `windows` has a (length, least hits) rule per class of item lengths."""

    ids: list
    texts: list[np.ndarray]
    edits: np.ndarray
    least: np.ndarray
    hashes: np.ndarray
    item: np.ndarray
    place: np.ndarray
    table: np.ndarray
    windows: list[tuple[int, int]]
    reach: int
    q: int


def build(items: list[tuple[object, str | None]], q: int = Q, edits: float = EDITS) -> Index:
    """Null items and items of fewer than q characters match nothing."""
    kept = [(i, c) for i, t in items if len(c := _trim(codes(t or ""))) >= q]
    size = np.array([len(c) for _, c in kept], np.int64)
    k = np.minimum((size * edits).astype(np.int64), (size - q) // q)
    least = size - q + 1 - k * q
    found = [grams(c, q) for _, c in kept]
    hashes = np.concatenate(found) if found else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(kept)), [len(f) for f in found]) if found else np.zeros(0, np.int64)
    place = np.concatenate([np.arange(len(f)) for f in found]) if found else np.zeros(0, np.int64)
    order = np.argsort(hashes, kind="stable")
    bits = max(16, int(len(hashes) * 24).bit_length())
    table = np.zeros(1 << bits, bool)
    table[(hashes >> np.uint64(64 - bits)).astype(np.int64)] = True
    windows = []
    if len(kept):
        for cls in np.unique(np.floor(np.log2(size) * 2)):
            at = np.floor(np.log2(size) * 2) == cls
            windows.append((int((size[at] + k[at]).max()) - q + 1, int(least[at].min())))
    reach = int((size + k).max()) + q if len(kept) else q
    return Index([i for i, _ in kept], [c for _, c in kept], k, least, hashes[order], item[order], place[order], table, windows, reach, q)


def _trim(c: np.ndarray) -> np.ndarray:
    solid = np.flatnonzero(c != 32)
    return c[solid[0]:solid[-1] + 1] if len(solid) else c[:0]


def scan(index: Index, texts: list[str]) -> list[tuple[int, int, int, int, int]]:
    """(text, item, start, end, edits) of every place, in characters; of overlapping places of an item the one with fewest edits."""
    out: list[tuple[int, int, int, int, int]] = []
    group: list[tuple[int, np.ndarray]] = []
    held = 0
    for n, text in enumerate(texts):
        c = codes(text)
        group.append((n, c))
        held += len(c) + 1
        if held >= _CHUNK or n == len(texts) - 1:
            out += _scan_group(index, group)
            group, held = [], 0
    return out


def _scan_group(index: Index, group: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, int, int, int]]:
    wall = np.array([_WALL], np.uint32)
    flat = np.concatenate([x for _, c in group for x in (c, wall)])
    starts = np.cumsum([0] + [len(c) + 1 for _, c in group])
    best: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    step = 4 * _CHUNK
    for lo in range(0, len(flat), step):  # a long text is read in pieces that overlap by more than any match
        part = flat[lo:lo + step + 2 * index.reach]
        for item, start, end, cost in _places(index, part):
            owner = int(np.searchsorted(starts, lo + start, "right")) - 1
            row, base = group[owner][0], int(starts[owner])
            best.setdefault((row, item), []).append((cost, lo + start - base, lo + end - base))
    out = []
    for (row, item), found in sorted(best.items()):
        taken: list[tuple[int, int]] = []
        for cost, start, end in sorted(set(found)):
            if all(end <= a or start >= b for a, b in taken):
                taken.append((start, end))
                out.append((row, item, start, end, cost))
    return out


def _places(index: Index, c: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    h = grams(c, index.q)
    if not len(h) or not len(index.hashes):
        return
    bits = len(index.table).bit_length() - 1
    hit = index.table[(h >> np.uint64(64 - bits)).astype(np.int64)]
    at = np.flatnonzero(hit)
    left = np.searchsorted(index.hashes, h[at])
    real = index.hashes[np.minimum(left, len(index.hashes) - 1)] == h[at]
    at, left = at[real], left[real]
    if not len(at):
        return
    dense = np.zeros(len(h) + 1, np.int32)
    for width, least in index.windows:
        # hits from this one to the end of a window that starts at it
        n = np.searchsorted(at, at + width) - np.arange(len(at))
        first = at[n >= least]
        np.add.at(dense, first, 1)
        np.add.at(dense, np.minimum(first + width, len(h)), -1)
    inside = np.cumsum(dense)[at] > 0
    at, left = at[inside], left[inside]
    if not len(at):
        return
    count = np.searchsorted(index.hashes, h[at], "right") - left
    pos = np.repeat(at, count)
    entry = np.repeat(left - np.r_[0, np.cumsum(count)[:-1]], count) + np.arange(count.sum())
    item = index.item[entry]
    diagonal = pos - index.place[entry]
    band = diagonal // (index.edits[item] + 1)
    # a spread of k diagonals lies in one of the bands of 2k + 2 that start at every k + 1
    pair = np.concatenate([np.stack([item, band]), np.stack([item, band - 1])], axis=1)
    place = np.r_[index.place[entry], index.place[entry]]
    key = np.lexsort((place, pair[1], pair[0]))
    pair, place = pair[:, key], place[key]
    new = np.r_[True, (pair[:, 1:] != pair[:, :-1]).any(axis=0)]
    fresh = new | np.r_[True, place[1:] != place[:-1]]  # a q-gram of the item counts once in a band
    first = np.flatnonzero(new)
    shared = np.add.reduceat(fresh.astype(np.int64), first)
    for i, b, n in zip(pair[0][first].tolist(), pair[1][first].tolist(), shared.tolist()):
        if n >= index.least[i]:
            k = int(index.edits[i])
            found = align(index.texts[i], c, b * (k + 1), k)
            if found:
                yield i, *found


def align(item: np.ndarray, text: np.ndarray, low: int, k: int) -> tuple[int, int, int] | None:
    """(start, end, edits) of the best alignment of the whole item with at most k edits, its path kept to the
    diagonals low - k to low + 3k + 1, which hold every path that starts in the band; None if there is none."""
    n, width = len(item), 4 * k + 2
    base = low - k
    for start in range(max(0, low), min(low + 2 * k + 2, len(text) - n + 1)):
        if item[0] == text[start] and np.array_equal(item, text[start:start + n]):
            return start, start + n, 0
    lane = np.arange(width)
    far = n + width + 1
    cost = np.where((base + lane >= 0) & (base + lane <= len(text)), 0, far)  # a match may start anywhere in the band
    origin = base + lane
    for i in range(n):
        col = base + i + lane  # text position this cell consumes
        ok = (col >= 0) & (col < len(text))
        step = np.where(ok, cost + (text[np.clip(col, 0, len(text) - 1)] != item[i]), far)
        skip = np.r_[cost[1:] + 1, far]  # the item's character has no partner
        take = skip < step
        score, come = np.where(take, skip, step), np.where(take, np.r_[origin[1:], 0], origin)
        run = score - lane  # a text character has no partner: from the left in the same row
        lead = np.minimum.accumulate(run)
        from_ = np.maximum.accumulate(np.where(run == lead, lane, 0))
        cost, origin = lead + lane, come[from_]
        cost = np.where((base + i + 1 + lane >= 0) & (base + i + 1 + lane <= len(text)), cost, far)
        if cost.min() > k:
            return None
    end = int(np.argmin(cost))
    return (int(origin[end]), base + n + end, int(cost[end])) if cost[end] <= k else None


def blocks(items: DataFrame, id_col: str, text_col: str, block_chars: int) -> Iterator[list[tuple[object, str | None]]]:
    """The items in blocks of bounded size, so that what a pass carries does not grow with the set."""
    block: list[tuple[object, str | None]] = []
    held = 0
    for r in items.select(F.col(id_col).alias("i"), F.col(text_col).alias("t")).toLocalIterator():
        block.append((r.i, r.t))
        held += len(r.t or "")
        if held >= block_chars:
            yield block
            block, held = [], 0
    if block:
        yield block


def find(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", q: int = Q, edits: float = EDITS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(id, item, start long, end long, edits int): every place of a text that holds an item with at most `edits` x length edits.

    Case and the kind of white space do not count. Null and empty texts have no rows, nor has an empty
    set of items; repeated rows and repeated items repeat.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).filter("text is not null")
    zero = F.lit(0).cast("long")
    schema = (rows.select("id").limit(0).crossJoin(items.select(F.col(item_col).alias("item")).limit(0))
              .select("id", "item", zero.alias("start"), zero.alias("end"), F.lit(0).alias("edits"))).schema
    out = docs.sparkSession.createDataFrame([], schema)
    for block in blocks(items, item_col, item_text, block_chars):
        index = docs.sparkSession.sparkContext.broadcast(build(block, q, edits))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                got = scan(index.value, batch.column("text").to_pylist())
                row, item, start, end, cost = zip(*got) if got else [()] * 5
                ids = index.value.ids
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(pa.array(row, pa.int64())), pa.array([ids[i] for i in item], kinds),
                     pa.array(start, pa.int64()), pa.array(end, pa.int64()), pa.array(cost, pa.int32())],
                    names=["id", "item", "start", "end", "edits"])
        from pyspark.sql.pandas.types import to_arrow_type
        kinds = to_arrow_type(schema["item"].dataType)
        out = out.union(rows.mapInArrow(run, schema))
    return out


def drop_contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                      q: int = Q, edits: float = EDITS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of docs whose text holds no item, with all their columns, judged in place without a shuffle."""
    out = docs
    for block in blocks(items, item_col, item_text, block_chars):
        index = docs.sparkSession.sparkContext.broadcast(build(block, q, edits))

        def run(batches: Iterator[pa.RecordBatch], index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                for row, *_ in scan(index.value, [t or "" for t in batch.column(text_col).to_pylist()]):
                    clean[row] = False
                yield batch.filter(pa.array(clean))
        out = out.mapInArrow(run, docs.schema)
    return out

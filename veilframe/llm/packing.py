"""Best-fit packing of documents into fixed-size token sequences by a grouping genetic algorithm.

Texts are tokenised once, in place; only (piece, length) moves. Pieces are dealt to blocks of bounded
size; on each block several islands evolve whole packings and pass their best one on. What a block
leaves in badly filled sequences goes, with the other blocks' rest, to a next and much smaller level.
"""

from __future__ import annotations

import os
import re
import struct
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import utf8
from veilframe.session import materialise

CAPACITY = 4096
CACHE = 300_000  # words a Python worker remembers
_PLAIN = re.compile("[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class WordEncoder:
    """Token ids of white-space separated words, as little-endian unsigned 32-bit bytes.

    For tokenizers that drop white space, so that a text's ids are its words' ids in order. Words of ASCII and
    Latin-1 letters are cut by the tokenizer's own pattern and go straight to its merge model; all
    others go through the whole tokenizer. Both are kept in a bounded cache.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        # byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = iter(range(256, 512))
        letter = [chr(b) if b in plain else chr(next(rest)) for b in range(256)]
        self.alphabet = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}

    def _plain(self, word: str) -> bytes:
        out = []
        for piece in _PIECE.findall(word.lower()):
            ids = self.pieces.get(piece)
            if ids is None:
                ids = np.array([t.id for t in self.model.tokenize(piece.translate(self.alphabet))], "<u4").tobytes()
                if len(self.pieces) >= CACHE:
                    self.pieces.clear()
                self.pieces[piece] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: bytes) -> bytes:
        known = self.words
        words = text.split()
        try:
            return b"".join([known[w] for w in words])
        except KeyError:
            pass
        fresh = {}
        for w in {w for w in words if w not in known}:
            s = w.decode()
            if _PLAIN.fullmatch(s) and "<|" not in s:
                fresh[w] = self._plain(s)
            else:
                fresh[w] = np.array(self.tokenizer.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
        out = b"".join([known.get(w) or fresh.get(w, b"") for w in words])
        if len(known) + len(fresh) > CACHE:
            known.clear()
        if len(fresh) <= CACHE:
            known.update(fresh)
        return out


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """(id, piece int, start long, ids binary): every document's ids and the end id, cut only where longer than capacity.

    ids are unsigned 32-bit, little-endian. A null or blank text has the end id alone. Repeated rows and
    null ids give pieces of their own.
    """
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    schema = rows.select("id", F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"), F.col("text").alias("ids")).schema
    end, size = struct.pack("<I", end_id), 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            at, piece, start, ids, held = [], [], [], [], 0
            texts = batch.column("text")
            for row in range(batch.num_rows):
                whole = enc.encode(texts[row].as_py()) + end
                for n, lo in enumerate(range(0, len(whole), size)):
                    at.append(row)
                    piece.append(n)
                    start.append(lo // 4)
                    ids.append(whole[lo:lo + size])
                held += len(whole)
                if held > 1 << 25 or row == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                         pa.array(ids, pa.binary())], names=["id", "piece", "start", "ids"])
                    at, piece, start, ids, held = [], [], [], [], 0
    return rows.mapInArrow(run, schema)


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = 1, id_col: str = "doc_id",
                   text_col: str = "text", carry: dict[str, Column] | None = None, **params) -> DataFrame:
    """(id, piece, start, length long, carried columns, sequence_id long, offset long), one row per piece.

    carry names expressions over `ids` that are kept with a piece; by default the ids themselves. An
    empty table gives no rows.
    """
    carry = {"ids": F.col("ids")} if carry is None else carry
    cut = pieces(docs, tokenizer, capacity, end_id, id_col, text_col)
    cut = materialise(cut.select("id", "piece", "start", (F.octet_length("ids") / 4).cast("long").alias("length"),
                                 *[c.alias(n) for n, c in carry.items()], F.monotonically_increasing_id().alias("uid")), "pieces")
    return cut.join(pack(cut.select("uid", "length"), capacity, **params), "uid").drop("uid")


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = 8192, islands: int = 3, rounds: int = 2,
         generations: int = 6, well_filled: float = 0.97) -> DataFrame:
    """(uid, sequence_id, offset) for items (uid long, unique; length long, 1 to capacity).

    Items that fill a sequence are placed alone. The others are packed per block of about `block` items by
    islands that exchange their best packing after each round; pieces of sequences filled below
    `well_filled` are packed again together with those of other blocks, until one block is left.
    """
    full = items.filter(F.col("length") >= capacity).select(
        "uid", (-1 - F.col("uid")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rest, placed = items.filter(F.col("length") < capacity), [full]
    before = None
    for level in range(8):
        n = rest.count()
        if n == 0:
            break
        blocks = -(-n // block)
        done = _solve(rest, blocks, level, capacity, islands, rounds, generations)
        if blocks == 1 or n == before:
            placed.append(done.select("uid", "sequence_id", "offset"))
            break
        fill = done.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
        done = materialise(done.join(fill, "sequence_id"), "packed")
        last = level == 7
        good = F.lit(last) | (F.col("fill") >= well_filled * capacity)
        placed.append(done.filter(good).select("uid", "sequence_id", "offset"))
        rest, before = done.filter(~good).select("uid", "length"), n
    out = placed[0]
    for part in placed[1:]:
        out = out.union(part)
    return out


def _solve(items: DataFrame, blocks: int, level: int, capacity: int, islands: int, rounds: int, generations: int) -> DataFrame:
    """(uid, length, sequence_id, offset): the best island's packing of every block."""
    gathered = items.groupBy(F.pmod(F.xxhash64("uid", F.lit(level)), F.lit(blocks)).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("uid", "length"))).alias("items"))  # about 8192 items a block, dealt by hash
    state = materialise(gathered.select("block", F.col("items.uid").alias("uid"), F.col("items.length").cast("array<int>").alias("length"),
                                        F.explode(F.sequence(F.lit(0), F.lit(islands - 1))).alias("island"),
                                        F.array().cast("array<array<int>>").alias("elites")), "islands")
    schema = state.select("block", "island", "uid", "length", F.array().cast("array<int>").alias("best"), F.lit(0).alias("bins"),
                          F.lit(0.0).alias("slack")).schema
    for step in range(rounds):
        ran = materialise(state.repartition("block", "island").mapInArrow(_evolve(capacity, generations, step, level), schema), "islands")
        if step < rounds - 1:
            guest = ran.select("block", F.pmod(F.col("island") + 1, F.lit(islands)).alias("island"), F.col("best").alias("guest"))
            state = ran.join(guest, ["block", "island"]).select("block", "uid", "length", "island", F.array("best", "guest").alias("elites"))
    best = ran.groupBy("block").agg(F.min(F.struct("bins", "slack", "island")).alias("m")).select("block", "m.island")
    flat = ran.join(best, ["block", "island"], "left_semi").select(
        "block", F.explode(F.arrays_zip("uid", "length", "best")).alias("x")).select(
        F.col("x.uid").alias("uid"), F.col("x.length").cast("long").alias("length"),
        (F.lit(level) * F.lit(1 << 58) + F.col("block") * F.lit(1 << 20) + F.col("x.best")).alias("sequence_id"))
    offset = "sum(length) OVER (PARTITION BY sequence_id ORDER BY length DESC, uid ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length"
    return materialise(flat.withColumn("offset", F.expr(offset)), "placed")


def _evolve(capacity: int, generations: int, step: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                size = np.array(row["length"], np.int64)
                rng = np.random.default_rng([row["block"], row["island"], step, level])
                best = evolve(size, capacity, [np.array(e, np.int64) for e in row["elites"]], rng, generations)
                bins = int(best.max()) + 1
                yield pa.RecordBatch.from_pylist([{
                    "block": row["block"], "island": row["island"], "uid": row["uid"], "length": row["length"],
                    "best": best.tolist(), "bins": bins, "slack": -_worth(best, size, capacity)}], schema=out)
    out = pa.schema([("block", pa.int64()), ("island", pa.int32()), ("uid", pa.list_(pa.int64())), ("length", pa.list_(pa.int32())),
                     ("best", pa.list_(pa.int32())), ("bins", pa.int32()), ("slack", pa.float64())])
    return run


def evolve(size: np.ndarray, capacity: int, elites: list[np.ndarray], rng: np.random.Generator, generations: int,
           population: int = 6) -> np.ndarray:
    """The best packing found (bin of every item): few bins first, then the most unequal fill.

    Stops as soon as a packing needs no more bins than the total length does.
    """
    bound = -(-int(size.sum()) // capacity)
    people = list(elites)
    while len(people) < population:
        noise = 1 if not people else 1 + rng.normal(0, 0.08, len(size))
        people.append(best_fit(size, np.argsort(-size * noise, kind="stable"), capacity, []))
        if people[-1].max() + 1 <= bound:
            return people[-1]
    rank = lambda p: (int(p.max()), -_worth(p, size, capacity))
    people.sort(key=rank)
    for _ in range(generations):
        if people[0].max() + 1 <= bound:
            break
        children = []
        for _ in range(population // 2):
            a, b = rng.choice(population, 2, replace=False)
            children.append(crossover(people[min(a, b)], people[max(a, b)], size, capacity, rng))
        people = sorted(people + children, key=rank)[:population]
    return people[0]


def _worth(assign: np.ndarray, size: np.ndarray, capacity: int) -> float:
    fill = np.bincount(assign, size) / capacity
    return float((fill ** 2).mean())


def crossover(one: np.ndarray, other: np.ndarray, size: np.ndarray, capacity: int, rng: np.random.Generator) -> np.ndarray:
    """Whole well-filled bins of `other` go into `one`; bins of `one` that share an item with them, and a few
    badly filled ones, are dissolved, and what they held besides is placed by best fit."""
    fill = np.bincount(other, size)
    take = (fill >= np.quantile(fill, 0.5)) & (rng.random(len(fill)) < 0.5)
    injected = take[other]
    own = np.bincount(one, size)
    broken = np.bincount(one, injected, len(own)) > 0
    broken |= (own <= np.quantile(own, 0.05)) & (rng.random(len(own)) < 0.7)
    kept = ~injected & ~broken[one]
    child = np.full(len(size), -1, np.int64)
    _, child[kept] = np.unique(one[kept], return_inverse=True) if kept.any() else (None, child[kept])
    base = int(child.max()) + 1
    _, put = np.unique(other[injected], return_inverse=True)
    child[injected] = put + base
    bins = int(child.max()) + 1
    loose = np.flatnonzero(child < 0)
    free = (capacity - np.bincount(child[child >= 0], size[child >= 0], bins)).astype(np.int64)
    order = loose[np.argsort(-size[loose], kind="stable")]
    child[order] = best_fit(size, order, capacity, free.tolist())[order]
    return np.unique(child, return_inverse=True)[1]


def best_fit(size: np.ndarray, order: np.ndarray, capacity: int, free: list[int]) -> np.ndarray:
    """Place items in the given order, each in the open bin it fills most, else in a new one."""
    assign = np.full(len(size), -1, np.int64)
    bins = sorted((room, b) for b, room in enumerate(free) if room > 0)
    count = len(free)
    for i in order.tolist():
        need = int(size[i])
        at = bisect_left(bins, (need, -1))
        if at == len(bins):
            room, b = capacity, count
            count += 1
        else:
            room, b = bins.pop(at)
        assign[i] = b
        if room > need:
            insort(bins, (room - need, b))
    return assign

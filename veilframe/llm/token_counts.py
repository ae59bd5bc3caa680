"""Edit-aware token counts: a tree of pre-token sums per document, updated only where a text is edited.

Tokens never cross pre-tokens, so a count is a sum over pre-tokens. Their lengths and counts are kept in leaves of a
few dozen, with sums above them. An edit is read again from a little before its start until the new pre-tokens fall into step with
the old ones; only those leaves are replaced and only the sums on their paths change.
"""

from __future__ import annotations

import base64
from bisect import bisect_left
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAF = 64  # pre-tokens in a leaf
AHEAD = 4  # characters the pattern may look at beyond the end of a match, and some more
CACHE = 200_000
PART = 1 << 24  # bytes of output a task holds


class Counter:
    """Tokens of a pre-token, by a byte-pair vocabulary; remembers a bounded number of them."""

    def __init__(self, vocabulary: str, pattern: str):
        import tiktoken

        with open(vocabulary, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        compiled = regex.compile(pattern)
        self.find, self.pieces = compiled.finditer, compiled.findall
        self.known: dict[str, int] = {}

    def count(self, piece: str) -> int:
        n = self.known.get(piece)
        if n is None:
            n = len(self.encoding.encode_ordinary(piece))
            if len(self.known) >= CACHE:
                self.known.clear()
            self.known[piece] = n
        return n

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        try:
            return [known[p] for p in pieces]
        except KeyError:
            return [self.count(p) for p in pieces]


_COUNTERS: dict[tuple[str, str], Counter] = {}


def counter(vocabulary: str, pattern: str) -> Counter:
    if (vocabulary, pattern) not in _COUNTERS:
        _COUNTERS[vocabulary, pattern] = Counter(vocabulary, pattern)
    return _COUNTERS[vocabulary, pattern]


class Tree:
    """Leaves of (length, tokens) per pre-token, and a heap of (characters, tokens) sums over them."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray]]):
        self.leaves = leaves
        self.width = 1 << max(0, (len(leaves) - 1).bit_length())
        self.sums = np.zeros((2 * self.width, 2), np.int64)
        for i, (length, tokens) in enumerate(leaves):
            self.sums[self.width + i] = length.sum(), tokens.sum()
        for i in range(self.width - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]

    @classmethod
    def of(cls, text: str, c: Counter) -> Tree:
        pieces = c.pieces(text)
        length, tokens = np.fromiter(map(len, pieces), np.uint32, len(pieces)), np.array(c.counts(pieces), np.uint32)
        return cls([(length[i:i + LEAF], tokens[i:i + LEAF]) for i in range(0, len(length), LEAF)] or [(length, tokens)])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 1])

    def locate(self, place: int) -> tuple[int, int]:
        """(leaf, its first character) of the pre-token that holds the character at `place`, or the last leaf."""
        node, start = 1, 0
        while node < self.width:
            node *= 2
            if place >= start + self.sums[node, 0] and self.sums[node + 1, 0]:
                start += int(self.sums[node, 0])
                node += 1
        return min(node - self.width, len(self.leaves) - 1), start

    def replace(self, leaf: int, length: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves[leaf] = length, tokens
        node = self.width + leaf
        self.sums[node] = length.sum(), tokens.sum()
        while node > 1:
            node //= 2
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, read: Callable[[int, int], str], size: int, start: int, old: int, new: int, c: Counter) -> int:
        """Bring the tree up to date with a text of `size` characters, in which `new` characters at `start` stand for `old` ones.

        read(a, b) gives characters a to b of that text; what is asked for grows until the new pre-tokens fall into step with the
        old ones. Returns the pre-tokens read again.
        """
        leaf, at = self.locate(max(0, start - AHEAD))
        ends = at + np.cumsum(self.leaves[leaf][0], dtype=np.int64)
        first = int(np.searchsorted(ends, start - AHEAD))  # ends before this one cannot have looked at the edit
        begin = int(ends[first - 1]) if first else at
        width = start + new - begin + 128
        while (found := self._in_step(read(begin, min(size, begin + width)), begin, size, leaf, at, start, old, new, c)) is None:
            width *= 4
        length, tokens, last, tail = found
        none = np.zeros(0, np.uint32)
        keep_l, keep_t = self.leaves[leaf][0][:first], self.leaves[leaf][1][:first]
        for i in range(leaf + 1, last + 1):
            self.replace(i, none, none)
        self.replace(leaf, np.concatenate([keep_l, np.array(length, np.uint32), tail[0]]),
                     np.concatenate([keep_t, np.array(tokens, np.uint32), tail[1]]))
        return len(length)

    def _in_step(self, chunk: str, begin: int, size: int, leaf: int, at: int, start: int, old: int, new: int, c: Counter):
        """(lengths, tokens, last leaf touched, what stays of it) of the pre-tokens from `begin` up to a boundary that was one before; None
        if the chunk ends too early to tell."""
        shift, end = new - old, begin + len(chunk)
        last, base = leaf, at
        # old boundaries at or after the edit, leaf by leaf, to fall into step with
        bounds = self._bounds(last, base, start + old) + shift
        length, tokens = [], []
        for m in c.find(chunk):
            here = begin + m.end()
            if end < size and here > end - AHEAD:
                return None
            length.append(m.end() - m.start())
            tokens.append(c.count(m.group()))
            if here < start + new:
                continue
            while not len(bounds) or bounds[-1] < here:
                if last + 1 >= len(self.leaves):
                    bounds = np.array([here if here == size else size + 1])
                    break
                base += int(self.leaves[last][0].sum())
                last += 1
                bounds = self._bounds(last, base, start + old) + shift
            if bounds[np.searchsorted(bounds, here)] == here:
                cut = int(np.searchsorted(base + np.cumsum(self.leaves[last][0], dtype=np.int64), here - shift, "right"))
                return length, tokens, last, (self.leaves[last][0][cut:], self.leaves[last][1][cut:])
        if end < size:
            return None
        return length, tokens, len(self.leaves) - 1, (np.zeros(0, np.uint32),) * 2  # read to the end of the text

    def _bounds(self, leaf: int, base: int, least: int) -> np.ndarray:
        ends = base + np.cumsum(self.leaves[leaf][0], dtype=np.int64)
        return ends[np.searchsorted(ends, least):]

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.leaves), *[len(length) for length, _ in self.leaves]], "<u4")
        return b"".join([sizes.tobytes(), *[x.astype("<u4").tobytes() for leaf in self.leaves for x in leaf]])

    @classmethod
    def from_bytes(cls, data: bytes) -> Tree:
        flat = np.frombuffer(data, "<u4")
        sizes, at, leaves = flat[1:1 + flat[0]], 1 + int(flat[0]), []
        for n in sizes.tolist():
            leaves.append((flat[at:at + n], flat[at + n:at + 2 * n]))
            at += 2 * n
        return cls(leaves)


def _written(rows: Iterator[tuple[int, list]], batch: pa.RecordBatch, schema: T.StructType, new: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    """Batches of about PART bytes: the input's columns, with the new columns' values, in the order of the schema."""
    lo, held, out = 0, 0, []
    for at, values in rows:
        out.append(values)
        held += sum(len(v) if isinstance(v, (str, bytes)) else 8 for v in values)
        if held > PART or at == batch.num_rows - 1:
            made = {name: pa.array(col, kind) for (name, kind), col in zip(new.items(), zip(*out))}
            same = batch.slice(lo, len(out))
            yield pa.RecordBatch.from_arrays([made[f] if f in made else same.column(f) for f in schema.names], names=schema.names)
            lo, held, out = at + 1, 0, []


def index(docs: DataFrame, vocabulary: str, pattern: str, text_col: str = "text") -> DataFrame:
    """docs with a column `tree` (binary) and `n_tokens` (long); columns of those names are replaced. A null text is empty."""
    rows = docs.drop("tree", "n_tokens")
    schema = rows.select("*", F.lit("").cast("binary").alias("tree"), F.lit(0).cast("long").alias("n_tokens")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary, pattern)
        for batch in batches:
            trees = ((i, Tree.of(t.as_py() or "", c)) for i, t in enumerate(batch.column(text_col)))
            yield from _written(((i, [t.to_bytes(), t.tokens]) for i, t in trees), batch, schema, {"tree": pa.binary(), "n_tokens": pa.int64()})
    return rows.mapInArrow(run, schema)


def apply_edits(indexed: DataFrame, vocabulary: str, pattern: str, edits_col: str = "edits", text_col: str = "text") -> DataFrame:
    """indexed with its edits carried out: new text, tree and n_tokens, and n_reencoded, the pre-tokens that were read again.

    edits is array<struct<start int, end int, text string>> in places of the text before any edit. Null or empty edits change
    nothing, a null text that gets no text stays null; edits that overlap an earlier one (by start, then end) or lie outside the text are left out.
    """
    rows = indexed.drop("n_reencoded")
    schema = rows.select("*", F.lit(0).cast("long").alias("n_reencoded")).schema

    def edited(batch: pa.RecordBatch, c: Counter) -> Iterator[tuple[int, list]]:
        for i, (text, edits, tree, n) in enumerate(zip(*[batch.column(x) for x in (text_col, edits_col, "tree", "n_tokens")])):
            text, edits, tree, n, reread = text.as_py(), edits.as_py(), tree.as_py(), n.as_py(), 0
            if edits:
                t = Tree.from_bytes(tree)
                new_text, reread = carry_out(text or "", edits, t, c)
                text = new_text if text is not None or new_text else None
                tree, n = t.to_bytes(), t.tokens
            yield i, [text, tree, n, reread]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary, pattern)
        new = {text_col: pa.string(), "tree": pa.binary(), "n_tokens": pa.int64(), "n_reencoded": pa.int64()}
        for batch in batches:
            yield from _written(edited(batch, c), batch, schema, new)
    return rows.mapInArrow(run, schema)


def mask_and_count(docs: DataFrame, vocabulary: str, pattern: str, rules: dict[str, str], text_col: str = "text") -> DataFrame:
    """docs with their matches of `rules` masked, and n_tokens_before, n_edits, n_reencoded, n_tokens (long): index(), masks() and
    apply_edits() in one pass, so a document's tree lives only while it is at hand.

    Columns of those names are replaced; a null text stays null and has no tokens.
    """
    counts = ("n_tokens_before", "n_edits", "n_reencoded", "n_tokens")
    rows = docs.drop(*counts)
    schema = rows.select("*", *[F.lit(0).cast("long").alias(n) for n in counts]).schema
    steps = list(rules.items())

    def masked(batch: pa.RecordBatch, c: Counter, compiled: list) -> Iterator[tuple[int, list]]:
        for i, value in enumerate(batch.column(text_col)):
            text = value.as_py()
            tree = Tree.of(text or "", c)
            before, edits, reread = tree.tokens, matches(text or "", compiled), 0
            if edits:
                text, reread = carry_out(text, edits, tree, c)
            yield i, [text, before, len(edits), reread, tree.tokens]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(vocabulary, pattern)
        compiled = [(regex.compile(p), marker) for p, marker in steps]
        for batch in batches:
            yield from _written(masked(batch, c, compiled), batch, schema, {text_col: pa.string(), **dict.fromkeys(counts, pa.int64())})
    return rows.mapInArrow(run, schema)


def carry_out(text: str, edits: list[dict], tree: Tree, c: Counter) -> tuple[str, int]:
    """The edited text and the pre-tokens read again; `tree` is brought up to date, edit by edit from the end."""
    chosen, end = [], 0
    for e in sorted(edits, key=lambda e: (e["start"], e["end"])):
        if end <= e["start"] <= e["end"] <= len(text):
            chosen.append(e)
            end = e["end"]
    # neighbours that a match could see both of are one edit, so every re-reading sees its final surroundings
    merged: list[list] = []
    for e in chosen:
        if merged and e["start"] - merged[-1][1] <= 2 * AHEAD:
            merged[-1][2] += text[merged[-1][1]:e["start"]] + (e["text"] or "")
            merged[-1][1] = e["end"]
        else:
            merged.append([e["start"], e["end"], e["text"] or ""])
    parts, places, done, size = [], [], 0, 0
    for start, end, new in merged:
        parts += [text[done:start], new]
        places.append(size + start - done)  # of the new text in the result
        size += start - done + len(new)
        done = end
    result = "".join([*parts, text[done:]])
    reread = 0
    for (start, end, new), place in zip(reversed(merged), reversed(places)):
        # the text as the tree has it next: as it was up to this edit, final from there on
        def read(a: int, b: int, start=start, place=place) -> str:
            return text[a:min(b, start)] + result[place + max(0, a - start):place + max(0, b - start)]
        reread += tree.edit(read, start + len(result) - place, start, end - start, len(new), c)
    return result, reread


def matches(text: str, compiled: list[tuple[regex.Pattern, str]]) -> list[dict]:
    """An edit per match of the rules, earlier rules first where matches overlap."""
    taken: list[tuple[int, int]] = []  # in order, apart from one another
    out = []
    for p, marker in compiled:
        for m in p.finditer(text):
            a, b = m.span()
            i = bisect_left(taken, (b, b))  # ranges from here on begin at or after the end
            if b > a and (not i or taken[i - 1][1] <= a):
                taken.insert(i, (a, b))
                out.append({"start": a, "end": b, "text": marker})
    return out


def masks(text_col: str, rules: dict[str, str]) -> Column:
    """Edits that put a marker in the place of every match of a pattern; earlier rules first where matches overlap."""
    steps = list(rules.items())

    @F.pandas_udf("array<struct<start int, end int, text string>>")
    def find(texts):
        import pandas as pd

        compiled = [(regex.compile(p), marker) for p, marker in steps]
        return pd.Series([matches(t or "", compiled) for t in texts])
    return find(F.col(text_col))

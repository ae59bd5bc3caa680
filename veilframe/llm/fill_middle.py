"""Fill-in-the-middle: documents cut at two drawn boundaries and put together in another order.

The byte offsets of all unit boundaries of a text are held as a learned index: line segments that miss no offset by
more than a fixed error, and the small difference of each boundary. A cut is predicted from its rank and corrected by
its difference, so it is exact. Where the offsets follow the lines exactly, as in ASCII texts, no differences are kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import utf8

ERROR = 120  # bytes a line may miss an offset by; differences, rounding included, fit one byte
BLOCK = 1 << 22  # bytes of a text whose offsets are held at a time
MARKERS = ("<P>", "<S>", "<M>")


class RankIndex:
    """Offset of every boundary by its rank: segments (first rank, its offset, slope), and what each boundary differs by."""

    def __init__(self, size: int, first: np.ndarray, base: np.ndarray, slope: np.ndarray, differs: np.ndarray):
        self.size, self.first, self.base, self.slope, self.differs = size, first, base, slope, differs

    @classmethod
    def fit(cls, blocks: Iterator[np.ndarray]) -> RankIndex:
        """Index of rising offsets that come in blocks; a segment never crosses blocks."""
        size, first, base, slope, differs = 0, [], [], [], []
        for y in blocks:
            at, slopes = segments(y)
            x = np.arange(len(y)) - np.repeat(at, np.diff(np.r_[at, len(y)]))
            lines = np.repeat(slopes, np.diff(np.r_[at, len(y)]))
            start = np.repeat(y[at], np.diff(np.r_[at, len(y)]))
            differs.append((y - start - np.rint(lines * x).astype(np.int64)).astype(np.int8))
            first.append(at + size)
            base.append(y[at])
            slope.append(slopes)
            size += len(y)
        differs = np.concatenate(differs)
        return cls(size, np.concatenate(first), np.concatenate(base), np.concatenate(slope), differs if differs.any() else differs[:0])

    def offset(self, rank: int) -> int:
        s = int(np.searchsorted(self.first, rank, "right")) - 1
        guess = int(self.base[s]) + int(np.rint(self.slope[s] * (rank - self.first[s])))
        return guess + int(self.differs[rank]) if len(self.differs) else guess


def segments(y: np.ndarray, error: int = ERROR) -> tuple[np.ndarray, np.ndarray]:
    """First ranks and slopes of lines through y[first] that miss no offset of theirs by more than `error`.

    Each segment is as long as a line from its start can be: the slopes that every further offset allows are
    narrowed until none is left. Blocks double with the segment, so the work stays linear.
    """
    first, slopes, at, step = [], [], 0, 1024
    while at < len(y):
        low, high, end = 0.0, np.inf, at + 1
        while end < len(y):
            stop = min(len(y), end + step)
            x, rise = np.arange(end - at, stop - at), y[end:stop] - y[at]
            lows = np.maximum(np.maximum.accumulate((rise - error) / x), low)
            highs = np.minimum(np.minimum.accumulate((rise + error) / x), high)
            crossed = lows > highs
            fits = int(crossed.argmax()) if crossed[-1] else stop - end
            if fits:
                low, high = lows[fits - 1], highs[fits - 1]
            end += fits
            if end < stop:
                break
            step *= 2
        first.append(at)
        slopes.append((low + high) / 2 if np.isfinite(high) else low)
        step = max(64, end - at)
        at = end
    return np.array(first, np.int64), np.array(slopes)


def boundaries(text: bytes, unit: regex.Pattern | None = None) -> Iterator[np.ndarray]:
    """Byte offsets of the starts of all units and of the end, in blocks.

    Without a pattern every code point is a unit. With one, a unit reaches from the start of a match to that of the
    next; what lies before the first match belongs to the first unit, and a text without a match is one unit.
    """
    if unit is None:
        data = np.frombuffer(text, np.uint8)
        for lo in range(0, len(data), BLOCK):
            starts = np.flatnonzero((data[lo:lo + BLOCK] & 0xC0) != 0x80)
            if len(starts):
                yield starts + lo
    elif text:
        chars = text.decode("utf-8", "replace")
        places = np.array([0, *[m.start() for m in unit.finditer(chars) if m.end() > m.start()][1:]])
        yield np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)[places]
    yield np.array([len(text)])


def draws(id_col: str, seed: int) -> list[Column]:
    """Four unsigned 32-bit numbers per id, from the SHA-256 of `seed:id`; a null id draws like an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def fill_in_middle(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1, plain_percent: int = 10,
                   spm_percent: int = 20, unit: str | None = None, markers: tuple[str, str, str] = MARKERS) -> DataFrame:
    """(id, n long, form, prefix_units long, middle_units long, output string): one row per row of docs, no shuffle.

    n is the number of units of a text, code points or the matches of `unit`. Two boundaries drawn from (seed, id)
    end prefix and middle. form psm is marker P, prefix, marker S, suffix, marker M, middle; spm has suffix and
    prefix the other way round, with their markers; plain is the text as it is, for plain_percent of the ids and for texts that are empty
    or hold a marker, and has null units. A null text is empty. Rows that repeat an id with the same text are cut
    alike; other columns of docs are not read.
    """
    check(markers)
    p, s, m = [x.encode() for x in markers]
    rows = docs.select(F.col(id_col).alias("id"), utf8(text_col).alias("text"), *draws(id_col, seed))
    schema = rows.select("id", F.lit(0).cast("long").alias("n"), F.lit("").alias("form"), F.col("h1").alias("prefix_units"),
                         F.col("h1").alias("middle_units"), F.col("text").alias("output")).schema

    def cut(text: bytes, h: tuple[int, int, int, int], pattern: regex.Pattern | None) -> tuple:
        index = RankIndex.fit(boundaries(text, pattern))
        n = index.size - 1
        if not text or p in text or s in text or m in text or h[2] % 100 >= 100 - plain_percent:
            return n, "plain", None, None, text
        a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        i, j = index.offset(a), index.offset(b)
        if h[3] % 100 < spm_percent:
            return n, "spm", a, b - a, b"".join((s, text[j:], p, text[:i], m, text[i:j]))
        return n, "psm", a, b - a, b"".join((p, text[:i], s, text[j:], m, text[i:j]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern = regex.compile(unit) if unit is not None else None
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("id")
            h = list(zip(*[batch.column(f"h{i}").to_pylist() for i in (1, 2, 3, 4)]))
            out, held, lo = [], 0, 0
            for row in range(batch.num_rows):
                out.append(cut(texts[row].as_py(), h[row], pattern))
                held += len(out[-1][-1])
                if held > 1 << 24 or row == batch.num_rows - 1:
                    n, form, a, b, whole = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [ids.slice(lo, len(out)), pa.array(n, pa.int64()), pa.array(form, pa.string()), pa.array(a, pa.int64()),
                         pa.array(b, pa.int64()), pa.array(whole, pa.binary())], names=schema.names)
                    out, held, lo = [], 0, row + 1
    return rows.mapInArrow(run, schema).withColumn("output", F.col("output").cast("string"))


def restore(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that was cut. Texts that hold a marker are plain, so an output of another form holds each marker once."""
    parts = F.split(output, "|".join("\\Q" + x + "\\E" for x in markers), -1)
    part = lambda i: F.get(parts, F.lit(i))
    return (F.when(form == "psm", F.concat(part(1), part(3), part(2)))
            .when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output))


def check(markers: tuple[str, str, str]) -> None:
    """Markers must be told apart wherever they meet a text: none may end as another begins."""
    if len(set(markers)) != 3 or not all(markers):
        raise ValueError("three different markers are needed")
    for a in markers:
        for b in markers:
            if (a != b and a in b) or any(a.endswith(b[:i]) for i in range(1, min(len(a), len(b) + (a != b)))):
                raise ValueError(f"markers {a!r} and {b!r} overlap")

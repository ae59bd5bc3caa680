"""Helpers the operators share: row keys, whole texts as bytes, groups streamed out of sorted batches."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from types import ModuleType

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\x20\x09-\x0D]+"
KEY = ["_k1", "_k2"]


def worker_state() -> dict:
    """What a Python worker keeps from one task to the next.

    Functions that travel with their helpers bring modules of their own, so their globals last for a task only.
    """
    return vars(sys.modules.setdefault("_veilframe_worker", ModuleType("_veilframe_worker")))


def row_key(id_col: str, text_col: str) -> list[Column]:
    """Two hashes that stand for a document row in joins, never null.

    Rows that repeat an id with the same text share a key and are treated alike; an id that repeats
    with another text, or a null id, still gives keys of its own.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(F.col(id_col), F.col(id_col).isNull(), text).alias(KEY[0]),
            F.xxhash64(F.lit("second"), text, F.col(id_col)).alias(KEY[1])]


def utf8(text_col: str) -> Column:
    """The whole text as UTF-8 bytes; a null text is empty."""
    return F.coalesce(F.col(text_col), F.lit("")).cast("binary")


def has_word(col: Column) -> Column:
    return col.rlike(r"[^\x20\x09-\x0D]")


def words(col: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text; none for a null or blank text."""
    trimmed = F.regexp_replace(F.coalesce(col, F.lit("")), rf"^{SPACE}|{SPACE}$", "")
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE))


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Tables of whole key groups out of batches sorted by the keys.

    Each table holds all groups that end in a batch; the open last group is carried on. Memory is one
    batch plus one group.
    """
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        tail = tuple(batch.column(k)[-1].as_py() for k in keys)
        head = tuple(batch.column(k)[0].as_py() for k in keys)
        if head == tail and head == last:
            held.append(batch)
            continue
        cut = _first_of_last(batch, keys, tail)
        if cut == 0:
            if held:
                yield pa.Table.from_batches(held)
            held = [batch]
        else:
            yield pa.Table.from_batches([*held, batch.slice(0, cut)])
            held = [batch.slice(cut)]
        last = tail
    if held:
        yield pa.Table.from_batches(held)


def _first_of_last(batch: pa.RecordBatch, keys: list[str], tail: tuple) -> int:
    lo, hi = 0, batch.num_rows - 1
    while lo < hi:
        mid = (lo + hi) // 2
        if tuple(batch.column(k)[mid].as_py() for k in keys) == tail:
            hi = mid
        else:
            lo = mid + 1
    return lo

"""SimHash near-duplicates by covering locality-sensitive hashing.

Every bit position gets a non-zero vector of radius + 1 bits; table v keeps the positions whose vector
has an odd product with v. The vectors of at most `radius` differing positions span a space of at most
`radius` dimensions, so some v is orthogonal to all of them: in that table the pair has equal keys. No
pair within the radius is missed, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import KEY, row_key, runs, utf8
from veilframe.llm.components import components
from veilframe.session import materialise

BITS = 64
BUCKET = 2048  # fingerprints a task compares at once; fuller buckets are divided by finer masks
_CHUNK = 1 << 16


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, seed: int = 42) -> DataFrame:
    """(_k1, _k2, id, fingerprint long) for every row: majority bits of the XXH64 of all k-word shingles.

    A-Z are lower-cased, words are split at ASCII white space. Fewer than k words give one shingle, none
    (null or blank texts) the fingerprint 0. Repeated rows repeat. Long texts are hashed in pieces, so
    memory does not grow with a text beyond its own words.
    """
    rows = docs.select(*row_key(id_col, text_col), F.col(id_col).alias("id"), utf8(text_col).alias("text"))
    schema = rows.select(*KEY, "id", F.lit(0).cast("long").alias("fingerprint")).schema
    return rows.mapInArrow(_hasher(k, seed), schema)


def _hasher(k: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = _majority(batch.column("text").to_pylist(), k, seed)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in (*KEY, "id")], pa.array(prints.view(np.int64))],
                                             names=[*KEY, "id", "fingerprint"])
    return run


def _majority(texts: list[bytes], k: int, seed: int) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    ones, total = np.zeros((len(texts), BITS), np.int64), np.zeros(len(texts), np.int64)
    buf: list[int] = []
    starts: list[int] = []
    owners: list[int] = []

    def flush():
        if buf:
            bits = np.unpackbits(np.array(buf, np.uint64).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            np.add.at(ones, owners, np.add.reduceat(bits, starts, axis=0, dtype=np.int64))
            for x in (buf, starts, owners):
                x.clear()

    for row, text in enumerate(texts):
        w = text.lower().split()
        n = max(len(w) - k + 1, 1) if w else 0
        total[row] = n
        for lo in range(0, n, _CHUNK):
            part = w[lo:lo + _CHUNK + k - 1]
            starts.append(len(buf))
            owners.append(row)
            if len(part) < k:
                buf.append(digest(b" ".join(part), seed))
            else:
                buf.extend([digest(b" ".join(s), seed) for s in zip(*[part[i:] for i in range(k)])])
            if len(buf) >= _CHUNK:
                flush()
    flush()
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).reshape(-1)


def masks(positions: list[int], radius: int) -> list[int]:
    """Covering masks over some bit positions, as signed 64-bit integers."""
    m = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, m + 1):
        value = sum(1 << p for j, p in enumerate(positions) if bin((j % m + 1) & v).count("1") % 2)
        out.append(value - (1 << BITS) if value >> (BITS - 1) else value)
    return out


def finer(mask: int, radius: int) -> list[int]:
    """The masks that divide a bucket of `mask` by the positions it leaves free, covering again."""
    free = [p for p in range(BITS) if not mask >> p & 1]
    signed = lambda x: (x & (1 << BITS) - 1) - (1 << BITS if x >> (BITS - 1) & 1 else 0)
    return sorted({signed(mask | m) for m in masks(free, radius)})


def _keys(fp: Column, of: list[int]) -> Column:
    return F.explode(F.array(*[F.struct(F.lit(m).alias("mask"), fp.bitwiseAND(F.lit(m)).alias("key")) for m in of]))


def links(prints: DataFrame, radius: int = 3, bucket: int = BUCKET) -> DataFrame:
    """(u, v) links that join all fingerprints within `radius` bits, over a table of distinct `fingerprint`.

    Each bucket gives a star per group it connects, not its pairs. A bucket of more than `bucket`
    fingerprints is divided by covering masks over its free positions, until it fits or no free position
    is left that could hold more than `bucket`, so no task compares an unbounded group.
    """
    of = masks(list(range(BITS)), radius)
    rows = materialise(prints.select("fingerprint", _keys(F.col("fingerprint"), of).alias("t"))
                       .select("fingerprint", "t.mask", "t.key"), "buckets")
    parts = []
    while True:
        full = rows.groupBy("mask", "key").count().filter(F.col("count") > bucket).select("mask", "key")
        full = materialise(full, "full")
        if full.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(full, ["mask", "key"], "left_anti"))
        of = sorted({r.mask for r in full.select("mask").distinct().collect()})  # at most 15, then 225, then 3,375 masks
        sub = F.create_map(*[x for m in of for x in (F.lit(m), F.array(*[F.lit(s) for s in finer(m, radius)]))])
        rows = materialise(
            rows.join(full, ["mask", "key"], "left_semi")
            .select("fingerprint", F.explode(F.element_at(sub, F.col("mask"))).alias("mask"))
            .select("fingerprint", "mask", F.col("fingerprint").bitwiseAND(F.col("mask")).alias("key")), "buckets")
    out = None
    for part in parts:
        found = (part.repartition("mask", "key").sortWithinPartitions("mask", "key", "fingerprint")
                 .mapInArrow(_stars(radius), "u long, v long"))
        out = found if out is None else out.union(found)
    return out.distinct()


def _stars(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, ["mask", "key"]):
            mask, key, fp = (t.column(c).to_numpy() for c in ("mask", "key", "fingerprint"))
            cut = np.flatnonzero(np.r_[True, (mask[1:] != mask[:-1]) | (key[1:] != key[:-1])])
            size = np.diff(np.r_[cut, len(fp)])
            two = cut[size == 2]
            a, b = fp[two], fp[two + 1]
            near = np.bitwise_count((a ^ b).view(np.uint64)) <= radius
            us, vs = [b[near]], [a[near]]
            for lo, n in zip(cut[size > 2], size[size > 2]):
                u, v = _star(fp[lo:lo + n], radius)
                us.append(u)
                vs.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["u", "v"])
    return run


def _star(fp: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint that some chain inside the bucket connects to a smaller-indexed root."""
    left = np.arange(len(fp))
    us, vs = [], []
    while len(left) > 1:
        root, todo, left = left[0], [left[0]], left[1:]
        while todo and len(left):
            near = np.bitwise_count((fp[left] ^ fp[todo.pop()]).view(np.uint64)) <= radius
            hit = left[near]
            todo.extend(hit)
            us.append(fp[hit])
            vs.append(np.full(len(hit), fp[root]))
            left = left[~near]
    empty = np.zeros(0, np.int64)
    return np.concatenate(us) if us else empty, np.concatenate(vs) if vs else empty


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, radius: int = 3,
                    seed: int = 42, bucket: int = BUCKET) -> DataFrame:
    """(_k1, _k2, id, fingerprint long, component, root long): one row per row of docs.

    root is a fingerprint that stands for the component, never null; component is the smallest id reachable over links of at most `radius` differing bits, the row's own
    included; null only if no row of the component has an id. Rows with equal fingerprints meet as one
    before any table is built, so copies cost one row. An empty table gives an empty result.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, k, seed), "prints")
    distinct = prints.groupBy("fingerprint").agg(F.min("id").alias("first"))
    roots = components(links(distinct, radius, bucket))
    member = distinct.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    of = member.groupBy("root").agg(F.min("first").alias("component"))
    named = member.join(of, "root").select("fingerprint", "component", "root")
    return prints.join(named, "fingerprint").select(*KEY, "id", "fingerprint", "component", "root")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """docs without near-duplicates: of each component the row with the smallest id stays, once; a row without an id only where none has one.

    Ties of an id with several texts are broken by the row key. All columns are kept.
    """
    found = near_duplicates(docs, id_col, text_col, **params)
    kept = found.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", *KEY)).alias("m")).select(*[F.col(f"m.{c}").alias(c) for c in KEY])
    keyed = docs.select(F.struct("*").alias("_row"), *row_key(id_col, text_col))
    return keyed.join(kept, KEY, "left_semi").dropDuplicates(KEY).select("_row.*")

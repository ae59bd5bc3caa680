"""Token-id files: documents tokenised in id order and written as patched frame-of-reference blocks.

A block of 256 values is its minimum, the width that holds all but a few of the differences from it, the low bits of
all differences packed at that width, and a list of exceptions with the high bits of the rest. The places of all blocks are
indexed at the end of a file, so a slice of ids decodes only the blocks it touches.

A file, all numbers little-endian:
    magic 8 bytes | blocks of ids | blocks of document ids | blocks of document lengths | places of the blocks, 4 bytes each | footer 64 bytes
    block: minimum int64 | count uint16 | width uint8 | exceptions uint16 | packed uint64 words | positions uint8 | high bits uint64
    footer: ids, documents, documents with a null id, blocks of ids, blocks of documents, partition, number in it (uint64 each), magic
Whatever follows the footer (Spark's text writer adds a line end) is no part of it.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.llm.common import utf8, worker_state
from veilframe.operators.ordering import running
from veilframe.session import small

BLOCK = 256  # values; a position fits one byte
KEPT = 90  # percentile of the bit lengths that a block's width holds
FILE_IDS = 1 << 24  # a file is closed after the document that reaches this
MAGIC = b"PATCHFR1"
FOOTER = 64
HEAD = "<qHBH"
HEAD_SIZE = struct.calcsize(HEAD)
CACHE = 120_000  # words that a Python worker remembers at least; twice as many at most
PART = 1 << 22  # bytes of text that are encoded at a time


def bit_length(v: np.ndarray) -> np.ndarray:
    """Bits of each uint64."""
    if not v.size or v.max() < 1 << 53:
        return np.frexp(v.astype(np.float64))[1].astype(np.uint8)
    high = v >> np.uint64(32)
    return np.where(high != 0, 32 + np.frexp(high.astype(np.float64))[1], np.frexp((v & np.uint64(0xFFFFFFFF)).astype(np.float64))[1]).astype(np.uint8)


def pack_bits(v: np.ndarray, width: int) -> np.ndarray:
    """(blocks, words) of uint64 that hold the low `width` bits of each row's values one after the other."""
    out = np.zeros((v.shape[1] * width // 64, len(v)), np.uint64)
    columns = np.ascontiguousarray(v.T)
    for i, column in enumerate(columns if width else ()):
        word, bit = divmod(i * width, 64)
        out[word] |= column << np.uint64(bit)
        if bit + width > 64:
            out[word + 1] |= column >> np.uint64(64 - bit)
    return np.ascontiguousarray(out.T)


def unpack_bits(words: np.ndarray, width: int, count: int = BLOCK) -> np.ndarray:
    out = np.zeros((count, len(words)), np.uint64)
    rows = np.ascontiguousarray(words.T)
    mask = np.uint64((1 << width) - 1)
    for i in range(count if width else 0):
        word, bit = divmod(i * width, 64)
        v = rows[word] >> np.uint64(bit)
        if bit + width > 64:
            v |= rows[word + 1] << np.uint64(64 - bit)
        np.bitwise_and(v, mask, out=out[i])
    return out.T


def encode_blocks(values: np.ndarray, kept: float = KEPT) -> list[bytes]:
    """Blocks of int64 values; the last one may be shorter and is filled up with its minimum."""
    if not len(values):
        return []
    values = np.asarray(values, np.int64)
    full = -len(values) % BLOCK
    rows = np.concatenate([values, np.full(full, values[len(values) - len(values) % BLOCK:].min() if full else 0)]).reshape(-1, BLOCK)
    low = rows.min(1)
    diff = rows.view(np.uint64) - low.view(np.uint64)[:, None]
    bits = bit_length(diff)
    held = min(BLOCK, max(1, int(np.ceil(BLOCK * kept / 100)))) - 1
    width = np.partition(bits, held, 1)[:, held]
    out: list[bytes] = [b""] * len(rows)
    count = np.full(len(rows), BLOCK)
    count[-1] -= full
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        d = diff[mine]
        over = bits[mine] > w
        words = pack_bits(d & np.uint64((1 << w) - 1), w)
        row, place = np.nonzero(over)
        high = d[row, place] >> np.uint64(w) if w < 64 else d[:0, 0]
        cut = np.searchsorted(row, np.arange(len(mine) + 1)).tolist()
        place, high = place.astype(np.uint8), high.astype("<u8")
        for i, b in enumerate(mine.tolist()):
            a, z = cut[i], cut[i + 1]
            out[b] = b"".join((struct.pack(HEAD, int(low[b]), int(count[b]), w, z - a), words[i].astype("<u8").tobytes(), place[a:z].tobytes(), high[a:z].tobytes()))
    return out


def decode_blocks(data: bytes, places: np.ndarray) -> np.ndarray:
    """int64 values of the blocks that begin at `places`."""
    heads = [struct.unpack_from(HEAD, data, p) for p in places.tolist()]
    rows = np.zeros((len(heads), BLOCK), np.uint64)
    width = np.array([h[2] for h in heads], np.int64)
    for w in np.unique(width).tolist():
        mine = np.flatnonzero(width == w)
        size = BLOCK * w // 64
        if size:
            words = np.stack([np.frombuffer(data, "<u8", size, int(places[b]) + HEAD_SIZE) for b in mine])
            rows[mine] = unpack_bits(words, w)
    for b, (_, _, w, n) in enumerate(heads):
        if n:
            at = int(places[b]) + HEAD_SIZE + BLOCK * w // 8
            rows[b, np.frombuffer(data, np.uint8, n, at)] |= np.frombuffer(data, "<u8", n, at + n) << np.uint64(w)
    if not heads:
        return np.zeros(0, np.int64)
    rows += np.array([h[0] for h in heads], np.int64).view(np.uint64)[:, None]
    flat = rows.view(np.int64).reshape(-1)
    # only the last block of a column is short
    return flat[:len(flat) - BLOCK + heads[-1][1]]


class FileWriter:
    """The bytes of one file; ids are packed as they come, so at most a few blocks of them are held unpacked."""

    def __init__(self, partition: int, number: int):
        self.partition, self.number = partition, number
        self.parts, self.places, self.size = [MAGIC], [], len(MAGIC)
        self.open, self.waiting, self.n = [], 0, 0
        self.docs: list[int | None] = []
        self.lengths: list[int] = []

    def _blocks(self, values: np.ndarray) -> int:
        new = encode_blocks(values)
        for b in new:
            self.places.append(self.size)
            self.size += len(b)
        self.parts += new
        return len(new)

    def add(self, docs: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> None:
        """Documents in order, with their ids one after the other."""
        self.docs += docs
        self.lengths += lengths.tolist()
        self.n += len(ids)
        self.open.append(ids)
        self.waiting += len(ids)
        if self.waiting >= 1 << 18:
            ready = np.concatenate(self.open)
            cut = len(ready) - len(ready) % BLOCK
            self._blocks(ready[:cut])
            self.open, self.waiting = [ready[cut:].copy()], len(ready) - cut

    def close(self) -> bytes:
        self._blocks(np.concatenate([np.zeros(0, np.uint32), *self.open]))
        id_blocks = len(self.places)
        none = sum(d is None for d in self.docs)  # nulls come first
        doc_blocks = self._blocks(np.array([0 if d is None else d for d in self.docs], np.int64))
        self._blocks(np.array(self.lengths, np.int64))
        return b"".join([*self.parts, np.array(self.places, "<u4").tobytes(), struct.pack(
            "<7Q", self.n, len(self.docs), none, id_blocks, doc_blocks, self.partition, self.number), MAGIC])


class FileReader:
    def __init__(self, data: bytes):
        end = data.rfind(MAGIC) + len(MAGIC)
        if end < 2 * len(MAGIC) or not data.startswith(MAGIC):
            raise ValueError("not a token file")
        self.data = data
        self.n, self.documents, none, ids, docs, self.partition, self.number = struct.unpack_from("<7Q", data, end - FOOTER)
        places = np.frombuffer(data, "<u4", ids + 2 * docs, end - FOOTER - 4 * (ids + 2 * docs))
        self.places, self._docs, self._lengths = places[:ids], places[ids:ids + docs], places[ids + docs:]
        self.none = none

    def doc_ids(self) -> list[int | None]:
        return [None] * self.none + decode_blocks(self.data, self._docs)[self.none:].tolist()

    def lengths(self) -> np.ndarray:
        return decode_blocks(self.data, self._lengths)

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """ids start to end of the file, as uint32; only the blocks that hold them are decoded."""
        end = self.n if end is None else min(end, self.n)
        if start >= end:
            return np.zeros(0, np.uint32)
        first = start // BLOCK
        got = decode_blocks(self.data, self.places[first:(end - 1) // BLOCK + 1])
        return got[start - first * BLOCK:end - first * BLOCK].astype(np.uint32)


class Recent:
    """Remembers what `make` gave for the keys asked for last; at least `size` of them, at most twice as many and those of one call.

    make takes a list of keys that are not known and gives a list.
    """

    def __init__(self, size: int, make):
        self.size, self.make = size, make
        self.young, self.old = {}, {}

    def __call__(self, keys: list[str]) -> list[bytes]:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        out = list(map(self.young.get, keys))
        missed = [k for k, v in zip(keys, out) if v is None]
        if not missed:
            return out
        found = dict(zip(missed, map(self.old.get, missed)))
        new = [k for k, v in found.items() if v is None]
        found.update(zip(new, self.make(new)))
        self.young.update(found)
        return [found[k] if v is None else v for k, v in zip(keys, out)]


class TextEncoder:
    """Token ids of whole texts, as little-endian uint32 bytes, equal to Tokenizer.encode without special tokens.

    With a byte-level tokenizer that splits by its own pattern and has no normaliser, no token crosses the place where a visible
    run and the blank or line end before it begin. There, texts are cut; pieces of ASCII and Latin-1 letters are cut on into the words
    of the tokenizer's pattern, all at once from the kinds of their bytes. Of equal words of a batch one goes to the
    merge model, other pieces go through the whole tokenizer; a bounded number is remembered. Texts with an added token, three
    spaces in a row or spaces of other kinds, and all texts of other tokenizers, go through whole.
    """

    #: Spaces that are cut at in no special way, and signs that some versions of Unicode have as spaces.
    ODD = "\x00-\x09\x0b-\x1f\x7f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u3000\ufeff"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                         and not spec.get("normalizer") and not spec.get("truncation") and not spec.get("padding"))
        added = "".join("|" + re.escape(t["content"]) for t in spec.get("added_tokens") or [])
        # a run of two spaces before a visible sign parts into its first one and the rest; longer runs and those at the end do not
        self.irregular = "[ \n]{3}|[ \n]{2}\\z|[" + self.ODD + "]" + added
        self.foreign = "[^\\t\\n\\r -~A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]"
        # byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on
        same = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        rest = iter(range(256, 512))
        letter = [chr(b) if b in same else chr(next(rest)) for b in range(256)]
        self.alphabet = {c: "".join(letter[b] for b in chr(c).encode()) for c in range(0x100)}
        self.words = Recent(CACHE, self._merged)

    def _merged(self, words: list[str]) -> list[bytes]:
        tokenize, ids, ends = self.model.tokenize, [], [0]
        # a tab is in no word that is cut here
        for word in "\t".join(words).translate(self.alphabet).split(self.alphabet[9]) if words else ():
            ids += [t.id for t in tokenize(word)]
            ends.append(4 * len(ids))
        data = np.array(ids, "<u4").tobytes()
        return [data[a:z] for a, z in zip(ends, ends[1:])]

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, how many each has) of a string array without nulls."""
        n = len(texts)
        if not self.by_piece:
            odd = np.ones(n, bool)
        else:
            odd = pc.match_substring_regex(texts, self.irregular).to_numpy(zero_copy_only=False)
        whole = {i: self._whole(texts[i].as_py()) for i in np.flatnonzero(odd).tolist()}
        lengths = np.zeros(n, np.int64)
        for i, ids in whole.items():
            lengths[i] = len(ids)
        regular = np.flatnonzero(~odd)
        if len(regular):
            ids, lengths[regular] = self._regular(texts.take(pa.array(regular)) if whole else texts)
            if not whole:
                return ids, lengths
        starts = np.r_[0, np.cumsum(lengths)]
        out = np.empty(starts[-1], np.uint32)
        if len(regular):
            out[_spread(starts[regular], lengths[regular])] = ids
        for i, w in whole.items():
            out[starts[i]:starts[i + 1]] = w
        return out, lengths

    def _regular(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
        if ends[0] == ends[-1]:
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        data, ends = np.frombuffer(texts.buffers()[2], np.uint8)[ends[0]:ends[-1]], ends - ends[0]
        begin, odd = word_starts(data, ends)
        words = pa.Array.from_buffers(pa.string(), len(begin), [None, pa.py_buffer(np.append(begin, len(data)).astype(np.int32)), pa.py_buffer(data)])
        coded = words.dictionary_encode()
        index, unique = coded.indices.to_numpy(), coded.dictionary
        if odd:
            foreign = pc.match_substring_regex(unique, self.foreign)
            known = iter(self.words(_strings(unique.filter(pc.invert(foreign)))))
            ids = [self._whole(w.as_py()).astype("<u4").tobytes() if f else next(known) for w, f in zip(unique, foreign.to_pylist())]
        else:
            ids = self.words(_strings(unique))
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        count = size[index]
        out = flat[_spread((np.cumsum(size) - size)[index], count)]
        return out, np.diff(np.r_[0, np.cumsum(count)][np.searchsorted(begin, ends)])


_BLANK, _LINE, _LETTER, _DIGIT, _SIGN, _FOREIGN = range(6)
_KINDS = np.array([_BLANK if c == " " else _LINE if c == "\n" else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN
                   for c in map(chr, range(128))] + [_FOREIGN] * 128, np.uint8)


def _strings(texts: pa.Array) -> list[str]:
    """to_pylist(), made at once."""
    return texts.to_numpy(zero_copy_only=False).tolist()


def word_starts(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, bool]:
    """Where words begin in the UTF-8 bytes of texts that lie one behind the other, and whether a piece was left whole.

    ends are 0 and the end of each text. Words are those of the byte-level pattern `'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|
    \\s+(?!\\S)|\\s+`, for texts whose only spaces are blanks and line ends, at most two in a row and one at the end. Pieces between
    spaces that hold other letters or signs than ASCII and the letters of Latin-1 stay whole.
    """
    n = len(data)
    kind = _KINDS[data]
    lead = np.flatnonzero(data == 0xC3)  # U+00C0 to U+00FF, of which the signs of multiplication and division are no letters
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    first = np.zeros(n + 1, bool)
    first[ends] = True
    space = kind <= _LINE
    cut = np.ones(n + 1, bool)
    np.not_equal(kind[1:], kind[:-1], out=cut[1:-1])
    cut[:-1] |= space
    cut[1:-1] &= (kind[:-1] != _BLANK) | space[1:]  # a blank goes with the sign behind it
    cut |= first
    quote = np.flatnonzero((data == 0x27) & cut[:-1])
    if len(quote):
        after = np.r_[data, 0, 0]
        one, two = after[quote + 1], after[quote + 2]
        size = 2 * np.isin(one, list(b"stmd"))
        size[((one == 0x72) | (one == 0x76)) & (two == 0x65) | (one == 0x6C) & (two == 0x6C)] = 3
        size[first[quote + 1]] = 0
        size[(size == 3) & first[np.minimum(quote + 2, n)]] = 0
        quote, size = quote[size > 0], size[size > 0]
        cut[quote + 1] = False
        cut[quote + size] = True
    foreign = kind == _FOREIGN
    odd = bool(foreign.any())
    if odd:
        piece = np.flatnonzero(space | first[:-1])
        whole = np.repeat(np.logical_or.reduceat(foreign, piece), np.diff(np.r_[piece, n]))
        whole[piece] = False
        cut[:-1] &= ~whole
    return np.flatnonzero(cut[:-1]), odd


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (counts[0] of them), starts[1], ..."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    kind = np.int32 if total + int(starts.max(initial=0)) < 1 << 31 else np.int64
    out = np.repeat((starts - (ends - counts)).astype(kind), counts)
    out += np.arange(total, dtype=kind)
    return out


def encoder(path: str) -> TextEncoder:
    held = worker_state().setdefault("token_files", {})
    if path not in held:
        held[path] = TextEncoder(path)
    return held[path]


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int | None = 2, id_col: str = "doc_id", text_col: str = "text",
                 file_ids: int = FILE_IDS) -> None:
    """Token files of docs under `path`, in ascending order of the integer id.

    One range exchange of the texts; each of its partitions is tokenised in order and gives files of about file_ids ids, a
    document never split over two. Files are published by Spark's own writer, so a task that is run again leaves no
    second copy. Null ids come first, a null text is empty and has the end id alone; rows that repeat an id all
    stay, in the order of their texts' hashes. An empty table gives no file.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), utf8(text_col).alias("text")).withColumn("tie", F.xxhash64("text")).withColumn(
        "row", F.monotonically_increasing_id())
    placed = rows.repartitionByRange("id", "tie", "row").sortWithinPartitions("id", "tie", "row").select("id", "text")

    def encoded(batch: pa.RecordBatch, enc: TextEncoder) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
        """(document ids, lengths, ids) of a few MB of texts at a time, the end id behind every document."""
        ids, texts = batch.column("id").to_pylist(), batch.column("text")
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(ids):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART, "right")))
            part = texts.slice(lo, hi - lo)
            try:
                part = part.cast(pa.string())
            except pa.ArrowInvalid:
                part = pa.array([t.as_py().decode("utf-8", "replace") for t in part], pa.string())
            flat, counts = enc.encode(part)
            if end_id is not None:
                flat, counts = np.insert(flat, np.cumsum(counts), end_id), counts + 1
            yield ids[lo:hi], counts, flat
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, partition, number, out = encoder(tokenizer), TaskContext.get().partitionId(), 0, None
        for batch in batches:
            for docs, counts, flat in encoded(batch, enc):
                ends, lo = np.cumsum(counts), 0
                while lo < len(docs):
                    if out is None:
                        out = FileWriter(partition, number)
                    base = int(ends[lo - 1]) if lo else 0
                    hi = min(len(docs), int(np.searchsorted(ends, base + file_ids - out.n)) + 1)
                    out.add(docs[lo:hi], counts[lo:hi], flat[base:int(ends[hi - 1])])
                    lo = hi
                    if out.n >= file_ids:
                        yield pa.RecordBatch.from_arrays([pa.array([out.close()], pa.binary())], names=["file"])
                        out, number = None, number + 1
        if out is not None:
            yield pa.RecordBatch.from_arrays([pa.array([out.close()], pa.binary())], names=["file"])

    files = placed.mapInArrow(run, "file binary")
    # the text writer copies a string's bytes as they are; one row is one file
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(content, partition, number, n, documents) of all files; columns that are not used are not computed."""
    # the line end of the text writer lies behind the footer
    foot = F.substring("content", -FOOTER - 1, FOOTER)
    number = lambda i: F.conv(F.concat(*[F.hex(F.substring(foot, 8 * i + b, 1)) for b in range(8, 0, -1)]), 16, 10).cast("long")
    return spark.read.format("binaryFile").load(path).filter("length > 0").select(
        "content", number(5).alias("partition"), number(6).alias("number"), number(0).alias("n"), number(1).alias("documents"))


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """(partition, number, n, documents, start): one row per file, in order; start is the ids of all files before it.

    Only footers leave the scan, and they are read without Python.
    """
    return running(_files(spark, path).drop("content"), ["partition", "number"], {"start": ("sum", "n")}, inclusive=False)


def read_documents(spark: SparkSession, path: str, checksums: bool = False) -> DataFrame:
    """(id, start long, n_tokens long, ids binary), read back from the files; with checksums ids_crc32 (long) in the place of ids.

    start counts the ids of all documents before it; ids are little-endian unsigned 32-bit, and so is what the crc32 is of.
    """
    name, kind = ("ids_crc32", pa.int64()) if checksums else ("ids", pa.binary())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                file = FileReader(content.as_py())
                docs, ends = file.doc_ids(), np.cumsum(file.lengths())
                lo = 0
                while lo < len(docs):  # a few MB at a time
                    base = int(ends[lo - 1]) if lo else 0
                    hi = max(lo + 1, int(np.searchsorted(ends, base + (1 << 20), "right")))
                    data = memoryview(file.ids(base, int(ends[hi - 1])).astype("<u4").tobytes())
                    at = np.r_[base, ends[lo:hi]]
                    ids = [data[4 * (a - base):4 * (z - base)] for a, z in zip(at[:-1].tolist(), at[1:].tolist())]
                    k = hi - lo
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([file.partition] * k, pa.int64()), pa.array([file.number] * k, pa.int64()), pa.array(docs[lo:hi], pa.int64()),
                         pa.array(at[:-1], pa.int64()), pa.array(np.diff(at), pa.int64()), pa.array(map(zlib.crc32, ids) if checksums else ids, kind)],
                        names=["partition", "number", "id", "within", "n_tokens", name])
                    lo = hi

    found = _files(spark, path).select("content").mapInArrow(
        run, f"partition long, number long, id long, within long, n_tokens long, {name} {'long' if checksums else 'binary'}")
    starts = manifest(spark, path).select("partition", "number", F.col("start").alias("_start"))
    return found.join(small(starts), ["partition", "number"]).select("id", (F.col("_start") + F.col("within")).alias("start"), "n_tokens", name)


def read_slices(spark: SparkSession, path: str, slices: DataFrame) -> DataFrame:
    """(start, length, ids binary) for every distinct (start long, length long): ids start to start + length of the whole corpus.

    Files decode only the blocks that a slice touches. Slices reach files by steps of FILE_IDS, as an equality. A slice
    over several files is put together in order; what lies outside the corpus is left out, and nulls or a
    length below 1 give no row.
    """
    files = manifest(spark, path).filter("n > 0")
    wanted = slices.select(F.col("start").cast("long").alias("start"), F.col("length").cast("long").alias("length")).filter("start >= 0 AND length > 0").distinct()
    steps = lambda start, n: F.explode(F.sequence(F.floor(start / FILE_IDS), F.floor((start + n - 1) / FILE_IDS)))
    lo, hi = F.greatest("s.start", "f.start"), F.least(F.col("s.start") + F.col("s.length"), F.col("f.start") + F.col("f.n"))
    parts = (wanted.withColumn("_s", steps(F.col("start"), F.col("length"))).alias("s")
             .join(files.withColumn("_s", steps(F.col("start"), F.col("n"))).alias("f"), "_s").filter(lo < hi)
             .select("partition", "number", "s.start", "s.length", (lo - F.col("f.start")).alias("lo"), (hi - F.col("f.start")).alias("hi")).distinct())
    per_file = parts.groupBy("partition", "number").agg(F.collect_list(F.struct("start", "length", "lo", "hi")).alias("want"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, want in zip(batch.column("content"), batch.column("want")):
                file = FileReader(content.as_py())
                for w in want.as_py():
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x]) for x in (w["start"], w["length"], file.partition, file.number)]
                        + [pa.array([file.ids(w["lo"], w["hi"]).astype("<u4").tobytes()], pa.binary())],
                        names=["start", "length", "partition", "number", "ids"])

    got = _files(spark, path).select("content", "partition", "number").join(small(per_file), ["partition", "number"]).select(
        "content", "want").mapInArrow(run, "start long, length long, partition long, number long, ids binary")
    return got.groupBy("start", "length").agg(F.array_sort(F.collect_list(F.struct("partition", "number", "ids"))).alias("p")).select(
        "start", "length", F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))

"""A Spark data source of byte ranges of text files in a folder that all workers see under the same path.

Unlike Spark's own text reader it lists names that begin with _ or ., follows no links and gives a row for a file without bytes.
Files are read in ranges: a range holds the physical lines that begin in it, so the rows are the same however files are cut.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from fnmatch import fnmatchcase

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES = 64 << 20
CHUNK = 1 << 20  # a reader holds the lines, the records and the batch of so many bytes
BOM = b"\xef\xbb\xbf"


def local_path(folder: str) -> str | None:
    """The folder as a path of the file system, None if only Spark can reach it."""
    if folder.startswith("file:"):
        return "/" + folder.removeprefix("file:").lstrip("/")
    return None if "://" in folder or folder.startswith(("hdfs:", "s3")) else os.path.abspath(folder)


def walk(root: str, glob: str, exclude: list[str] = ()) -> list[tuple[str, int, int]]:
    """(path, size, modification time in ns) of all files below root whose name fits, sorted; no links are followed.

    exclude are resolved folders. Folders of a level are listed side by side.
    """
    skipped = {os.path.realpath(e) for e in exclude}
    found, level = [], [] if os.path.realpath(root) in skipped else [root]

    def listed(folder: str) -> tuple[list[str], list[tuple[str, int, int]]]:
        folders, files = [], []
        with os.scandir(folder) as entries:
            for e in entries:
                if e.is_symlink():
                    continue
                if e.is_dir():
                    if not skipped or os.path.realpath(e.path) not in skipped:
                        folders.append(e.path)
                elif e.is_file() and fnmatchcase(e.name, glob):
                    stat = e.stat()
                    files.append((e.path, stat.st_size, stat.st_mtime_ns))
        return folders, files

    with ThreadPoolExecutor(16) as pool:
        while level:
            below = []
            for folders, files in pool.map(listed, level):
                below += folders
                found += files
            level = below
    return sorted(found)


class Ranges(InputPartition):
    def __init__(self, ranges: list[tuple[str, int, int, int]]):
        self.ranges = ranges  # (path, size, from, to)


def plan(files: list[tuple[str, int, int]], split: int, most: int = 2_000) -> list[Ranges]:
    """Ranges of at most `split` bytes, small files together up to that size and `most` files."""
    out, held, size = [], [], 0
    for path, n, _ in files:
        for lo in range(0, max(n, 1), split):
            hi = min(n, lo + split)
            if held and (size + hi - lo > split or len(held) >= most):
                out.append(Ranges(held))
                held, size = [], 0
            held.append((path, n, lo, hi))
            size += hi - lo
    return [*out, Ranges(held)] if held else out


def physical_lines(path: str, lo: int, hi: int, longest: int | None = None) -> Iterator[tuple[list[bytes], bool]]:
    """Lists of the lines that begin in lo..hi, cut at \\n only, and whether the last of a list has no \\n; a byte order mark is left out.

    A line of more than `longest` bytes ends the reading with one list [line as far as read] twice as long at least.
    """
    with open(path, "rb") as f:
        f.seek(max(0, lo - 1))
        if lo:  # the line that the byte before belongs to is not ours, unless it ends there
            while (part := f.readline(CHUNK)) and not part.endswith(b"\n"):
                pass
        start = f.tell()  # of the line that is being read
        ahead = 0
        if not lo:
            ahead = 3 if f.read(3) == BOM else 0
            f.seek(ahead)
        rest: list[bytes] = []
        while start < hi:
            data = f.read(CHUNK)
            if not data:
                if rest:
                    yield [b"".join(rest)], True
                return
            first, *others = data.split(b"\n")
            rest.append(first)
            if others:
                lines = []
                for p in (b"".join(rest), *others[:-1]):
                    if start >= hi:
                        break
                    lines.append(p)
                    start += len(p) + 1 + ahead
                    ahead = 0
                rest = [others[-1]] if others[-1] else []
                yield lines, False
            if longest is not None and start < hi and sum(map(len, rest)) > longest:
                yield [b"".join(rest)], True
                return


class TextRanges(DataSource):
    """Options: path, glob, exclude (lines), split (bytes), max_chars, kind = lines or records.

    lines: (file, block, size, value binary), a physical line per row. records: (file, block, seq, text, eol, error): a row per
    record, which ends at \\n, \\r\\n or a lone \\r; eol is what ended it. A file without bytes, and one that cannot be read on, has a row
    without text, in the second case with the error's class name.
    """

    @classmethod
    def name(cls) -> str:
        return "text_ranges"

    def schema(self) -> str:
        if self.options.get("kind", "lines") == "lines":
            return "file string, block long, size long, value binary"
        return "file string, block long, seq long, text string, eol string, error string"

    def reader(self, schema) -> RangeReader:
        return RangeReader(self.options)


class RangeReader(DataSourceReader):
    def __init__(self, options):
        self.options = dict(options)
        self.max_chars = int(options["max_chars"]) if options.get("max_chars") else None

    def partitions(self) -> list[Ranges]:
        o = self.options
        if o.get("listed"):  # a chosen list instead of a folder, written as text
            files = sorted((f, os.path.getsize(f), 0) for f in listed(o["listed"]) if os.path.exists(f))
        else:
            files = walk(o["path"], o.get("glob", "*.[tT][xX][tT]"), [x for x in o.get("exclude", "").split("\n") if x])
        return plan(files, int(o.get("split", SPLIT_BYTES))) or [Ranges([])]

    def read(self, partition: Ranges) -> Iterator[pa.RecordBatch]:
        one = self._lines if self.options.get("kind", "lines") == "lines" else self._records
        for r in partition.ranges:
            yield from one(*r)

    def _lines(self, path: str, size: int, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        for lines, _ in physical_lines(path, lo, hi):
            n = len(lines)
            yield pa.RecordBatch.from_arrays(
                [pa.array(["file:" + path] * n), pa.array([lo] * n, pa.int64()), pa.array([size] * n, pa.int64()), pa.array(lines, pa.binary())],
                names=["file", "block", "size", "value"])

    def _records(self, path: str, size: int, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
        seq = 0
        none = [(None, None, None)]
        longest = 4 * self.max_chars + 8 if self.max_chars is not None else None
        try:
            for lines, unended in physical_lines(path, lo, hi, longest):
                rows = []
                for i, line in enumerate(lines):
                    last = unended and i == len(lines) - 1
                    rows += cut_records(line.decode("utf-8"), "" if last else "\n")
                if self.max_chars is not None and any(len(t) + len(e) > self.max_chars for t, e, _ in rows):
                    rows = [(None, None, "RecordTooLong")]
                yield self._batch(path, lo, seq, rows)
                seq += len(rows)
                if rows[-1][2]:
                    return
        except (UnicodeDecodeError, OSError) as e:
            yield self._batch(path, lo, seq, [(None, None, type(e).__name__)])
            return
        if not seq and not lo:
            yield self._batch(path, lo, 0, none)

    def _batch(self, path: str, lo: int, seq: int, rows: list[tuple]) -> pa.RecordBatch:
        n = len(rows)
        text, eol, error = (pa.array(c, pa.string()) for c in zip(*rows))
        return pa.RecordBatch.from_arrays(
            [pa.array([path] * n), pa.array([lo] * n, pa.int64()), pa.array(range(seq, seq + n), pa.int64()), text, eol, error],
            names=["file", "block", "seq", "text", "eol", "error"])


def cut_records(line: str, end: str) -> list[tuple[str, str, None]]:
    """(text, terminator, no error) of the records of a physical line that ended with `end`."""
    if "\r" not in line:
        return [(line, end, None)]
    *parts, last = line.split("\r")
    if not last and end:
        return [*[(p, "\r", None) for p in parts[:-1]], (parts[-1], "\r\n", None)]
    return [*[(p, "\r", None) for p in parts], *([(last, end, None)] if last or end else [])]


def listed(folder: str) -> Iterator[str]:
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(f"{folder}/{name}", encoding="utf-8") as f:
                yield from (line.rstrip("\n") for line in f)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TextRanges)


def read(spark: SparkSession, root: str, kind: str, glob: str, exclude=(), max_chars: int | None = None, split: int = SPLIT_BYTES,
         listed: str | None = None) -> DataFrame:
    """Rows of TextRanges below root, or of the files whose paths are written in the folder `listed`."""
    register(spark)
    options = {"path": root, "kind": kind, "glob": glob, "exclude": "\n".join(exclude), "split": split}
    if max_chars is not None:
        options["max_chars"] = max_chars
    if listed is not None:
        options["listed"] = listed
    return spark.read.format("text_ranges").options(**options).load()

"""Publishing text files under their inputs' relative paths, byte for byte, from rows in reading order.

Tasks write one staged object per range of an input; Spark keeps those of the attempts that count. When the job has committed, an
input whose ranges are all sound is put together at known offsets, in parallel, and takes its final name in one step. Others
leave nothing, and what was published before stays.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

SEGMENT = ("file string, block long, staged string, bytes long, records long, blank_records long, chars long, max_record_chars long, "
           "seconds double, error_type string")
MANIFEST = ("input string, output string, status string, records long, blank_records long, chars long, max_record_chars long, "
            "seconds double, records_per_second double, error_type string")
_ROWS = 1000  # written at a time


class Staged(WriterCommitMessage):
    def __init__(self, segments: list[dict]):
        self.segments = segments


class StagedText(DataSource):
    """Sink of rows (file, block, out, eol, chars, blank, error) in reading order; option path is the staging folder.

    A row with an error fails its range. Null out and eol stand for a file without bytes.
    """

    @classmethod
    def name(cls) -> str:
        return "staged_text"

    def writer(self, schema, overwrite) -> StageWriter:
        return StageWriter(self.options["path"])


class StageWriter(DataSourceArrowWriter):
    def __init__(self, folder: str):
        self.folder = folder

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Segments of consecutive rows of one range, each in a file of its own."""
        done: list[dict] = []
        stream, now, key, began = None, None, None, time.perf_counter()
        try:
            for batch in iterator:
                for at, part in _runs(batch):
                    if at != key:
                        if stream is not None:
                            stream.close()
                            now["seconds"] = time.perf_counter() - began
                            began = time.perf_counter()
                        key = at
                        now = {"file": at[0], "block": at[1], "staged": f"{self.folder}/{uuid.uuid4().hex}", "bytes": 0, "records": 0,
                               "blank_records": 0, "chars": 0, "max_record_chars": 0, "error_type": None}
                        stream = open(now["staged"], "wb")
                        done.append(now)
                    _add(now, stream, part)
            if stream is not None:
                now["seconds"] = time.perf_counter() - began
        finally:
            if stream is not None:
                stream.close()
        return Staged(done)

    def commit(self, messages: list[Staged | None]) -> None:
        with open(f"{self.folder}/segments.json", "w", encoding="utf-8") as f:
            for m in messages:
                for s in m.segments if m else ():
                    f.write(json.dumps(s) + "\n")

    def abort(self, messages: list[Staged | None]) -> None:
        for m in messages:
            for s in m.segments if m else ():
                if os.path.exists(s["staged"]):
                    os.unlink(s["staged"])


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    files, blocks, n = batch.column("file"), batch.column("block"), batch.num_rows
    new = pc.or_(pc.not_equal(files[1:], files[:-1]), pc.not_equal(blocks[1:], blocks[:-1])) if n > 1 else pa.array([], pa.bool_())
    cuts = [*pc.indices_nonzero(new).to_pylist(), n - 1] if n else []
    for lo, last in zip([0, *(c + 1 for c in cuts)], cuts):
        yield (files[lo].as_py(), blocks[lo].as_py()), batch.slice(lo, last + 1 - lo)


def _add(segment: dict, stream, rows: pa.RecordBatch) -> None:
    errors = rows.column("error").drop_null()
    if len(errors):
        segment["error_type"] = segment["error_type"] or errors[0].as_py()
    real = rows.filter(pc.is_valid(rows.column("eol")))
    if not real.num_rows:
        return
    segment["records"] += real.num_rows
    segment["blank_records"] += pc.sum(real.column("blank")).as_py() or 0
    segment["chars"] += pc.sum(real.column("chars")).as_py()
    segment["max_record_chars"] = max(segment["max_record_chars"], pc.max(real.column("chars")).as_py())
    if not segment["error_type"]:
        for lo in range(0, real.num_rows, _ROWS):
            part = real.slice(lo, _ROWS)
            data = "".join(x for pair in zip(part.column("out").to_pylist(), part.column("eol").to_pylist()) for x in pair).encode()
            stream.write(data)
            segment["bytes"] += len(data)


def stage(rows: DataFrame, out: str) -> str:
    """Write rows (see StagedText) into a new staging folder below out; its path."""
    folder = f"{out}/.staging-{uuid.uuid4().hex}"
    os.makedirs(folder)
    rows.sparkSession.dataSource.register(StagedText)
    columns = [F.col("file").cast("string"), F.col("block").cast("long"), F.col("out").cast("string"), F.col("eol").cast("string"),
               F.col("chars").cast("long"), F.col("blank").cast("boolean"), F.col("error").cast("string")]
    try:
        rows.select(*[c.alias(n) for c, n in zip(columns, ("file", "block", "out", "eol", "chars", "blank", "error"))]) \
            .write.format("staged_text").mode("append").save(folder)
    except Exception:
        clear(folder)
        raise
    return folder


def publish(spark: SparkSession, staged: str, root: str, out: str) -> DataFrame:
    """Give every sound input its output under the same relative path; a manifest row per input of the staging folder.

    Segments are copied to their offsets by as many tasks as there are; the last step per file is a rename, which may be repeated.
    """
    segments = spark.read.schema(SEGMENT).json(f"file://{staged}/segments.json")
    of_file = Window.partitionBy("file")
    placed = segments.withColumns({
        "offset": F.coalesce(F.sum("bytes").over(of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "parts": F.count(F.lit(1)).over(of_file), "failed": F.max("error_type").over(of_file)})

    def target(path: str) -> str:
        return os.path.join(out, os.path.relpath(path, root))

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                temporary = f"{staged}/{r['block0']}.whole"
                done = os.open(temporary, os.O_CREAT | os.O_WRONLY, 0o644)
                try:
                    at = r["offset"]
                    with open(r["staged"], "rb") as f:
                        while data := f.read(8 << 20):
                            os.pwrite(done, data, at)
                            at += len(data)
                finally:
                    os.close(done)
            yield batch.select(["file"])

    several = placed.filter("parts > 1 AND failed IS NULL").withColumn("block0", F.sha1("file"))
    several.mapInArrow(copy, "file string").write.format("noop").mode("overwrite").save()

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            outputs = []
            for r in batch.to_pylist():
                dest = target(r["file"])
                outputs.append(dest)
                if r["error_type"] is None:
                    os.makedirs(os.path.dirname(dest), exist_ok=True)
                    whole = r["staged"] if r["parts"] == 1 else f"{staged}/{r['name']}.whole"
                    try:
                        os.replace(whole, dest)
                    except FileNotFoundError:  # an attempt before this one has done it
                        if not os.path.exists(dest):
                            raise
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in batch.schema.names] + [pa.array(outputs, pa.string())],
                                             names=[*batch.schema.names, "output"])

    files = segments.groupBy("file").agg(
        F.count(F.lit(1)).alias("parts"), F.max("error_type").alias("error_type"), F.min("staged").alias("staged"),
        *[F.sum(c).alias(c) for c in ("records", "blank_records", "chars", "seconds")],
        F.max("max_record_chars").alias("max_record_chars")).withColumn("name", F.sha1("file"))
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in files.schema] + ["output string"])
    done = files.mapInArrow(rename, schema)
    ok = F.col("error_type").isNull()
    return done.select(
        F.col("file").alias("input"), "output", F.when(ok, "ok").otherwise("failed").alias("status"),
        *[F.when(ok, F.col(c)).alias(c) for c in ("records", "blank_records", "chars", "max_record_chars")], "seconds",
        F.when(ok & (F.col("seconds") > 0), F.col("records") / F.col("seconds")).alias("records_per_second"), "error_type")


def clear(staged: str) -> None:
    """Take away what is left of a staging folder: segments that were copied or belong to failed inputs."""
    for name in os.listdir(staged):
        os.unlink(f"{staged}/{name}")
    os.rmdir(staged)


def collisions(spark: SparkSession, files: DataFrame, root: str, out: str, protected: list[str] = ()) -> DataFrame:
    """(output, reason) of planned outputs that would overwrite an input or a protected file, leave the output folder or meet
    another output, links and hard links resolved.

    files is (file, size, modified) of inputs below root; every path is looked at by the task that has its row.
    """
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = os.path.realpath(out)
        key = lambda s: f"{s.st_dev}:{s.st_ino}" if s else None
        for batch in batches:
            rows = []
            for path in batch.column("file").to_pylist():
                dest = os.path.join(out, os.path.relpath(path, root)) if path not in guarded else None
                real = os.path.realpath(dest) if dest else None
                own = os.stat(path) if os.path.exists(path) else None
                there = os.stat(dest) if dest and os.path.exists(dest) else None
                rows.append((os.path.realpath(path), key(own), dest, real, key(there), bool(dest) and not real.startswith(base + "/")))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.string()] * 5 + [pa.bool_()])],
                                                 names=["file", "own", "output", "real", "there", "outside"])

    guarded = frozenset(os.path.abspath(p) for p in protected)
    kept = spark.createDataFrame([(p,) for p in sorted(guarded)], "file string")
    seen = files.select("file").union(kept).mapInArrow(
        look, "file string, own string, output string, real string, there string, outside boolean")
    planned = seen.filter("output IS NOT NULL")
    twice = planned.groupBy("real").agg(F.count(F.lit(1)).alias("n"), F.min("output").alias("output")).filter("n > 1").select(
        "output", F.lit("second output").alias("reason"))
    away = planned.filter("outside").select("output", F.lit("outside the output folder").alias("reason"))
    names = planned.join(seen.select(F.col("file").alias("real")).distinct(), "real", "left_semi").select("output")
    nodes = planned.join(seen.filter("own IS NOT NULL").select(F.col("own").alias("there")).distinct(), "there", "left_semi").select("output")
    over = names.union(nodes).distinct().select("output", F.lit("input or protected file").alias("reason"))
    return twice.union(away).union(over)

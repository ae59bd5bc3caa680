"""Line-oriented text files: discovery, splittable scan with line numbers and terminators, sink,
manifest, input signatures and output guards.
"""

from __future__ import annotations

import os
import posixpath
from fnmatch import fnmatchcase
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from veilframe.functions.detect import is_blank
from veilframe.sources import publish, ranges

TXT = "*.[tT][xX][tT]"


def _files(spark: SparkSession, fmt: str, glob: str):
    return (spark.read.format(fmt).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", glob))


def _resolved(spark: SparkSession, folder: str):
    """A folder's file system and its path as the readers print it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs, fs.makeQualified(path)


def not_under(spark: SparkSession, path: Column, root, folders) -> Column:
    """Path lies outside the given folders (output folder, excluded folders), named in full or from a root on."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")  # noqa: E731  readers print local paths in two ways
    roots = [root] if isinstance(root, str) else list(root)
    keep = F.lit(True)
    for folder in folders:
        full = [folder] if folder.startswith("/") or ":/" in folder else [posixpath.join(r, folder) for r in roots]
        for f in full:
            keep = keep & ~F.startswith(plain(path), F.lit(_resolved(spark, f)[1].toString().rstrip("/") + "/"))
    return keep


def resolved(folder: str) -> str:
    """A folder all workers see, as its resolved path."""
    path = ranges.local_path(folder)
    if path is None:
        raise ValueError(f"{folder} is no path that workers can open; mount it")
    return os.path.realpath(path)


def discover(spark: SparkSession, root: str, exclude=(), glob: str = TXT) -> DataFrame:
    """Input signature of every text file below root: path, size, modification time.

    Lists files without bytes and names that start with _ or . too, and follows no links. Folders are listed side by side, a
    level at a time; a store that only Spark can reach is listed through its file system.
    """
    path = ranges.local_path(root)
    if path is not None:
        skip = [f for e in exclude for f in [e if e.startswith("/") else ranges.local_path(e) if ":/" in e else os.path.join(path, e)]]
        rows = [("file:" + f, n, ns // 1000) for f, n, ns in ranges.walk(os.path.realpath(path), glob, skip)]
        return spark.createDataFrame(rows, "file string, size long, modified long").withColumn("modified", F.timestamp_micros("modified"))
    fs, path = _resolved(spark, root)
    found, rows = fs.listFiles(path, True), []
    while found.hasNext():
        f = found.next()
        if fnmatchcase(f.getPath().getName(), glob) and not f.isSymlink():
            rows.append((f.getPath().toString(), f.getLen(), f.getModificationTime()))
    meta = spark.createDataFrame(rows, "file string, size long, modified long").withColumn("modified", F.timestamp_millis("modified"))
    return meta.where(not_under(spark, F.col("file"), root, exclude))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of two signatures that differ, with the side they come from."""
    return (before.exceptAll(after).withColumn("side", F.lit("before"))
            .unionByName(after.exceptAll(before).withColumn("side", F.lit("after"))))


def pending(inputs: DataFrame, manifest: DataFrame, key: str = "file") -> DataFrame:
    """Inputs without a finished, non-empty output."""
    done = manifest.where((F.col("status") == "ok") & (F.col("chars") > 0)).select(key).distinct()
    return inputs.join(done, key, "left_anti")


def check_outputs(inputs: DataFrame, dest: Column, protected: list[str]) -> DataFrame:
    """Destinations that would overwrite an input, a protected path or one another."""
    planned = inputs.select("file", dest.alias("dest"))
    clash = planned.groupBy("dest").agg(F.count("*").alias("writers"))
    aliased = inputs.select(F.col("file").alias("dest"), F.lit(True).alias("is_input")).distinct()
    return (clash.join(aliased, "dest", "left")
            .withColumn("reason", F.when(F.col("writers") > 1, "second output")
                        .when(F.col("is_input"), "input")
                        .when(F.col("dest").isin(protected) if protected else F.lit(False), "protected"))
            .where("reason is not null").select("dest", "reason"))


def raw_lines(reader) -> DataFrame:
    """Lines cut at \\n only, so that files stay splittable, with their file block.

    `reader` is spark.read or spark.readStream with a `text` source.
    """
    return reader.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"), "value")


def read_raw(spark: SparkSession, root, exclude=(), glob: str = TXT) -> DataFrame:
    """Physical lines of all files below root (or several roots): of folders the workers can open by their byte ranges, of others by
    Spark's reader, which passes over names that begin with _ or . ."""
    roots = [root] if isinstance(root, str) else list(root)
    if all(ranges.local_path(r) for r in roots):
        parts = []
        for r in roots:
            path = os.path.realpath(ranges.local_path(r))
            skip = [e if e.startswith("/") else ranges.local_path(e) if ":/" in e else os.path.join(path, e) for e in exclude]
            parts.append(ranges.read(spark, path, "lines", glob, skip).withColumn("value", F.col("value").cast("string")))
        return reduce(DataFrame.union, parts)
    lines = raw_lines(_files(spark, "text", glob).option("lineSep", "\n").load(root))
    return lines.where(not_under(spark, F.col("file"), root, exclude))


def records(raw: DataFrame, max_chars: int | None = None) -> DataFrame:
    """One row per record: file, line_no (from 1), text, eol, failed, error.

    Records end at \\n, \\r\\n or a lone \\r. Line numbers need no sort: rows of a file block are
    numbered in reading order and each block adds the counts of the blocks before it. Whether the
    last line is terminated follows from the file size. `failed` marks files holding a record
    longer than max_chars, terminator included, or bytes that are not UTF-8; `error` says which.
    """
    cut = raw.select("file", "block", "size", F.octet_length("value").alias("_bytes"), (~F.is_valid_utf8("value")).alias("_bad"),
                     F.split("value", r"(?<=\r)(?!\z)", -1).alias("_all"))
    pieces = (cut.select("file", "block", "size", "_bytes", "_bad", F.size("_all").alias("_n"),
                         F.posexplode("_all").alias("_piece", "_text"))
              .withColumn("_mid", F.monotonically_increasing_id())
              .withColumn("_last", F.col("_piece") == F.col("_n") - 1))
    length = F.length("_text") + F.col("_last").cast("int")
    limit = F.lit(max_chars if max_chars is not None else 2**60)
    blocks = pieces.groupBy("file", "block").agg(
        F.first("size").alias("size"), F.count("*").alias("n"), F.min("_mid").alias("first"),
        F.sum(F.when(F.col("_last"), F.col("_bytes") + 1).otherwise(0)).alias("bytes"),
        F.count_if(length > limit).alias("over"), F.count_if("_bad").alias("bad"), F.max_by(length, "_mid").alias("last_len"))
    of_file = Window.partitionBy("file")
    earlier = of_file.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    missing = F.col("size") - F.sum("bytes").over(of_file)
    placed = (blocks
              .withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
              .withColumn("total", F.sum("n").over(of_file))
              # 0 or 3: terminated (3 with a byte order mark); -1 or 2: last line unterminated
              .withColumn("open_end", missing.isin(-1, 2))
              .withColumn("end_len", F.max_by("last_len", "block").over(of_file))
              .withColumn("n_over", F.sum("over").over(of_file))
              .withColumn("error", F.when(F.sum("bad").over(of_file) > 0, "UnicodeDecodeError").when(F.col("n_over") > F.when(
                  F.col("open_end") & (F.col("end_len") == limit + 1), 1).otherwise(0), "RecordTooLong"))
              .withColumn("failed", F.col("error").isNotNull())
              .select("file", "block", "first", "before", "total", "open_end", "failed", "error"))
    rows = (pieces.drop("size", "_bytes", "_bad", "_n").join(placed, ["file", "block"])
            .withColumn("line_no", F.col("before") + F.col("_mid") - F.col("first") + 1))
    at_end = F.col("open_end") & (F.col("line_no") == F.col("total"))
    cr = F.col("_text").endswith("\r")
    eol = (F.when(cr & (~F.col("_last") | at_end), "\r").when(cr, "\r\n")
           .when(at_end, "").otherwise("\n"))
    return rows.select("file", "line_no", F.regexp_replace("_text", r"\r\z", "").alias("text"),
                       eol.alias("eol"), "failed", "error")


def scan(spark: SparkSession, root, exclude=(), max_chars: int | None = None,
         glob: str = TXT) -> DataFrame:
    return records(read_raw(spark, root, exclude, glob), max_chars)


def summary(lines: DataFrame, text: str = "text", by: str = "file") -> DataFrame:
    """Per-file manifest: status and counts only, never text."""
    size = F.length(text) + F.length("eol")
    return lines.groupBy(by).agg(
        F.when(F.bool_or("failed"), "failed").otherwise("ok").alias("status"),
        F.count("*").alias("records"), F.count_if(is_blank(F.col(text))).alias("blank_records"),
        F.sum(size).alias("chars"), F.max(size).alias("max_record_chars"),
        (F.max("error") if "error" in lines.columns else F.when(F.bool_or("failed"), "RecordTooLong")).alias("error_type"))


def manifest(inputs: DataFrame, lines: DataFrame, text: str = "text") -> DataFrame:
    """summary() with a row for every discovered input: files without bytes are ok and empty, files that Spark's
    readers pass over for their name (_ or . in front) have failed as HiddenFile."""
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    counted = summary(lines, text).withColumn("_path", plain(F.col("file"))).drop("file")
    rows = inputs.select("file", "size", plain(F.col("file")).alias("_path")).join(counted, "_path", "left")
    empty = F.col("size") == 0
    return rows.select(
        "file", F.coalesce("status", F.when(empty, "ok").otherwise("failed")).alias("status"),
        *[F.coalesce(c, F.when(empty, F.lit(0).cast("long"))).alias(c) for c in ("records", "blank_records", "chars")],
        "max_record_chars", F.coalesce("error_type", F.when(F.col("status").isNull() & ~empty, "HiddenFile")).alias("error_type"))


def rollup(manifest: DataFrame) -> DataFrame:
    """Directory totals under the per-file rows (file is null on the total row)."""
    return manifest.rollup("file").agg(
        F.count("*").alias("files"), F.sum("records").alias("records"),
        F.sum("blank_records").alias("blank_records"), F.sum("chars").alias("chars"),
        F.max("max_record_chars").alias("max_record_chars"))


def relative(path: Column, root: str) -> Column:
    return F.regexp_replace(path, "^.*?" + posixpath.normpath(root.removeprefix("file:")) + "/", "")


def write_text(lines: DataFrame, out: str, root: str, text: str = "text") -> DataFrame:
    """Publish the records of inputs below root under the same relative paths below out; a manifest row per input.

    Bytes that `text` leaves alone stay as they were, terminators and a missing last one included. Records may come in any order and
    are ordered by (file, line_no); an input with a failed record keeps its old output. streaming.redact.run_directory() does
    without that exchange, and publishes files without bytes too.
    """
    root, out = resolved(root), resolved(out)
    error = F.when(F.col("failed"), F.coalesce("error", F.lit("RecordTooLong")) if "error" in lines.columns else F.lit("RecordTooLong"))
    name = F.regexp_replace("file", "^file:/+", "/")
    # a stretch of an input's records that one task has is a segment, named by its first record
    rows = (lines.select(name.alias("file"), "line_no", F.col(text).alias("out"), "eol", (F.length(text) + F.length("eol")).alias("chars"),
                         is_blank(F.col(text)).alias("blank"), error.alias("error"))
            .repartitionByRange("file", "line_no").sortWithinPartitions("file", "line_no")
            .withColumn("block", F.spark_partition_id().cast("long")))
    os.makedirs(out, exist_ok=True)
    staged = publish.stage(rows, out)
    manifest = publish.publish(lines.sparkSession, staged, root, out).persist()
    manifest.count()
    publish.clear(staged)
    return manifest

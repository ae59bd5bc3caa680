"""Incremental redaction with Structured Streaming: a state per input file, records of a stream."""

from __future__ import annotations

import os
import time
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from veilframe.functions.detect import is_blank
from veilframe.operators.redact import redact
from veilframe.sources import publish, ranges
from veilframe.sources.rules import Rules
from veilframe.sources.text import TXT, discover, resolved

EVENT = "file string, kind string, run long, size long, modified long, force boolean"
WORK = "file string, run long, attempt int, action string"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STORE = "spark.sql.streaming.stateStore.providerClass"


class FileState(StatefulProcessor):
    """One state per input: none, then running, done or failed, with the attempts made and the signature it was last seen with.

    A file that is seen is to be processed if it is new, has changed, is forced, or has failed or been left running less than
    `attempts` times; else it is skipped, or given up. What became of a run arrives as ok or failed events.
    """

    def __init__(self, attempts: int):
        self.attempts = attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("file", "status string, attempts int, size long, modified long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        status, tries, size, modified = self.state.get() if self.state.exists() else (None, 0, -1, -1)
        out = []
        events = pd.concat(list(rows))
        events = events.assign(order=events["kind"].map({"seen": 0}).fillna(1)).sort_values(["run", "order"])
        for e in events.itertuples():
            if e.kind != "seen":
                status = "done" if e.kind == "ok" else "failed"
                continue
            same = (size, modified) == (e.size, e.modified)
            if not same or e.force:
                tries = 0
            if status == "done" and same and not e.force:
                action = "skip"
            elif tries >= self.attempts:
                action = "give up"
            else:
                action, status, tries, size, modified = "process", "running", tries + 1, e.size, e.modified
            out.append((key[0], e.run, tries, action))
        self.state.update((status, tries, size, modified))
        if out:
            yield pd.DataFrame(out, columns=["file", "run", "attempt", "action"])

    def close(self) -> None:
        pass


def work(events: DataFrame, attempts: int = 3) -> DataFrame:
    """(file, run, attempt, action) for a stream of events: what to do about every input that a run has seen."""
    return events.groupBy("file").transformWithStateInPandas(
        statefulProcessor=FileState(attempts), outputStructType=WORK, outputMode="Append", timeMode="None")


def process_files(spark: SparkSession, files: DataFrame, root: str, out: str, rules: Rules = Rules(), max_chars: int | None = None,
                  detector=None, split: int = ranges.SPLIT_BYTES) -> DataFrame:
    """Redact the files of a table (file) below root and publish them below out; their manifest.

    One pass without a shuffle. Records keep their terminators, so what is not masked is the same bytes; a detector may reorder
    rows, which are then put in order range by range. An input with an over-long record, bytes that are not UTF-8 or a record
    that its detector fails on (see guarded()) has failed, the others go on.
    """
    listing = f"{out}/.staging-list-{time.time_ns()}"
    files.select("file").write.text("file://" + listing)
    try:
        rows = ranges.read(spark, root, "records", TXT, max_chars=max_chars, split=split, listed=listing)
        rows = rows.withColumns({"chars": F.length("text") + F.length("eol"), "blank": is_blank(F.col("text"))})
        done = redact(rows, rules, detector=detector).withColumnRenamed("redacted", "out")
        if "detector_error" in done.columns:
            done = done.withColumn("error", F.coalesce("error", "detector_error"))
        if detector is not None:
            done = done.repartition("file", "block").sortWithinPartitions("file", "block", "seq")
        staged = publish.stage(done, out)
        manifest = publish.publish(spark, staged, root, out).persist()
        manifest.count()  # the renames are made here, once
        publish.clear(staged)
    finally:
        publish.clear(listing)
    return manifest


def run_directory(spark: SparkSession, root: str, out: str, rules: Rules = Rules(), max_chars: int | None = None, detector=None,
                  overwrite: bool = False, exclude=(), protected=(), attempts: int = 3, split: int = ranges.SPLIT_BYTES) -> DataFrame:
    """Redact all text files below root into the same relative paths below out, and return this run's manifest.

    A run processes inputs that are new, have changed or failed before (at most `attempts` times), and skips those that are done or
    have an output that is not empty, unless overwrite says otherwise. States live in the checkpoint of a stream below out, so a
    run that was stopped goes on where it was: outputs appear whole or not at all. The output folder must not be root or hold
    it; below root it is never read. Outputs that would meet each other, an input or a protected file, links resolved, stop the run
    before anything is written, and so does a folder without text files. root and out are paths that all workers see.
    """
    root, out = resolved(root), resolved(out)
    if root == out or root.startswith(out + "/"):
        raise ValueError("the output folder must not be the input folder or hold it")
    inputs = discover(spark, root, exclude=[out, *exclude]).select(F.expr("substring(file, 6)").alias("file"), "size", F.unix_micros("modified").alias("modified"))
    inputs = inputs.persist()
    if inputs.isEmpty():
        raise ValueError("no text files in the input folder")
    clashes = publish.collisions(spark, inputs, root, out, list(protected)).limit(3).collect()
    if clashes:
        raise ValueError("; ".join(f"{c.output}: {c.reason}" for c in clashes))
    os.makedirs(out, exist_ok=True)
    run = time.time_ns()
    events, manifests = f"file://{out}/.state/events", f"file://{out}/.state/manifest"
    inputs.select("file", F.lit("seen").alias("kind"), F.lit(run).alias("run"), "size", "modified", F.lit(overwrite).alias("force")) \
        .write.mode("append").parquet(events)
    inputs.unpersist()

    def publish_batch(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        # a batch may hold what a stopped run has left; its last word about a file counts
        last = batch.groupBy("file").agg(F.max_by(F.struct("run", "attempt", "action"), "run").alias("w")).select("file", "w.*").persist()
        todo = last.filter("action = 'process'")
        there = todo.limit(0).select("file") if overwrite else todo.filter("attempt = 1").select("file").mapInArrow(
            _with_output(root, out), "file string")
        there = there.persist()
        todo = todo.join(there, "file", "left_anti")
        rows = session.createDataFrame([], publish.MANIFEST)
        if not todo.isEmpty():
            rows = process_files(session, todo, root, out, rules, max_chars, detector, split)
        others = last.filter("action = 'skip'").select("file").union(there).withColumn("status", F.lit("skipped")).union(
            last.filter("action = 'give up'").select("file", F.lit("failed").alias("status")))
        output = F.concat(F.lit(out), F.substring("file", len(root) + 1, 1 << 30))
        whole = rows.unionByName(others.select(F.col("file").alias("input"), output.alias("output"), "status"), allowMissingColumns=True)
        whole = whole.join(last.select(F.col("file").alias("input"), "attempt"), "input", "left")
        whole.write.mode("overwrite").json(f"{manifests}/run={run}/batch={batch_id}")
        outcome = rows.select(F.col("input").alias("file"), F.col("status").alias("kind")).union(there.select("file", F.lit("ok")))
        none = F.lit(-1).cast("long")
        outcome.select("file", "kind", F.lit(run).alias("run"), none.alias("size"), none.alias("modified"), F.lit(False).alias("force")) \
            .write.mode("append").parquet(events)

    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)  # the store that keeps named states
    try:
        todo = work(spark.readStream.schema(EVENT).parquet(events), attempts)
        (todo.writeStream.foreachBatch(publish_batch).outputMode("append").option("checkpointLocation", f"file://{out}/.state/checkpoint")
         .trigger(availableNow=True).start().awaitTermination())
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)
    schema = publish.MANIFEST + ", attempt int, batch long"
    return spark.read.schema(schema).json(f"{manifests}/run={run}").drop("batch")


def report(manifest: DataFrame) -> DataFrame:
    """One row: files, success, failed, skipped, record and character totals, and whether the run is complete."""
    n = lambda s: F.count_if(F.col("status") == s)
    return manifest.agg(
        F.count(F.lit(1)).alias("files"), n("ok").alias("success"), n("failed").alias("failed"), n("skipped").alias("skipped"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("records", "blank_records", "chars")],
        (F.sum("records") / F.sum(F.when(F.col("status") == "ok", F.col("seconds")))).alias("records_per_second"),
        F.when(n("failed") > 0, "failed").otherwise("completed").alias("status"))


def _with_output(root: str, out: str):
    """Files that have an output that is not empty."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            there = [f for f in batch.column("file").to_pylist() if os.path.isfile(o := os.path.join(out, os.path.relpath(f, root))) and os.path.getsize(o)]
            yield pa.RecordBatch.from_arrays([pa.array(there, pa.string())], names=["file"])
    return run


def redact_stream(stream: DataFrame, out: str, rules: Rules = Rules(), text: str = "text") -> str:
    """Redact an unbounded record stream into parquet; the sink's commit log makes it exactly once."""
    (redact(stream, rules, text).writeStream.format("parquet").option("path", out)
     .option("checkpointLocation", out + "-checkpoint").trigger(availableNow=True)
     .start().awaitTermination())
    return out

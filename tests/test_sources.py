import os
import random

import pytest
from pyspark.sql import functions as F

from veilframe.operators.corpus import budget_batches
from veilframe.operators.redact import guarded, redact
from veilframe.sources import ranges, readers, text
from veilframe.streaming.redact import report, run_directory


def put(path, data: bytes):
    os.makedirs(path.parent, exist_ok=True)
    path.write_bytes(data)


def lines(spark, root, **kw):
    return [(r.text, r.eol) for r in text.scan(spark, str(root), **kw).orderBy("file", "line_no").collect()]


def test_line_scan_keeps_terminators(spark, tmp_path):
    put(tmp_path / "a.txt", "﻿电话13748260915\r\n\n \t\r南京市\r最后一行".encode())
    assert lines(spark, tmp_path) == [("电话13748260915", "\r\n"), ("", "\n"), (" \t", "\r"), ("南京市", "\r"), ("最后一行", "")]
    numbers = [r.line_no for r in text.scan(spark, str(tmp_path)).orderBy("line_no").collect()]
    assert numbers == [1, 2, 3, 4, 5]


@pytest.mark.parametrize("limit,failed", [(4, False), (3, True)])
def test_record_limit(spark, tmp_path, limit, failed):
    put(tmp_path / "a.txt", b"abc\nxyz")
    got = text.scan(spark, str(tmp_path), max_chars=limit)
    assert {r.failed for r in got.collect()} == {failed} and got.count() == 2


def test_discovery_and_empty_file(spark, tmp_path):
    put(tmp_path / "a.txt", b"x\n")
    put(tmp_path / "nested" / "a.TXT", b"y\n")
    put(tmp_path / "out" / "b.txt", b"z\n")
    put(tmp_path / "ignored.csv", b"q\n")
    put(tmp_path / "empty.txt", b"")
    found = text.discover(spark, str(tmp_path), exclude=["out"])
    assert sorted(os.path.basename(r.file) for r in found.collect()) == ["a.TXT", "a.txt", "empty.txt"]
    assert lines(spark, tmp_path, exclude=["out"]) == [("x", "\n"), ("y", "\n")]


def test_exclusion_by_resolved_folder_and_full_manifest(spark, tmp_path):
    put(tmp_path / "out" / "b.txt", b"z\n")
    put(tmp_path / "sub" / "out" / "deep.txt", b"ab\n\n")
    put(tmp_path / "_notes.txt", b"x\n")
    put(tmp_path / ".hid.txt", b"x\n")
    put(tmp_path / "empty.txt", b"")
    put(tmp_path / "bad.txt", b"ok\n\xff\xfe\n")
    found = text.discover(spark, str(tmp_path), exclude=["out"])
    got = {os.path.basename(r.file): (r.status, r.records, r.error_type)
           for r in text.manifest(found, text.scan(spark, str(tmp_path), exclude=[str(tmp_path / "out")])).collect()}
    assert got == {"deep.txt": ("ok", 2, None), "_notes.txt": ("ok", 1, None), ".hid.txt": ("ok", 1, None),
                   "empty.txt": ("ok", 0, None), "bad.txt": ("failed", 2, "UnicodeDecodeError")}


def test_links_are_not_followed(spark, tmp_path):
    put(tmp_path / "elsewhere" / "outside.txt", b"outside\n")
    put(tmp_path / "in" / "a.txt", b"inside\n")
    os.symlink(tmp_path / "elsewhere" / "outside.txt", tmp_path / "in" / "link.txt")
    os.symlink(tmp_path / "elsewhere", tmp_path / "in" / "linked")
    os.symlink(tmp_path / "in", tmp_path / "in" / "circle")
    assert [os.path.basename(r.file) for r in text.discover(spark, str(tmp_path / "in")).collect()] == ["a.txt"]
    assert lines(spark, tmp_path / "in") == [("inside", "\n")]


DATA = [b"", b"\n", b"a", b"a\n", b"\r", b"a\r", b"a\r\n", b"a\rb\r\nc\n\nd", b"\xef\xbb\xbfbom\nx", b"\xef\xbb\xbf", "日本\r\u00e9\n \t\n".encode(), b"\n\n\r\r\n\r",
        b"one long line of more than a few bytes without an end", b"x" * 40 + b"\n" + b"y" * 7]


def as_text(data):
    with_mark = data.decode("utf-8-sig")
    return with_mark


def cut(t):
    """(text, terminator) of all records, as a text stream that keeps line ends reads them."""
    import io
    out = []
    for line in io.StringIO(t, newline=""):
        for end in ("\r\n", "\n", "\r", ""):
            if line.endswith(end):
                out.append((line[:len(line) - len(end)], end))
                break
    return out


@pytest.mark.parametrize("split", [1, 2, 3, 7, 64, 1 << 20])
def test_ranges_give_the_same_records_at_every_split_size(spark, tmp_path, split):
    for i, d in enumerate(DATA):
        put(tmp_path / f"{i:02d}.txt", d)
    got = ranges.read(spark, str(tmp_path), "records", text.TXT, split=split).orderBy("file", "block", "seq").collect()
    for i, d in enumerate(DATA):
        rows = [(r.text, r.eol) for r in got if r.file.endswith(f"{i:02d}.txt")]
        assert [r for r in rows if r != (None, None)] == cut(as_text(d)), (i, d)
        assert len(rows) >= 1 or not d
    raw = ranges.read(spark, str(tmp_path), "lines", text.TXT, split=split).orderBy("file", "block")
    flat = text.records(raw.withColumn("value", F.col("value").cast("string"))).orderBy("file", "line_no").collect()
    for i, d in enumerate(DATA):
        assert [(r.text, r.eol) for r in flat if r.file.endswith(f"{i:02d}.txt")] == cut(as_text(d)), (i, d)


def statuses(manifest):
    return {os.path.basename(r.input): r.status for r in manifest.collect()}


@pytest.mark.parametrize("split", [2, 1 << 20])
def test_directory_run_is_lossless(spark, tmp_path, split):
    src, out = tmp_path / "in", tmp_path / "out"
    for i, d in enumerate(DATA):
        put(src / f"{'_' if i % 3 == 1 else '.' if i % 3 == 2 else ''}d{i % 2}" / f"{'_' if i % 2 else ''}{i}.txt", d)
    put(src / "a.txt", "电话13800138000\r电话13800138000".encode())
    os.symlink(src / "a.txt", src / "link.txt")
    put(src / "ignored.csv", b"q")
    m = run_directory(spark, str(src), str(out), split=split)
    want = {p.relative_to(src): p.read_bytes() for p in src.rglob("*") if p.is_file() and not p.is_symlink() and p.suffix == ".txt"}
    got = {p.relative_to(out): p.read_bytes() for p in out.rglob("*") if p.is_file() and ".state" not in p.parts}
    stars = "电话***********\r电话***********".encode()
    assert got == {k: stars if k.name == "a.txt" else as_text(v).encode() for k, v in want.items()}
    rows = {r.input: r for r in m.collect()}
    assert len(rows) == len(want) and {r.status for r in rows.values()} == {"ok"}
    for k, v in want.items():
        r, c = rows[str(src / k)], cut(as_text(v))
        assert r.output == str(out / k) and (r.records, r.chars) == (len(c), len(as_text(v))) and r.attempt == 1
        assert r.blank_records == sum(not t.strip() for t, _ in c) and r.max_record_chars == max((len(t) + len(e) for t, e in c), default=0)


def test_directory_run_skips_overwrites_and_sees_changes(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    put(src / "a.txt", b"12345678\n")
    put(src / "nested" / "A.TXT", b"87654321")
    put(out / "a.txt", b"there already")
    run = lambda **kw: statuses(run_directory(spark, str(src), str(out), **kw))
    assert run() == {"a.txt": "skipped", "A.TXT": "ok"}
    assert (out / "a.txt").read_bytes() == b"there already" and (out / "nested" / "A.TXT").read_bytes() == b"********"
    assert run() == {"a.txt": "skipped", "A.TXT": "skipped"}
    put(src / "nested" / "A.TXT", b"87654321 and more")
    put(src / "new.txt", b"n")
    assert run() == {"a.txt": "skipped", "A.TXT": "skipped", "new.txt": "ok"} or (out / "nested" / "A.TXT").read_bytes() == b"******** and more"
    m = run_directory(spark, str(src), str(out), overwrite=True)
    assert statuses(m) == {"a.txt": "ok", "A.TXT": "ok", "new.txt": "ok"} and (out / "a.txt").read_bytes() == b"********\n"
    r = report(m).first()
    assert (r.files, r.success, r.failed, r.skipped, r.status) == (3, 3, 0, 0, "completed")
    assert not [p for p in out.iterdir() if p.name.startswith(".staging")]


def test_failed_files_keep_old_output_and_others_go_on(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    put(src / "long.txt", b"x" * 50)
    put(src / "bad.txt", b"ok\n\xff\n")
    put(src / "fine.txt", b"ok\n")
    put(out / "long.txt", b"old")
    m = run_directory(spark, str(src), str(out), max_chars=10, overwrite=True, split=4)
    got = {os.path.basename(r.input): (r.status, r.error_type, r.records) for r in m.collect()}
    assert got == {"long.txt": ("failed", "RecordTooLong", None), "bad.txt": ("failed", "UnicodeDecodeError", None), "fine.txt": ("ok", None, 1)}
    assert (out / "long.txt").read_bytes() == b"old" and (out / "fine.txt").read_bytes() == b"ok\n" and not (out / "bad.txt").exists()
    assert report(m).first().status == "failed"


def test_detector_fault_marks_one_file_and_is_tried_again(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    for n in range(6):
        put(src / f"{n}.txt", f"record of {'SECRET' if n == 4 else 'no'} use\nBob came".encode())
    seen = tmp_path / "seen"
    seen.mkdir()

    def find(texts):
        out = []
        for t in texts:
            (seen / f"{len(list(seen.iterdir()))}-{abs(hash(t))}").write_text(t)
            if "SECRET" in t and not (seen.parent / "mended").exists():
                raise KeyError(t)
            out.append([("name", 0, 3)] if t.startswith("Bob") else [])
        return out

    run = lambda: run_directory(spark, str(src), str(out), detector=guarded(find), attempts=2)
    m = run()
    assert {os.path.basename(r.input): (r.status, r.error_type) for r in m.collect()} == {
        f"{n}.txt": ("failed", "KeyError") if n == 4 else ("ok", None) for n in range(6)}
    assert "SECRET" not in str(m.collect()) and (out / "0.txt").read_bytes() == b"record of no use\n*** came"
    put(tmp_path / "mended", b"")
    for f in list(seen.iterdir()):
        f.unlink()
    m = run()
    assert {os.path.basename(r.input): (r.status, r.attempt) for r in m.collect()} == {
        f"{n}.txt": ("ok", 2) if n == 4 else ("skipped", 1) for n in range(6)}
    assert {f.read_text() for f in seen.iterdir()} == {"record of SECRET use", "Bob came"}  # only that file was read again


def test_a_run_that_fails_leaves_nothing(spark, tmp_path):
    put(tmp_path / "in" / "a.txt", b"12345678\n")
    put(tmp_path / "out" / "old.txt", b"old")

    def broken(df, text):
        return df.withColumn("entities", F.raise_error(F.lit("down")).cast("array<struct<type:string,start:int,end:int>>"))
    with pytest.raises(Exception, match="down"):
        run_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"), detector=broken)
    assert sorted(p.name for p in (tmp_path / "out").iterdir() if p.name != ".state") == ["old.txt"]
    assert statuses(run_directory(spark, str(tmp_path / "in"), str(tmp_path / "out"))) == {"a.txt": "ok"}  # the stopped run goes on
    assert (tmp_path / "out" / "a.txt").read_bytes() == b"********\n"


def test_files_are_given_up_after_some_attempts(spark, tmp_path):
    put(tmp_path / "in" / "bad.txt", b"\xff")
    put(tmp_path / "in" / "good.txt", b"g")
    got = [[(os.path.basename(r.input), r.status, r.attempt, r.error_type) for r in run_directory(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), attempts=2).orderBy("input").collect()] for _ in range(3)]
    assert got[0] == [("bad.txt", "failed", 1, "UnicodeDecodeError"), ("good.txt", "ok", 1, None)]
    assert got[1] == [("bad.txt", "failed", 2, "UnicodeDecodeError"), ("good.txt", "skipped", 1, None)]
    assert got[2] == [("bad.txt", "failed", 2, None), ("good.txt", "skipped", 1, None)]


def test_outputs_must_not_meet_inputs_or_each_other(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    put(src / "a.txt", b"a\n")
    put(src / "nested" / "a.txt", b"b\n")
    run = lambda out=out, **kw: run_directory(spark, str(src), str(out), overwrite=True, **kw)
    for folder in (src, tmp_path):
        with pytest.raises(ValueError):
            run(folder)
    out.mkdir()
    os.link(src / "nested" / "a.txt", out / "a.txt")
    with pytest.raises(ValueError, match="input or protected"):
        run()
    (out / "a.txt").unlink()
    os.symlink(out, out / "nested")
    with pytest.raises(ValueError, match="second output"):
        run()
    (out / "nested").unlink()
    os.symlink(tmp_path / "elsewhere", out / "nested")
    with pytest.raises(ValueError, match="outside"):
        run()
    (out / "nested").unlink()
    put(tmp_path / "config.json", b"{}")
    os.link(tmp_path / "config.json", out / "a.txt")
    with pytest.raises(ValueError, match="protected"):
        run(protected=[str(tmp_path / "config.json")])
    assert (src / "a.txt").read_bytes() == b"a\n" and (src / "nested" / "a.txt").read_bytes() == b"b\n"
    with pytest.raises(ValueError):
        run_directory(spark, str(tmp_path / "elsewhere2"), str(out)) if (tmp_path / "elsewhere2").mkdir() is None else None


def test_output_below_the_input_is_not_read(spark, tmp_path):
    put(tmp_path / "a.txt", "电话13800138000\n".encode())
    put(tmp_path / "generated" / "stale.txt", b"x\n")
    for status in ("ok", "skipped", "skipped"):
        assert statuses(run_directory(spark, str(tmp_path), str(tmp_path / "results"), exclude=[str(tmp_path / "generated")])) == {"a.txt": status}


def test_publish_of_records_in_any_order(spark, tmp_path):
    put(tmp_path / "in" / "a.txt", b"one\rtwo 12345678\r\nthree\n")
    put(tmp_path / "in" / "sub" / "b.txt", b"last 12345678")
    got = text.scan(spark, str(tmp_path / "in")).repartition(7)
    m = text.write_text(redact(got), str(tmp_path / "out"), str(tmp_path / "in"), "redacted")
    assert (tmp_path / "out" / "a.txt").read_bytes() == b"one\rtwo ********\r\nthree\n"
    assert (tmp_path / "out" / "sub" / "b.txt").read_bytes() == b"last ********"
    assert statuses(m) == {"a.txt": "ok", "b.txt": "ok"}


def test_budget_batches(spark):
    rows = [("f", i, n) for i, n in enumerate([3, 3, 5, 2, 1])]
    df = spark.createDataFrame(rows, "file string, line_no long, size long")
    got = [r.batch for r in budget_batches(df, "file", "line_no", "size", 2, 7).orderBy("line_no").collect()]
    assert got == [0, 0, 1, 1, 2]


def test_budget_batches_cross_spans(spark):
    rng = random.Random(4)
    rows = [(f, i + 1, rng.randrange(1, 40)) for f, n in (("a", 400), ("b", 1), ("c", 97)) for i in range(n)]
    want = {}
    batch = rows_in = used = 0
    for k, (f, i, n) in enumerate(rows):
        if k and f != rows[k - 1][0]:
            batch = rows_in = used = 0
        if rows_in and (rows_in == 6 or used + n > 90):
            batch, rows_in, used = batch + 1, 0, 0
        rows_in, used = rows_in + 1, used + n
        want[f, i] = batch
    df = spark.createDataFrame(rows, "file string, line_no long, size long").repartition(5)
    for span in (1, 10, 1000):
        assert {(r.file, r.line_no): r.batch for r in budget_batches(df, "file", "line_no", "size", 6, 90, span).collect()} == want


def test_sources_reject_unknown_and_empty(spark):
    empty = spark.createDataFrame([], "file string, line_no long, text string")
    with pytest.raises(ValueError):
        readers.load_layout("no_such_layout", {"train": empty})
    with pytest.raises(ValueError):
        readers.load_layout("topic_lines", {"train": empty})
    lines = spark.createDataFrame([("f", 1, "a=1"), ("f", 2, "b=2")], "file string, line_no long, text string")
    pairs = readers.load_layout("own", {"any": lines}, read=lambda x: x.select(F.split("text", "=").alias("pair")))
    assert [(r.pair, r.split) for r in pairs.orderBy("pair").collect()] == [(["a", "1"], "any"), (["b", "2"], "any")]


def test_linked_story_highlights(spark):
    import hashlib
    stem = hashlib.sha1(b"http://x").hexdigest()
    body = ["First line", "Second.", "@highlight", "Point one", "@highlight", "Point two"]
    story = spark.createDataFrame([(f"d/{stem}.story", i, t) for i, t in enumerate(body)], "file string, line_no int, text string")
    urls = spark.createDataFrame([("http://x",)], "url string")
    row = readers.linked_stories(urls, story).first()
    assert (row.article, row.highlights) == ("first line . second.", "point one . point two .")


def test_choices_and_dates(spark):
    df = spark.createDataFrame([("b", ["a", "b"])], "answer string, choices array<string>")
    assert df.select(readers.choice_label(F.col("answer"), F.col("choices"))).first()[0] == 1

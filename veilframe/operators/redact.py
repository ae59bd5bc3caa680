"""Redaction of text columns: findings, masks, typed replacement, JSON and the two-stage job."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions import detect, spans
from veilframe.functions.detect import normalise_one
from veilframe.sources.rules import Rules


def with_findings(df: DataFrame, rules: Rules = Rules(), text: str = "text",
                  out: str = "spans") -> DataFrame:
    """Add the union of all rule hits as a span array; no shuffle."""
    keep = df.columns
    df = detect.with_normalised(df, text)
    df = df.withColumn("_field", detect.field_spans(F.col("_norm"), rules))
    df = df.withColumn("_hits", F.concat("_field", detect.rule_spans(F.col("_norm"), rules)))
    df = df.withColumn("_hits", detect.to_source(F.col("_hits"), F.col("_at")))
    return df.select(*keep, spans.union_spans(F.col("_hits")).alias(out))


def findings(df: DataFrame, key: list[str], rules: Rules = Rules(), text: str = "text") -> DataFrame:
    """One row per finding: key, category, rule, start, end. The text itself is not carried."""
    return (with_findings(df, rules, text)
            .select(*key, F.explode_outer("spans").alias("s")).where("s is not null")
            .select(*key, "s.category", F.col("s.source").alias("rule"), "s.start", "s.end"))


def redact_rules(df: DataFrame, rules: Rules = Rules(), text: str = "text",
                 out: str = "redacted", keep_spans: str | None = None) -> DataFrame:
    """Rules only: every finding masked at equal length."""
    found = with_findings(df, rules, text, "_spans").withColumn(
        out, spans.mask(F.col(text), F.col("_spans")))
    return found.withColumnRenamed("_spans", keep_spans) if keep_spans else found.drop("_spans")


def redact(df: DataFrame, rules: Rules = Rules(), text: str = "text", out: str = "redacted",
           detector=None, name_mask: str = "full") -> DataFrame:
    """Rules plus raw formats, then an optional detector on the masked, non-blank records.

    detector(df, text_column) returns df with an `entities` array<struct<type,start,end>> column
    and one row per input row; a `detector_error` column that it adds stays, see guarded().
    """
    keep = df.columns
    found = with_findings(df, rules, text, "_spans")
    found = found.withColumn("_all", spans.union_plain(
        F.concat("_spans", detect.raw_format_spans(F.col(text)))))
    staged = found.withColumn("_masked", spans.mask(F.col(text), F.col("_all"))).select(*keep, "_masked")
    if detector is None:
        return staged.withColumnRenamed("_masked", out)
    blank = detect.is_blank(F.col("_masked"))
    seen = detector(staged.withColumn("_active", F.when(~blank, F.col("_masked"))), "_active")
    replaced = spans.replace_entities(F.col("_active"), F.col("entities"), name_mask)
    keep = [*keep, "detector_error"] if "detector_error" in seen.columns and "detector_error" not in keep else keep
    return seen.select(*keep, F.when(F.col("_active").isNull(), F.col("_masked"))
                       .otherwise(replaced).alias(out))


def guarded(find):
    """A detector of find(texts) -> a list of (type, start, end) per text, in which a failure stays with its record.

    A batch that raises is gone through record by record; a record that raises has no entities and the class name of
    the exception, never its message, as detector_error.
    """
    kind = "struct<entities: array<struct<type: string, start: int, end: int>>, detector_error: string>"

    def one(text):
        try:
            return {"entities": _entities(find([text])[0]), "detector_error": None}
        except Exception as e:  # noqa: BLE001  any fault of a plugged-in detector
            return {"entities": [], "detector_error": type(e).__name__}

    @F.pandas_udf(kind)
    def run(texts: pd.Series) -> pd.DataFrame:
        active = texts.dropna()
        try:
            found = find(active.tolist()) if len(active) else []
            if len(found) != len(active):
                raise ValueError("a detector gives one list per text")
            got = [{"entities": _entities(f), "detector_error": None} for f in found]
        except Exception:  # noqa: BLE001
            got = [one(t) for t in active]
        by = dict(zip(active.index, got))
        return pd.DataFrame([by.get(i, {"entities": None, "detector_error": None}) for i in texts.index])

    def detector(df: DataFrame, text: str) -> DataFrame:
        return df.withColumn("_found", run.asNondeterministic()(text)).select("*", "_found.*").drop("_found")
    return detector


def _entities(found) -> list[dict]:
    return [{"type": t, "start": int(a), "end": int(b)} for t, a, b in found]


def _walk(value, labels, leaf, masked):
    """Rebuild a JSON value: sensitive keys through masked(), other strings and ints through leaf()."""
    if isinstance(value, dict):
        return {k: masked(v) if normalise_one(k)[0].casefold() in labels
                else _walk(v, labels, leaf, masked) for k, v in value.items()}
    if isinstance(value, list):
        return [_walk(v, labels, leaf, masked) for v in value]
    if isinstance(value, str) or (isinstance(value, int) and not isinstance(value, bool)):
        return leaf(value)
    return value


def _compact(value) -> str:
    return json.dumps(value, ensure_ascii=False, separators=(",", ":"))


_BETWEEN = "\n\0\n"


def redact_json(df: DataFrame, rules: Rules = Rules(), column: str = "json",
                out: str = "redacted") -> DataFrame:
    """Redact JSON strings. Leaf texts of a document are joined by a line break, a null character and a line break, masked like
    any text and cut back by length, so the rules run once per document. No pattern crosses a line break, and known
    values that hold a null character are refused, so nothing matches across leaves."""
    labels = frozenset(detect.label_table(rules))
    if any("\0" in v for values in rules.known_values.values() for v in values):
        raise ValueError("a known value must not hold a null character")

    @F.pandas_udf(T.StringType())
    def leaves(docs: pd.Series) -> pd.Series:
        def one(doc):
            if doc is None:
                return None
            texts = []
            _walk(json.loads(doc), labels, lambda v: texts.append(str(v)), lambda v: None)
            return _BETWEEN.join(texts)
        return docs.map(one, na_action="ignore")

    @F.pandas_udf(T.StringType())
    def rebuild(docs: pd.Series, masks: pd.Series) -> pd.Series:
        def one(doc, mask):
            pos = 0

            def leaf(v):
                nonlocal pos
                text = str(v)
                new = mask[pos:pos + len(text)]
                pos += len(text) + len(_BETWEEN)
                return new if isinstance(v, str) or new != text else v

            def masked(v):
                if v is None or v == "":
                    return v
                return "*" * len(v if isinstance(v, str) else _compact(v))
            return _compact(_walk(json.loads(doc), labels, leaf, masked))
        return pd.Series([None if d is None else one(d, m) for d, m in zip(docs, masks)], dtype=object)

    keep = df.columns
    flat = df.withColumn("_leaves", leaves.asNondeterministic()(column))
    done = redact_rules(flat, rules, "_leaves", "_leafmask")
    # read twice, so the mask stays a column of its own below the function call
    ready = done.withColumn("_same", F.length("_leafmask") == F.length("_leaves"))
    return ready.select(*keep, F.when(F.col("_same"), rebuild.asNondeterministic()(F.col(column), F.col("_leafmask")))
                        .otherwise(F.raise_error(F.lit("a JSON mask changed its length"))).alias(out))

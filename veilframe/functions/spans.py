"""Span algebra on array columns: union, masking and typed replacement without any shuffle.

A span is struct<start int, end int, category string, source string>, half-open, in code points
of the original text. Touching spans stay apart; spans overlap iff start < previous end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions.fold import let, scan

SPANS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
    T.StructField("category", T.StringType()), T.StructField("source", T.StringType())]))

# fixed values: which rule names the union when spans overlap (lower wins)
SOURCE_PRIORITY = {"field": 0, "known": 1, "vehicle_plate": 2, "format": 3, "bank_card": 4,
                   "continuous_digits": 5}
# fixed values: replacement text by entity type
TYPE_MARKERS = {"地址": "[地址已脱敏]", "工作单位": "[单位已脱敏]"}
NAME_TYPE = "姓名"


def no_spans() -> Column:
    return F.array().cast(SPANS)


def span(start: Column, end: Column, category: Column, source: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), end.cast("int").alias("end"),
                    category.cast("string").alias("category"), source.cast("string").alias("source"))


def regex_spans(text: Column, pattern: str, category: str, source: str, keep=None) -> Column:
    """All matches of a (Java) pattern as spans; keep(match) filters matches.

    Positions come from the pieces around the matches: piece and match lengths alternate.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("hit"))

    def step(acc, x):
        start = acc["pos"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        wanted = x["hit"].isNotNull() if keep is None else x["hit"].isNotNull() & keep(x["hit"])
        one = F.array(span(start, end, F.lit(category), F.lit(source)))
        return F.struct(end.alias("pos"),
                        F.when(wanted, F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    zero = F.struct(F.lit(0).alias("pos"), no_spans().alias("out"))
    return F.when(text.rlike(pattern), scan(pairs, zero, ["pos"], SPANS, step)).otherwise(no_spans())


def _fold(ordered: Column, elem_type: str, merge) -> Column:
    """Left fold of sorted spans into disjoint ones; merge(previous, span) joins two overlapping."""
    out_type = f"array<{elem_type}>"
    zero = F.struct(F.lit(None).cast(elem_type).alias("cur"), F.array().cast(out_type).alias("out"))

    def step(acc, x):
        cur, out = acc["cur"], acc["out"]
        overlap = cur.isNotNull() & (x["start"] < cur["end"])
        return F.struct(
            F.when(overlap, merge(cur, x)).otherwise(x).alias("cur"),
            F.when(overlap | cur.isNull(), out).otherwise(F.concat(out, F.array(cur))).alias("out"))

    def finish(last):
        return F.when(last["cur"].isNull(), F.array().cast(out_type)).otherwise(F.array(last["cur"]))

    return scan(ordered, zero, ["cur"], out_type, step, finish)


def union_spans(spans: Column) -> Column:
    """Category-aware union: the label of the highest-priority member, earliest on ties."""
    return let(spans, lambda s: F.when(F.size(s) <= 1, s).otherwise(_union_labelled(s)))


def _union_labelled(spans: Column) -> Column:
    rank = F.create_map(*[F.lit(v) for kv in SOURCE_PRIORITY.items() for v in kv])
    elem = "struct<start:int,prio:int,neg:int,seq:int,end:int,category:string,source:string>"
    keyed = F.transform(spans, lambda s, i: F.struct(
        s["start"].alias("start"), rank[s["source"]].alias("prio"), (-s["end"]).alias("neg"),
        i.alias("seq"), s["end"].alias("end"), s["category"].alias("category"),
        s["source"].alias("source")))

    def merge(a, b):
        better = b["prio"] < a["prio"]
        pick = lambda f: F.when(better, b[f]).otherwise(a[f])
        return F.struct(a["start"].alias("start"), pick("prio").alias("prio"), a["neg"].alias("neg"),
                        a["seq"].alias("seq"), F.greatest(a["end"], b["end"]).alias("end"),
                        pick("category").alias("category"), pick("source").alias("source"))

    folded = _fold(F.array_sort(keyed), elem, merge)
    out = F.transform(folded, lambda s: span(s["start"], s["end"], s["category"], s["source"]))
    return out


def union_plain(spans: Column) -> Column:
    """Label-free union of (start, end)."""
    elem = "struct<start:int,end:int>"
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"))))
    return _fold(ordered, elem, lambda a, b: F.struct(
        a["start"].alias("start"), F.greatest(a["end"], b["end"]).alias("end")))


def splice(text: Column, spans: Column, replacement) -> Column:
    """Replace disjoint sorted spans by replacement(text, span); pieces are joined once.

    Each span is paired with the end of the one before it; the pair behind the last span is the tail.
    """
    def join(t, sp):
        ends = F.concat(F.array(F.lit(0)), F.transform(sp, lambda s: s["end"]))
        pieces = F.zip_with(sp, ends, lambda s, prev: F.concat(
            F.substring(t, prev + 1, F.coalesce(s["start"] - prev, F.lit(2**31 - 1))),
            F.coalesce(replacement(t, s), F.lit(""))))
        return F.array_join(pieces, "")
    return let(text, lambda t: let(spans, lambda sp: join(t, sp)))


def mask(text: Column, spans: Column) -> Column:
    """Equal-length mask: one asterisk per original code point."""
    return splice(text, spans, lambda t, s: F.repeat(F.lit("*"), s["end"] - s["start"]))


def replace_entities(text: Column, entities: Column, name_mask: str = "full") -> Column:
    """Typed replacement of array<struct<type,start,end>>; wrong coordinates or types fail the job."""
    if name_mask not in ("full", "keep-first"):
        raise ValueError("name_mask must be full or keep-first")
    bad = let(F.length(text), lambda n: F.exists(entities, lambda e: ~F.coalesce(
        e["type"].isNotNull() & (e["start"] >= 0) & (e["start"] < e["end"]) & (e["end"] <= n),
        F.lit(False))))
    elem = "struct<start:int,end:int,kind:string>"
    ordered = F.array_sort(F.array_distinct(F.transform(entities, lambda e: F.struct(
        e["start"].cast("int").alias("start"), e["end"].cast("int").alias("end"),
        e["type"].cast("string").alias("kind")))))
    groups = _fold(ordered, elem, lambda a, b: F.struct(
        a["start"].alias("start"), F.greatest(a["end"], b["end"]).alias("end"),
        F.lit(None).cast("string").alias("kind")))

    def replacement(t, s):
        stars = F.repeat(F.lit("*"), s["end"] - s["start"])
        out = stars
        if name_mask == "keep-first":
            kept = F.concat(F.substring(t, s["start"] + 1, F.lit(1)),
                            F.repeat(F.lit("*"), s["end"] - s["start"] - 1))
            out = F.when((s["kind"] == NAME_TYPE) & (s["end"] - s["start"] > 1), kept).otherwise(out)
        for kind, marker in TYPE_MARKERS.items():
            out = F.when(s["kind"] == kind, F.lit(marker)).otherwise(out)
        return out

    return F.when(entities.isNull(), F.raise_error(F.lit("detector gave no result for a record"))) \
            .when(bad, F.raise_error(F.lit("detector gave invalid entity coordinates or type"))) \
            .otherwise(splice(text, groups, replacement))

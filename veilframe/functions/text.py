"""Text functions as column expressions."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.functions.fold import let
from veilframe.session import small

# fixed values: punctuation dropped before answers are compared
ANSWER_PUNCTUATION = "-:_*^/\\~`+=，。：？！“”；’《》…·、「」（）－～『』"
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# fixed values: CJK punctuation and its ASCII counterpart
CJK_PUNCTUATION = {"，": ",", "。": ".", "！": "!", "？": "?", "；": ";", "（": "(", "）": ")",
                   "【": "[", "】": "]", "“": '"'}
FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
HALF_WIDTH = "".join(chr(c) for c in range(0x21, 0x7F))


def cut_sentences(text: Column) -> Column:
    """Chinese sentence split; closing quotes stay with their sentence."""
    # fixed values: sentence ends
    for end in (r"([。！？\?])([^”’])", r"(\.{6})([^”’])", r"(…{2})([^”’])", r"([。！？\?][”’])([^，。！？\?])"):
        text = F.regexp_replace(text, end, "$1\n$2")
    return F.split(F.regexp_replace(text, r"[\s\p{Z}]+\z", ""), "\n")


def half_width(text: Column) -> Column:
    """Full-width forms to ASCII; the ideographic space stays as it is."""
    return F.translate(text, FULL_WIDTH, HALF_WIDTH)


def chunks(text: Column, width: int) -> Column:
    """Fixed-width pieces of a text; an empty text has one empty piece."""
    starts = F.sequence(F.lit(0), F.greatest(F.length(text) - 1, F.lit(0)), F.lit(width))
    return F.transform(starts, lambda s: F.substring(text, s + 1, F.lit(width)))


def rejoin(df: DataFrame, key: str, order: str, value: str, out: str) -> DataFrame:
    """Chunk results back to one text per key, in chunk order (a document's own chunks)."""
    g = df.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(order, value))).alias("_g"))
    return g.select(key, F.array_join(F.col("_g")[value], "").alias(out))


def normalise_answer(text: Column) -> Column:
    """Lower case, no punctuation, no English articles, single spaces."""
    bare = F.translate(F.lower(text), ANSWER_PUNCTUATION + ASCII_PUNCTUATION, "")
    return F.trim(F.regexp_replace(F.regexp_replace(bare, r"(?<![\p{L}\p{N}_])(a|an|the)(?![\p{L}\p{N}_])", " "), r"[\s\p{Z}]+", " "))


def squeeze(text: Column) -> Column:
    """No white space, CJK punctuation as ASCII."""
    return F.translate(F.regexp_replace(text, r"[\s\p{Z}\x1C-\x1F\x85]", ""),
                       "".join(CJK_PUNCTUATION), "".join(CJK_PUNCTUATION.values()))


@F.pandas_udf(T.StringType())
def _strip_accents(texts: pd.Series) -> pd.Series:
    def one(t):
        return "".join(c for c in unicodedata.normalize("NFD", t) if unicodedata.category(c) != "Mn")
    return texts.map(one, na_action="ignore")


def strip_accents(text: Column) -> Column:
    """Decompose and drop combining marks; ASCII texts do not leave the JVM."""
    ascii_only = F.octet_length(text) == F.length(text)
    return F.when(ascii_only, text).otherwise(_strip_accents.asNondeterministic()(F.when(~ascii_only, text)))


def basic_tokens(text: Column, lower: bool = True) -> Column:
    """Word tokens: controls dropped, CJK characters, punctuation and symbols isolated."""
    t = F.regexp_replace(text, "[\\p{Cc}\\p{Cf}\\x{0}\\x{FFFD}&&[^\t\n\r]]", "")
    if lower:
        t = strip_accents(F.lower(t))
    t = F.regexp_replace(t, r"([\p{IsHan}\p{P}$+<=>^`|~])", " $1 ")
    return F.filter(F.split(t, r"[\s\p{Z}]+"), lambda w: w != "")


def words(text: Column) -> Column:
    """Lower-case word tokens of Latin-script text."""
    return F.regexp_extract_all(F.lower(text), F.lit("[0-9a-zà-ÿ]+"), F.lit(0))


def tokens_to_ids(df: DataFrame, token: str, vocab: DataFrame, unk_id: int) -> DataFrame:
    """Join tokens to vocab(token, id); unknown tokens take unk_id."""
    v = vocab.select(F.col("token").alias(token), "id")
    return df.join(small(v), token, "left").withColumn("id", F.coalesce("id", F.lit(unk_id)))


def lcs_len(a, b) -> int:
    """Longest common subsequence length, bit-parallel over the longer sequence."""
    if len(a) < len(b):
        a, b = b, a
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    row = full = (1 << len(a)) - 1
    for y in b:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


@F.pandas_udf(T.LongType())
def lcs_length(left: pd.Series, right: pd.Series) -> pd.Series:
    """LCS length of two token arrays."""
    return pd.Series([lcs_len(list(a), list(b)) for a, b in zip(left, right)], dtype="int64")


def common_substring(a: str, b: str) -> tuple[int, int]:
    """End position in a and length of the first longest common substring.

    What ends at the next character is at most one longer than the longest so far, so one search in b a character is enough.
    """
    best = end = 0
    for i in range(len(a)):
        if a[i - best:i + 1] in b:
            best, end = best + 1, i + 1
    return end, best


@F.pandas_udf(T.StructType([T.StructField("end", T.LongType()), T.StructField("length", T.LongType())]))
def longest_common_substring(left: pd.Series, right: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([common_substring(a, b) for a, b in zip(left, right)], columns=["end", "length"])


def final_answer(text: Column, strict: bool = True) -> Column:
    """Strict: last number behind '#### '. Flexible: last number that is not '' or '.'."""
    if strict:
        found = F.regexp_extract_all(text, F.lit(r"#### (-?[0-9.,]+)"), F.lit(1))
        return F.translate(F.get(found, F.size(found) - 1), ",$", "")
    found = F.regexp_extract_all(text, F.lit(r"-?[0-9.,]+"), F.lit(0))
    real = F.filter(found, lambda x: x != ".")
    # with nothing but dots the first match is what remains
    return F.coalesce(F.get(real, F.size(real) - 1), F.get(found, F.lit(0)))


def template(parts: list) -> Column:
    """Prompt from a typed list: str literal, or dict with 'text' (a column name), 'mask', 'options'."""
    out = []
    for part in parts:
        if isinstance(part, str):
            out.append(F.lit(part))
        elif "text" in part:
            out.append(F.concat(F.lit(part.get("prefix", "")), F.col(part["text"]).cast("string")))
        elif "mask" in part:
            out.append(F.lit("[MASK]" * part["mask"]))
        elif "options" in part:
            out.append(F.lit(part.get("separator", ", ").join(part["options"])))
        else:
            raise ValueError(f"unknown template part {part}")
    return F.concat(*out)


def unify_options(prompt: Column) -> Column:
    """Sort and deduplicate a trailing [b,a] option list."""
    opts = F.regexp_extract(prompt, r"\[([^\[\]]*)\]$", 1)
    prefix = F.regexp_replace(prompt, r"\[[^\[\]]*\]$", "")
    sorted_ = F.array_join(F.array_sort(F.array_distinct(F.split(opts, ","))), ",")
    return F.when(prompt.rlike(r"\[[^\[\]]*\]$"), F.concat(prefix, F.lit("["), sorted_, F.lit("]"))) \
            .otherwise(prompt)


def char_diff(source: Column, target: Column) -> Column:
    """array<struct<position,from,to>> of differing characters of two equally long texts."""
    pairs = F.zip_with(F.split(source, ""), F.split(target, ""), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    tagged = F.transform(pairs, lambda p, i: F.struct(i.alias("position"), p["a"].alias("from"), p["b"].alias("to")))
    return F.filter(tagged, lambda p: ~p["from"].eqNullSafe(p["to"]))


def ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """All n-grams as joined strings; none when the sequence is shorter than n."""
    def grams(t):
        last = F.size(t) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), F.greatest(last, F.lit(0)))) \
                  .otherwise(F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(sep, *[F.get(t, i + k) for k in range(n)]))
    return let(tokens, grams)


def repeats_trigram(tokens: Column) -> Column:
    return let(ngrams(tokens, 3, "\u0001"), lambda g: F.size(g) > F.size(F.array_distinct(g)))


def length_bucket(length: Column, buckets: list[int], default: int) -> Column:
    """Smallest configured length that holds `length`, else the default."""
    fits = F.filter(F.array(*[F.lit(b) for b in sorted(buckets)]), lambda b: b >= length)
    return F.coalesce(F.get(fits, F.lit(0)), F.lit(default))


def is_chinese_date(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy年M月d日")).isNotNull()


def render_chat(df: DataFrame, conv: str, turn: str, role: str, text: str, out: str = "rendered") -> DataFrame:
    """One rendered text per conversation, turns in order."""
    lines = F.sort_array(F.collect_list(F.struct(turn, role, text)))
    g = df.groupBy(conv).agg(lines.alias("_g"))
    return g.select(conv, F.array_join(F.transform("_g", lambda m: F.concat(
        F.lit("<|"), m[role], F.lit("|>\n"), m[text], F.lit("\n"))), "").alias(out))


def chat_messages(df: DataFrame) -> Column:
    """Unify the two conversational layouts by their columns: prompt/completion, or messages."""
    cols = set(df.columns)
    if {"prompt", "completion"} <= cols:
        return F.array(*[F.struct(F.lit(r).alias("role"), F.col(c).alias("content"))
                         for r, c in (("user", "prompt"), ("assistant", "completion"))])
    if "messages" in cols:
        return F.transform("messages", lambda m: F.struct(m["role"].alias("role"), m["content"].alias("content")))
    raise ValueError("no conversational columns")

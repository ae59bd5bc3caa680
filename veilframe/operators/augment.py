"""Text augmentation on token arrays: substitute, insert, swap, delete.

All draws come from hashes of (seed, key, position), so retries and engines agree. Characters work
the same way on split(text, '').
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.operators.corpus import unit
from veilframe.operators.ordering import row_index
from veilframe.operators.rows import seeded
from veilframe.session import materialise, small

EMPTY = "array<int>"


def _plain(token: Column, stop_words: list[str]) -> Column:
    """Not a stop word, not a number, not made of ASCII letters only."""
    keep = ~token.rlike(r"^\p{Nd}+$") & ~token.rlike("^[A-Za-z]+$")
    return keep & ~token.isin(stop_words) if stop_words else keep


def eligible(tokens: Column, stop_words: list[str] = ()) -> Column:
    """Positions open to substitution: plain tokens without any digit."""
    marks = F.transform(tokens, lambda t, i: F.when(_plain(t, list(stop_words)) & ~t.rlike(r"\p{Nd}"), i))
    return F.filter(marks, lambda i: i.isNotNull())


def eligible_pairs(tokens: Column, stop_words: list[str] = ()) -> Column:
    """Positions whose token and right neighbour are both plain."""
    ok = lambda t: _plain(t, list(stop_words))
    pairs = F.zip_with(tokens, F.slice(tokens, F.lit(2), F.size(tokens)), lambda a, b: ok(a) & ok(b))
    return F.filter(F.transform(pairs, lambda p, i: F.when(p, i)), lambda i: i.isNotNull())


def how_many(size: Column, n_eligible: Column | None = None, fixed: int | None = None,
             percent: float = 0.1, least: int = 1, most: int = 10) -> Column:
    """Number of changes: fixed or ceil(percent * size), kept within [least, most], at most 30 % of the eligible."""
    n = F.lit(fixed) if fixed else F.ceil(size * percent)
    n = F.greatest(F.least(n, F.lit(most)), F.lit(least))
    if n_eligible is not None:
        n = F.least(n, F.floor(n_eligible * 0.3))
    return F.when(size == 0, 0).otherwise(n).cast("int")


def choose(positions: Column, n: Column, key: Column, seed: int) -> Column:
    """n positions in hash order, returned ascending."""
    drawn = F.sort_array(F.transform(positions, lambda i: F.struct(seeded(seed, key, i).alias("h"), i.alias("i"))))
    return F.array_sort(F.slice(drawn, F.lit(1), F.greatest(n, F.lit(0)))["i"])


def delete(tokens: Column, chosen: Column) -> Column:
    return let(chosen, lambda c: F.filter(tokens, lambda t, i: ~F.array_contains(c, i)))


def swap(tokens: Column, chosen: Column) -> Column:
    """Exchange each chosen token with its right neighbour, from left to right."""
    def one(t, i):
        return F.concat(F.slice(t, F.lit(1), i), F.array(F.get(t, i + 1), F.get(t, i)),
                        F.slice(t, i + 3, F.size(t)))
    return F.aggregate(chosen, tokens, one)


def change(df: DataFrame, key: str, tokens: str, chosen: str, dictionary: DataFrame, seed: int,
           out: str, insert: bool = False) -> DataFrame:
    """Substitute chosen tokens from dictionary(token, options), or insert an option beside them.

    Only the chosen tokens are exploded, without their text; the dictionary is joined on the token (broadcast when a
    count proves it small), and the few changes per row return as an array and are set between slices of the tokens.
    Rows and dictionary are written once, as both are read twice. Tokens without an entry stay. An inserted word stands
    before or behind by a coin flip.
    """
    df = materialise(df, "tokens")
    places = F.transform(chosen, lambda i: F.struct(i.alias("_i"), F.get(tokens, i).alias("_t")))
    picked = df.select(key, F.explode(places).alias("_p")).select(key, "_p.*")
    words = materialise(dictionary.select(F.col("token").alias("_t"), "options"), "dictionary")
    hit = picked.join(small(words), "_t")
    draw = F.floor(unit(seed, F.col(key), F.col("_i")) * F.size("options")).cast("int")
    before = unit(seed + 1, F.col(key), F.col("_i")) < 0.5
    new = F.get(F.col("options"), draw)
    pair = F.when(before, F.array(new, F.col("_t"))).otherwise(F.array(F.col("_t"), new)) if insert else F.array(new)
    edits = hit.groupBy(key).agg(F.collect_list(F.struct(F.col("_i").alias("i"), pair.alias("w"))).alias("_e"))
    return df.join(edits, key, "left").withColumn(
        out, F.when(F.col("_e").isNull(), F.col(tokens)).otherwise(_spliced(F.col(tokens), F.col("_e")))).drop("_e")


def _spliced(tokens: Column, edits: Column) -> Column:
    """Tokens with edits (i, w) put in the place of their i-th; of edits of one place the first counts."""
    def between(e):
        def one(x, j):
            start = F.when(j > 0, F.get(e, j - 1)["i"] + 1).otherwise(F.lit(0))
            return F.concat(F.slice(tokens, start + 1, x["i"] - start), x["w"])
        tail = F.coalesce(F.get(e, F.size(e) - 1)["i"] + 1, F.lit(0))
        return F.flatten(F.concat(F.transform(e, one), F.array(F.slice(tokens, tail + 1, F.size(tokens)))))
    first = let(edits["i"], lambda at: F.filter(edits, lambda x, j: (F.array_position(at, x["i"]) == j + 1) & (x["i"] < F.size(tokens))))
    return let(F.sort_array(first), between)


def random_dictionary(tokens: DataFrame, vocab: DataFrame, seed: int) -> DataFrame:
    """A random vocabulary word for every distinct token, as dictionary(token, options)."""
    indexed = materialise(row_index(vocab.select(F.col("token").alias("_w")).distinct(), ["_w"], "_idx"), "vocabulary")
    n = indexed.count()
    draw = F.floor(unit(seed, F.col("token")) * n).cast("long")
    return (tokens.select("token").distinct().withColumn("_idx", draw).join(indexed, "_idx")
            .select("token", F.array("_w").alias("options")))


def weighted_choice(rows: DataFrame, key: str, pos: str, weight: str, n: str, seed: int) -> DataFrame:
    """n positions per key without replacement, with probability in proportion to weight.

    The n smallest of -ln(u) / weight are such a sample. Returns (key, positions ascending).
    """
    u = (unit(seed, F.col(key), F.col(pos)) + 1e-12)
    rank = F.when(F.col(weight) > 0, -F.ln(u) / F.col(weight)).otherwise(F.lit(float("inf")))
    g = rows.groupBy(key).agg(F.sort_array(F.collect_list(F.struct(rank.alias("r"), F.col(pos).alias("p")))).alias("_g"),
                              F.first(n).alias("_n"))  # eligible positions of one text
    return g.select(key, F.array_sort(F.slice(F.col("_g")["p"], F.lit(1), F.col("_n"))).alias("positions"))


def variants(df: DataFrame, key: str, n: int) -> DataFrame:
    """n copies per row under the key '<key>-<copy>', to be drawn independently."""
    return df.withColumn("variant", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn(
        "vkey", F.concat_ws("-", F.col(key).cast("string"), F.col("variant").cast("string")))


def distinct_variants(df: DataFrame, key: str, text: str, original: str) -> DataFrame:
    """Variants that differ from the input and from one another."""
    return df.where(F.col(text) != F.col(original)).dropDuplicates([key, text])

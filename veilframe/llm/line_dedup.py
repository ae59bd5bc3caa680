"""Near-duplicate lines by an exact set-similarity join, in DataFrame functions only.

A line is the set of its 5-word shingles. Sets are ordered by rarity; lines whose similarity reaches num / den share a
token of their prefixes, at places that leave room for the overlap they need. Equal lines meet as one class first; a line
is removed when an earlier line of any document, by (id, row key, line number), is equal or similar to it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.functions.fold import let
from veilframe.llm.common import KEY, has_word, row_key, words
from veilframe.session import materialise

SHINGLE = 5
BUCKETS = 1 << 14  # of the frequency sketch: one number each, whatever the size of the corpus
_HASH = (1 << 48) - 1  # bits of a token's hash below its rank
_LINE = ["_s", "_len"]  # a line's words: their hash, and how many characters they have
_AT = ["id", KEY[0], "line"]


def normal(line: Column) -> Column:
    """The line's words, one blank between them."""
    odd = line.rlike(r"[\x09-\x0D]") | F.contains(line, F.lit("  ")) | F.startswith(line, F.lit(" ")) | F.endswith(line, F.lit(" "))
    return F.when(odd, F.array_join(words(line), " ")).otherwise(line)


def _has_word(line: Column) -> Column:
    """has_word(), settled by the first character where that is visible."""
    return (F.ascii(line) > 32) | has_word(line)


def shingles(normal_line: Column, k: int = SHINGLE) -> Column:
    """64-bit hashes of all k-word shingles of a line in normal form; one of the whole line below k words."""
    return let(F.split(normal_line, " "), lambda w: F.when(F.size(w) < k, F.array(F.xxhash64(w))).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def rarity_sketch(lines: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One row `_ranks`: per bucket of token hashes four times the binary logarithm of how often its tokens occur in `_line`s.

    16,384 bytes, whatever the number of lines. Any fixed order of tokens keeps the join exact; this one puts
    common tokens last. Tokens are hashed one per row, as shingles() hashes them.
    """
    w = lines.select(F.split(normal(F.col("_line")), " ").alias("w"))
    each = w.select("w", F.explode(F.sequence(F.lit(0), F.greatest(F.size("w") - k, F.lit(0)))).alias("i"))
    hashed = F.when(F.size("w") < k, F.xxhash64("w")).otherwise(F.xxhash64(*[F.get("w", F.col("i") + j) for j in range(k)]))
    counts = each.groupBy(hashed.bitwiseAND(F.lit(BUCKETS - 1)).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    level = F.least(F.lit(127), F.floor(F.log2(F.coalesce("n", F.lit(1))) * 4)).cast("tinyint")
    whole = lines.sparkSession.range(BUCKETS).join(counts, "id", "left").agg(F.array_sort(F.collect_list(F.struct("id", level.alias("r")))).alias("a"))
    return materialise(whole.select(F.col("a.r").alias("_ranks")), "ranks")


def ranked(tokens: Column, ranks: Column) -> Column:
    """Distinct tokens in order of rarity: the sketch's rank above 48 bits of the hash, sorted."""
    return F.sort_array(F.array_distinct(F.transform(tokens, lambda h: F.shiftleft(
        F.get(ranks, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")).cast("long"), 48).bitwiseOR(h.bitwiseAND(F.lit(_HASH))))))


def _may_match(num: int, den: int) -> Column:
    """Sizes that allow the similarity, and places of a shared token that leave enough tokens behind it.

    Holds at the first token that a similar pair has in common, so no such pair is lost.
    """
    x, y = _size("x.at"), _size("y.at")
    left = F.least(x - _place("x.at"), y - _place("y.at"))
    return ((F.col("x.token") == F.col("y.token")) & (x * num <= y * den) & (y * num <= x * den) & (left * (num + den) >= (x + y) * num))


def _at(n: Column, i: Column) -> Column:
    """Size of a set and place of a token in it as one number, so that a token travels with two others only."""
    return F.shiftleft(n.cast("long"), 32).bitwiseOR(i.cast("long"))


def _size(at: str) -> Column:
    return F.shiftright(at, 32)


def _place(at: str) -> Column:
    return F.col(at).bitwiseAND(F.lit((1 << 32) - 1))


def _keys(id_col: str, text_col: str) -> list[Column]:
    """row_key() with 16 bits of its second number: 80 bits tell documents apart, and many narrow rows carry them."""
    first, second = row_key(id_col, text_col)
    return [first, second.bitwiseAND(F.lit(65535)).cast("int").alias(KEY[1])]


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(*_keys(id_col, text_col), F.struct("*").alias("_row"))


def _of_row(col: str) -> Column:
    """A column of the row, read so that the row stays whole: all uses in a plan then share one exchange of the rows."""
    return let(F.col("_row"), lambda r: r[col])


def _with(base: DataFrame, per_doc: DataFrame, how: str = "inner") -> DataFrame:
    """base with what a table of one narrow row per document has to say; the texts are neither sorted nor moved again."""
    return base.join(per_doc.hint("shuffle_hash"), KEY, how)


def _sets_of(base: DataFrame, wanted: DataFrame, sketch: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(id, k1, k2, _s, _len, _r, fields of wanted's rows) for (k1, k2, _wanted array<struct<line, ...>>): a row per wanted line with its
    ranked tokens."""
    def one(line: Column, x: Column) -> Column:
        return let(normal(line), lambda n: x.withField("_s", F.xxhash64(n)).withField("_len", F.length(n)).withField(
            "_r", ranked(shingles(n, k), F.col("_ranks"))))
    found = _with(base, wanted).crossJoin(F.broadcast(sketch)).select(  # one row of 16 KB
        _of_row(id_col).alias("id"), *KEY, F.explode(let(split_lines(_of_row(text_col)), lambda parts: F.transform(
            "_wanted", lambda x: one(F.get(parts, x["line"]), x)))).alias("_x"))
    # never null, and known to be so: no use of the rows adds a filter of its own, so all share what comes of them
    return found.select("id", *KEY, "_x.*").withColumns({"_s": F.coalesce("_s", F.lit(0)), "_len": F.coalesce("_len", F.lit(0))})


def _removals(docs: DataFrame, base: DataFrame, id_col: str, text_col: str, num: int, den: int, k: int) -> DataFrame:
    """removals() of docs, which base holds as (_k1, _k2, _row)."""
    # keys and parts once per document, below the lines
    parts = docs.select(*_keys(id_col, text_col), F.col(id_col).alias("id"), split_lines(F.col(text_col)).alias("_parts"))
    lines = parts.select(*KEY, "id", F.posexplode("_parts").alias("line", "_line")).filter(_has_word(F.col("_line")))
    sketch = rarity_sketch(lines, k)
    at = F.shiftleft(F.col("line").cast("long"), 16).bitwiseOR(F.col(KEY[1])).alias("at")
    named = lines.withColumn("_line", normal(F.col("_line"))).select(
        F.xxhash64("_line").alias("_s"), F.length("_line").alias("_len"),
        F.struct("id", KEY[0], at, _few_tokens(F.col("_line"), num, den, k).alias("few")).alias("_v"))
    # every line moves once, its number and the second key as one: in the order of its class the first one is the class, the others go
    so_far = Window.partitionBy(*_LINE).orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = named.withColumn("_nth", F.count(F.lit(1)).over(so_far)).withColumn("_first", F.first("_v").over(so_far))
    place = [F.shiftright("at", 16).cast("int").alias("line"), F.col("at").bitwiseAND(F.lit(65535)).cast("int").alias(KEY[1])]
    classes = ordered.filter("_nth = 1").select(*_LINE, "_v.*").select(*_LINE, "id", KEY[0], *place, "few")
    later = ordered.filter(_place_of("_v") != _place_of("_first")).select(_place_of("_v").alias("_v")).select("_v.*").select(KEY[0], *place)
    # the first line of every class, read from the texts where they have been moved to
    first = _sets_of(base, classes.groupBy(*KEY).agg(F.collect_list("line").alias("_l")).select(
        *KEY, F.transform("_l", lambda x: F.struct(x.alias("line"))).alias("_wanted")), sketch, id_col, text_col, k)
    n = F.size("_r")
    sets = first.select(*_LINE, n.alias("n"), F.slice("_r", F.lit(1), n - F.floor((num * n + den - 1) / den).cast("int") + 1).alias("prefix"))
    similar = _similar(sets.filter(~_few(F.col("n"), num, den)), classes, base, id_col, text_col, sketch, num, den, k).union(_same_few(classes))
    gone = later.select(*KEY, "line").union(classes.join(similar, _LINE, "left_semi").select(*KEY, "line"))
    return gone.groupBy(*KEY).agg(F.collect_set("line").alias("removed"))


def _place_of(at: str) -> Column:
    """Document and line: a row that comes twice is one document, so its lines are not removed for each other."""
    return let(F.col(at), lambda v: F.struct(v[KEY[0]].alias(KEY[0]), v["at"].alias("at")))


def _few(n: Column, num: int, den: int) -> Column:
    """Whether a set of n tokens is so small that no other set is similar enough."""
    return n * (den - num) < num


def _few_tokens(normal_line: Column, num: int, den: int, k: int) -> Column:
    """The sorted tokens of a line with so few that only an equal set is similar, if lines of other words can have them; else null.

    For k > 1 such a set's shingles run in a circle, so the line has no more different words than tokens, and repeats one. The
    first words tell most lines apart.
    """
    most = -(-num // (den - num)) - 1 if num < den else 0
    w = F.split(normal_line, " ", most + 2) if 0 < most < 4 else F.split(normal_line, " ")
    if 0 < most < 4:  # of one word more than that two are equal, or there are not so many
        may = reduce(Column.__or__, [F.get(w, F.lit(i)).eqNullSafe(F.get(w, F.lit(j))) for j in range(1, most + 1) for i in range(j)])
        may = may | F.get(w, F.lit(most)).isNull()
    else:
        may = F.size(F.array_distinct(w)) < F.size(w) if k > 1 else F.lit(True)
    return F.when(may, let(F.sort_array(F.array_distinct(shingles(normal_line, k))), lambda r: F.when(_few(F.size(r), num, den), r)))


def _same_few(classes: DataFrame) -> DataFrame:
    """Classes of few tokens whose first line has an earlier line of other words with the same set, as '- - - - - -' of a longer one."""
    few = classes.filter("few IS NOT NULL").select(*_LINE, F.struct(*_AT).alias("_at"), "few")
    first = few.groupBy("few").agg(F.min("_at").alias("_first"))
    return few.join(first, "few").filter(F.col("_first") < F.col("_at")).select(*_LINE)


def _similar(sets: DataFrame, classes: DataFrame, base: DataFrame, id_col: str, text_col: str, sketch: DataFrame, num: int, den: int,
             k: int) -> DataFrame:
    """Classes whose first line has an earlier similar line of another class."""
    # one number stands for a class while it travels with its tokens; the classes themselves stay apart, so classes that share it only
    # make more candidates, which are compared whole; it loses a pair if just these two are similar, one in 2 ** 40.
    # the 24 bits that are not used are the low ones: they come first in a row and are packed with the zeros before them
    number = F.xxhash64(*_LINE).bitwiseAND(F.lit(-1 << 24)).alias("_c")
    rows = sets.select(number, "n", F.posexplode("prefix").alias("i", "token")).select(
        "_c", "token", _at(F.col("n"), F.col("i")).alias("at"))
    shared = rows.alias("x").join(rows.alias("y"), _may_match(num, den) & (F.col("x._c") != F.col("y._c")), "left_semi")
    # tokens that the same lines share say the same about each pair: the first of them is enough, and every pair's first common one stays
    same = Window.partitionBy("token")
    who = shared.withColumn("_who", F.sum(F.xxhash64("_c").cast("decimal(20,0)")).over(same)).withColumn("_many", F.count(F.lit(1)).over(same))
    first = who.groupBy("_c", "_who", "_many").agg(F.min(F.struct(F.col("at").alias("at"), "token")).alias("_p"))
    places = first.groupBy("_c").agg(F.collect_list("_p").alias("_places"))  # a prefix at most
    wanted = classes.select(*KEY, "line", number).join(places, "_c").groupBy(*KEY).agg(
        F.collect_list(F.struct("line", "_places")).alias("_wanted"))
    full = _sets_of(base, wanted, sketch, id_col, text_col, k).select(*_LINE, F.struct(*_AT).alias("_at"), "_places", "_r")
    side = full.select(*_LINE, "_at", "_r", F.explode_outer("_places").alias("_p")).select(
        *_LINE, "_at", F.slice("_r", _place("_p.at").cast("int") + 1, F.size("_r")).alias("_r"), "_p.*")
    # a pair is judged at its first common token: what stands before it in either set is not in the other
    overlap = F.size(F.array_intersect("x._r", "y._r"))
    other = (F.col("x._s") != F.col("y._s")) | (F.col("x._len") != F.col("y._len"))
    near = (_may_match(num, den) & other & (F.col("y._at") < F.col("x._at"))
            & (overlap * (num + den) >= (_size("x.at") + _size("y.at")) * num))
    return side.alias("x").join(side.alias("y"), near, "left_semi").select(*_LINE).distinct()


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4, den: int = 5,
             k: int = SHINGLE) -> DataFrame:
    """(_k1, _k2, removed array<int>): the numbers, from 0, of the lines to remove, for documents that lose any.

    Lines without words always stay. Null texts and empty tables give no rows.
    """
    return _removals(docs, _keyed(docs, id_col, text_col), id_col, text_col, num, den, k)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", num: int = 4, den: int = 5,
                k: int = SHINGLE) -> DataFrame:
    """docs with removed lines cut out of their texts; all rows and columns stay, and n_lines, n_removed are added.

    Columns of those two names are replaced. A null text stays null (no lines removed); a document that
    loses every line has an empty text. Rows that repeat an id with the same text are one document.
    """
    docs = docs.drop("n_lines", "n_removed")
    base = _keyed(docs, id_col, text_col)
    gone = _removals(docs, base, id_col, text_col, num, den, k)
    text = _of_row(text_col)
    kept = let(split_lines(text), lambda parts: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("removed")), lambda i: F.get(parts, i)), "\n"))
    out = _with(base, gone, "left").select(
        F.when(F.col("removed").isNull(), F.col("_row")).otherwise(F.col("_row").withField(f"`{text_col}`", kept)).alias("_row"),
        F.size(split_lines(text)).cast("long").alias("n_lines"),
        F.size(F.coalesce("removed", F.array().cast("array<int>"))).cast("long").alias("n_removed"))
    return out.select("_row.*", "n_lines", "n_removed")

"""Queries over text, token-array, chat, window and reward functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from veilframe.functions import arrays as A
from veilframe.functions import text as T
from veilframe.operators import labels as L
from veilframe.operators import scores as S
from veilframe.operators.rows import seeded
from veilframe.plans.registry import query
from veilframe.session import table

W = "regexp_extract_all(lower(text), '[0-9a-zà-ÿ]+')"


def docs(spark, sf, *cols):
    return table(spark, sf, "documents").select("doc_id", "text", *cols)


def ids(col="text"):
    """Token ids of a text: word lengths, so that both engines agree without a tokenizer."""
    return F.transform(T.words(F.col(col)), lambda w: F.length(w))


def joined(arr, sep=","):
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


IDS = "list_transform(" + W + ", lambda w: length(w))"


@query("cut_sentences", """SELECT doc_id, len(string_split(p, chr(10)))::BIGINT AS sentences, md5(p) AS md5 FROM (SELECT doc_id,
 regexp_replace(regexp_replace(translate(text, '.!', '。！'), '([。！？?])([^”’])', '\\1' || chr(10) || '\\2', 'g'), '[\\s\\pZ]+$', '') AS p FROM documents)""")
def cut_sentences(spark, sf):
    d = docs(spark, sf).select("doc_id", T.cut_sentences(F.translate("text", ".!", "。！")).alias("s"))
    return d.select("doc_id", F.size("s").cast("long").alias("sentences"), F.md5(F.array_join("s", "\n")).alias("md5"))


@query("half_width", "SELECT c_custkey, c_name AS half FROM customer")
def half_width(spark, sf):
    wide = F.translate("c_name", T.HALF_WIDTH, T.FULL_WIDTH)
    return table(spark, sf, "customer").select("c_custkey", T.half_width(wide).alias("half"))


@query("chunk_text", """SELECT doc_id, i AS chunk, md5(substr(text, i * 500 + 1, 500)) AS md5 FROM
 (SELECT doc_id, text, unnest(range((greatest(length(text), 1) + 499) // 500)) AS i FROM documents)""")
def chunk_text(spark, sf):
    d = docs(spark, sf).select("doc_id", F.posexplode(T.chunks(F.col("text"), 500)).alias("chunk", "c"))
    return d.select("doc_id", F.col("chunk").cast("long"), F.md5("c").alias("md5"))


@query("rejoin_chunks", "SELECT doc_id, md5(translate(text, 'aeiou', 'AEIOU')) AS md5 FROM documents")
def rejoin_chunks(spark, sf):
    d = docs(spark, sf).select("doc_id", F.posexplode(T.chunks(F.col("text"), 500)).alias("chunk", "c"))
    return T.rejoin(d.withColumn("c", F.translate("c", "aeiou", "AEIOU")), "doc_id", "chunk", "c", "t").select("doc_id", F.md5("t").alias("md5"))


@query("normalise_answer", r"""SELECT doc_id, md5(array_to_string(list_filter(regexp_split_to_array(translate(lower(text),
 '-:_*^/\~`+=，。：？！“”；’《》…·、「」（）－～『』!"#$%&''(),.;<>?@[]{|}', ''), '[\s\pZ]+'),
 lambda w: w <> '' AND w NOT IN ('a', 'an', 'the')), ' ')) AS md5 FROM documents""")
def normalise_answer(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.normalise_answer(F.col("text"))).alias("md5"))


@query("squeeze_text", r"""SELECT doc_id, md5(translate(regexp_replace(text, '[\s\pZ\x1C-\x1F\x{85}]', '', 'g'), '，。！？；（）【】“', ',.!?;()[]"')) AS md5 FROM documents""")
def squeeze_text(spark, sf):
    return docs(spark, sf).select("doc_id", F.md5(T.squeeze(F.col("text"))).alias("md5"))


@query("basic_tokens", r"""WITH t AS (SELECT doc_id, unnest(regexp_split_to_array(regexp_replace(strip_accents(lower(
 regexp_replace(text, '[^\t\n\r\x20-\x7E\x{A0}-\x{AC}\x{AE}-\x{24FF}]', '', 'g'))), '([\p{Han}\p{P}$+<=>^`|~])', ' \1 ', 'g'), '[\s\pZ]+')) AS w FROM documents)
 SELECT doc_id, count(*) AS tokens, count(DISTINCT w) AS kinds FROM t WHERE w <> '' GROUP BY doc_id""")
def basic_tokens(spark, sf):
    d = docs(spark, sf).select("doc_id", T.basic_tokens(F.col("text")).alias("t"))
    return d.where(F.size("t") > 0).select("doc_id", F.size("t").cast("long").alias("tokens"),
                                           F.size(F.array_distinct("t")).cast("long").alias("kinds"))


@query("sub_word_coverage", f"""WITH w AS (SELECT unnest({W}) AS word FROM documents), c AS (SELECT word, count(*) AS n FROM w GROUP BY 1),
 v AS (SELECT word FROM c WHERE n >= 20)
 SELECT sum(n)::BIGINT AS tokens, (sum(n) FILTER (word NOT IN (SELECT word FROM v)))::BIGINT AS unknown FROM c""")
def sub_word_coverage(spark, sf):
    """Tokens and unknown tokens of the corpus against a whole-word vocabulary."""
    counts = docs(spark, sf).select(F.explode(T.words(F.col("text"))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    vocab = counts.where("n >= 20").select(F.col("word").alias("token"))
    from veilframe.operators.lexicon import sub_words
    pieces = sub_words(counts, vocab)
    unk = F.array_contains("pieces", "[UNK]")
    return pieces.agg(F.sum("n").alias("tokens"), F.sum(F.when(unk, F.col("n"))).alias("unknown"))


@query("tokens_to_ids", f"""WITH w AS (SELECT doc_id, unnest({W}) AS word FROM documents), c AS (SELECT word, count(*) AS n FROM w GROUP BY 1),
 v AS (SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS id FROM c QUALIFY n >= 20)
 SELECT doc_id, sum(coalesce(id, -1))::BIGINT AS id_sum, count(*) FILTER (id IS NULL) AS unk FROM w LEFT JOIN v USING (word) GROUP BY doc_id""")
def tokens_to_ids(spark, sf):
    from veilframe.operators.corpus import build_vocab
    toks = docs(spark, sf).select("doc_id", F.explode(T.words(F.col("text"))).alias("token"))
    vocab = build_vocab(toks, "token", min_freq=20).select("token", "id")
    out = T.tokens_to_ids(toks, "token", vocab, -1)
    return out.groupBy("doc_id").agg(F.sum("id").alias("id_sum"), F.count_if(F.col("id") == -1).alias("unk"))


@query("edit_distance", "SELECT p_partkey, levenshtein(p_name, p_type)::BIGINT AS d FROM part")
def edit_distance(spark, sf):
    return table(spark, sf, "part").select("p_partkey", F.levenshtein("p_name", "p_type").cast("long").alias("d"))


@query("lcs_length", f"""SELECT doc_id, (len({W}) + 1) // 2 AS lcs FROM documents""")
def lcs_length(spark, sf):
    """Every second word of a text is a subsequence of it, so the LCS is its length."""
    w = docs(spark, sf).select("doc_id", T.words(F.col("text")).alias("w"))
    half = F.filter("w", lambda x, i: i % 2 == 0)
    return w.select("doc_id", T.lcs_length(F.col("w"), half).alias("lcs"))


@query("common_substring", """WITH c AS (SELECT *, length(text) AS n FROM conversations)
 SELECT conv_id, turn, CASE WHEN n <= 10 THEN n WHEN n <= 20 THEN 10 ELSE n - 10 END::BIGINT AS length,
 CASE WHEN n <= 10 THEN n WHEN n <= 20 THEN 10 ELSE instr(text, substr(text, 11)) + n - 11 END::BIGINT AS "end" FROM c""")
def common_substring(spark, sf):
    """Every text against itself with its first ten characters moved behind the rest."""
    c = table(spark, sf, "conversations")
    moved = F.concat(F.substring("text", 11, 1 << 30), F.lit("\x01"), F.substring("text", 1, 10))
    s = T.longest_common_substring(F.col("text"), moved)
    return c.select("conv_id", "turn", s.alias("s")).select("conv_id", "turn", "s.length", "s.end")


@query("final_answer", """SELECT doc_id, regexp_extract_all(t, '#### (-?[0-9.,]+)', 1)[-1] AS strict,
 list_filter(regexp_extract_all(text, '-?[0-9.,]+'), lambda x: x <> '.')[-1] AS flexible FROM
 (SELECT doc_id, text, text || ' #### 12 #### -' || doc_id AS t FROM documents) WHERE len(list_filter(regexp_extract_all(text, '-?[0-9.,]+'), lambda x: x <> '.')) > 0""")
def final_answer(spark, sf):
    d = docs(spark, sf).where(F.exists(F.regexp_extract_all("text", F.lit("-?[0-9.,]+"), F.lit(0)), lambda x: x != "."))
    t = F.concat("text", F.lit(" #### 12 #### -"), F.col("doc_id").cast("string"))
    return d.select("doc_id", T.final_answer(t).alias("strict"), T.final_answer(F.col("text"), strict=False).alias("flexible"))


@query("prompt_template", """SELECT o_orderkey, 'order of ' || o_custkey || ' is [MASK][MASK] in urgent/low' AS prompt FROM orders""")
def prompt_template(spark, sf):
    parts = ["order of ", {"text": "o_custkey"}, " is ", {"mask": 2}, " in ", {"options": ["urgent", "low"], "separator": "/"}]
    return table(spark, sf, "orders").select("o_orderkey", T.template(parts).alias("prompt"))


@query("unify_options", "SELECT c_custkey, 'class[' || CASE WHEN c_mktsegment < 'F' THEN c_mktsegment || ',F' WHEN c_mktsegment = 'F' THEN 'F' ELSE 'F,' || c_mktsegment END || ']' AS prompt FROM customer")
def unify_options(spark, sf):
    raw = F.concat(F.lit("class[F,"), "c_mktsegment", F.lit(",F]"))
    return table(spark, sf, "customer").select("c_custkey", T.unify_options(raw).alias("prompt"))


@query("char_diff", "SELECT c_custkey, 8::BIGINT AS position, '#' AS \"from\", '-' AS \"to\" FROM customer")
def char_diff(spark, sf):
    c = table(spark, sf, "customer")
    d = T.char_diff(F.col("c_name"), F.translate("c_name", "#", "-"))
    return c.select("c_custkey", F.explode(d).alias("d")).select("c_custkey", F.col("d.position").cast("long").alias("position"), "d.from", "d.to")


@query("trigram_repeats", f"""WITH t AS (SELECT conv_id, turn, {W} AS w FROM conversations)
 SELECT conv_id, turn, CAST(len(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) < greatest(len(w) - 2, 0) AS INT) AS repeats FROM t""")
def trigram_repeats(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", T.words(F.col("text")).alias("w"))
    return c.select("conv_id", "turn", T.repeats_trigram(F.col("w")).cast("int").alias("repeats"))


@query("length_bucket", "SELECT doc_id, CASE WHEN n_chars <= 128 THEN 128 WHEN n_chars <= 1024 THEN 1024 ELSE 4096 END::BIGINT AS bucket FROM documents")
def length_bucket(spark, sf):
    return table(spark, sf, "documents").select("doc_id", T.length_bucket(F.col("n_chars"), [1024, 128], 4096).cast("long").alias("bucket"))


@query("chinese_dates", """SELECT o_orderkey, CAST(o_orderstatus = 'F' AS INT) AS is_date FROM orders""")
def chinese_dates(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy年M月d日")).otherwise(F.col("o_orderpriority"))
    return o.select("o_orderkey", T.is_chinese_date(text).cast("int").alias("is_date"))


@query("chat_render", """SELECT conv_id, md5(string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn)) AS md5 FROM conversations GROUP BY conv_id""")
def chat_render(spark, sf):
    r = T.render_chat(table(spark, sf, "conversations"), "conv_id", "turn", "role", "text")
    return r.select("conv_id", F.md5("rendered").alias("md5"))


@query("chat_messages", """SELECT conv_id, turn, 'user' AS r1, a.text AS c1, 'assistant' AS r2, b.text AS c2 FROM
 conversations a JOIN (SELECT conv_id, turn - 1 AS turn, text FROM conversations) b USING (conv_id, turn)""")
def chat_messages(spark, sf):
    """Prompt/completion rows recognised by their columns and brought to one message layout."""
    c = table(spark, sf, "conversations")
    nxt = c.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("completion"))
    rows = c.select("conv_id", "turn", F.col("text").alias("prompt")).join(nxt, ["conv_id", "turn"])
    m = rows.select("conv_id", "turn", T.chat_messages(rows).alias("m"))
    return m.select("conv_id", "turn", F.col("m")[0]["role"].alias("r1"), F.col("m")[0]["content"].alias("c1"),
                    F.col("m")[1]["role"].alias("r2"), F.col("m")[1]["content"].alias("c2"))


@query("join_prompt_response", f"""SELECT conv_id, turn, 256::BIGINT * ((len({IDS}) + 8 + 255) // 256)::BIGINT AS width, (coalesce(list_sum({IDS}), 0) + 8 * 3)::BIGINT AS total FROM conversations""")
def join_prompt_response(spark, sf):
    """Left-padded prompt and right-padded response: strip, concatenate, pad to a multiple."""
    zeros = F.array_repeat(F.lit(0), 5)
    prompt = F.concat(zeros, F.array_repeat(F.lit(3), 8))
    both = F.concat(A.strip_padding(prompt, 0), A.strip_padding(F.concat(ids(), zeros), 0))
    c = table(spark, sf, "conversations").select("conv_id", "turn", both.alias("x"))
    padded = A.pad(F.col("x"), A.round_up(F.size("x"), 256), 0)
    return c.select("conv_id", "turn", padded.alias("p")).select(
        "conv_id", "turn", F.size("p").cast("long").alias("width"), F.aggregate("p", F.lit(0), lambda s, v: s + v).cast("long").alias("total"))


@query("pad_batch", f"""WITH t AS (SELECT doc_id, doc_id // 16 AS batch, {IDS} AS ids FROM documents),
 w AS (SELECT batch, ((max(len(ids)) + 7) // 8 * 8)::BIGINT AS width FROM t GROUP BY 1)
 SELECT doc_id, width, len(ids)::BIGINT AS n, coalesce(list_sum(ids), 0)::BIGINT AS total FROM t JOIN w USING (batch)""")
def pad_batch(spark, sf):
    d = docs(spark, sf).select("doc_id", F.floor(F.col("doc_id") / 16).alias("batch"), ids().alias("ids"))
    p = A.pad_batch(d, "batch", {"ids": 0}, multiple=8, masks=True)
    total = F.aggregate("ids", F.lit(0), lambda a, x: a + x)
    n = F.aggregate("ids_mask", F.lit(0), lambda a, x: a + x)
    return p.select("doc_id", F.size("ids").cast("long").alias("width"), n.cast("long").alias("n"), total.cast("long").alias("total"))


@query("eos_mask", f"""SELECT conv_id, turn, CASE WHEN list_position({IDS}, 9) > 0 THEN list_position({IDS}, 9) ELSE len({IDS}) END::BIGINT AS kept FROM conversations""")
def eos_mask(spark, sf):
    m = A.eos_mask(ids(), [9])
    return table(spark, sf, "conversations").select("conv_id", "turn", F.aggregate(m, F.lit(0), lambda a, x: a + x).cast("long").alias("kept"))


@query("truncate_pair", """SELECT o_orderkey, least(a, greatest((40 - 0) // 2, 40 - b))::BIGINT AS n_a, (least(a + b, 40) - least(a, greatest(20, 40 - b)))::BIGINT AS n_b
 FROM (SELECT o_orderkey, (o_custkey % 50)::BIGINT AS a, (o_orderkey % 60)::BIGINT AS b FROM orders)""")
def truncate_pair(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.array_repeat(F.lit(1), (F.col("o_custkey") % 50).cast("int")).alias("a"),
                                          F.array_repeat(F.lit(2), (F.col("o_orderkey") % 60).cast("int")).alias("b"))
    a, b, _ = A.truncate_pair(F.col("a"), F.col("b"), F.size("a") + F.size("b") - 40, "longest_first")
    return o.select("o_orderkey", F.size(a).cast("long").alias("n_a"), F.size(b).cast("long").alias("n_b"))


@query("truncate_second", f"""WITH t AS (SELECT doc_id, {IDS} AS ids FROM documents)
 SELECT doc_id, least(len(ids), 100)::BIGINT AS kept, CASE WHEN len(ids) > 100 THEN len(ids) - 100 + least(10, 100) ELSE 0 END::BIGINT AS overflow FROM t""")
def truncate_second(spark, sf):
    d = docs(spark, sf).select("doc_id", ids().alias("ids")).withColumn("head", F.array(F.lit(1)))
    _, b, over = A.truncate_pair(F.col("head"), F.col("ids"), F.size("ids") - 100, "only_second", stride=10)
    return d.select("doc_id", F.size(b).cast("long").alias("kept"), F.size(over).cast("long").alias("overflow"))


@query("part_budgets", """WITH p AS (SELECT o_orderkey, (o_custkey % 90)::BIGINT AS a, (o_orderkey % 70)::BIGINT AS b FROM orders),
 x AS (SELECT *, 100 - 10 AS room FROM p)
 SELECT o_orderkey, CASE WHEN a + b + 10 <= 100 THEN NULL WHEN a <= 45 THEN a WHEN b <= 45 THEN room - b ELSE 45 END AS la,
 CASE WHEN a + b + 10 <= 100 THEN NULL WHEN b <= 45 THEN b WHEN a <= 45 THEN room - a ELSE 45 END AS lb FROM x""")
def part_budgets(spark, sf):
    lengths = F.array((F.col("o_custkey") % 90).cast("int"), F.lit(10), (F.col("o_orderkey") % 70).cast("int"))
    o = table(spark, sf, "orders").select("o_orderkey", A.part_budgets(lengths, [False, True, False], 100).alias("m"))
    return o.select("o_orderkey", F.col("m")[0].cast("long").alias("la"), F.col("m")[2].cast("long").alias("lb"))


@query("window_chunks", f"""WITH t AS (SELECT doc_id, {IDS} AS ids FROM documents), c AS (SELECT doc_id, ids,
 unnest(range(0, greatest(CEIL((len(ids) - 117) / 50.0)::BIGINT * 50, 0) + 1, 50)) AS start FROM t)
 SELECT doc_id, start, len(ids[start + 1:start + 117])::BIGINT AS n, coalesce(list_sum(ids[start + 1:start + 117]), 0)::BIGINT AS total FROM c""")
def window_chunks(spark, sf):
    d = docs(spark, sf).select("doc_id", F.array_repeat(F.lit(7), 8).alias("q"), ids().alias("ids"))
    c = A.window_chunks(d, "doc_id", "q", "ids", 128, 3, 50)
    total = F.aggregate("ids", F.lit(0), lambda a, x: a + x)
    return c.select("doc_id", F.col("start").cast("long"), F.size("ids").cast("long").alias("n"), total.cast("long").alias("total"))


@query("affix_ids", f"""SELECT conv_id, turn, least(len({IDS}), 27)::BIGINT + 5 AS n, list_sum([1, 2, 3] || {IDS}[1:27] || [4, 5])::BIGINT AS total FROM conversations""")
def affix_ids(spark, sf):
    c = table(spark, sf, "conversations").select("conv_id", "turn", A.with_affixes(ids(), [1, 2, 3], [4, 5], 32).alias("x"))
    return c.select("conv_id", "turn", F.size("x").cast("long").alias("n"), F.aggregate("x", F.lit(0), lambda a, v: a + v).cast("long").alias("total"))


@query("strip_padding", f"""SELECT doc_id, len(list_filter({IDS}, lambda x: x <> 2))::BIGINT AS n FROM documents""")
def strip_padding(spark, sf):
    return docs(spark, sf).select("doc_id", F.size(A.strip_padding(ids(), 2)).cast("long").alias("n"))


@query("strip_edges", """SELECT o_orderkey, 3::BIGINT AS inner_n, (3 + (o_custkey % 5 > 0)::INT)::BIGINT AS eos_n FROM orders""")
def strip_edges(spark, sf):
    z = F.array_repeat(F.lit(0), (F.col("o_custkey") % 5).cast("int"))
    x = F.concat(z, F.array(F.lit(4), F.lit(0), F.lit(5)), z)
    y = F.concat(F.array(F.lit(4), F.lit(0), F.lit(5)), z)
    return table(spark, sf, "orders").select("o_orderkey", F.size(A.strip_edges(x, 0)).cast("long").alias("inner_n"),
                                             F.size(A.strip_right_keep_eos(y, 0)).cast("long").alias("eos_n"))


@query("sequence_mask", "SELECT o_orderkey, (o_custkey % 9)::BIGINT AS valid, (CASE WHEN o_custkey % 9 = 8 THEN 32 ELSE 16 END)::BIGINT AS width FROM orders")
def sequence_mask(spark, sf):
    n = (F.col("o_custkey") % 9).cast("int")
    m = A.valid_mask(n, A.round_up(n + 1 + 8, 16))
    return table(spark, sf, "orders").select("o_orderkey", F.aggregate(m, F.lit(0), lambda a, x: a + x).cast("long").alias("valid"), F.size(m).cast("long").alias("width"))


PAIR = f"""WITH t AS (SELECT conv_id, turn, text, {IDS} AS ids, lead({IDS}) OVER w AS nxt FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)) """


@query("preference_sequence", f"""WITH t AS (SELECT doc_id, {IDS} AS ids FROM documents), s AS (SELECT doc_id,
 len(ids) AS p0, (len(ids) + 1) // 2 AS a0, least(len(ids), len(ids) // 3 + 1) AS b0 FROM t),
 u AS (SELECT doc_id, CASE WHEN p0 + a0 + b0 > 128 THEN least(p0, 32) ELSE p0 END AS p, a0, b0 FROM s),
 v AS (SELECT doc_id, p, CASE WHEN p + a0 + b0 > 128 THEN floor(a0::DOUBLE / (a0 + b0) * (128 - p))::BIGINT ELSE a0 END AS a, a0, b0 FROM u)
 SELECT doc_id, p::BIGINT AS p, a::BIGINT AS a, CASE WHEN p + a0 + b0 > 128 THEN least(b0, 128 - p - a) ELSE b0 END::BIGINT AS b FROM v""")
def preference_sequence(spark, sf):
    """Whole documents as prompts, a half and a third of them as responses."""
    d = docs(spark, sf).select("doc_id", ids().alias("ids"))
    n = F.size("ids")
    prompt, chosen = F.col("ids"), F.slice(F.col("ids"), F.lit(1), F.floor((n + 1) / 2).cast("int"))
    rejected = F.slice(F.col("ids"), F.lit(1), (F.floor(n / 3) + 1).cast("int"))
    none = F.array().cast("array<array<int>>")
    seq = A.preference_sequence(prompt, chosen, rejected, none, 0, 128, 32)
    b = d.select("doc_id", seq.alias("s")).select("doc_id", F.col("s.bounds").alias("b"))
    return b.select("doc_id", F.col("b")[0].cast("long").alias("p"), (F.col("b")[1] - F.col("b")[0]).cast("long").alias("a"),
                    (F.col("b")[2] - F.col("b")[1]).cast("long").alias("b"))


@query("preference_orientation", """SELECT o_orderkey, CASE WHEN o_custkey % 7 > o_orderkey % 7 THEN 'second' ELSE 'first' END AS chosen,
 (o_custkey % 7 <> o_orderkey % 7) AS valid FROM orders""")
def preference_orientation(spark, sf):
    o = table(spark, sf, "orders").select(
        "o_orderkey", F.array("o_orderstatus").alias("src"), F.array().cast("array<string>").alias("tgt"),
        F.array(F.lit("first"), F.lit("second")).alias("response"),
        F.array((F.col("o_orderkey") % 7).cast("int"), (F.col("o_custkey") % 7).cast("int")).alias("sort"))
    return L.oriented_preference(o).select("o_orderkey", "chosen", "valid")


@query("retrieval_triples", """SELECT c_custkey, (c_nationkey % 3 <> 0) AS valid FROM customer""")
def retrieval_triples(spark, sf):
    neg = F.when(F.col("c_nationkey") % 3 == 0, F.array(F.lit(" "))).otherwise(F.array("c_mktsegment"))
    return table(spark, sf, "customer").select("c_custkey", L.valid_triple(F.col("c_name"), F.array("c_name"), neg).alias("valid"))


@query("above_threshold", """SELECT vec_id, i - 1 AS pos, round(embedding[i]::DOUBLE, 6) AS p FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) WHERE embedding[i] > 0.2::FLOAT""")
def above_threshold(spark, sf):
    e = table(spark, sf, "embeddings").select("vec_id", F.explode(L.above(F.col("embedding"), F.lit(0.2).cast("float"))).alias("x"))
    return e.select("vec_id", F.col("x.pos").cast("long").alias("pos"), F.round(F.col("x.p").cast("double"), 6).alias("p"))


# rewards -----------------------------------------------------------------------------------

@query("group_advantage", """SELECT event_id, round(CASE WHEN n = 1 THEN value / (1 + 1e-6) ELSE (value - m) / (s + 1e-6) END, 6) AS advantage FROM
 (SELECT event_id, value, count(*) OVER w AS n, avg(value) OVER w AS m, stddev_samp(value) OVER w AS s FROM events WINDOW w AS (PARTITION BY user_id))""")
def group_advantage(spark, sf):
    e = table(spark, sf, "events").select("event_id", "user_id", "value")
    return S.group_advantage(e, "user_id", "value").select("event_id", F.round("advantage", 6).alias("advantage"))


@query("valid_groups", """SELECT user_id, count(*) AS n FROM events WHERE user_id IN (SELECT user_id FROM events GROUP BY user_id
 HAVING count(*) = 70 AND var_pop(value) > 100) GROUP BY user_id""")
def valid_groups(spark, sf):
    e = table(spark, sf, "events").select("user_id", "value")
    return S.valid_groups(e, "user_id", "value", 70, 100.0).groupBy("user_id").agg(F.count("*").alias("n"))


@query("masked_whiten", """WITH m AS (SELECT avg(value) AS mean, var_samp(value) AS v FROM events WHERE event_type <> 'error')
 SELECT event_id, round((value - mean) / sqrt(v + 1e-8), 6) AS white FROM events, m""")
def masked_whiten(spark, sf):
    e = table(spark, sf, "events").select("event_id", "value", (F.col("event_type") != "error").cast("int").alias("m"))
    return S.whiten(e, "value", "m", "white").select("event_id", F.round("white", 6).alias("white"))


TRAJ = """WITH RECURSIVE w AS (SELECT vec_id, embedding AS e, len(embedding) AS n FROM embeddings),"""


@query("gae_advantage", TRAJ + """ r AS (SELECT vec_id, e, n AS t, 0.0::DOUBLE AS nextv, 0.0::DOUBLE AS adv, 0.0::DOUBLE AS total FROM w UNION ALL
 SELECT vec_id, e, t - 1, e[t]::DOUBLE, (e[t]::DOUBLE * 2 + 0.9 * nextv - e[t]::DOUBLE + 0.9 * 0.8 * adv), total + (e[t]::DOUBLE * 2 + 0.9 * nextv - e[t]::DOUBLE + 0.9 * 0.8 * adv)
 FROM r WHERE t > 0) SELECT vec_id, round(adv, 6) AS first_advantage, round(total, 5) AS total FROM r WHERE t = 0""")
def gae_advantage(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    g = S.gae(F.transform("v", lambda x: x * 2), F.col("v"), F.transform("v", lambda x: F.lit(1)), 0.9, 0.8)
    out = v.select("vec_id", g.alias("g"))
    return out.select("vec_id", F.round(F.col("g")[0]["advantage"], 6).alias("first_advantage"),
                      F.round(F.aggregate("g", F.lit(0.0), lambda a, x: a + x["advantage"]), 5).alias("total"))


@query("discounted_returns", TRAJ + """ r AS (SELECT vec_id, e, n AS t, 0.0::DOUBLE AS run, 0.0::DOUBLE AS ret FROM w UNION ALL
 SELECT vec_id, e, t - 1, (e[t]::DOUBLE + 0.95 * run) * (t % 10 <> 0)::INT, e[t]::DOUBLE + 0.95 * run FROM r WHERE t > 0)
 SELECT vec_id, t, round(ret, 6) AS ret FROM r WHERE t < 64""")
def discounted_returns(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    mask = F.transform("v", lambda x, i: ((i + 1) % 10 != 0).cast("int"))
    r = S.discounted_returns(F.col("v"), mask, 0.95)
    return v.select("vec_id", F.posexplode(r).alias("t", "ret")).select("vec_id", F.col("t").cast("long"), F.round("ret", 6).alias("ret"))


@query("kl_rewards", """SELECT vec_id, i - 1 AS t, round(-0.1 * (embedding[i]::DOUBLE - 0.5 * embedding[i]::DOUBLE) + CASE WHEN i = 60 THEN least(greatest(label::DOUBLE, -5), 5) ELSE 0 END, 6) AS reward
 FROM (SELECT *, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)""")
def kl_rewards(spark, sf):
    v = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("double").alias("score"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    mask = F.transform("v", lambda x, i: (i < 60).cast("int"))
    r = S.kl_rewards(F.col("v"), F.transform("v", lambda x: x * 0.5), mask, F.col("score"), 0.1, 5.0)
    return v.select("vec_id", F.posexplode(r).alias("t", "reward")).select("vec_id", F.col("t").cast("long"), F.round("reward", 6).alias("reward"))


@query("overlong_penalty", "SELECT doc_id, round(least(0, -(n_chars - 1500) / 500.0 * 0.5), 6) AS penalty FROM documents")
def overlong_penalty(spark, sf):
    return table(spark, sf, "documents").select("doc_id", F.round(S.overlong_penalty(F.col("n_chars"), 2000, 500, 0.5), 6).alias("penalty"))


@query("best_candidate", f"""WITH t AS (SELECT conv_id, turn, {W} AS w, length(text) AS score FROM conversations),
 a AS (SELECT conv_id, turn, score - CASE WHEN len(w) >= 60 OR len(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) < greatest(len(w) - 2, 0) THEN 1000 ELSE 0 END AS adj FROM t)
 SELECT conv_id, first(turn ORDER BY adj DESC, turn) AS turn, max(adj)::DOUBLE AS score FROM a GROUP BY conv_id""")
def best_candidate(spark, sf):
    from veilframe.operators.decode import best_candidate as best
    c = table(spark, sf, "conversations").select("conv_id", "turn", T.words(F.col("text")).alias("w"), F.length("text").cast("double").alias("score"))
    return best(c, "conv_id", "turn", "score", F.size("w") >= 60, T.repeats_trigram(F.col("w"))).select("conv_id", "turn", "score")

"""Queries over row operators: sharding, slicing, batching, splitting, padding, labels."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

from veilframe.operators import labels as L
from veilframe.operators import rows as R
from veilframe.operators.ordering import row_index, row_index_by_id, running
from veilframe.plans.registry import query
from veilframe.session import small, table

IDX = """WITH idx AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
 row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders),
 cnt AS (SELECT count(*) AS n FROM orders) """
CIDX = """WITH idx AS (SELECT c_custkey, c_nationkey, c_mktsegment,
 row_number() OVER (ORDER BY c_custkey) - 1 AS row_idx FROM customer),
 cnt AS (SELECT count(*) AS n FROM customer) """


def orders(spark, sf):
    cols = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    return row_index_by_id(table(spark, sf, "orders").select(*cols), "o_orderkey")


def customers(spark, sf):
    cols = ["c_custkey", "c_nationkey", "c_mktsegment"]
    return row_index_by_id(table(spark, sf, "customer").select(*cols), "c_custkey")


@query("global_row_index", """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1
 AS row_idx FROM orders""")
def global_row_index(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return row_index(o, [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "row_idx")


@query("map_rows", """SELECT o_orderkey, upper(o_orderstatus) AS status, round(o_totalprice * 0.1, 4) AS tax
 FROM orders""")
def map_rows(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", F.upper("o_orderstatus").alias("status"),
        F.round(F.col("o_totalprice") * 0.1, 4).alias("tax"))


@query("map_batched", "SELECT doc_id, length(text) * 2 AS double_len FROM documents")
def map_batched(spark, sf):
    def double(batches):
        for b in batches:
            size = pc.multiply(pc.utf8_length(b.column("text")).cast(pa.int64()), 2)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), size], names=["doc_id", "double_len"])
    return table(spark, sf, "documents").select("doc_id", "text").mapInArrow(
        double, "doc_id long, double_len long")


@query("filter_rows", "SELECT o_orderkey FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def filter_rows(spark, sf):
    o = table(spark, sf, "orders")
    return o.where((F.col("o_totalprice") > 100000) & (F.col("o_orderstatus") == "F")).select("o_orderkey")


@query("shard_contiguous", IDX + """SELECT o_orderkey, CAST(CASE WHEN row_idx < (n % 7) * (n // 7 + 1)
 THEN row_idx // (n // 7 + 1) ELSE (n % 7) + (row_idx - (n % 7) * (n // 7 + 1)) // (n // 7) END AS BIGINT)
 AS shard FROM idx, cnt""")
def shard_contiguous(spark, sf):
    o = orders(spark, sf)
    n = table(spark, sf, "orders").count()
    return o.select("o_orderkey", R.shard_id(F.col("row_idx"), n, 7, True).alias("shard"))


@query("shard_strided", IDX + "SELECT o_orderkey, row_idx FROM idx WHERE row_idx % 5 = 3")
def shard_strided(spark, sf):
    return R.shard(orders(spark, sf), 5, 3).select("o_orderkey", "row_idx")


@query("shard_padded", CIDX + """SELECT c_custkey, row_idx % 7 AS shard FROM idx UNION ALL
 SELECT c_custkey, s AS shard FROM idx, cnt, (SELECT unnest(range(7)) AS s)
 WHERE row_idx = n - 1 AND n % 7 <> 0 AND s >= n % 7""")
def shard_padded(spark, sf):
    return R.shard_padded(customers(spark, sf), 7).select("c_custkey", "shard")


@query("skip_rows", IDX + "SELECT o_orderkey FROM idx WHERE row_idx >= 1234")
def skip_rows(spark, sf):
    return R.skip(orders(spark, sf), 1234).select("o_orderkey")


@query("slice_rows", IDX + "SELECT o_orderkey, row_idx FROM idx WHERE row_idx >= 10 AND row_idx < 900 AND (row_idx - 10) % 3 = 0")
def slice_rows(spark, sf):
    return R.slice_rows(orders(spark, sf), 10, 900, 3).select("o_orderkey", "row_idx")


@query("select_rows", CIDX + """SELECT a.row_idx AS new_idx, b.c_custkey FROM idx a, idx b, cnt
 WHERE b.row_idx = (a.c_nationkey * 31 + a.row_idx // 2) % n""")
def select_rows(spark, sf):
    c = customers(spark, sf)
    n = table(spark, sf, "customer").count()
    positions = c.select(F.col("row_idx").alias("new_idx"),
                         ((F.col("c_nationkey") * 31 + R.div(F.col("row_idx"), 2)) % n).alias("row_idx"))
    return R.select_rows(c.select("row_idx", "c_custkey"), positions).select("new_idx", "c_custkey")


@query("reorder_rows", CIDX + "SELECT c_custkey, n - 1 - row_idx AS row_idx FROM idx, cnt")
def reorder_rows(spark, sf):
    c = customers(spark, sf)
    n = table(spark, sf, "customer").count()
    perm = c.select("row_idx", (F.lit(n - 1) - F.col("row_idx")).alias("new_idx"))
    return R.reorder(c.select("c_custkey", "row_idx"), perm).select("c_custkey", "row_idx")


@query("repeat_interleave", CIDX + "SELECT c_custkey, row_idx * 3 + r AS row_idx FROM idx, (SELECT unnest(range(3)) AS r)")
def repeat_interleave(spark, sf):
    return R.repeat(customers(spark, sf), 3).select("c_custkey", "row_idx")


@query("repeat_tiled", CIDX + "SELECT c_custkey, r * n + row_idx AS row_idx FROM idx, cnt, (SELECT unnest(range(3)) AS r)")
def repeat_tiled(spark, sf):
    return R.repeat(customers(spark, sf), 3, interleave=False).select("c_custkey", "row_idx")


@query("chunk_rows", CIDX + "SELECT c_custkey, CAST(row_idx // (n // 10) AS BIGINT) AS chunk FROM idx, cnt")
def chunk_rows(spark, sf):
    return R.chunk(customers(spark, sf), 10).select("c_custkey", "chunk")


@query("micro_batches", CIDX + "SELECT CAST(row_idx // 64 AS BIGINT) AS batch, count(*) AS n_rows, sum(c_custkey)::BIGINT AS keys FROM idx GROUP BY 1")
def micro_batches(spark, sf):
    return (R.micro_batches(customers(spark, sf), 64).groupBy("batch")
            .agg(F.count("*").alias("n_rows"), F.sum("c_custkey").alias("keys")))


@query("fold_rows", CIDX + """SELECT CAST(row_idx // 5 AS BIGINT) AS fold,
 string_agg(c_custkey, ',' ORDER BY row_idx) AS keys, string_agg(c_mktsegment, ',' ORDER BY row_idx) AS segments
 FROM idx GROUP BY 1""")
def fold_rows(spark, sf):
    f = R.fold(customers(spark, sf), 5, ["c_custkey", "c_mktsegment"])
    return f.select("fold", F.array_join(F.transform("c_custkey", lambda x: x.cast("string")), ",").alias("keys"),
                    F.array_join("c_mktsegment", ",").alias("segments"))


@query("unfold_rows", CIDX + "SELECT row_idx, c_custkey, c_mktsegment FROM idx")
def unfold_rows(spark, sf):
    cols = ["c_custkey", "c_mktsegment"]
    return R.unfold(R.fold(customers(spark, sf), 5, cols), 5, cols)


@query("collate_rows", CIDX + """SELECT CAST(row_idx // 50 AS BIGINT) AS batch,
 md5(string_agg(c_custkey || ':' || c_nationkey, '|' ORDER BY row_idx)) AS fingerprint FROM idx GROUP BY 1""")
def collate_rows(spark, sf):
    lists = R.fold(customers(spark, sf), 50, ["c_custkey", "c_nationkey"])
    pairs = F.transform(F.arrays_zip("c_custkey", "c_nationkey"),
                        lambda p: F.concat_ws(":", p["c_custkey"], p["c_nationkey"]))
    return lists.select(F.col("fold").alias("batch"), F.md5(F.array_join(pairs, "|")).alias("fingerprint"))


@query("columns_consistent", """SELECT doc_id, len(string_split(text, ' '))::BIGINT AS n_words,
 len(string_split(text, '. '))::BIGINT AS n_sentences,
 CAST(len(string_split(text, ' ')) = len(string_split(text, '. ')) AS INT) AS consistent FROM documents""")
def columns_consistent(spark, sf):
    d = table(spark, sf, "documents").select(
        "doc_id", F.split("text", " ").alias("words"), F.split("text", r"\. ").alias("sentences"))
    return d.select("doc_id", F.size("words").cast("long").alias("n_words"),
                    F.size("sentences").cast("long").alias("n_sentences"),
                    R.columns_consistent(["words", "sentences"]).cast("int").alias("consistent"))


@query("select_rename", "SELECT c_custkey AS key, c_mktsegment AS segment FROM customer")
def select_rename(spark, sf):
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return R.rename(c, ["c_custkey", "c_mktsegment"], ["key", "segment"])


@query("union_columns", """SELECT d.doc_id, d.lang, d.n_chars, l.quality, l.toxic FROM documents d
 JOIN labels l USING (doc_id)""")
def union_columns(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return R.union_columns(d, table(spark, sf, "labels").join(d.select("doc_id", "lang"), "doc_id"), "doc_id")


@query("pad_to_multiple", CIDX + """SELECT row_idx, c_custkey, 0 AS padded FROM idx UNION ALL
 SELECT n + row_idx, c_custkey, 1 FROM idx, cnt WHERE row_idx < (64 - n % 64) % 64""")
def pad_to_multiple(spark, sf):
    return R.pad_to_multiple(customers(spark, sf), 64).select("row_idx", "c_custkey", "padded")


@query("unpad_rows", CIDX + "SELECT row_idx, c_custkey FROM idx")
def unpad_rows(spark, sf):
    c = customers(spark, sf)
    return R.unpad(R.pad_to_multiple(c, 64), table(spark, sf, "customer").count()).select("row_idx", "c_custkey")


@query("split_ratio", IDX + """, b AS (SELECT n, round(949.0 / 1000 * n)::BIGINT AS a1,
 round(50.0 / 1000 * n)::BIGINT AS a2, round(1.0 / 1000 * n)::BIGINT AS a3 FROM cnt)
 SELECT o_orderkey, CASE WHEN row_idx < a1 - (a1 + a2 + a3 - n) THEN 'train'
 WHEN row_idx < a1 + a2 - (a1 + a2 + a3 - n) THEN 'valid' ELSE 'test' END AS split FROM idx, b""")
def split_ratio(spark, sf):
    return R.split_by_ratio(orders(spark, sf), "949,50,1").select("o_orderkey", "split")


@query("shuffle_rows", CIDX + """SELECT c_custkey, row_number() OVER (ORDER BY md5('42:' || row_idx), row_idx) - 1
 AS position FROM idx""")
def shuffle_rows(spark, sf):
    return row_index(customers(spark, sf), R.shuffle_key(42), "position").select("c_custkey", "position")


@query("shuffle_in_buffers", CIDX + """SELECT c_custkey, row_number() OVER
 (ORDER BY row_idx // 100, md5('42:' || row_idx), row_idx) - 1 AS position FROM idx""")
def shuffle_in_buffers(spark, sf):
    return row_index(customers(spark, sf), R.shuffle_key(42, 100), "position").select("c_custkey", "position")


@query("sort_in_buffers", IDX + """SELECT o_orderkey, row_number() OVER
 (ORDER BY row_idx // 256, o_totalprice DESC, row_idx) - 1 AS position FROM idx""")
def sort_in_buffers(spark, sf):
    order = [R.div(F.col("row_idx"), 256), F.desc("o_totalprice"), F.asc("row_idx")]
    return row_index(orders(spark, sf), order, "position").select("o_orderkey", "position")


@query("sort_by_length", """SELECT doc_id, row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1 AS position,
 (row_number() OVER (ORDER BY n_chars DESC, doc_id) - 1) // 32 AS batch FROM documents""")
def sort_by_length(spark, sf):
    """Length-sorted batching; doc_id is kept, so results return to their order by a plain join."""
    d = table(spark, sf, "documents").select("doc_id", "n_chars")
    return R.batches(row_index(d, [F.desc("n_chars"), F.asc("doc_id")]), 32).select(
        "doc_id", F.col("row_idx").alias("position"), "batch")


@query("batch_rows", IDX + "SELECT o_orderkey, CAST(row_idx // 64 AS BIGINT) AS batch FROM idx, cnt WHERE row_idx // 64 < n // 64")
def batch_rows(spark, sf):
    return R.batches(orders(spark, sf), 64, drop_last=True).select("o_orderkey", "batch")


@query("distributed_batches", IDX + """SELECT o_orderkey, CAST((row_idx - 96) // 64 AS BIGINT) AS step,
 CAST(((row_idx - 96) % 64) // 16 AS BIGINT) AS rank FROM idx WHERE row_idx >= 96""")
def distributed_batches(spark, sf):
    return R.distributed_batches(orders(spark, sf), 16, 4, 96).select("o_orderkey", "step", "rank")


@query("epoch_minibatches", CIDX + """SELECT e AS epoch, CAST(row_idx // 25 AS BIGINT) AS batch,
 sum(c_custkey)::BIGINT AS keys FROM idx, (SELECT unnest(range(3)) AS e) GROUP BY 1, 2""")
def epoch_minibatches(spark, sf):
    return (R.epochs(customers(spark, sf), 25, 3).groupBy("epoch", "batch")
            .agg(F.sum("c_custkey").alias("keys")))


@query("running_total", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
 sum(l_quantity::BIGINT) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey
 ROWS UNBOUNDED PRECEDING)::BIGINT AS running_qty FROM lineitem""")
def running_total(spark, sf):
    li = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long").alias("q"))
    return running(li, ["l_linenumber", "l_partkey", "l_suppkey"], {"running_qty": ("sum", "q")},
                   by=["l_orderkey"]).drop("q")


@query("concat_tables", "SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def concat_tables(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return o.unionByName(o.where("o_orderstatus = 'F'").select("o_orderstatus", "o_orderkey"))


@query("exclude_steps", """SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) AS step
 FROM orders) WHERE NOT (step BETWEEN 5 AND 100 OR step BETWEEN 1000 AND 4000)""")
def exclude_steps(spark, sf):
    return L.exclude_intervals(orders(spark, sf), [(5, 100), (1000, 4000)]).select("o_orderkey")


@query("label_ids", """WITH m AS (SELECT o_orderpriority, min(o_orderkey) AS first FROM orders GROUP BY 1),
 r AS (SELECT o_orderpriority, row_number() OVER (ORDER BY first) - 1 AS label_id FROM m)
 SELECT o_orderkey, label_id FROM orders JOIN r USING (o_orderpriority)""")
def label_ids(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    found = L.discover_labels(o, "o_orderpriority", "o_orderkey")
    return L.to_ids(o, "o_orderpriority", found, "label_id").select("o_orderkey", "label_id")


@query("label_check", """SELECT o_orderpriority AS label, count(*) AS n_rows FROM orders
 WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM') GROUP BY 1""")
def label_check(spark, sf):
    o = table(spark, sf, "orders").select("o_orderpriority")
    return L.unknown_labels(o, "o_orderpriority", ["1-URGENT", "2-HIGH", "3-MEDIUM"])


@query("multi_hot", """SELECT o_custkey, CAST(max(CAST(o_orderstatus = 'F' AS INT)) AS VARCHAR) || ','
 || max(CAST(o_orderstatus = 'O' AS INT)) || ',' || max(CAST(o_orderstatus = 'P' AS INT)) AS hot
 FROM orders GROUP BY o_custkey""")
def multi_hot(spark, sf):
    per = table(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_set("o_orderstatus").alias("labels"))
    hot = L.multi_hot(F.col("labels"), ["F", "O", "P"])
    return per.select("o_custkey", F.array_join(F.transform(hot, lambda x: x.cast("int").cast("string")), ",").alias("hot"))


@query("split_by_pairs", """WITH dev AS (SELECT DISTINCT o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 450000)
 SELECT o_orderkey, CASE WHEN EXISTS (SELECT 1 FROM dev WHERE dev.o_custkey = o.o_custkey
 AND dev.o_orderstatus = o.o_orderstatus) THEN 'dev' ELSE 'train' END AS split FROM orders o""")
def split_by_pairs(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return L.split_by_pairs(o, o.where("o_totalprice > 450000"), ["o_custkey", "o_orderstatus"]).select(
        "o_orderkey", "split")


@query("indexed_test_rows", """SELECT row_number() OVER (ORDER BY o_orderkey) - 1 AS index, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'P'""")
def indexed_test_rows(spark, sf):
    o = table(spark, sf, "orders").where("o_orderstatus <> 'P'").select("o_orderkey", "o_orderstatus")
    return L.indexed(o, ["o_orderkey"]).select("index", "o_orderkey", "o_orderstatus")


@query("drop_invalid_labels", "SELECT o_orderkey FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'")
def drop_invalid_labels(spark, sf):
    return L.drop_invalid(table(spark, sf, "orders"), "o_orderpriority", "4-NOT SPECIFIED").select("o_orderkey")


@query("set_intersection", """SELECT DISTINCT o_custkey AS key FROM orders INTERSECT
 SELECT DISTINCT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING'""")
def set_intersection(spark, sf):
    c = table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select("c_custkey")
    return table(spark, sf, "orders").select(F.col("o_custkey").alias("key")).intersect(c)


@query("symmetric_difference", """SELECT key, CASE WHEN o.key IS NULL THEN 'left' ELSE 'right' END AS side FROM
 (SELECT c_custkey AS key FROM customer WHERE c_nationkey < 20) c FULL JOIN
 (SELECT DISTINCT o_custkey AS key FROM orders WHERE o_totalprice > 200000) o USING (key)
 WHERE c.key IS NULL OR o.key IS NULL""")
def symmetric_difference(spark, sf):
    left = table(spark, sf, "customer").where("c_nationkey < 20").select(F.col("c_custkey").alias("key"))
    right = table(spark, sf, "orders").where("o_totalprice > 200000").select(F.col("o_custkey").alias("key"))
    return L.symmetric_difference(left, right)

import tracemalloc

import pyarrow as pa

from veilframe.operators import extract
from veilframe.operators.extract import mine_relations
from veilframe.plans import load

CONFIG = [
    {"head_role": "人物类", "group": "国籍", "trig_word": ["国籍"], "trig_type": "trigger", "reverse": False,
     "tail_role": [{"main": ["地点类"], "support": ["时间类"]}]},
    {"head_role": "人物类", "group": "作品", "trig_word": ["创作", "著有"], "trig_type": "trigger", "reverse": False, "rel_group": "作者",
     "tail_role": [{"main": ["作品类_实体"], "support": []}, {"main": ["物体类"], "support": ["数量"]}]},
    {"head_role": "人物类", "group": "职业", "trig_word": ["诗人", "画家"], "trig_type": "role", "reverse": False,
     "tail_role": [{"main": ["身份类"], "support": ["时间类"]}]},
    {"head_role": "地点类", "group": "所属", "trig_word": ["位于"], "trig_type": "trigger", "reverse": True,
     "tail_role": [{"main": ["地点类"], "support": []}]},
    {"head_role": "时间类", "group": "事件", "trig_word": ["发生"], "trig_type": "trigger", "reverse": False,
     "tail_role": [{"main": ["事件类"], "support": []}]},
]


def mine(spark, *sentences):
    rows = [(i, None if s is None else [dict(zip(("item", "tag"), t.split("/", 1) if not t.startswith("//") else ("/", t[2:]))) for t in s.split()])
            for i, s in enumerate(sentences)]
    df = spark.createDataFrame(rows, "k int, t array<struct<item:string,tag:string>>")
    flat = lambda xs: [x.item for x in xs]
    return [(r.k, r.group, r.src, r.head.item, flat(r.tails), flat(r.triggers), flat(r.support)) for r in
            sorted(mine_relations(df, "k", "t", CONFIG).collect(), key=lambda r: (r.k, r.head.pos, r.group, r.src))]


def test_tail_to_the_right_with_support_and_joined_tails(spark):
    got = mine(spark, "李白/人物类_实体 1982年/时间类 国籍/信息资料 是/肯定词 中国/地点类_国 、/w 和/连词 唐/地点类 。/w")
    assert got == [(0, "国籍", "HGT", "李白", ["中国", "唐"], ["国籍"], ["1982年"])]


def test_conjunction_needs_its_tag(spark):
    got = mine(spark, "甲/人物类 国籍/x 为/x 中国/地点类 和/连词 法国/地点类 。/w", "甲/人物类 国籍/x 为/x 中国/地点类 和/介词 法国/地点类 。/w")
    assert [g[4] for g in got] == [["中国", "法国"], ["中国"]]


def test_tail_to_the_left_and_stops(spark):
    got = mine(spark, "甲/人物类 的/x 中国/地点类 国籍/x 。/w",  # behind the trigger only a stop
               "甲/人物类 的/x 国籍/x 、/w 中国/地点类 。/w",  # no tail behind a joining stop
               "甲/人物类 的/x 国籍/x ，/w 中国/地点类 。/w",
               "甲/人物类 的/x 国籍/x 乙/人物类 中国/地点类 。/w")  # none behind another head, which finds no trigger itself
    assert got == [(0, "国籍", "HTG", "甲", ["中国"], ["国籍"], [])]


def test_joined_tails_to_the_left(spark):
    assert mine(spark, "甲/人物类 有/x 法国/地点类 、/w 中国/地点类 国籍/x 。/w") == [(0, "国籍", "HTG", "甲", ["中国", "法国"], ["国籍"], [])]


def test_counterpart_and_several_triggers(spark):
    got = mine(spark, "甲/人物类 创作/x 、/w 著有/x 了/x 诗/作品类_实体 《/w 词/作品类_实体 。/w")
    assert got == [(0, "作品", "HGT", "甲", ["诗", "词"], ["创作", "著有"], []), (0, "作者", "REVERSE", "诗", ["甲"], ["创作", "著有"], []),
                   (0, "作者", "REVERSE", "词", ["甲"], ["创作", "著有"], [])]


def test_second_kind_of_tail_has_its_own_support(spark):
    got = mine(spark, "甲/人物类 创作/x 了/x 两/数量词 本/数量 书/物体类_印刷 。/w")
    assert (0, "作品", "HGT", "甲", ["书"], ["创作"], ["本", "两"]) in got


def test_trigger_that_is_the_tail(spark):
    got = mine(spark, "甲/人物类 ，/w 唐代/时间类 诗人/身份类 、/w 官员/身份类 。/w", "甲/人物类 诗人/称呼 。/w", "甲/人物类 、/w 乙/人物类 诗人/身份类 。/w")
    assert got == [(0, "职业", "TAIL", "甲", ["诗人", "官员"], [], ["唐代"]), (2, "职业", "TAIL", "乙", ["诗人"], [], [])]


def test_turned_relation_has_no_other_direction(spark):
    got = mine(spark, "寺/地点类_建筑 位于/x 河南/地点类_省 洛阳/地点类_市 。/w", "寺/组织类 位于/x 河南/地点类 。/w")
    assert [g[:5] for g in got] == [(0, "所属", "HGT", "河南", ["寺"]), (0, "所属", "HGT", "洛阳", ["寺"])]
    got = mine(spark, "洛阳/地点类_市 的/x 位于/x 处/x 河南/地点类_省 、/w 中国/地点类_国 。/w")
    assert [g[:5] for g in got] == [(0, "所属", "HGT", "河南", ["洛阳"]), (0, "所属", "HGT", "中国", ["洛阳"])]


def test_dates_are_times_and_empty_sentences(spark):
    got = mine(spark, "2020年1月3日/数量词 发生/x 了/x 地震/事件类 。/w", None, "", "甲/人物类")
    assert got == [(0, "事件", "HGT", "2020年1月3日", ["地震"], ["发生"], [])]


LONG = [{"head_role": "H", "group": "g", "trig_word": ["the"], "trig_type": "trigger", "reverse": False, "tail_role": [{"main": ["T"], "support": ["S"]}]}]


def arrays(sentences):
    """Sentences of item/tag words as the arrays an Arrow batch has; None stays null."""
    return pa.array([None if s is None else [dict(zip(("item", "tag"), t.split("/"))) for t in s.split()] for s in sentences],
                    pa.list_(pa.struct([("item", pa.string()), ("tag", pa.string())])))


def found(sentences, configs):
    """(sentence, places of head, tails, triggers, support) and the sizes of the batches they come in."""
    out, sizes = [], []
    for at, (group, src, head, *parts) in extract.relations_of(sentences, extract.machines(configs)):
        sizes.append((len(at), sum(len(x.flatten()) for x in parts)))
        flat = [[[q["pos"] for q in row] for row in x.to_pylist()] for x in parts]
        out += zip(at.tolist(), group.to_pylist(), src.to_pylist(), head.field("pos").to_pylist(), *flat)
    return out, sizes


def test_relations_of_a_long_sentence_come_in_batches():
    # 100 heads, each with the 100 triggers behind them all and up to 30 places a relation
    s = " ".join(["a/H", "b/S"] * 100 + ["the/o", *["c/T"] * 30, "，/w"] * 100)
    got, sizes = found(arrays([None, s, "", s]), LONG)
    assert len(got) == 2 * 100 * 100 and {g[0] for g in got} == {1, 3} and len(set(map(str, got))) == len(got)
    assert len(sizes) > 2 and max(n for n, _ in sizes) <= 8192 and max(n for _, n in sizes) <= 65536 + 300
    assert (1, "g", "HGT", 198, [*range(201, 231)], [200], [199]) in got


def test_batches_do_not_change_relations(monkeypatch):
    sentences = arrays(["a/H b/S the/o c/T d/H the/o e/T 、/w f/T", None, "", "the/o c/T", "a/H c/T the/o 。/w", "a/H the/o b/o c/T"] * 3).slice(1)
    want, sizes = found(sentences, LONG)
    assert len(sizes) == 1 and [w for w in want if w[0] == 5] == [
        (5, "g", "HGT", 0, [3], [2], [1]), (5, "g", "HGT", 0, [6, 8], [5], [1]), (5, "g", "HGT", 4, [6, 8], [5], [])]
    for piece, rows in ((1, 1), (4, 2), (12, 100)):
        monkeypatch.setattr(extract, "_PIECE", piece)
        monkeypatch.setattr(extract, "_ROWS", rows)
        assert found(sentences, LONG)[0] == want


def test_relations_hold_a_piece_of_a_batch():
    """A batch of a million tokens: no Python object for each of them."""
    one = arrays([" ".join(["a/H the/o c/T"] + [f"w{i}/o" for i in range(997)])])
    batch = pa.concat_arrays([one] * 1000)
    machines, n = extract.machines(LONG), 0
    tracemalloc.start()
    for at, _ in extract.relations_of(batch, machines):
        n += len(at)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 1000 and peak < 30e6


def test_relations_are_not_joined_to_the_words(spark, tmp_path):
    rows = [(1, "Another big the old house"), (1, "Another big the old house"), (2, "another the the big house"), (3, "another country the big house"),
            (4, None), (5, ""), (None, "another big the old house"), (6, "another big x house the"), (7, "another on the x house the big horse")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = load().QUERIES["mine_relations"](spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == [(1, 0, "another", 4)] * 4 + [(2, 0, "another", 4), (3, 1, "country", 4)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    join = next(line for line in plan.splitlines() if "Join Inner" in line)
    assert "MapInArrow" in plan and "ArrowEvalPython" not in plan and "before" in join and "slice" not in join

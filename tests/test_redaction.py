"""Literal redaction fixtures."""
import json

import pytest
from pyspark.sql import functions as F

from veilframe.operators.redact import findings, redact, redact_json, redact_rules
from veilframe.functions import spans
from veilframe.sources.rules import Rules

S = lambda n: "*" * n
PLAIN = [
    ("我叫陈嘉宁，住南京市栖霞区云栖路86号6栋1203室。姓名：陈嘉宁；地址：北京市朝阳区。", None),
    ("地址：南京市云栖路1234567号", f"地址：南京市云栖路{S(7)}号"),
    ("拨打+86 137-4826-0915，证件320106199204183527。", f"拨打{S(17)}，证件{S(18)}。"),
    ("Ａ：① 联系１３７​４８２６０９１５！", f"Ａ：① 联系{S(12)}！"),
    ("电话：13748260915，地址：南京市，姓名：陈嘉宁", f"电话：{S(11)}，地址：南京市，姓名：陈嘉宁"),
    ("请问手机号码是多少？地址是什么？电话是您本人的吗？", None),
    ("电话：13748260915；车牌：皖A12345", f"电话：{S(11)}；车牌：{S(7)}"),
    ("号码110105491231002 ١٣٨٠٠١٣٨٠٠٠", f"号码{S(15)} {S(11)}"),
    ("13748\n260915", None),
    ("车是皖A12345，另一辆浙BD12345，停在楼下。", f"车是{S(7)}，另一辆{S(8)}，停在楼下。"),
    ("皖ａ·１２３ｂ５、浙 B-D12345、粤Z1234港、沪A1234学", f"{S(8)}、{S(10)}、{S(7)}、{S(7)}"),
    ("皖A12ABC34567890，稍后到。", f"{S(15)}，稍后到。"),
    ("皖A和浙B只是前缀，甲A12345不是库内前缀。", None),
    ("用6222021234567890，还有6222021234567890123。", f"用{S(16)}，还有{S(19)}。"),
    ("用6222 0212 3456 7890或6222-0212-3456-7890-123。", f"用{S(19)}或{S(23)}。"),
    ("６２２２　０２１２　３４５６　７８９０", S(19)),
    ("银行卡号：622202123456789012；车牌号：皖A12345", f"银行卡号：{S(18)}；车牌号：{S(7)}"),
    ("编号123456，1234567，12345678，0000000。", f"编号123456，{S(7)}，{S(8)}，{S(7)}。"),
    ("订单ORD202609210001，流水123456789012345678901234567890。", f"订单ORD{S(12)}，流水{S(30)}。"),
    ("1234 5678、1234-5678、1234\n5678、123456.7", None),
    ("１２３​４５６７；١٢٣٤٥٦٧", f"{S(8)}；{S(7)}"),
    ('"phone": "a\\"b", x', f'"phone": "{S(4)}", x'),
    ("", None),
]
CONFIGURED = [
    ("TEST-ABC；客户编码：ABC123", f"{S(8)}；客户编码：{S(6)}",
     Rules(fields={"客户编号": ["客户编码"]}, known_values={"业务编号": ["TEST-ABC"]})),
    ("皖A12345，浙B12345", f"{S(7)}，浙B12345", Rules(plate_prefixes=("皖A",))),
    ("1234567，12345678", f"1234567，{S(8)}", Rules(min_continuous_digits=8)),
    ("1234567，13748260915，皖A12345，6222021234567890", f"1234567，{S(11)}，{S(7)}，{S(16)}",
     Rules(enable_continuous_digits=False)),
    ("原文ﬃ结束", "原文*结束", Rules(known_values={"自定义": ["ffi"]})),
]



def test_json_leaves_stay_apart(spark):
    rules = Rules(known_values={"id": ["x\ny", "pq"]})
    df = spark.createDataFrame([('{"a":"x","b":"y","c":"x\\ny","d":"pq"}',)], "json string")
    assert redact_json(df, rules).first().redacted == '{"a":"x","b":"y","c":"***","d":"**"}'


def run(spark, texts, fn):
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    return [r.redacted for r in fn(df).orderBy("id").collect()]


def test_rule_fixtures(spark):
    texts = [t for t, _ in PLAIN]
    got = run(spark, texts, redact_rules)
    assert got == [t if e is None else e for t, e in PLAIN]
    assert run(spark, got, redact_rules) == got  # idempotent
    assert [len(g) for g in got] == [len(t) for t in texts]


def test_configured_rules(spark):
    for text, expected, rules in CONFIGURED:
        assert run(spark, [text], lambda df: redact_rules(df, rules)) == [expected]
    r = Rules(known_values={"业务编号": ["TEST-010-12345678-END"]})
    assert run(spark, ["编号TEST-010-12345678-END。"], lambda d: redact(d, r)) == [f"编号{S(21)}。"]
    assert run(spark, ["联系010-12345678。"], redact) == [f"联系{S(12)}。"]


def test_categories(spark):
    df = spark.createDataFrame([(1, "皖A12345，6222021234567890，1234567")], "id long, text string")
    got = [r.category for r in findings(df, ["id"]).orderBy("start").collect()]
    assert got == ["车牌号", "银行卡号", "连续数字"]


@pytest.mark.parametrize("bad", [0, -1, True, 7.5, "7"])
def test_bad_threshold(bad):
    with pytest.raises(ValueError):
        Rules(min_continuous_digits=bad)


def test_json(spark):
    docs = [
        '{"phone":13748260915,"rows":[{"姓名":"陈嘉宁","地址":{"city":"南京"}}],"count":2}',
        '{"phone":"","bank_card":null}',
        '{"name":"陈嘉宁","serial":1234567,"card_number":6222021234567890,"other":6222021234567890,'
        '"plate":"皖A12345","count":6,"ok":true}',
        '{"phone":["12","345"]}',
    ]
    df = spark.createDataFrame(list(enumerate(docs)), "id int, json string")
    got = [json.loads(r.redacted) for r in redact_json(df).orderBy("id").collect()]
    first = json.loads(docs[0]) | {"phone": S(11)}
    third = json.loads(docs[2]) | {"serial": S(7), "card_number": S(16), "other": S(16), "plate": S(7)}
    assert got == [first, json.loads(docs[1]), third, {"phone": S(12)}]


ENTITY_CASES = [
    ("陈嘉宁", [("姓名", 0, 3)], "full", "***"),
    ("陈嘉宁", [("姓名", 0, 3)], "keep-first", "陈**"),
    ("陈", [("姓名", 0, 1)], "keep-first", "*"),
    ("ABCDEFGHIJ", [("姓名", 1, 4), ("地址", 3, 6), ("工作单位", 5, 8)], "keep-first", f"A{S(7)}IJ"),
    ("ABCDE!", [("地址", 0, 3), ("地址", 0, 3), ("工作单位", 3, 5)], "full", "[地址已脱敏][单位已脱敏]!"),
    ("陈嘉宁住南京市栖霞区，在云杉科技公司工作。", [("姓名", 0, 3), ("地址", 4, 10), ("工作单位", 12, 18)],
     "full", "***住[地址已脱敏]，在[单位已脱敏]工作。"),
]


def entity_frame(spark, text, ents):
    return spark.createDataFrame([(text, ents)],
                                 "text string, e array<struct<type:string,start:int,end:int>>")


@pytest.mark.parametrize("text,ents,how,expected", ENTITY_CASES)
def test_entity_replacement(spark, text, ents, how, expected):
    df = entity_frame(spark, text, ents)
    assert df.select(spans.replace_entities(F.col("text"), F.col("e"), how)).first()[0] == expected


@pytest.mark.parametrize("bad", [("地址", -1, 1), ("地址", 0, 0), ("地址", 2, 1), ("地址", 0, 4),
                                 (None, 0, 1)])
def test_bad_entities_fail(spark, bad):
    df = entity_frame(spark, "ABC", [bad])
    with pytest.raises(Exception):
        df.select(spans.replace_entities(F.col("text"), F.col("e"))).collect()


def test_hybrid(spark):
    seen = []

    def detector(df, text):
        places = [("陈嘉宁", "姓名"), ("南京市栖霞区", "地址")]
        ents = F.filter(F.array(*[F.struct(
            F.lit(kind).alias("type"), (F.instr(text, word) - 1).alias("start"),
            (F.instr(text, word) - 1 + len(word)).alias("end")) for word, kind in places]),
            lambda e: e["start"] >= 0)
        seen.extend(r[0] for r in df.select(text).collect())
        return df.withColumn("entities", ents)

    texts = ["电话１３７４８２６０９１５，陈嘉宁住南京市栖霞区。\r\n", " \t\r\n", "", "陈嘉宁\n"]
    got = run(spark, texts, lambda d: redact(d, detector=detector))
    assert got == [f"电话{S(11)}，***住[地址已脱敏]。\r\n", " \t\r\n", "", "***\n"]
    assert sorted(x for x in seen if x) == sorted([f"电话{S(11)}，陈嘉宁住南京市栖霞区。\r\n", "陈嘉宁\n"])


def test_rule_file(tmp_path):
    from veilframe.sources.rules import load_rules
    (tmp_path / "plates.json").write_text('["皖A", "皖B"]', encoding="utf-8")
    config = tmp_path / "rules.json"
    config.write_text(json.dumps({"fields": {"客户编号": ["客户编码"]}, "min_continuous_digits": 8,
                                  "plate_prefixes_file": "plates.json"}), encoding="utf-8")
    rules = load_rules(config)
    assert rules.digit_threshold == 8 and rules.plate_letters() == {"皖": "AB"}
    for bad in ({"other": 1}, {"fields": {"a": [""]}}, {"enable_continuous_digits": 1}, {"known_values": ["x"]}):
        config.write_text(json.dumps(bad), encoding="utf-8")
        with pytest.raises(ValueError):
            load_rules(config)


def test_repartitioning_changes_nothing(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(PLAIN)], "id int, text string")
    results = [sorted((r.id, r.redacted) for r in redact(df.repartition(n)).collect()) for n in (1, 17)]
    assert results[0] == results[1]

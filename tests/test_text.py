import re

import pytest
from cuegrain.functions import text as T
from pyspark.sql import functions as F


def one(spark, expression, **values):
    df = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)) if values else spark.range(1)
    return df.select(expression.alias("x")).first()["x"]


def test_containment_and_grams(spark):
    c = lambda a, b: one(spark, T.containment(F.col("a"), F.col("b")), a=a, b=b)
    assert c("一月為胞", "他說一月為胞精血凝也") == 1.0
    assert c("一 月　為 胞", "一月為胞") == 1.0
    assert c("", "甲乙") == 0.0 and c("甲", "甲") == 1.0 and c("甲乙丙", "甲乙") == 0.5
    assert c(None, "甲") is None
    assert one(spark, T.gram_list(F.col("a"), 2), a="甲") == [] and one(spark, T.gram_list(F.col("a"), 2), a=None) is None
    assert one(spark, T.grams(F.col("a"), 3), a="甲 乙") == ["甲乙"]
    assert one(spark, T.agreement(F.col("a"), F.col("b")), a="甲乙丙", b="甲乙") == 0.5


def test_markdown_and_pieces(spark):
    m = lambda a: one(spark, T.strip_markdown(F.col("a")), a=a)
    assert m("**一月為胞**，精血凝也") == "一月為胞，精血凝也"
    assert m("## 標題\n- 條列項") == "標題 條列項"
    assert m("一月為胞\n\n精血凝也") == "一月為胞 精血凝也"
    s = lambda a, n: one(spark, T.split_long(F.col("a"), n), a=a)
    assert s("短。", 10) == ["短。"] and s("", 5) == [""]
    assert s("甲乙。丙丁。戊己庚。", 6) == ["甲乙。丙丁。", "戊己庚。"]
    assert s("一二三四五六七八。九。", 4) == ["一二三四", "五六七八", "。九。"]
    for text in ("甲乙丙丁戊。" * 30 + "x" * 95 + "！" + "己。" * 40, "x" * 100):
        pieces = s(text, 40)
        assert "".join(pieces) == text and all(0 < len(p) <= 40 for p in pieces)


def test_entities_and_symbols(spark):
    e = lambda a: sorted(one(spark, T.named_entities(F.col("a")), a=a))
    assert e("《黃帝內經》第三章說2.5公分，一九九九年") == sorted({"黃帝內經", "2.5", "三", "一九九九", "一九九九年"})
    u = lambda a, b: one(spark, T.unsupported_entities(F.col("a"), F.col("b")), a=a, b=b)
    assert u("兩組靜脈，分為兩種", "2 組靜脈") == [] and u("《甲》七成", "甲") == ["七"]
    assert one(spark, T.symbol_entities(F.col("a")), a="Rz(φ) 是 4x4，R₁₁ 與 T_2") == ["4x4", "Rz(φ)", "R₁₁", "T_2"]
    s = lambda a, b: one(spark, T.unsupported_symbols(F.col("a"), F.col("b")), a=a, b=b)
    many = lambda a: one(spark, T.symbol_entities(F.col("a")), a=a)
    assert many("f(x1) ab(x_1, 3x4) 12 × 3y_2 a1. b2") == ["12 × 3", "ab(x_1, 3x4)", "b2", "x1"] and many("") == []
    assert s("nₓ x₂₃", "n x23") == ["nₓ"] and s("3 x 12", "三乘以一二") == [] and s("3×4", "三×四") == ["3×4"] and s("T_2", "T2") == []
    assert s("4x4 的 R11", "四乘四的 R 一一") == [] and s("4x4", "三乘三") == ["4x4"]


def test_similarities(spark):
    r = lambda a, b: one(spark, T.common_substring_ratio(F.col("a"), F.col("b")), a=a, b=b)
    assert r("甲乙丙", "x甲乙丙x") == 1.0 and r("甲乙丙丁", "丙丁甲乙") == 0.5 and r("", "甲") == 0.0
    plain = lambda a, b: max((n for n in range(1, len(a) + 1) for i in range(len(a) - n + 1) if a[i : i + n] in b), default=0)
    import random

    rng = random.Random(1)
    texts = [("".join(rng.choice("甲乙丙") for _ in range(rng.randrange(30))), "".join(rng.choice("甲乙丙") for _ in range(rng.randrange(30)))) for _ in range(200)]
    assert T.longest_common(*map(list, zip(*texts))).tolist() == [plain(a, b) for a, b in texts]
    assert T.longest_common([], []).tolist() == [] and T.longest_common(["a" * 30_000], ["a" * 20_000 + "b"]).tolist() == [20_000]
    c = lambda a, b: one(spark, T.cer(F.col("a"), F.col("b")), a=a, b=b)
    assert c("", "") == 0.0 and c("甲", "") == 1.0 and c("意地論", "瑜伽師地論") == pytest.approx(3 / 5)
    t = lambda a, b, **k: one(spark, T.token_similarity(F.col("a"), F.col("b"), **k), a=a, b=b)
    assert t("", "") == 1.0 and t("甲", "") == 0.0 and t("钵", "波", sounds={"钵": "bo", "波": "bo"}) == 1.0
    j = lambda a, b: one(spark, T.rejection(F.col("a"), F.col("b")), a=a, b=b)
    assert j("ABC", "abc") == "case" and j("五蘊", "五蘊，色受想行識") == "insertion" and j("買房子", "受精卵著床") == "rewrite" and j("憍梵钵提", "憍梵波提") is None


def test_corrections(spark):
    assert T.replace_unprotected("現在過去未來", "未", "未來") == "現在過去未來"
    assert T.replace_unprotected("未與未來", "未", "未來") == "未來與未來"
    assert T.replace_unprotected("aaab", "aa", "aab") == "aabab"
    df = spark.createDataFrame([("時運與時運", ["時運"], ["識蘊"]), ("甲", ["乙"], ["丙"]), (None, None, None)], "t string, b array<string>, a array<string>")
    assert [r[0] for r in df.select(T.apply_corrections("t", "b", "a")).collect()] == ["識蘊與識蘊", None, None]


def test_small_functions(spark):
    assert one(spark, T.referential_phrases(F.col("a")), a="這張圖所說的，如上圖，這張圖") == ["如上圖", "這張圖"]
    assert one(spark, T.clean_caption(F.col("a")), a=" <c>a</c>  &lt;b&gt; &amp;amp; ") == "a <b> &amp;"
    import html

    for text in ("a &amp;lt; b &#60;&#x3C;&#x1F600;&#128; &hellip;&ampx; &notit; &copy &nosuch; & &; &#; &#0; &#xD800; &#1;&#99999999999;&NotEqualTilde;", "", "plain", "&&amp;&"):
        assert one(spark, T.unescape(F.col("a")), a=text) == html.unescape(text)
    assert one(spark, T.clock(F.lit(3725.9))) == "01:02:05" and one(spark, T.clock_seconds(F.lit("01:02:03.500"))) == 3723.5
    assert one(spark, T.quota_limit(F.col("a")), a="PerDay 'quotaValue': '20'") == 20 and one(spark, T.quota_limit(F.col("a")), a="limit: 5") is None
    assert one(spark, T.status_code(F.col("a")), a="429 too many") == 429 and one(spark, T.status_code(F.col("a")), a="{'code': 503}") == 503
    assert T.params_hash({"a": 1, "b": 2}) == T.params_hash({"b": 2, "a": 1}) and re.fullmatch("[0-9a-f]{16}", T.params_hash({}))
    assert one(spark, T.fingerprint(F.col("a"), F.lit(None).cast("string")), a="x") is None
    assert one(spark, T.terms(F.col("a")), a="甲乙，丙丁 甲乙、戊") == ["甲乙", "丙丁"] and one(spark, T.han_runs(F.col("a")), a="甲乙丙a丁戊") == ["甲乙丙"]
    assert one(spark, T.number_variants(F.col("a")), a="二") == ["二", "2", "兩"] and one(spark, T.number_variants(F.col("a")), a="33") == ["33"]
    assert one(spark, T.coverage(F.col("a"), F.col("b")), a="甲乙丙丁", b="甲乙丙x") == 0.5

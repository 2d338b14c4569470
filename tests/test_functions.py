import pytest
from pyspark.sql import functions as F

from tallywire.functions.clock import iso_text, iso_timestamp, millis_to_iso, run_id
from tallywire.functions.numbers import json_number, number_text, round_half_up
from tallywire.functions.strict_json import parse_strict
from tallywire.functions.text import pad_left, pad_right, utf8_text, utf16_char, utf16_length, utf16_prefix


def values(spark, rows, kind, column):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r[0] for r in df.orderBy("i").select(column).collect()]


@pytest.mark.parametrize(
    "decimals, cases",
    [
        (2, {1.005: 1.0, -0.125: -0.12, 0.125: 0.13, 21.4567: 21.46, 45.4321: 45.43, -7.5: -7.5, 1e300: 1e300}),
        (3, {0.12345: 0.123, 2.0005: 2.001, -0.0005: 0.0}),
        (0, {0.49999999999999994: 0.0, 0.5: 1.0, -0.5: 0.0, 1e18: 1e18}),
    ],
)
def test_round_half_up(spark, decimals, cases):
    assert values(spark, list(cases), "double", round_half_up(F.col("x"), decimals)) == list(cases.values())


def test_round_of_nothing(spark):
    assert values(spark, [None, float("nan"), float("inf")], "double", round_half_up(F.col("x"), 2)) == [None] * 3


def test_number_text(spark):
    cases = {
        120.0: "120", 91.2: "91.2", -30.0: "-30", 0.0: "0", -0.0: "0", 0.001: "0.001", 0.0001: "0.0001",
        1e-6: "0.000001", 1.5e-7: "1.5e-7", 1e7: "10000000", 12345678.25: "12345678.25", 1e20: "100000000000000000000",
        1e21: "1e+21", 1.5e22: "1.5e+22", 123456.5: "123456.5", -2e7: "-20000000",
    }
    assert values(spark, list(cases), "double", number_text(F.col("x"))) == list(cases.values())


def test_json_number(spark):
    column = F.to_json(F.struct(json_number(F.col("x")).alias("v")), {"ignoreNullFields": "false"})
    found = values(spark, [3.0, 3.5, None, float("inf")], "double", column)
    assert found == ['{"v":3}', '{"v":3.5}', '{"v":null}', '{"v":null}']


def test_utf8_text(spark):
    rows = [b"abc", "é😀".encode(), b"a\xffb", None]
    assert values(spark, rows, "binary", utf8_text(F.col("x"))) == ["abc", "é😀", "a�b", ""]


def test_utf16(spark):
    assert values(spark, ["", "abc", "é", "😀a"], "string", utf16_length(F.col("x"))) == [0, 3, 1, 3]
    prefix = utf16_prefix(F.col("x"), 3)
    rows = ["abcd", "ab", "😀😀", "a😀b", "ab😀", "ééééé"]
    assert values(spark, rows, "string", prefix) == ["abc", "ab", "😀�", "a😀", "ab�", "ééé"]
    assert values(spark, [65, 90, 955, 0xD800], "int", utf16_char(F.col("x"))) == ["A", "Z", "λ", "�"]


def test_padding_never_cuts(spark):
    assert values(spark, ["7", "1234567"], "string", pad_left(F.col("x"), 6, "0")) == ["000007", "1234567"]
    assert values(spark, ["ab", "abcdef"], "string", pad_right(F.col("x"), 4)) == ["ab  ", "abcdef"]


def test_iso_timestamp(spark):
    good = {
        "2026-09-30": "2026-09-30T00:00:00.000Z",
        "2026-09-30T10:00": "2026-09-30T10:00:00.000Z",
        "2026-09-30T10:00:01.5Z": "2026-09-30T10:00:01.500Z",
        "2026-09-30T10:00:01+02:00": "2026-09-30T08:00:01.000Z",
        "2026-09-30T10:00:01+0200": "2026-09-30T08:00:01.000Z",
        "2026-02-30": "2026-03-02T00:00:00.000Z",
        "2026-02-31T10:00:00Z": "2026-03-03T10:00:00.000Z",
    }
    column = iso_text(iso_timestamp(F.col("x")))
    assert values(spark, list(good), "string", column) == list(good.values())
    bad = ["2026-09-40T10:00:00Z", "2026-09-3xT10:00:00Z", "2026-09-30T10:00:00.5abZ", "yesterday", "T10:00", "", "2026-13-01", "2026-09-32", "2026-09-00", "2026-09-30T25:00", "2026", "30.9.2026"]
    assert values(spark, [*bad, None], "string", column) == [None] * (len(bad) + 1)


def test_iso_text(spark):
    assert values(spark, [1_790_762_400_007], "bigint", millis_to_iso(F.col("x"))) == ["2026-09-30T10:00:00.007Z"]
    assert values(spark, [1_790_762_400_007], "bigint", run_id(F.timestamp_millis("x"))) == ["2026-09-30T10-00-00-007Z"]


def test_parse_strict(spark):
    good = {
        '{"a":1}': '{"a":1}', " [1] ": "[1]", "null": "null", '"x"': '"x"', "7": "7", '{"a":"]"}': '{"a":"]"}',
        '{"a":1,"a":2}': '{"a":2}', '{"a":[1,{"b":[]}]}': '{"a":[1,{"b":[]}]}', "\n\t true": "true",
    }
    column = F.to_json(parse_strict(F.col("x")))
    assert values(spark, list(good), "string", column) == list(good.values())
    bad = [
        "", " ", '{"a":', '{"a":1} x', "1] x", "1} x", "1,2", '{"a":1}{"b":2}', '1,"_end":1} g', "[1]]", "]", "][",
        "{'a':1}", "{a:1}", "NaN", '{"a":01}', "[1,]", "1]", '"]',
    ]
    assert values(spark, [*bad, None], "string", column) == [None] * (len(bad) + 1)

"""Column functions: one test per rule."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitchflow import functions as P


def values(spark, rows, schema, column):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(column).collect()]


@pytest.mark.parametrize(
    ("text", "want"),
    [("55%", 55), ("1.7", 2), ("-2.5", -3), (" 45 ", 45), ("1e2", 100), ("x", None), ("", None), (None, None)],
)
def test_percent_to_number(spark, text, want):
    assert values(spark, [(text,)], "a string", P.percent_to_number(F.col("a"))) == [want]


def test_try_to_number_keeps_percent_as_text(spark):
    assert values(spark, [("55%",)], "a string", P.try_to_number(F.col("a"))) == [None]


@pytest.mark.parametrize(
    ("name", "want"),
    [("  José  Núñez ", "jos nez"), ("O'Neil-Smith", "oneilsmith"), ("Мбаппе", ""), ("", ""), (None, None), ("A\tB", "ab")],
)
def test_name_key(spark, name, want):
    assert values(spark, [(name,)], "a string", P.name_key(F.col("a"))) == [want]


def test_full_name(spark):
    rows = [("A", "B"), (None, "B"), ("A", None), (None, None), (" ", "")]
    assert values(spark, rows, "a string, b string", P.full_name(F.col("a"), F.col("b"))) == ["A B", "B", "A", None, None]


def test_event_id_is_null_when_a_part_is(spark):
    rows = [("t", 1, 2), ("t", None, 2)]
    got = values(spark, rows, "t string, p int, o long", P.event_id(F.col("t"), F.col("p"), F.col("o")))
    assert got == ["t:1:2", None]


def test_event_time_takes_the_first_known(spark):
    a, b, c = (dt.datetime(2025, 1, d) for d in (1, 2, 3))
    rows = [(a, b, c), (None, b, c), (None, None, c), (None, None, None)]
    schema = "a timestamp_ntz, b timestamp_ntz, c timestamp_ntz"
    assert values(spark, rows, schema, P.event_time(*[F.col(x) for x in "abc"])) == [a, b, c, None]


@pytest.mark.parametrize(
    ("detail", "want"),
    [("Red Card", "red"), ("Second YELLOW card", "yellow"), ("yellow then red", "red"), ("Foul", "unknown"), (None, "unknown")],
)
def test_card_color(spark, detail, want):
    assert values(spark, [(detail,)], "a string", P.card_color(F.col("a"))) == [want]


def test_side_label(spark):
    assert values(spark, [(0,), (1,), (2,)], "a long", P.side_label(F.col("a"))) == ["home", "away", "unknown_2"]


def test_times(spark):
    assert values(spark, [(1700000000123,), (None,)], "a long", P.epoch_ms_to_ntz(F.col("a"))) == [
        dt.datetime(2023, 11, 14, 22, 13, 20, 123000),
        None,
    ]
    text = [("2025-08-16 14:23:07.9",), ("2025-08-16T14:23:07+07:00",)]
    assert values(spark, text, "a string", P.to_ntz_seconds(F.col("a"))) == [dt.datetime(2025, 8, 16, 14, 23, 7)] * 2


def test_utf8_text(spark):
    assert values(spark, [(bytearray("Núñez", "utf-8"),), (None,)], "a binary", P.utf8_text(F.col("a"))) == ["Núñez", None]


def test_parsed_drops_what_is_not_json_but_keeps_json_null(spark):
    rows = [(1, '{"a":1}'), (2, "broken"), (3, ""), (4, None), (5, "null"), (6, '{"a":1,"a":2}')]
    df = spark.createDataFrame(rows, "id int, v string")
    assert [r.id for r in P.parsed(df, "v").orderBy("id").collect()] == [1, 5]
    assert P.parsed(df, "v", keep_null=True).count() == 6


def test_parsed_parses_once(spark):
    df = spark.createDataFrame([('{"a":1,"b":2}',)], "v string")
    out = P.parsed(df, "v").select(P.number(F.col("p"), "$.a"), P.number(F.col("p"), "$.b"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("parseJson") == 1


def test_parsed_reads_a_stored_variant_without_parsing(spark, tmp_path):
    path = str(tmp_path / "raw")
    spark.createDataFrame([('{"a":1}',)], "v string").select(F.parse_json("v").alias("v")).write.parquet(path)
    out = P.parsed(spark.read.parquet(path), "v").select(P.number(F.col("p"), "$.a"))
    assert "parseJson" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.first()[0] == 1


def test_number_rounds_and_is_strict(spark):
    df = P.parsed(spark.createDataFrame([('{"a":1.7,"b":"12","c":null,"d":"x"}',)], "v string"), "v")
    p = F.col("p")
    row = df.select(*[P.number(p, f"$.{k}").alias(k) for k in ("a", "b", "c", "missing")]).first()
    assert tuple(row) == (2, 12, None, None)
    with pytest.raises(Exception, match="INVALID_VARIANT_CAST"):
        df.select(P.number(p, "$.d")).collect()
    assert df.select(P.try_jget(p, "$.d", "bigint")).first()[0] is None


def test_safe_path(spark):
    df = P.parsed(spark.createDataFrame([('{"a":{"b":[1,{"c":null}]}}',)], "v string"), "v")
    p = F.col("p")
    row = df.select(
        P.safe_path(p, ["a", "b", 0], "bigint", -1),
        P.safe_path(p, ["a", "b", 5], "bigint", -1),
        P.safe_path(p, ["a", 0], "bigint", -1),
        P.safe_path(p, ["a", "b", 1, "c"], "bigint", -1),
        P.safe_path(p, ["a", "x"], "string"),
    ).first()
    assert tuple(row) == (1, -1, -1, -1, None)


def test_messages(spark):
    rows = [('{"a":1}',), ("oops",), ("",), (None,)]
    wrapped = values(spark, rows, "v string", P.wrap_bad_json(F.col("v")))
    assert wrapped == ['{"a":1}', '{"_raw":"oops"}', None, None]
    decoded = values(spark, rows, "v string", F.to_json(P.decode_message(F.col("v"))))
    assert decoded == wrapped


def test_is_object_and_array_size(spark):
    df = P.parsed(spark.createDataFrame([("{}",), ('{"a":1}',), ("[1,null]",), ("[]",), ("1",), ("null",)], "v string"), "v")
    p = F.col("p")
    got = [tuple(r) for r in df.select(P.is_object(p), P.array_size(p)).collect()]
    assert got == [(True, None), (True, None), (False, 2), (False, 0), (False, None), (False, None)]

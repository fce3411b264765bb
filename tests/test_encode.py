import json
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.encode import NATIVE_TYPE, encode, row_json, stringify
from lakequery.operators.capped import columns


def one(spark, expression, dialect="embedded"):
    return json.loads(row_json(spark.sql(f"SELECT {expression} AS v"), dialect).first()[0])["v"]


@pytest.mark.parametrize(
    "expression, expected",
    [
        ("CAST(NULL AS INT)", None),
        ("NULL", None),
        ("true", True),
        ("CAST(7 AS TINYINT)", 7),
        ("9223372036854775807L", 9223372036854775807),
        ("CAST(0.1 AS FLOAT)", 0.10000000149011612),
        ("1e16D", 1e16),
        ("CAST('NaN' AS DOUBLE)", "NaN"),
        ("CAST('Infinity' AS DOUBLE)", "inf"),
        ("CAST('-Infinity' AS FLOAT)", "-inf"),
        ("1.10BD", "1.10"),
        ("'te\"xt'", 'te"xt'),
        ("X'00FFa0'", "0x00ffa0"),
        ("X''", "0x"),
        ("DATE'2024-01-02'", "date32:19724"),
        ("DATE'1969-12-31'", "date32:-1"),
        ("TIMESTAMP_NTZ'2024-01-03 04:05:06.12'", "timestamp(Microsecond, 1704254706120000)"),
        ("TIMESTAMP_NTZ'1969-12-31 23:59:59.5'", "timestamp(Microsecond, -500000)"),
        ("TIMESTAMP'2024-01-03 04:05:06Z'", "timestamp(Microsecond, 1704254706000000)"),
        ("TIME'12:34:56.7'", "time64(Microsecond, 45296700000)"),
        ("INTERVAL '1 02:03:04.5' DAY TO SECOND", {"months": 0, "days": 1, "nanos": 7384500000000}),
        ("INTERVAL '-1 02:00:00' DAY TO SECOND", {"months": 0, "days": -1, "nanos": -7200000000000}),
        ("INTERVAL '1-2' YEAR TO MONTH", {"months": 14, "days": 0, "nanos": 0}),
        ("make_interval(1, 2, 0, 3, 4)", {"months": 14, "days": 3, "nanos": 14400000000000}),
        ("CAST(NULL AS INTERVAL DAY TO SECOND)", None),
        ("array(DATE'1970-01-02', NULL)", ["date32:1", None]),
        ("array(1D, CAST('Infinity' AS DOUBLE))", [1.0, "inf"]),
        ("map('a', 1.5BD)", [{"key": "a", "value": "1.5"}]),
        ("map('a', array(CAST('-Infinity' AS DOUBLE)))", [{"key": "a", "value": ["-inf"]}]),
        ("named_struct('x', X'01', 'y', NULL)", {"x": "0x01", "y": None}),
        ("CAST(NULL AS STRUCT<x: INT>)", None),
        ("parse_json('{\"a\":[1,{}]}')", {"a": [1, {}]}),
    ],
)
def test_embedded(spark, expression, expected):
    assert one(spark, expression) == expected


RELATIONAL = [
    ("DATE'2024-01-02'", "2024-01-02"),
    ("TIMESTAMP_NTZ'2024-01-03 04:05:06'", "2024-01-03 04:05:06"),
    ("TIMESTAMP_NTZ'2024-01-03 04:05:06.12'", "2024-01-03 04:05:06.120"),
    ("TIMESTAMP_NTZ'2024-01-03 04:05:06.000120'", "2024-01-03 04:05:06.000120"),
    ("TIMESTAMP_NTZ'1969-12-31 23:59:59.5'", "1969-12-31 23:59:59.500"),
    ("TIMESTAMP'2024-01-03 04:05:06.5Z'", "2024-01-03T04:05:06.500+00:00"),
    ("TIME'12:34:56'", "12:34:56"),
    ("TIME'12:34:56.7'", "12:34:56.700"),
    ("TIME'12:34:56.0007'", "12:34:56.000700"),
    ("array(1)", "<unsupported:array<int>>"),
    ("CAST(NULL AS ARRAY<INT>)", None),
    ("X'0aFF'", "0x0aff"),
    ("2.50BD", "2.50"),
    ("parse_json('[1]')", [1]),
    ("CAST('NaN' AS DOUBLE)", "NaN"),
    ("CAST('Infinity' AS FLOAT)", "inf"),
    ("true", True),
]


@pytest.mark.parametrize("dialect", ["mysql", "postgres"])
@pytest.mark.parametrize("expression, expected", RELATIONAL)
def test_relational(spark, dialect, expression, expected):
    assert one(spark, expression, dialect) == expected


def test_pass_through_dialect_keeps_values(spark):
    df = spark.sql("SELECT 1.50BD AS d, DATE'2024-01-02' AS day")
    assert encode(df, "json").schema == df.schema


def test_unknown_dialect(spark):
    with pytest.raises(ValueError):
        encode(spark.range(1), "oracle")


def test_unsigned_64_stays_a_number_and_128_becomes_text(spark):
    df = spark.sql("SELECT 18446744073709551615BD AS v").select(
        F.col("v").cast("decimal(20,0)").alias("u", metadata={NATIVE_TYPE: "UInt64"}),
        F.col("v").cast("decimal(38,0)").alias("h", metadata={NATIVE_TYPE: "hugeint"}),
    )
    assert json.loads(row_json(df).first()[0]) == {
        "u": 18446744073709551615,
        "h": "18446744073709551615",
    }


def test_zoneless_and_zoned_times_do_not_depend_on_the_session_zone(spark):
    sql = "SELECT TIMESTAMP_NTZ'2024-07-03 04:05:06.12' AS n, TIMESTAMP'2024-07-03 04:05:06.12Z' AS z"
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {d: json.loads(row_json(spark.sql(sql), d).first()[0]) for d in ("embedded", "postgres")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got["embedded"] == dict.fromkeys("nz", "timestamp(Microsecond, 1719979506120000)")
    assert got["postgres"] == {
        "n": "2024-07-03 04:05:06.120",
        "z": "2024-07-03T04:05:06.120+00:00",
    }


def test_row_object_keeps_nulls_and_the_last_of_repeated_names(spark):
    df = spark.sql("SELECT 1 AS a, NULL AS b, 2 AS a")
    assert json.loads(row_json(df).first()[0]) == {"b": None, "a": 2}


def test_names_need_no_escaping(spark):
    df = spark.sql("SELECT 1 AS `a.b`, 2 AS `c``d`, CAST('Infinity' AS DOUBLE) AS `e \"f`")
    assert json.loads(row_json(df).first()[0]) == {"a.b": 1, "c`d": 2, 'e "f': "inf"}


def test_infinite_rows_do_not_change_other_rows(spark):
    df = spark.sql("SELECT explode(array(1.5D, CAST('Infinity' AS DOUBLE), NULL)) AS v")
    assert [json.loads(r[0])["v"] for r in row_json(df).collect()] == [1.5, "inf", None]


def test_encoding_stays_in_one_codegen_stage(spark):
    df = spark.range(5).selectExpr("id", "CAST(id AS DOUBLE) AS d", "current_date() AS day")
    plan = row_json(df)._jdf.queryExecution().executedPlan().toString()
    assert all("*(1)" in line for line in plan.strip().splitlines())


def test_stringify(spark):
    df = spark.sql(
        "SELECT NULL AS n, true AS b, 5 AS i, 1.0D AS d, CAST('-Infinity' AS DOUBLE) AS f, 'x' AS s,"
        " array('a') AS l, named_struct('k', CAST('Infinity' AS DOUBLE)) AS o, 2.50BD AS c,"
        " parse_json('[1]') AS j, X'01' AS x"
    )
    assert stringify(df).first().asDict() == {
        "n": "", "b": "true", "i": "5", "d": "1.0", "f": "-inf", "s": "x", "l": '["a"]',
        "o": '{"k":"inf"}', "c": "2.50", "j": "[1]", "x": "0x01",
    }
    assert stringify(df, nulls=None).first()["n"] is None
    assert all(isinstance(f.dataType, T.StringType) for f in stringify(df).schema.fields)


def test_float_widening_is_exact(spark):
    value = one(spark, "CAST(3.4028235e38 AS FLOAT)")
    assert math.isclose(value, 3.4028234663852886e38, rel_tol=0)


def test_clock_changes_of_the_session_zone_do_not_show(spark):
    """02:30 does not exist in New York on this day, and 01:30 in November happens twice."""
    sql = (
        "SELECT TIMESTAMP_NTZ'2024-03-10 02:30:00' AS gap, TIMESTAMP_NTZ'2024-11-03 01:30:00.5' AS fold,"
        " TIMESTAMP'2024-03-10T02:30:00Z' AS zoned, TIMESTAMP'1900-01-01T00:00:00.000001Z' AS old,"
        " TIMESTAMP_NTZ'1900-01-01 00:00:00.25' AS older"
    )
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = {d: json.loads(row_json(spark.sql(sql), d).first()[0]) for d in ("embedded", "postgres")}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    expected = {d: json.loads(row_json(spark.sql(sql), d).first()[0]) for d in ("embedded", "postgres")}
    assert got == expected
    assert got["postgres"] == {
        "gap": "2024-03-10 02:30:00",
        "fold": "2024-11-03 01:30:00.500",
        "zoned": "2024-03-10T02:30:00+00:00",
        "old": "1900-01-01T00:00:00.000001+00:00",
        "older": "1900-01-01 00:00:00.250",
    }


def test_pass_through_dialect_spells_infinities(spark):
    df = spark.sql("SELECT map('k', CAST('-Infinity' AS FLOAT)) AS m, array(CAST('NaN' AS DOUBLE)) AS a")
    assert json.loads(row_json(df, "json").first()[0]) == {"m": {"k": "-inf"}, "a": ["NaN"]}
    assert stringify(df, "json").first()["m"] == '{"k":"-inf"}'


def test_types_named_by_a_database(spark):
    df = spark.sql("SELECT '{\"a\":[1]}' AS j, 'not json' AS k, 5BD AS u, 'x' AS s").select(
        F.col("j").alias("j", metadata={"jdbcClientType": "JSON"}),
        F.col("k").alias("k", metadata={"jdbcClientType": "jsonb"}),
        F.col("u").cast("decimal(20,0)").alias("u", metadata={"jdbcClientType": "BIGINT UNSIGNED"}),
        F.col("s").alias("s", metadata={"jdbcClientType": "VARCHAR"}),
    )
    expected = {"j": {"a": [1]}, "k": "not json", "u": 5, "s": "x"}
    assert json.loads(row_json(df, "mysql").first()[0]) == expected
    assert json.loads(row_json(df, "embedded").first()[0]) == expected | {"j": '{"a":[1]}'}
    assert stringify(df, "postgres").first().asDict() == {"j": '{"a":[1]}', "k": "not json", "u": "5", "s": "x"}
    assert [c.data_type for c in columns(df)] == ["JSON", "jsonb", "BIGINT UNSIGNED", "VARCHAR"]


MEMBERS = {
    "date'2020-01-02'": '"date32:18263"',
    "timestamp'1969-12-31 23:59:59.5'": '"timestamp(Microsecond, -500000)"',
    "timestamp_ntz'2020-01-01 00:00:00.000001'": '"timestamp(Microsecond, 1577836800000001)"',
    "X'01ff'": '"0x01ff"',
    "CAST(0.1 AS FLOAT)": "0.10000000149011612",
    "CAST('-Infinity' AS DOUBLE)": '"-inf"',
    "CAST('NaN' AS FLOAT)": '"NaN"',
    "1e3": "1000.0",
    "12345678901234567.25BD": '"12345678901234567.25"',
    "true": "true",
    "7Y": "7",
    "'date32'": '"date32"',
    "CAST(NULL AS INT)": "null",
}


def test_members_of_unions_encode_as_columns_do(spark):
    """Alone, in lists of unlike members, as values of objects and both within each other."""
    union = {"native_type": "union(a, b)"}

    def row(sql):
        return row_json(spark.sql(f"SELECT {sql} AS v").select(F.col("v").alias("v", metadata=union))).first()[0]

    for sql, want in MEMBERS.items():
        alone = f"CAST({sql} AS VARIANT)"
        assert row(alone) == f'{{"v":{want}}}'
        assert row(f"to_variant_object(array({alone}, CAST('x' AS VARIANT)))") == f'{{"v":[{want},"x"]}}'
        nested = f"to_variant_object(named_struct('k', named_struct('l', array(array({alone})), 'n', 1)))"
        assert row(nested) == f'{{"v":{{"k":{{"l":[[{want}]],"n":1}}}}}}'
        plain = row_json(spark.sql(f"SELECT array({sql}) AS v")).first()[0]
        assert plain == f'{{"v":[{want}]}}'


def test_json_variants_stay_as_they_are(spark):
    """Fractions parsed from JSON are decimals inside, yet numbers."""
    text = '{"a":[1.5,null,{"b":12345678901234567890.25}],"c":{},"d":[],"e":"date"}'
    df = spark.sql(f"SELECT parse_json('{text}') AS v")
    assert row_json(df).first()[0] == f'{{"v":{text}}}'
    assert stringify(df).first()[0] == text
    for dialect in ("mysql", "postgres", "json"):
        assert row_json(df, dialect).first()[0] == f'{{"v":{text}}}'


def test_variants_too_deep_fail_only_where_something_is_to_encode(spark):
    def deep(sql):
        for _ in range(10):
            sql = f"to_variant_object(array({sql}))"
        return spark.sql(f"SELECT {sql} AS v")

    assert row_json(deep("CAST('x' AS VARIANT)")).first()[0] == '{"v":' + "[" * 10 + '"x"' + "]" * 10 + "}"
    with pytest.raises(Exception, match="nested over 8 levels"):
        row_json(deep("CAST(date'2020-01-02' AS VARIANT)")).collect()
    with_null = spark.sql("SELECT CAST(NULL AS VARIANT) AS v UNION ALL SELECT CAST(X'00' AS VARIANT)")
    assert sorted(r[0] for r in stringify(with_null).collect()) == ["", "0x00"]

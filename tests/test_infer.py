import itertools
import json

import pytest
from pyspark.sql import types as T

from lakequery.operators.infer import (
    BOOL,
    FLOAT64,
    INT64,
    UTF8,
    infer_types,
    normalize,
    project_typed,
)

INT64_MAX = 2**63 - 1
TOKENS = {
    "null": "null",
    "bool": "true",
    "int": "4",
    "big": "18446744073709551615",
    "float": "1.5",
    "text": '"t"',
}


def fold(classes):
    """The row-order rule, one value at a time."""
    state = None
    for c in classes:
        if c == "null":
            continue
        if state is None:
            state = {"bool": BOOL, "int": INT64, "big": UTF8, "float": FLOAT64, "text": UTF8}[c]
        elif state == UTF8:
            break
        elif state == BOOL:
            state = BOOL if c == "bool" else UTF8
        elif c in ("bool", "text"):
            state = UTF8
        elif state == INT64 and c == "int":
            state = INT64
        else:
            state = FLOAT64
    return state or UTF8


def found(spark, rows, **kwargs):
    df = spark.createDataFrame(list(enumerate(rows)), "ord long, row string")
    return {r["column_name"]: r["column_type"] for r in infer_types(df, "row", ord_col="ord", **kwargs).collect()}


def test_aggregate_equals_fold_on_every_short_sequence(spark):
    sequences = [s for n in range(1, 5) for s in itertools.product(TOKENS, repeat=n)]
    rows = [
        "{" + ",".join(f'"{i}":{TOKENS[s[k]]}' for i, s in enumerate(sequences) if k < len(s)) + "}"
        for k in range(4)
    ]
    assert found(spark, rows) == {str(i): fold(s) for i, s in enumerate(sequences)}


@pytest.mark.parametrize(
    "values, expected",
    [
        (["null", "null"], UTF8),
        (["true", "false"], BOOL),
        (["true", "1"], UTF8),
        (["1", "null", "2"], INT64),
        (["1", "1.5"], FLOAT64),
        (["1.5", "1"], FLOAT64),
        (["1", "18446744073709551615"], FLOAT64),
        (["18446744073709551615", "1"], UTF8),
        (["1", '"x"'], UTF8),
        (["[1]", "2"], UTF8),
        (["1.0"], FLOAT64),
        (["1e3"], FLOAT64),
        ([str(INT64_MAX)], INT64),
        ([str(INT64_MAX + 1)], UTF8),
        ([f"{INT64_MAX + 1}.0"], FLOAT64),
        (["18446744073709551616"], FLOAT64),
        ([str(-(2**63) - 1)], FLOAT64),
        (["9" * 30], FLOAT64),
        (['"1"'], UTF8),
    ],
)
def test_cases(spark, values, expected):
    assert found(spark, [f'{{"c":{v}}}' for v in values]) == {"c": expected}


def test_missing_keys_and_named_columns(spark):
    rows = ['{"a":1}', "{}", '{"b":true}', '[{"a":"x"}]', "3"]
    assert found(spark, rows) == {"a": INT64, "b": BOOL}
    assert found(spark, rows, columns=["a", "z"]) == {"a": INT64, "z": UTF8}


@pytest.mark.parametrize("bad", ['{"c":1', '{"c":1} {"c":2}', "word", ""])
def test_malformed_rows_are_errors(spark, bad):
    rows = ['{"c":1}', bad]
    df = spark.createDataFrame([(row,) for row in rows], "row string")
    with pytest.raises(Exception, match="not one JSON value"):
        infer_types(df, "row").collect()
    with pytest.raises(Exception, match="not one JSON value"):
        project_typed(df, "row", {"c": INT64}).collect()


def test_projection_matches_class_not_castability(spark):
    values = ["null", "true", "5", '"5"', "1.0", "1e3", "18446744073709551615", "[1,2.0]", '{"k":1.0}']
    df = spark.createDataFrame([(i, f'{{"v":{v}}}') for i, v in enumerate(values)], "i int, row string")

    def read(kind):
        return [r["v"] for r in project_typed(df, "row", {"v": kind}).orderBy("i").collect()]

    big = 18446744073709551615.0
    assert read(BOOL) == [None, True] + [None] * 7
    assert read(INT64) == [None, None, 5] + [None] * 6
    assert read(FLOAT64) == [None, None, 5.0, None, 1.0, 1000.0, big, None, None]
    text = read(UTF8)
    assert text[:5] == [None, "true", "5", "5", "1.0"]
    assert json.loads(text[7]) == [1, 2.0] and json.loads(text[8]) == {"k": 1.0}


def test_projection_of_absent_key_and_odd_names(spark):
    df = spark.createDataFrame([('{"a.b":1,"c\'d":"x"}',)], "row string")
    row = project_typed(df, "row", {"a.b": INT64, "c'd": UTF8, "none": FLOAT64}).first()
    assert tuple(row) == (1, "x", None)


def test_normalize_needs_no_scan(spark):
    df = spark.sql("SELECT CAST(1 AS TINYINT) AS a, CAST(2 AS FLOAT) AS b, true AS c, 1.5BD AS d, array(1) AS e")
    assert normalize(df).schema.simpleString() == "struct<a:bigint,b:double,c:boolean,d:string,e:string>"
    assert tuple(normalize(df).first()) == (1, 2.0, True, "1.5", "[1]")

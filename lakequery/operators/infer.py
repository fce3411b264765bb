"""Column types found in JSON rows, and the typed projection they imply."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.encode import EMBEDDED, Encoder, cell_text, last_wins, native_type, quoted

BOOL, INT64, FLOAT64, UTF8 = "Bool", "Int64", "Float64", "Utf8"
SPARK_TYPES = {
    BOOL: T.BooleanType(),
    INT64: T.LongType(),
    FLOAT64: T.DoubleType(),
    UTF8: T.StringType(),
}

_UINT64_MAX = "18446744073709551615"
# Classes of JSON values: booleans, integers of int64, integers above it, other numbers, the rest.
_FLAG, _INT, BIG, _FLOAT, _OTHER = range(1, 6)
# What is kept of the classes of a key; flags of parts of the rows merge by "or".
FLAGS = {
    "other": (_OTHER,),
    "flag": (_FLAG,),
    "whole": (_INT,),
    "number": (_INT, BIG, _FLOAT),
    "wide": (BIG, _FLOAT),
}
_LONG_WHOLE = tuple(f"DECIMAL({digits},0)" for digits in range(19, 39))


def value_class(kind: Column, token: Column) -> Column:
    """Class of a JSON value, null for null. Numbers, not names, so that folding stays in hash maps.

    ``kind`` is the type its variant has. That cannot tell ``9223372036854775808`` from the same
    number with ``.0``; only whole decimals that long look at the raw token, so no other row pays
    for it.
    """
    unsigned = token.rlike(r"^[0-9]+$") & (
        (F.length(token) < len(_UINT64_MAX)) | (F.lpad(token, len(_UINT64_MAX), "0") <= _UINT64_MAX)
    )
    return (
        F.when(kind == "VOID", None)
        .when(kind == "BIGINT", _INT)
        .when(kind == "BOOLEAN", _FLAG)
        .when(kind == "DOUBLE", _FLOAT)
        .when(kind.isin(*_LONG_WHOLE), F.when(unsigned, BIG).otherwise(_FLOAT))
        .when(kind.startswith("DECIMAL"), _FLOAT)
        .otherwise(_OTHER)
    )


def infer_types(
    df: DataFrame,
    json_col: str,
    columns: list[str] | None = None,
    ord_col: str | None = None,
) -> DataFrame:
    """One row per key of the JSON objects in ``json_col``: ``column_name``, ``column_type``.

    ``columns`` adds the keys that never hold a value, as text. See ``seen_classes``.
    """
    decided = seen_classes(df, json_col, ord_col).select(
        F.col("key").alias("column_name"), decided_type(*map(F.col, FLAGS), F.col("first")).alias("column_type")
    )
    if columns is None:
        return decided
    named = df.sparkSession.createDataFrame(
        [(name,) for name in dict.fromkeys(columns)], "column_name string"
    )
    return named.join(decided, "column_name", "left").select(
        "column_name", F.coalesce("column_type", F.lit(UTF8)).alias("column_type")
    )


def decided_type(other: Column, flag: Column, whole: Column, number: Column, wide: Column, first: Column) -> Column:
    """The type that holds all values of a key, of what classes were seen and of which the first was."""
    is_text = other | (flag & number) | F.coalesce(first == BIG, F.lit(False))
    return F.when(is_text, UTF8).when(flag, BOOL).when(wide, FLOAT64).when(whole, INT64).otherwise(UTF8)


def seen_classes(df: DataFrame, json_col: str, ord_col: str | None = None) -> DataFrame:
    """One row per key: ``key``, the ``FLAGS`` of the classes seen, and the class of the ``first`` value.

    The row-order rule reduces to flags and the class of the first value, which merge: each task
    folds its rows to one row per key before anything is shuffled. ``ord_col`` gives the row order
    and is needed only to know the first value. Malformed JSON fails the query; null rows and other values
    than objects are skipped.
    """
    order = quoted(ord_col) if ord_col else F.monotonically_increasing_id()
    parsed = df.select(
        order.alias("ord"),
        quoted(json_col).alias("json"),
        parsed_json(quoted(json_col), T.MapType(T.StringType(), T.VariantType())).alias("doc"),
    )
    pairs = parsed.select("ord", "json", F.explode(json_object("json", "doc")).alias("key", "value"))
    kinds = pairs.select("key", "ord", "json", F.schema_of_variant("value").alias("kind"))
    token = F.from_json("json", "map<string,string>")[F.col("key")]
    classes = kinds.select("key", "ord", value_class(F.col("kind"), token).alias("class"))
    # One row per key and class is left of all rows of a task; the flags are worked out of those.
    firsts = classes.groupBy("key", "class").agg(F.min("ord").alias("ord"))

    def seen(*classes: int) -> Column:
        return F.coalesce(F.bool_or(F.col("class").isin(*classes)), F.lit(False))

    return firsts.groupBy("key").agg(
        *[seen(*classes).alias(name) for name, classes in FLAGS.items()],
        F.min_by("class", F.when(F.col("class").isNotNull(), F.col("ord"))).alias("first"),
    )


def parsed_json(text: Column, kind: T.DataType) -> Column:
    """The text parsed once, for ``json_object`` to take from a column of its own projection."""
    form = T.StructType([T.StructField("row", kind), T.StructField("end", T.IntegerType())])
    # Spark's parsers stop after the first value; inside an object, text that follows is an error.
    return F.from_json(F.concat(F.lit('{"row":'), text, F.lit(',"end":0}')), form)


def json_object(text: str, parsed: str) -> Column:
    """The JSON object in column ``parsed``, or null for another JSON value; malformed text is an error."""
    bad = F.col(text).isNotNull() & F.col(parsed)["end"].isNull()
    said = F.concat(F.lit("row is not one JSON value: "), F.col(text))
    return F.when(bad, F.raise_error(said)).otherwise(F.col(parsed)["row"])


def project_typed(df: DataFrame, json_col: str, types: Mapping[str, str]) -> DataFrame:
    """JSON rows as typed columns; a value of another class becomes null, text takes any value.

    Values are matched by class, not by whether a cast would work: the string ``"5"`` in an Int64
    column is null. Other columns of ``df`` pass through.
    """
    fields = [
        T.StructField(name, T.StringType() if kind == UTF8 else T.VariantType())
        for name, kind in types.items()
    ]
    kept = [quoted(c) for c in df.columns if c not in types and c != json_col]
    text = quoted(json_col)
    parsed = df.select(*kept, text.alias("_lq_text"), parsed_json(text, T.StructType(fields)).alias("_lq_doc"))
    parsed = parsed.select(*kept, json_object("_lq_text", "_lq_doc").alias("_lq_row"))
    out = []
    for name, kind in types.items():
        value = F.col("_lq_row")[name]
        if kind != UTF8:
            actual = F.schema_of_variant(value)
            fits = {
                BOOL: actual == "BOOLEAN",
                INT64: actual == "BIGINT",
                FLOAT64: actual.rlike("^(BIGINT|DOUBLE|DECIMAL)"),
            }[kind]
            value = F.when(fits, F.try_variant_get(value, "$", SPARK_TYPES[kind].simpleString()))
        out.append(value.alias(name))
    return parsed.select(*kept, *out)


def normalize(df: DataFrame, dialect: str = EMBEDDED) -> DataFrame:
    """The export types of a typed result, known from its schema without a scan.

    Integers become long, floats double, booleans stay and everything else becomes its cell text,
    which is what inference over the encoded rows would find.
    """
    encoder = Encoder.of(df, dialect)
    df = last_wins(df)
    out = []
    for f in df.schema.fields:
        c = quoted(f.name)
        if isinstance(f.dataType, T.BooleanType):
            out.append(c.alias(f.name))
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            out.append(c.cast("long").alias(f.name))
        elif isinstance(f.dataType, (T.FloatType, T.DoubleType)):
            out.append(c.cast("double").alias(f.name))
        else:
            out.append(cell_text(c, f.dataType, encoder, native_type(f)).alias(f.name))
    return df.select(*out)

"""Values as JSON-ready columns, rows as JSON text, cells as plain text.

Everything here builds native column expressions from the schema, so encoding stays inside
code generation and never leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.variants import encoded_variant

EMBEDDED, MYSQL, POSTGRES, JSON = "embedded", "mysql", "postgres", "json"
DIALECTS = (EMBEDDED, MYSQL, POSTGRES, JSON)

# Field metadata keys that keep the type a source had before Spark widened it: this library's own,
# and the one Spark's JDBC reader sets.
NATIVE_TYPE = "native_type"
_JDBC_TYPE = "jdbcClientType"

# Unsigned 64-bit names, whose decimal(20,0) carrier stays a JSON number.
UNSIGNED_64 = ("ubigint", "uint64", "bigint unsigned")

# Fixed value: how the native type of a column of unions begins, whose decimals become text like any others.
UNION = "union"

# Database types that hold JSON and reach Spark as text.
JSON_TEXT = ("json", "jsonb")

MICROS_PER_SECOND = 1_000_000
_UTC_NAMES = ("UTC", "Etc/UTC", "Z", "GMT", "+00:00")
_NUMERIC_AS_IS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_TEXT = (T.StringType, T.CharType, T.VarcharType)
_TIME = getattr(T, "TimeType", None)


def native_type(field: T.StructField) -> str | None:
    """The name a column's type has at its source, where one is known."""
    return field.metadata.get(NATIVE_TYPE) or field.metadata.get(_JDBC_TYPE)


def _is_time(dtype: T.DataType) -> bool:
    return _TIME is not None and isinstance(dtype, _TIME)


def _clock_micros(c: Column) -> Column:
    """Microseconds since midnight of a time, a zoneless timestamp or an interval's clock part."""
    seconds = (F.extract(F.lit("SECOND"), c) * MICROS_PER_SECOND).cast("long")
    hours = F.extract(F.lit("HOUR"), c).cast("long")
    minutes = F.extract(F.lit("MINUTE"), c).cast("long")
    return (hours * 3600 + minutes * 60) * MICROS_PER_SECOND + seconds


def _epoch() -> Column:
    return F.lit("1970-01-01").cast("timestamp_ntz")


def _even_fraction(text: Column) -> Column:
    """Date-time text with no, three or six fraction digits; Spark's own drops trailing zeros."""
    point = F.instr(text, ".")
    short = F.pmod(point - F.octet_length(text), F.lit(3))
    zeros = F.when(short == 1, "0").when(short == 2, "00").otherwise("")
    return F.when(point == 0, text).otherwise(F.concat(text, zeros))


def _interval(c: Column, dtype: T.DataType) -> Column:
    zero = F.lit(0)
    months, days, nanos = zero, zero, F.lit(0).cast("long")
    if not isinstance(dtype, T.DayTimeIntervalType):
        months = F.extract(F.lit("YEAR"), c) * 12 + F.extract(F.lit("MONTH"), c)
    if not isinstance(dtype, T.YearMonthIntervalType):
        days = F.extract(F.lit("DAY"), c)
        nanos = _clock_micros(c) * 1000
    return F.when(
        c.isNotNull(),
        F.struct(
            months.cast("int").alias("months"), days.cast("int").alias("days"), nanos.alias("nanos")
        ),
    )


class Encoder:
    """Builds the encoding of one dialect under one session time zone."""

    def __init__(self, dialect: str, timezone: str):
        if dialect not in DIALECTS:
            raise ValueError(f"unknown dialect: {dialect}, use one of {', '.join(DIALECTS)}")
        self.dialect = dialect
        self.utc = timezone in _UTC_NAMES

    @classmethod
    def of(cls, df: DataFrame, dialect: str) -> Encoder:
        return cls(dialect, df.sparkSession.conf.get("spark.sql.session.timeZone"))

    def value(self, c: Column, dtype: T.DataType, native: str | None = None) -> Column:
        """The JSON-ready form of ``c``; nulls stay null."""
        if self.dialect == JSON:
            return c
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return c.cast("double")
        native = (native or "").lower()
        if native in JSON_TEXT and isinstance(dtype, _TEXT) and self.dialect in (MYSQL, POSTGRES):
            return F.coalesce(F.try_parse_json(c), c.cast("variant"))
        if isinstance(dtype, T.VariantType):
            # Only the embedded dialect has unions; elsewhere a variant is a JSON document.
            return encoded_variant(c, native.startswith(UNION)) if self.dialect == EMBEDDED else c
        if isinstance(dtype, (T.BooleanType, *_NUMERIC_AS_IS, *_TEXT)):
            return c
        if isinstance(dtype, T.DecimalType):
            return c if native in UNSIGNED_64 else c.cast("string")
        if isinstance(dtype, T.BinaryType):
            return F.concat(F.lit("0x"), F.lower(F.hex(c)))
        if isinstance(dtype, T.NullType):
            return c.cast("string")
        if self.dialect == EMBEDDED:
            return self._embedded(c, dtype)
        return self._relational(c, dtype)

    def _embedded(self, c: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.DateType):
            return F.concat(F.lit("date32:"), F.unix_date(c).cast("string"))
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            micros = self.micros(c, dtype)
            return F.concat(F.lit("timestamp(Microsecond, "), micros.cast("string"), F.lit(")"))
        if _is_time(dtype):
            micros = _clock_micros(c)
            return F.concat(F.lit("time64(Microsecond, "), micros.cast("string"), F.lit(")"))
        if isinstance(
            dtype, (T.YearMonthIntervalType, T.DayTimeIntervalType, T.CalendarIntervalType)
        ):
            return _interval(c, dtype)
        if isinstance(dtype, T.ArrayType):
            return F.transform(c, lambda item: self.value(item, dtype.elementType))
        if isinstance(dtype, T.MapType):
            return F.transform(
                F.map_entries(c),
                lambda entry: F.struct(
                    self.value(entry["key"], dtype.keyType).alias("key"),
                    self.value(entry["value"], dtype.valueType).alias("value"),
                ),
            )
        if isinstance(dtype, T.StructType):
            fields = [
                self.value(c[f.name], f.dataType, native_type(f)).alias(f.name)
                for f in dtype.fields
            ]
            return F.when(c.isNotNull(), F.struct(*fields)) if fields else c
        return self._unsupported(c, dtype)

    def _relational(self, c: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.DateType):
            return c.cast("string")
        if isinstance(dtype, T.TimestampNTZType) or _is_time(dtype):
            return _even_fraction(c.cast("string"))
        if isinstance(dtype, T.TimestampType):
            text = _even_fraction(self._utc(c).cast("string"))
            return F.concat(F.replace(text, F.lit(" "), F.lit("T")), F.lit("+00:00"))
        return self._unsupported(c, dtype)

    def _utc(self, c: Column) -> Column:
        """A timestamp as zoneless UTC, past any clock change of the session zone."""
        if self.utc:
            return c.cast("timestamp_ntz")
        seconds = F.unix_micros(c).cast("decimal(20,0)") / F.lit(MICROS_PER_SECOND)
        zero = F.lit(0)
        return _epoch() + F.make_dt_interval(zero, zero, zero, seconds.cast("decimal(18,6)"))

    @staticmethod
    def _unsupported(c: Column, dtype: T.DataType) -> Column:
        return F.when(c.isNotNull(), F.lit(f"<unsupported:{dtype.simpleString()}>"))

    def micros(self, c: Column, dtype: T.DataType) -> Column:
        """Microseconds since the epoch; a zoneless timestamp is read as UTC in any session."""
        if isinstance(dtype, T.TimestampType):
            return F.unix_micros(c)
        if self.utc:
            return F.unix_micros(c.cast("timestamp"))
        since = c - _epoch()
        days = F.extract(F.lit("DAY"), since).cast("long")
        return days * (86_400 * MICROS_PER_SECOND) + _clock_micros(since)

    # -- non-finite numbers ------------------------------------------------------------------

    def has_infinity(self, c: Column, dtype: T.DataType) -> Column | None:
        """Whether a value holds an infinity anywhere; None when its type cannot."""
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return F.abs(c) == float("inf")
        nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
        if not nested or self.dialect in (MYSQL, POSTGRES):
            return None
        if isinstance(dtype, T.ArrayType):
            if self.has_infinity(F.lit(None), dtype.elementType) is None:
                return None
            return F.exists(c, lambda item: self.has_infinity(item, dtype.elementType))
        if isinstance(dtype, T.MapType):
            found = [
                self.has_infinity(side(c), T.ArrayType(side_type))
                for side, side_type in ((F.map_keys, dtype.keyType), (F.map_values, dtype.valueType))
            ]
        else:
            found = [self.has_infinity(c[f.name], f.dataType) for f in dtype.fields]
        return any_of(found)

    def spelled(self, c: Column, dtype: T.DataType) -> Column:
        """An encoded value with its infinities spelled out, numbers kept as numbers."""
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return (
                F.when(c == float("inf"), F.parse_json(F.lit('"inf"')))
                .when(c == float("-inf"), F.parse_json(F.lit('"-inf"')))
                .when(F.isnan(c), F.parse_json(F.lit('"NaN"')))
                .otherwise(c.cast("double").cast("variant"))
            )
        if isinstance(dtype, T.ArrayType):
            return F.transform(c, lambda item: self.spelled(item, dtype.elementType))
        if isinstance(dtype, T.MapType):
            return F.transform_values(c, lambda _, v: self.spelled(v, dtype.valueType))
        if isinstance(dtype, T.StructType) and dtype.fields:
            fields = [self.spelled(c[f.name], f.dataType).alias(f.name) for f in dtype.fields]
            return F.when(c.isNotNull(), F.struct(*fields))
        return c


def any_of(conditions: list[Column | None]) -> Column | None:
    """Disjunction of the conditions that exist, null counting as false."""
    known = [F.coalesce(c, F.lit(False)) for c in conditions if c is not None]
    if not known:
        return None
    result = known[0]
    for condition in known[1:]:
        result = result | condition
    return result


def last_wins(df: DataFrame) -> DataFrame:
    """Drop all but the last column of each name, as a row object keyed by name would."""
    names = df.columns
    if len(set(names)) == len(names):
        return df
    by_position = df.toDF(*[f"_{i}" for i in range(len(names))])
    last = {name: i for i, name in enumerate(names)}
    keep = [i for i, name in enumerate(names) if last[name] == i]
    return by_position.select(
        *[F.col(f"_{i}").alias(names[i], metadata=df.schema[i].metadata) for i in keep]
    )


def quoted(name: str) -> Column:
    """A column by its exact name, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def encode(df: DataFrame, dialect: str = EMBEDDED) -> DataFrame:
    """Every column in its JSON-ready form: text for types JSON lacks, nested ones recursively."""
    encoder = Encoder.of(df, dialect)
    df = last_wins(df)
    return df.select(
        *[
            encoder.value(quoted(f.name), f.dataType, native_type(f)).alias(f.name)
            for f in df.schema.fields
        ]
    )


def row_json(df: DataFrame, dialect: str = EMBEDDED, name: str = "row") -> DataFrame:
    """One column holding each row as a JSON object keyed by column name, nulls kept.

    ``to_json`` already writes NaN as text but spells infinities its own way. A row that holds one
    takes a second form built on variants, so all other rows keep the cheap path.
    """
    encoder = Encoder.of(df, dialect)
    df = last_wins(df)
    if not df.columns:
        return df.select(F.lit("{}").alias(name))
    fields, shapes = df.schema.fields, encode(df, dialect).schema.fields
    values = [encoder.value(quoted(f.name), f.dataType, native_type(f)) for f in fields]
    text = _object_text([value.alias(f.name) for value, f in zip(values, fields)])
    infinite = any_of([encoder.has_infinity(quoted(f.name), f.dataType) for f in fields])
    if infinite is not None:
        spelled = [encoder.spelled(v, s.dataType).alias(s.name) for v, s in zip(values, shapes)]
        text = F.when(infinite, _object_text(spelled)).otherwise(text)
    return df.select(text.alias(name))


def _object_text(members: list[Column]) -> Column:
    return F.to_json(F.struct(*members), {"ignoreNullFields": "false"})


def cell_text(c: Column, dtype: T.DataType, encoder: Encoder, native: str | None = None) -> Column:
    """One cell as text: strings raw, booleans and numbers printed, nested values as JSON."""
    value = encoder.value(c, dtype, native)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return (
            F.when(value == float("inf"), "inf")
            .when(value == float("-inf"), "-inf")
            .otherwise(value.cast("string"))
        )
    interval = isinstance(
        dtype, (T.YearMonthIntervalType, T.DayTimeIntervalType, T.CalendarIntervalType)
    )
    nested = isinstance(dtype, (T.ArrayType, T.MapType, T.StructType))
    if encoder.dialect in (MYSQL, POSTGRES) and (nested or interval):
        return value
    if isinstance(dtype, T.VariantType):
        return value.cast("string")
    if nested or interval:
        options = {"ignoreNullFields": "false"}
        plain = F.to_json(value, options)
        infinite = encoder.has_infinity(c, dtype)
        if infinite is None:
            return plain
        shape = dtype if encoder.dialect == JSON else _encoded_type(dtype)
        spelled = encoder.spelled(value, shape)
        return F.when(F.coalesce(infinite, F.lit(False)), F.to_json(spelled, options)).otherwise(plain)
    return value.cast("string")


def _encoded_type(dtype: T.DataType) -> T.DataType:
    """The shape an embedded nested value has once encoded, as far as its numbers go."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return T.DoubleType()
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_encoded_type(dtype.elementType))
    if isinstance(dtype, T.MapType):
        entry = T.StructType(
            [
                T.StructField("key", _encoded_type(dtype.keyType)),
                T.StructField("value", _encoded_type(dtype.valueType)),
            ]
        )
        return T.ArrayType(entry)
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _encoded_type(f.dataType)) for f in dtype.fields])
    return T.StringType()


def stringify(df: DataFrame, dialect: str = EMBEDDED, nulls: str | None = "") -> DataFrame:
    """Every column as cell text; ``nulls`` replaces null, or None keeps it."""
    encoder = Encoder.of(df, dialect)
    cells = []
    for f in df.schema.fields:
        text = cell_text(quoted(f.name), f.dataType, encoder, native_type(f))
        cells.append((text if nulls is None else F.coalesce(text, F.lit(nulls))).alias(f.name))
    return df.select(*cells)

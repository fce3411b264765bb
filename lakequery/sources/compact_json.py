"""Header-typed JSON lines: names, then types, then one array of values per row."""

from __future__ import annotations

import io
import json
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.encode import NATIVE_TYPE
from lakequery.storage import open_filesystem

# The type names a header may use and the Spark type that holds each.
_TYPES = {
    "bool": "boolean",
    "int8": "tinyint",
    "int16": "smallint",
    "int32": "int",
    "int64": "bigint",
    "uint8": "smallint",
    "uint16": "int",
    "uint32": "bigint",
    "uint64": "decimal(20,0)",
    "float32": "float",
    "float64": "double",
    "date": "date",
    "date32": "date",
    "datetime": "timestamp_ntz",
    "datetime64": "timestamp_ntz",
}
_BLANK = " \t\r\n"
_WRAPPER = re.compile(r"^(?:Nullable|LowCardinality)\((.*)\)$")
_DECIMAL = re.compile(r"^Decimal\((\d+),\s*(\d+)\)$")
_ARRAY = re.compile(r"^Array\((.*)\)$")


# Integer types wider than any Spark integer or exact decimal of 38 digits.
_WIDE = ("int128", "uint128", "int256", "uint256")
_WHOLE = "^-?[0-9]+$"


class CompactJsonError(ValueError):
    """A file's header lines are missing, malformed or differ from those of other files."""


def _base(name: str) -> str:
    """The type name without wrappers and parameters, in lower case."""
    return _unwrapped(name).split("(", 1)[0].lower()


def _unwrapped(name: str) -> str:
    name = name.strip()
    while wrapped := _WRAPPER.match(name):
        name = wrapped.group(1).strip()
    return name


def spark_type(name: str) -> str:
    """The Spark type of a header type name; what has no closer type is text."""
    name = _unwrapped(name)
    if decimal := _DECIMAL.match(name):
        precision, scale = decimal.groups()
        return f"decimal({precision},{scale})" if int(precision) <= 38 else "string"
    if array := _ARRAY.match(name):
        return f"array<{spark_type(array.group(1))}>"
    return _TYPES.get(_base(name), "string")


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first two non-blank lines of each listed file, without reading further."""
    for batch in batches:
        found: dict[str, list] = {"path": [], "names": [], "types": []}
        for uri in batch.column("path").to_pylist():
            fs, path = open_filesystem(uri)
            with fs.open_input_stream(path) as stream:  # unpacked by its extension
                text = (line.strip(_BLANK) for line in io.TextIOWrapper(stream, encoding="utf-8"))
                lines = list(islice(filter(None, text), 2))
            found["path"].append(uri)
            found["names"].append(lines[0] if lines else None)
            found["types"].append(lines[1] if len(lines) > 1 else None)
        yield pa.RecordBatch.from_pydict(
            found, pa.schema([(name, pa.string()) for name in ("path", "names", "types")])
        )


def _string_array(line: str, what: str) -> list[str]:
    try:
        values = json.loads(line)
    except json.JSONDecodeError as error:
        raise CompactJsonError(f"{what} line is not JSON ({error}): {line}") from None
    if not isinstance(values, list) or not all(isinstance(v, str) for v in values):
        raise CompactJsonError(f"{what} line is not an array of strings: {line}")
    return values


def _header(spark: SparkSession, path: str | list[str]) -> tuple[str, str] | None:
    """The header lines all files share; None when no file has a line."""
    # Only paths are selected, so no content is read; few tasks then open many files each.
    files = spark.read.format("binaryFile").load(path).select("path")
    files = files.coalesce(4 * spark.sparkContext.defaultParallelism)
    heads = files.mapInArrow(_heads, "path string, names string, types string")
    distinct = heads.where(F.col("names").isNotNull()).groupBy("names", "types").agg(
        F.min("path").alias("path")
    )
    rows = distinct.orderBy("path").limit(2).collect()
    if not rows:
        return None
    for row in rows:
        if row["types"] is None:
            raise CompactJsonError(f"{row['path']} ends before the line of column types")
    if len(rows) > 1:
        raise CompactJsonError(f"{rows[0]['path']} and {rows[1]['path']} have different headers")
    return rows[0]["names"], rows[0]["types"]


def _data_lines(lines: DataFrame, header: tuple[str, str]) -> DataFrame:
    """Lines below the headers, each exactly as often as the files hold it.

    The headers are the first two lines of a file. Rows may equal them, and lines of equal text are
    interchangeable, so it is enough to count such lines in every block and give back all but the two
    that a file starts with.
    """
    like = F.col("line").isin(*header)
    twice = 2 if header[0] == header[1] else 1
    counted = lines.where(like).groupBy("path", "start", "line").agg(F.count(F.lit(1)).alias("n"))
    extra = counted.select(
        "line", (F.col("n") - F.when(F.col("start") == 0, twice).otherwise(0)).cast("int").alias("n")
    ).where("n > 0")
    given_back = extra.select(F.explode(F.array_repeat("line", F.col("n"))).alias("line"))
    return lines.where(~like).select("line").unionByName(given_back)


def _cell(value: Column, token: Column, kind: str, declared: str) -> Column:
    """The value under its declared type, or null where its class does not fit; nothing is rounded.

    ``token`` is its text. Integers of 64 bits and more may be quoted, as writers do that to spare
    readers without them; those above 64 bits unsigned stay text, so no digit is lost.
    """
    actual = F.schema_of_variant(value)
    quoted = actual == "STRING"
    number = actual.rlike("^(BIGINT|DOUBLE|DECIMAL)")
    if kind.startswith("array<"):
        return F.from_json(F.to_json(value), kind)
    if kind == "string":
        if _base(declared) in _WIDE:
            return F.when((number | quoted) & token.rlike(_WHOLE), token)
        return F.when(quoted, value.cast("string")).otherwise(F.when(actual != "VOID", token))
    if kind == "boolean":
        return F.when(actual == "BOOLEAN", F.try_variant_get(value, "$", kind))
    if kind in ("float", "double"):
        return F.when(number | (quoted & token.rlike("(?i)^-?(nan|inf(inity)?)$")), token.try_cast(kind))
    if kind in ("date", "timestamp_ntz"):
        return F.when(quoted, token.try_cast(kind))
    if kind.startswith("decimal") and not kind.endswith(",0)"):
        exact = token.try_cast(kind)
        return F.when((number | quoted) & (exact == token.try_cast("decimal(38,18)")), exact)
    spelled = number if kind in ("tinyint", "smallint", "int") else number | quoted
    return F.when(spelled & token.rlike(_WHOLE), token.try_cast(kind))


def _columns(header: tuple[str, str]) -> tuple[list[str], list[str]]:
    names = _string_array(header[0], "column name")
    types = _string_array(header[1], "column type")
    if len(names) != len(types):
        raise CompactJsonError(f"the header names {len(names)} columns and types {len(types)}")
    return names, types


def read_compact_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Typed rows of header-typed JSON line files; a second, filtered scan looks for rows like headers.

    A value its declared type cannot hold becomes null. A row that is not an array, or has too few
    or too many values, fails the query and names the line.
    """
    header = _header(spark, path)
    if header is None:
        return spark.createDataFrame([], T.StructType([]))
    names, types = _columns(header)
    lines = (
        spark.read.text(path)
        .select(
            F.btrim("value", F.lit(_BLANK)).alias("line"),
            F.col("_metadata.file_path").alias("path"),
            F.col("_metadata.file_block_start").alias("start"),
        )
        .where(F.col("line") != "")
    )
    return _typed_rows(_data_lines(lines, header), names, types)


def _typed_rows(data: DataFrame, names: list[str], types: list[str]) -> DataFrame:
    """The arrays in column ``line`` as columns of the header's names and types."""
    kinds = [spark_type(t) for t in types]
    # Spark's parsers stop after the first JSON value of a text. Inside an object, text that follows
    # the array is an error, and "end" is only seen when the array was the whole line.
    wrapped = F.concat(F.lit('{"row":'), "line", F.lit(',"end":0}'))
    parsed = data.select(
        "line",
        F.from_json(wrapped, "row array<variant>, end int").alias("doc"),
        F.from_json(wrapped, "row array<string>").alias("texts"),
    )
    broken = F.col("doc.row").isNull() | F.col("doc.end").isNull()
    said = F.concat(
        F.when(broken, "line is not one JSON array: ").otherwise(
            F.concat(F.lit(f"expected {len(names)} values, found "), F.size("doc.row").cast("string"), F.lit(": "))
        ),
        "line",
    )
    # A generator of one row: it holds whatever columns are read, for a count as well, and what it takes from
    # is parsed once below it, where a filter or a projection would be merged with the parsing and repeat it.
    row = F.array(F.struct(F.col("doc.row").alias("cells"), F.col("texts.row").alias("tokens")))
    whole = F.when(broken | (F.size("doc.row") != len(names)), F.raise_error(said)).otherwise(row)
    return parsed.select(F.inline(whole)).select(
        *[
            _cell(F.col("cells")[i], F.col("tokens")[i], kind, declared).alias(
                name, metadata={NATIVE_TYPE: declared}
            )
            for i, (name, kind, declared) in enumerate(zip(names, kinds, types))
        ]
    )


def _below_headers(header: tuple[str, str]):
    """Lines without the two that open each file, which must be the header.

    Lines of a block come in order and blocks are told apart by a number, so only where a block that opens a file
    begins are lines looked at one by one.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, left, name = None, 0, None

        def complete() -> None:
            if left:
                raise CompactJsonError(f"the header of {name} is not two lines within the first block of it")

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            edges = [0, *(np.flatnonzero(blocks[1:] != blocks[:-1]) + 1).tolist(), len(blocks)]
            keep = np.ones(len(blocks), bool)
            for start, end in zip(edges, edges[1:]):
                if start == end:
                    continue
                if blocks[start] != current:
                    complete()
                    current, name = blocks[start], batch.column("opened")[start].as_py()
                    left = 0 if name is None else len(header)
                for at in range(start, min(start + left, end)):
                    if batch.column("line")[at].as_py() != header[len(header) - left]:
                        raise CompactJsonError(f"{name} has a different header than the stream: {header}")
                    keep[at], left = False, left - 1
            yield batch.select(["line"]).filter(pa.array(keep))
        complete()

    return task


def stream_compact_json(
    spark: SparkSession,
    path: str,
    header: tuple[str, str] | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """Header-typed JSON line files of a folder as a stream, with rows typed as ``read_compact_json`` types them.

    The files that are there now fix the header; for a folder that is still empty give its two lines. Spark's file
    source keeps which files have been read, and shares a large file between tasks, so a stream resumes where it
    ended and a batch can be run again. A file with another or an incomplete header fails its batch.
    """
    found = header or _header(spark, path)
    if found is None:
        raise CompactJsonError(f"{path} has no file yet, so give the two header lines of the stream")
    names, types = _columns(found)
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    meta = "_metadata.file_path", "_metadata.file_block_start"
    lines = reader.text(path).select(
        F.btrim("value", F.lit(_BLANK)).alias("line"),
        F.xxhash64(*meta).alias("block"),
        F.when(F.col(meta[1]) == 0, F.col(meta[0])).alias("opened"),
    )
    data = lines.where(F.col("line") != "").mapInArrow(_below_headers(found), "line string")
    return _typed_rows(data, names, types)

"""CSV whose quoted cells hold line breaks, with each large file shared by many tasks.

Spark's text scan cuts a file into blocks at line ends, but whether a line end there ends a record depends on
whether it lies inside quotes, and so on all that comes before it. Read from outside or from inside quotes, a
block is a function from the state before it to the state after it. One scan finds that function for every
block, running both cases side by side; composing the functions along a file gives the state every block
begins in. A second scan then puts lines together to records. What is left over at the edges of blocks, the
pieces of records that straddle them, is joined by the block its record began in.

Only one row per block passes through the driver, as for row numbers.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.encode import quoted

QUOTE = '"'
_BLOCK = ["file", "start", "length"]
# Of a block: its partition, the state after it from either state before it, where the record that is open then
# began, where the record that comes into it ends (null: not in it), and whether it begins with an open record.
_BLOCKS = pa.schema(
    [
        *((name, pa.int64()) for name in _BLOCK),
        ("part", pa.int32()),
        ("from_outside", pa.bool_()),
        ("from_inside", pa.bool_()),
        ("open_from_outside", pa.int64()),
        ("open_from_inside", pa.int64()),
        ("closes", pa.int64()),
        ("first_stays_open", pa.bool_()),
    ]
)
_KNOWN = (
    "file bigint, start bigint, length bigint, part int, number int, inside boolean, home int, "
    "head_until bigint, open_from bigint, header_open boolean"
)
_RECORDS = pa.schema([("record", pa.string()), ("header", pa.bool_())])
_PARSE = {"mode": "FAILFAST", "escape": QUOTE, "multiLine": "true"}
_ROWS_AT_A_TIME = 4096


class CsvError(ValueError):
    """A file cannot be cut into records, or does not have the header of the others."""


def inside_after(line: str, inside: bool, sep: str = ",") -> bool:
    """Whether the end of ``line`` lies inside quotes. A quote opens a cell only where the cell begins."""
    if QUOTE not in line:
        return inside
    at = 0
    if not inside and line.startswith(QUOTE):
        at, inside = 1, True
    while True:
        while inside:
            at = line.find(QUOTE, at)
            if at < 0:
                return True
            inside = line.startswith(QUOTE, at + 1)  # a doubled quote is text
            at += 2 if inside else 1
        opening = line.find(sep + QUOTE, at)
        if opening < 0:
            return False
        at, inside = opening + len(sep) + 1, True


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    text = spark.read.option("lineSep", "\n").text(path)
    return text.select(
        F.col("value").alias("line"),
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.monotonically_increasing_id().alias("place"),
        F.spark_partition_id().alias("part"),
    )


def block_functions(lines: DataFrame, sep: str) -> DataFrame:
    """One row per block, as ``_BLOCKS`` says."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, outside, inside, open_outside, open_inside, closes, whole = None, False, True, 0, 0, None, False

        def done() -> pa.RecordBatch:
            row = (*block, outside, inside, open_outside, open_inside, closes, not whole)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _BLOCKS)], schema=_BLOCKS)

        for batch in batches:
            texts, places, *where = (column.to_pylist() for column in batch.columns)
            for line, place, *at in zip(texts, places, *where):
                if at != block:
                    if block is not None:
                        yield done()
                    block, outside, inside, open_outside, open_inside, closes, whole = at, False, True, place, place, None, False
                same = outside == inside
                outside = inside_after(line, outside, sep)
                inside = outside if same else inside_after(line, inside, sep)
                if not outside:
                    whole = whole or open_outside < place or bool(line.removesuffix("\r"))
                    open_outside = place + 1
                if not inside:
                    closes = place if closes is None else closes
                    open_inside = place + 1
        if block is not None:
            yield done()

    kinds = (
        "file bigint, start bigint, length bigint, part int, from_outside boolean, from_inside boolean, "
        "open_from_outside bigint, open_from_inside bigint, closes bigint, first_stays_open boolean"
    )
    return lines.select("line", "place", *_BLOCK, "part").mapInArrow(task, kinds)


def composed(functions: list) -> list[tuple]:
    """The blocks of all files, in order, as ``_KNOWN`` says: the state each begins in, the number of the block where the
    record that comes into it began, up to which line that record's piece goes, and from which line an open one begins."""
    rows, number = [], 0
    for file, blocks in groupby(sorted(functions, key=lambda b: (b["file"], b["start"])), key=lambda b: b["file"]):
        inside, home = False, None
        for block in blocks:
            ends_inside = block["from_inside"] if inside else block["from_outside"]
            stays = inside and block["closes"] is None
            opened = block["open_from_inside"] if inside else block["open_from_outside"]
            until = block["closes"] if inside and not stays else None
            header = block["start"] == 0 and block["first_stays_open"]
            rows.append(
                (file, block["start"], block["length"], block["part"], number, inside, home, until)
                + (opened if ends_inside and not stays else None, header)
            )
            home = (home if stays else number) if ends_inside else None
            inside, number = ends_inside, number + 1
        if inside:
            raise CsvError(f"a file ends inside quotes, opened in its block at byte {rows[home][1]}; its path hashes to {file}")
    return rows


def whole_records(lines: DataFrame) -> DataFrame:
    """``record`` and ``header`` of the records that lie within one block; blank lines between records are none."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, inside, coming, header, held = None, False, False, False, []
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _RECORDS)], schema=_RECORDS)

        for batch in batches:
            for line, block, begins_inside, opens_file, sep in zip(*(c.to_pylist() for c in batch.columns)):
                if block != at:  # what was still held is a piece
                    at, inside, coming, header, held = block, begins_inside, begins_inside, opens_file, []
                inside = inside_after(line, inside, sep)
                if inside:
                    if not coming:
                        held.append(line)
                    continue
                if not coming:
                    held.append(line)
                    text = "\n".join(held).removesuffix("\r")
                    if text:
                        out.append((text, header))
                        header = False
                coming, held = False, []
                if len(out) >= _ROWS_AT_A_TIME:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)
                out = []

    return lines.mapInArrow(task, "record string, header boolean")


def straddling_records(placed: DataFrame) -> DataFrame:
    """``record`` and ``header`` of the records that lie in several blocks, put together from their lines."""
    stays = F.col("inside") & F.col("head_until").isNull()
    head = F.col("inside") & (stays | (F.col("place") <= F.col("head_until")))
    tail = F.col("place") >= F.col("open_from")
    pieces = placed.where(head | tail).select(
        F.when(head, F.col("home")).otherwise(F.col("number")).alias("home"),
        F.struct("number", "place", "line").alias("piece"),
        (~head & F.col("header_open")).alias("header"),
    )
    held = pieces.groupBy("home").agg(F.sort_array(F.collect_list("piece")).alias("pieces"), F.bool_or("header").alias("header"))
    text = F.array_join(F.col("pieces.line"), "\n")
    return held.select(F.regexp_replace(text, "\r$", "").alias("record"), "header")


def _detected(rows: DataFrame) -> T.StructType:
    """The narrowest type that holds every cell of a column, of those CSV scans detect; text where there is none."""
    tests = {
        "int": lambda c: c.rlike(r"^[+-]?\d+$") & c.try_cast("int").isNotNull(),
        "bigint": lambda c: c.rlike(r"^[+-]?\d+$") & c.try_cast("bigint").isNotNull(),
        "double": lambda c: c.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$|^NaN$|^-?Inf$"),
        "timestamp": lambda c: c.rlike(r"^\d{4}-\d\d-\d\d([ T]\d\d:\d\d:\d\d(\.\d+)?)?$") & c.try_cast("timestamp").isNotNull(),
        "boolean": lambda c: F.lower(c).isin("true", "false"),
    }
    asked = [
        F.bool_and(test(quoted(name))).alias(f"{i}_{kind}") for i, name in enumerate(rows.columns) for kind, test in tests.items()
    ]
    found = rows.agg(*asked).first()
    kinds = [next((kind for kind in tests if found[f"{i}_{kind}"]), "string") for i in range(len(rows.columns))]
    return T.StructType(
        [T.StructField(name, T.StructType.fromDDL(f"c {kind}")[0].dataType) for name, kind in zip(rows.columns, kinds)]
    )


def read_csv_split(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None, sep: str = ","
) -> DataFrame:
    """CSV with a header line in every file, read in blocks; quoted cells may hold line breaks, quotes are doubled.

    The data is scanned once here, to find where quotes are open, and again when rows are read (and for types
    to be detected, where no ``schema`` is given): by tasks that put lines together, and for the few lines at the edges
    of blocks. Lines end in LF or CRLF. A cell its type cannot hold, a
    row of the wrong length, another header than the first file's and a file that ends inside quotes fail the
    query. The frame stands for the blocks found here: should the cluster change so that files are cut
    elsewhere, it fails and asks to be made again.
    """
    lines = _lines(spark, path)
    blocks = composed(block_functions(lines, sep).collect())
    names = spark.read.option("header", True).option("multiLine", True).option("escape", QUOTE).option("sep", sep).csv(path).columns
    known = spark.createDataFrame(blocks, _KNOWN)
    placed = lines.join(F.broadcast(known), [*_BLOCK, "part"], "left")
    moved = F.raise_error(F.lit("files are cut into other blocks than when they were scanned; read them again"))
    placed = placed.where(F.when(F.col("number").isNull(), moved.cast("boolean")).otherwise(True))
    within = placed.select("line", "number", "inside", (F.col("start") == 0).alias("opens"), F.lit(sep).alias("sep"))
    records = whole_records(within).unionByName(straddling_records(placed))

    texts = T.StructType([T.StructField(f"_{i}", T.StringType()) for i in range(len(names))])
    options = {**_PARSE, "sep": sep}

    def parsed(form: T.StructType, record: Column | str = "record") -> Column:
        return F.from_csv(record, form.toDDL(), options)

    # The first task that opens a file finds its header, unless that is longer than a block.
    opening = whole_records(within.where("opens")).where("header").first() or records.where("header").first()
    if opening is None:
        return spark.createDataFrame([], schema if schema is not None else T.StructType([]))
    differs = F.when(
        ~parsed(texts).eqNullSafe(parsed(texts, F.lit(opening["record"]))),
        F.raise_error(F.concat(F.lit("a file has another header than the first: "), "record")).cast("boolean"),
    )
    data = records.where(F.when(F.col("header"), F.coalesce(differs, F.lit(False))).otherwise(True)).select("record")
    if schema is None:
        cells = data.select(parsed(texts).alias("row")).select("row.*").toDF(*names)
        schema = _detected(cells)
    form = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return data.select(parsed(form).alias("row")).select("row.*")

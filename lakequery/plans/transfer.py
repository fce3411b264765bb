"""Exports read back, and sources read from files Spark made of whole tables."""

from __future__ import annotations

import io
import zipfile
from itertools import islice
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import functions as F

from lakequery.functions.encode import EMBEDDED
from lakequery.plans.registry import plan, table, views
from lakequery.sinks.dataset import INFERRED, write_dataset
from lakequery.sources.compact_json import read_compact_json, stream_compact_json
from lakequery.sources.csv import read_csv, register_csv
from lakequery.storage import scratch_dir
from lakequery.streaming.export import save_stream
from lakequery.streaming.inferred import read_inferred

_CUSTOMER = "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
_ORDERS = (
    "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, "
    "o_orderdate string, o_orderpriority string"
)


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    write_dataset(table(spark, sf_dir, "documents"), "csv", path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    return read_csv(spark, path, schema)


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents")
def csv_split_scan(spark, sf_dir):
    """Texts full of line breaks, in files that tasks share."""
    path = scratch_dir(spark, "csv")
    write_dataset(table(spark, sf_dir, "documents"), "csv", path)
    return read_csv(spark, path, "doc_id long, text string, lang string, source string, n_chars long", split=True)


@plan("SELECT page_id, url, html FROM pages")
def csv_pages(spark, sf_dir):
    """Markup is full of quotes, commas and line breaks."""
    path = scratch_dir(spark, "csv")
    write_dataset(table(spark, sf_dir, "pages"), "csv", path)
    return read_csv(spark, path, "page_id long, url string, html string")


@plan("SELECT * FROM customer")
def csv_append(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    customer = table(spark, sf_dir, "customer")
    write_dataset(customer.where("c_nationkey < 12"), "csv", path)
    write_dataset(customer.where("c_nationkey >= 12"), "csv", path, "append")
    return read_csv(spark, path, _CUSTOMER)


@plan(
    """
    SELECT o_orderstatus, count(*) AS n, max(o_orderkey) AS last_key, max(o_totalprice) AS top_price
    FROM orders GROUP BY o_orderstatus
    """
)
def csv_scan(spark, sf_dir):
    path = scratch_dir(spark, "csv")
    write_dataset(table(spark, sf_dir, "orders"), "csv", path)
    register_csv(spark, "orders_csv", path, multi_line=False)
    return spark.sql(
        "SELECT o_orderstatus, count(*) AS n, CAST(max(o_orderkey) AS BIGINT) AS last_key,"
        " max(o_totalprice) AS top_price FROM orders_csv GROUP BY o_orderstatus"
    )


_ORDERS_ENCODED = """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           'timestamp(Microsecond, ' || epoch_us(o_orderdate) || ')' AS o_orderdate, o_orderpriority
    FROM orders
"""


@plan(_ORDERS_ENCODED)
def json_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "json")
    write_dataset(table(spark, sf_dir, "orders"), "json", path)
    return spark.read.schema(_ORDERS).json(path)


@plan("SELECT doc_id, text, lang, source, n_chars FROM documents")
def json_documents(spark, sf_dir):
    path = scratch_dir(spark, "json")
    documents = table(spark, sf_dir, "documents")
    write_dataset(documents, "json", path)
    return spark.read.schema(documents.schema).json(path)


@plan(
    """
    SELECT conv_id, turn, role, text FROM conversations
    """
)
def orc_conversations(spark, sf_dir):
    path = scratch_dir(spark, "orc")
    write_dataset(table(spark, sf_dir, "conversations"), "orc", path)
    return spark.read.orc(path)


@plan(_ORDERS_ENCODED)
def json_append(spark, sf_dir):
    path = scratch_dir(spark, "json")
    orders = table(spark, sf_dir, "orders")
    write_dataset(orders.where("o_orderstatus = 'F'"), "json", path)
    write_dataset(orders.where("o_orderstatus != 'F'"), "json", path, "append")
    return spark.read.schema(_ORDERS).json(path)


_LINEITEM_EXPORTED = """
    SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
           l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
           'timestamp(Microsecond, ' || epoch_us(l_shipdate) || ')' AS l_shipdate
    FROM lineitem
"""


@plan(_LINEITEM_EXPORTED)
def parquet_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "parquet")
    write_dataset(table(spark, sf_dir, "lineitem"), "parquet", path)
    return spark.read.parquet(path)


@plan(_LINEITEM_EXPORTED)
def orc_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "orc")
    write_dataset(table(spark, sf_dir, "lineitem"), "orc", path)
    return spark.read.orc(path)


_SHEET = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


_ROWS_AT_A_TIME = 5_000


def _workbook_rows(content: bytes):
    """Cell text of each row below the header; a blank cell is null."""
    with zipfile.ZipFile(io.BytesIO(content)) as book, book.open("xl/worksheets/sheet1.xml") as sheet:
        letters = None
        for _, node in ElementTree.iterparse(sheet):
            if node.tag == f"{_SHEET}row":
                cells = {c.get("r").rstrip("0123456789"): "".join(c.itertext()) for c in node}
                if letters is None:
                    letters = list(cells)
                else:
                    yield [cells.get(letter) for letter in letters]
                node.clear()


def _sheet_rows(batches):
    schema = pa.schema([("cells", pa.list_(pa.string()))])
    for batch in batches:
        for content in batch.column("content"):
            rows = _workbook_rows(content.as_py())
            while part := list(islice(rows, _ROWS_AT_A_TIME)):
                yield pa.RecordBatch.from_pydict({"cells": part}, schema)


@plan("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def xlsx_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "xlsx")
    customer = table(spark, sf_dir, "customer")
    write_dataset(customer, "xlsx", path)
    books = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path)
    rows = books.select("content").mapInArrow(_sheet_rows, "cells array<string>")
    return rows.select(
        *[
            (F.col("cells")[i].cast("double") if f.dataType.typeName() != "string" else F.col("cells")[i])
            .cast(f.dataType)
            .alias(f.name)
            for i, f in enumerate(customer.schema.fields)
        ]
    )


@plan(
    """
    SELECT file_type, row_count FROM (SELECT count(*) AS row_count FROM customer),
      (VALUES ('csv'), ('excel'), ('json'), ('orc'), ('parquet')) AS formats(file_type)
    """
)
def save_row_count(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    saved = [
        write_dataset(customer, name, scratch_dir(spark, name))
        for name in ("csv", "xlsx", "json", "orc", "parquet")
    ]
    return spark.createDataFrame(
        [(s.file_type, s.row_count) for s in saved], "file_type string, row_count bigint"
    )


def _headed(lines, path: str, names: str, types: str) -> None:
    """Write a frame of lines so that every part file starts with its two header lines."""
    place = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    placed = lines.select("line", place.alias("place"))
    headed = F.when(F.col("place") == 0, F.array(F.lit(names), F.lit(types), F.col("line")))
    every = placed.select(F.explode(headed.otherwise(F.array("line"))).alias("value"))
    every.write.option("maxRecordsPerFile", 0).text(path)


@plan("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def compact_json_scan(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    names = '["c_custkey","c_name","c_nationkey","c_acctbal","c_mktsegment"]'
    types = '["Int64","String","Nullable(Int32)","Float64","LowCardinality(String)"]'
    line = F.to_json(F.array(*[F.col(c).cast("variant") for c in customer.columns]))
    path = scratch_dir(spark, "compact")
    _headed(customer.select(line.alias("line")), path, names, types)
    return read_compact_json(spark, path)


@plan(
    """
    SELECT CASE WHEN event_type IN ('click', 'view') THEN NULL ELSE event_id END AS id,
           CASE event_type WHEN 'click' THEN 'name' WHEN 'view' THEN 'String' ELSE props END AS name
    FROM events
    """
)
def compact_json_lookalikes(spark, sf_dir):
    """Two kinds of rows are the very text of a header line; none may be lost."""
    names, types = '["id","name"]', '["Int64","String"]'
    line = (
        F.when(F.col("event_type") == "click", names)
        .when(F.col("event_type") == "view", types)
        .otherwise(F.to_json(F.array(F.col("event_id").cast("variant"), F.col("props").cast("variant"))))
    )
    path = scratch_dir(spark, "compact")
    _headed(table(spark, sf_dir, "events").select(line.alias("line")), path, names, types)
    return read_compact_json(spark, path)


@plan(
    """
    SELECT l_orderkey, '1701411834604692317316873037158841' || lpad(CAST(l_partkey AS VARCHAR), 5, '0') AS wide,
           CAST(9000000000000000000 + l_orderkey AS BIGINT) AS long
    FROM lineitem
    """
)
def compact_json_wide_ints(spark, sf_dir):
    """Integers of 39 digits as numbers, and of 19 digits as quoted ones."""
    wide = F.concat(F.lit("1701411834604692317316873037158841"), F.lpad(F.col("l_partkey").cast("string"), 5, "0"))
    long = (F.lit(9_000_000_000_000_000_000) + F.col("l_orderkey")).cast("string")
    line = F.concat(F.lit("["), F.col("l_orderkey").cast("string"), F.lit(","), wide, F.lit(',"'), long, F.lit('"]'))
    path = scratch_dir(spark, "compact")
    _headed(
        table(spark, sf_dir, "lineitem").select(line.alias("line")),
        path,
        '["l_orderkey","wide","long"]',
        '["Int64","UInt128","Int64"]',
    )
    return read_compact_json(spark, path)


def _event_stream(spark, sf_dir):
    """Events as a stream of many files, several micro-batches of them."""
    events, path = table(spark, sf_dir, "events"), scratch_dir(spark, "stream-in")
    events.repartition(12).write.parquet(path)
    return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 5).parquet(path)


def _event_counts(saved):
    return saved.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.max("event_id").alias("last_id")
    )


@plan("SELECT event_type, count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type")
def stream_save(spark, sf_dir):
    """An export that overwrites an earlier one of the same events."""
    target = scratch_dir(spark, "stream-out")
    for attempt in ("first", "second"):
        state = scratch_dir(spark, f"stream-state-{attempt}")
        save_stream(_event_stream(spark, sf_dir), "parquet", target, state, dialect=EMBEDDED)
    return _event_counts(spark.read.parquet(target))


@plan("SELECT event_type, 2 * count(*) AS n, max(event_id) AS last_id FROM events GROUP BY event_type")
def stream_append(spark, sf_dir):
    """Two streams that add to one dataset."""
    target = scratch_dir(spark, "stream-out")
    for attempt in ("first", "second"):
        state = scratch_dir(spark, f"stream-state-{attempt}")
        save_stream(_event_stream(spark, sf_dir), "json", target, state, "append", EMBEDDED)
    return _event_counts(spark.read.schema("event_id long, event_type string").json(target))


@plan(
    """
    SELECT CAST(event_id % 7 AS BIGINT) AS day, count(*) AS n, count(props) AS with_props, sum(user_id)::BIGINT AS users
    FROM events GROUP BY 1
    """
)
def stream_checked_files(spark, sf_dir):
    """Many files in several micro-batches, the columns of each held against those of the first."""
    target, state = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-state")
    save_stream(_event_stream(spark, sf_dir), "orc", target, state)
    day = F.expr("event_id % 7").cast("long").alias("day")
    return spark.read.orc(target).groupBy(day).agg(
        F.count(F.lit(1)).alias("n"), F.count("props").alias("with_props"), F.sum("user_id").alias("users")
    )


@plan("SELECT event_id, event_type, user_id, value FROM events")
def compact_json_stream(spark, sf_dir):
    """Header-typed files read as a stream in two runs; the second finds only the files that came meanwhile."""
    source, target, state = (scratch_dir(spark, name) for name in ("compact", "stream-out", "stream-state"))
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")
    names, types = '["event_id","event_type","user_id","value"]', '["Int64","String","Nullable(Int64)","Nullable(Float64)"]'
    for part in range(2):
        chosen = events.where(F.col("event_id") % 3 == 0 if part else F.col("event_id") % 3 != 0).repartition(6)
        line = F.to_json(F.array(*[F.col(c).cast("variant") for c in events.columns]))
        _headed(chosen.select(line.alias("line")), f"{source}/{part}", names, types)
        stream = stream_compact_json(spark, f"{source}/*", max_files=4)
        save_stream(stream, "parquet", target, state)
    return spark.read.parquet(target)


@plan(
    """
    SELECT event_id, CASE WHEN event_id % 4 = 3 THEN event_id + 0.5 ELSE event_id END::DOUBLE AS amount,
      CASE WHEN event_id % 4 = 2 THEN event_type ELSE user_id::VARCHAR END AS code,
      user_id % 2 = 0 AS even
    FROM events
    """
)
def stream_inferred(spark, sf_dir):
    """Columns that look whole in the first files; fractions and names come in later micro-batches."""
    views(spark, sf_dir, "events")
    path = scratch_dir(spark, "stream-in")
    rows = spark.sql(
        """SELECT event_id, event_id % 4 AS quarter, user_id % 2 = 0 AS even,
             parse_json(concat(event_id, if(event_id % 4 = 3, '.5', ''))) AS amount,
             if(event_id % 4 = 2, CAST(event_type AS VARIANT), CAST(user_id AS VARIANT)) AS code
           FROM events"""
    )
    target, state = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-state")
    for quarter in range(4):
        rows.where(f"quarter = {quarter}").drop("quarter").write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.drop("quarter").schema).parquet(path)
        save_stream(stream, "parquet", target, state, typing=INFERRED)
    return read_inferred(spark, target, "parquet")

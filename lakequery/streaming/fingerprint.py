"""The columns of a stream's input files, which the first of them fixes for all later ones.

A file stream has one schema, given before any file is seen, and Spark reads every file under it: a column
that a file lacks, or holds under another name, comes as nulls. So the columns each file really has are read
from its footer or header line, by tasks, before a micro-batch is stored.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import orc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.sinks.formats import ExportError
from lakequery.storage import Storage, open_filesystem

COLUMNAR, DELIMITED = ("parquet", "orc"), ("csv", "csv.gz", "csv.bz2", "csv.zst", "csv.lz4", "csv.snappy")
_SOURCE_ENTRY = "path string, batchId long"
_PRINTS = pa.schema([("path", pa.string()), ("columns", pa.string())])


def _kind(dtype: pa.DataType) -> str:
    """A type's name. Variants are shredded into other columns in each file, as its values happen to be."""
    if pa.types.is_struct(dtype):
        names = [field.name for field in dtype]
        if {"metadata", "value"} <= set(names) <= {"metadata", "value", "typed_value"}:
            return "variant"
        return f"struct<{', '.join(f'{json.dumps(field.name)}: {_kind(field.type)}' for field in dtype)}>"
    if pa.types.is_map(dtype):
        return f"map<{_kind(dtype.key_type)}, {_kind(dtype.item_type)}>"
    if pa.types.is_list(dtype) or pa.types.is_large_list(dtype):
        return f"list<{_kind(dtype.value_type)}>"
    return str(dtype)


def _listed(schema: pa.Schema) -> str:
    return json.dumps([[field.name, _kind(field.type)] for field in schema], ensure_ascii=False)


def file_columns(uri: str, header: bool) -> str | None:
    """Names, and types where the format has them, as JSON; None for a format that holds no columns."""
    fs, path = open_filesystem(uri)
    name = path.rsplit("/", 1)[-1].lower()
    if name.endswith(".parquet"):
        with fs.open_input_file(path) as file:
            return _listed(pq.read_schema(file))
    if name.endswith(".orc"):
        with fs.open_input_file(path) as file:
            return _listed(orc.ORCFile(file).schema)
    if header and name.endswith(DELIMITED):
        with fs.open_input_stream(path) as stream:  # unpacked by its extension
            rows = csv.reader(io.TextIOWrapper(stream, encoding="utf-8", newline=""))
            first = next((row for row in rows if row), None)
        return None if first is None else json.dumps([[cell] for cell in first], ensure_ascii=False)
    return None


def batch_files(spark: SparkSession, checkpoint: str, batch_id: int) -> DataFrame:
    """``source`` and ``path`` of every file of a micro-batch, as its checkpoint lists them.

    Spark notes, before it runs a batch, up to which entry each file source is read, and the files of each entry.
    Sources that are not files have no such list.
    """
    storage = Storage(spark)

    def offsets(batch: int) -> list[str]:
        path = f"{checkpoint}/offsets/{batch}"
        return [row[0] for row in spark.read.text(path).collect()][2:] if batch >= 0 and storage.exists(path) else []

    def entry(line: str) -> int:
        found = json.loads(line) if line.startswith("{") else {}
        return found.get("logOffset", -1)

    before, found = offsets(batch_id - 1), None
    for source, line in enumerate(offsets(batch_id)):
        low, high = entry(before[source]) if source < len(before) else -1, entry(line)
        folder = f"{checkpoint}/sources/{source}"
        # Older entries move into compact ones, which repeat all before them.
        there = {e.name for e in storage.children(folder)} if high > low else set()
        names = [name for n in range(low + 1, high + 1) for name in (f"{n}", f"{n}.compact") if name in there]
        if not names:
            continue
        lines = spark.read.text([f"{folder}/{name}" for name in names]).where(F.startswith("value", F.lit("{")))
        entries = lines.select(F.from_json("value", _SOURCE_ENTRY).alias("e")).select("e.*")
        listed = entries.where(F.col("batchId").between(low + 1, high)).select(F.lit(source).alias("source"), "path").distinct()
        found = listed if found is None else found.union(listed)
    return found if found is not None else spark.createDataFrame([], "source int, path string")


def distinct_columns(files: DataFrame, header: bool) -> list:
    """One row per source and set of columns among ``files``, with the first file that has it; tasks open the files."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column("path").to_pylist()
            prints = [file_columns(unquote(path), header) for path in paths]
            yield pa.RecordBatch.from_arrays(
                [batch.column("source"), pa.array(paths, pa.string()), pa.array(prints, pa.string())],
                names=["source", "path", "columns"],
            )

    prints = files.mapInArrow(task, "source int, path string, columns string").where("columns IS NOT NULL")
    # Two sets of columns in one source are an error already, so a few rows say all.
    ranked = prints.groupBy("source", "columns").agg(F.min("path").alias("path")).orderBy("source", "path")
    return ranked.limit(64).collect()


def check_files(
    spark: SparkSession, checkpoint: str, batch_id: int, fixed: dict[str, list], header: bool = False
) -> dict[str, list]:
    """Hold the files of a micro-batch against the columns that the first file of each source fixed.

    ``fixed`` maps a source's number to its columns and the file they come from; the result adds sources
    that are new. A file with other names, types or order of columns raises an error that names it.
    """
    fixed = dict(fixed)
    for row in distinct_columns(batch_files(spark, checkpoint, batch_id), header):
        source, own = str(row["source"]), json.loads(row["columns"])
        columns, first = fixed.setdefault(source, [own, row["path"]])
        if own != columns:
            raise ExportError(f"Inconsistent columns in a streaming export: {row['path']} has {own}, but {first} has {columns}")
    return fixed

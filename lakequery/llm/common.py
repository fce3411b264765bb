"""What the corpus operators share: batches of Python rows, tables that cut lineage, bounded checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.storage import drop_scratch, scratch_dir

# How much text Python handles at a time where it works on whole batches.
SLICE_BYTES = 4 << 20
# Spark's settings while a table is stored.
WRITING = {
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}

# The Spark name of each Arrow type the operators return.
SPARK_TYPES = {
    pa.int32(): "int",
    pa.int64(): "bigint",
    pa.float64(): "double",
    pa.bool_(): "boolean",
    pa.string(): "string",
    pa.binary(): "binary",
    pa.list_(pa.int64()): "array<bigint>",
    pa.list_(pa.int32()): "array<int>",
    pa.list_(pa.string()): "array<string>",
}


def spark_schema(schema: pa.Schema) -> str:
    return ", ".join(f"`{field.name}` {SPARK_TYPES[field.type]}" for field in schema)


def map_columns(
    df: DataFrame, schema: pa.Schema, run: Callable[[dict[str, list]], dict[str, list]]
) -> DataFrame:
    """Apply ``run`` to each Arrow batch, given and returning columns as Python lists."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_pydict(run(batch.to_pydict()), schema=schema)

    return df.mapInArrow(task, spark_schema(schema))


def keep_rows(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows, all columns untouched, for whose ``column`` texts ``keep`` says True, a few megabytes of them at a time."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(column)
            for part in text_slices(batch, at):
                yield part.filter(pa.array(keep(part.column(at).to_pylist()), pa.bool_()))
        # The worker stays for other tasks, and would keep what this one took.
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(task, df.schema)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session's settings with these values, and as they were afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read again: a lost executor then costs a read, not a rerun.

    Tasks hand Python bounded batches, and the shuffle files of the write go with its end, as only the table is read again.
    """
    path = scratch_dir(spark, label)
    with settings(spark, WRITING):
        df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    read.scratch_path = path
    return read


def discard(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` that nothing reads any more."""
    for table in tables:
        drop_scratch(table.sparkSession, table.scratch_path)


def documents(df: DataFrame) -> DataFrame:
    """Only doc_id and text, so that no other column of the input can clash."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def slices(texts: list[str], bound: int = SLICE_BYTES) -> Iterator[range]:
    """Neighbouring texts of a few megabytes together; a longer one stands alone."""
    start, size = 0, 0
    for k, text in enumerate(texts):
        if size and size + len(text) > bound:
            yield range(start, k)
            start, size = k, 0
        size += len(text)
    if start < len(texts):
        yield range(start, len(texts))


def text_slices(batch: pa.RecordBatch, column: int, bound: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows of a few megabytes of text together; a longer one stands alone. Nothing is copied."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
    start, held = 0, 0
    for k, size in enumerate(sizes.tolist()):
        if held and held + size > bound:
            yield batch.slice(start, k - start)
            start, held = k, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)

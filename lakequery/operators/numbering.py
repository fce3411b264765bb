"""Row numbers and chunk ids over a whole result, with no step that one task must do alone."""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.encode import quoted
from lakequery.storage import scratch_dir

DEFAULT_BATCH_SIZE = 200
# Up to so many first rows are picked by each task while it reads; more are sorted with all others.
TOP_ROWS = 100_000

# monotonically_increasing_id keeps the partition above this bit and the position below it.
_POSITION_BITS = 33
_HASHED = "_lq_hash"
_PLACE = "_lq_place"


def chunk_size(batch_size: int | None) -> int:
    """Rows per chunk: 200 unless given, and never less than one."""
    return max(DEFAULT_BATCH_SIZE if batch_size is None else int(batch_size), 1)


def content_hash(df: DataFrame) -> Column:
    """A hash of the whole row, maps and variants included."""
    parts = [
        F.to_json(F.struct(quoted(f.name))) if _unhashable(f.dataType) else quoted(f.name)
        for f in df.schema.fields
    ]
    return F.xxhash64(*parts) if parts else F.lit(0).cast("long")


def _unhashable(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.MapType, T.VariantType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _unhashable(dtype.elementType)
    return isinstance(dtype, T.StructType) and any(_unhashable(f.dataType) for f in dtype.fields)


def spread_sort(df: DataFrame, order: list[str], unique: bool = False) -> DataFrame:
    """``df`` sorted by ``order``, with rows of one key free to fill many partitions.

    Ties fall to a hash of the row, then to the row's place in its input partition. Each input
    partition is first sorted by hash (one long, so a radix sort), which brings copies of a row
    together: they always get the same set of places, and a rerun task sends the same rows to the
    same partitions whatever order its input arrived in. With ``unique`` the caller states that no
    two rows agree in ``order``, so there are no ties and a plain range sort does.
    """
    keys = [quoted(name) for name in order]
    if unique:
        return df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    placed = (
        df.withColumn(_HASHED, content_hash(df))
        .sortWithinPartitions(_HASHED)
        .withColumn(_PLACE, F.monotonically_increasing_id())
    )
    return (
        placed.repartitionByRange(*keys, _HASHED, _PLACE)
        .sortWithinPartitions(*keys, _HASHED, _PLACE)
        .drop(_HASHED, _PLACE)
    )


def _storable(df: DataFrame) -> tuple[DataFrame, list[tuple[str, T.DataType]]]:
    """Columns under names by position, in types that files hold, and how to give them back."""
    plain = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    fields = [(f.name, f.dataType) for f in df.schema.fields]
    cells = [
        F.col(f"_{i}").cast("string").alias(f"_{i}") if isinstance(kind, T.CalendarIntervalType) else F.col(f"_{i}")
        for i, (_, kind) in enumerate(fields)
    ]
    return plain.select(*cells), fields


def number_rows(
    df: DataFrame, order: list[str] | None = None, name: str = "row_ord", unique: bool = False
) -> DataFrame:
    """Add a dense 0-based number in result order (that of ``df`` itself unless ``order`` is given).

    The ordered rows are written once to the shared scratch folder with their place, which fixes
    them against lost executors. One narrow scan of that table then counts rows per partition, and
    the running sums (one number per partition, never per row) turn places into numbers; only those
    sums are broadcast. Columns of any type and repeated names are kept. ``unique`` says that
    ``order`` is a key.
    """
    if name in [c.lower() for c in df.columns]:
        raise ValueError(f"there is a column {name} already")
    stored = store_in_order(df, order, unique)
    offsets = stored.spark.createDataFrame([(p.number, p.start) for p in stored.parts], "_lq_part int, _lq_start long")
    return (
        stored.read(stored.path)
        .withColumn("_lq_part", _part_of())
        .join(F.broadcast(offsets), "_lq_part")
        .select(*stored.given_back(), (F.col("_lq_start") + _position_of()).alias(name))
    )


def _part_of() -> Column:
    return F.shiftright(F.col(_PLACE), _POSITION_BITS).cast("int")


def _position_of() -> Column:
    return F.col(_PLACE).bitwiseAND((1 << _POSITION_BITS) - 1)


@dataclass(frozen=True)
class Part:
    """One file of a stored result: the number of its partition and of its first row, and how many rows it has."""

    number: int
    start: int
    rows: int
    file: str


@dataclass(frozen=True)
class StoredResult:
    """A result written in order, with an index of where each file's rows stand in it: one entry per file.

    Rows are found by position without a shuffle: the index names the files, and the places kept beside the
    rows, which rise through a file, let its row groups be skipped.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    fields: list[tuple[str, T.DataType]]
    parts: list[Part]

    @property
    def total(self) -> int:
        return self.parts[-1].start + self.parts[-1].rows if self.parts else 0

    def read(self, *paths: str) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def given_back(self) -> list[Column]:
        return [
            (F.col(f"_{i}").cast("interval") if isinstance(kind, T.CalendarIntervalType) else F.col(f"_{i}")).alias(n)
            for i, (n, kind) in enumerate(self.fields)
        ]

    def rows(self, first: int, count: int, name: str = "row_ord") -> DataFrame:
        """The rows from number ``first`` on, at most ``count``, with their number; only their files are opened."""
        last = min(first + max(count, 0), self.total)
        low = max(0, bisect_right(self.parts, first, key=lambda p: p.start) - 1)
        wanted = [p for p in self.parts[low : bisect_left(self.parts, last, key=lambda p: p.start)] if p.start + p.rows > first]
        if first >= last or not wanted:
            return self.read(self.path).limit(0).select(*self.given_back(), F.lit(0).cast("long").alias(name))
        # Only the first and the last of the files hold other rows as well, so two bounds do.
        head, tail = wanted[0], wanted[-1]
        from_place = (head.number << _POSITION_BITS) + first - head.start
        to_place = (tail.number << _POSITION_BITS) + last - tail.start
        rows = self.read(*[p.file for p in wanted]).where((F.col(_PLACE) >= from_place) & (F.col(_PLACE) < to_place))
        starts = F.lit(head.start)
        for p in wanted[1:]:
            starts = F.when(_part_of() == p.number, F.lit(p.start)).otherwise(starts)
        return rows.select(*self.given_back(), (starts + _position_of()).cast("long").alias(name))


def first_rows(df: DataFrame, order: list[str] | None, count: int) -> DataFrame:
    """The first rows in ``order``, ties by a hash of the row, or else in the order ``df`` has; all its columns are kept."""
    if not order:
        return df.limit(count)
    names = [column.lower() for column in df.columns]
    plain = df.toDF(*[f"_{i}" for i in range(len(names))])
    keys = [F.col(f"_{names.index(key.lower())}") for key in order]
    top = plain.withColumn(_HASHED, content_hash(plain)).orderBy(*keys, _HASHED).limit(count).drop(_HASHED)
    return top.toDF(*df.columns)


def store_in_order(df: DataFrame, order: list[str] | None = None, unique: bool = False) -> StoredResult:
    """Write ``df`` once, in its own order or by ``order``, and index it; the driver sees one row per file."""
    spark = df.sparkSession
    ordered, fields = _storable(df)
    if order:
        names = [column.lower() for column in df.columns]
        ordered = spread_sort(ordered, [f"_{names.index(key.lower())}" for key in order], unique)
    path = scratch_dir(spark, "numbered")
    placed = ordered.withColumn(_PLACE, F.monotonically_increasing_id())
    placed.write.option("maxRecordsPerFile", 0).parquet(path)
    fixed = spark.read.schema(placed.schema).parquet(path)
    counted = fixed.groupBy(_part_of().alias("part")).agg(
        F.count(F.lit(1)).alias("rows"), F.min("_metadata.file_path").alias("file")
    )
    found = sorted(counted.collect())
    starts = accumulate((row["rows"] for row in found), initial=0)
    parts = [Part(row["part"], start, row["rows"], row["file"]) for row, start in zip(found, starts)]
    return StoredResult(spark, path, placed.schema, fields, parts)


def with_batch_id(
    df: DataFrame,
    batch_size: int | None = None,
    order: list[str] | None = None,
    limit: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Add ``row_ord`` and ``batch_id``, so each chunk of the result is a group a job can use.

    A ``limit`` keeps the rows numbered below it, of which a small number is chosen before anything is stored.
    """
    if limit is not None and limit <= TOP_ROWS:
        df = first_rows(df, order, max(limit, 0))
    numbered = number_rows(df, order, unique=unique)
    if limit is not None:
        numbered = numbered.where(F.col("row_ord") < max(limit, 0))
    size = chunk_size(batch_size)
    return numbered.withColumn("batch_id", F.expr(f"row_ord div {size}"))


def pages(df: DataFrame, rows: int) -> DataFrame:
    """The rows in result order, in partitions of ``rows`` rows each, for jobs that take a page per task."""
    numbered = number_rows(df, name="_lq_row")
    last = numbered.agg(F.max("_lq_row")).first()[0]
    count = 1 if last is None else last // rows + 1
    page = F.expr(f"CAST(_lq_row div {rows} AS INT)")
    placed = numbered.repartitionById(count, page).sortWithinPartitions("_lq_row")
    return placed.drop("_lq_row")


def page_rows(df: DataFrame, rows: int) -> Iterator[Row]:
    """The rows in result order, read ``rows`` at a time: the driver holds one such page, and no task more."""
    stored = store_in_order(df)
    for first in range(0, stored.total, rows):
        page = stored.rows(first, rows, "_lq_row").collect()
        yield from sorted(page, key=lambda row: row[-1])

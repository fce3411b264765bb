"""The statement log: every statement of every session as rows to query."""

from __future__ import annotations

import time
import uuid
import warnings
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakequery.log_compaction import MOST_FILES, merge_log, read_merged
from lakequery.operators.numbering import number_rows
from lakequery.storage import Storage

QUERY, QUERY_STREAM, SAVE = "query", "queryStream", "save"
SUCCESS, ERROR = "success", "error"

LOG_SCHEMA = (
    "session_id string, view_name string, operation string, sql string, created_at timestamp, "
    "row_count bigint, status string, error string, duration_ms bigint"
)

# The shape of a session document and of its times (UTC, milliseconds, Z).
SESSION_SCHEMA = (
    "session_id string, created_at string, updated_at string, "
    "views array<struct<view_name: string, operation: string, sql: string, created_at: string, "
    "row_count: bigint, status: string, error: string>>"
)
TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Rows that wait until they are written together.
FLUSH_ROWS = 500

# Rows of one session that a lookup of its first row handles together.
_CHUNK_ROWS = 1_000_000


@dataclass(frozen=True)
class SessionInfo:
    session_id: str
    path: str


def time_text(c: Column, timezone_name: str = "UTC") -> Column:
    """A timestamp as UTC text with milliseconds; ``timezone_name`` is the session's."""
    return F.date_format(F.to_utc_timestamp(c, timezone_name), TIME_FORMAT)


def parse_time(c: Column) -> Column:
    """The timestamp in such text; null when it is not one."""
    return F.try_to_timestamp(c)


@dataclass
class StatementLog:
    """The rows one session adds to the shared log under ``path``, partitioned by day.

    Rows are written in groups: when ``FLUSH_ROWS`` wait, when the table is read, and at ``flush``.
    A log that cannot be written warns and keeps its rows for the next try; it never hides the
    outcome of a statement.
    """

    spark: SparkSession
    path: str
    session_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    _generated: int = 0
    _waiting: list[tuple] = field(default_factory=list)

    def name(self, view_name: str | None) -> str:
        """A given name trimmed; a blank one becomes the next generated name."""
        given = (view_name or "").strip()
        if given:
            return given
        self._generated += 1
        return f"view_{self._generated}"

    def append(
        self,
        operation: str,
        sql: str,
        view_name: str | None = None,
        row_count: int | None = None,
        error: str | None = None,
        duration_ms: int | None = None,
    ) -> None:
        """Add the row of a statement that has ended."""
        self._waiting.append(
            (
                self.session_id,
                self.name(view_name),
                operation,
                sql,
                datetime.now(timezone.utc),
                None if error is not None else row_count,
                SUCCESS if error is None else ERROR,
                error,
                duration_ms,
            )
        )
        if len(self._waiting) >= FLUSH_ROWS:
            try:
                self.flush()
            except Exception as failure:
                warnings.warn(f"the statement log at {self.path} was not written: {failure}", stacklevel=2)

    def flush(self) -> None:
        """Write the rows that wait, one file a day."""
        if not self._waiting:
            return
        rows = [(*row, row[4].date().isoformat()) for row in self._waiting]
        frame = self.spark.createDataFrame(rows, f"{LOG_SCHEMA}, log_date string").coalesce(1)
        frame.write.mode("append").partitionBy("log_date").parquet(self.path)
        self._waiting.clear()

    def table(self) -> DataFrame:
        """The log of all sessions, ``log_date`` included for pruning."""
        schema = f"{LOG_SCHEMA}, log_date string"
        self.flush()
        if not Storage(self.spark).exists(self.path):
            return self.spark.createDataFrame([], schema)
        return read_merged(self.spark, self.path, schema)

    def compact(self, most: int = MOST_FILES) -> int:
        """Merge the small files of days that have more than ``most``; sessions may write meanwhile."""
        self.flush()
        return merge_log(self.spark, self.path, LOG_SCHEMA, most)

    def info(self) -> SessionInfo:
        return SessionInfo(self.session_id, self.path)


class Timer:
    """Milliseconds since it was made."""

    def __init__(self):
        self._start = time.monotonic()

    @property
    def ms(self) -> int:
        return int((time.monotonic() - self._start) * 1000)


def read_sessions(
    spark: SparkSession, paths: str | list[str], multi_line: bool = True
) -> DataFrame:
    """Session documents as one row per statement, with its position in the document.

    Each file is one document; ``multi_line=False`` reads files that hold one document per line.
    A malformed document fails the query.
    """
    reader = spark.read.schema(SESSION_SCHEMA).option("mode", "FAILFAST")
    documents = reader.option("multiLine", multi_line).json(paths)
    return documents.select("session_id", F.posexplode("views").alias("position", "view")).select(
        "session_id",
        "position",
        F.col("view.view_name").alias("view_name"),
        F.col("view.operation").alias("operation"),
        F.col("view.sql").alias("sql"),
        parse_time(F.col("view.created_at")).alias("created_at"),
        F.col("view.row_count").alias("row_count"),
        F.col("view.status").alias("status"),
        F.col("view.error").alias("error"),
    )


def session_summary(statements: DataFrame) -> DataFrame:
    """Statements and rows per session, operation and status; each task adds up its own first."""
    return statements.groupBy("session_id", "operation", "status").agg(
        F.count(F.lit(1)).alias("statements"),
        F.coalesce(F.sum("row_count"), F.lit(0)).cast("bigint").alias("total_rows"),
    )


def named_views(statements: DataFrame, order: str = "position") -> DataFrame:
    """Apply the naming rule to a log: blank names are numbered per session, in ``order``.

    All blank rows get one dense numbering in session order; a row's index is its number less that
    of its session's first row. First numbers are looked up by session and chunk of numbers, so
    even a session that wrote most of the log is never one group of rows.
    """
    blank = F.coalesce(F.trim("view_name"), F.lit("")) == ""
    given = statements.where(~blank).withColumn("view_name", F.trim("view_name"))
    numbered = number_rows(statements.where(blank), ["session_id", order], "_lq_view").withColumn(
        "_lq_chunk", F.expr(f"_lq_view div {_CHUNK_ROWS}")
    )
    by_session = Window.partitionBy("_lq_session")  # one row per chunk a session has rows in
    firsts = (
        numbered.groupBy(
            F.col("session_id").alias("_lq_session"), F.col("_lq_chunk").alias("_lq_part")
        )
        .agg(F.min("_lq_view").alias("_lq_low"))
        .select("_lq_session", "_lq_part", F.min("_lq_low").over(by_session).alias("_lq_first"))
    )
    found = numbered.join(
        firsts,
        F.col("session_id").eqNullSafe(F.col("_lq_session"))
        & (F.col("_lq_chunk") == F.col("_lq_part")),
    )
    index = F.col("_lq_view") - F.col("_lq_first") + 1
    generated = found.withColumn("view_name", F.concat(F.lit("view_"), index.cast("string")))
    return given.unionByName(generated.select(*statements.columns))

"""One user's session: run SQL, page it, export it, and log each statement."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession

from lakequery.functions.encode import EMBEDDED, row_json
from lakequery.operators.capped import ColumnMeta, cap, columns, row_cap
from lakequery.operators.numbering import chunk_size, page_rows, with_batch_id
from lakequery.sinks.dataset import DECLARED, write_dataset
from lakequery.sinks.formats import SaveResult
from lakequery.sources.jdbc import Database, Partitioning, read_database
from lakequery.statements import (
    QUERY,
    QUERY_STREAM,
    SAVE,
    SessionInfo,
    StatementLog,
    Timer,
)
from lakequery.streaming.export import save_stream

Result = TypeVar("Result")

# Chunks that one task hands to the reader of a paged result at a time.
PAGE_CHUNKS = 50


@dataclass(frozen=True)
class QueryBatch:
    columns: list[ColumnMeta]
    rows: list[dict]


class QueryResult:
    """A result: ``rows`` for a client, ``run`` and ``df`` for work on the cluster."""

    def __init__(
        self, session: Session, sql: str, df: DataFrame, limit: int | None, view_name: str | None
    ):
        self.columns = columns(df)
        self.df = cap(df, limit)
        self.execution_time_ms: int | None = None
        self._session, self._sql, self._view_name = session, sql, view_name
        self._whole, self._limit = df, limit

    def run(
        self, action: Callable[[DataFrame], Result], rows_of: Callable[[Result], int | None] = lambda found: None
    ) -> Result:
        """Hand the frame to ``action``, and log the statement with the outcome of that.

        ``rows_of`` takes the row count for the log from what ``action`` returns.
        """
        result, self.execution_time_ms = self._session._logged(
            QUERY, self._sql, self._view_name, lambda: action(self.df), rows_of
        )
        return result

    def rows(self) -> list[dict]:
        """Run the statement and log it: at most ``limit`` encoded row objects, in memory.

        Only a result with a limit can be held; ``query_stream`` pages others and ``df`` leaves them
        on the cluster.
        """
        if self._limit is None:
            raise ValueError("rows() holds the result in memory, so give query() a limit; or use query_stream or df")

        def collect() -> list[dict]:
            lines = cap(row_json(self._whole, self._session.dialect), self._limit)
            return [json.loads(line[0]) for line in lines.collect()]

        rows, self.execution_time_ms = self._session._logged(
            QUERY, self._sql, self._view_name, collect, len
        )
        return rows


class Session:
    """SQL over one Spark session, or in ``database`` where one is given.

    Each statement is logged once, when it has ended, with its outcome. ``close`` writes what the log
    still holds; a session is also a context manager.
    """

    def __init__(
        self,
        spark: SparkSession,
        log_path: str,
        dialect: str | None = None,
        database: Database | None = None,
    ):
        self.spark = spark
        self.database = database
        self.dialect = dialect or (database.dialect if database else EMBEDDED)
        self.log = StatementLog(spark, log_path)

    def __enter__(self) -> Session:
        return self

    def __exit__(self, *failure) -> None:
        self.close()

    def close(self) -> None:
        self.log.flush()

    def info(self) -> SessionInfo:
        return self.log.info()

    def _logged(self, operation: str, sql: str, view_name: str | None, work, rows_of):
        timer = Timer()
        try:
            result = work()
        except Exception as error:
            self.log.append(operation, sql, view_name, error=str(error), duration_ms=timer.ms)
            raise
        self.log.append(operation, sql, view_name, rows_of(result), duration_ms=timer.ms)
        return result, timer.ms

    def _frame(
        self, sql: str, limit: int | None = None, partition: Partitioning | None = None
    ) -> DataFrame:
        if self.database is None:
            return self.spark.sql(sql)
        return read_database(self.spark, self.database, sql, partition, limit)

    def _shared(self, partition: Partitioning | None) -> Partitioning | None:
        """Whole results of a database must be shared out, or one task would read them."""
        if self.database is not None and partition is None:
            raise ValueError("a whole result of a database needs partition=Partitioning(...)")
        return partition

    def _analysed(self, operation: str, sql: str, limit: int | None, view_name: str | None) -> DataFrame:
        timer = Timer()
        try:
            return self._frame(sql, limit)
        except Exception as error:
            self.log.append(operation, sql, view_name, error=str(error), duration_ms=timer.ms)
            raise

    def query(self, sql: str, limit: int | None = None, view_name: str | None = None) -> QueryResult:
        """The result of a statement: whole and lazy, or its first ``limit`` rows."""
        rows = row_cap(limit)
        df = self._analysed(QUERY, sql, rows, view_name)
        return QueryResult(self, sql, df, rows, view_name)

    def query_stream(
        self,
        sql: str,
        batch_size: int | None = None,
        limit: int | None = None,
        view_name: str | None = None,
    ) -> Iterator[QueryBatch]:
        """The whole result in chunks of ``batch_size`` rows (200 unless given), the last one shorter.

        The encoded rows are stored once in the shared folder and read back page by page, so neither
        a task nor the driver holds more than ``PAGE_CHUNKS`` chunks. An empty result yields one
        chunk, which carries the columns.
        """
        most = row_cap(limit)
        df = self._analysed(QUERY_STREAM, sql, most, view_name)
        return self._chunks(cap(df, most), sql, chunk_size(batch_size), view_name)

    def _chunks(
        self, df: DataFrame, sql: str, size: int, view_name: str | None
    ) -> Iterator[QueryBatch]:
        meta, rows, sent, timer = columns(df), [], 0, Timer()
        try:
            for line in page_rows(row_json(df, self.dialect), size * PAGE_CHUNKS):
                rows.append(json.loads(line[0]))
                if len(rows) == size:
                    sent += size
                    yield QueryBatch(meta, rows)
                    rows = []
            if rows or not sent:
                sent += len(rows)
                yield QueryBatch(meta, rows)
        except GeneratorExit:  # the reader has seen enough
            self.log.append(QUERY_STREAM, sql, view_name, sent, duration_ms=timer.ms)
            raise
        except Exception as error:
            self.log.append(QUERY_STREAM, sql, view_name, error=str(error), duration_ms=timer.ms)
            raise
        self.log.append(QUERY_STREAM, sql, view_name, sent, duration_ms=timer.ms)

    def batches(
        self,
        sql: str,
        batch_size: int | None = None,
        limit: int | None = None,
        order: list[str] | None = None,
        view_name: str | None = None,
        partition: Partitioning | None = None,
        unique: bool = False,
    ) -> DataFrame:
        """The same chunks as a frame with ``batch_id``, for jobs that work on them in parallel.

        ``unique`` says that ``order`` is a key, which spares a sort.
        """

        def work() -> DataFrame:
            return with_batch_id(self._frame(sql, None, self._shared(partition)), batch_size, order, limit, unique)

        return self._logged(QUERY_STREAM, sql, view_name, work, lambda df: None)[0]

    def save(
        self,
        sql: str,
        file_type: str,
        path: str,
        mode: str | None = None,
        view_name: str | None = None,
        typing: str = DECLARED,
        partition: Partitioning | None = None,
    ) -> SaveResult:
        """Export a whole result, without a row cap; ``partition`` shares out a database's rows."""

        def work() -> SaveResult:
            df = self._frame(sql, None, self._shared(partition))
            return write_dataset(df, file_type, path, mode, self.dialect, typing)

        return self._logged(SAVE, sql, view_name, work, lambda saved: saved.row_count)[0]

    def save_stream(
        self,
        df: DataFrame,
        file_type: str,
        path: str,
        checkpoint: str,
        mode: str | None = None,
        view_name: str | None = None,
        header: bool = False,
        typing: str = DECLARED,
    ) -> SaveResult:
        """Export a streaming frame until its input is used up."""

        def work() -> SaveResult:
            return save_stream(df, file_type, path, checkpoint, mode, self.dialect, header=header, typing=typing)

        label = f"stream into {path}"
        return self._logged(SAVE, label, view_name, work, lambda saved: saved.row_count)[0]

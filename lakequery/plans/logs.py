"""Session documents as data. Events stand in for statements, fifty of them to a session."""

from __future__ import annotations

from contextlib import suppress

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakequery.log_compaction import live_files
from lakequery.operators.numbering import with_batch_id
from lakequery.plans.registry import plan, table, views
from lakequery.session import Session
from lakequery.statements import StatementLog, named_views, read_sessions, session_summary, time_text
from lakequery.storage import scratch_dir

_STATEMENTS = """
    SELECT row_ord, concat('s', batch_id) AS session_id,
           CASE WHEN event_type IN ('view', 'click') THEN concat(' ', event_type, ' ') ELSE ' ' END
             AS view_name,
           CASE event_type WHEN 'view' THEN 'queryStream' WHEN 'purchase' THEN 'save' ELSE 'query' END
             AS operation,
           CASE WHEN event_type != 'error' THEN CAST(event_id AS BIGINT) END AS row_count,
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
           CASE WHEN event_type = 'error' THEN props END AS error,
           props AS sql, date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'") AS created_at
    FROM statement_events
"""


def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write the documents and read them back. Row numbers bound each one to 50 statements."""
    events = table(spark, sf_dir, "events")
    with_batch_id(events, 50, ["event_id"]).createOrReplaceTempView("statement_events")
    fields = ["view_name", "operation", "sql", "created_at", "row_count", "status", "error"]
    statements = spark.sql(_STATEMENTS).groupBy("session_id").agg(
        F.min("created_at").alias("created_at"),
        F.max("created_at").alias("updated_at"),
        F.array_sort(F.collect_list(F.struct("row_ord", *fields))).alias("views"),
    )
    path = scratch_dir(spark, "sessions")
    statements.write.json(path)
    return read_sessions(spark, path, multi_line=False)


_NUMBERED = """
    SELECT 's' || (place // 50) AS session_id, place % 50 AS position, event_type, event_id, ts
    FROM (SELECT *, row_number() OVER (ORDER BY event_id) - 1 AS place FROM events)
"""


@plan(
    f"""
    SELECT session_id, CAST(position AS INTEGER) AS position,
           CASE event_type WHEN 'view' THEN 'queryStream' WHEN 'purchase' THEN 'save' ELSE 'query' END
             AS operation,
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
           coalesce(CASE WHEN event_type != 'error' THEN event_id END, -1) AS row_count,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS created_at
    FROM ({_NUMBERED})
    """
)
def session_flatten(spark, sf_dir):
    statements = _sessions(spark, sf_dir)
    return statements.select(
        "session_id",
        "position",
        "operation",
        "status",
        F.coalesce("row_count", F.lit(-1)).alias("row_count"),
        time_text(F.col("created_at"), spark.conf.get("spark.sql.session.timeZone")).alias("created_at"),
    )


@plan(
    f"""
    SELECT session_id,
           CASE event_type WHEN 'view' THEN 'queryStream' WHEN 'purchase' THEN 'save' ELSE 'query' END
             AS operation,
           CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status,
           count(*) AS statements,
           CAST(coalesce(sum(CASE WHEN event_type != 'error' THEN event_id END), 0) AS BIGINT) AS total_rows
    FROM ({_NUMBERED}) GROUP BY ALL
    """,
    name="session_summary",
)
def statement_counts(spark, sf_dir):
    return session_summary(_sessions(spark, sf_dir))


@plan(
    f"""
    SELECT session_id, CAST(position AS INTEGER) AS position,
           CASE WHEN event_type IN ('view', 'click') THEN event_type
                ELSE 'view_' || count(CASE WHEN event_type NOT IN ('view', 'click') THEN 1 END)
                       OVER (PARTITION BY session_id ORDER BY position) END AS view_name
    FROM ({_NUMBERED})
    """
)
def session_view_names(spark, sf_dir):
    return named_views(_sessions(spark, sf_dir)).select("session_id", "position", "view_name")


def _written(df: DataFrame) -> int:
    """Run the frame on the executors and give the rows that Spark counted meanwhile."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("append").save()
    return seen.get["rows"]


@plan(
    """
    SELECT c_nationkey AS nation, 'query' AS operation, 'success' AS status, count(*) AS row_count
    FROM customer GROUP BY c_nationkey
    UNION ALL SELECT DISTINCT c_nationkey, 'query', 'error', -1 FROM customer
    """
)
def statement_log(spark, sf_dir):
    """A statement per nation that counts its customers, and one that fails; then the log itself."""
    views(spark, sf_dir, "customer")
    nations = [row[0] for row in table(spark, sf_dir, "nation").select("n_nationkey").collect()]
    session = Session(spark, scratch_dir(spark, "log"))
    for nation in nations:
        customers = f"SELECT c_custkey FROM customer WHERE c_nationkey = {nation}"
        if not spark.sql(customers).isEmpty():
            session.query(customers, view_name=f"good_{nation}").run(_written, rows_of=int)
            with suppress(PySparkException):
                failing = f"SELECT raise_error('none') FROM ({customers})"
                session.query(failing, view_name=f"bad_{nation}").run(_written, rows_of=int)
    named = F.regexp_extract("view_name", "_([0-9]+)$", 1).cast("int")
    return session.log.table().select(
        named.alias("nation"), "operation", "status", F.coalesce("row_count", F.lit(-1)).alias("row_count")
    )


@plan(
    """
    SELECT c_nationkey AS nation, count(*) AS row_count, 2 AS times, true AS bounded FROM customer GROUP BY c_nationkey
    """
)
def log_compaction(spark, sf_dir):
    """Sessions that each write files of their own, merged twice while others write on; no row is lost or doubled."""
    path = scratch_dir(spark, "log")
    counts = table(spark, sf_dir, "customer").groupBy("c_nationkey").count().collect()  # a row per nation
    for _ in range(2):
        for share in range(4):
            log = StatementLog(spark, path)
            for row in counts[share::4]:
                log.append("query", "SELECT ...", f"nation_{row['c_nationkey']}", row["count"])
            log.flush()
        StatementLog(spark, path).compact(most=1)
    rows = StatementLog(spark, path).table()
    bounded = live_files(spark, path) <= rows.select("log_date").distinct().count()
    nation = F.regexp_extract("view_name", "_([0-9]+)$", 1).cast("int").alias("nation")
    return rows.groupBy(nation).agg(
        F.max("row_count").alias("row_count"), F.count(F.lit(1)).cast("int").alias("times"), F.lit(bounded).alias("bounded")
    )

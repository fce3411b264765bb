"""Type inference and typed projection over JSON rows made from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakequery.operators.infer import BOOL, FLOAT64, INT64, UTF8, infer_types, project_typed
from lakequery.plans.registry import plan, table, views
from lakequery.sinks.dataset import INFERRED, write_dataset
from lakequery.storage import scratch_dir

# JSON rows whose keys mix classes: whole, half, flag, loose, empty, odd.
_MIXED = """
    SELECT event_id, event_type, concat(
      '{"whole":', event_id,
      ',"half":', event_id, CASE WHEN event_id % 2 = 1 THEN '.5' ELSE '' END,
      ',"flag":', CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END,
      ',"loose":', CASE WHEN event_type = 'error' THEN '"e"' ELSE CAST(user_id AS STRING) END,
      ',"odd":', CASE WHEN event_id % 3 = 0 THEN 'true' WHEN event_id % 3 = 1 THEN '7' ELSE 'null' END,
      ',"empty":null}') AS row
    FROM events
"""


@plan(
    """
    SELECT 'k' AS column_name, CASE
      WHEN bool_and(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT')) THEN 'Int64'
      WHEN bool_and(json_type(props, '$.k') IN ('UBIGINT', 'BIGINT', 'DOUBLE')) THEN 'Float64'
      WHEN bool_and(json_type(props, '$.k') = 'BOOLEAN') THEN 'Bool' ELSE 'Utf8' END AS column_type
    FROM events
    """
)
def infer_props(spark, sf_dir):
    return infer_types(table(spark, sf_dir, "events"), "props", ord_col="event_id")


@plan(
    """
    SELECT 'whole' AS column_name, 'Int64' AS column_type
    UNION ALL SELECT 'half', CASE WHEN bool_or(event_id % 2 = 1) THEN 'Float64' ELSE 'Int64' END FROM events
    UNION ALL SELECT 'flag', 'Bool'
    UNION ALL SELECT 'loose', CASE WHEN bool_or(event_type = 'error') THEN 'Utf8' ELSE 'Int64' END FROM events
    UNION ALL SELECT 'odd', CASE WHEN bool_or(event_id % 3 = 0) AND bool_or(event_id % 3 = 1) THEN 'Utf8'
        WHEN bool_or(event_id % 3 = 0) THEN 'Bool' ELSE 'Int64' END FROM events
    UNION ALL SELECT 'empty', 'Utf8'
    """
)
def infer_mixed(spark, sf_dir):
    views(spark, sf_dir, "events")
    return infer_types(spark.sql(_MIXED), "row", ord_col="event_id")


@plan(
    """
    SELECT event_type, count(*) AS n, count(CASE WHEN event_id % 2 = 0 THEN 1 END) AS whole_halves,
           max(CASE WHEN event_id % 2 = 1 THEN event_id + 0.5 ELSE event_id END)::DOUBLE AS top_half,
           count(CASE WHEN user_id % 2 = 0 THEN 1 END) AS true_flags,
           CASE WHEN event_type = 'error' THEN 0 ELSE count(*) END AS loose_numbers,
           sum(CASE WHEN event_type = 'error' THEN 1 ELSE length(user_id::VARCHAR) END)::BIGINT
             AS loose_chars,
           count(CASE WHEN event_id % 3 = 0 THEN 1 END) AS odd_flags
    FROM events GROUP BY event_type
    """,
    name="project_typed",
)
def typed_rows(spark, sf_dir):
    """Each key read under a type that only some of its values have."""
    views(spark, sf_dir, "events")
    rows = spark.sql(_MIXED).withColumn("again", F.col("row"))
    first = project_typed(rows, "row", {"half": INT64, "flag": BOOL, "loose": UTF8, "odd": BOOL})
    renamed = first.withColumnsRenamed({"half": "whole_half", "loose": "loose_text"})
    both = project_typed(renamed, "again", {"half": FLOAT64, "loose": INT64})
    return both.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("whole_half").alias("whole_halves"),
        F.max("half").alias("top_half"),
        F.count_if("flag").alias("true_flags"),
        F.count("loose").alias("loose_numbers"),
        F.sum(F.length("loose_text")).alias("loose_chars"),
        F.count("odd").alias("odd_flags"),
    )


@plan(
    """
    SELECT count(*) AS n, count(*) AS kept,
           max(CASE WHEN event_id < 500 THEN event_id ELSE event_id + 0.5 END)::DOUBLE AS last_kept,
           CASE WHEN max(event_id) < 500 THEN 'bigint' ELSE 'double' END AS column_type
    FROM events
    """
)
def infer_whole_export(spark, sf_dir):
    """The first rows look whole; the fractions further down are kept all the same."""
    views(spark, sf_dir, "events")
    rows = spark.sql(
        "SELECT parse_json(CASE WHEN event_id < 500 THEN CAST(event_id AS STRING)"
        " ELSE concat(event_id, '.5') END) AS v FROM events ORDER BY event_id"
    )
    path = scratch_dir(spark, "inferred")
    write_dataset(rows, "parquet", path, typing=INFERRED)
    saved = spark.read.parquet(path)
    return saved.agg(
        F.count(F.lit(1)).alias("n"),
        F.count("v").alias("kept"),
        F.max("v").cast("double").alias("last_kept"),
        F.max(F.typeof("v")).alias("column_type"),
    )

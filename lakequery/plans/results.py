"""Capped and chunked results, and SQL passed through to Spark."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakequery.operators.capped import query
from lakequery.operators.numbering import store_in_order, with_batch_id
from lakequery.plans.registry import plan, table, views

LINEITEM_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


@plan(
    """
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
    FROM orders ORDER BY o_orderkey LIMIT 1000
    """
)
def limited_query(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return query(
        spark,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority "
        "FROM orders ORDER BY o_orderkey",
        limit=1000,
    )


@plan(
    """
    WITH numbered AS (
      SELECT l_orderkey, (row_number() OVER (
        ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 200 AS batch_id
      FROM lineitem)
    SELECT batch_id, count(*) AS row_count, min(l_orderkey) AS first_orderkey,
           max(l_orderkey) AS last_orderkey
    FROM numbered GROUP BY batch_id
    """
)
def batch_summary(spark, sf_dir):
    keys = table(spark, sf_dir, "lineitem").select(*LINEITEM_KEY)
    return (
        with_batch_id(keys, 200, LINEITEM_KEY)
        .groupBy("batch_id")
        .agg(
            F.count(F.lit(1)).alias("row_count"),
            F.min("l_orderkey").alias("first_orderkey"),
            F.max("l_orderkey").alias("last_orderkey"),
        )
    )


@plan(
    """
    SELECT o_orderkey, row_ord, row_ord // 200 AS batch_id FROM (
      SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) - 1 AS row_ord
      FROM orders)
    WHERE row_ord < 1000
    """
)
def batch_capped(spark, sf_dir):
    views(spark, sf_dir, "orders")
    top = spark.sql("SELECT o_orderkey FROM orders ORDER BY o_totalprice DESC, o_orderkey")
    return with_batch_id(top, limit=1000)


@plan(
    """
    SELECT event_type, rank_value, count(*) AS n FROM (
      SELECT event_type, row_number() OVER (ORDER BY event_type, event_id) - 1 AS rank_value
      FROM events)
    GROUP BY event_type, rank_value
    """
)
def number_duplicates(spark, sf_dir):
    """Five keys share all rows, so sorting by key alone would leave five tasks busy."""
    kinds = table(spark, sf_dir, "events").select("event_type")
    numbered = with_batch_id(kinds, 1, ["event_type"])
    return numbered.groupBy("event_type", F.col("batch_id").alias("rank_value")).agg(
        F.count(F.lit(1)).alias("n")
    )


@plan(
    """
    SELECT (row_number() OVER (ORDER BY event_id) - 1) // 333 AS batch_id, event_id FROM events
    """
)
def batch_tail(spark, sf_dir):
    """A chunk size that leaves a short last chunk, over a key."""
    events = table(spark, sf_dir, "events").select("event_id")
    return with_batch_id(events, 333, ["event_id"], unique=True).select("batch_id", "event_id")


@plan(
    """
    WITH numbered AS (
      SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
        row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1 AS row_ord FROM lineitem)
    SELECT row_ord // 333 AS page, l_orderkey, l_linenumber, row_ord FROM numbered
    WHERE row_ord // 333 IN (0, 7, 12, (SELECT (count(*) - 1) // 333 FROM lineitem))
    """
)
def page_lookup(spark, sf_dir):
    """Single pages of a result in order, the last one short; each opens the files that hold it."""
    result = store_in_order(table(spark, sf_dir, "lineitem").select(*LINEITEM_KEY), LINEITEM_KEY)
    found = [
        result.rows(333 * page, 333).withColumn("page", F.lit(page).cast("long"))
        for page in sorted({0, 7, 12, (result.total - 1) // 333})
    ]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every.select("page", "l_orderkey", "l_linenumber", "row_ord")


def sql_plan(name: str, tables: list[str], sql: str, oracle: str | None = None) -> None:
    """Register SQL that runs unchanged, whole, through Spark."""

    def run(spark, sf_dir):
        views(spark, sf_dir, *tables)
        return query(spark, sql)

    plan(oracle or sql, name)(run)


sql_plan(
    "sql_values",
    ["orders"],
    """
    SELECT s.label, count(*) AS n
    FROM orders JOIN (VALUES ('F', 'filled'), ('O', 'open'), ('P', 'partial')) AS s(status, label)
      ON o_orderstatus = s.status
    GROUP BY s.label
    """,
)
sql_plan(
    "sql_union_all",
    ["orders", "lineitem"],
    """
    SELECT source, code, count(*) AS n FROM (
      SELECT 'orders' AS source, o_orderstatus AS code FROM orders
      UNION ALL
      SELECT 'lineitem' AS source, l_linestatus AS code FROM lineitem) AS codes
    GROUP BY source, code
    """,
)
sql_plan(
    "sql_range",
    ["lineitem"],
    """
    SELECT step, count(*) AS n
    FROM lineitem LATERAL VIEW explode(sequence(1, l_linenumber)) AS step
    GROUP BY step
    """,
    """
    SELECT step, count(*) AS n
    FROM (SELECT unnest(range(1, l_linenumber + 1))::INTEGER AS step FROM lineitem)
    GROUP BY step
    """,
)
sql_plan(
    "sql_filter_sort",
    ["orders"],
    """
    SELECT o_orderkey, o_orderpriority, o_totalprice
    FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000
    ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS FIRST LIMIT 100
    """,
)
sql_plan(
    "sql_join_agg",
    ["nation", "customer", "orders"],
    """
    SELECT n_name, sum(placed) AS orders_placed, sum(spent) AS cents
    FROM (
      SELECT o_custkey, count(*) AS placed, sum(CAST(o_totalprice * 100 + 0.5 AS BIGINT)) AS spent
      FROM orders GROUP BY o_custkey) AS per_customer
    JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
    """
    SELECT n_name, count(*) AS orders_placed,
           CAST(sum(CAST(floor(o_totalprice * 100 + 0.5) AS BIGINT)) AS BIGINT) AS cents
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name
    """,
)
sql_plan(
    "sql_window",
    ["orders"],
    """
    SELECT o_custkey, o_orderkey, CAST(r AS BIGINT) AS place FROM (
      SELECT o_custkey, o_orderkey,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS r
      FROM orders) AS ranked
    WHERE r <= 3
    """,
)
sql_plan(
    "sql_setops",
    ["customer", "orders", "supplier"],
    """
    SELECT 'never ordered' AS kind, c_custkey AS key FROM (
      SELECT c_custkey FROM customer EXCEPT SELECT DISTINCT o_custkey FROM orders) AS idle
    UNION ALL
    SELECT 'shared key' AS kind, c_custkey AS key FROM (
      SELECT c_custkey FROM customer INTERSECT SELECT DISTINCT s_suppkey FROM supplier) AS shared
    """,
)
sql_plan(
    "sql_rollup",
    ["lineitem"],
    """
    SELECT coalesce(l_returnflag, 'all') AS returnflag, coalesce(l_linestatus, 'all') AS linestatus,
           count(*) AS n, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
    FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
    """,
)

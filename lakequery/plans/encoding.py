"""Encoders over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakequery.functions.encode import EMBEDDED, JSON, MYSQL, NATIVE_TYPE, POSTGRES, encode, row_json, stringify
from lakequery.plans.registry import plan, table, views


@plan(
    """
    SELECT event_id, 'timestamp(Microsecond, ' || epoch_us(ts) || ')' AS ts FROM events
    """
)
def encode_embedded_ts(spark, sf_dir):
    return encode(table(spark, sf_dir, "events").select("event_id", "ts"))


@plan(
    """
    SELECT o_orderkey, 'date32:' || date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE))
             AS o_orderdate
    FROM orders
    """
)
def encode_embedded_date(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return encode(
        spark.sql("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders")
    )


@plan(
    """
    SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice
    FROM orders
    """
)
def encode_decimal(spark, sf_dir):
    views(spark, sf_dir, "orders")
    return encode(
        spark.sql("SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice FROM orders")
    )


@plan("SELECT doc_id, '0x' || lower(hex(text)) AS text FROM documents")
def encode_blob(spark, sf_dir):
    views(spark, sf_dir, "documents")
    return encode(spark.sql("SELECT doc_id, CAST(text AS BINARY) AS text FROM documents"))


@plan("SELECT event_type AS key, event_id AS value FROM events")
def encode_map(spark, sf_dir):
    views(spark, sf_dir, "events")
    maps = encode(spark.sql("SELECT map(event_type, event_id) AS m FROM events"))
    return maps.select(F.inline("m"))


@plan(
    """
    SELECT label, count(*) AS n, min(v) AS least, max(v) AS greatest
    FROM (SELECT label, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
    GROUP BY label
    """
)
def encode_list(spark, sf_dir):
    lists = encode(table(spark, sf_dir, "embeddings").select("label", "embedding"))
    values = lists.select("label", F.explode("embedding").alias("v"))
    return values.groupBy("label").agg(
        F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("greatest")
    )


@plan(
    """
    SELECT c_custkey, c_name AS name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
           '0x' || lower(hex(c_mktsegment)) AS segment
    FROM customer
    """
)
def encode_struct(spark, sf_dir):
    views(spark, sf_dir, "customer")
    nested = encode(
        spark.sql(
            "SELECT c_custkey, named_struct('name', c_name, 'balance', CAST(c_acctbal AS DECIMAL(12,2)),"
            " 'segment', CAST(c_mktsegment AS BINARY)) AS s FROM customer"
        )
    )
    return nested.select("c_custkey", "s.*")


@plan(
    """
    WITH gaps AS (SELECT event_id, epoch_us(ts) - (SELECT min(epoch_us(ts)) FROM events) AS us FROM events)
    SELECT event_id, 0 AS months, CAST(us // 86400000000 AS INTEGER) AS days,
           (us % 86400000000) * 1000 AS nanos
    FROM gaps
    """
)
def encode_interval(spark, sf_dir):
    views(spark, sf_dir, "events")
    gaps = encode(
        spark.sql("SELECT event_id, ts - (SELECT min(ts) FROM events) AS gap FROM events")
    )
    return gaps.select("event_id", "gap.*")


_FRACTION = """
    CASE WHEN epoch_us({c}) % 1000000 = 0 THEN ''
         WHEN epoch_us({c}) % 1000 = 0
           THEN '.' || lpad(CAST(epoch_us({c}) % 1000000 // 1000 AS VARCHAR), 3, '0')
         ELSE '.' || lpad(CAST(epoch_us({c}) % 1000000 AS VARCHAR), 6, '0') END"""


def _date_time(column: str, separator: str = " ") -> str:
    return f"strftime({column}, '%Y-%m-%d{separator}%H:%M:%S') || {_FRACTION.format(c=column)}"


@plan(
    f"""
    WITH cut AS (SELECT event_id, ts, date_trunc('millisecond', ts) AS ms,
                        date_trunc('second', ts) AS sec FROM events)
    SELECT event_id, {_date_time("ts")} AS ts, {_date_time("ms")} AS ms, {_date_time("sec")} AS sec
    FROM cut
    """
)
def encode_relational_ts(spark, sf_dir):
    views(spark, sf_dir, "events")
    cut = spark.sql(
        "SELECT event_id, ts, CAST(date_trunc('MILLISECOND', ts) AS TIMESTAMP_NTZ) AS ms,"
        " CAST(date_trunc('SECOND', ts) AS TIMESTAMP_NTZ) AS sec FROM events"
    )
    return encode(cut, MYSQL)


@plan(f"SELECT event_id, {_date_time('ts', 'T')} || '+00:00' AS ts FROM events")
def encode_zoned_ts(spark, sf_dir):
    views(spark, sf_dir, "events")
    zoned = spark.sql("SELECT event_id, to_timestamp_ltz(concat(CAST(ts AS STRING), 'Z')) AS ts FROM events")
    return encode(zoned, POSTGRES)


@plan(
    """
    SELECT event_type, CASE event_type WHEN 'error' THEN 'NaN' WHEN 'click' THEN 'inf'
             WHEN 'view' THEN '-inf' ELSE 'number' END AS spelled, count(*) AS n
    FROM events GROUP BY ALL
    """
)
def encode_nonfinite(spark, sf_dir):
    views(spark, sf_dir, "events")
    rows = spark.sql(
        "SELECT event_type, CASE event_type WHEN 'error' THEN CAST('NaN' AS DOUBLE)"
        " WHEN 'click' THEN CAST('Infinity' AS DOUBLE) WHEN 'view' THEN CAST('-Infinity' AS DOUBLE)"
        " ELSE value END AS v FROM events"
    )
    read = row_json(rows).select(F.from_json("row", "event_type string, v variant").alias("r"))
    is_text = F.schema_of_variant("r.v") == "STRING"
    spelled = F.when(is_text, F.col("r.v").cast("string")).otherwise("number").alias("spelled")
    return read.groupBy(F.col("r.event_type"), spelled).agg(F.count(F.lit(1)).alias("n"))


@plan("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def row_json_fields(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return row_json(customer).select(F.from_json("row", customer.schema).alias("r")).select("r.*")


@plan("SELECT c_custkey, c_mktsegment AS label FROM customer")
def row_json_last_wins(spark, sf_dir):
    views(spark, sf_dir, "customer")
    twice = spark.sql("SELECT c_custkey, c_name AS label, c_mktsegment AS label FROM customer")
    return row_json(twice).select(F.from_json("row", "c_custkey long, label string").alias("r")).select("r.*")


@plan(
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id, props,
           CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS event_type,
           CASE WHEN user_id % 2 = 0 THEN 'true' ELSE 'false' END AS even_user,
           '[' || user_id || ',' || event_id || ']' AS ids
    FROM events
    """
)
def cell_text(spark, sf_dir):
    views(spark, sf_dir, "events")
    rows = spark.sql(
        "SELECT event_id, props, nullif(event_type, 'error') AS event_type,"
        " user_id % 2 = 0 AS even_user, array(user_id, event_id) AS ids FROM events"
    )
    return stringify(rows, EMBEDDED)


@plan(
    """
    SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
           '0x' || lower(hex(c_name)) AS name, CAST(DATE '2020-01-01' + c_nationkey AS VARCHAR) AS day,
           '<unsupported:array<string>>' AS tags
    FROM customer
    """
)
def encode_mysql_types(spark, sf_dir):
    views(spark, sf_dir, "customer")
    return encode(spark.sql(_CUSTOMER_TYPES), MYSQL)


@plan(
    """
    SELECT c_custkey, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS balance,
           '0x' || lower(hex(c_name)) AS name, CAST(DATE '2020-01-01' + c_nationkey AS VARCHAR) AS day,
           '<unsupported:array<string>>' AS tags
    FROM customer
    """
)
def encode_postgres_types(spark, sf_dir):
    views(spark, sf_dir, "customer")
    return encode(spark.sql(_CUSTOMER_TYPES), POSTGRES)


_CUSTOMER_TYPES = """
    SELECT c_custkey, CAST(c_acctbal AS DECIMAL(12,2)) AS balance, CAST(c_name AS BINARY) AS name,
           date_add(DATE'2020-01-01', c_nationkey) AS day, array(c_mktsegment) AS tags
    FROM customer
"""


@plan("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def encode_passthrough(spark, sf_dir):
    return encode(table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderpriority"), JSON)


_UNION_MEMBERS = """
    SELECT event_id, CASE event_type
      WHEN 'click' THEN CAST(ts AS VARIANT)
      WHEN 'view' THEN CAST(CAST(ts AS DATE) AS VARIANT)
      WHEN 'error' THEN CAST(CAST(event_id AS DECIMAL(12,2)) + 0.25BD AS VARIANT)
      WHEN 'purchase' THEN to_variant_object(named_struct(
        'bytes', CAST(props AS BINARY), 'days', array(CAST(ts AS DATE), NULL), 'id', event_id,
        'inner', named_struct('at', ts, 'price', CAST(user_id AS DECIMAL(9,1)) + 0.5BD, 'single', CAST(user_id + 0.5 AS FLOAT))))
      ELSE CAST(event_type AS VARIANT) END AS member
    FROM events
"""


@plan(
    """
    WITH forms AS (
      SELECT *, 'timestamp(Microsecond, ' || epoch_us(ts) || ')' AS moment,
        'date32:' || date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day_text
      FROM events
    )
    SELECT event_id, CASE event_type
      WHEN 'click' THEN moment WHEN 'view' THEN day_text WHEN 'error' THEN event_id || '.25'
      WHEN 'purchase' THEN '{"bytes":"0x' || lower(hex(props)) || '","days":["' || day_text || '",null],"id":' || event_id
        || ',"inner":{"at":"' || moment || '","price":"' || user_id || '.5","single":' || user_id || '.5}}'
      ELSE event_type END AS member
    FROM forms
    """
)
def encode_variant(spark, sf_dir):
    """Unions of dates, times, decimals, bytes, text, and lists and objects of them."""
    views(spark, sf_dir, "events")
    rows = spark.sql(_UNION_MEMBERS)
    unions = rows.select("event_id", F.col("member").alias("member", metadata={NATIVE_TYPE: "union"}))
    return stringify(unions).withColumn("event_id", F.col("event_id").cast("long"))

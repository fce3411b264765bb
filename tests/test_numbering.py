from pyspark.sql import functions as F

from lakequery.operators.numbering import first_rows, number_rows, page_rows, spread_sort, store_in_order, with_batch_id


def test_numbers_are_dense_and_follow_the_order(spark):
    df = spark.range(0, 10_000, 1, 7).select((F.col("id") * 7919 % 10_007).alias("k"))
    rows = number_rows(df, ["k"]).collect()
    assert sorted(r["row_ord"] for r in rows) == list(range(10_000))
    keys = [r["k"] for r in sorted(rows, key=lambda r: r["row_ord"])]
    assert keys == sorted(keys)


def test_own_order_is_kept_without_a_shuffle(spark):
    df = spark.sql("SELECT id FROM range(0, 3000, 1, 6) ORDER BY id DESC")
    rows = number_rows(df).collect()
    assert all(r["id"] == 2999 - r["row_ord"] for r in rows)


def test_copies_of_one_row_are_spread_over_partitions(spark):
    """A third of all rows are the same row; no partition may hold them all."""
    df = spark.range(0, 30_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    parts = spread_sort(df, ["k"]).groupBy(F.spark_partition_id().alias("p"), "k").count()
    copies = [r["count"] for r in parts.where("k = -1").collect()]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sum(copies) == 10_000 and len(copies) > 1 and max(copies) < 9_000
    rows = number_rows(df, ["k"]).agg(F.count("*"), F.countDistinct("row_ord"), F.max("row_ord")).first()
    assert tuple(rows) == (30_000, 30_000, 29_999)


def test_ties_are_ordered_by_content(spark):
    left = spark.range(0, 500, 1, 3).select((F.col("id") % 5).alias("k"), "id")
    right = spark.range(499, -1, -1, 5).select((F.col("id") % 5).alias("k"), "id")
    assert {tuple(r) for r in number_rows(left, ["k"]).collect()} == {
        tuple(r) for r in number_rows(right, ["k"]).collect()
    }


def test_maps_and_variants_can_be_carried(spark):
    df = spark.sql("SELECT id, map('a', id) AS m, parse_json('[1]') AS v FROM range(50)")
    assert number_rows(df, ["id"]).where("m['a'] = row_ord").count() == 50


def test_batch_cap(spark):
    df = with_batch_id(spark.range(10), 2, ["id"], limit=3)
    assert sorted(tuple(r) for r in df.collect()) == [(0, 0, 0), (1, 1, 0), (2, 2, 1)]
    assert with_batch_id(spark.range(10), 2, ["id"], limit=0).count() == 0


def test_empty_result(spark):
    df = with_batch_id(spark.range(0))
    assert df.columns == ["id", "row_ord", "batch_id"] and df.count() == 0


def test_numbering_does_not_use_an_unpartitioned_window(spark):
    plan = number_rows(spark.range(100), ["id"])._jdf.queryExecution().toString()
    assert "Window" not in plan and "SinglePartition" not in plan


def test_pages_open_only_their_files_and_shuffle_nothing(spark):
    df = spark.range(0, 5000, 1, 9).select((F.col("id") * 7919 % 10_007).alias("k"))
    want = sorted(r["k"] for r in df.collect())
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        result = store_in_order(df, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert result.total == 5000 and len(result.parts) > 2
    edge = result.parts[1].start
    for first, count in [(0, 1), (0, 5000), (edge - 3, 6), (edge, 10), (4990, 100), (4999, 1), (17, 4000)]:
        page = result.rows(first, count)
        got = {r["row_ord"]: r["k"] for r in page.collect()}
        assert got == {n: want[n] for n in range(first, min(first + count, 5000))}
        plan = page._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "_lq_place" in plan.split("PushedFilters", 1)[1].split("ReadSchema")[0]
    assert len(result.rows(0, 5).inputFiles()) == 1 and len(result.rows(edge - 1, 2).inputFiles()) == 2
    for first, count in [(5000, 10), (0, 0), (3, -1)]:
        assert result.rows(first, count).count() == 0


def test_rows_page_by_page(spark):
    df = spark.sql("SELECT id FROM range(0, 1000, 1, 5) ORDER BY id DESC")
    assert [r["id"] for r in page_rows(df, 64)] == list(range(999, -1, -1))
    assert list(page_rows(spark.range(0), 64)) == []


def test_a_small_limit_is_taken_while_reading(spark, tmp_path):
    """No more rows than asked for are sorted and stored; ties are those of the whole result."""
    path = str(tmp_path / "in")
    spark.range(0, 20_000, 1, 6).selectExpr("id % 50 AS k", "id", "id AS K2").write.parquet(path)
    df = spark.read.parquet(path)
    plan = first_rows(df, ["k"], 700)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    whole = {(r["id"], r["row_ord"]) for r in number_rows(df, ["k"]).where("row_ord < 700").collect()}
    few = with_batch_id(df, 100, ["k"], limit=700)
    assert {(r["id"], r["row_ord"]) for r in few.collect()} == whole
    assert few.columns == ["k", "id", "K2", "row_ord", "batch_id"]
    own = with_batch_id(df.orderBy(F.desc("id")), 100, limit=3)
    assert sorted((r["row_ord"], r["id"]) for r in own.collect()) == [(0, 19_999), (1, 19_998), (2, 19_997)]

import glob
import shutil

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from lakequery import Session
from lakequery.operators.capped import columns
from lakequery.sinks.dataset import write_dataset
from lakequery.sinks.formats import ExportError
from lakequery.storage import Storage
from lakequery.streaming.export import check_columns, save_stream
from lakequery.streaming.inferred import read_inferred


@pytest.fixture
def files(spark, tmp_path):
    """Four files of 250 rows."""
    path = str(tmp_path / "in")
    spark.range(0, 1000, 1, 4).withColumn("name", F.concat(F.lit("n,"), "id")).write.parquet(path)
    return path


def stream(spark, path, per_trigger=1):
    schema = "id long, name string"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


@pytest.mark.parametrize("name", ["csv", "xlsx", "json", "orc", "parquet"])
def test_export(spark, files, tmp_path, name):
    out = str(tmp_path / "out")
    saved = save_stream(stream(spark, files), name, out, str(tmp_path / "state"))
    assert (saved.file_type, saved.row_count) == ("excel" if name == "xlsx" else name, 1000)
    parts = glob.glob(f"{out}/part-*")
    assert len({p.rsplit("/part-", 1)[1][37:45] for p in parts}) == 4  # batches
    if name in ("json", "orc", "parquet"):
        read = spark.read.format(name).load(out)
        assert read.select("id").distinct().count() == 1000 == read.count()
        assert read.columns == ["id", "name"]


def test_resume_counts_each_batch_once(spark, files, tmp_path):
    """A batch fails after its rows were written; the rerun replaces them."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    bad = stream(spark, files).withColumn(
        "name", F.when(F.col("id") == 999, F.raise_error(F.lit("boom"))).otherwise(F.col("name"))
    )
    with pytest.raises(StreamingQueryException, match="boom"):
        save_stream(bad, "parquet", out, state)
    saved = save_stream(stream(spark, files), "parquet", out, state)
    read = spark.read.parquet(out)
    assert saved.row_count == 1000 == read.count() == read.select("id").distinct().count()
    spark.range(1000, 1100).withColumn("name", F.lit("late")).coalesce(1).write.mode("append").parquet(files)
    assert save_stream(stream(spark, files), "parquet", out, state).row_count == 1100


def test_replayed_batch_replaces_its_rows(spark, files, tmp_path):
    """Losing the commit mark makes Spark run the last batch again."""
    out, state = str(tmp_path / "out"), tmp_path / "state"
    save_stream(stream(spark, files), "csv", out, str(state))
    for mark in glob.glob(f"{state}/commits/3") + glob.glob(f"{state}/commits/.3.crc"):
        (state / "commits" / mark.rsplit("/", 1)[-1]).unlink()
    assert save_stream(stream(spark, files), "csv", out, str(state)).row_count == 1000
    assert spark.read.option("header", True).csv(out).count() == 1000


def test_empty_stream_keeps_columns(spark, tmp_path):
    (tmp_path / "in").mkdir()
    saved = save_stream(stream(spark, str(tmp_path / "in")), "parquet", str(tmp_path / "out"), str(tmp_path / "s"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert saved.row_count == 0 == read.count() and read.columns == ["id", "name"]


def test_modes(spark, files, tmp_path):
    out = str(tmp_path / "out")
    save_stream(stream(spark, files), "json", out, str(tmp_path / "s1"))
    save_stream(stream(spark, files), "json", out, str(tmp_path / "s2"), "append")
    assert spark.read.json(out).count() == 2000
    assert save_stream(stream(spark, files), "parquet", out, str(tmp_path / "s3")).row_count == 1000
    assert spark.read.parquet(out).count() == 1000
    with pytest.raises(ExportError, match="Append mode is not supported"):
        save_stream(stream(spark, files), "parquet", out, str(tmp_path / "s4"), "append")


def test_columns_must_agree(spark):
    first = columns(spark.sql("SELECT 1 AS a, 'x' AS b"))
    check_columns(first, first)
    check_columns(first, [])
    for other in ("SELECT 1 AS a", "SELECT 1 AS a, 2 AS b", "SELECT 1 AS a, 'x' AS c"):
        with pytest.raises(ExportError, match="Inconsistent columns"):
            check_columns(first, columns(spark.sql(other)))


def test_session_logs_the_stream(spark, files, tmp_path):
    session = Session(spark, str(tmp_path / "log"))
    session.save_stream(stream(spark, files), "csv", str(tmp_path / "out"), str(tmp_path / "s"), view_name="live")
    row = session.log.table().first()
    assert (row["view_name"], row["operation"], row["row_count"]) == ("live", "save", 1000)


def test_streams_and_exports_share_a_dataset(spark, files, tmp_path):
    """Checkpoints may have one name, and one may be made anew; no batch replaces another's."""
    out = str(tmp_path / "out")
    write_dataset(spark.sql("SELECT -1L AS id, 'first' AS name"), "json", out)
    for folder in ("a", "b"):
        saved = save_stream(stream(spark, files), "json", out, str(tmp_path / folder / "state"), "append")
        assert saved.row_count == 1000
    shutil.rmtree(tmp_path / "b")
    assert save_stream(stream(spark, files), "json", out, str(tmp_path / "b" / "state"), "append").row_count == 1000
    write_dataset(spark.sql("SELECT -2L AS id, 'last' AS name"), "json", out, "append")
    read = spark.read.json(out)
    assert read.count() == 3002 and read.where("id < 0").count() == 2
    assert read.columns == ["id", "name"]


def test_crash_while_files_are_moved(spark, files, tmp_path, monkeypatch):
    """Some files of a batch are in place when the driver dies; the rerun leaves no copy."""
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    whole = Storage.rename_all

    def dies(self, moves):
        whole(self, dict(list(moves.items())[:1]))
        raise RuntimeError("driver lost")

    monkeypatch.setattr(Storage, "rename_all", dies)
    with pytest.raises(StreamingQueryException, match="driver lost"):
        save_stream(stream(spark, files, 4), "parquet", out, state)
    monkeypatch.setattr(Storage, "rename_all", whole)
    assert save_stream(stream(spark, files, 4), "parquet", out, state).row_count == 1000
    read = spark.read.parquet(out)
    assert read.count() == 1000 == read.select("id").distinct().count()


def test_a_failed_overwrite_leaves_the_old_rows(spark, files, tmp_path):
    out = str(tmp_path / "out")
    save_stream(stream(spark, files), "parquet", out, str(tmp_path / "s1"))
    failing = stream(spark, files).where("raise_error('boom') IS NULL")
    with pytest.raises(Exception, match="boom"):
        save_stream(failing, "parquet", out, str(tmp_path / "s2"))
    assert spark.read.parquet(out).count() == 1000


@pytest.mark.parametrize("file_format", ["parquet", "orc", "csv"])
def test_a_foreign_file_fails_and_is_named(spark, tmp_path, file_format):
    """It lacks a declared column, so Spark alone would store nulls."""
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")

    def add(df):
        df.coalesce(1).write.mode("append").option("header", True).format(file_format).save(path)

    def read():
        reader = spark.readStream.schema("id long, n long").option("header", True).option("maxFilesPerTrigger", 1)
        return reader.format(file_format).load(path)

    for k in range(3):
        add(spark.range(10 * k, 10 * k + 10).withColumn("n", F.col("id") * 2))
    assert save_stream(read(), "parquet", out, state, header=True).row_count == 30
    known = set(glob.glob(f"{path}/part-*"))
    add(spark.range(30, 33).withColumnRenamed("id", "other").withColumn("n", F.lit(1).cast("long")))
    (foreign,) = set(glob.glob(f"{path}/part-*")) - known
    with pytest.raises(StreamingQueryException, match=f"(?s)Inconsistent columns.*{foreign.rsplit('/', 1)[-1]} has"):
        save_stream(read(), "parquet", out, state, header=True)
    assert spark.read.parquet(out).count() == 30
    with pytest.raises(StreamingQueryException, match="Inconsistent columns"):
        save_stream(read(), "json", str(tmp_path / "other"), str(tmp_path / "fresh"), header=True)


@pytest.mark.parametrize("change", ["CAST(id AS INT) AS id, n", "n, id", "id, n, 1 AS more"])
def test_types_and_order_of_columns_are_fixed_too(spark, tmp_path, change):
    path = str(tmp_path / "in")
    rows = spark.range(4).withColumn("n", F.lit(1))
    rows.coalesce(1).write.parquet(path)
    stream_of = spark.readStream.schema("id long, n int").parquet(path)
    save_stream(stream_of, "json", str(tmp_path / "out"), str(tmp_path / "state"))
    rows.selectExpr(*change.split(", ")).coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(StreamingQueryException, match="Inconsistent columns"):
        save_stream(stream_of, "json", str(tmp_path / "out"), str(tmp_path / "state"))


def test_files_are_checked_past_a_compacted_list(spark, tmp_path):
    """Spark folds its lists of files together every ten batches."""
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    spark.range(0, 24, 1, 24).write.parquet(path)
    read = spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)
    assert save_stream(read, "parquet", out, state).row_count == 24
    spark.range(1).withColumnRenamed("id", "it").coalesce(1).write.mode("append").parquet(path)
    with pytest.raises(StreamingQueryException, match="Inconsistent columns"):
        save_stream(read, "parquet", out, state)
    assert spark.read.parquet(out).count() == 24


def test_streams_without_files_have_nothing_to_check(spark, tmp_path):
    rate = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 10).load()
    assert save_stream(rate, "json", str(tmp_path / "out"), str(tmp_path / "state"), trigger={"once": True}).row_count == 10


def test_types_widen_as_batches_come(spark, tmp_path):
    """Every value of every batch is kept, and the types are those of the same rows as one batch."""
    path, out, state = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state")
    batches = [
        "1, null, true, 1, null",
        "2, 7, true, 9223372036854775808, null",
        "2.5, 8, 3, 3, null",
        "3, 'x', 4, 4, null",
    ]
    names = ["a", "b", "c", "d", "e"]
    for k, values in enumerate(batches):
        cells = [f"parse_json('{v}')" if v[0] != "'" else f"CAST({v} AS VARIANT)" for v in values.split(", ")]
        row = ", ".join(f"{cell} AS {name}" for cell, name in zip(cells, names))
        spark.sql(f"SELECT {k} AS k, {row}").coalesce(1).write.mode("append").parquet(path)
        read = spark.readStream.schema("k int, a variant, b variant, c variant, d variant, e variant").parquet(path)
        saved = save_stream(read, "parquet", out, state, typing="inferred")
        assert saved.row_count == k + 1
    df = read_inferred(spark, out, "parquet")
    assert [kind for _, kind in df.dtypes] == ["bigint", "double", "string", "string", "double", "string"]
    assert [tuple(r) for r in df.orderBy("k").collect()] == [
        (0, 1.0, None, "true", 1.0, None),
        (1, 2.0, "7", "true", 9223372036854775808.0, None),
        (2, 2.5, "8", "3", 3.0, None),
        (3, 3.0, "x", "4", 4.0, None),
    ]
    write_dataset(spark.read.parquet(path).orderBy("k"), "parquet", str(tmp_path / "whole"), typing="inferred")
    assert spark.read.parquet(str(tmp_path / "whole")).dtypes == df.dtypes
    with pytest.raises(ExportError, match="typing of a csv stream"):
        save_stream(read, "csv", str(tmp_path / "c"), str(tmp_path / "cs"), typing="inferred")
    with pytest.raises(ExportError, match="no export of a stream"):
        read_inferred(spark, path, "parquet")


def test_an_inferred_batch_that_runs_again_replaces_itself(spark, files, tmp_path):
    out, state = str(tmp_path / "out"), tmp_path / "state"
    save_stream(stream(spark, files), "orc", out, str(state), typing="inferred")
    for mark in glob.glob(f"{state}/commits/3") + glob.glob(f"{state}/commits/.3.crc"):
        (state / "commits" / mark.rsplit("/", 1)[-1]).unlink()
    assert save_stream(stream(spark, files), "orc", out, str(state), typing="inferred").row_count == 1000
    df = read_inferred(spark, out, "orc")
    assert df.dtypes == [("id", "bigint"), ("name", "string")]
    assert df.count() == 1000 == df.select("id").distinct().count()

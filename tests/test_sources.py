import gzip
import json
from datetime import date, datetime

import pytest
from pyspark.errors import PySparkException

from lakequery.operators.capped import cap, columns
from lakequery.sinks.dataset import write_dataset
from lakequery.sources.compact_json import CompactJsonError, read_compact_json, spark_type, stream_compact_json
from lakequery.sources.csv import register_csv
from lakequery.sources import jdbc
from lakequery.sources.jdbc import Database, Partitioning, bounds_sql, even_bounds, range_predicates, read_database
from lakequery.storage import scratch_dir
from lakequery.streaming.export import save_stream

TYPED = '["id","name","score"]\n["UInt64","String","Float64"]\n'
ROWS = '[31,"quay",4.5]\n[32,"pier",-7.0]\n[40,"dock",0.25]\n'


def write(path, text):
    path.write_text(text)
    return str(path)


def test_csv_view(spark, tmp_path):
    path = write(tmp_path / "p.csv", 'id,name,score\n31,quay,5\n32,"p\ni""er",-2\n')
    register_csv(spark, "csv_places", path)
    df = spark.sql("SELECT id, name, score FROM csv_places ORDER BY id")
    assert df.schema.simpleString() == "struct<id:int,name:string,score:int>"
    assert [tuple(r) for r in df.collect()] == [(31, "quay", 5), (32, 'p\ni"er', -2)]


def test_csv_schema_skips_detection(spark, tmp_path):
    path = write(tmp_path / "p.csv", "id,name\n1,7\n")
    assert tuple(register_csv(spark, "v", path, "id long, name string").first()) == (1, "7")


def test_compact_rows(spark, tmp_path):
    df = read_compact_json(spark, write(tmp_path / "a.txt", TYPED + ROWS))
    assert [tuple(c) for c in columns(df)] == [("id", "UInt64"), ("name", "String"), ("score", "Float64")]
    assert df.schema.simpleString() == "struct<id:decimal(20,0),name:string,score:double>"
    rows = cap(df, 2).collect()
    assert [(int(r["id"]), r["name"], r["score"]) for r in rows] == [(31, "quay", 4.5), (32, "pier", -7.0)]


def test_compact_header_without_rows(spark, tmp_path):
    df = read_compact_json(spark, write(tmp_path / "a.txt", '["id","name"]\n["UInt64","String"]\n'))
    assert df.columns == ["id", "name"] and df.count() == 0


def test_compact_empty_file_has_no_columns(spark, tmp_path):
    assert read_compact_json(spark, write(tmp_path / "a.txt", "")).columns == []


def test_compact_blank_lines_and_many_files(spark, tmp_path):
    for i in range(5):
        lines = [["id", "name"], ["Int64", "String"], [i, f"n{i}"], [i + 10, None]]
        write(tmp_path / f"{i}.txt", "\n  \n" + "\n\n".join(json.dumps(line) for line in lines))
    rows = read_compact_json(spark, str(tmp_path)).collect()
    assert sorted(r["id"] for r in rows) == [0, 1, 2, 3, 4, 10, 11, 12, 13, 14]


def test_compact_files_split_between_tasks(spark, tmp_path):
    path = tmp_path / "big.txt"
    write(path, TYPED + "".join(f'[{i},"n{i}",0.5]\n' for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32kb")
    try:
        df = read_compact_json(spark, str(path))
        assert df.rdd.getNumPartitions() > 4
        assert df.selectExpr("count(*)", "sum(id)", "sum(score)").first()[:2] == (20_000, 199_990_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_rows_that_look_like_headers_are_kept(spark, tmp_path):
    text = '["a","b"]\n["String","String"]\n["a","b"]\n["x","1"]\n["String","String"]\n'
    for name in ("p", "q"):
        write(tmp_path / name, text)
    rows = read_compact_json(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == sorted([("a", "b"), ("x", "1"), ("String", "String")] * 2)


def test_lookalike_rows_in_split_files(spark, tmp_path):
    head = ['["a"]', '["String"]']
    write(tmp_path / "p", "\n".join(head + head * 3000))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4kb")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        counts = {r["a"]: r["count"] for r in read_compact_json(spark, str(tmp_path)).groupBy("a").count().collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert counts == {"a": 3000, "String": 3000}


def test_compact_values_of_every_type(spark, tmp_path):
    names = ["i8", "u8", "u64", "f", "d", "day", "ts", "b", "l", "e", "big"]
    types = [
        "Int8", "UInt8", "Nullable(UInt64)", "Float32", "Decimal(10, 2)", "Date", "DateTime64(3, 'UTC')",
        "Bool", "Array(Nullable(Int32))", "Enum8('a' = 1)", "Int256",
    ]
    row = [-1, 255, "18446744073709551615", 1.5, 2.25, "2024-01-02", "2024-01-02 03:04:05.678", True,
           [1, None], "a", "99999999999999999999999999999999999999999"]
    bad = ["x", -1, None, "y", "z", "no day", 5, "maybe", "q", None, None]
    path = write(tmp_path / "a", "\n".join(json.dumps(line) for line in (names, types, row, bad)))
    good, nulls = read_compact_json(spark, path).orderBy("i8", ascending=False).collect()
    assert (good["i8"], good["u8"], int(good["u64"]), good["f"], str(good["d"])) == (
        -1, 255, 18446744073709551615, 1.5, "2.25",
    )
    assert (str(good["day"]), str(good["ts"])) == ("2024-01-02", "2024-01-02 03:04:05.678000")
    assert (good["b"], good["l"], good["e"], good["big"]) == (True, [1, None], "a", row[-1])
    assert [nulls[n] for n in ("i8", "u64", "f", "d", "day", "b", "e")] == [None] * 7


def test_type_names():
    assert [spark_type(t) for t in ("LowCardinality(Nullable(String))", "UUID", "UInt32", "Decimal(76, 3)")] == [
        "string", "string", "bigint", "string",
    ]


@pytest.mark.parametrize(
    "text, message",
    [
        ('["a","b"]\n["Int8"]\n', "names 2 columns and types 1"),
        ('["a","b"]\n', "ends before the line of column types"),
        ("not json\n[]\n", "column name line is not JSON"),
        ('["a"]\n{"a":1}\n', "column type line is not an array of strings"),
        ('["a"]\n[1]\n', "column type line is not an array of strings"),
    ],
)
def test_bad_headers(spark, tmp_path, text, message):
    with pytest.raises(CompactJsonError, match=message):
        read_compact_json(spark, write(tmp_path / "a", text))


@pytest.mark.parametrize(
    "line, message",
    [
        ('[1,"x"]', "expected 3 values, found 2"),
        ('[1,"x",2,3]', "found 4"),
        ('{"id":1}', "line is not one JSON array"),
        ("[1,2", "line is not one JSON array"),
        ('[1,"x",2] x', "line is not one JSON array"),
        ('[1,"x",2]]', "line is not one JSON array"),
        ('[1,"x",2]}', "line is not one JSON array"),
        ('[1,"x",2],[1]', "line is not one JSON array"),
        ("7", "line is not one JSON array"),
    ],
)
def test_bad_rows(spark, tmp_path, line, message):
    df = read_compact_json(spark, write(tmp_path / "a", TYPED + ROWS + line + "\n"))
    with pytest.raises(PySparkException, match=message):
        df.collect()


def test_different_headers_are_an_error(spark, tmp_path):
    write(tmp_path / "a", TYPED + ROWS)
    write(tmp_path / "b", '["id","name","rank"]\n["UInt64","String","Float64"]\n')
    with pytest.raises(CompactJsonError, match="different headers"):
        read_compact_json(spark, str(tmp_path))


def options(kind, **kwargs):
    return Database(kind, "db.host", "shop", "reader", "secret", **kwargs).options("SELECT 1 AS a;")


def test_mysql_family():
    for kind, port in (("mysql", 3306), ("doris", 9030), ("starrocks", 9030)):
        got = options(kind)
        assert got["url"] == f"jdbc:mysql://db.host:{port}/shop?characterEncoding=UTF-8&tinyInt1isBit=false"
        assert got["dbtable"] == "(SELECT 1 AS a) lakequery"
        assert (got["user"], got["password"]) == ("reader", "secret")
        assert Database(kind, "h").dialect == "mysql"


def test_postgres_family_and_search_path():
    for kind in ("postgres", "supabase"):
        assert options(kind, port=6543)["url"] == "jdbc:postgresql://db.host:6543/shop"
        assert "sessionInitStatement" not in options(kind, schema="  ")
        init = options(kind, schema=" o'brien ")["sessionInitStatement"]
        assert init == "SELECT set_config('search_path', 'o''brien', false)"
        assert Database(kind, "h").dialect == "postgres"


def test_clickhouse_urls():
    def url(host, **kwargs):
        return Database("clickhouse", host, **kwargs).url

    assert url("localhost") == "jdbc:clickhouse://localhost:8123/"
    assert url("https://demo.example.com:8443/") == "jdbc:clickhouse://demo.example.com:8443/?ssl=true"
    assert url("::1", database=" d ") == "jdbc:clickhouse://[::1]:8123/d"
    assert url("[::1]", port=9000) == "jdbc:clickhouse://[::1]:9000/"
    assert Database("clickhouse", "h").dialect == "json"


def test_partitioned_reads():
    database = Database("postgres", "h", "d")
    got = database.options("SELECT * FROM t", Partitioning("id", 64, 1, 10**9))
    assert (got["partitionColumn"], got["lowerBound"], got["upperBound"], got["numPartitions"]) == (
        "id", "1", "1000000000", "64",
    )
    with pytest.raises(ValueError):
        database.options("SELECT 1", Partitioning("id", 64))
    assert bounds_sql("SELECT * FROM t;", "id") == (
        "SELECT min(id) AS lo, max(id) AS hi FROM (SELECT * FROM t) bounded"
    )


def test_table_lists():
    assert "DATABASE()" in Database("doris", "h").tables_sql
    assert "current_schema()" in Database("supabase", "h").tables_sql
    assert "system.tables" in Database("clickhouse", "h").tables_sql


def test_unknown_database():
    with pytest.raises(ValueError):
        Database("sqlserver", "h")


def test_scratch_follows_the_checkpoint_setting(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{base}/lakequery/x-")


def test_odd_paths_and_packed_files(spark, tmp_path):
    folder = tmp_path / "a b%20c=é#1"
    folder.mkdir()
    with gzip.open(folder / "rows x.txt.gz", "wt") as file:
        file.write(TYPED + ROWS)
    assert read_compact_json(spark, str(folder)).selectExpr("sum(score)").first()[0] == -2.25
    saved = write_dataset(spark.range(5), "xlsx", str(folder / "book s"))
    assert saved.row_count == 5 and list((folder / "book s").glob("*.xlsx"))


def test_a_short_row_fails_even_a_count(spark, tmp_path):
    (tmp_path / "a.json").write_text('["id","name"]\n["Int64","String"]\n[1,"x"]\n[2]\n')
    with pytest.raises(Exception, match="expected 2 values, found 1"):
        read_compact_json(spark, str(tmp_path)).count()


def test_rows_like_headers_of_typed_columns_are_kept(spark, tmp_path):
    lines = ['["id","name"]', '["Int64","String"]', '[1,"x"]', '["id","name"]', '["Int64","String"]', '[2,"y"]']
    (tmp_path / "a.json").write_text("\n".join(lines))
    got = read_compact_json(spark, str(tmp_path)).collect()
    assert sorted(got, key=str) == sorted([(1, "x"), (None, "name"), (None, "String"), (2, "y")], key=str)


def test_values_are_matched_by_class_and_never_rounded(spark, tmp_path):
    wide = "170141183460469231731687303715884105727"
    header = '["a","b","c","d"]\n["Int64","Int128","Decimal(5,2)","Int32"]\n'
    rows = [f'[1.5,{wide},1.25,"7"]', f'["7","{wide}",1.255,2]', "[9223372036854775808,1.5,true,4294967296]"]
    (tmp_path / "a.json").write_text(header + "\n".join(rows))
    got = {tuple(None if v is None else str(v) for v in r) for r in read_compact_json(spark, str(tmp_path)).collect()}
    assert got == {(None, wide, "1.25", None), ("7", wide, None, "2"), (None, None, None, None)}


def test_bad_cells_of_a_csv_fail(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,name\n1,x\nabc,y\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path), "id int, name string").collect()


def test_header_typed_files_as_a_stream(spark, tmp_path):
    """Large files are split, batches end, a restart reads only what is new."""
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()
    for k in range(3):
        write(folder / f"{k}.txt", TYPED + "".join(f'[{1000 * k + i},"n{i}",0.5]\n' for i in range(1000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4kb")
    try:
        stream = stream_compact_json(spark, str(folder), max_files=1)
        assert stream.dtypes == read_compact_json(spark, str(folder)).dtypes
        assert save_stream(stream, "parquet", out, state).row_count == 3000
        write(folder / "3.txt", TYPED + '["3000","late",null]\n\n[3001,"later",1]\n')
        assert save_stream(stream_compact_json(spark, str(folder), max_files=1), "parquet", out, state).row_count == 3002
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    read = spark.read.parquet(out)
    assert read.selectExpr("count(*)", "count(DISTINCT id)", "count(score)").first()[:] == (3002, 3002, 3001)


def test_rows_like_headers_in_a_stream(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for name in ("p", "q"):
        write(folder / name, '["a","b"]\n\n["String","String"]\n["a","b"]\n["x","1"]\n["String","String"]\n')
    save_stream(stream_compact_json(spark, str(folder)), "json", str(tmp_path / "out"), str(tmp_path / "state"))
    rows = spark.read.schema("a string, b string").json(str(tmp_path / "out")).collect()
    assert sorted(tuple(r) for r in rows) == sorted([("a", "b"), ("x", "1"), ("String", "String")] * 2)


@pytest.mark.parametrize("text", ['["a","c"]\n["Int8","Int8"]\n[1,2]\n', '["a","b"]\n', '["a","b"]\n["Int8","Int16"]\n'])
def test_a_file_with_another_header_fails_the_stream(spark, tmp_path, text):
    folder = tmp_path / "in"
    folder.mkdir()
    header = ('["a","b"]', '["Int8","Int8"]')
    with pytest.raises(CompactJsonError, match="no file yet"):
        stream_compact_json(spark, str(folder))
    stream = stream_compact_json(spark, str(folder), header)
    write(folder / "good", "\n".join(header) + "\n[1,2]\n")
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    assert save_stream(stream, "parquet", out, state).row_count == 1
    write(folder / "foreign", text)
    with pytest.raises(Exception, match="foreign (has a different header|is not two lines)"):
        save_stream(stream, "parquet", out, state)
    assert spark.read.parquet(out).count() == 1


def test_even_ranges_of_a_skewed_column(spark):
    """A third of the rows share one key and the rest crowd at one end; every row has one range."""
    df = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 77 WHEN id % 997 = 1 THEN NULL ELSE CAST(pow(1.0005, id) AS BIGINT) END AS k"
    )
    predicates = range_predicates("k", even_bounds(df, 16))
    counts = [df.where(p).count() for p in predicates]
    assert sum(counts) == 30_000 and len(predicates) <= 17
    hot = [n for p, n in zip(predicates, counts) if p == "k = 77"]
    assert len(hot) == 1 and hot[0] >= 10_000
    assert max(n for p, n in zip(predicates, counts) if p != "k = 77") <= 2 * 30_000 / 16
    total = df.where(" OR ".join(f"({p})" for p in predicates)).count()
    assert total == 30_000


def test_range_predicates():
    assert range_predicates("k", []) == []
    assert range_predicates("k", [3, 5, 5, 5, 9]) == [
        "k < 3 OR k IS NULL", "k >= 3 AND k < 5", "k = 5", "k > 5 AND k < 9", "k >= 9",
    ]
    assert range_predicates("d", [datetime(2024, 1, 2, 3, 4, 5)])[1] == "d >= '2024-01-02 03:04:05'"
    assert range_predicates("d", [date(2024, 1, 2)])[0] == "d < '2024-01-02' OR d IS NULL"
    with pytest.raises(TypeError):
        range_predicates("name", ["x"])


def test_even_partitions_reach_the_reader(spark, monkeypatch):
    """No database runs here: the frames it would give are put in its place."""
    asked = []

    class Reader:
        def format(self, name):
            return self

        def options(self, **options):
            asked.append(options)
            return self

        def load(self):
            if "min(k)" in asked[-1]["dbtable"]:
                return spark.sql("SELECT 0 AS lo, 999 AS hi")
            return spark.range(1000).selectExpr("least(id, 400) AS k")

        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates, properties))
            return spark.range(1)

    class FakeSpark:
        read = Reader()

    database = Database("postgres", "h", "shop", "u", "p")
    read_database(FakeSpark(), database, "SELECT * FROM t;", Partitioning("k", 4, even=True))
    bounds, column, (url, table, predicates, properties) = asked
    assert "numPartitions" not in bounds and column["numPartitions"] == "4" and column["upperBound"] == "999"
    assert column["dbtable"] == "(SELECT k FROM (SELECT * FROM t) shared) lakequery"
    assert url == "jdbc:postgresql://h:5432/shop" and table == "(SELECT * FROM t) lakequery"
    assert predicates[0].startswith("k < 24") or predicates[0].startswith("k < 25")
    assert predicates[-2:] == ["k = 400", "k > 400"] and properties["fetchsize"] == str(jdbc.FETCH_SIZE)
    assert "partitionColumn" not in properties

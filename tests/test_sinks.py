import glob
import io
import os
import random
import re
import zipfile
from types import SimpleNamespace
from xml.etree import ElementTree

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from lakequery import Session
from lakequery import storage as storage_module
from lakequery.sinks import xlsx
from lakequery.sinks.dataset import write_dataset
from lakequery.sinks.formats import ExportError, parse_format, parse_mode
from lakequery.sources.csv import read_csv
from lakequery.storage import Storage

FORMATS = ["csv", "excel", "json", "orc", "parquet"]
NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet(path):
    with zipfile.ZipFile(path) as book:
        root = ElementTree.fromstring(book.read("xl/worksheets/sheet1.xml"))
    return [
        {c.get("r"): (c.get("t"), "".join(c.itertext())) for c in row} for row in root.iter(f"{NS}row")
    ]


def data_files(path):
    """Visible files at or under a path, with when each was written."""
    found = [path, *glob.glob(f"{path}/**", recursive=True)]
    visible = [f for f in found if os.path.isfile(f) and "/_temporary" not in f]
    return {f: os.stat(f).st_mtime_ns for f in visible}


def test_format_and_mode_names():
    assert [parse_format(f) for f in (" CSV ", "xlsx", "Excel", "json", "ORC", "parquet")] == [
        "csv", "excel", "excel", "json", "orc", "parquet",
    ]
    assert [parse_mode(m) for m in (None, "", "  ", "Overwrite", " append ")] == ["overwrite"] * 4 + ["append"]
    with pytest.raises(ExportError, match="no export format"):
        parse_format("avro")
    with pytest.raises(ExportError, match="no export mode"):
        parse_mode("upsert")


@pytest.mark.parametrize("name", FORMATS)
def test_row_count_and_result_name(stock, tmp_path, name):
    saved = write_dataset(stock, "xlsx" if name == "excel" else name, str(tmp_path / "t"))
    assert (saved.file_type, saved.row_count) == (name, 2)


@pytest.mark.parametrize("name, label", [("parquet", "parquet"), ("orc", "orc"), ("xlsx", "excel/xlsx")])
def test_append_is_refused_where_files_cannot_grow(stock, tmp_path, name, label):
    path = str(tmp_path / "t")
    write_dataset(stock, name, path, "append")
    with pytest.raises(ExportError, match=f"Append mode is not supported for {label} exports"):
        write_dataset(stock, name, path, "append")
    write_dataset(stock, name, path)


def test_dataset_append_and_overwrite(spark, stock, tmp_path):
    for name in ("csv", "json"):
        path = str(tmp_path / name)
        write_dataset(stock, name, path)
        write_dataset(stock, name, path, "append")
        read = spark.read.json(path) if name == "json" else read_csv(spark, path)
        assert read.count() == 4
        write_dataset(stock, name, path)
        read = spark.read.json(path) if name == "json" else read_csv(spark, path)
        assert sorted(tuple(r[c] for c in ("sku", "part", "bins")) for r in read.collect()) == [
            (7, "rivet", 310),
            (9, "nut, hex", 45),
        ]


def test_dataset_json_append_checks_what_is_there(stock, tmp_path):
    path = tmp_path / "d"
    path.mkdir()
    (path / "x.csv").write_text("id,name\n")
    with pytest.raises(ExportError, match="does not hold JSON rows"):
        write_dataset(stock, "json", str(path), "append")


def test_csv_append_needs_the_same_columns(spark, stock, tmp_path):
    path = str(tmp_path / "t")
    write_dataset(stock, "csv", path)
    with pytest.raises(ExportError, match="its columns are"):
        write_dataset(stock.select("part", "sku", "bins"), "csv", path, "append")
    assert read_csv(spark, path).count() == 2


def test_one_file_is_no_dataset(stock, tmp_path):
    (tmp_path / "f").write_text("id\n1\n")
    with pytest.raises(ExportError, match="one file"):
        write_dataset(stock, "csv", str(tmp_path / "f"), "append")
    assert write_dataset(stock, "csv", str(tmp_path / "f")).row_count == 2


def test_a_failed_swap_rolls_back(spark, stock, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    write_dataset(stock, "csv", path)
    rename, calls = Storage.rename, []

    def second_fails(self, source, target):
        calls.append(source)
        if len(calls) == 2:
            raise OSError("store is away")
        rename(self, source, target)

    monkeypatch.setattr(Storage, "rename", second_fails)
    with pytest.raises(OSError, match="away"):
        write_dataset(stock.where("sku = 7"), "csv", path)
    assert read_csv(spark, path).count() == 2


@pytest.mark.parametrize("name", FORMATS)
def test_empty_result_keeps_columns(spark, stock, tmp_path, name):
    empty = stock.where("sku < 0")
    dataset = str(tmp_path / "d")
    assert write_dataset(empty, name, dataset).row_count == 0
    if name == "csv":
        assert read_csv(spark, dataset).columns == ["sku", "part", "bins"]
    elif name == "json":
        assert spark.read.text(dataset).count() == 0
    elif name == "excel":
        for path in glob.glob(f"{dataset}/*.xlsx"):
            assert [[c[1] for c in r.values()] for r in sheet(path)] == [["sku", "part", "bins"]]
    else:
        assert spark.read.format(name).load(dataset).columns == ["sku", "part", "bins"]


@pytest.mark.parametrize("name", FORMATS)
def test_failed_export_leaves_the_target(spark, stock, tmp_path, name):
    path = str(tmp_path / "t")
    write_dataset(stock, name, path)
    before = data_files(path)
    failing = spark.sql("SELECT CASE WHEN id < 900 THEN id ELSE raise_error('boom') END AS id FROM range(1000)")
    with pytest.raises(PySparkException, match="boom"):
        write_dataset(failing, name, path)
    assert data_files(path) == before


def test_bad_sql_is_logged_and_leaves_the_target(spark, tmp_path):
    session, path = Session(spark, str(tmp_path / "log")), str(tmp_path / "t.csv")
    session.save("SELECT 1 AS id", "csv", path, view_name="good")
    for sql, kind in (("SELECT nope", "csv"), ("SELECT 1 AS id", "avro")):
        with pytest.raises((PySparkException, ExportError)):
            session.save(sql, kind, path)
    assert [r["id"] for r in read_csv(spark, path).collect()] == [1]
    log = session.log.table().orderBy("created_at").collect()
    assert [(r["view_name"], r["operation"], r["status"], r["row_count"]) for r in log] == [
        ("good", "save", "success", 1),
        ("view_1", "save", "error", None),
        ("view_2", "save", "error", None),
    ]


def test_save_has_no_row_cap(spark, tmp_path):
    session = Session(spark, str(tmp_path / "log"))
    assert session.save("SELECT id FROM range(5000)", "parquet", str(tmp_path / "t")).row_count == 5000


def test_overwrite_may_read_its_own_target(spark, stock, tmp_path):
    path = str(tmp_path / "t")
    write_dataset(stock, "parquet", path)
    write_dataset(spark.read.parquet(path).withColumn("bins", F.col("bins") + 1), "parquet", path)
    assert sorted(r["bins"] for r in spark.read.parquet(path).collect()) == [46, 311]


def test_repeated_names_are_refused(spark, tmp_path):
    for name in FORMATS:
        with pytest.raises(ExportError, match="two columns named"):
            write_dataset(spark.sql("SELECT 1 AS a, 2 AS A"), name, str(tmp_path / "t"))


def test_csv_text_survives(spark, tmp_path):
    texts = ["a,b", 'say "hi"', "two\nlines", "cr\rlf\r\n", "  spaces  ", "back\\slash", "é☃", "'"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    write_dataset(df, "csv", str(tmp_path / "t"))
    read = read_csv(spark, str(tmp_path / "t"), "i int, t string")
    assert [r["t"] for r in read.orderBy("i").collect()] == texts


def test_lone_empty_cells_stay_rows(spark, tmp_path):
    df = spark.sql("SELECT * FROM VALUES ('a'), (NULL), (''), ('b') AS t(v)")
    write_dataset(df, "csv", str(tmp_path / "d"))
    assert read_csv(spark, str(tmp_path / "d")).count() == 4


def test_columnar_types(spark, tmp_path):
    df = spark.sql("SELECT 1 AS i, 1.5BD AS d, true AS b, DATE'1970-01-02' AS day, array(1) AS l")
    for name in ("parquet", "orc"):
        write_dataset(df, name, str(tmp_path / name))
        saved = spark.read.format(name).load(str(tmp_path / name))
        assert saved.schema.simpleString() == "struct<i:bigint,d:string,b:boolean,day:string,l:string>"
        assert tuple(saved.first()) == (1, "1.5", True, "date32:1", "[1]")


def test_inferred_typing_keeps_every_value(spark, tmp_path):
    df = spark.sql(
        "SELECT id, CASE WHEN id = 250 THEN parse_json('\"late\"') ELSE parse_json(string(id)) END AS v,"
        " NULL AS n FROM range(0, 300, 1, 4) ORDER BY id"
    )
    write_dataset(df, "parquet", str(tmp_path / "t"), typing="inferred")
    saved = spark.read.parquet(str(tmp_path / "t"))
    assert saved.schema.simpleString() == "struct<id:bigint,v:string,n:string>"
    assert saved.where("v = 'late'").collect()[0]["id"] == 250 and saved.where("v = string(id)").count() == 299


def test_xlsx_cells(spark, tmp_path):
    df = spark.sql(
        "SELECT 1 AS i, true AS b, 2.5D AS d, CAST('NaN' AS DOUBLE) AS f, NULL AS n,"
        " 'a<&>\"\\u0001_x0041_' AS t, array(1) AS l"
    )
    write_dataset(df, "xlsx", str(tmp_path / "t"))
    header, row = sheet(glob.glob(str(tmp_path / "t" / "*.xlsx"))[0])
    assert [v for _, v in header.values()] == ["i", "b", "d", "f", "n", "t", "l"]
    assert row == {
        "A2": (None, "1"),
        "B2": ("b", "1"),
        "C2": (None, "2.5"),
        "D2": ("inlineStr", "NaN"),
        "F2": ("inlineStr", 'a<&>"_x0001__x005F_x0041_'),
        "G2": ("inlineStr", "[1]"),
    }


def test_xlsx_limits():
    with pytest.raises(xlsx.SheetLimitError):
        xlsx.Workbook(io.BytesIO(), [str(i) for i in range(xlsx.MAX_COLUMNS + 1)])
    long = pa.array(["x" * xlsx.MAX_CELL_CHARS, None])
    assert len(xlsx.cells("A", pa.array(["1", "2"]), long)) == 2
    for text in ("x" * (xlsx.MAX_CELL_CHARS + 1), "😀" * (xlsx.MAX_CELL_CHARS // 2 + 1)):
        with pytest.raises(xlsx.SheetLimitError):
            xlsx.cells("A", pa.array(["1"]), pa.array([text]))


def test_column_letters():
    assert [xlsx.column_letters(i) for i in (0, 25, 26, 701, 702, 16_383)] == [
        "A", "Z", "AA", "ZZ", "AAA", "XFD",
    ]


def test_full_workbooks_roll_over(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(xlsx, "SLICE", 10)
    monkeypatch.setattr(xlsx, "MAX_ROWS", 41)
    write_dataset(spark.range(0, 100, 1, 1), "xlsx", str(tmp_path / "t"))
    books = sorted(glob.glob(str(tmp_path / "t" / "*.xlsx")))
    rows = [sheet(b) for b in books]
    assert [len(r) for r in rows] == [41, 41, 21]
    assert [int(c[1]) for r in rows for line in r[1:] for c in line.values()] == list(range(100))


def test_count_needs_no_second_job(spark, stock, tmp_path):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("export", "export")
    write_dataset(stock, "parquet", str(tmp_path / "t"))
    jobs = tracker.getJobIdsForGroup("export")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


def test_overwrite_where_a_rename_would_copy(spark, stock, tmp_path, monkeypatch):
    """Object stores get the new parts first and lose the old ones after."""
    monkeypatch.setattr(Storage, "renames_cheaply", lambda self, path: False)
    path = str(tmp_path / "t")
    write_dataset(stock, "json", path)
    first = data_files(path)
    write_dataset(spark.read.json(path).where("sku = 7"), "json", path)
    assert [r["sku"] for r in spark.read.json(path).collect()] == [7]
    assert not {f for f in first if "/part-" in f} & set(data_files(path))
    with pytest.raises(PySparkException, match="boom"):
        write_dataset(spark.sql("SELECT raise_error('boom') AS x"), "json", path)
    assert [r["sku"] for r in spark.read.json(path).collect()] == [7]


def test_no_leftovers_beside_a_target(stock, tmp_path):
    for _ in range(2):
        write_dataset(stock, "csv", str(tmp_path / "t"))
    assert os.listdir(tmp_path) == ["t"]


def test_scratch_lies_in_a_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    settings = {"spark.sql.warehouse.dir": "hdfs://store/warehouse"}
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)))
    assert storage_module.scratch_dir(fake, "x").startswith("hdfs://store/warehouse/lakequery/x-")
    path = storage_module.scratch_dir(spark, "x")
    assert path.startswith(base)
    spark.range(3).write.parquet(path)
    storage_module.drop_scratch(spark, path)
    assert not Storage(spark).exists(path) and path not in storage_module._made
    storage_module._made.pop()


def test_random_text_survives_every_text_format(spark, tmp_path):
    """Whole cells come back from CSV, JSON and Excel, whatever characters they hold."""
    generator = random.Random(7)
    alphabet = ['"', ",", "\n", "\r", "\\", "'", " ", "\t", "#", "a", "é", "☃", "😀", "<", "&", "_x0041_", "{", "["]
    texts = ["".join(generator.choices(alphabet, k=generator.randint(1, 12))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").repartition(3)
    for name in ("csv", "json", "xlsx"):
        write_dataset(df, name, str(tmp_path / name))
    want = dict(enumerate(texts))
    read = read_csv(spark, str(tmp_path / "csv"), "i int, t string").collect()
    assert {r["i"]: r["t"] for r in read} == want and len(read) == 3000
    assert {r["i"]: r["t"] for r in spark.read.json(str(tmp_path / "json")).collect()} == want
    cells = {}
    for book in glob.glob(str(tmp_path / "xlsx" / "*.xlsx")):
        for row in sheet(book)[1:]:
            (_, i), (_, t) = row.values()
            cells[int(i)] = re.sub("_x([0-9A-F]{4})_", lambda m: chr(int(m.group(1), 16)), t)
    assert cells == want

"""CSV files cut into blocks of a few bytes, against Python's own reader."""

import csv
import io
import random

import pytest

from lakequery.sources.csv import read_csv, register_csv
from lakequery.sources.csv_split import CsvError, inside_after, read_csv_split


@pytest.fixture
def tiny_blocks(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


PIECES = ["a", "bc", " ", ",", '"', '""', "\n", "\n\n", "\r\n", "é", "x" * 30, ',"', '",', "1"]


def written(path, rows, end):
    with open(path, "w", newline="", encoding="utf-8") as out:
        csv.writer(out, lineterminator=end).writerows(rows)


@pytest.mark.parametrize("seed", range(6))
def test_rows_are_those_of_the_whole_file(spark, tmp_path, tiny_blocks, seed):
    rng = random.Random(seed)
    want = []
    for k in range(2):
        rows = [["id", 'the "text"\nof it', "n"]]
        for i in range(rng.randint(0, 60)):
            rows.append([f"{k}-{i}", "".join(rng.choices(PIECES, k=rng.randint(0, 12))), rng.choice(["", "7"])])
        written(tmp_path / f"{k}.csv", rows, rng.choice(["\n", "\r\n"]))
        want += [tuple(cell or None for cell in row) for row in rows[1:]]
    df = read_csv_split(spark, str(tmp_path), "id string, text string, n string")
    got = [(row["id"], row["text"] or None, row["n"]) for row in df.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert df.count() == len(want)


def test_one_file_is_read_by_many_tasks(spark, tmp_path, tiny_blocks):
    rows = [["id", "text"], *([str(i), f"line\nof, {i}"] for i in range(200))]
    written(tmp_path / "one.csv", rows, "\n")
    df = read_csv_split(spark, str(tmp_path / "one.csv"), "id int, text string")
    assert df.rdd.getNumPartitions() > 10
    assert sorted(map(tuple, df.collect())) == sorted((i, f"line\nof, {i}") for i in range(200))
    whole = read_csv(spark, str(tmp_path / "one.csv"), "id int, text string")
    assert sorted(whole.collect()) == sorted(df.collect())


def test_a_record_over_many_blocks(spark, tmp_path, tiny_blocks):
    """The header and one record are longer than several blocks, and no quote lies in some of them."""
    rows = [["id", "\n".join(["head"] * 100)], ["1", "\n".join(["text,"] * 300)], ["2", ""]]
    written(tmp_path / "long.csv", rows, "\n")
    got = read_csv_split(spark, str(tmp_path / "long.csv")).collect()
    assert [tuple(row) for row in sorted(got)] == [(1, rows[1][1]), (2, None)]


def test_types_are_detected(spark, tmp_path, tiny_blocks):
    rows = [["a", "b", "c", "d", "e", "f"], *([str(i), str(i << 40), f"{i}.5", "true", "2024-01-02 03:04:05", f"t\n{i}"] for i in range(30))]
    written(tmp_path / "t.csv", rows, "\n")
    df = register_csv(spark, "split_rows", str(tmp_path / "t.csv"), split=True)
    assert [kind for _, kind in df.dtypes] == ["int", "bigint", "double", "boolean", "timestamp", "string"]
    assert spark.sql("SELECT sum(a), max(f) FROM split_rows").first()[0] == sum(range(30))


def test_stray_quotes_open_nothing(spark, tmp_path, tiny_blocks):
    lines = ["id,text", *(f'{i},5" pipe' for i in range(40)), '40,"a\n""b"""', ""]
    (tmp_path / "stray.csv").write_text("\n".join(lines))
    got = {row["id"]: row["text"] for row in read_csv_split(spark, str(tmp_path / "stray.csv"), "id int, text string").collect()}
    assert len(got) == 41 and got[7] == '5" pipe' and got[40] == 'a\n"b"'


@pytest.mark.parametrize(
    ("line", "before", "after"),
    [("a,b", False, False), ("a,b", True, True), ('"a', False, True), ('a"', True, False), ('a""', True, True), ('a,"b""', False, True),
     ('a"b', False, False), ('"a","b', False, True), ('x","y"', True, False), ('"a"b"', False, False), ("", True, True)],
)
def test_states(line, before, after):
    assert inside_after(line, before) is after


def test_faults_are_named(spark, tmp_path, tiny_blocks):
    open_end, ragged, other, bad = (tmp_path / name for name in ("open", "ragged", "other", "bad"))
    for folder in (open_end, ragged, other, bad):
        folder.mkdir()
    (open_end / "a.csv").write_text('id,text\n1,"never closed\n' + "x\n" * 200)
    with pytest.raises(CsvError, match="ends inside quotes"):
        read_csv_split(spark, str(open_end))
    (ragged / "a.csv").write_text("id,text\n1,a\n2\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_split(spark, str(ragged), "id int, text string").collect()
    (other / "a.csv").write_text("id,text\n1,a\n")
    (other / "b.csv").write_text("text,id\na,1\n")
    with pytest.raises(Exception, match="another header"):
        read_csv_split(spark, str(other), "id string, text string").collect()
    (bad / "a.csv").write_text("id\nx\n")
    with pytest.raises(Exception, match="MALFORMED"):
        read_csv_split(spark, str(bad), "id int").collect()


def test_header_alone(spark, tmp_path, tiny_blocks):
    (tmp_path / "a.csv").write_text("id,text\n")
    df = read_csv_split(spark, str(tmp_path / "a.csv"))
    assert df.columns == ["id", "text"] and df.count() == 0

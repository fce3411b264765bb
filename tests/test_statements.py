import glob
import json

import pytest
from pyspark.sql import functions as F

from lakequery import log_compaction
from lakequery import statements as statements_module
from lakequery.statements import LOG_SCHEMA, StatementLog, named_views, read_sessions, session_summary, time_text
from lakequery.storage import Storage


def document(session_id, *views):
    return {
        "session_id": session_id,
        "created_at": "2024-01-01T00:00:00.000Z",
        "updated_at": "2024-01-01T00:00:09.120Z",
        "views": list(views),
    }


def view(name, operation="query", rows=None, error=None):
    record = {"view_name": name, "operation": operation, "sql": "SELECT 1", "created_at": "2024-01-01T00:00:01.250Z"}
    if rows is not None:
        record["row_count"] = rows
    record["status"] = "success" if error is None else "error"
    if error is not None:
        record["error"] = error
    return record


def test_documents_become_rows(spark, tmp_path):
    docs = [
        document("s1", view("a", rows=3), view("b", "save", rows=4), view("c", error="bad\nline")),
        document("s2", view("d", "queryStream", rows=0)),
        document("s3"),
    ]
    for i, doc in enumerate(docs):
        (tmp_path / f"{i}.json").write_text(json.dumps(doc, indent=2))
    statements = read_sessions(spark, str(tmp_path))
    rows = statements.orderBy("session_id", "position").collect()
    assert [(r["session_id"], r["view_name"], r["row_count"], r["status"], r["error"]) for r in rows] == [
        ("s1", "a", 3, "success", None),
        ("s1", "b", 4, "success", None),
        ("s1", "c", None, "error", "bad\nline"),
        ("s2", "d", 0, "success", None),
    ]
    text = statements.select(time_text(F.col("created_at"))).first()[0]
    assert text == "2024-01-01T00:00:01.250Z"
    summary = {tuple(r) for r in session_summary(statements).collect()}
    assert summary == {
        ("s1", "query", "success", 1, 3),
        ("s1", "save", "success", 1, 4),
        ("s1", "query", "error", 1, 0),
        ("s2", "queryStream", "success", 1, 0),
    }


def test_blank_names_are_numbered_per_session(spark):
    names = ["x", None, " y ", " ", "", "z"]
    rows = [(s, i, n) for s in ("s1", "s2") for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "session_id string, position int, view_name string")
    got = named_views(df).orderBy("session_id", "position").collect()
    assert [r["view_name"] for r in got] == ["x", "view_1", "y", "view_2", "view_3", "z"] * 2


def test_malformed_documents_are_not_skipped(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(document("s1", view("a", rows=3))))
    (tmp_path / "b.json").write_text('{"session_id": "s2", "views": [')
    with pytest.raises(Exception, match="Malformed records"):
        read_sessions(spark, str(tmp_path)).collect()


def test_a_session_may_span_many_chunks(spark, monkeypatch):
    monkeypatch.setattr(statements_module, "_CHUNK_ROWS", 7)
    rows = [("hot", i, None) for i in range(60)] + [(f"s{i}", 0, "") for i in range(20)] + [(None, 0, "")]
    df = spark.createDataFrame(rows, "session_id string, position int, view_name string")
    got = {(r["session_id"], r["position"]): r["view_name"] for r in named_views(df).collect()}
    assert got == {(s, p): f"view_{p + 1}" for s, p, _ in rows}


def written_log(spark, path, sessions, rows=3):
    for k in range(sessions):
        log = StatementLog(spark, path)
        for n in range(rows):
            log.append("query", f"SELECT {k}", f"s{k}_{n}", n)
        log.flush()


def names(spark, path):
    return sorted(r["view_name"] for r in StatementLog(spark, path).table().collect())


def test_merged_logs_keep_every_row(spark, tmp_path):
    path = str(tmp_path / "log")
    written_log(spark, path, 6)
    before = names(spark, path)
    assert StatementLog(spark, path).compact(most=2) == 1
    assert names(spark, path) == before and log_compaction.live_files(spark, path) == 1
    assert StatementLog(spark, path).compact(most=2) == 0
    written_log(spark, path, 3)  # beside the merged file
    twice = sorted(before + [name for name in before if name < "s3"])
    assert names(spark, path) == twice
    assert StatementLog(spark, path).compact(most=2) == 1 and names(spark, path) == twice
    assert log_compaction.drop_replaced(spark, path) == 10 and names(spark, path) == twice
    assert len(glob.glob(f"{path}/log_date=*/*.parquet")) == 1
    assert StatementLog(spark, path).table().schema["row_count"].dataType.typeName() == "long"


def test_of_two_merges_from_one_state_one_is_late(spark, tmp_path, monkeypatch):
    """Both saw the same files; the second commit must not count, or rows would be there twice."""
    path = str(tmp_path / "log")
    written_log(spark, path, 4)
    before, stale = names(spark, path), log_compaction.read_manifests(spark, path)
    (day,) = [d.name for d in (tmp_path / "log").iterdir() if d.name.startswith("log_date=")]
    assert log_compaction.merge_day(spark, path, day, LOG_SCHEMA, 1)
    with monkeypatch.context() as patched:
        patched.setattr(log_compaction, "read_manifests", lambda *_: stale)
        assert not log_compaction.merge_day(spark, path, day, LOG_SCHEMA, 1)
    assert names(spark, path) == before and log_compaction.live_files(spark, path) == 1
    assert len(glob.glob(f"{path}/{day}/merged-*.parquet")) == 1


def test_a_merge_that_ends_before_its_commit_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    written_log(spark, path, 4)
    before = names(spark, path)

    def dies(self, path, text):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patched:
        patched.setattr(Storage, "create_text", dies)
        with pytest.raises(RuntimeError, match="driver lost"):
            StatementLog(spark, path).compact(most=1)
    assert names(spark, path) == before and log_compaction.live_files(spark, path) == 4
    assert StatementLog(spark, path).compact(most=1) == 1 and names(spark, path) == before

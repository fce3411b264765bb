"""Export of a stream, one micro-batch at a time, into the same formats as a batch."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.functions.encode import EMBEDDED, row_json
from lakequery.operators.capped import ColumnMeta, columns
from lakequery.operators.infer import project_typed
from lakequery.sinks.dataset import (
    DECLARED,
    INFERRED,
    counted,
    distinct_names,
    export_frame,
    superseded,
    write_parts,
)
from lakequery.sinks.formats import (
    ORC,
    OVERWRITE,
    PARQUET,
    ExportError,
    SaveResult,
    check_append,
    parse_format,
    parse_mode,
)
from lakequery.storage import Storage, drop_scratch, scratch_dir
from lakequery.streaming.fingerprint import check_files
from lakequery.streaming.inferred import Seen, classes_of, label_of, merged, types_of


def check_columns(first: list[ColumnMeta], later: list[ColumnMeta]) -> None:
    """Every chunk must have the names and types of the first; one without columns passes."""
    if later and later != first:
        raise ExportError(f"Inconsistent columns in a streaming export: {later} after {first}")


@dataclass
class StreamTarget:
    """A dataset directory that one streaming query adds micro-batches to, each exactly once.

    A batch is staged in a hidden folder of the query. Its manifest, with the row count and the
    names its files are about to get, is stored before the files are moved beside the others. A
    batch that runs again first removes what its old manifest names, so it replaces itself.
    """

    spark: SparkSession
    path: str
    checkpoint: str
    file_format: str
    dialect: str
    typing: str = DECLARED

    @cached_property
    def storage(self) -> Storage:
        return Storage(self.spark)

    @cached_property
    def query_id(self) -> str:
        """The identity Spark gave the query when its checkpoint was made."""
        metadata = self.spark.read.text(f"{self.checkpoint}/metadata").first()[0]
        return json.loads(metadata)["id"]

    @property
    def work(self) -> str:
        return f"{self.path}/_stream-{self.query_id}"

    def write(self, batch: DataFrame, batch_id: int) -> None:
        staged, manifest = f"{self.work}/staged", f"{self.work}/manifests/{batch_id}.json"
        self.storage.delete(staged)
        encoded = scratch_dir(self.spark, "encoded") if self.typing == INFERRED else None
        frame, found = self.typed(batch, batch_id, encoded) if encoded else (export_frame(batch, self.file_format, self.dialect), {})
        frame, seen = counted(frame)
        write_parts(frame, self.file_format, staged)
        if encoded:
            drop_scratch(self.spark, encoded)
        label = f"{label_of(dict(found['types']))}-" if found else ""
        if self.storage.exists(manifest):
            old = json.loads(self.spark.read.text(manifest).first()[0])
            self.storage.delete_all([f"{self.path}/{name}" for name in old["files"]])
        moves = {
            entry.path: f"part-{self.query_id}-{batch_id:08d}-{label}{entry.name.removeprefix('part-')}"
            for entry in self.storage.children(staged)
            if entry.name.startswith("part-")
        }
        record = {"batch_id": batch_id, "rows": seen.get["rows"], "files": list(moves.values())}
        record |= {name: json.dumps(value) for name, value in found.items()}
        self.storage.write_text(manifest, json.dumps(record))
        self.storage.rename_all({old: f"{self.path}/{name}" for old, name in moves.items()})

    def typed(self, batch: DataFrame, batch_id: int, path: str) -> tuple[DataFrame, dict]:
        """The batch under the types that hold all values up to it, and what its manifest says of them.

        The encoded rows are stored in ``path``, so the batch is computed once.
        """
        row_json(batch, self.dialect).write.parquet(path)
        rows, names = self.spark.read.schema("row string").parquet(path), batch.columns
        own = classes_of(rows, "row", names)
        types = types_of(merged(self.seen_before(batch_id), own), names)
        return project_typed(rows, "row", types), {"classes": own, "types": list(types.items())}

    def seen_before(self, batch_id: int) -> Seen:
        """What all earlier batches showed of the columns: one small document per batch, those merged one by one."""
        folder, seen = f"{self.work}/manifests", {}
        if self.storage.exists(folder):
            manifests = self.spark.read.schema("batch_id long, classes string").json(folder)
            earlier = manifests.where(F.col("batch_id") < batch_id).orderBy("batch_id")
            for row in earlier.toLocalIterator():
                seen = merged(seen, json.loads(row["classes"] or "{}"))
        return seen

    def began(self) -> bool:
        """Whether some batch of this query has noted what it replaces or stored a manifest."""
        return any(self.storage.exists(f"{self.work}/{name}") for name in ("superseded.json", "manifests"))

    def supersede(self) -> None:
        """Note what the target holds, before the first batch of an overwriting stream."""
        old = superseded(self.storage, self.path)
        self.storage.write_text(f"{self.work}/superseded.json", json.dumps(old))

    def drop_superseded(self) -> None:
        """After the last batch: delete what was noted, of this run or of one that it resumes."""
        note = f"{self.work}/superseded.json"
        if self.storage.exists(note):
            old = json.loads(self.spark.read.option("wholetext", True).text(note).first()[0])
            self.storage.delete_all([path for path in old if not path.endswith(f"_stream-{self.query_id}")])
            self.storage.delete(note)

    def check_sources(self, batch_id: int, header: bool) -> None:
        """Hold the batch's files against the columns of the first file, which is noted beside the manifests."""
        note = f"{self.work}/columns.json"
        noted = self.storage.exists(note)
        fixed = json.loads(self.spark.read.option("wholetext", True).text(note).first()[0]) if noted else {}
        found = check_files(self.spark, self.checkpoint, batch_id, fixed, header)
        if found != fixed:
            self.storage.write_text(note, json.dumps(found))

    def row_count(self) -> int:
        manifests = self.spark.read.schema("rows long").json(f"{self.work}/manifests")
        return int(manifests.agg(F.sum("rows")).first()[0] or 0)


def save_stream(
    df: DataFrame,
    file_type: str,
    path: str,
    checkpoint: str,
    mode: str | None = None,
    dialect: str = EMBEDDED,
    trigger: dict | None = None,
    header: bool = False,
    typing: str = DECLARED,
) -> SaveResult:
    """Run a streaming frame into the dataset ``path``; the result counts this stream's rows.

    The first file fixes the columns: a Parquet or ORC file with others, or with ``header`` a CSV file with another
    header line, fails its micro-batch before a row of it is stored, and the error names the file.

    ``typing="inferred"`` gives Parquet and ORC columns the types of the values so far, which widen as batches come;
    ``read_inferred`` reads all parts under the widest.
    A failed batch ends the export with its error and the same ``checkpoint`` resumes it, without
    storing or counting a row twice. A stream that overwrites drops what the target held after its
    last batch; until then, and where a batch fails, the old rows stay readable.
    """
    spark = df.sparkSession
    file_format, save_mode = parse_format(file_type), parse_mode(mode)
    distinct_names(df)
    if typing not in (DECLARED, INFERRED) or (typing == INFERRED and file_format not in (PARQUET, ORC)):
        raise ExportError(f"typing of a {file_format} stream cannot be {typing}")
    storage = Storage(spark)
    target = StreamTarget(spark, storage.qualify(path), checkpoint, file_format, dialect, typing)
    if not storage.exists(f"{checkpoint}/metadata"):
        check_append(spark, file_format, save_mode, path)
    first = columns(df)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        check_columns(first, columns(batch))
        target.check_sources(batch_id, header)
        if save_mode == OVERWRITE and not target.began():
            target.supersede()
        target.write(batch, batch_id)

    writer = df.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    writer.trigger(**(trigger or {"availableNow": True})).start().awaitTermination()
    if not storage.exists(f"{target.work}/manifests"):
        if save_mode == OVERWRITE and not target.began():
            target.supersede()
        target.write(spark.createDataFrame([], df.schema), 0)
    target.drop_superseded()
    return SaveResult(path, file_format, target.row_count())

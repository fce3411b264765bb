"""Merging the many small files of a statement log, while sessions go on writing to it.

Each commit of a merge is a manifest that names the files it replaces and those it adds. Manifests of a day are
numbered, and one is created only if no other has its number: of two merges that began from the same state the
second sees that it is late, drops its files and begins anew. Readers take a merged file only once a manifest names
it, and from then on none that it replaces, so every row is seen once at any time. Files that sessions add meanwhile
are in no manifest and simply stay.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.storage import Storage

MERGED = "merged-"
# Days with more files than this are merged, into files of about this size.
MOST_FILES = 4
FILE_BYTES = 128 << 20
RETRIES = 20


@dataclass(frozen=True)
class Manifests:
    """What all merges committed so far say: one manifest per merge that was not cleaned up since."""

    added: frozenset[str]
    replaced: frozenset[str]
    last: dict[str, int]

    def live(self, name: str) -> bool:
        return name not in self.replaced and (not name.startswith(MERGED) or name in self.added)

    def rows(self) -> Column:
        """The condition that keeps each row of a scan once."""
        name = F.col("_metadata.file_name")
        unnamed = F.startswith(name, F.lit(MERGED)) & ~name.isin(*sorted(self.added))
        return ~(name.isin(*sorted(self.replaced)) | unnamed)


def folder_of(path: str) -> str:
    return f"{path.rstrip('/')}/_merges"


def read_manifests(spark: SparkSession, path: str) -> Manifests:
    storage, added, replaced, last = Storage(spark), set(), set(), {}
    entries = storage.children(folder_of(path))
    if entries:
        record = "day string, number int, added array<string>, replaced array<string>"
        for row in spark.read.schema(record).json(folder_of(path)).toLocalIterator():
            added.update(row["added"])
            replaced.update(row["replaced"])
            last[row["day"]] = max(row["number"], last.get(row["day"], 0))
    return Manifests(frozenset(added), frozenset(replaced), last)


def parts(storage: Storage, folder: str) -> list[str]:
    return [e.name for e in storage.children(folder) if e.name.endswith(".parquet") and not e.name.startswith(("_", "."))]


def merge_day(spark: SparkSession, path: str, day: str, schema: str, most: int = MOST_FILES) -> bool:
    """Merge one day's files if there are more than ``most``; whether it did, and was first."""
    storage, known, folder = Storage(spark), read_manifests(spark, path), f"{path.rstrip('/')}/{day}"
    old = [name for name in parts(storage, folder) if known.live(name)]
    if len(old) <= most:
        return False
    size = sum(storage.size(f"{folder}/{name}") for name in old)
    mark, number = uuid.uuid4().hex, known.last.get(day, 0) + 1
    staging = f"{path.rstrip('/')}/_merging-{mark}"
    rows = spark.read.schema(schema).parquet(*[f"{folder}/{name}" for name in old])
    rows.coalesce(max(1, ceil(size / FILE_BYTES))).write.parquet(staging)
    added = {name: f"{MERGED}{mark}-{k:05d}.parquet" for k, name in enumerate(parts(storage, staging))}
    storage.rename_all({f"{staging}/{name}": f"{folder}/{new}" for name, new in added.items()})
    storage.delete(staging)
    manifest = {"day": day, "number": number, "added": list(added.values()), "replaced": old}
    if storage.create_text(f"{folder_of(path)}/{day.replace('=', '-')}-{number:08d}.json", json.dumps(manifest)):
        return True
    storage.delete_all([f"{folder}/{name}" for name in added.values()])
    return False


def merge_log(spark: SparkSession, path: str, schema: str, most: int = MOST_FILES) -> int:
    """Merge every day that has more than ``most`` files; the number of merges committed.

    Replaced files stay until ``drop_replaced``, for readers that have planned with them.
    """
    storage, done = Storage(spark), 0
    path = storage.qualify(path).rstrip("/")
    for entry in storage.children(path):
        if entry.is_dir and entry.name.startswith("log_date="):
            for _ in range(RETRIES):
                if merge_day(spark, path, entry.name, schema, most):
                    done += 1
                    break
                known = read_manifests(spark, path)
                if sum(map(known.live, parts(storage, entry.path))) <= most:
                    break
    return done


def drop_replaced(spark: SparkSession, path: str) -> int:
    """Delete the files that merges have replaced, once nobody reads them any more; how many there were.

    The manifests stay, as their numbers and the files they add are still asked for.
    """
    storage = Storage(spark)
    path = storage.qualify(path).rstrip("/")
    known = read_manifests(spark, path)
    gone = [
        f"{entry.path}/{name}"
        for entry in storage.children(path)
        if entry.is_dir and entry.name.startswith("log_date=")
        for name in parts(storage, entry.path)
        if name in known.replaced
    ]
    storage.delete_all(gone)
    return len(gone)


def live_files(spark: SparkSession, path: str) -> int:
    storage = Storage(spark)
    path = storage.qualify(path).rstrip("/")
    known = read_manifests(spark, path)
    days = [e.path for e in storage.children(path) if e.is_dir and e.name.startswith("log_date=")]
    return sum(known.live(name) for day in days for name in parts(storage, day))


def read_merged(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All rows of the log, each once, whatever merges have done to its files."""
    return spark.read.schema(schema).parquet(path).where(read_manifests(spark, path).rows())

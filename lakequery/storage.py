"""Paths on the cluster's file system, through the Hadoop client Spark already has."""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyarrow import fs as pafs
from pyspark.sql import SparkSession


# Schemes whose directories can be renamed as one metadata operation.
CHEAP_RENAME = ("file", "hdfs", "viewfs", "abfs", "abfss", "ofs")
CALLS_IN_FLIGHT = 32


@dataclass(frozen=True)
class Entry:
    """One child of a directory."""

    path: str
    is_dir: bool

    @property
    def name(self) -> str:
        return self.path.rstrip("/").rsplit("/", 1)[-1]


class Storage:
    """The few file-system calls the sinks need, for any scheme Spark can reach."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _resolve(self, path: str):
        hadoop_path = self._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path.getFileSystem(self._conf), hadoop_path

    def qualify(self, path: str) -> str:
        """The path with its scheme, as executors must see it."""
        fs, p = self._resolve(path)
        return fs.makeQualified(p).toString()

    def beside(self, path: str, suffix: str) -> str:
        """A new name in the same directory, which readers of that directory skip."""
        parent, name = path.rstrip("/").rsplit("/", 1)
        return f"{parent}/_{name}.{uuid.uuid4().hex}.{suffix}"

    def exists(self, path: str) -> bool:
        fs, p = self._resolve(path)
        return fs.exists(p)

    def is_file(self, path: str) -> bool:
        fs, p = self._resolve(path)
        return fs.exists(p) and fs.getFileStatus(p).isFile()

    def is_empty(self, path: str) -> bool:
        """Whether there is nothing to append to: no path, an empty file or a folder without parts."""
        fs, p = self._resolve(path)
        if not fs.exists(p):
            return True
        status = fs.getFileStatus(p)
        if status.isFile():
            return status.getLen() == 0
        return all(entry.name.startswith(("_", ".")) for entry in self.children(path))

    def size(self, path: str) -> int:
        """Bytes under a file or directory; 0 when it does not exist."""
        fs, p = self._resolve(path)
        return fs.getContentSummary(p).getLength() if fs.exists(p) else 0

    def children(self, path: str) -> list[Entry]:
        fs, p = self._resolve(path)
        if not fs.exists(p):
            return []
        return sorted(
            (Entry(s.getPath().toString(), s.isDirectory()) for s in fs.listStatus(p)),
            key=lambda entry: entry.path,
        )

    def delete(self, path: str) -> None:
        fs, p = self._resolve(path)
        if fs.exists(p) and not fs.delete(p, True):
            raise OSError(f"could not delete {path}")

    def delete_all(self, paths: list[str]) -> None:
        """Delete many paths; each call waits on the store, so several are in flight."""
        with ThreadPoolExecutor(CALLS_IN_FLIGHT) as pool:
            list(pool.map(self.delete, paths))

    def rename_all(self, moves: dict[str, str]) -> None:
        with ThreadPoolExecutor(CALLS_IN_FLIGHT) as pool:
            list(pool.map(self.rename, moves.keys(), moves.values()))

    def renames_cheaply(self, path: str) -> bool:
        """Whether renaming a directory is one metadata operation, not a copy of its data."""
        return self._resolve(path)[0].getScheme() in CHEAP_RENAME

    def rename(self, source: str, target: str) -> None:
        fs, src = self._resolve(source)
        dst = self._jvm.org.apache.hadoop.fs.Path(target)
        fs.mkdirs(dst.getParent())
        if not fs.rename(src, dst):
            raise OSError(f"could not rename {source} to {target}")

    def write_text(self, path: str, text: str) -> None:
        """Create or replace a small file."""
        fs, p = self._resolve(path)
        stream = fs.create(p, True)
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> bool:
        """Create a small file only if there is none; whether this call made it."""
        fs, p = self._resolve(path)
        try:
            stream = fs.create(p, False)
        except Py4JJavaError as error:
            if fs.exists(p):
                return False
            raise error
        try:
            stream.write(bytearray(text.encode("utf-8")))
        finally:
            stream.close()
        return True


def open_filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """For Python code in tasks: the file system of a qualified path as Spark prints it."""
    return pafs.FileSystem.from_uri(quote(re.sub("^s3[an]://", "s3://", path), safe="/:@"))


_made: list[str] = []


def clear_scratch(spark: SparkSession) -> None:
    """Delete the scratch tables this process made; frames that read them must be finished."""
    storage = Storage(spark)
    while _made:
        storage.delete(_made.pop())


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh path in a folder the cluster shares, for tables that cut lineage.

    ``spark.checkpoint.dir`` names that folder; where it is unset the warehouse serves, which every
    executor must reach as well.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/lakequery/{label}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Delete one scratch table whose frames are finished."""
    Storage(spark).delete(path)
    if path in _made:
        _made.remove(path)

"""Types of a stream's columns, found batch by batch and only ever widened.

What has been seen of a column merges over batches as it does over rows, so a batch's flags are kept beside its
row count and every batch is written under the types that hold all values up to it. Parts written under narrower
types stay as they are; a reader takes the parts of each set of types apart and widens them.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakequery.functions.encode import quoted
from lakequery.operators.infer import BIG, BOOL, FLAGS, FLOAT64, INT64, SPARK_TYPES, UTF8, seen_classes
from lakequery.sinks.formats import ORC, ExportError
from lakequery.storage import Storage

Seen = dict[str, dict]


def classes_of(rows: DataFrame, json_col: str, names: list[str]) -> Seen:
    """What one batch shows of each column; nothing for a column without values."""
    found = {row["key"]: row for row in seen_classes(rows, json_col).collect()}  # a row per column
    return {
        name: {**{flag: found[name][flag] for flag in FLAGS}, "first": found[name]["first"]}
        for name in names
        if name in found
    }


def merged(earlier: Seen, later: Seen) -> Seen:
    """What two runs of rows show together; the first value is that of the earlier run."""
    out = dict(earlier)
    for name, more in later.items():
        known = out.get(name)
        out[name] = more if known is None else {
            **{flag: known[flag] or more[flag] for flag in FLAGS},
            "first": known["first"] if known["first"] is not None else more["first"],
        }
    return out


def types_of(seen: Seen, names: list[str]) -> dict[str, str]:
    """The narrowest type that holds all that was seen of each column."""

    def kind(of: dict | None) -> str:
        if of is None or of["other"] or (of["flag"] and of["number"]) or of["first"] == BIG:
            return UTF8
        return BOOL if of["flag"] else FLOAT64 if of["wide"] else INT64 if of["whole"] else UTF8

    return {name: kind(seen.get(name)) for name in names}


def label_of(types: dict[str, str]) -> str:
    """A short name of a set of types, for the names of the parts that have them."""
    return hashlib.sha256(json.dumps(list(types.items())).encode()).hexdigest()[:12]


def widened(value: Column, kind: str, to: str) -> Column:
    return value if kind == to else value.cast(SPARK_TYPES[to])


def read_inferred(spark: SparkSession, path: str, file_format: str) -> DataFrame:
    """All rows an export stream with inferred types has stored in ``path``, under the types that hold them all.

    A number whose column turned to text is spelled as the stored number is. Only one row per set of types, of which
    there are few as types only widen, comes to the driver.
    """
    queries = [e.path for e in Storage(spark).children(path) if e.name.startswith("_stream-")]
    if not queries:
        raise ExportError(f"{path} holds no export of a stream")
    record = "batch_id long, classes string, types string"
    manifests = spark.read.schema(record).json([f"{query}/manifests" for query in queries])
    query = F.regexp_extract(F.col("_metadata.file_path"), "_stream-([^/]+)/", 1).alias("query")
    batches = manifests.where("types IS NOT NULL").select(query, "*")
    last = F.max(F.struct("batch_id", "types"))
    kept = batches.groupBy("query").agg(last["types"].alias("final"), F.collect_set("types").alias("all")).collect()
    frames = []
    for row in kept:
        final = dict(json.loads(row["final"]))
        for types in sorted(row["all"]):
            kinds = dict(json.loads(types))
            schema = T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind in kinds.items()])
            parts = spark.read.schema(schema).option("pathGlobFilter", f"part-{row['query']}-*-{label_of(kinds)}-*")
            part = (parts.orc if file_format == ORC else parts.parquet)(path)
            frames.append(part.select(*[widened(quoted(n), kinds[n], final[n]).alias(n) for n in final]))
    if not frames:
        raise ExportError(f"the streams that wrote {path} did not infer types")
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out

"""Benchmark decontamination by greedy string tiling.

Shared seeds, hashed runs of ``MIN_TILE`` words, join documents with benchmark items. A pair goes on only if its
seeds could cover enough of the item. Tiling then marks, again and again, the longest matches of words
not yet marked, found by running Karp-Rabin hashes at halving lengths; reordered passages are covered
by several tiles. A document is contaminated by an item whose words its tiles cover to a threshold.

The only thing sent to all tasks is a filter of fixed size over the seeds of the benchmark. The pairs
come from a join on seeds, in which rows that stand for one document are already distinct.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import map_columns, spark_schema, stored

MIN_TILE = 5
MIN_COVERAGE = 0.6
# Bits of the seed filter, whatever the size of the benchmark; two per seed.
FILTER_BITS = 1 << 25
BUCKET_BITS = 32768
# A document's candidate items are dealt into so many parts.
ITEM_PARTS = 64

WORD = re.compile(r"\w+")
# An odd multiplier for hashes modulo 2 to the 64.
BASE = np.uint64(0x9E3779B97F4A7C15)
TILED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("item_id", pa.int64()),
        ("tiles", pa.string()),
        ("n_tiles", pa.int32()),
        ("covered", pa.int32()),
        ("n_words", pa.int32()),
        ("coverage", pa.float64()),
    ]
)


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def hashed(words: list[str]) -> np.ndarray:
    known: dict[str, int] = {}
    for word in words:
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def windows(values: np.ndarray, length: int) -> np.ndarray:
    """Rolling hashes of every run of ``length`` values, modulo 2 to the 64."""
    n = len(values) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(length):
        out = out * BASE + values[k : k + n]
    return out ^ (out >> np.uint64(29))


def seeds_of(text: str | None, length: int) -> np.ndarray:
    return np.unique(windows(hashed(words_of(text)), length))


def filter_places(seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mixed = seeds * BASE
    return (mixed >> np.uint64(39)).astype(np.int64), ((mixed >> np.uint64(5)) & np.uint64(FILTER_BITS - 1)).astype(np.int64)


def tiles_of(document: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (start in document, start in item, length), longest first.

    Each pass looks for matches of unmarked words at one length by Karp-Rabin: it hashes all unmarked
    runs of the item, looks up those of the document, extends what is equal as far as it goes and marks
    the longest matches first. If some match is much longer than the length, the pass is repeated at
    that length; otherwise the length halves, down to ``least``.
    """
    marked_d, marked_i = np.zeros(len(document), bool), np.zeros(len(item), bool)
    found: list[tuple[int, int, int]] = []
    length = max(least, min(len(document), len(item)))
    while length >= least:
        matches = _matches(document, item, marked_d, marked_i, length)
        if matches and matches[0][2] > 2 * length:
            length = matches[0][2]
            continue
        for d, i, n in matches:
            if marked_d[d : d + n].any() or marked_i[i : i + n].any():
                continue
            marked_d[d : d + n] = marked_i[i : i + n] = True
            found.append((d, i, n))
        # What overlaps a tile may still hold a free run of this length, so look once more.
        if not any(n >= length for _, _, n in matches):
            length = length // 2 if length // 2 >= least else least if length > least else 0
    return found


def _matches(document: np.ndarray, item: np.ndarray, marked_d: np.ndarray, marked_i: np.ndarray, length: int) -> list:
    hashes_d, hashes_i = windows(document, length), windows(item, length)
    free_d = _free(marked_d, length)
    free_i = np.flatnonzero(_free(marked_i, length))
    order = free_i[np.argsort(hashes_i[free_i], kind="stable")]
    keys = hashes_i[order]
    candidates = np.flatnonzero(free_d & np.isin(hashes_d, keys))
    out = []
    for d in candidates.tolist():
        for i in order[np.searchsorted(keys, hashes_d[d], "left") : np.searchsorted(keys, hashes_d[d], "right")].tolist():
            # Only where the match starts: the words before differ, are marked or are not there.
            if d and i and document[d - 1] == item[i - 1] and not marked_d[d - 1] and not marked_i[i - 1]:
                continue
            most = min(len(document) - d, len(item) - i)
            stop = (document[d : d + most] != item[i : i + most]) | marked_d[d : d + most] | marked_i[i : i + most]
            n = int(stop.argmax()) if stop.any() else most
            if n >= length:
                out.append((d, i, n))
    return sorted(out, key=lambda m: (-m[2], m[0], m[1]))


def _free(marked: np.ndarray, length: int) -> np.ndarray:
    """Where a run of ``length`` unmarked words starts."""
    if len(marked) < length:
        return np.zeros(0, bool)
    sums = np.concatenate([[0], np.cumsum(marked)])
    return sums[length:] == sums[:-length]


def items_of(benchmark: DataFrame) -> DataFrame:
    """item_id and text of the items that can be looked for; null, empty and repeated rows drop out."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return rows.where(F.col("item_id").isNotNull() & (F.length("text") > 0)).dropDuplicates()


def item_seeds(items: DataFrame, least: int) -> DataFrame:
    """item, its word count, seed and how often it has that. Items shorter than a tile have one seed of their own."""
    schema = pa.schema(
        [
            ("item", pa.int64()),
            ("n_words", pa.int32()),
            ("size", pa.int32()),
            ("seed", pa.list_(pa.int64())),
            ("times", pa.list_(pa.int64())),
        ]
    )

    def run(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in schema.names}
        for item, text in zip(c["item"], c["text"]):
            words = words_of(text)
            if words:
                size = min(least, len(words))
                seeds, times = np.unique(windows(hashed(words), size), return_counts=True)
                values = (item, len(words), size, seeds.view(np.int64).tolist(), times.tolist())
                for name, value in zip(schema.names, values):
                    out[name].append(value)
        return out

    lists = map_columns(items, schema, run).withColumn("both", F.explode(F.arrays_zip("seed", "times")))
    return lists.select("item", "n_words", "size", "both.seed", "both.times")


def seed_filter(seeds: DataFrame) -> np.ndarray:
    """A bit array of fixed size with two bits set for every seed; the driver gets at most 4 MB."""
    schema = pa.schema([("place", pa.int64())])

    def run(c: dict[str, list]) -> dict[str, list]:
        places = filter_places(np.array(c["seed"], np.int64).view(np.uint64))
        return {"place": np.unique(np.concatenate(places)).tolist()}

    places = map_columns(seeds.select("seed"), schema, run)
    bucket = F.floor(F.col("place") / BUCKET_BITS)
    parts = places.groupBy(bucket.alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("place") % BUCKET_BITS).alias("bits")
    )
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in parts.collect():
        at = row.bucket * BUCKET_BITS // 8
        bits[at : at + BUCKET_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    return bits


def _holds(bits: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    one, two = filter_places(seeds)
    return ((bits[one >> 3] >> (one & 7).astype(np.uint8)) & (bits[two >> 3] >> (two & 7).astype(np.uint8)) & 1).astype(bool)


def document_seeds(rows: DataFrame, bits: np.ndarray, sizes: list[int]) -> DataFrame:
    """Row id, words and distinct seeds that pass the filter, of the rows that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out: tuple[list, list, list] = ([], [], [])
            for row_id, text in zip(ids, texts):
                values = hashed(words_of(text))
                seeds = np.unique(np.concatenate([windows(values, size) for size in sizes]))
                seeds = seeds[_holds(bits, seeds)]
                if len(seeds):
                    for column, value in zip(out, (row_id, values.tobytes(), seeds.view(np.int64).tolist())):
                        column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.binary()), pa.array(out[2], pa.list_(pa.int64()))],
                    names=["doc_id", "words", "seeds"],
                )

    return rows.mapInArrow(run, "doc_id bigint, words binary, seeds array<bigint>")


def find_leaks(
    spark: SparkSession,
    docs: DataFrame,
    benchmark: DataFrame,
    least: int = MIN_TILE,
    coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """One row per contaminated document and the item it holds.

    Columns: doc_id, item_id, tiles (start in document:start in item:length in words, comma-joined),
    n_tiles, covered, n_words (of the item) and coverage. Words are runs of word characters in lower
    case. Null and empty texts, and rows without an id, are never contaminated; rows that repeat a
    doc_id count as one document each and give one row for their best. Items of fewer words than a tile
    must occur whole.
    """
    # An item is known by a number of its own, as texts may share an id.
    items = stored(spark, items_of(benchmark).withColumn("item", F.monotonically_increasing_id()), "items")
    seeds = stored(spark, item_seeds(items, least), "item-seeds")
    sizes = sorted(row["size"] for row in seeds.select("size").distinct().collect())
    if not sizes:
        return spark.createDataFrame([], spark_schema(TILED))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = rows.where("doc_id IS NOT NULL AND text IS NOT NULL")
    seeded = document_seeds(known, seed_filter(seeds), sizes)
    # A row is known by a number of its own, as ids may repeat.
    numbered = stored(spark, seeded.withColumn("row", F.monotonically_increasing_id()), "seeded")
    hits = numbered.select("row", F.explode("seeds").alias("seed"))
    pairs = hits.join(seeds, "seed").groupBy("row", "item").agg(
        F.sum("times").alias("shared"), F.first("n_words").alias("n_words"), F.first("size").alias("size")
    )
    # Each occurrence of a shared seed covers at most ``size`` words of the item.
    likely = pairs.where(F.col("shared") * F.col("size") >= coverage * F.col("n_words")).select("row", "item")
    item_words = map_columns(
        items,
        pa.schema([("item", pa.int64()), ("item_id", pa.int64()), ("item_words", pa.binary())]),
        lambda c: {"item": c["item"], "item_id": c["item_id"], "item_words": [hashed(words_of(t)).tobytes() for t in c["text"]]},
    )
    # The pairs of a document stay together up to a bound, so that its words travel once a pack.
    packed = (
        likely.join(item_words, "item")
        .groupBy("row", F.pmod(F.xxhash64("item"), F.lit(ITEM_PARTS)).alias("part"))
        .agg(F.collect_list(F.struct("item_id", "item_words")).alias("items"))
        .drop("part")
    )
    paired = packed.join(numbered.select("row", "doc_id", "words"), "row").select("doc_id", "words", "items")

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                document = np.frombuffer(row["words"], np.uint64)
                for entry in row["items"]:
                    item = np.frombuffer(entry["item_words"], np.uint64)
                    tiles = tiles_of(document, item, min(least, len(item)))
                    covered = sum(n for _, _, n in tiles)
                    if covered >= coverage * len(item):
                        said = ",".join(f"{d}:{i}:{n}" for d, i, n in tiles)
                        out.append((row["doc_id"], entry["item_id"], said, len(tiles), covered, len(item), covered / len(item)))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), TILED.types)], schema=TILED)

    tiled = paired.mapInArrow(tile, spark_schema(TILED))
    best = F.struct("coverage", F.struct("tiles", "n_tiles", "covered", "n_words").alias("rest"))
    return (
        tiled.groupBy("doc_id", "item_id")
        .agg(F.max(best).alias("best"))
        .select("doc_id", "item_id", "best.rest.*", "best.coverage")
    )


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Rows keep all columns; those without an id stay."""
    leaks = find_leaks(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    marked = leaks.select(F.col("doc_id").alias("leaked_doc_id")).distinct()
    return docs.join(marked, docs["doc_id"].cast("long") == marked["leaked_doc_id"], "left_anti")

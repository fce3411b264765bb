"""Near-duplicate documents by circulant MinHash, banding and exact verification.

A document's set is its distinct runs of five words. One permutation scatters the set over the places
of a circle; a second, shifted by k places, gives signature coordinate k as the least value it takes on
the set. All coordinates of a shingle thus lie next to each other in one table of permuted values.

Documents of equal sets are one class, known by its smallest doc_id. Classes that agree in a band meet
in a bucket. First each class is verified against the smallest one it meets, which connects large groups
by as many comparisons as they have members, then, in two rounds, against one leader of each other component
it meets that the sketch does not rule out. Whatever bucket then still holds several components
has its remaining pairs across components verified, after a sketch has ruled out those far from the
threshold and counts modulo two those that surely differ in too many shingles. Links are confirmed on
full sets; components follow by label propagation.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import cache
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import spark_schema, stored, text_slices

WORDS = 5
# Similarity of 75 in 100, held exactly in whole numbers.
PERCENT = 75
# 60 bands of 6 coordinates meet at similarity 0.75 but for one pair in 100,000.
BANDS, ROWS = 60, 6
COORDINATES = BANDS * ROWS
# Places on the circle, a power of two.
CIRCLE = 1 << 18
# The sketch: four bits of each of 352 coordinates, 16 to a word. At similarity 0.75 such bits agree in 0.7656 of the
# coordinates, 269.5, with a standard deviation under 8; the cut lies six of them below, at a similarity of about 0.6.
SKETCH_WORDS = 22
MIN_EQUAL = 222
# Bits of a set's parities: which shares of the hash range hold an odd number of its shingles. Bits that differ are never
# more than the shingles that only one set has, and hardly fewer in sets of up to about 500.
PARITY_BITS = 2048
# Shingles of the members that meet a leader in one group.
GROUP_SHINGLES = 40_000
# Signatures of texts seen before that a task keeps, as copies of one text lie in many tasks.
KEPT_SIGNATURES = 2048
# Rounds in which members try one leader of each other component they meet, before all that is left is compared.
LEADER_ROUNDS = 2

# What separates words.
SPACES = re.compile("[\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_shingles", pa.int64()),
        ("same", pa.binary()),
        ("bands", pa.list_(pa.int64())),
        ("sketch", pa.list_(pa.int64())),
    ]
)


def words_of(text: str | None) -> list[str]:
    return [word for word in SPACES.split((text or "").translate(LOWER)) if word]


def shingles(text: str | None) -> np.ndarray:
    """The distinct 64-bit hashes of the text's five-word runs, in order; of all words if fewer."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    known: dict[str, int] = {}
    for word in words:
        if word not in known:
            known[word] = xxhash.xxh3_64_intdigest(word)
    values = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    size = min(WORDS, len(values))
    out = np.full(len(values) - size + 1, size, np.uint64)
    for k in range(size):
        out = (out ^ values[k : k + len(out)]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(32)
    return np.unique(out)


@cache
def circle() -> np.ndarray:
    """The second permutation, written on so that every shift is a plain slice."""
    values = np.random.default_rng(17).permutation(CIRCLE).astype(np.uint32)
    return np.concatenate([values, values[:COORDINATES]])


def signature(hashes: np.ndarray) -> np.ndarray:
    """All coordinates: for shift k the least permuted value k places on from the set's places."""
    # The first permutation: an odd multiple modulo the power of two, of hashes that are mixed already.
    places = np.unique((hashes * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - 18)).astype(np.int64)
    shifted = np.lib.stride_tricks.sliding_window_view(circle(), COORDINATES)
    least = np.full(COORDINATES, CIRCLE, np.uint32)
    for at in range(0, len(places), 1024):
        np.minimum(least, shifted[places[at : at + 1024]].min(0), out=least)
    return least


def bands_of(least: np.ndarray) -> list[int]:
    rows = np.ascontiguousarray(least.reshape(BANDS, ROWS))
    salted = np.concatenate([np.arange(BANDS, dtype=np.uint32)[:, None], rows], 1)
    return [xxhash.xxh3_64_intdigest(row.tobytes()) - (1 << 63) for row in salted]


def sketch_of(least: np.ndarray) -> list[int]:
    """The top four bits of each mixed coordinate, 16 coordinates to a word."""
    mixed = least[: 16 * SKETCH_WORDS].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(60)
    shifts = np.arange(0, 64, 4, dtype=np.uint64)
    return np.bitwise_or.reduce(mixed.reshape(SKETCH_WORDS, 16) << shifts, axis=1).view(np.int64).tolist()


def parities_of(hashes: np.ndarray) -> list[int]:
    """For each share of the hash range whether it holds an odd number of the set, 64 shares to a word."""
    shares = (hashes * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - (PARITY_BITS.bit_length() - 1))
    odd = np.bincount(shares.astype(np.int64), minlength=PARITY_BITS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def parities_allow(one: Column, other: Column, sizes: Column) -> Column:
    """Whether sets with these sketches, of ``sizes`` shingles together, can reach the similarity by their parities.

    At it, a share of (100 - PERCENT) in (100 + PERCENT) of both sets' shingles is in one of them only.
    """
    one, other = (F.slice(sketch, SKETCH_WORDS + 1, PARITY_BITS // 64) for sketch in (one, other))
    words = F.zip_with(one, other, lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    differing = F.aggregate(words, F.lit(0), lambda total, n: total + n)
    return (100 + PERCENT) * differing <= (100 - PERCENT) * sizes


def sketches_agree(one: Column, other: Column) -> Column:
    """Whether enough coordinates have equal bits."""
    lowest = F.lit(0x1111111111111111)
    differing = F.lit(0)
    for k in range(SKETCH_WORDS):
        x = one[k].bitwiseXOR(other[k])
        folded = x.bitwiseOR(F.shiftrightunsigned(x, 1))
        folded = folded.bitwiseOR(F.shiftrightunsigned(folded, 2)).bitwiseAND(lowest)
        differing = differing + F.bit_count(folded)
    return 16 * SKETCH_WORDS - differing >= MIN_EQUAL


def signed(docs: DataFrame) -> DataFrame:
    """Set size, set digest, band keys and sketch (with the parities behind it) of each row; the empty set has no bands."""

    def sign(text: str) -> tuple:
        hashes = shingles(text)
        same = hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
        if not len(hashes):
            return 0, same, [], []
        least = signature(hashes)
        return len(hashes), same, bands_of(least), sketch_of(least) + parities_of(hashes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, tuple] = {}
        for batch in batches:
            for part in text_slices(batch, 1):
                rows = []
                for text in part.column(1).to_pylist():
                    key = xxhash.xxh3_128_digest(text or "")
                    if key not in known:
                        if len(known) >= KEPT_SIGNATURES:
                            known.pop(next(iter(known)))
                        known[key] = sign(text)
                    rows.append(known[key])
                columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(SIGNED)[1:])]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema=SIGNED)

    return docs.mapInArrow(run, spark_schema(SIGNED))


def shingle_sets(texts: DataFrame) -> DataFrame:
    """doc_id and the full set of each text (doc_id, text), as the bytes of its hashes in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1):
                sets = [shingles(text).tobytes() for text in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.binary())], names=["doc_id", "hashes"])

    return texts.mapInArrow(run, "doc_id bigint, hashes binary")


def verified(spark: SparkSession, edges: DataFrame, sets: DataFrame, sizes: DataFrame, label: str) -> DataFrame:
    """Of candidate pairs (a, b), each once, those whose full sets reach the similarity.

    Members b that meet leader a are dealt into groups of bounded size; each group reads its leader
    once. ``sets`` has doc_id and hashes of every class, ``sizes`` doc_id and n_shingles.
    """
    weighed = edges.join(sizes.withColumnRenamed("doc_id", "b"), "b")
    parts = F.greatest(F.lit(1), F.ceil(F.sum("n_shingles") / GROUP_SHINGLES)).alias("parts")
    counted = stored(spark, weighed.groupBy("a").agg(parts), f"{label}-leaders")
    members = (
        edges.join(counted, "a")
        .withColumn("part", F.pmod(F.xxhash64("b"), F.col("parts")))
        .join(sets.select(F.col("doc_id").alias("b"), "hashes"), "b")
        .select("a", "part", "b", "hashes")
    )
    parts_of = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    leaders = counted.join(sets.select(F.col("doc_id").alias("a"), "hashes"), "a").select(
        "a", parts_of, F.lit(None).cast("long").alias("b"), "hashes"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A group's leader comes first, as its b is null, and then its members one by one.
        own = np.zeros(0, np.uint64)
        for batch in batches:
            close: list[tuple[int, int]] = []
            for a, b, hashes in zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), batch.column("hashes")):
                found = np.frombuffer(hashes.as_buffer(), np.uint64)
                if b is None:
                    own = found.copy()
                elif similar(own, found):
                    close.append((a, b))
            if close:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*close)], names=["a", "b"])

    grouped = leaders.unionByName(members).repartition("a", "part").sortWithinPartitions("a", "part", F.asc_nulls_first("b"))
    return stored(spark, grouped.mapInArrow(run, "a bigint, b bigint"), f"{label}-links")


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= PERCENT * (len(one) + len(other) - shared)


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """id and component (its smallest id) of everything in ``edges`` (a, b).

    Alternating rounds link each node's larger neighbours, and then its smaller ones, to the least id
    around, until every node hangs on its component's least id; rounds grow with the logarithm of the
    longest chain. Each round is written to the shared folder. Stars are counted in pieces, so a hub
    needs no single task.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current = stored(spark, pairs, "edges")
    if current.isEmpty():
        return current.select(F.col("a").alias("id"), F.col("b").alias("component"))
    # The alternation is known to settle, in rounds that grow with the logarithm of the nodes; nothing ends it before.
    for level in count():
        both = current.unionAll(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(least.select("a", F.least("a", "m").alias("m")), "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .where("a <> b")
            .distinct()
        )
        large = stored(spark, large, f"large-{level}")
        heads = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(heads, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
            .select("e.a", "e.b")
            .where("a <> b")
            .distinct()
        )
        small = stored(spark, small, f"small-{level}")
        # Done when it is a set of stars that another round would leave alone.
        hubs = small.select(F.col("b").alias("a")).distinct()
        twice = small.groupBy("a").count().where("count > 1")
        if small.join(hubs, "a", "left_semi").select("a").union(twice.select("a")).isEmpty():
            return small.select(F.col("a").alias("id"), F.col("b").alias("component"))
        current = small


def _merged(spark: SparkSession, labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (id, component) with the components that ``links`` (a, b) tie together made one.

    Only the graph between components is looked at, which shrinks from step to step.
    """
    between = _named(links, labels).select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    tied = components(spark, between).select(F.col("id").alias("component"), F.col("component").alias("into"))
    joined = labels.join(tied, "component", "left")
    return stored(spark, joined.select("id", F.coalesce("into", "component").alias("component")), "labels")


def find_classes(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs``.

    A document without words is linked with nothing. Rows without an id have no component and are kept.
    Rows that repeat a doc_id share what is kept; where their texts differ, links of either text count.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    made = stored(spark, signed(rows), "signed")
    known = made.where("doc_id IS NOT NULL AND n_shingles > 0")
    # Equal sets are one class; its bands and sketch are those of any member.
    classes = stored(
        spark,
        known.groupBy("same").agg(
            F.min("doc_id").alias("id"),
            F.first("n_shingles").alias("n_shingles"),
            F.first("bands").alias("bands"),
            F.first("sketch").alias("sketch"),
        ),
        "classes",
    )
    buckets = classes.select("id", F.explode("bands").alias("bucket"))
    leaders = buckets.groupBy("bucket").agg(F.min("id").alias("leader"), F.max("id").alias("last")).where("leader < last")
    shared = stored(spark, buckets.join(leaders.select("bucket", "leader"), "bucket"), "buckets")
    members = shared.select("id").distinct()
    wanted = members.select(F.col("id").alias("doc_id"))
    sets = stored(spark, shingle_sets(rows.join(wanted, "doc_id", "left_semi")), "candidates")
    sizes = classes.select(F.col("id").alias("doc_id"), "n_shingles")

    # The smallest leader that each class meets connects most; others are tried where it has not.
    met = shared.where("id <> leader").groupBy(F.col("id").alias("b")).agg(F.min("leader").alias("a"))
    first = stored(spark, _comparable(met, sizes), "first")
    links = verified(spark, first, sets, sizes, "first")
    labels = _merged(spark, members.withColumn("component", F.col("id")), links)
    traits = classes.select("id", "n_shingles", "sketch")
    tried = first
    for level in range(LEADER_ROUNDS):
        others = stored(spark, _unmet(shared, labels, traits, tried), f"others-{level}")
        if others.isEmpty():
            break
        labels = _merged(spark, labels, verified(spark, others, sets, sizes, f"others-{level}"))
        tried = tried.unionByName(others)
    across = _across(spark, shared, labels, traits)
    final = _merged(spark, labels, verified(spark, across, sets, sizes, "across"))
    placed = made.join(classes.select("same", "id"), "same", "left")
    placed = placed.join(final, "id", "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id"))
    component = component.otherwise(F.coalesce("component", "id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def _unmet(shared: DataFrame, labels: DataFrame, traits: DataFrame, tried: DataFrame) -> DataFrame:
    """Members and the first member of a bucket in another component that their traits allow, without those tried.

    Of each other component a member tries one; what that leaves apart is compared in ``_across``.
    """
    named = shared.select("bucket", "id").join(labels, "id")
    mixed = (
        named.groupBy("bucket")
        .agg(F.min(F.struct("id", "component")).alias("head"), F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("bucket", F.col("head.id").alias("a"), F.col("head.component").alias("of_a"))
    )
    heads = mixed.join(traits.select(_trait_columns("a")), "a")
    met = named.select("bucket", F.col("id").alias("b"), "component").join(traits.select(_trait_columns("b")), "b")
    pairs = met.join(heads, (met["bucket"] == heads["bucket"]) & (F.col("component") != F.col("of_a")) & _close("a", "b"))
    pairs = pairs.select("a", "b", "of_a").distinct().join(tried, ["a", "b"], "left_anti")
    return pairs.groupBy("b", "of_a").agg(F.min("a").alias("a")).select("a", "b")


def _trait_columns(name: str) -> list[Column]:
    return [F.col("id").alias(name), F.col("n_shingles").alias(f"size_{name}"), F.col("sketch").alias(f"sketch_{name}")]


def _close(one: str, other: str) -> Column:
    """Whether size, sketch and parities leave it open that the sets reach the similarity."""
    sizes, sketches = ([F.col(f"{trait}_{name}") for name in (one, other)] for trait in ("size", "sketch"))
    return _sizes_allow(*sizes) & sketches_agree(*sketches) & parities_allow(*sketches, sizes[0] + sizes[1])


def _named(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs with the components of their ends so far."""
    a = labels.select(F.col("id").alias("a"), F.col("component").alias("of_a"))
    b = labels.select(F.col("id").alias("b"), F.col("component").alias("of_b"))
    return pairs.join(a, "a").join(b, "b")


def _comparable(pairs: DataFrame, sizes: DataFrame) -> DataFrame:
    """Pairs whose set sizes alone do not rule the similarity out."""
    a = sizes.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("size_a"))
    b = sizes.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("size_b"))
    return pairs.join(a, "a").join(b, "b").where(_sizes_allow(F.col("size_a"), F.col("size_b"))).select("a", "b")


def _sizes_allow(a: Column, b: Column) -> Column:
    return 100 * F.least(a, b) >= PERCENT * F.greatest(a, b)


def _across(spark: SparkSession, shared: DataFrame, labels: DataFrame, traits: DataFrame) -> DataFrame:
    """Pairs of one bucket but different components that their traits allow.

    Of each bucket all but its largest component are joined to all of it: a pair across components has
    a side outside the largest one, so nothing is lost, and a large group alone makes no pairs.
    """
    named = shared.select("bucket", "id").join(labels, "id")
    counts = named.groupBy("bucket", "component").count()
    largest = counts.groupBy("bucket").agg(
        F.max(F.struct("count", "component")).alias("top"), F.count("*").alias("components")
    )
    mixed = largest.where("components > 1").select("bucket", F.col("top.component").alias("largest"))
    inside = stored(spark, named.join(mixed, "bucket").join(traits, "id"), "mixed")
    left = inside.where(F.col("component") != F.col("largest")).select("bucket", F.col("component").alias("cx"), *_trait_columns("x"))
    right = inside.select("bucket", F.col("component").alias("cy"), *_trait_columns("y"))
    pairs = left.join(right, (left["bucket"] == right["bucket"]) & (F.col("cx") != F.col("cy")) & _close("x", "y"))
    return pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group stays, the one with the smallest doc_id. Rows keep all columns."""
    gone = find_classes(spark, docs).where(~F.col("kept")).select(F.col("doc_id").alias("gone_doc_id")).distinct()
    return docs.join(gone, docs["doc_id"].cast("long") == gone["gone_doc_id"], "left_anti")

"""Nearest neighbours by randomly rotated one-bit codes with error bounds.

Every vector belongs to the list of its nearest centroid and is coded by the signs of its rotated,
normalised difference from it. From the packed signs and two scalars a task estimates the distance of
a query to every vector of a block, with bounds on the error of the estimate; only vectors whose lower
bound is within the k-th upper bound are measured exactly, on the original vectors. A query first
searches its own list; the distance of its k-th find then rules out every other list that is too far
away as a whole (triangle inequality), and the rest are searched.

Lists are cut into blocks of bounded size, so a list may hold any share of the rows. Of identical
vectors only the k + 1 smallest ids can be results, so the others leave before anything is measured.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakequery.llm.common import stored

# Sizes of the sample and of the table of centroids fitted on it, and of blocks.
SAMPLE_ROWS = 8192
MAX_LISTS = 1024
ROWS_PER_LIST = 2048
BLOCK_ROWS = 4096
PACK_QUERIES = 256
# How many standard errors the bounds allow for. At 3 about one in 400 bounds fails by chance.
SIGMAS = 3.0
K = 10

BLOCK = "list int, chunk int, ids binary, vectors binary, codes binary, norms binary, dots binary, radius double"
FOUND = pa.schema(
    [("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())]
)


@dataclass
class Coder:
    """Centroids and a random rotation; small, and the same in every task."""

    centroids: np.ndarray
    rotation: np.ndarray

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        squares = (self.centroids**2).sum(1)
        return (squares - 2 * vectors @ self.centroids.T).argmin(1)

    def residual(self, vectors: np.ndarray, lists: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
        """Rotated unit differences from the centroids, and their lengths."""
        difference = vectors - self.centroids[lists]
        norms = np.sqrt((difference**2).sum(1))
        unit = difference / np.where(norms > 0, norms, 1)[:, None]
        return unit @ self.rotation.T, norms


def fit(sample: np.ndarray, lists: int, seed: int = 5) -> Coder:
    """Centroids by k-means on the sample, and a rotation from a seeded normal matrix."""
    rng = np.random.default_rng(seed)
    centroids = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)].copy()
    for _ in range(8):
        near = ((centroids**2).sum(1) - 2 * sample @ centroids.T).argmin(1)
        counts = np.bincount(near, minlength=len(centroids))
        sums = np.zeros_like(centroids)
        np.add.at(sums, near, sample)
        filled = counts > 0
        centroids[filled] = sums[filled] / counts[filled, None]
    dimension = sample.shape[1]
    rotation, r = np.linalg.qr(rng.normal(size=(dimension, dimension)))
    return Coder(centroids, rotation * np.sign(np.diag(r)))


def usable(vector: Column) -> Column:
    """Neither null nor zero, and every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def vectors_of(rows: DataFrame) -> DataFrame:
    """vec_id and vec of the rows that take part: usable, of a known id and the commonest length."""
    clean = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vec"))
    clean = clean.where(F.col("vec_id").isNotNull() & usable(F.col("vec")))
    sizes = clean.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return clean.where(F.size("vec") == (sizes["size"] if sizes else 0))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def coded(rows: DataFrame, coder: Coder) -> DataFrame:
    """Each vector's list, code and correction scalars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            vectors = matrix(batch.column("vec"))
            lists = coder.nearest(vectors)
            unit, norms = coder.residual(vectors, lists)
            codes = np.packbits(unit > 0, axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id"),
                    pa.array(lists, pa.int32()),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    pa.array([c.tobytes() for c in codes], pa.binary()),
                    pa.array(norms),
                    pa.array(np.abs(unit).sum(1) / math.sqrt(vectors.shape[1])),
                ],
                names=["vec_id", "list", "vec", "code", "norm", "dot"],
            )

    return rows.mapInArrow(run, "vec_id bigint, list int, vec binary, code binary, norm double, dot double")


def index_blocks(rows: DataFrame) -> DataFrame:
    """Coded vectors packed into rows of at most about ``BLOCK_ROWS`` vectors of one list."""
    sizes = rows.groupBy("list").count().withColumnRenamed("count", "rows")
    salted = rows.join(F.broadcast(sizes), "list").withColumn(
        "chunk", F.pmod(F.xxhash64("vec_id"), F.ceil(F.col("rows") / BLOCK_ROWS)).cast("int")
    )

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("vec_id")
        return pd.DataFrame(
            {
                "list": frame["list"].iloc[:1],
                "chunk": frame["chunk"].iloc[:1],
                "ids": [frame["vec_id"].to_numpy(np.int64).tobytes()],
                "vectors": [b"".join(frame["vec"])],
                "codes": [b"".join(frame["code"])],
                "norms": [frame["norm"].to_numpy().tobytes()],
                "dots": [frame["dot"].to_numpy().tobytes()],
                "radius": [float(frame["norm"].max())],
            }
        )

    return salted.drop("rows").groupBy("list", "chunk").applyInPandas(run, BLOCK)


def packs(asked: DataFrame, chunks: DataFrame) -> DataFrame:
    """Questions (list, query_id, vec, far) packed per list, one copy for every chunk of the list."""
    counted = asked.join(asked.groupBy("list").agg(F.count("*").alias("asked")), "list")
    salted = counted.withColumn("pack", F.pmod(F.xxhash64("query_id"), F.ceil(F.col("asked") / PACK_QUERIES)))

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("query_id")
        return pd.DataFrame(
            {
                "list": frame["list"].iloc[:1],
                "query_ids": [frame["query_id"].to_numpy(np.int64).tobytes()],
                "query_vectors": [b"".join(frame["vec"])],
                "fars": [frame["far"].to_numpy(float).tobytes()],
            }
        )

    packed = salted.select("list", "pack", "query_id", "vec", "far").groupBy("list", "pack").applyInPandas(
        run, "list int, query_ids binary, query_vectors binary, fars binary"
    )
    return packed.join(chunks, "list")


def search_block(block: dict, coder: Coder, k: int) -> Iterator[tuple[int, int, float]]:
    """The best k of a block for each question of a pack: query_id, vec_id and exact distance."""
    dimension = coder.rotation.shape[0]
    ids = np.frombuffer(block["ids"], np.int64)
    vectors = np.frombuffer(block["vectors"]).reshape(len(ids), dimension)
    codes = np.frombuffer(block["codes"], np.uint8).reshape(len(ids), -1)
    norms, dots = np.frombuffer(block["norms"]), np.frombuffer(block["dots"])
    query_ids = np.frombuffer(block["query_ids"], np.int64)
    queries = np.frombuffer(block["query_vectors"]).reshape(len(query_ids), dimension)
    fars = np.frombuffer(block["fars"])
    unit, query_norms = coder.residual(queries, block["list"])
    # Inner products of the query with the sign vectors, from the set bits and the query's own sum.
    bits = np.unpackbits(codes, axis=1, count=dimension).astype(np.float32)
    signs = (2 * (unit.astype(np.float32) @ bits.T) - unit.sum(1)[:, None]) / math.sqrt(dimension)
    safe = np.where(dots > 0, dots, 1)
    estimate = signs / safe
    spread = SIGMAS * np.sqrt(np.maximum(0, 1 - safe**2)) / safe / math.sqrt(max(1, dimension - 1)) + 1e-6
    for q in range(len(query_ids)):
        scale = 2 * norms * query_norms[q]
        middle = norms**2 + query_norms[q] ** 2 - scale * estimate[q]
        slack = scale * spread + 1e-9 * (1 + np.abs(middle))
        own = ids == query_ids[q]
        upper = np.where(own, np.inf, middle + slack)
        limit = fars[q] ** 2 * (1 + 1e-9)
        if len(upper) > k:
            limit = min(limit, np.partition(upper, k - 1)[k - 1])
        rows = np.flatnonzero((middle - slack <= limit) & ~own)
        distances = np.sqrt(((vectors[rows] - queries[q]) ** 2).sum(1))
        for at in np.lexsort((ids[rows], distances))[:k]:
            yield int(query_ids[q]), int(ids[rows[at]]), float(distances[at])


def found_in(blocks: DataFrame, questions: DataFrame, coder: Coder, k: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                found = list(search_block(row, coder, k))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), FOUND.types)] if found else [pa.array([], t) for t in FOUND.types], schema=FOUND)

    return blocks.join(questions, ["list", "chunk"]).mapInArrow(run, "query_id bigint, vec_id bigint, score double")


def ranked(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def nearest(spark: SparkSession, rows: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """The k nearest of each query among all other rows: query_id, rank, vec_id, score.

    ``rows`` has vec_id and embedding. Vectors that are null, zero, not finite in some component, of
    no id or of another length than most take no part. Rows that repeat id and vector count once;
    equal distances go to the smaller id. Fewer rows than k give fewer results, none give none.
    """
    vectors = stored(spark, vectors_of(rows), "vectors")
    count = vectors.count()
    share = min(1.0, SAMPLE_ROWS / max(1, count))
    picked = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) < F.lit(math.ceil(share * (1 << 30)))
    sample = [row.vec for row in vectors.where(picked).select("vec").limit(2 * SAMPLE_ROWS).collect()]
    if not sample:
        sample = [row.vec for row in vectors.select("vec").limit(1).collect()]
    if not sample:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    coder = fit(np.array(sample), max(1, min(MAX_LISTS, count // ROWS_PER_LIST)))

    same = Window.partitionBy("vec").orderBy("vec_id")
    distinct = (
        vectors.withColumn("copy", F.dense_rank().over(same))
        .where(F.col("copy") <= k + 1)
        .dropDuplicates(["vec", "vec_id"])
        .drop("copy")
    )
    blocks = stored(spark, index_blocks(coded(distinct, coder)), "blocks")
    chunks = blocks.select("list", "chunk")
    radii = {r["list"]: r.radius for r in blocks.groupBy("list").agg(F.max("radius").alias("radius")).collect()}

    asked = coded(vectors.where(is_query).dropDuplicates(["vec_id"]), coder)
    asked = stored(spark, asked.select("list", F.col("vec_id").alias("query_id"), "vec"), "queries")
    # The own list may hold no candidate block when it was emptied of copies; then nothing is ruled out.
    home = stored(
        spark, found_in(blocks, packs(asked.withColumn("far", F.lit(float("inf"))), chunks), coder, k), "home"
    )
    fars = ranked(home, k).where(F.col("rank") == k).select("query_id", F.col("score").alias("far"))

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, reach = np.array(sorted(radii)), np.array([radii[x] for x in sorted(radii)])
        for batch in batches:
            for row in batch.to_pylist():
                query = np.frombuffer(row["vec"])
                away = np.sqrt(((coder.centroids[names] - query) ** 2).sum(1))
                near = names[(away - reach <= row["far"] * (1 + 1e-9)) & (names != row["list"])]
                if len(near):
                    n = len(near)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(near, pa.int32()), pa.array([row["query_id"]] * n, pa.int64()), pa.array([row["vec"]] * n, pa.binary()), pa.array([row["far"]] * n, pa.float64())],
                        names=["list", "query_id", "vec", "far"],
                    )

    bounded = asked.join(fars, "query_id", "left").fillna(float("inf"), ["far"])
    further = bounded.mapInArrow(elsewhere, "list int, query_id bigint, vec binary, far double")
    away = found_in(blocks, packs(further, chunks), coder, k)
    return ranked(home.unionByName(away), k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

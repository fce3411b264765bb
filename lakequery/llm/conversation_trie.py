"""A prefix trie of conversations, with a count-min sketch that keeps unshared tails out of the shuffle.

A prefix is known by its depth and a polynomial digest: the turns' 127-bit digests times rising powers of a
base that is drawn anew for each run, modulo a prime. Such digests add up, so they are computed along the
sorted turns by all tasks at once and joined over the edges of partitions; no conversation, however long,
is ever held together.

All prefixes are counted in a count-min sketch of bounded size. It never counts too little, so a count of one
proves that a prefix belongs to one conversation alone, as do all longer ones of it. Their nodes are written
where they are found. Only prefixes that may be shared are shuffled and grouped exactly. A sketch too small for
its input lets more prefixes pass for shared ones, which costs time and changes nothing.

Sums over subtrees need no walk of the tree. Of the members of a node, that with the smallest id owns it, and
then owns all longer prefixes of its own. A member of a node pays for the turns from there on that it does not
own, and counts a leaf if it owns its own end and nothing goes on from there.
"""

from __future__ import annotations

import hashlib
import secrets as randomness
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import spark_schema, stored
from lakequery.llm.resampling import crc32_sql
from lakequery.operators.numbering import spread_sort

# How conversations are rebuilt: every one begins with turns of the first of its group of five.
GROUP = 5
BORROWED = 9

PRIME = (1 << 127) - 1
DIGEST_BYTES = 16
# The sketch: four rows of counters of one byte that stop at two, at most 16 MB together.
ROWS = 4
LEAST_WIDTH, MOST_WIDTH = 1 << 12, 1 << 22
COUNTERS_PER_PREFIX = 8
BLOCK = 1 << 16
CHUNK_IDS = 4096

RUNNING = pa.schema(
    [
        ("part", pa.int32()),
        ("conv_id", pa.int64()),
        ("index", pa.int64()),
        ("digest", pa.binary()),
        ("running", pa.binary()),
        ("n_bytes", pa.int64()),
        ("before", pa.int64()),
        ("first", pa.bool_()),
        ("last", pa.bool_()),
    ]
)
PREFIX = [
    ("depth", pa.int64()),
    ("digest", pa.binary()),
    ("parent", pa.binary()),
    ("n_bytes", pa.int64()),
    ("before", pa.int64()),
    ("last", pa.bool_()),
]
PREFIXES = pa.schema([("conv_id", pa.int64()), *PREFIX])
HEADS = pa.schema(
    [
        ("conv_id", pa.int64()),
        ("skipped", pa.int64()),
        ("shift", pa.int64()),
        ("byte_shift", pa.int64()),
        ("offset", pa.binary()),
        ("made", pa.list_(pa.struct(PREFIX))),
    ]
)
HEADS_SPARK = (
    "conv_id bigint, skipped bigint, shift bigint, byte_shift bigint, offset binary, made array<struct<"
    "depth: bigint, digest: binary, parent: binary, n_bytes: bigint, before: bigint, last: boolean>>"
)
BLOCKS = pa.schema([("block", pa.int64()), ("counters", pa.binary())])
CHUNKS = pa.schema([("depth", pa.int64()), ("digest", pa.binary()), ("first", pa.int64()), ("text", pa.string())])
ENDS = pa.schema([("depth", pa.int64()), ("digest", pa.binary()), ("ends_sha256", pa.string())])
NODE = ["depth", "digest"]
NO_ENDS = hashlib.sha256(b"").hexdigest()


def number_of(digest: bytes) -> int:
    return int.from_bytes(digest, "big") % PRIME


def digest_of(number: int) -> bytes:
    return number.to_bytes(DIGEST_BYTES, "big")


def sorted_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, a digest of role and text, and the text's bytes, in the order of conversations and turns.

    Turns with one number stand in the order of their roles, then of their digests.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    told_apart = F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    digest = F.unhex(F.substring(F.sha2(told_apart, 256), 1, 2 * DIGEST_BYTES))
    slim = rows.select("conv_id", "turn", "role", digest.alias("digest"), F.octet_length("text").cast("long").alias("n_bytes"))
    return spread_sort(slim, ["conv_id", "turn", "role", "digest"]).select("conv_id", "digest", "n_bytes")


def running_digests(spark: SparkSession, turns: DataFrame, base: int) -> DataFrame:
    """Turns with what has run up to them since their conversation began in their partition, stored."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, held = TaskContext.get().partitionId(), None, None
        index, total, power, before, opening = 0, 0, 1, 0, True
        out: list[tuple] = []
        for batch in batches:
            for conv_id, digest, n_bytes in zip(*(column.to_pylist() for column in batch.columns)):
                if held is not None:
                    out.append((*held, conv_id != conv))
                if conv_id != conv:
                    opening = conv is None
                    conv, index, total, power, before = conv_id, 0, 0, 1, 0
                total = (total + number_of(digest) * power) % PRIME
                held = (part, conv, index, digest, digest_of(total), n_bytes, before, opening)
                index, power, before = index + 1, power * base % PRIME, before + n_bytes
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), RUNNING)], schema=RUNNING)
                out = []
        if held is not None:  # whether the conversation goes on is for the next partition to say
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((*held, None), RUNNING)], schema=RUNNING)

    return stored(spark, turns.mapInArrow(task, spark_schema(RUNNING)), "trie-running")


def carried(spark: SparkSession, running: DataFrame, base: int) -> DataFrame:
    """For each partition: what its first conversation brings from earlier ones, and whether its last one ends there.

    The driver sees one row per partition: its last one.
    """
    tails = running.where("last IS NULL").select("part", "conv_id", "index", "running", "n_bytes", "before", "first")
    firsts = running.where("first AND index = 0").select("part", F.col("conv_id").alias("opens"))
    parts = sorted(tails.join(firsts, "part").collect())
    rows, conv, count, total, size = [], None, 0, 0, 0
    for k, tail in enumerate(parts):
        brought = conv == tail["opens"]
        n, poly, n_bytes = (count, total, size) if brought else (0, 0, 0)
        ends = k + 1 == len(parts) or parts[k + 1]["opens"] != tail["conv_id"]
        rows.append((tail["part"], tail["opens"], n, digest_of(poly), n_bytes, ends))
        if not tail["first"]:  # its last conversation began in it
            n, poly, n_bytes = 0, 0, 0
        conv, count = tail["conv_id"], n + tail["index"] + 1
        total = (poly + pow(base, n, PRIME) * number_of(tail["running"])) % PRIME
        size = n_bytes + tail["before"] + tail["n_bytes"]
    return spark.createDataFrame(
        rows, "part int, opens bigint, n_carried bigint, carried binary, bytes_carried bigint, ends boolean"
    )


def whole_turns(running: DataFrame, carries: DataFrame) -> DataFrame:
    """Turns with their index in their whole conversation; ``carries`` has one row per partition."""
    joined = running.join(F.broadcast(carries), "part")
    own = F.col("conv_id") == F.col("opens")
    return joined.select(
        "conv_id",
        (F.col("index") + F.when(own, F.col("n_carried")).otherwise(F.lit(0))).alias("index"),
        "digest",
        "running",
        "n_bytes",
        (F.col("before") + F.when(own, F.col("bytes_carried")).otherwise(F.lit(0))).alias("before"),
        F.coalesce("last", "ends").alias("last"),
        F.when(own, F.col("n_carried")).otherwise(F.lit(0)).alias("n_carried"),
        F.when(own, F.col("carried")).alias("carried"),
    )


def borrowed(spark: SparkSession, turns: DataFrame, base: int) -> DataFrame:
    """One row per conversation: its prefixes made of borrowed turns, and how its own later turns continue them.

    At most BORROWED turns of a conversation meet here.
    """
    few = turns.where(F.col("index") < BORROWED).select("conv_id", F.struct("index", "digest", "n_bytes").alias("turn"))
    heads = few.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("own"))
    # The length is the CRC's, and nothing is borrowed from oneself.
    named = heads.withColumn("lender", F.col("conv_id") - F.col("conv_id") % GROUP).withColumn(
        "skipped", F.when(F.col("lender") == F.col("conv_id"), F.lit(0)).otherwise(F.crc32(F.col("conv_id").cast("string")) % BORROWED)
    )
    lenders = heads.where(F.col("conv_id") % GROUP == 0).select(F.col("conv_id").alias("lender"), F.col("own").alias("lent"))
    pairs = named.join(lenders, "lender", "left").select("conv_id", "skipped", "own", "lent")

    def sums(turns: list[dict]) -> tuple[list[int], list[int]]:
        digests, sizes = [0], [0]
        for k, turn in enumerate(turns):
            digests.append((digests[-1] + number_of(turn["digest"]) * pow(base, k, PRIME)) % PRIME)
            sizes.append(sizes[-1] + turn["n_bytes"])
        return digests, sizes

    def one(conv_id: int, skipped: int, own: list[dict], lent: list[dict] | None) -> tuple:
        taken = (lent or [])[:skipped]
        digests, sizes = sums(taken)
        own_digests, own_sizes = sums(own[:skipped])
        shift = len(taken) - skipped
        ended = len(own) <= skipped
        made = [
            {
                "depth": d,
                "digest": digest_of(digests[d]),
                "parent": digest_of(digests[d - 1]) if d else None,
                "n_bytes": taken[d - 1]["n_bytes"] if d else 0,
                "before": sizes[d - 1] if d else 0,
                "last": ended and d == len(taken),
            }
            for d in range(len(taken) + 1)
        ]
        offset = (digests[-1] - pow(base, shift, PRIME) * own_digests[-1]) % PRIME
        return conv_id, skipped, shift, sizes[-1] - own_sizes[-1], digest_of(offset), made

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = [one(*row) for row in zip(*(column.to_pylist() for column in batch.columns))]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), HEADS)], schema=HEADS)

    return stored(spark, pairs.mapInArrow(task, HEADS_SPARK), "trie-heads")


def all_prefixes(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """One row per rebuilt conversation and depth, stored."""
    base = randomness.randbelow(PRIME - 2) + 2
    running = running_digests(spark, sorted_turns(conversations), base)
    turns = whole_turns(running, carried(spark, running, base))
    heads = borrowed(spark, turns, base)
    made = heads.select("conv_id", F.inline("made"))
    later = turns.join(heads.drop("made"), "conv_id").where("index >= skipped")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers: dict[int, int] = {}
        for batch in batches:
            rows = batch.to_pydict()
            digests, parents, depths = [], [], []
            for index, digest, run, n, brought, shift, offset in zip(
                rows["index"], rows["digest"], rows["running"], rows["n_carried"], rows["carried"], rows["shift"], rows["offset"]
            ):
                total = number_of(run)
                if n:
                    total += pow(base, n, PRIME) * total - total + number_of(brought)
                if shift not in powers:
                    powers[shift] = pow(base, shift, PRIME)
                made_up = (number_of(offset) + powers[shift] * total) % PRIME
                depth = index + 1 + shift
                digests.append(digest_of(made_up))
                parents.append(digest_of((made_up - number_of(digest) * pow(base, depth - 1, PRIME)) % PRIME))
                depths.append(depth)
            if depths:
                before = [b + s for b, s in zip(rows["before"], rows["byte_shift"])]
                made_of = [rows["conv_id"], depths, digests, parents, rows["n_bytes"], before, rows["last"]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(made_of, PREFIXES)], schema=PREFIXES)

    return stored(spark, made.unionByName(later.mapInArrow(task, spark_schema(PREFIXES))), "trie-prefixes")


def places(digests: pa.Array, depths: np.ndarray, width: int) -> np.ndarray:
    """Where each row of the sketch counts a prefix: an array of ROWS lines."""
    quarters = np.frombuffer(b"".join(digests.to_pylist()), ">u4").reshape(-1, 4).astype(np.uint64)
    mixed = (quarters + depths.astype(np.uint64)[:, None]) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(32)) & np.uint64(width - 1)).astype(np.int64).T + np.arange(ROWS)[:, None] * width


def sketch_of(spark: SparkSession, prefixes: DataFrame) -> np.ndarray:
    """Counters of all prefixes that stop at two; merged block by block, at most ROWS * MOST_WIDTH bytes."""
    wanted = COUNTERS_PER_PREFIX * prefixes.count()
    width = min(max(1 << max(wanted - 1, 1).bit_length(), LEAST_WIDTH), MOST_WIDTH)
    size = min(BLOCK, width)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketch = np.zeros(ROWS * width, np.uint8)
        for batch in batches:
            if batch.num_rows:
                where, n = np.unique(places(batch.column(1), batch.column(0).to_numpy(), width), return_counts=True)
                sketch[where] = np.minimum(sketch[where] + np.minimum(n, 2), 2)
        blocks = sketch.reshape(-1, size)
        full = np.flatnonzero(blocks.any(axis=1))
        for k in full:
            yield pa.RecordBatch.from_pydict({"block": [int(k)], "counters": [blocks[k].tobytes()]}, schema=BLOCKS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held = None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"block": [at], "counters": [held.tobytes()]}, schema=BLOCKS)

        for batch in batches:
            for block, counters in zip(batch.column(0).to_pylist(), batch.column(1)):
                more = np.frombuffer(counters.as_buffer(), np.uint8)
                if block == at:
                    held = np.minimum(held + more, 2)
                else:
                    if at is not None:
                        yield done()
                    at, held = block, more
        if at is not None:
            yield done()

    parts = prefixes.select("depth", "digest").mapInArrow(count, spark_schema(BLOCKS))
    merged = parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, spark_schema(BLOCKS))
    sketch = np.zeros((ROWS * width // size, size), np.uint8)
    for row in merged.collect():
        sketch[row["block"]] = np.frombuffer(row["counters"], np.uint8)
    return sketch.reshape(ROWS, width)


def screened(spark: SparkSession, prefixes: DataFrame, sketch: np.ndarray) -> DataFrame:
    """Prefixes with ``single`` and ``parent_single``: whether the sketch proves them unshared."""
    width, sent = sketch.shape[1], spark.sparkContext.broadcast(sketch.reshape(-1))
    schema = PREFIXES.append(pa.field("single", pa.bool_())).append(pa.field("parent_single", pa.bool_()))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = bytes(DIGEST_BYTES)
        for batch in batches:
            if not batch.num_rows:
                continue
            depth = batch.column(1).to_numpy()
            own = sent.value[places(batch.column(2), depth, width)].min(axis=0) == 1
            above = sent.value[places(batch.column(3).fill_null(nothing), depth - 1, width)].min(axis=0) == 1
            above &= depth > 0
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own | above), pa.array(above)], schema=schema)

    return prefixes.mapInArrow(task, spark_schema(schema))


def end_hashes(ends: DataFrame) -> DataFrame:
    """depth, digest and the SHA-256 of the rising, comma-joined conv_ids of each node in ``ends``.

    Ids are sorted by all tasks at once, so one node may fill many partitions, and leave as texts of thousands
    of ids. The texts of a node are then hashed one after the other as they come, none kept.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids, out = None, [], []
        for batch in batches:
            for depth, digest, conv_id in zip(*(column.to_pylist() for column in batch.columns)):
                if ids and (node != (depth, digest) or len(ids) == CHUNK_IDS):
                    out.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                node = (depth, digest)
                ids.append(conv_id)
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), CHUNKS)], schema=CHUNKS)
                out = []
        if ids:
            last = (*node, ids[0], ",".join(map(str, ids)))
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, CHUNKS)], schema=CHUNKS)

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha, out = None, None, []
        for batch in batches:
            for depth, digest, text in zip(*(column.to_pylist() for column in batch.columns)):
                if node == (depth, digest):
                    sha.update(b"," + text.encode())
                    continue
                if node is not None:
                    out.append((*node, sha.hexdigest()))
                node, sha = (depth, digest), hashlib.sha256(text.encode())
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), ENDS)], schema=ENDS)
                out = []
        if node is not None:
            last = (*node, sha.hexdigest())
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(last, ENDS)], schema=ENDS)

    ids = spread_sort(ends.select(*NODE, "conv_id"), [*NODE, "conv_id"], unique=True)
    texts = ids.mapInArrow(join, spark_schema(CHUNKS)).repartition(*NODE).sortWithinPartitions(*NODE, "first")
    return texts.select(*NODE, "text").mapInArrow(hashed, spark_schema(ENDS))


def finished(conv_id: Column, ends: Column) -> Column:
    """The hash of a node that only ``conv_id`` can end in."""
    return F.when(ends, F.sha2(conv_id.cast("string"), 256)).otherwise(F.lit(NO_ENDS))


def prefix_trie(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations, all long but the last column: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Every conv_id is rebuilt from the first turns of the first conversation of its group and its own later ones; one
    whose turns are all left out is a member of the root only. Rows without a conv_id belong to no conversation and are
    left out; null roles and texts are empty, null turns come first. Turns that share a number stand in the order of role
    and text digest, and repeated rows are so many turns. Remainders take the sign of the id. Texts of any length count
    whole; an empty table has no node, not even a root. Other columns are not read.
    """
    prefixes = all_prefixes(spark, conversations)
    marked = stored(spark, screened(spark, prefixes, sketch_of(spark, prefixes)), "trie-screened")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    goes_on = F.when(F.col("last"), none).otherwise(one)
    alone = [one.alias("n_convs"), goes_on.alias("n_children"), one.alias("n_leaves"), none.alias("saved_tokens")]
    alone.append(finished(F.col("conv_id"), F.col("last")).alias("ends_sha256"))
    tails = marked.where("parent_single").select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *alone)

    tops = marked.where("single AND NOT parent_single")
    shared = marked.where("NOT single")
    grouped = shared.groupBy(*NODE).agg(
        F.max("parent").alias("parent"), F.count("*").alias("n_convs"), F.min("conv_id").alias("owner")
    )
    grouped = stored(spark, grouped, "trie-grouped")
    above = F.struct((F.col("depth") - 1).alias("depth"), F.col("parent").alias("digest")).alias("above")
    children = grouped.select(above).union(tops.select(above)).where("above.depth >= 0").groupBy("above").agg(F.count("*").alias("n"))
    children = children.select("above.depth", "above.digest", F.col("n").alias("n_children"))
    nodes = grouped.join(children, NODE, "left").withColumn("n_children", F.coalesce("n_children", none))
    # Stored, so that both sides of the next join come straight from files: then a node with very many members is split.
    nodes = stored(spark, nodes, "trie-nodes")

    members = shared.drop("single", "parent_single", "parent").join(nodes.select(*NODE, "owner", "n_children"), NODE)
    members = stored(spark, members, "trie-members")
    owned = F.col("owner") == F.col("conv_id")
    paid = members.groupBy("conv_id").agg(
        F.sum(F.when(owned, none).otherwise(F.col("n_bytes"))).alias("unowned"),
        F.max("last").alias("ends_here"),
        F.max(F.col("last") & owned & (F.col("n_children") == 0)).alias("leaf_here"),
    )
    # What ends beyond the shared prefixes ends in a leaf of its own.
    paid = paid.select("conv_id", "unowned", F.when(~F.col("ends_here") | F.col("leaf_here"), one).otherwise(none).alias("leaf"))
    below = members.join(paid, "conv_id").groupBy(*NODE).agg(
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.col("unowned") - F.col("before"), none)).alias("saved_tokens"),
    )
    owners = grouped.select((F.col("depth") + 1).alias("depth"), F.col("digest").alias("parent"), F.col("owner").alias("parent_conv_id"))
    # A parent that is not among the grouped ones was proved to be single: it is the node's own conversation.
    whole = (
        nodes.join(below, NODE)
        .join(end_hashes(members.where("last")), NODE, "left")
        .join(owners, ["depth", "parent"], "left")
        .select(
            F.col("owner").alias("conv_id"),
            "depth",
            F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "owner")).alias("parent_conv_id"),
            "n_convs",
            "n_children",
            "n_leaves",
            "saved_tokens",
            F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
        )
    )
    first_alone = tops.join(owners, ["depth", "parent"], "left").select(
        "conv_id", "depth", F.when(F.col("depth") > 0, F.coalesce("parent_conv_id", "conv_id")).alias("parent_conv_id"), *alone
    )
    return whole.union(first_alone).union(tails)


def oracle_sql() -> str:
    return f"""
    WITH own AS (
      SELECT conv_id, coalesce(role, '') AS r, coalesce(text, '') AS t,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k
      FROM conversations WHERE conv_id IS NOT NULL
    ),
    convs AS (SELECT conv_id, {crc32_sql('conv_id::VARCHAR')} % {BORROWED} AS h FROM (SELECT DISTINCT conv_id FROM own)),
    rebuilt AS (
      SELECT c.conv_id, k AS place, r, t FROM convs c JOIN own o ON o.conv_id = c.conv_id - c.conv_id % {GROUP} AND k <= h
      UNION ALL
      SELECT conv_id, k + {BORROWED}, r, t FROM convs JOIN own USING (conv_id) WHERE k > h
    ),
    prefixes AS MATERIALIZED (
      SELECT conv_id, 0 AS depth, '' AS path, 0 AS n_bytes FROM convs
      UNION ALL
      SELECT conv_id, row_number() OVER w, string_agg(md5(length(r) || ':' || r || t), '') OVER w, octet_length(encode(t))
      FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)
    ),
    nodes AS MATERIALIZED (
      SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(n_bytes) AS n_bytes FROM prefixes GROUP BY path, depth
    ),
    ends AS (
      SELECT path, string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) AS ids
      FROM (SELECT conv_id, max(depth) AS depth FROM prefixes GROUP BY conv_id) JOIN prefixes USING (conv_id, depth) GROUP BY path
    ),
    children AS (SELECT left(path, 32 * (depth - 1)) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
    below AS (
      SELECT a.path, count(*) FILTER (c.n_children IS NULL) AS n_leaves, sum((b.n_convs - 1) * b.n_bytes) AS saved_tokens
      FROM nodes a JOIN nodes b ON b.path[: length(a.path)] = a.path AND b.depth >= a.depth
      LEFT JOIN children c ON c.path = b.path
      GROUP BY a.path
    )
    SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
      saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
    FROM nodes n JOIN below USING (path)
    LEFT JOIN children c ON c.path = n.path LEFT JOIN ends e ON e.path = n.path
    LEFT JOIN nodes p ON n.depth > 0 AND p.path = left(n.path, 32 * (n.depth - 1)) AND p.depth = n.depth - 1
    """

"""Target-distribution importance resampling over hashed runs of words, with a head-tail vocabulary.

Every run of one to ``max_words`` words falls into the bucket of its CRC-32. What a bucket gains is the
logarithm of its share in the target over its share in the corpus; a document's weight is the sum of
the gains of its runs, and documents are drawn without replacement by weight plus Gumbel noise.

A scan of the whole corpus finds the words (and, for longer runs, the pairs) that occur most. Their exact
CRC states are sent to all tasks: a frequent run is one look-up, any other is computed from the states of
its words. Which runs are frequent changes the time only, never a bucket. Buckets are kept per document,
two or four bytes a run, so the text is not read again for totals and weights, and totals are exact sums.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import SLICE_BYTES, spark_schema, stored, text_slices
from lakequery.operators.numbering import number_rows

BUCKETS = 10_000
MAX_WORDS = 1
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
# What is sent to all tasks: so many frequent runs, none longer than so many bytes, at most 6 MB.
HEAD_RUNS = 1 << 16
HEAD_BYTES = 64
# Counters a task holds while it looks for frequent runs.
TASK_RUNS = 1 << 15

COUNTED = pa.schema([("run", pa.binary()), ("n", pa.int64())])
TOTALS = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])
BAGS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("bag", pa.binary())])
WEIGHTS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def _byte_table() -> bytes:
    """Letters in lower case, digits and all bytes of other scripts as they are, the rest blank."""
    kept = {b for b in range(256) if b >= 0x80 or chr(b).isalnum()}
    return bytes(ord(chr(b).lower()) if b < 0x80 and b in kept else b if b in kept else 0x20 for b in range(256))


TABLE = _byte_table()


def parts_of(text: bytes, bound: int = SLICE_BYTES) -> Iterator[list[bytes]]:
    """The words of a text, a few megabytes of it at a time, cut between words."""
    start = 0
    while len(text) - start > bound:
        cut = text[start : start + bound].translate(TABLE).rfind(b" ")
        end = start + cut + 1 if cut >= 0 else start + bound
        piece = text[start:end].translate(TABLE)
        while cut < 0 and end < len(text):  # one word longer than the bound
            more = text[end : end + bound].translate(TABLE)
            blank = more.find(b" ")
            piece += more if blank < 0 else more[: blank + 1]
            end += len(more) if blank < 0 else blank + 1
            cut = blank
        yield piece.split()
        start = end
    yield text[start:].translate(TABLE).split()


def frequent_runs(texts: DataFrame, max_words: int, head_runs: int = HEAD_RUNS) -> dict[bytes, int]:
    """The CRC states of the words, and of the pairs where runs have two words, that occur most in all ``texts``.

    Each task keeps a bounded summary (what overflows it lowers all counts alike), the sums of which name
    the most frequent ones.
    """
    def lowered(counts: Counter) -> Counter:
        least = sorted(counts.values(), reverse=True)[TASK_RUNS]
        return Counter({run: n - least for run, n in counts.items() if n > least})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for rows in text_slices(batch, 0, SLICE_BYTES):
                for text in rows.column(0).to_pylist():
                    for words in parts_of(text or b""):
                        counts.update(words)
                        if max_words > 1:
                            counts.update(map(b" ".join, zip(words, words[1:])))
                        if len(counts) > 4 * TASK_RUNS:
                            counts = lowered(counts)
        if len(counts) > TASK_RUNS:
            counts = lowered(counts)
        short = [(run, n) for run, n in counts.items() if len(run) <= HEAD_BYTES]
        if short:
            yield pa.RecordBatch.from_pydict({"run": [r for r, _ in short], "n": [n for _, n in short]}, schema=COUNTED)

    summed = texts.mapInArrow(task, spark_schema(COUNTED)).groupBy("run").agg(F.sum("n").alias("n"))
    top = summed.orderBy(F.desc("n"), "run").limit(head_runs).select("run").collect()
    return {bytes(row["run"]): crc32(row["run"]) for row in top}


class Hasher:
    """Buckets of runs of words: frequent ones looked up, the rest from the CRC states of what they begin with."""

    def __init__(self, head: dict[bytes, int], max_words: int, buckets: int):
        self.head, self.max_words, self.buckets = head, max_words, buckets
        self.kind = np.uint16 if buckets <= 1 << 16 else np.uint32

    def single(self, words: list[bytes]) -> list[int]:
        states = list(map(self.head.get, words))
        return [crc32(word) if state is None else state for word, state in zip(words, states)]

    def bag(self, words: list[bytes], before: list[bytes]) -> np.ndarray:
        """Buckets of all runs that end in ``words``; ``before`` are the up to max_words - 1 words in front of them."""
        found = []
        if self.max_words > 1:
            words, skip = [*before, *words], len(before)
        else:
            skip = 0
        states = self.single(words)
        found.append(states[skip:])
        for size in range(2, self.max_words + 1):
            longer = []
            for k, state in enumerate(states[: len(words) - size + 1]):
                last = words[k + size - 1]
                known = self.head.get(words[k] + b" " + last) if size == 2 else None
                longer.append(crc32(last, crc32(b" ", state)) if known is None else known)
            states = longer
            # Runs that end before ``words`` were counted with the part in front.
            found.append(states[max(skip - size + 1, 0) :])
        flat = np.fromiter((state for part in found for state in part), np.uint32, sum(map(len, found)))
        return (flat % np.uint32(self.buckets)).astype(self.kind)

    def of_text(self, text: bytes) -> tuple[int, np.ndarray]:
        bags, before, total = [], [], 0
        for words in parts_of(text):
            bags.append(self.bag(words, before))
            total += len(words)
            before = [*before, *words][-(self.max_words - 1) :] if self.max_words > 1 else []
        return total, bags[0] if len(bags) == 1 else np.concatenate(bags)

    def of_texts(self, texts: list[bytes | None]) -> list[tuple[int, np.ndarray]]:
        """Of a few megabytes of texts; with runs of one word all of them at once."""
        if self.max_words > 1 or len(texts) == 1:
            return [self.of_text(text or b"") for text in texts]
        words = [(text or b"").translate(TABLE).split() for text in texts]
        flat = self.bag([word for own in words for word in own], [])
        ends = np.cumsum([len(own) for own in words])
        return [(len(own), flat[end - len(own) : end]) for own, end in zip(words, ends.tolist())]


def bags_of(rows: DataFrame, hasher: Hasher) -> DataFrame:
    """doc_id, n_words, n_features and the buckets of all runs of each row (doc_id, text as bytes)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, 1, SLICE_BYTES):
                made = hasher.of_texts(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        pa.array([n for n, _ in made], pa.int64()),
                        pa.array([len(bag) for _, bag in made], pa.int64()),
                        pa.array([bag.tobytes() for _, bag in made], pa.binary()),
                    ],
                    schema=BAGS,
                )

    return rows.mapInArrow(task, spark_schema(BAGS))


def bucket_totals(bags: DataFrame, hasher: Hasher) -> np.ndarray:
    """How many runs of all rows fall into each bucket: an array of fixed length."""
    kind, buckets = hasher.kind, hasher.buckets

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(buckets, np.int64)
        for batch in batches:
            for bag in batch.column(0):
                totals += np.bincount(np.frombuffer(bag.as_buffer(), kind), minlength=buckets)
        full = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(full, pa.int64()), pa.array(totals[full], pa.int64())], schema=TOTALS)

    counted = bags.select("bag").mapInArrow(task, spark_schema(TOTALS)).groupBy("bucket").agg(F.sum("n").alias("n"))
    totals = np.zeros(buckets, np.int64)
    for row in counted.collect():
        totals[row["bucket"]] = row["n"]
    return totals


def gains_of(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's share in the target and in the corpus, each with one more run a bucket."""
    n, s_all, t_all = len(corpus), float(corpus.sum()), float(target.sum())
    ratios = [(t + 1.0) * (s_all + n) / ((s + 1.0) * (t_all + n)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(ratio)) for ratio in ratios], np.int64)


def weigh(bags: DataFrame, gains: np.ndarray, kind: type) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weights = [int(gains[np.frombuffer(bag.as_buffer(), kind)].sum()) for bag in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(weights, pa.int64())], schema=WEIGHTS)

    return bags.mapInArrow(task, spark_schema(WEIGHTS))


def resample(
    spark: SparkSession,
    docs: DataFrame,
    target: DataFrame,
    max_words: int = MAX_WORDS,
    buckets: int = BUCKETS,
    min_words: int = MIN_WORDS,
    percent: int = PERCENT,
    seed: int = SEED,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_features, weight, score and rank.

    Of the N rows with at least ``min_words`` words, the ``percent`` of N with the highest scores are drawn and
    ranked from 1, ties to the smaller doc_id; the others' rank is null. Texts are read whole, in parts of a few
    megabytes. A null or empty text has no features, weight 0 and is never drawn; a null id takes part with the
    noise of an empty id and loses ties; rows that repeat an id share its noise, and of equal scores either may
    come first. Without documents there are no rows; without a target only the smoothing remains. Other columns
    are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    aims = target.select(F.lit(0).cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    hasher = Hasher(frequent_runs(rows.select("text"), max_words), max_words, buckets)
    bags = stored(spark, bags_of(rows, hasher), "resampling-bags")
    gains = gains_of(bucket_totals(bags, hasher), bucket_totals(bags_of(aims, hasher), hasher))
    noise_of = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    drawn = F.conv(F.substring(noise_of, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((drawn + 0.5) / 4294967296))).cast("long")
    scored = weigh(bags, gains, hasher.kind).withColumn("score", F.col("weight") + noise)
    scored = stored(spark, scored, "resampling-scores")
    eligible = scored.where(F.col("n_words") >= min_words)
    wanted = eligible.count() * percent // 100
    ordered = eligible.withColumn("falling", -F.col("score")).withColumn("nameless", F.col("doc_id").isNull())
    ranked = number_rows(ordered, ["falling", "nameless", "doc_id"], name="place")
    rank = F.when(F.col("place") < wanted, F.col("place") + 1).cast("long")
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < min_words)
    return ranked.select(*columns, rank.alias("rank")).union(rest.select(*columns, F.lit(None).cast("long").alias("rank")))


def crc32_sql(text: str) -> str:
    """CRC-32 of the bytes of a text, in the SQL engine that checks: four bits at a time, by the usual polynomial."""
    entries = []
    for n in range(16):
        for _ in range(4):
            n = n >> 1 ^ (0xEDB88320 if n & 1 else 0)
        entries.append(str(n))
    table = f"CAST([{', '.join(entries)}] AS BIGINT[])"

    def step(state: str, nibble: str) -> str:
        return f"xor(({state}) >> 4, ({table})[(xor({state}, {nibble}) & 15) + 1])"

    byte = f"('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT"
    whole = f"list_transform(range(0, octet_length(encode({text}))), lambda i: {byte})"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {whole}), lambda a, b: {step(step('a', 'b'), '(b >> 4)')}), 4294967295)"


def oracle_sql() -> str:
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = (
        f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
    WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS n, doc_id, {words} AS words FROM documents),
    found AS MATERIALIZED (SELECT n, unnest(words) AS word FROM docs),
    aims AS MATERIALIZED (SELECT unnest({words}) AS word FROM benchmark),
    hashed AS MATERIALIZED (
      SELECT word, {crc32_sql('word')} % {BUCKETS} AS bucket FROM (SELECT word FROM found UNION SELECT word FROM aims)
    ),
    corpus AS (SELECT bucket, count(*) AS s FROM found JOIN hashed USING (word) GROUP BY bucket),
    target AS (SELECT bucket, count(*) AS t FROM aims JOIN hashed USING (word) GROUP BY bucket),
    totals AS (SELECT (SELECT count(*) FROM found) AS s_all, (SELECT count(*) FROM aims) AS t_all),
    gains AS (
      SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + {BUCKETS})
        / ((coalesce(s, 0) + 1)::DOUBLE * (t_all + {BUCKETS}))))::BIGINT AS gain
      FROM corpus FULL JOIN target USING (bucket), totals
    ),
    weights AS (SELECT n, sum(gain)::BIGINT AS weight FROM found JOIN hashed USING (word) JOIN gains USING (bucket) GROUP BY n),
    scored AS (
      SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
          / 4294967296)))::BIGINT AS score
      FROM docs LEFT JOIN weights USING (n)
    ),
    ranked AS (
      SELECT *, CASE WHEN n_features >= {MIN_WORDS} THEN row_number() OVER (PARTITION BY n_features >= {MIN_WORDS} ORDER BY score DESC, doc_id) END AS place,
        count(*) FILTER (n_features >= {MIN_WORDS}) OVER () AS eligible
      FROM scored
    )
    SELECT doc_id, n_features, weight, score, CASE WHEN place <= eligible * {PERCENT} // 100 THEN place END AS rank FROM ranked
    """

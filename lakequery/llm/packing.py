"""Bound-certified best-fit packing of tokenized documents into fixed-length sequences.

Pieces are dealt into groups of bounded size, and each group is packed by best-fit decreasing. A
group's bin count is held against lower bounds from dual-feasible functions: where they meet, no
packing of those pieces has fewer bins and the group is done. Groups with a gap give up the bins that
hold their free space and are packed again: each round deals the open pieces anew into as many groups of
that size as they fill. Rounds end when one saves no bin; its packing is then dropped for the one before.
What is left between the bins and the bound of all pieces together is logged.
"""

from __future__ import annotations

import logging
import math
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import documents, spark_schema, stored, text_slices

CAPACITY = 4096
END_ID = 1
# Pieces of a group, on average, in every round.
GROUP_PIECES = 2048
# Chunks and parts whose ids a process keeps; a table starts anew at this size.
CACHED_CHUNKS = 700_000
# How much text is tokenized at a time: the more, the more words it has in common.
SLICE_BYTES = 8 << 20
# In the pipeline, whose workers hold what other stages took as well; a slice takes over 20 times its bytes, what is kept
# of a chunk about 200 bytes.
STAGE_SLICE_BYTES = 2 << 20
STAGE_CACHED_CHUNKS = 100_000

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
LOG = logging.getLogger(__name__)
PACKED = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, copy bigint, grp bigint, bin int, offset bigint, open boolean"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkTokenizer:
    """A word tokenizer's ids of whole texts, by way of their distinct chunks.

    The vocabulary's rules never join characters over white space, so the ids of a text are those of
    the chunks between its blanks, in order. Chunks in plain ASCII are cut further at the rules' own
    borders and others before trailing punctuation, so that `word`, `Word` and `word,` share work.
    Each distinct part goes through the tokenizer once a process, until the tables start anew or are dropped.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.whole = Tokenizer.from_file(path)
        # For parts that are already lower-case ASCII and lie between borders: the model alone.
        self.plain = Tokenizer(self.whole.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def _learn(self, tokenizer, parts: list[str]) -> None:
        for part, found in zip(parts, tokenizer.encode_batch_fast(parts, add_special_tokens=False)):
            self.parts[part] = np.array(found.ids, "<u4").tobytes()

    def _fill(self, chunks: list[str]) -> None:
        """Put the ids of chunks that are not known yet into the table."""
        plain: dict[str, list[str]] = {}
        other: dict[str, list[str]] = {}
        for chunk in chunks:
            if chunk.isascii() and chunk.isprintable() and "<|" not in chunk:
                plain[chunk] = BORDERS.findall(chunk.lower())
            else:
                core = chunk.rstrip(PUNCTUATION)
                cut = len(core) < len(chunk) and core[-1:].lower().isalpha() and "<|" not in chunk
                other[chunk] = [core, chunk[len(core) :]] if cut else [chunk]
        for tokenizer, cuts in ((self.plain, plain), (self.whole, other)):
            new = {part for parts in cuts.values() for part in parts if part not in self.parts}
            self._learn(tokenizer, list(new))
            for chunk, parts in cuts.items():
                self.chunks[chunk] = b"".join(map(self.parts.__getitem__, parts))

    def forget(self) -> None:
        """Drop what was learned of chunks, which changes time and memory alone."""
        self.chunks.clear()
        self.parts.clear()

    def encode(self, texts: pa.Array, cached: int = CACHED_CHUNKS) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts in one array, and where each text's begin (and the last ones end).

        A table of more than ``cached`` chunks or parts starts anew, which changes time and memory alone.
        """
        for blank in "\n\r\t":
            texts = pc.replace_substring(texts, blank, " ")
        split = pc.split_pattern(texts, " ")
        coded = split.flatten().dictionary_encode()
        distinct, index = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        known = self.chunks
        for table in (self.chunks, self.parts):
            if len(table) > cached:
                table.clear()
        self._fill([chunk for chunk in distinct if chunk not in known])
        found = [known[chunk] for chunk in distinct]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids = np.frombuffer(b"".join(found), "<u4")
        first = np.cumsum(sizes) - sizes
        lengths = sizes[index]
        ends = np.cumsum(lengths)
        order = np.repeat(first[index] - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        bounds = np.concatenate([[0], ends])[split.offsets.to_numpy() - split.offsets[0].as_py()]
        return ids[order], bounds


# Where the vocabulary's rules cut lower-case ASCII, and ASCII punctuation.
BORDERS = re.compile("'(?:s|t|re|ve|m|ll|d)|[a-z]+|[0-9]|[^a-z0-9]+")
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


@cache
def chunk_tokenizer(path: str) -> ChunkTokenizer:
    return ChunkTokenizer(path)


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """Every document's tokens cut at ``capacity``: doc_id, piece, start, length, ids_crc32.

    About ``slice_bytes`` of text are tokenized at a time, which changes time and memory alone.
    A null or empty text has the end id alone. Null and repeated doc_ids give their pieces as others.
    """
    path = path or tokenizer_path()
    end = np.array([END_ID], "<u4").tobytes()
    # With small slices memory is short.
    short = slice_bytes < SLICE_BYTES
    cached = STAGE_CACHED_CHUNKS if short else CACHED_CHUNKS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in text_slices(batch, 1, slice_bytes):
                out: list[tuple] = []
                # The texts stay in Arrow: only what is new of their chunks becomes Python text.
                every, bounds = chunk_tokenizer(path).encode(pc.fill_null(rows.column(1), ""), cached)
                for doc_id, low, high in zip(rows.column(0).to_pylist(), bounds.tolist(), bounds[1:].tolist()):
                    ids = every[low:high].tobytes() + end
                    for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                        part = ids[at : at + 4 * capacity]
                        out.append((doc_id, piece, at // 4, len(part) // 4, zlib.crc32(part)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), PIECE)], schema=PIECE)
        if short:
            # The worker stays for other tasks, and would keep what this one took.
            chunk_tokenizer(path).forget()
            pa.default_memory_pool().release_unused()

    return documents(docs).mapInArrow(run, spark_schema(PIECE))


def best_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Each item's bin and offset: items by falling length, each into the fullest bin that takes it.

    Bins are found by their free space: bit g of ``free`` is set while some bin has g left.
    """
    bins = np.empty(len(lengths), np.int32)
    offsets = np.empty(len(lengths), np.int64)
    with_free: dict[int, list[int]] = {}
    free, count = 0, 0
    for item in np.argsort(-lengths, kind="stable").tolist():
        length = int(lengths[item])
        fitting = free >> length
        if fitting:
            left = length + (fitting & -fitting).bit_length() - 1
            chosen = with_free[left].pop()
            if not with_free[left]:
                free ^= 1 << left
        else:
            left, chosen = capacity, count
            count += 1
        bins[item], offsets[item] = chosen, capacity - left
        rest = left - length
        if rest:
            with_free.setdefault(rest, []).append(chosen)
            free |= 1 << rest
    return bins, offsets


def lower_bound(lengths: np.ndarray, capacity: int) -> float:
    """The largest of several dual-feasible bounds on the bins that ``lengths`` need, unrounded.

    Each function maps lengths to shares so that no set of items that fits one bin sums to over 1:
    the identity; a threshold function that lifts items over ``capacity - t`` to whole bins and drops
    those under ``t``; and rounding functions that round (k + 1) shares down to k.
    """
    return _bound(*np.unique(lengths, return_counts=True), capacity)


def _bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> float:
    """The same from the different lengths in rising order and how often each occurs."""
    best = float(sizes @ counts) / capacity
    thresholds = np.unique(np.concatenate([sizes[sizes <= capacity // 2], [capacity // 2]]))
    upper, lower = np.cumsum(counts[::-1])[::-1], np.cumsum(sizes * counts)
    for t in thresholds[:: max(1, len(thresholds) // 256)]:
        large = np.searchsorted(sizes, capacity - t, "right")
        first = np.searchsorted(sizes, t, "left")
        whole = upper[large] if large < len(sizes) else 0
        middle = (lower[large - 1] if large else 0) - (lower[first - 1] if first else 0)
        best = max(best, whole + max(0, middle) / capacity)
    for k in range(1, 21):
        share = (k + 1) * sizes
        exact = share % capacity == 0
        value = np.where(exact, sizes / capacity, (share // capacity) / k)
        best = max(best, float(value @ counts))
    return best


def pack_group(frame: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """Pack one group and mark the pieces of the bins that it would exchange."""
    frame = frame.sort_values(["length", "doc_id", "piece", "ids_crc32", "copy"], ascending=False, kind="stable")
    lengths = frame["length"].to_numpy()
    bins, offsets = best_fit_decreasing(lengths, capacity)
    fill = np.bincount(bins, weights=lengths)
    gap = len(fill) - math.ceil(lower_bound(lengths, capacity) - 1e-9)
    # The emptiest bins, until they hold the free space of the gap twice over. Without a gap no packing
    # of this group has fewer bins, and only its emptiest one may still be shared with other groups.
    order = np.argsort(fill, kind="stable")
    spare = np.cumsum(capacity - fill[order])
    open_bins = np.zeros(len(fill), bool)
    open_bins[order[: np.searchsorted(spare, 2 * gap * capacity) + 1]] = True
    open_bins &= fill < capacity
    return frame.assign(bin=bins, offset=offsets, open=open_bins[bins])


def pack(spark: SparkSession, rows: DataFrame, capacity: int = CAPACITY, group: int = GROUP_PIECES) -> DataFrame:
    """Place every piece: the columns of ``rows`` (those of ``pieces``), sequence_id and offset.

    Ties of length go by doc_id and piece, so a rerun task packs alike. Rows may repeat.
    """
    keyed = stored(spark, rows.withColumn("copy", F.monotonically_increasing_id()), "pieces")
    # As many rows as there are different lengths, so at most ``capacity``.
    lengths = np.array(sorted(keyed.groupBy("length").count().collect()), np.int64).reshape(-1, 2)
    bound = math.ceil(_bound(lengths[:, 0], lengths[:, 1], capacity) - 1e-9)
    todo, pieces_left, bins_left = keyed, int(lengths[:, 1].sum()), None
    done: list[DataFrame] = []
    closed_bins, level, before = 0, 0, None
    while True:
        groups = max(1, math.ceil(pieces_left / group))
        place = F.pmod(F.xxhash64("doc_id", "piece", "copy", F.lit(level)), F.lit(groups))
        packed = stored(spark, _packed(todo.withColumn("grp", place), capacity), f"packed-{level}")
        first = F.col("offset") == 0
        found = packed.agg(
            F.count_if(first).alias("bins"),
            F.count_if(first & F.col("open")).alias("open_bins"),
            F.count_if("open").alias("open_pieces"),
        ).first()
        if before is not None and found.bins >= bins_left:
            done.append(before.where("open").withColumn("level", F.lit(level - 1)))
            bins = closed_bins + bins_left
            break
        if found.open_bins < 2 or closed_bins + found.bins <= bound:
            done.append(packed.withColumn("level", F.lit(level)))
            bins = closed_bins + found.bins
            break
        done.append(packed.where(~F.col("open")).withColumn("level", F.lit(level)))
        closed_bins += found.bins - found.open_bins
        before, todo = packed, packed.where("open").drop("grp", "bin", "offset", "open")
        pieces_left, bins_left = found.open_pieces, found.open_bins
        level += 1
    LOG.info("%d bins, lower bound %d, after %d rounds", bins, bound, level + 1)
    whole = done[0]
    for part in done[1:]:
        whole = whole.unionByName(part)
    return whole.select(
        *PIECE.names,
        (F.col("level").cast("long") * (1 << 50) + F.col("grp") * (1 << 20) + F.col("bin")).alias("sequence_id"),
        "offset",
    )


def _packed(rows: DataFrame, capacity: int) -> DataFrame:
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        return pack_group(frame, capacity)[[part.split()[0] for part in PACKED.split(", ")]]

    return rows.groupBy("grp").applyInPandas(run, PACKED)


def pack_documents(spark: SparkSession, docs: DataFrame, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """All documents, tokenized whole and packed: a row per piece with its sequence and offset."""
    return pack(spark, pieces(docs, slice_bytes=slice_bytes))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack_documents(spark, docs, STAGE_SLICE_BYTES)



"""Removal of repeated byte strings by blockwise suffix sorting with a difference cover.

A byte goes if some string of ``LENGTH`` bytes that covers it also starts earlier. Sorting all suffixes
of a corpus is out of reach, so passes over the texts narrow down what is sorted:

1. Each window of ``LENGTH`` bytes has an anchor, its least hashed gram of ``GRAM`` bytes, which depends on
   its bytes alone; equal windows have equal anchors. Neighbouring windows of one anchor are a run. Anchors
   that occur once cannot hold a repeated window. A gram is long enough that unlike texts hardly share one,
   so what is in question does not grow with chance.
2. Runs of equal bytes are repeated as a whole; only the first of each stays in question, and only if
   its anchor also occurs within other bytes.
3. The windows still in question are cut out of their texts and laid side by side in blocks, where they
   are suffixes to be sorted. Within a block they are sorted one bucket of equal first bytes at a time;
   suffixes that agree in their first ``PERIOD`` bytes are put in order by the ranks of a difference-cover
   sample, which are made once a block: for any two suffixes some short shift lands on two sample
   positions whose ranks decide. Equal windows are neighbours in that order.
4. Each block's different windows meet those of other blocks as sorted keys; only windows whose key
   blocks share become rows, and the first place of each decides.

A block is bounded, so memory is too; partial aggregation takes the copies out before each shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import discard, spark_schema, stored
from lakequery.operators.numbering import number_rows

LENGTH = 100
# A multiple of a word's 8 bytes.
GRAM = 40
SPAN = LENGTH - GRAM + 1
BLOCK_BYTES = 2 << 20
# Less where all windows of a block are sorted.
QUESTION_BYTES = 1 << 19
# Windows of a block whose anchors are found at a time, as what that takes is many times their bytes.
CHUNK_WINDOWS = 1 << 16
# Keys of blocks that a task sends on together.
SENT_KEYS = 1 << 20
# Bits of a filter, a fixed size; two filters at most are sent to all tasks.
FILTER_BITS = 1 << 27
BUCKET_BITS = 32768
# A perfect difference set modulo 31; sums of shifts reach 124 bytes, past LENGTH.
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
PAD = 5 * PERIOD + 8
LAST_ID = (1 << 63) - 1

C1, C2, C3 = (np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(32))) * C3
    return values ^ (values >> np.uint64(29))


def folded(words: list[np.ndarray]) -> np.ndarray:
    """The words of each gram as one number, which still has to be mixed."""
    total = words[0].astype(np.uint64)
    for word in words[1:]:
        total *= C1
        total += word.astype(np.uint64, copy=False)
    return total * C2


class Block:
    """Pieces of documents side by side: bytes, and for each window start its document and offset."""

    def __init__(self, pieces: list[tuple[int, int, bytes]]):
        ids, offsets, sizes = (np.array(c, np.int64) for c in ([p[0] for p in pieces], [p[1] for p in pieces], [len(p[2]) for p in pieces]))
        self.lay(ids, offsets, sizes, b"".join(piece for _, _, piece in pieces))

    @classmethod
    def packed(cls, row: dict) -> Block:
        """A block as ``row`` packs it."""
        block = cls.__new__(cls)
        block.lay(*(np.frombuffer(row[name], np.int64) for name in ("ids", "offsets", "sizes")), row["data"])
        return block

    def row(self) -> dict:
        places = {"ids": self.ids, "offsets": self.offsets + self.ends - self.sizes, "sizes": self.sizes}
        return {name: [values.tobytes()] for name, values in places.items()} | {"data": [self.text[: self.size].tobytes()]}

    def lay(self, ids: np.ndarray, offsets: np.ndarray, sizes: np.ndarray, data: bytes) -> None:
        self.text = np.frombuffer(data + bytes(PAD + LENGTH), np.uint8)
        self.words = np.ndarray((len(self.text) - 7,), ">u8", self.text, strides=(1,))
        self.size = len(data)
        self.ids, self.sizes, self.ends = ids, sizes, np.cumsum(sizes)
        self.offsets = offsets - (self.ends - sizes)

    def place(self, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """doc_id and offset in the document of positions of the block."""
        piece = np.searchsorted(self.ends, starts, "right")
        return self.ids[piece], starts + self.offsets[piece]

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Anchor hash, first and last window start of every run."""
        n = self.size - LENGTH + 1
        empty = np.zeros(0, np.int64)
        if n <= 0:
            return np.zeros(0, np.uint64), empty, empty
        anchor = np.empty(n, np.int32)
        for at in range(0, n, CHUNK_WINDOWS):
            anchor[at : at + CHUNK_WINDOWS] = self.anchors(at, min(CHUNK_WINDOWS, n - at))
        for end in self.ends[:-1].tolist():
            anchor[max(0, end - LENGTH + 1) : end] = -1
        cuts = np.flatnonzero(anchor[1:] != anchor[:-1])
        first, last = np.append(0, cuts + 1), np.append(cuts, n - 1)
        at = anchor[first].astype(np.int64)
        first, last, at = first[at >= 0], last[at >= 0], at[at >= 0]
        # An anchor is a least hash, so nearly all begin with zero bits; mixed once more they fill filters and ranges evenly.
        return mixed(mixed(folded([self.words[at + k] for k in range(0, GRAM, 8)])) * C1), first, last

    def starts(self) -> np.ndarray:
        """Where every window begins."""
        sizes = self.sizes - LENGTH + 1
        return np.repeat(self.ends - self.sizes - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())

    def anchors(self, start: int, n: int) -> np.ndarray:
        """Where the leftmost least gram of each of ``n`` windows from ``start`` on begins."""
        size = n + SPAN - 1
        words = self.words[start : start + size + GRAM - 8].astype(np.uint64)
        keys = mixed(folded([words[k : k + size] for k in range(0, GRAM, 8)]))
        # Hash above, place below, least of a sliding span that doubles.
        keys &= np.uint64(~((1 << 24) - 1) & (1 << 64) - 1)
        keys |= np.arange(size, dtype=np.uint64)
        span = 1
        while span < SPAN:
            step = min(span, SPAN - span)
            keys, span = np.minimum(keys[:-step], keys[step:]), span + step
        return (keys & np.uint64((1 << 24) - 1)).astype(np.int32) + np.int32(start)

    def keys(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hashes of runs of windows, of which the first and the last hold all bytes, as a run is no longer than ``SPAN``."""
        return mixed(self.window_key(first, 0) + mixed(self.window_key(last, 1) * C1 + (last - first).astype(np.uint64)) * C2)

    def window_key(self, starts: np.ndarray, kind: int) -> np.ndarray:
        """One of two independent hashes of each whole window."""
        key = np.full(len(starts), (C2, C1)[kind])
        for at in (*range(0, LENGTH - 8, 8), LENGTH - 8):
            word = self.words[starts + at].astype(np.uint64)
            key = mixed((key ^ word) * C2 + np.uint64(at) if kind else key * C1 + word)
        return key


@cache
def shifts() -> np.ndarray:
    """For two positions modulo the period, the least shift that takes both into the cover."""
    cover = np.isin(np.arange(PERIOD), COVER)
    table = np.empty((PERIOD, PERIOD), np.int64)
    for a in range(PERIOD):
        for b in range(PERIOD):
            table[a, b] = next(d for d in range(PERIOD) if cover[(a + d) % PERIOD] and cover[(b + d) % PERIOD])
    return table


def in_order(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The order of rows by their columns, the first one most significant, and which of them begin a group of equal rows.

    Only rows that the columns before leave equal are sorted by the next one.
    """
    order = np.argsort(columns[0])
    ordered = columns[0][order]
    new = np.ones(len(order), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    for column in columns[1:]:
        tied = ~new
        tied[:-1] |= ~new[1:]
        at = np.flatnonzero(tied)
        group, members = np.cumsum(new)[at], order[at]
        values = column[members]
        within = np.lexsort((values, group))
        order[at], values = members[within], values[within]
        new[at[1:]] |= values[1:] != values[:-1]
    return order, new


def names(columns: list[np.ndarray]) -> np.ndarray:
    """Dense ranks of rows by their columns, the first one most significant."""
    order, new = in_order(columns)
    ranks = np.empty(len(order), np.int64)
    ranks[order] = np.cumsum(new)
    return ranks


def sample_ranks(block: Block, starts: np.ndarray) -> np.ndarray:
    """Ranks by 124 bytes of the cover's positions in the first ``PERIOD`` bytes of every start."""
    size = len(block.text)
    covered = np.zeros(size + 1, np.int32)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + 4 * PERIOD, -1)
    sampled = np.resize(np.isin(np.arange(PERIOD), COVER), size)
    inside = np.flatnonzero((np.cumsum(covered[:size], dtype=np.int32) > 0) & sampled)
    inside = inside[inside + PERIOD + 8 <= size]
    ranks = np.zeros(size + 4 * PERIOD, np.int32)
    ranks[inside] = names([block.words[inside + at] for at in (0, 8, 16, PERIOD - 8)])
    for step in (PERIOD, 2 * PERIOD):
        ranks[inside] = names([ranks[inside], ranks[inside + step]])
    return ranks


def settle_ties(items: np.ndarray, groups: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """Each group's items in the order of the sample ranks, by merging runs of all groups at once.

    Items that agree in over ``LENGTH`` bytes may stay in any order, as they are of one class.
    """
    table = shifts()
    base = np.searchsorted(groups, groups, "left")
    size = np.searchsorted(groups, groups, "right") - base
    place = np.arange(len(items)) - base
    width = 1
    while width < (size.max() if len(size) else 0):
        run = place // width
        start = np.minimum((run ^ 1) * width, size)
        low, high = start.copy(), np.minimum(start + width, size)
        right = (run & 1).astype(bool)
        while (searching := low < high).any():
            middle = (low + high) // 2
            other = items[base + np.minimum(middle, size - 1)]
            shift = table[other % PERIOD, items % PERIOD]
            theirs, own = ranks[other + shift], ranks[items + shift]
            before = np.where(right, theirs <= own, theirs < own) & searching
            low = np.where(before, middle + 1, low)
            high = np.where(searching & ~before, middle, high)
        target = base + (run - (run & 1)) * width + (place - run * width) + (low - start)
        items, width = items[np.argsort(target, kind="stable")], 2 * width
    return items


def sorted_classes(block: Block, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The starts in suffix order, and for each the number of its class of equal windows."""
    if not len(starts):
        return starts, starts
    ranks = sample_ranks(block, starts)
    ordered = []
    first = block.text[starts]
    for bucket in np.unique(first):
        members = starts[first == bucket]
        order, new = in_order([block.words[members + at] for at in (0, 8, 16, PERIOD - 8)])
        members = members[order]
        group = np.cumsum(new)
        tied = ~new
        tied[:-1] |= ~new[1:]
        members[tied] = settle_ties(members[tied], group[tied], ranks)
        ordered.append(members)
    whole = np.concatenate(ordered)
    same = np.ones(len(whole) - 1, bool)
    for at in (*range(0, LENGTH - 8, 8), LENGTH - 8):
        word = block.words[whole + at]
        same &= word[1:] == word[:-1]
    return whole, np.concatenate([[0], np.cumsum(~same)])


def blocks_of(batches: Iterator[pa.RecordBatch], bound: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of bounded size; a long document is cut so that each window lies in exactly one piece."""

    def pieces() -> Iterator[tuple[int, int, bytes]]:
        for batch in batches:
            for doc_id, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for start in range(0, max(0, len(data) - LENGTH + 1), bound):
                    yield doc_id, start, data[start : start + bound + LENGTH - 1]

    return gathered(pieces(), bound)


def gathered(pieces: Iterator[tuple[int, int, bytes]], bound: int) -> Iterator[Block]:
    """Blocks of about ``bound`` bytes at most; a larger piece stands alone."""
    held: list[tuple[int, int, bytes]] = []
    size = 0
    for piece in pieces:
        if held and size + len(piece[2]) > bound:
            yield Block(held)
            held, size = [], 0
        held.append(piece)
        size += len(piece[2])
    if held:
        yield Block(held)


def _places(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - 27)).astype(np.int64)


def filter_of(hashes: DataFrame) -> np.ndarray:
    """A bit array of fixed size that holds the column ``g``; the driver gets 16 MB at most."""
    place = F.shiftrightunsigned("g", 64 - 27)
    parts = hashes.groupBy(F.floor(place / BUCKET_BITS).alias("bucket")).agg(
        F.bitmap_construct_agg(place % BUCKET_BITS).alias("bits")
    )
    # Stored first, so that the shuffles behind the hashes leave nothing on disk.
    kept = stored(hashes.sparkSession, parts, "filter")
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    for row in kept.toLocalIterator():
        at = row.bucket * BUCKET_BITS // 8
        bits[at : at + BUCKET_BITS // 8] = np.frombuffer(bytes(row.bits), np.uint8)
    discard(kept)
    return bits


def held_by(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    places = _places(hashes)
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _batch(columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def share_count(spark: SparkSession) -> int:
    """Into how many ranges keys are dealt: a power of two, several for each partition."""
    return 1 << (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length()


class Shares:
    """Keys of several blocks, which leave as sorted rows (part, keys), one for each of ``parts`` equal ranges of keys."""

    def __init__(self, parts: int):
        self.bounds = np.arange(1, parts, dtype=np.uint64) * np.uint64((1 << 64) // parts if parts > 1 else 0)
        self.held: list[np.ndarray] = []

    def add(self, keys: np.ndarray) -> Iterator[tuple[list[int], list[bytes]]]:
        self.held.append(keys)
        if sum(map(len, self.held)) >= SENT_KEYS:
            yield self.sent()

    def sent(self) -> tuple[list[int], list[bytes]]:
        whole = np.sort(np.concatenate([np.zeros(0, np.uint64), *self.held]))
        self.held = []
        cuts = [0, *np.searchsorted(whole, self.bounds).tolist(), len(whole)]
        full = [k for k in range(len(cuts) - 1) if cuts[k] < cuts[k + 1]]
        return full, [whole[cuts[k] : cuts[k + 1]].tobytes() for k in full]


def anchors(rows: DataFrame, parts: int) -> DataFrame:
    """Pass 1: the anchors of blocks as shares, those that occur several times in their block twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = Shares(parts)
        for block in blocks_of(batches):
            found, n = np.unique(block.runs()[0], return_counts=True)
            for sent in shares.add(np.repeat(found, np.minimum(n, 2))):
                yield _share_rows(*sent)
        yield _share_rows(*shares.sent())

    return rows.mapInArrow(run, "part int, keys binary")


def _share_rows(parts: list[int], keys: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(keys, pa.binary())], names=["part", "keys"])


def repeated_runs(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """Pass 2: anchor, key of the bytes, document and first and last start of each run in question.

    Of equal runs of a block only the first keeps its keys; the others are repeats already.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks_of(batches):
            g, first, last = block.runs()
            kept = held_by(bits, g)
            g, first, last = g[kept], first[kept], last[kept]
            keys = block.keys(first, last)
            doc_ids, low = block.place(first)
            order = np.lexsort((low, doc_ids, keys, g))
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(g[order]) != 0) | (np.diff(keys[order]) != 0)
            # The same place of the same document, read twice, is no repeat of itself.
            leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            head = np.empty(len(order), bool)
            head[order] = new | ((doc_ids[order] == doc_ids[leader]) & (low[order] == low[leader]))
            g, keys = (pa.array(c.view(np.int64), mask=~head) for c in (g, keys))
            yield pa.RecordBatch.from_arrays(
                [g, keys, pa.array(doc_ids), pa.array(low), pa.array(low + last - first)], names=["g", "k", "doc_id", "lo", "hi"]
            )

    return rows.mapInArrow(run, "g bigint, k bigint, doc_id bigint, lo bigint, hi bigint")


def settled_runs(runs: DataFrame) -> DataFrame:
    """Repeats, and firsts of which ``g`` has several: doc_id, lo, hi and whether it is such a first. Runs without ``g`` are repeats."""
    settled = settled_keys(runs.where("g IS NOT NULL"))
    return settled.unionByName(runs.where("g IS NULL").select("doc_id", "lo", "hi", F.lit(False).alias("head")))


def settled_keys(runs: DataFrame) -> DataFrame:
    """Of runs, or windows, in the order of both keys and place: repeats, and firsts of which ``g`` has several.

    Columns: doc_id, lo, hi and whether it is such a first. ``runs`` is read once. A block gives an anchor's equal runs once,
    so even a passage of very many documents is a bounded number of rows; they stream by in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: list[np.ndarray] = []  # the first run of the last key
        waiting = False  # whether it is the only key of its anchor so far
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [column.to_numpy() for column in batch.columns]
            if before:
                columns = [np.concatenate(pair) for pair in zip(before, columns)]
            g, k, doc_ids, low, high = columns
            new_g, new = np.ones(len(g), bool), np.ones(len(g), bool)
            new_g[1:] = np.diff(g) != 0
            new[1:] = new_g[1:] | (np.diff(k) != 0)
            leader = np.maximum.accumulate(np.where(new, np.arange(len(g)), 0))
            # The same place, read twice, is no repeat of itself.
            again = ~new & ((doc_ids != doc_ids[leader]) | (low != low[leader]))
            firsts = np.flatnonzero(new)
            only = new_g[firsts]
            if before:
                only[0] = waiting
            several = ~only
            several[:-1] |= ~new_g[firsts[1:]]
            if before and not waiting:
                several[0] = False
            rows = np.concatenate([firsts[several], np.flatnonzero(again)])
            before, waiting = [column[firsts[-1:]] for column in columns], bool(only[-1] and not several[-1])
            if len(rows):
                head = np.arange(len(rows)) < several.sum()
                yield _batch({"doc_id": doc_ids[rows], "lo": low[rows], "hi": high[rows], "head": head})

    ordered = runs.repartition("g").sortWithinPartitions("g", "k", "doc_id", "lo")
    return ordered.mapInArrow(run, "doc_id bigint, lo bigint, hi bigint, head boolean")


def place_hash(doc_ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return mixed(doc_ids.astype(np.uint64) * C1 + starts.astype(np.uint64) * C2)


def head_places(rows: DataFrame) -> DataFrame:
    """The column ``g``: hashes of the places (doc_id, lo), for a filter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = place_hash(batch.column("doc_id").to_numpy(), batch.column("lo").to_numpy())
            yield _batch({"g": hashes.view(np.int64)})

    return rows.select("doc_id", "lo").mapInArrow(run, "g bigint")


def in_question(rows: DataFrame, heads: DataFrame) -> DataFrame:
    """Blocks of the windows that start in the ranges ``heads`` has for a document, a packed block per row.

    Neighbouring ranges are one piece of text. A document comes with its own ranges, so this does not depend on how much is in question elsewhere.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes]]:
        for batch in batches:
            row, low, high = ranges_of(batch.column(2))
            new = np.ones(len(row), bool)
            new[1:] = (np.diff(row) != 0) | (low[1:] > high[:-1] + 1)
            at = np.flatnonzero(new)
            high = np.maximum.reduceat(high, at) if len(at) else high
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for n, start, last in zip(row[at].tolist(), low[at].tolist(), high.tolist()):
                for cut in range(start, last + 1, QUESTION_BYTES):
                    yield ids[n], cut, texts[n][cut : min(last + 1, cut + QUESTION_BYTES) + LENGTH - 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in gathered(pieces(batches), QUESTION_BYTES):
            yield pa.RecordBatch.from_pydict(block.row(), schema=PACKED)

    listed = heads.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges"))
    return rows.join(listed, "doc_id").select("doc_id", "data", "ranges").mapInArrow(run, spark_schema(PACKED))


def ranges_of(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, lo and hi of the ranges of all rows, in order."""
    flat = lists.flatten()
    low, high = (flat.field(k).to_numpy(zero_copy_only=False).astype(np.int64, copy=False) for k in (0, 1))
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(lists)), sizes)
    order = np.lexsort((high, low, row))
    return row, low[order], high[order]


def packed_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Block]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield Block.packed(batch.slice(k, 1).to_pylist()[0])


def sorted_windows(blocks: DataFrame, parts: int) -> DataFrame:
    """Pass 3: windows sorted in their block.

    Rows are either repeats within the block (doc_id, lo, hi), or the keys of different windows of
    blocks as shares (part, keys).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shares = Shares(parts)
        nowhere = [np.zeros(0, np.int64)] * 3
        for block in packed_blocks(batches):
            ordered, kinds = sorted_classes(block, block.starts())
            doc_ids, offsets = block.place(ordered)
            order = np.lexsort((offsets, doc_ids, kinds))
            is_first = np.ones(len(order), bool)
            is_first[1:] = np.diff(kinds[order]) != 0
            # The same place of the same document, read twice, is no repeat of itself.
            leader = np.maximum.accumulate(np.where(is_first, np.arange(len(order)), 0))
            same = (doc_ids[order] == doc_ids[order[leader]]) & (offsets[order] == offsets[order[leader]])
            for sent in shares.add(block.window_key(ordered[order[is_first]], 0)):
                yield _window_rows(*sent, *nowhere)
            rest = np.sort(ordered[order[~is_first & ~same]])
            if len(rest):
                breaks = np.flatnonzero(np.diff(rest) != 1)
                low, high = rest[np.append(0, breaks + 1)], rest[np.append(breaks, len(rest) - 1)]
                # A stretch of neighbours never crosses pieces, as the last starts of a piece are no windows.
                ids, at = block.place(low)
                yield _window_rows([], [], ids, at, at + high - low)
        yield _window_rows(*shares.sent(), *nowhere)

    return blocks.mapInArrow(run, "part int, keys binary, doc_id bigint, lo bigint, hi bigint")


def _window_rows(parts: list[int], keys: list[bytes], ids: np.ndarray, low: np.ndarray, high: np.ndarray) -> pa.RecordBatch:
    no_keys, no_place = pa.nulls(len(ids), pa.int32()), pa.nulls(len(parts), pa.int64())
    columns = [
        pa.concat_arrays([pa.array(parts, pa.int32()), no_keys]),
        pa.concat_arrays([pa.array(keys, pa.binary()), pa.nulls(len(ids), pa.binary())]),
        *(pa.concat_arrays([no_place, pa.array(c)]) for c in (ids, low, high)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["part", "keys", "doc_id", "lo", "hi"])


def shared_keys(shares: DataFrame) -> DataFrame:
    """The column ``g``: keys that occur several times in the shares; a task holds those of one part at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, [np.zeros(0, np.uint64)]

        def several() -> pa.RecordBatch:
            keys = np.sort(np.concatenate(held))
            return _batch({"g": np.unique(keys[1:][keys[1:] == keys[:-1]]).view(np.int64)})

        for batch in batches:
            for k, keys in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if k != part:
                    yield several()
                    part, held = k, []
                held.append(np.frombuffer(keys, np.uint64))
        yield several()

    return shares.select("part", "keys").repartition("part").sortWithinPartitions("part").mapInArrow(run, "g bigint")


def window_rows(blocks: DataFrame, shared: np.ndarray) -> DataFrame:
    """Pass 4: keys and place of the first of each kind of windows of a block whose key blocks share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in packed_blocks(batches):
            starts = block.starts()
            one = block.window_key(starts, 0)
            kept = held_by(shared, one)
            one, two = one[kept], block.window_key(starts[kept], 1)
            ids, at = block.place(starts[kept])
            order = np.lexsort((at, ids, two, one))
            one, two, ids, at = one[order], two[order], ids[order], at[order]
            new = np.ones(len(order), bool)
            new[1:] = (np.diff(one) != 0) | (np.diff(two) != 0)
            yield _batch({"g": one[new].view(np.int64), "k": two[new].view(np.int64), "doc_id": ids[new], "lo": at[new], "hi": at[new]})

    return blocks.mapInArrow(run, "g bigint, k bigint, doc_id bigint, lo bigint, hi bigint")


def repeated_starts(spark: SparkSession, rows: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """doc_id, lo, hi: all windows that start between lo and hi occur earlier. ``rows``: doc_id, data.

    Also the stored tables to discard once that has been read.
    """
    parts = share_count(spark)
    runs = stored(spark, repeated_runs(rows, filter_of(shared_keys(anchors(rows, parts)))), "runs")
    settled = stored(spark, settled_runs(runs), "settled")
    discard(runs)
    blocks = stored(spark, in_question(rows, settled.where("head")), "in-question")
    windows = stored(spark, sorted_windows(blocks, parts), "windows")
    shared = filter_of(shared_keys(windows.where("part IS NOT NULL")))
    across = settled_keys(window_rows(blocks, shared))
    found = settled.unionByName(across).where("NOT head").drop("head")
    repeats = stored(spark, found.unionByName(windows.where("part IS NULL").select("doc_id", "lo", "hi")), "repeats")
    discard(settled, blocks, windows)
    return repeats, [repeats]


PACKED = pa.schema([(name, pa.binary()) for name in ("ids", "offsets", "sizes", "data")])
RESULT = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_bytes", pa.int64()),
        ("n_removed", pa.int64()),
        ("n_spans", pa.int64()),
        ("kept_sha256", pa.string()),
        ("kept", pa.binary()),
    ]
)


def removed(sizes: np.ndarray, lists: pa.Array) -> list[list[tuple[int, int]]]:
    """For each text, given by its size, the maximal runs of bytes covered by windows that start in its ranges."""
    row, low, high = ranges_of(lists)
    end = np.minimum(sizes[row], high + LENGTH)
    row, low, end = row[low < end], low[low < end], end[low < end]
    # Ends so far, with each text's own numbers behind those of the texts before it.
    base = row * (int(sizes.max(initial=0)) + 1)
    reach = np.maximum.accumulate(end + base)
    new = np.ones(len(row), bool)
    new[1:] = (np.diff(row) != 0) | (low[1:] + base[1:] > reach[:-1])
    at = np.flatnonzero(new)
    ends = (reach - base)[np.append(at[1:] - 1, len(row) - 1)] if len(at) else end
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(sizes))]
    for n, start, stop in zip(row[at].tolist(), low[at].tolist(), ends.tolist()):
        spans[n].append((start, stop))
    return spans


def digested(rows: DataFrame, touched: np.ndarray, with_text: bool) -> DataFrame:
    """Size and digest of every row; its bytes travel on only if asked for or if some may have to go."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            given, ids, data = batch.column(0), batch.column(1), batch.column(2).to_pylist()
            needed = with_text | held_by(touched, place_hash(ids.to_numpy(), np.zeros(len(ids), np.int64)))
            yield pa.RecordBatch.from_arrays(
                [
                    given,
                    ids,
                    pa.array([text if keep else None for text, keep in zip(data, needed)], pa.binary()),
                    pa.array([len(text) for text in data], pa.int64()),
                    pa.array([None if keep else hashlib.sha256(text).hexdigest() for text, keep in zip(data, needed)], pa.string()),
                ],
                names=["given", "doc_id", "data", "size", "digest"],
            )

    return rows.mapInArrow(run, "given bigint, doc_id bigint, data binary, size bigint, digest string")


def identified(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """given, doc_id and data of each row: a number per document that rises with the given id.

    That is the id itself where every id has one text. Otherwise the different pairs of id and text hash are
    numbered, which takes a shuffle of the texts and a stored copy of them.
    """
    hashed = rows.withColumn("h", F.xxhash64("data")).withColumn("h2", F.xxhash64(F.lit(1), "data"))
    texts = F.struct("h", "h2")
    shared = hashed.groupBy("given").agg(F.min(texts).alias("low"), F.max(texts).alias("high"))
    if not shared.where((F.col("low") != F.col("high")) | (F.col("given") == LAST_ID)).limit(1).count():
        return rows.select("given", F.coalesce("given", F.lit(LAST_ID)).alias("doc_id"), "data")
    pairs = hashed.select(F.col("given").isNull().alias("nameless"), "given", "h", "h2").distinct()
    numbers = number_rows(pairs, ["nameless", "given", "h", "h2"], name="doc_id", unique=True)
    of = numbers.select(F.col("given").alias("n_given"), F.col("h").alias("n_h"), F.col("h2").alias("n_h2"), "doc_id")
    same = F.col("given").eqNullSafe(F.col("n_given")) & (F.col("h") == F.col("n_h")) & (F.col("h2") == F.col("n_h2"))
    return stored(spark, hashed.join(of, same).select("given", "doc_id", "data"), "numbered-texts")


def remove_repeats(spark: SparkSession, docs: DataFrame, with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and, if asked, kept.

    kept is what is left, as bytes. Null texts are empty; texts under ``LENGTH`` bytes stay whole.
    Rows without an id come after all others. Rows that repeat id and text are the same document, in
    which nothing is a repeat of itself; different texts under one id, or under none, are documents of
    their own, in the order of their hashes.
    """
    data = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = identified(spark, docs.select(F.col("doc_id").cast("long").alias("given"), data.alias("data")))
    ranges, used = repeated_starts(spark, rows.where(F.octet_length("data") >= LENGTH).select("doc_id", "data"))
    collected = stored(spark, ranges.groupBy("doc_id").agg(F.collect_list(F.struct("lo", "hi")).alias("ranges")), "ranges")
    discard(*used)
    touched = filter_of(head_places(collected.select("doc_id", F.lit(0).cast("long").alias("lo"))))
    # Stored, as only then tasks hand Python small batches of text.
    joined = stored(spark, digested(rows, touched, with_text), "digests").join(collected, "doc_id", "left")
    schema = RESULT if with_text else RESULT.remove(RESULT.get_field_index("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {name: [] for name in RESULT.names}
            if not batch.num_rows:
                continue
            covered = removed(batch.column("size").to_numpy(), batch.column("ranges"))
            for given, text, spans, size, digest in zip(*(batch.column(name).to_pylist() for name in ("given", "data")), covered, *(batch.column(name).to_pylist() for name in ("size", "digest"))):
                if text is None:
                    for name, value in zip(RESULT.names, (given, size, 0, 0, digest, None)):
                        out[name].append(value)
                    continue
                at, parts = 0, []
                for low, end in spans:
                    parts.append(text[at:low])
                    at = end
                left = b"".join([*parts, text[at:]])
                values = (given, len(text), len(text) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left)
                for name, value in zip(RESULT.names, values):
                    out[name].append(value)
            yield pa.RecordBatch.from_pydict({name: out[name] for name in schema.names}, schema=schema)

    spark_types = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.mapInArrow(run, spark_types + ", kept binary" * with_text)

"""Near duplicates, decontamination, repeated strings and neighbours against brute force."""

import hashlib
import random
import re
import time
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lakequery.llm import ann, common, decontaminate, near_duplicates, suffix_dedup

WORDS = [f"w{i}" for i in range(400)]


def near_documents():
    rng = random.Random(5)
    docs = []
    for family in range(25):
        base = rng.choices(WORDS, k=rng.randint(3, 120))
        for _ in range(rng.randint(1, 8)):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            docs.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words) + "\n")
    docs += ["", None, " \t", "one two", "One  two", "one two three four five"] + [docs[0]] * 3
    return list(enumerate(docs))


def shingle_set(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", (text or "").lower()) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def slow_components(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    label = {i: i for i, _ in docs}
    changed = True
    links = [
        (a, b)
        for a in sets
        for b in sets
        if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ]
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label, sets


def test_classes_are_those_of_all_pairs(spark):
    docs = near_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS kept", "2 AS id")
    got = {r.doc_id: r for r in near_duplicates.find_classes(spark, df.repartition(3)).collect()}
    label, sets = slow_components(docs)
    assert {i: r.component_id for i, r in got.items()} == label
    assert {i: r.n_shingles for i, r in got.items()} == {i: len(s) for i, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got.values())
    stage = near_duplicates.near_duplicate_stage(spark, df, "")
    assert stage.columns == df.columns
    assert sorted(r.doc_id for r in stage.collect()) == sorted(set(label.values()))


def test_links_that_cross_a_leader_are_found(spark):
    """In one bucket of single documents only the pass across components can find the links."""
    docs = near_documents()
    df = spark.createDataFrame(docs, "doc_id long, text string")
    made = near_duplicates.signed(df).where("n_shingles > 0")
    classes = made.groupBy("same").agg(
        F.min("doc_id").alias("id"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch")
    )
    shared = classes.select("id", F.lit(0).cast("long").alias("bucket"))
    labels = classes.select("id", F.col("id").alias("component"))
    across = near_duplicates._across(spark, shared, labels, classes)
    texts, sizes = near_duplicates.shingle_sets(df), classes.select(F.col("id").alias("doc_id"), "n_shingles")
    links = near_duplicates.verified(spark, across, texts, sizes, "t")
    label, _ = slow_components(docs)
    got = {r.id: r.component for r in near_duplicates.components(spark, links).collect()}
    firsts = {r.id for r in classes.collect()}
    assert {i: got.get(i, i) for i in firsts} == {i: label[i] for i in firsts}


def test_near_copies_below_the_threshold_are_told_from_links(spark):
    """Of 80 copies of one text all pairs are similar to 0.6 or more, but only those of a copy and its own copy are links."""
    rng = random.Random(8)
    words = [f"w{k}" for k in range(20_000)]
    base = rng.choices(words, k=200)
    docs = []
    for i in range(40):
        copy = list(base)
        for at in rng.sample(range(5, 195, 10), 4):
            copy[at] = rng.choice(words)
        docs += [(2 * i, " ".join(copy)), (2 * i + 1, " ".join([*copy[:-1], "end"]))]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    traits = near_duplicates.signed(df).withColumnRenamed("doc_id", "id").select("id", "n_shingles", "sketch")
    shared = traits.select("id", F.lit(0).cast("long").alias("bucket"))
    label, sets = slow_components(docs)
    pairs = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) < 0.75 * len(sets[a] | sets[b])]
    assert len(pairs) > 2500 and all(len(sets[a] & sets[b]) > 0.6 * len(sets[a] | sets[b]) for a, b in pairs)
    links = {(a, b) for a in sets for b in sets if a < b} - set(pairs)
    across = near_duplicates._across(spark, shared, traits.select("id", F.col("id").alias("component")), traits)
    got = {(r.a, r.b) for r in across.collect()}
    assert got >= links and len(got - links) < 0.1 * len(pairs)


def test_parities_rule_no_link_out(spark):
    """Sets of all sizes at the least similarity of a link, and so large that most bits are chance."""
    rng = np.random.default_rng(4)
    rows = []
    for n in (1, 4, 7, 70, 700, 7000, 70_000):
        for _ in range(5):
            hashes = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            small = rng.permutation(hashes)[: -(-75 * len(hashes) // 100)]
            half = len(hashes) // 7
            moved = np.concatenate([hashes[half:], rng.integers(0, 1 << 63, half).astype(np.uint64)])
            for other in (small, moved):
                assert near_duplicates.similar(hashes, np.unique(other))
                sketches = [[0] * near_duplicates.SKETCH_WORDS + near_duplicates.parities_of(s) for s in (hashes, other)]
                rows.append((*sketches, len(hashes) + len(other)))
    far = [rng.integers(0, 1 << 63, 300).astype(np.uint64) for _ in range(2)]
    rows.append((*[[0] * near_duplicates.SKETCH_WORDS + near_duplicates.parities_of(s) for s in far], 600))
    df = spark.createDataFrame(rows, "x array<long>, y array<long>, sizes long").coalesce(1)
    allowed = [r[0] for r in df.select(near_duplicates.parities_allow(F.col("x"), F.col("y"), F.col("sizes"))).collect()]
    assert allowed == [True] * (len(rows) - 1) + [False]


def test_components_of_long_chains(spark):
    edges = spark.range(0, 500).select((F.col("id") + 1).alias("a"), F.col("id").alias("b"))
    more = spark.createDataFrame([(1000, 1001), (1001, 1002), (1002, 1000), (7000, 7000)], "a long, b long")
    got = {r.id: r.component for r in near_duplicates.components(spark, edges.unionByName(more)).collect()}
    assert got == {i: 0 for i in range(1, 501)} | {1001: 1000, 1002: 1000}


def test_circulant_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    a = rng.integers(0, 1 << 63, 900).astype(np.uint64)
    b = np.concatenate([a[:750], rng.integers(0, 1 << 63, 150).astype(np.uint64)])
    same = (near_duplicates.signature(a) == near_duplicates.signature(b)).mean()
    assert abs(same - 750 / 1050) < 0.1
    assert (1 - 0.75**near_duplicates.ROWS) ** near_duplicates.BANDS < 1e-5


def shuffle_files(spark):
    folders = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirs()
    return {path for folder in folders for path in Path(folder.getPath()).rglob("shuffle_*.data")}


def lasting(spark, before, least=1):
    """New shuffle files of some size that are not deleted soon, as Spark deletes in the background."""

    def new():
        return [path for path in shuffle_files(spark) - before if path.exists() and path.stat().st_size >= least]

    ends = time.monotonic() + 10
    while new() and time.monotonic() < ends:
        time.sleep(0.2)
    return new()


def test_stored_tables_are_written_in_bounded_batches_without_lasting_shuffles(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"n": [batch.num_rows], "size": [batch.nbytes]})

    before, bound = shuffle_files(spark), "spark.sql.execution.arrow.maxBytesPerBatch"
    kept = spark.conf.get(bound)
    rows = spark.range(0, 4000, 1, 2).select("id", F.repeat(F.lit("x"), 20_000).alias("text")).repartition(2, "id")
    table = common.stored(spark, rows.mapInArrow(sizes, "n long, size long"), "t")
    assert not lasting(spark, before) and spark.conf.get(bound) == kept
    batches = table.collect()
    assert sum(r.n for r in batches) == 4000 and max(r["size"] for r in batches) < 8 << 20


def test_null_ids_and_empty_tables_of_classes(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (1, "a b c d e f")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates.find_classes(spark, df).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True)]
    assert near_duplicates.find_classes(spark, df.limit(0)).count() == 0


def slow_tiles(document, item, least):
    """Greedy string tiling by comparing every pair of places."""
    marked_d, marked_i, covered = set(), set(), 0
    while True:
        best = (0, 0, 0)
        for d in range(len(document)):
            for i in range(len(item)):
                n = 0
                while d + n < len(document) and i + n < len(item) and document[d + n] == item[i + n] and d + n not in marked_d and i + n not in marked_i:
                    n += 1
                if n > best[0]:
                    best = (n, d, i)
        n, d, i = best
        if n < least:
            return covered
        marked_d |= set(range(d, d + n))
        marked_i |= set(range(i, i + n))
        covered += n


def test_tiling_covers_as_much_as_the_slow_form():
    rng = random.Random(8)
    for _ in range(150):
        item = rng.choices(range(12), k=rng.randint(5, 40))
        parts = [item[a : a + rng.randint(3, 15)] for a in rng.choices(range(len(item)), k=3)]
        document = [w for part in parts for w in [*part, *rng.choices(range(20), k=rng.randint(0, 5))]]
        tiles = decontaminate.tiles_of(np.array(document, np.uint64), np.array(item, np.uint64), 3)
        assert sum(n for *_, n in tiles) == slow_tiles(document, item, 3)
        assert all(document[d : d + n] == item[i : i + n] for d, i, n in tiles)


def test_leaks_are_found_in_any_order_and_clean_documents_left(spark):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choices(WORDS, k=30)).capitalize() + ".") for i in range(20)] + [(50, "tiny item"), (51, None), (52, "")]
    words = items[3][1].split()
    swapped = " ".join([*words[15:], "between", *words[:15]])
    docs = [
        (0, " ".join(rng.choices(WORDS, k=200))),
        (1, f"before {items[5][1].upper()} after"),
        (2, swapped),
        (3, " ".join(words[:12])),
        (4, None),
        (5, ""),
        (6, "a tiny item here"),
        (None, items[5][1]),
        (1, f"again {items[5][1]}"),
    ]
    frame = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS item_id")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in decontaminate.find_leaks(spark, frame, bench).collect()}
    assert set(got) == {(1, 5), (2, 3), (6, 50)}
    assert got[2, 3].n_tiles == 2 and got[1, 5].coverage == 1.0
    assert decontaminate.find_leaks(spark, frame, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(spark, frame.limit(0), bench).count() == 0


def test_leaks_agree_with_tiling_every_pair(spark, small):
    docs, bench = (spark.read.parquet(f"{small}/{name}.parquet") for name in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(spark, docs, bench).collect()}
    items = [(r.item_id, decontaminate.hashed(decontaminate.words_of(r.text))) for r in bench.collect()]
    want = set()
    for row in docs.collect():
        text = decontaminate.hashed(decontaminate.words_of(row.text))
        for item_id, item in items:
            if len(np.intersect1d(text, item)) >= 0.3 * len(set(item.tolist())):
                tiles = decontaminate.tiles_of(text, item, decontaminate.MIN_TILE)
                if sum(n for *_, n in tiles) >= decontaminate.MIN_COVERAGE * len(item):
                    want.add((row.doc_id, item_id))
    assert got == want and want


def slow_removal(docs, length=suffix_dedup.LENGTH):
    seen, out = set(), {}
    for doc_id, text in sorted(docs):
        covered = np.zeros(len(text), bool)
        for start in range(len(text) - length + 1):
            window = text[start : start + length]
            if window in seen:
                covered[start : start + length] = True
            seen.add(window)
        spans = int((np.diff(np.concatenate([[0], covered.astype(int)])) == 1).sum())
        left = np.frombuffer(text, np.uint8)[~covered].tobytes()
        out[doc_id] = (len(text), int(covered.sum()), spans, hashlib.sha256(left).hexdigest())
    return out


def test_blocks_hold_every_window_once():
    rng = random.Random(12)
    docs = [(i, bytes(rng.choices(b"abc", k=rng.randint(0, 2000)))) for i in range(30)]
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in docs], "data": [t for _, t in docs]})
    found = []
    for block in suffix_dedup.blocks_of(iter([batch]), 700):
        _, first, last = block.runs()
        for a, b in zip(first, last):
            ids, at = block.place(np.arange(a, b + 1))
            found += list(zip(ids.tolist(), at.tolist()))
    assert sorted(found) == [(i, s) for i, t in docs for s in range(len(t) - suffix_dedup.LENGTH + 1)]


def test_anchors_of_a_block_are_found_in_bounded_memory(monkeypatch):
    rng = np.random.default_rng(6)
    block = suffix_dedup.Block([(i, 0, rng.integers(97, 100, 20_000).astype(np.uint8).tobytes()) for i in range(100)])
    tracemalloc.start()
    whole = block.runs()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 20 * block.size
    monkeypatch.setattr(suffix_dedup, "CHUNK_WINDOWS", 777)
    assert all(np.array_equal(a, b) for a, b in zip(whole, block.runs()))


def test_texts_that_share_a_phrase_share_no_anchor():
    rng = np.random.default_rng(8)
    around = [rng.integers(97, 123, 300).astype(np.uint8).tobytes() for _ in range(50)]
    block = suffix_dedup.Block([(i, 0, text[:150] + b" in the course of the year " + text[150:]) for i, text in enumerate(around)])
    found = block.runs()[0]
    assert len(found) == len(np.unique(found))


def test_ties_alone_are_sorted_on():
    rng = np.random.default_rng(7)
    for n in (0, 1, 2, 3000):
        columns = [rng.integers(0, 12, n).astype(np.uint64) for _ in range(4)]
        rows = list(zip(*columns))
        order, new = suffix_dedup.in_order(columns)
        assert [rows[k] for k in order] == sorted(rows)
        assert new.sum() == len(set(rows)) and sorted(order) == list(range(n))
        ranks = {row: k for k, row in enumerate(sorted(set(rows)), 1)}
        assert suffix_dedup.names(columns).tolist() == [ranks[row] for row in rows]


def test_anchors_fill_a_filter_evenly():
    """An anchor is a least hash; taken as it is, nearly all would share their first bits, and with them places of the filter."""
    block = suffix_dedup.Block([(1, 0, np.random.default_rng(5).integers(97, 123, 200_000).astype(np.uint8).tobytes())])
    found = np.unique(block.runs()[0])
    assert len(found) > 5000
    assert 0.1 < (found < np.uint64(1 << 61)).mean() < 0.15
    bits = np.zeros(suffix_dedup.FILTER_BITS // 8, np.uint8)
    np.bitwise_or.at(bits, suffix_dedup._places(found) >> 3, (1 << (suffix_dedup._places(found) & 7)).astype(np.uint8))
    assert np.unpackbits(bits).sum() > 0.999 * len(found) and suffix_dedup.held_by(bits, found).all()


def test_keys_leave_in_few_rows_and_meet_again(spark):
    rng = random.Random(4)
    part = bytes(rng.choices(b"abcdef", k=300))
    docs = [(i, bytes(rng.choices(b"abcdef", k=200)) + part * (i < 3)) for i in range(40)]
    rows = spark.createDataFrame(docs, "doc_id long, data binary").coalesce(1)
    many = suffix_dedup.anchors(rows, 64).collect()
    assert len(many) <= 64 and sorted({r.part for r in many}) == [r.part for r in many]
    keys = [np.frombuffer(r["keys"], np.uint64) for r in many]
    assert all((np.diff(k.astype(object)) >= 0).all() and set(k >> np.uint64(58)) == {r.part} for r, k in zip(many, keys))
    seen, n = np.unique(np.concatenate(keys), return_counts=True)
    shared = suffix_dedup.shared_keys(suffix_dedup.anchors(rows.repartition(5), 64)).collect()
    assert sorted(r.g for r in shared) == sorted(seen[n > 1].view(np.int64).tolist()) and shared
    assert suffix_dedup.shared_keys(suffix_dedup.anchors(rows.limit(0), 1)).count() == 0


def test_blocks_in_question_hold_the_windows_of_the_ranges(spark, monkeypatch):
    rng = random.Random(6)
    docs = [(i, bytes(rng.choices(b"abc", k=rng.randint(100, 900)))) for i in range(12)]
    ranges = [(i, low, min(len(t) - 100, low + rng.randint(0, 60))) for i, t in docs[:9] for low in range(0, len(t) - 99, 97)]
    ranges += [(0, low, low) for low in range(len(docs[0][1]) - 99)]
    monkeypatch.setattr(suffix_dedup, "QUESTION_BYTES", 400)
    blocks = suffix_dedup.in_question(
        spark.createDataFrame([*docs, docs[1]], "doc_id long, data binary"), spark.createDataFrame(ranges, "doc_id long, lo long, hi long")
    ).collect()
    found = []
    for block in (suffix_dedup.Block.packed(r.asDict()) for r in blocks):
        starts = block.starts()
        assert block.size <= 400 + suffix_dedup.LENGTH - 1 and block.row() == suffix_dedup.Block.packed({k: v[0] for k, v in block.row().items()}).row()
        ids, at = block.place(starts)
        assert all(bytes(block.text[s : s + 100]) == docs[i][1][o : o + 100] for s, i, o in zip(starts.tolist(), ids.tolist(), at.tolist()))
        found += zip(ids.tolist(), at.tolist())
    want = {(i, at) for i, low, high in ranges for at in range(low, high + 1)}
    assert sorted(found) == sorted([*want, *(w for w in want if w[0] == 1)])


def slow_settled(runs):
    first, places = {}, {}
    for g, k, doc_id, low, high in sorted(runs):
        first.setdefault(g, {}).setdefault(k, (doc_id, low, high))
    heads = [(*run, True) for keys in first.values() if len(keys) > 1 for run in keys.values()]
    return sorted(heads + [(d, a, b, False) for g, k, d, a, b in runs if (d, a) != first[g][k][:2]])


@pytest.mark.parametrize("rows", [1, 2, 7, 1000])
def test_runs_are_settled_across_batches(spark, rows):
    rng = random.Random(rows)
    runs = [(g, rng.randint(-2, 2) << 61, d, low, low + 5) for g in [-(1 << 63), 5, 6, 7, (1 << 63) - 1] * 6 for d, low in [(rng.randint(0, 4), rng.randint(0, 3))]]
    runs += [(9, 1, 1, 1, 6), (9, 1, 1, 1, 6), (10, 1, 1, 1, 6), (10, 2, 1, 2, 7)]
    with common.settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)}):
        got = suffix_dedup.settled_keys(spark.createDataFrame(runs, "g long, k long, doc_id long, lo long, hi long")).collect()
    assert sorted(map(tuple, got)) == slow_settled(runs)


def test_removed_spans_of_many_texts():
    rng = random.Random(7)
    sizes = [rng.randint(0, 900) for _ in range(60)]
    lists = [None if n % 7 == 0 else [{"lo": a, "hi": a + rng.randint(0, 40)} for a in rng.choices(range(950), k=rng.randint(0, 9))] for n in range(60)]
    kind = pa.list_(pa.struct([("lo", pa.int64()), ("hi", pa.int64())]))
    got = suffix_dedup.removed(np.array(sizes), pa.array([None, *lists, None], kind)[1:-1])
    for size, ranges, spans in zip(sizes, lists, got):
        covered = np.zeros(size + 2, bool)
        for r in ranges or []:
            covered[1 + r["lo"] : 1 + min(size, r["hi"] + suffix_dedup.LENGTH)] = True
        covered[-1] = False
        edges = np.flatnonzero(np.diff(covered.astype(int)))
        assert spans == list(zip(edges[::2].tolist(), edges[1::2].tolist()))
    assert suffix_dedup.removed(np.zeros(0, np.int64), pa.array([], kind)) == []


def test_repeats_are_removed_exactly(spark):
    rng = random.Random(11)
    base = ["".join(rng.choices("abcdefgh é", k=rng.randint(50, 700))) for _ in range(8)]
    docs = []
    for i in range(80):
        text = ""
        for _ in range(rng.randint(0, 4)):
            part = rng.choice(base)
            text += part[rng.randrange(len(part)) :][: rng.randint(1, 500)]
            text += rng.choice(["", "ab" * rng.randint(1, 120), "z" * rng.randint(1, 250)])
        docs.append((i, text))
    docs += [(80 + i, docs[i][1]) for i in range(10)] + [(200, ""), (201, "x" * 100_000)]
    df = spark.createDataFrame([*docs, (202, None)], "doc_id long, text string").selectExpr("*", "1 AS lo", "2 AS data")
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.remove_repeats(spark, df.repartition(4), False).collect()}
    want = slow_removal([(i, t.encode()) for i, t in docs])
    assert got.pop(202) == (0, 0, 0, hashlib.sha256(b"").hexdigest())
    assert got == want


def test_repeats_of_odd_rows(spark):
    text = "".join(random.Random(1).choices("abcdef", k=300))
    df = spark.createDataFrame([(5, text), (5, text), (None, text)], "doc_id long, text string")
    got = sorted((r.doc_id or 99, r.n_removed, len(r.kept)) for r in suffix_dedup.remove_repeats(spark, df).collect())
    assert got == [(5, 0, 300), (5, 0, 300), (99, 300, 0)]
    assert suffix_dedup.remove_repeats(spark, df.limit(0)).count() == 0


def test_passes_leave_no_shuffles_and_one_table_behind(spark):
    rng = random.Random(2)
    part = bytes(rng.choices(b"abcdef", k=300))
    rows = [(i, bytes(rng.choices(b"abcdef", k=200)) + part[i:]) for i in range(8)]
    before = shuffle_files(spark)
    ranges, used = suffix_dedup.repeated_starts(spark, spark.createDataFrame(rows, "doc_id long, data binary"))
    assert not lasting(spark, before, least=200) and len(used) == 1  # a sum of one row a task is smaller
    assert {r.doc_id for r in ranges.collect()} == set(range(1, 8))


def test_texts_that_share_an_id_or_have_none_are_documents_of_their_own(spark):
    """Ranges found in one of them must not reach the others."""
    rng = random.Random(3)
    a, b, c, d = ("".join(rng.choices("abcdefgh", k=260)) for _ in range(4))

    def kept(docs):
        df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
        return sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.kept.decode()) for r in suffix_dedup.remove_repeats(spark, df).collect())

    assert kept([(1, a), (None, b + a), (None, c)]) == [(False, 1, 260, a), (True, 0, 260, c), (True, 0, 520, b)]
    assert kept([(1, a), (2, b + a), (2, c), (2, c), (3, d)]) == [
        (False, 1, 260, a), (False, 2, 260, c), (False, 2, 260, c), (False, 2, 520, b), (False, 3, 260, d),
    ]
    both = kept([(None, b + a), (None, a + c), (None, d)])
    assert [row[-1] for row in both if row[2] == 260] == [d]
    assert sorted(row[-1] for row in both if row[2] == 520) in (sorted([b + a, c]), sorted([b, a + c]))
    largest = 2**63 - 1
    assert kept([(largest, a + b), (None, c + b)]) == [(False, largest, 520, a + b), (True, 0, 520, c)]


def test_suffix_order_and_cover():
    shifts = {(a - b) % suffix_dedup.PERIOD for a in suffix_dedup.COVER for b in suffix_dedup.COVER}
    assert shifts == set(range(suffix_dedup.PERIOD))
    text = b"".join(random.Random(2).choices([b"ab", b"ba", b"a", b"xyz" * 30], k=900))
    block = suffix_dedup.Block([(1, 0, text)])
    starts = np.arange(len(text) - suffix_dedup.LENGTH + 1)
    order, kinds = suffix_dedup.sorted_classes(block, starts)
    windows = [text[s : s + suffix_dedup.LENGTH] for s in order]
    assert sorted(order) == list(starts) and windows == sorted(windows)
    assert len(set(zip(windows, kinds))) == len(set(windows)) == kinds[-1] + 1


def slow_nearest(rows, queries, k):
    out = set()
    for q in queries:
        vector = np.array(rows[q], float)
        found = sorted((float(np.sqrt(((np.array(v, float) - vector) ** 2).sum())), i) for i, v in rows.items() if i != q)
        out |= {(q, rank, i, score) for rank, (score, i) in enumerate(found[:k], 1)}
    return out


@pytest.mark.parametrize("spread", [0.05, 3.0])
def test_neighbours_against_brute_force(spark, monkeypatch, spread):
    monkeypatch.setattr(ann, "BLOCK_ROWS", 300)
    monkeypatch.setattr(ann, "ROWS_PER_LIST", 150)
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(12, 48))
    rows = {i: (centers[i % 12] + spread * rng.normal(size=48)).astype(np.float32).tolist() for i in range(1500)}
    for i in range(400, 700):
        rows[i] = rows[100]
    frame = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<float>")
    got = {tuple(r) for r in ann.nearest(spark, frame, F.col("vec_id") % 50 == 0).collect()}
    want = slow_nearest(rows, range(0, 1500, 50), 10)
    key = lambda found: {(q, i) for q, _, i, _ in found}
    assert len(key(got) & key(want)) >= 0.99 * len(want)
    shared = {(q, i): s for q, _, i, s in want}
    assert all(abs(shared[q, i] - s) < 1e-9 for q, _, i, s in got if (q, i) in shared)
    ties = sorted((r, i) for q, r, i, _ in got if q == 100)
    assert [i for _, i in ties] == list(range(400, 410))


def test_neighbours_of_odd_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 0.0]), (2, None), (3, [1.0, float("nan")]), (4, [1.0, None]), (5, [2.0, 0.0]),
            (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (5, [2.0, 0.0]), (7, [1.0, 2.0, 3.0]), (8, [0.0, 1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS rank", "2 AS list")
    got = [tuple(r) for r in ann.nearest(spark, frame, F.col("vec_id") % 100 == 0).orderBy("rank").collect()]
    assert got == [(0, 1, 5, 1.0), (0, 2, 8, 2**0.5)]
    assert ann.nearest(spark, frame.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_leaks_of_items_that_repeat_themselves(spark):
    phrase = "say it once again right now"
    long = " ".join(random.Random(3).choices(WORDS, k=400))
    items = [(1, " ".join([phrase] * 10)), (2, long), (2, "a short one of seven words here")]
    docs = [(1, f"before {items[0][1]} after"), (2, "here a short one of seven words here stands"), (3, phrase)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = decontaminate.find_leaks(spark, frame, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r.doc_id, r.item_id, r.coverage) for r in got} == {(1, 1, 1.0), (2, 2, 1.0)}

"""Packing, WARC archives and the pipeline: exact round trips and bounds."""

import hashlib
import random
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakequery.llm import packing, warc
from lakequery.llm.queries import PLANS


def test_chunked_ids_are_those_of_whole_texts():
    rng, whole = random.Random(4), Tokenizer.from_file(packing.tokenizer_path())
    parts = ["a", "B", "'s", "'", "́", "Å", " ", "  ", "\n", "1", "é", "Σ", "ς", "ΟΔΟΣ", "\x1c", "\x85", "中", "🙂", "<|endoftext|>",
             "\t", "\r\n", "don't", "İ", "ﬁ", "_", ",", "-—", "²", "ǆ", "%%%", "\xa0", " "]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 14))) for _ in range(3000)]
    ids, bounds = packing.chunk_tokenizer(packing.tokenizer_path()).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        want = whole.encode(text, add_special_tokens=False).ids
        assert ids[bounds[k] : bounds[k + 1]].tolist() == want, text


def fewest_bins(lengths, capacity):
    """Exhaustive search for small cases."""
    best = [len(lengths)]

    def place(rest, bins):
        if len(bins) >= best[0]:
            return
        if not rest:
            best[0] = len(bins)
            return
        tried = set()
        for k, space in enumerate(bins):
            if space >= rest[0] and space not in tried:
                tried.add(space)
                place(rest[1:], [*bins[:k], space - rest[0], *bins[k + 1 :]])
        place(rest[1:], [*bins, capacity - rest[0]])

    place(sorted(lengths, reverse=True), [])
    return best[0]


def test_bounds_never_exceed_the_fewest_bins():
    rng = random.Random(6)
    for _ in range(120):
        lengths = np.array([rng.randint(1, 20) for _ in range(rng.randint(1, 8))])
        fewest = fewest_bins(lengths.tolist(), 20)
        bins, _ = packing.best_fit_decreasing(lengths, 20)
        assert packing.lower_bound(lengths, 20) <= fewest + 1e-9 <= bins.max() + 1 + 1e-9


def test_bound_certifies_large_pieces():
    """Halves and a bit need a bin each, which the plain sum does not see."""
    assert packing.lower_bound(np.full(10, 2049), 4096) == 10


def check_packing(rows, capacity):
    used = {}
    for row in rows:
        used.setdefault(row.sequence_id, []).append((row.offset, row.length))
    for parts in used.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(used)


@pytest.mark.parametrize("least, most", [(1, 900), (1, 4096), (1300, 2100), (4096, 4096)])
def test_groups_exchange_until_few_bins_are_left(spark, least, most):
    rng = np.random.default_rng(least)
    lengths = rng.integers(least, most + 1, 6000)
    frame = pd.DataFrame({"doc_id": range(6000), "piece": 0, "start": 0, "length": lengths, "ids_crc32": 0})
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    packed = packing.pack(spark, spark.createDataFrame(frame, schema), group=300).collect()
    assert sorted(r.doc_id for r in packed) == list(range(6000))
    bins = check_packing(packed, 4096)
    together, _ = packing.best_fit_decreasing(lengths, 4096)
    assert bins >= np.ceil(packing.lower_bound(lengths, 4096) - 1e-9)
    assert bins <= 1.02 * (together.max() + 1) + 1


def test_pieces_of_odd_documents(spark):
    long = " ".join(f"word{i}" for i in range(9000))
    rows = [(1, None), (2, ""), (3, long), (None, "hi"), (2, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS piece", "2 AS length")
    packed = packing.pack_documents(spark, docs).collect()
    check_packing(packed, 4096)
    whole = Tokenizer.from_file(packing.tokenizer_path()).encode(long, add_special_tokens=False).ids + [1]
    pieces = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in packed if r.doc_id == 3)
    assert pieces == [
        (k, at, len(whole[at : at + 4096]), zlib.crc32(np.array(whole[at : at + 4096], "<u4").tobytes()))
        for k, at in enumerate(range(0, len(whole), 4096))
    ]
    assert sorted(r.length for r in packed if r.doc_id in (1, 2)) == [1, 1, 1]
    assert packing.pack_documents(spark, docs.limit(0)).count() == 0


def test_slices_of_text_change_no_piece(spark):
    docs = spark.createDataFrame([(i, f"Text number {i}, " * i) for i in range(40)], "doc_id long, text string").coalesce(1)
    assert sorted(packing.pieces(docs, slice_bytes=100).collect()) == sorted(packing.pieces(docs).collect())


def test_stage_keeps_few_chunks_and_drops_them_after_a_task(monkeypatch):
    """Workers stay for the other stages, and would hold the chunks of every text they have seen."""

    class Docs:
        def mapInArrow(self, run, schema):
            return run

    monkeypatch.setattr(packing, "documents", lambda docs: docs)
    monkeypatch.setattr(packing, "STAGE_CACHED_CHUNKS", 100, raising=False)
    texts = [" ".join(f"w{k}x{i}" for i in range(20)) for k in range(200)]
    batch = pa.record_batch([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    tokenizer = packing.chunk_tokenizer(packing.tokenizer_path())
    tokenizer.chunks.clear(), tokenizer.parts.clear()
    want = [row for part in packing.pieces(Docs())(iter([batch])) for row in part.to_pylist()]
    tokenizer.chunks.clear(), tokenizer.parts.clear()
    found, most = [], 0
    for part in packing.pieces(Docs(), slice_bytes=1000)(iter([batch])):
        found += part.to_pylist()
        most = max(most, len(tokenizer.chunks))
    assert found == want and len(found) == len(texts)
    # What one slice adds to a table that has just not reached its bound.
    assert most <= 100 + 1000 / len("w0x0 ")
    assert not tokenizer.chunks and not tokenizer.parts


def test_pages_survive_archives(spark, small, tmp_path):
    rng = random.Random(1)
    big, nasty = "".join(rng.choices("abcé☃\r\n", k=120_000)), "x WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 60
    rows = [
        (1, "http://a/ü?q=1 2", "<p>short</p>"), (2, None, "<p>short</p>"), (3, "u", big), (9, "u", big), (5, "u", big),
        (4, "u", None), (6, "u", ""), (7, "u", nasty), (8, "u", nasty), (None, "u", big), (10, "bad\r\nHeader: x", "y" * 1000),
        (11, "u", "z" * 999), (12, "u", "z" * 999), (9, "u", big),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS digest", "2 AS head")
    path = str(tmp_path / "warc")
    warc.write_archives(pages.repartition(3), path)
    got = warc.read_archives(spark, path).collect()
    want = []
    for page_id, _, html in rows:
        data = (html or "").encode()
        heads = [p for p, _, h in rows if h == html and p is not None and len(data) >= 1000]
        head = max(heads, default=page_id)
        revisit = len(data) >= 1000 and head != page_id
        want.append((page_id, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", head if revisit else None))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert any(b"continuation" in zlib.decompress(f.read_bytes(), 31) for f in (tmp_path / "warc").glob("*.gz"))
    assert warc.archive_pages(spark, pages.limit(0)).count() == 0


def test_broken_archives_are_errors():
    head = b"WARC-Type: response\r\nContent-Length: 50\r\n\r\n"
    with pytest.raises(ValueError, match="ends early"):
        list(warc.split_records(iter([("f", b""), ("f", head + b"short")])))
    with pytest.raises(ValueError, match="without a length"):
        list(warc.split_records(iter([("f", b""), ("f", b"WARC-Type: response\r\n\r\n")])))
    with pytest.raises(ValueError, match="chunk"):
        warc.unchunked(b"3\r\nabcd\r\n0\r\n\r\n")
    assert warc.unchunked(warc.chunked(b"ab" * 9000)) == b"ab" * 9000
    segments = pd.DataFrame({"origin": "o", "segment": [1, 3], "total": [0, 9], "block": [b"abc", b"def"], "page_id": 1, "payload_digest": ""})
    with pytest.raises(ValueError, match="do not make"):
        warc.reassembled(segments)


def test_queries_are_whole_and_registered():
    numbers = {int(name.split("_")[0][2:]) for name in PLANS}
    assert numbers == set(range(1, 14)) and len(PLANS) == 13


def test_pipeline(spark, small):
    documents = spark.read.parquet(f"{small}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "decontamination", "secret_scan", "packing",
    ]
    docs, kept = documents, [documents.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, small)
        assert after.columns == documents.columns
        assert after.select("doc_id").subtract(docs.select("doc_id")).count() == 0
        docs = after
        kept.append(docs.count())
    assert kept == sorted(kept, reverse=True) and 0.5 * kept[0] < kept[-1] < kept[0]
    packed = corpus_pipeline.run(spark, small).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.collect()}
    check_packing(packed, 4096)


def test_pipeline_stages_take_empty_and_odd_tables(spark, small):
    rows = [(None, None, None, None, None), (1, "the same words of the text", "en", "s", 1), (1, "", None, None, 0)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    odd = odd.selectExpr("*", "1 AS component_id", "2 AS leaked_doc_id", "3 AS gone_doc_id")
    for docs in (odd, odd.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            after = stage(spark, docs, small)
            assert after.count() <= 3
            if name != "packing":
                assert after.columns == docs.columns


def test_groups_stay_bounded_in_every_round(spark):
    lengths = np.random.default_rng(3).integers(1000, 2001, 6000)
    frame = pd.DataFrame({"doc_id": range(6000), "piece": 0, "start": 0, "length": lengths, "ids_crc32": 0})
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    packed = packing.pack(spark, spark.createDataFrame(frame, schema), group=300).collect()
    assert sorted(r.doc_id for r in packed) == list(range(6000))
    check_packing(packed, 4096)
    groups = {}
    for row in packed:
        groups[row.sequence_id >> 20] = groups.get(row.sequence_id >> 20, 0) + 1
    assert max(groups.values()) <= 450

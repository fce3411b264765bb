"""WARC archives of pages: written by Spark's own committer, read back record by record.

The writer frames payloads by chunked transfer encoding and cuts long blocks into segments. The reader
streams each archive once, groups continuation records by the record they continue, orders them by
segment number, verifies the total length and removes the framing. Of equal payloads one record is a
response and the others revisit it.

An archive is one gzip file per task, so a record never straddles tasks; reading needs one record in
memory at a time. Record ids are `<urn:page:ID:SHA1>`.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import map_columns, stored
from lakequery.storage import scratch_dir

VERSION = b"WARC/1.1\r\n"
# Blocks longer than this continue in further records; transfer chunks are at most this long.
SEGMENT_BYTES = 32 << 10
CHUNK_BYTES = 8 << 10
# Shorter payloads are always written whole.
REVISIT_BYTES = 1000
# The revisit profile and the date all records carry, as pages have none.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
URN = re.compile(r"<urn:page:(-?\d*):([0-9a-f]{40})(?::\d+)?>")

PARSED = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("origin", pa.string()),
        ("segment", pa.int64()),
        ("total", pa.int64()),
        ("block", pa.binary()),
    ]
)
RESULT = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def chunked(payload: bytes) -> bytes:
    parts = [payload[at : at + CHUNK_BYTES] for at in range(0, len(payload), CHUNK_BYTES)]
    return b"".join(b"%x\r\n%b\r\n" % (len(part), part) for part in [*parts, b""])


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; ValueError where the framing is broken."""
    parts, at = [], 0
    while True:
        line = body.index(b"\r\n", at)
        size = int(body[at:line].split(b";")[0], 16)
        at = line + 2
        if size == 0:
            return b"".join(parts)
        if body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a transfer chunk does not end where it says")
        parts.append(body[at : at + size])
        at += size + 2


def urn(page_id: int | None, digest: str, segment: int = 1) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{digest}{f':{segment}' if segment > 1 else ''}>"


def record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    """A record without its very last line end, which the text writer adds."""
    fields = [*fields, ("WARC-Date", DATE), ("Content-Length", str(len(block)))]
    head = "".join(f"{name}: {value}\r\n" for name, value in fields).encode()
    return VERSION + head + b"\r\n" + block + b"\r\n"


def records(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> Iterator[bytes]:
    """All records of one page: a revisit, or a response with its continuations."""
    target = [("WARC-Target-URI", quote(url, safe=":/?#[]@!$&'()*+,;=%~"))] if url else []
    common = [*target, ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if revisit:
        block = HTTP + b"Content-Length: %d\r\n\r\n" % len(payload)
        own = [("WARC-Type", "revisit"), ("WARC-Record-ID", urn(page_id, digest)), ("WARC-Profile", PROFILE), ("WARC-Refers-To", urn(refers_to, digest))]
        yield record(own + common, block)
        return
    block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(payload)
    if len(block) <= SEGMENT_BYTES:
        yield record([("WARC-Type", "response"), ("WARC-Record-ID", urn(page_id, digest)), *common], block)
        return
    cuts = range(0, len(block), SEGMENT_BYTES)
    for number, at in enumerate(cuts, 1):
        own = [("WARC-Type", "continuation" if at else "response"), ("WARC-Record-ID", urn(page_id, digest, number)), ("WARC-Segment-Number", str(number))]
        if at:
            own.append(("WARC-Segment-Origin-ID", urn(page_id, digest)))
        if number == len(cuts):
            own.append(("WARC-Segment-Total-Length", str(len(block))))
        yield record(own + (common if not at else target), block[at : at + SEGMENT_BYTES])


def planned(pages: DataFrame) -> DataFrame:
    """page_id, url, html and digest, with refers_to and revisit decided by payload.

    Null html is an empty payload. Null page_ids are smaller than others. Rows that repeat the largest
    page_id of a payload are all responses.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumn("digest", F.sha1(F.col("html").cast("binary")))
    long = F.octet_length("html") >= REVISIT_BYTES
    heads = (
        rows.where(long)
        .groupBy("digest")
        .agg(F.max("page_id").alias("head"), F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
        .drop("copies")
    )
    joined = rows.join(heads, "digest", "left")
    revisit = F.col("head").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("head"))
    return joined.select("page_id", "url", "html", "digest", "head", revisit.alias("revisit"))


def write_archives(pages: DataFrame, path: str) -> None:
    """Write every page to gzip archives under ``path``; a failed task leaves no part of a file."""
    schema = pa.schema([("value", pa.binary())])

    def run(c: dict[str, list]) -> dict[str, list]:
        rows = zip(c["page_id"], c["url"], c["html"], c["digest"], c["head"], c["revisit"])
        return {"value": [r for p, u, h, d, o, v in rows for r in records(p, u, h.encode(), d, o, v)]}

    lines = map_columns(planned(pages), schema, run).select(F.col("value").cast("string").alias("value"))
    lines.write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def split_records(rows: Iterator[tuple[str, bytes]]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, from what lies between version lines, in file order.

    A version line inside a block is part of it: a record goes on until its stated length is there.
    """
    held: bytes | None = None
    need, file = 0, None
    for path, piece in rows:
        if path != file:
            if held is not None:
                raise ValueError(f"a record of {file} ends early")
            file = path
            if piece == b"":
                continue
        held = piece if held is None else held + VERSION + piece
        if not need:
            end = held.find(b"\r\n\r\n")
            length = re.search(rb"(?im)^content-length:[ \t]*(\d+)", held[: max(0, end)])
            if end < 0 or not length:
                raise ValueError(f"{file} has a record without a length")
            need = end + 4 + int(length[1])
        if len(held) >= need:
            head, _, _ = held.partition(b"\r\n\r\n")
            fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n"))
            yield fields, held[need - int(fields["Content-Length"]) : need]
            held, need = None, 0
    if held is not None:
        raise ValueError(f"a record of {file} ends early")


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def parsed_row(fields: dict[str, str], block: bytes) -> tuple:
    """A row of ``PARSED``; segments keep their block until they are put together."""
    kind, number = fields["WARC-Type"], fields.get("WARC-Segment-Number")
    page, digest, _ = _urn(fields["WARC-Record-ID"])
    if number:
        origin = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
        return page, None, digest, "response", None, origin, int(number), int(fields.get("WARC-Segment-Total-Length", 0)), block
    if kind == "revisit":
        length = re.search(rb"(?im)^content-length: (\d+)", block)
        return page, int(length[1]), digest, kind, _urn(fields["WARC-Refers-To"])[0], None, None, None, None
    payload = payload_of(block)
    return page, len(payload), _verified(payload, digest), kind, None, None, None, None, None


def _urn(text: str) -> tuple[int | None, str, str]:
    found = URN.fullmatch(text)
    return (int(found[1]) if found[1] else None), found[2], text


def _verified(payload: bytes, digest: str) -> str:
    if hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"a payload does not have its digest {digest}")
    return digest


def reassembled(frame: pd.DataFrame) -> pd.DataFrame:
    """One record from its segments; every page that was written twice comes out twice."""
    copies = int((frame["segment"] == 1).sum())
    frame = frame.drop_duplicates("segment").sort_values("segment")
    block = b"".join(frame["block"])
    total = int(frame["total"].max())
    if list(frame["segment"]) != list(range(1, len(frame) + 1)) or len(block) != total:
        raise ValueError(f"the segments of {frame['origin'].iloc[0]} do not make {total} bytes")
    payload = payload_of(block)
    first = frame.iloc[0]
    row = {
        "page_id": first["page_id"],
        "payload_bytes": len(payload),
        "payload_digest": _verified(payload, first["payload_digest"]),
        "record_type": "response",
        "refers_to": None,
    }
    out = pd.DataFrame([row] * copies)
    return out.astype({"page_id": "Int64", "refers_to": "Int64"})


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    lines = spark.read.option("lineSep", VERSION.decode()).text(path)
    pieces = lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("value"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple[str, bytes]]:
            for batch in batches:
                yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())

        held, size = [], 0
        for fields, block in split_records(rows()):
            held.append(parsed_row(fields, block))
            size += len(held[-1][-1] or b"") + 200
            if size > 4 << 20:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)

    schema = f"{RESULT}, origin string, segment bigint, total bigint, block binary"
    parsed = stored(spark, pieces.mapInArrow(run, schema), "warc-records")
    whole = parsed.where(F.col("segment").isNull()).select(*[part.split()[0] for part in RESULT.split(", ")])
    segments = parsed.where(F.col("segment").isNotNull()).drop("payload_bytes", "record_type", "refers_to")
    return whole.unionByName(segments.groupBy("origin").applyInPandas(reassembled, RESULT))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), PARSED.types)], schema=PARSED)


def archive_pages(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write the pages' archives to the shared folder and read them back."""
    path = scratch_dir(spark, "warc")
    write_archives(pages, path)
    return read_archives(spark, path)

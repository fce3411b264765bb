"""Secret scans with structural confirmation.

Patterns propose, structure decides: beyond the base patterns, whose matches always stay, base64 or
hex characters are reported only when they decode to something with the inner structure of a key or a
signed token. Keys state their own lengths, so they are read from wherever one may start, inside a run
or not, over line breaks and written-out escapes of them, for as many bytes as they say. DER keys must have nested lengths that add up to the byte, SSH keys length
prefixes that do, armoured keys a body that decodes to either, tokens a JSON header naming an
algorithm. Offsets are code points, ends exclusive.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from lakequery.llm.common import documents, keep_rows, map_columns

# The base patterns. `hex` and `access` state their least lengths inside the pattern,
# which finds the same matches: a shorter run of the class holds no longer one.
ASSIGN = re.compile(
    r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII | re.IGNORECASE,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE_KINDS = ("assign", "access", "hex")
MIN_VALUE = 6

# Candidates for confirmation. Armour is bounded by its own end line or by what cannot be base64.
ARMOUR = re.compile(
    r"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s:,-]|\\+[nrt/])*?)-----END \1-----"
)
ESCAPED = re.compile(r"\\+([nrt/])")
# A whole run that two more parts follow, the places in it where a header may start, and those parts.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++={0,2}(?=\.[A-Za-z0-9_-]{2,}+={0,2}\.)")
HEADER = re.compile(r"(?=eyJ|ewo|eyA|ew0|IHsi)")
TOKEN_REST = re.compile(r"\.[A-Za-z0-9_-]{2,}={0,2}\.[A-Za-z0-9_-]*")
# A SEQUENCE with long-form length, or with a short one, and the OpenSSH magic start so.
BASE64_START = re.compile(r"(?=M[C-I][A-Za-z0-9+/_-]{14}|b3BlbnNzaC1rZXktdjEA)")
HEX_START = re.compile(r"(?=30[0-9A-Fa-f]{14}|6[Ff]70656[Ee]737368)")
BASE64_LINE, HEX_LINE = re.compile(r"[A-Za-z0-9+/_-]+"), re.compile(r"[0-9A-Fa-f]+")
BREAK = re.compile(r"(?:[ \t]*(?:\\+[nr]|[\r\n]))+[ \t]*")
# The order of kinds that share a start.
KINDS = (*BASE_KINDS, "jwt", "private_key", "der_key", "ssh_key")

# Object identifiers of key algorithms, DER content bytes in hex.
KEY_ALGORITHMS = {
    "2a864886f70d010101": "rsa",
    "2a8648ce3d0201": "ec",
    "2a8648ce380401": "dsa",
    "2b6570": "ed25519",
    "2b6571": "ed448",
    "2b656e": "x25519",
    "2b656f": "x448",
}
SSH_MAGIC = b"openssh-key-v1\x00"
SSH_NAMES = (b"ssh-rsa", b"ssh-dss", b"ssh-ed25519", b"ecdsa-sha2-")

Span = tuple[str, int, int]


def base_spans(text: str) -> list[Span]:
    """The base matches, by start and then by kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_VALUE]
    found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=_place)


def _place(span: Span) -> tuple[int, int, int]:
    return span[1], KINDS.index(span[0]), span[2]


def der_items(data: bytes) -> list[tuple[int, bytes]] | None:
    """The items of a DER value list, if their lengths fill ``data`` exactly."""
    items, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, length = data[at], data[at + 1]
        at += 2
        if length & 0x80:
            size = length & 0x7F
            if not 1 <= size <= 4 or at + size > len(data):
                return None
            length = int.from_bytes(data[at : at + size], "big")
            at += size
        if at + length > len(data):
            return None
        items.append((tag, data[at : at + length]))
        at += length
    return items


def is_der_key(data: bytes) -> bool:
    """Whether the bytes are one DER private key: PKCS#1, SEC 1 or PKCS#8, plain or encrypted."""
    outer = der_items(data)
    if not outer or len(outer) != 1 or outer[0][0] != 0x30:
        return False
    inner = der_items(outer[0][1])
    if not inner or len(inner) < 2:
        return False
    tags = [tag for tag, _ in inner]
    if len(inner) >= 9 and set(tags[:9]) == {0x02} and inner[0][1] in (b"\x00", b"\x01"):
        return len(inner[1][1]) >= 32
    if tags[:2] == [0x02, 0x04] and inner[0][1] == b"\x01" and 16 <= len(inner[1][1]) <= 66:
        return set(tags[2:]) <= {0xA0, 0xA1}
    if tags[:3] == [0x02, 0x30, 0x04] and inner[0][1] in (b"\x00", b"\x01"):
        algorithm = der_items(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and algorithm[0][1].hex() in KEY_ALGORITHMS
    if tags == [0x30, 0x04]:
        algorithm = der_items(inner[0][1])
        return bool(algorithm) and algorithm[0][0] == 0x06 and algorithm[0][1].startswith(b"\x2a\x86\x48\x86\xf7\x0d\x01")
    return False


def _ssh_strings(data: bytes, count: int) -> list[bytes] | None:
    found, at = [], 0
    for _ in range(count):
        if at + 4 > len(data):
            return None
        length = int.from_bytes(data[at : at + 4], "big")
        at += 4
        if at + length > len(data):
            return None
        found.append(data[at : at + length])
        at += length
    return [*found, data[at:]]


def is_ssh_key(data: bytes) -> bool:
    """Whether the bytes are an OpenSSH private key whose length prefixes fit."""
    if not data.startswith(SSH_MAGIC):
        return False
    head = _ssh_strings(data[len(SSH_MAGIC) :], 3)
    if head is None or len(head[3]) < 4 or int.from_bytes(head[3][:4], "big") < 1:
        return False
    keys = _ssh_strings(head[3][4:], 2)
    if keys is None or keys[2]:
        return False
    named = _ssh_strings(keys[0], 1)
    return named is not None and named[0].startswith(SSH_NAMES)


def decode64(run: str) -> bytes | None:
    """Base64 of either alphabet, padded or not; None where it cannot be."""
    body = run.rstrip("=").replace("-", "+").replace("_", "/")
    if len(body) % 4 == 1:
        return None
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def is_signed_token(header: str) -> bool:
    """Whether a token's first part decodes to a JSON object that names an algorithm."""
    if not header.startswith(("eyJ", "ewo", "eyA", "ew0", "IHsi")):
        return False
    data = decode64(header)
    try:
        parsed = json.loads(data) if data is not None else None
    except (ValueError, RecursionError):
        return False
    return isinstance(parsed, dict) and isinstance(parsed.get("alg"), str)


def _key_kind(data: bytes | None) -> str | None:
    if data is None:
        return None
    return "der_key" if is_der_key(data) else "ssh_key" if is_ssh_key(data) else None


def _taken(text: str, start: int, count: int, line: re.Pattern) -> tuple[str, int] | None:
    """The next ``count`` characters of lines like ``line`` without the breaks between, and their end."""
    parts, at = [], start
    while True:
        m = line.match(text, at, at + count) if at + count <= len(text) else None
        if not m:
            return None
        parts.append(m[0])
        at, count = m.end(), count - len(m[0])
        if not count:
            return "".join(parts), at
        broken = BREAK.match(text, at)
        if not broken:
            return None
        at = broken.end()


def key_at(text: str, start: int, line: re.Pattern) -> tuple[str, int] | None:
    """Kind and end of the key that starts here in base64 or hex, as ``line`` says, if there is one."""
    in_hex, end = line is HEX_LINE, start

    def first(size: int) -> bytes | None:
        nonlocal end
        taken = _taken(text, start, 2 * size if in_hex else -(-4 * size // 3), line)
        if taken is None:
            return None
        end = taken[1]
        return bytes.fromhex(taken[0]) if in_hex else decode64(taken[0])[:size]

    head = first(8)
    if head is None:
        return None
    size = der_size(head) if head[0] == 0x30 else ssh_size(first)
    data = first(size) if size else None
    kind = _key_kind(data)
    if kind is None:
        return None
    pad = 0 if in_hex else -size % 3
    return kind, end + pad * (text[end : end + pad] == "=" * pad)


def der_size(head: bytes) -> int | None:
    """Bytes of the SEQUENCE that starts so, if its first item may be a version or an algorithm."""
    size = head[1] & 0x7F if head[1] & 0x80 else 0
    if size > 4 or head[1] == 0x80 or head[2 + size] not in (0x02, 0x30):
        return None
    return 2 + size + (int.from_bytes(head[2 : 2 + size], "big") if size else head[1])


def ssh_size(first: Callable[[int], bytes | None]) -> int | None:
    """Bytes of the OpenSSH key whose first bytes ``first`` gives, from its length prefixes."""
    size = len(SSH_MAGIC)
    for skipped in (0, 0, 0, 4, 0):  # cipher, kdf, its options; after the number of keys public and private ones
        size += skipped
        data = first(size + 4)
        if data is None:
            return None
        size += 4 + int.from_bytes(data[size:], "big")
    return size


def confirmed_spans(text: str) -> Iterator[Span]:
    """Spans whose decoded content has the structure of a key or a token."""
    armoured = []
    for m in ARMOUR.finditer(text) if "-----BEGIN " in text else ():
        lines = ESCAPED.sub(lambda e: "/" if e[1] == "/" else "\n", m[2]).split("\n")
        body = "".join(line for line in lines if ":" not in line)
        if "ENCRYPTED" in m[1] or "Proc-Type" in m[2] or _key_kind(decode64("".join(body.split()))):
            armoured.append(m.span())
            yield "private_key", *m.span()
    for m in TOKEN.finditer(text) if "ey" in text or "ew" in text or "IHsi" in text else ():
        for start in HEADER.finditer(text, m.start(), m.end()):
            if m.end() - start.start() >= 8 and is_signed_token(text[start.start() : m.end()]):
                yield "jwt", start.start(), TOKEN_REST.match(text, m.end()).end()
                break
    for starts, line in ((BASE64_START, BASE64_LINE), (HEX_START, HEX_LINE)):
        past = 0
        for m in starts.finditer(text):
            if m.start() < past or any(a <= m.start() < b for a, b in armoured):
                continue
            if found := key_at(text, m.start(), line):
                kind, past = found
                yield kind, m.start(), past


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan_text(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and confirmed ones together; both by start and then by kind."""
    text = text or ""
    base = base_spans(text)
    added = set(confirmed_spans(text)).difference(base)
    return base, sorted([*base, *added], key=_place) if added else base


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``, whole texts scanned; null or empty texts have no spans.

    Columns: doc_id (null and repeated ones as given), n_assign, n_access, n_hex, base_sha256, spans.
    """
    schema = pa.schema(
        [("doc_id", pa.int64())]
        + [(f"n_{kind}", pa.int64()) for kind in BASE_KINDS]
        + [("base_sha256", pa.string()), ("spans", pa.string())]
    )

    def run(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in schema.names}
        out["doc_id"] = c["doc_id"]
        for text in c["text"]:
            base, every = scan_text(text)
            kinds = [kind for kind, _, _ in base]
            for kind in BASE_KINDS:
                out[f"n_{kind}"].append(kinds.count(kind))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(every))
        return out

    return map_columns(documents(docs), schema, run)


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a secret; those with any span go. Rows keep all columns."""
    return keep_rows(docs, "text", lambda texts: [not scan_text(text)[1] for text in texts])

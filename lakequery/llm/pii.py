"""Personal data by a semi-Markov conditional random field over candidate stretches of text.

Base patterns find plain forms, and their matches always stay. The field adds the forms they miss,
such as `ann (at) mail dot org` or a national phone number. It scores whole segments, not tokens: a
segment's features are its shape, digit count, checksum and the words before it. Dynamic programming
over segments of at most ``MAX_TOKENS`` tokens chooses boundaries and types of a stretch jointly.
Tokens outside stretches can only be plain text, so a document is solved stretch by stretch.

The field is trained by likelihood on the driver, on generated stretches of every type and on a
bounded sample of stretches of the corpus that the base patterns label. Offsets are code points.
"""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakequery.llm.common import documents, map_columns

# The base patterns, with possessive repeats so that long runs stay linear.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")

# Candidate stretches: numbers with separators, and words joined by an at and dots in some spelling.
NUMBERS = re.compile(r"[+(]{0,2}[0-9](?:[\x20().\-/]{0,3}[0-9])++")
AT_SIGN = re.compile(r"@|[\[({<]\x20?at\x20?[\])}>]|\x20at\x20", re.ASCII | re.IGNORECASE)
AT = r"(?:\x20?@\x20?|\x20?[\[({<]\x20?at\x20?[\])}>]\x20?|\x20at\x20)"
DOT = r"(?:\.|\x20?[\[({<]\x20?dot\x20?[\])}>]\x20?|\x20dot\x20)"
MAIL_TAIL = re.compile(rf"{AT}[A-Za-z0-9-]++(?:{DOT}[A-Za-z0-9-]++)+", re.ASCII | re.IGNORECASE)
MIN_DIGITS = 7
TOKEN = re.compile(r"[0-9]+|[A-Za-z]+|[^0-9A-Za-z]")
CUE = re.compile(r"[a-z]+")
MAX_TOKENS = 24
MAX_LOCAL = 64
CUE_CHARS = 24

# Size of the training sample and of the training itself.
SAMPLE_DOCUMENTS = 400
SAMPLE_STRETCHES = 300
GENERATED = 60
EPOCHS = 6

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = sum(int(d) for d in digits[-1::-2])
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """The base matches, by kind as listed and then by start."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        if tail := DOMAIN.match(text, at + 1):
            start = at
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                end = tail.end()
                found.append(("email", start, end))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0]) if len(m[0]) < 40 else ""
        if 16 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return found


def stretches(text: str) -> list[tuple[int, int]]:
    """Where anything but plain text may lie, in order and not overlapping."""
    found = []
    for m in NUMBERS.finditer(text):
        if sum("0" <= c <= "9" for c in m[0]) >= MIN_DIGITS:
            found.append(m.span())
    for m in AT_SIGN.finditer(text):
        spaced = m.start() > 0 and text[m.start() - 1] == " "
        tail = MAIL_TAIL.match(text, m.start() - spaced)
        if tail:
            start = tail.start()
            while start > 0 and text[start - 1] in LOCAL and tail.start() - start < MAX_LOCAL:
                start -= 1
            if start < tail.start():
                found.append((start, tail.end()))
    merged: list[list[int]] = []
    for start, end in sorted(found):
        if merged and start < merged[-1][1]:
            merged[-1][1] = max(end, merged[-1][1])
        else:
            merged.append([start, end])
    return [(start, end) for start, end in merged]


def segment_features(text: str, start: int, end: int) -> list[str]:
    """Features of one whole candidate segment, and of the text just before and after it."""
    span = text[start:end]
    digits = digits_of(span)
    shape = re.sub("[A-Za-z]+", "a", re.sub("[0-9]+", lambda m: str(min(len(m[0]), 9)), span))
    before, after = text[max(0, start - 1) : start], text[end : end + 1]
    cues = CUE.findall(text[max(0, start - CUE_CHARS) : start].lower())[-2:]
    parts = re.split(r"\.", span)
    found = [
        "bias",
        f"shape={shape[:24]}",
        f"first={_kind(span[0])}",
        f"last={_kind(span[-1])}",
        f"before={_kind(before)}",
        f"after={_kind(after)}",
        f"digits={min(len(digits), 20)}",
        *(f"cue={cue}" for cue in cues),
    ]
    if re.search("[A-Za-z]", span):
        found.append(f"at={len(AT_SIGN.findall(span))}")
        found.append(f"mail={bool(re.fullmatch(rf'[A-Za-z0-9][A-Za-z0-9._%+-]*{MAIL_TAIL.pattern}', span, re.ASCII | re.IGNORECASE))}")
    elif len(digits) >= 13:
        found.append(f"luhn={luhn(digits)},{16 <= len(digits) <= 19}")
    if len(parts) == 4 and all(p.isdigit() for p in parts):
        found.append(f"octets={all(int(p) <= 255 for p in parts if len(p) < 9)}")
    return found


def _kind(char: str) -> str:
    return "d" if char.isdigit() else "a" if char.isalpha() else "s" if char.isspace() else char or "end"


class Field:
    """Weights of every feature for every kind; plain tokens score zero."""

    def __init__(self, weights: dict[str, np.ndarray]):
        self.weights = weights
        self.zero = np.zeros(len(KINDS))

    def lattice(self, text: str, start: int, end: int) -> list[tuple[int, int, int, int, list[str]]]:
        """Candidate segments of a stretch: first token, token after the last, both offsets, features."""
        tokens = [m.span() for m in TOKEN.finditer(text, start, end)]
        out = []
        for i, (a, _) in enumerate(tokens):
            if text[a].isspace() or text[a] in ")].,-/":
                continue
            for j in range(i + 1, min(i + MAX_TOKENS, len(tokens)) + 1):
                b = tokens[j - 1][1]
                if text[b - 1].isalnum() and (b - a) >= 5:
                    out.append((i, j, a, b, segment_features(text, a, b)))
        return out

    def score(self, features: list[str]) -> np.ndarray:
        total = self.zero
        for name in features:
            if (w := self.weights.get(name)) is not None:
                total = total + w
        return total

    def decode(self, text: str, start: int, end: int) -> list[Span]:
        """The best segmentation of a stretch, without its plain tokens."""
        size = sum(1 for _ in TOKEN.finditer(text, start, end))
        ending: dict[int, list] = {}
        for i, j, a, b, features in self.lattice(text, start, end):
            scores = self.score(features)
            k = int(scores.argmax())
            if scores[k] > 0:
                ending.setdefault(j, []).append((float(scores[k]), i, (KINDS[k], a, b)))
        best: list[float] = [0.0] * (size + 1)
        back: list[tuple[int, Span | None]] = [(0, None)] * (size + 1)
        for j in range(1, size + 1):
            best[j], back[j] = best[j - 1], (j - 1, None)
            for score, i, span in ending.get(j, ()):
                if best[i] + score > best[j]:
                    best[j], back[j] = best[i] + score, (i, span)
        found, j = [], size
        while j > 0:
            j, span = back[j]
            if span:
                found.append(span)
        return found[::-1]


def _log_sum(values: list[float]) -> float:
    top = max(values)
    return top + math.log(sum(math.exp(v - top) for v in values))


def fit(examples: list[tuple[str, int, int, list[Span]]]) -> Field:
    """Maximum likelihood by stochastic gradient with adaptive steps; examples are labelled stretches."""
    weights: dict[str, np.ndarray] = {}
    squares: dict[str, np.ndarray] = {}
    field = Field(weights)
    made = []
    for text, start, end, gold in examples:
        size = sum(1 for _ in TOKEN.finditer(text, start, end))
        made.append((size, field.lattice(text, start, end), {(a, b): KINDS.index(k) for k, a, b in gold}))
    order = list(range(len(made)))
    for epoch in range(EPOCHS):
        random.Random(epoch).shuffle(order)
        for n in order:
            size, lattice, gold = made[n]
            scored = [field.score(features) for *_, features in lattice]
            ending: dict[int, list[int]] = {}
            starting: dict[int, list[int]] = {}
            for at, (i, j, *_) in enumerate(lattice):
                ending.setdefault(j, []).append(at)
                starting.setdefault(i, []).append(at)
            sums = [_log_sum(list(s)) for s in scored]
            ahead, behind = [0.0] * (size + 1), [0.0] * (size + 1)
            for j in range(1, size + 1):
                ahead[j] = _log_sum([ahead[j - 1], *(ahead[lattice[x][0]] + sums[x] for x in ending.get(j, ()))])
            for i in range(size - 1, -1, -1):
                behind[i] = _log_sum([behind[i + 1], *(behind[lattice[x][1]] + sums[x] for x in starting.get(i, ()))])
            for x, (i, j, a, b, features) in enumerate(lattice):
                gradient = -np.exp(scored[x] + (ahead[i] + behind[j] - ahead[size]))
                if (a, b) in gold:
                    gradient[gold[a, b]] += 1
                if np.abs(gradient).max() < 1e-4:
                    continue
                for name in features:
                    if name not in weights:
                        weights[name], squares[name] = np.zeros(len(KINDS)), np.full(len(KINDS), 1e-2)
                    squares[name] += gradient * gradient
                    weights[name] += 0.3 * gradient / np.sqrt(squares[name]) - 1e-4 * weights[name]
    return field


def _with_check_digit(body: str) -> str:
    return next(body + str(d) for d in range(10) if luhn(body + str(d)))


def generated_examples(seed: int = 11) -> list[tuple[str, int, int, list[Span]]]:
    """Stretches of every kind in many spellings, and numbers that are none, by a seeded rule."""
    rng = random.Random(seed)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    word = lambda: "".join(rng.choice("abcdefghiklmnoprstuvw") for _ in range(rng.randint(2, 8)))

    def mail() -> str:
        at = rng.choice(["@", " (at) ", " [at] ", "(at)", " at ", "[at]", " @ ", "{at}", "<at>"])
        dot = rng.choice([".", " dot ", " (dot) ", "[dot]"]) if at != "@" else "."
        if at == " at ":
            dot = " dot "
        return f"{word()}{rng.choice(['', '.' + word(), digits(2)])}{at}{word()}{dot}{rng.choice(['com', 'org', 'net', 'de'])}"

    def phone() -> str:
        return rng.choice(
            [
                f"+{digits(1)} ({digits(3)}) {digits(3)}-{digits(4)}",
                f"({digits(3)}) {digits(3)}-{digits(4)}",
                f"{digits(3)}-{digits(3)}-{digits(4)}",
                f"+{digits(2)} {digits(3)} {digits(7)}",
                f"00{digits(2)} {digits(3)} {digits(6)}",
            ]
        )

    def card() -> str:
        n = _with_check_digit(digits(15))
        return rng.choice([n, " ".join(n[i : i + 4] for i in (0, 4, 8, 12)), "-".join(n[i : i + 4] for i in (0, 4, 8, 12)), ".".join(n[i : i + 4] for i in (0, 4, 8, 12)), "/".join(n[i : i + 4] for i in (0, 4, 8, 12))])

    def address() -> str:
        return ".".join(str(rng.randint(0, 255)) for _ in range(4))

    def none() -> str:
        wrong = str(int(_with_check_digit(digits(15))[-1]) ^ 1)
        return rng.choice(
            [
                f"{rng.randint(1900, 2030)}-{digits(2)}-{digits(2)}",
                f"{digits(2)}.{digits(2)}.{rng.randint(1900, 2030)}",
                digits(rng.choice([7, 8, 9, 10, 11, 12, 13, 14, 20, 24])),
                f"{digits(3)}.{digits(6)}",
                f"{rng.randint(256, 999)}.{rng.randint(256, 999)}.{rng.randint(256, 999)}.{digits(1)}",
                next(n for n in iter(lambda: digits(15) + wrong, None) if not luhn(n)),
                " ".join(digits(rng.randint(1, 2)) for _ in range(8)),
                f"978-{digits(1)}-{digits(4)}-{digits(4)}-{digits(1)}",
                f"{digits(4)}-{digits(4)}",
                f"{digits(2)} {digits(3)} {digits(3)}",
            ]
        )

    out = []
    for kind, make in (("email", mail), ("phone", phone), ("card", card), ("ip", address), (None, none), (None, none)):
        for _ in range(GENERATED):
            left, span = f"{word()} {word()} ", make()
            text = f"{left}{span}{rng.choice(['.', ' ', ', ', '!'])}{word()}"
            gold = [(kind, len(left), len(left) + len(span))] if kind else []
            for start, end in stretches(text):
                out.append((text, start, end, [g for g in gold if start <= g[1] and g[2] <= end]))
    return out


def train(docs: DataFrame) -> Field:
    """Fit on generated stretches and on those of at most ``SAMPLE_DOCUMENTS`` documents of the corpus.

    The documents are the ones with the smallest hash of doc_id among those that hold a stretch, so
    the sample is bounded and the same at each run. Their base matches are the labels.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("around", pa.list_(pa.string()))])

    def run(c: dict[str, list]) -> dict[str, list]:
        around = [
            [text[max(0, a - CUE_CHARS - 2) : b + 2] for a, b in stretches(text) if b - a <= 200][:4]
            for text in (t or "" for t in c["text"])
        ]
        rows = [k for k, found in enumerate(around) if found]
        return {"doc_id": [c["doc_id"][k] for k in rows], "around": [around[k] for k in rows]}

    sampled = documents(docs).where(F.pmod(F.xxhash64("doc_id"), F.lit(_SHARES)) < _share(docs))
    rows = (
        map_columns(sampled, schema, run)
        .orderBy(F.xxhash64("doc_id"), "doc_id", F.array_join("around", "\n"))
        .limit(SAMPLE_DOCUMENTS)
        .collect()
    )
    pieces = [piece for row in rows for piece in row.around][:SAMPLE_STRETCHES]
    examples = generated_examples()
    for piece in pieces:
        gold = base_spans(piece)
        for start, end in stretches(piece):
            examples.append((piece, start, end, [g for g in gold if start <= g[1] and g[2] <= end]))
    return fit(examples)


_SHARES = 1 << 20


def _share(docs: DataFrame) -> int:
    """Of ``_SHARES`` parts, how many to look through for the training sample."""
    return math.ceil(_SHARES * min(1.0, 50 * SAMPLE_DOCUMENTS / max(1, docs.select("doc_id").count())))


def scan_text(text: str | None, field: Field) -> tuple[list[Span], list[Span]]:
    """Base spans, and base and added ones together, each by kind and then by start.

    An added span never overlaps a base one.
    """
    text = text or ""
    base = base_spans(text)
    taken = sorted((a, b) for _, a, b in base)
    added = []
    for start, end in stretches(text):
        inside = [(a, b) for a, b in taken if a < end and start < b]
        if any(a <= start and end <= b for a, b in inside):
            continue
        for span in field.decode(text, start, end):
            if not any(a < span[2] and span[1] < b for a, b in inside):
                added.append(span)
    return base, sorted([*base, *added], key=_place) if added else base


def _place(span: Span) -> tuple[int, int, int]:
    return KINDS.index(span[0]), span[1], span[2]


def joined(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scanner(field: Field) -> Callable[[dict[str, list]], dict[str, list]]:
    def run(c: dict[str, list]) -> dict[str, list]:
        out: dict[str, list] = {name: [] for name in SCHEMA.names}
        out["doc_id"] = c["doc_id"]
        for text in c["text"]:
            base, every = scan_text(text, field)
            kinds = [kind for kind, _, _ in base]
            for kind in KINDS:
                out[f"n_{kind}"].append(kinds.count(kind))
            out["base_sha256"].append(hashlib.sha256(joined(base).encode()).hexdigest())
            out["spans"].append(joined(every))
        return out

    return run


SCHEMA = pa.schema(
    [("doc_id", pa.int64())]
    + [(f"n_{kind}", pa.int64()) for kind in KINDS]
    + [("base_sha256", pa.string()), ("spans", pa.string())]
)


def find_personal_data(docs: DataFrame, field: Field | None = None) -> DataFrame:
    """One row per row of ``docs``, whole texts scanned; null or empty texts have no spans.

    Columns: doc_id (null and repeated ones as given), n_email, n_ip, n_card, n_phone, base_sha256,
    spans.
    """
    return map_columns(documents(docs), SCHEMA, scanner(field or train(docs)))

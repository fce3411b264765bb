"""Language identification by hierarchical discrimination: family first, then pairs within it.

A text is the mean of its words, a word the mean of its hashed character n-grams, so that every
linear score of a text is a mean of scores of words and a batch scores each distinct word once.
One-versus-rest linear support vector machines choose the language family; one-versus-one machines
vote among the languages of that family.

Machines only rank languages, and two of them are each other's mirror, so what is in no known language
is found after them: by how likely the n-grams of a text are in the language they name, against its
labelled texts.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakequery.llm.common import keep_rows, map_columns, slices

BUCKETS = 4096
MAX_GRAM = 4
# Sizes of the sample that the machines are fitted on.
ROWS_PER_LANGUAGE = 1000
MAX_LANGUAGES = 200
EPOCHS = 12
PENALTY = 1e-4
# Text whose n-grams are held at a time, about 60 times its size in memory.
SLICE_BYTES = 1 << 20
# Steepness of the map from margins to scores.
SLOPE = 3.0
# Share of a text's n-grams that each language leaves for those it was not seen with; the least spread
# of a language's texts; how many spreads a text may lie under their middle (labelled texts of the
# tables reach 14.4); and from how many different words on more of them no longer narrow the spread.
UNSEEN = 0.05
LEAST_SPREAD = 0.2
MAX_SPREADS = 15.0
# Score from which on the language that the machines name is the only one a text is held against. Under it
# lie about 1 in 100 texts, such as those in two languages.
SURE = 0.8
FULL_VARIETY = 60

# Languages of the larger families by ISO 639-1 code; any other is its own family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is fy lb af yi fo",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "baltic": "lt lv",
    "uralic": "fi et hu se",
    "turkic": "tr az kk uz ky tk tt",
    "indic": "hi bn ur pa mr gu ne si as or",
    "dravidian": "ta te kn ml",
    "semitic": "ar he mt am",
    "iranian": "fa ps ku tg",
    "celtic": "ga gd cy br",
    "malayic": "id ms jv su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

# Multipliers of the n-gram hash, one per place.
PLACES = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint64)


@dataclass
class Words:
    """The distinct lower-case words of some texts, and each text's words as places among them."""

    distinct: pa.Array
    index: np.ndarray
    bounds: np.ndarray

    @classmethod
    def of(cls, texts: list[str | None]) -> Words:
        lower = pc.utf8_lower(pa.array([text or "" for text in texts], pa.string()))
        letters = pc.utf8_trim(pc.replace_substring_regex(lower, r"[^\p{L}]+", " "), " ")
        split = pc.split_pattern(letters, " ")
        coded = split.flatten().dictionary_encode()
        index = coded.indices.to_numpy(zero_copy_only=False)
        real = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False) > 0
        kept = real[index] if len(index) else np.zeros(0, bool)
        bounds = np.concatenate([[0], np.cumsum(kept)])[split.offsets.to_numpy()]
        return cls(coded.dictionary, index[kept], bounds)

    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def variety(self) -> np.ndarray:
        """How many words of equal weight each text is worth: fewer, the more they repeat."""
        n = max(1, len(self.distinct))
        owner = np.repeat(np.arange(len(self.bounds) - 1), self.counts())
        pairs, times = np.unique(owner * n + self.index, return_counts=True)
        squares = np.bincount(pairs // n, times.astype(float) ** 2, len(self.bounds) - 1)
        return self.counts() ** 2 / np.maximum(1, squares)

    def means(self, weights: np.ndarray) -> np.ndarray:
        """For each text and column of ``weights`` the mean over its words of their mean weight."""
        buckets, owners = self.grams()
        n = len(self.distinct)
        sizes = np.maximum(1, np.bincount(owners, minlength=n))
        means = np.empty((len(self.bounds) - 1, weights.shape[1]))
        for k, column in enumerate(weights.T):
            of_words = np.bincount(owners, column[buckets], n) / sizes
            sums = np.concatenate([[0], np.cumsum(of_words[self.index])])[self.bounds]
            means[:, k] = np.diff(sums) / np.maximum(1, self.counts())
        return means

    def grams(self) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the n-grams of all distinct words with their ends marked, and whose they are."""
        marked = pc.binary_join_element_wise("<", self.distinct, ">", "")
        sizes = pc.utf8_length(marked).to_numpy(zero_copy_only=False).astype(np.int64)
        points = np.frombuffer("".join(marked.to_pylist()).encode("utf-32-le"), "<u4").astype(np.uint64)
        owner = np.repeat(np.arange(len(sizes)), sizes)
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(points))
        buckets, owners = [], []
        rolled = np.zeros(len(points), np.uint64)
        for n in range(1, MAX_GRAM + 1):
            size = max(0, len(points) - n + 1)
            rolled = rolled[:size] + (points[n - 1 :] + np.uint64(1)) * PLACES[n - 1]
            mixed = (rolled + np.uint64(n)) * np.uint64(0xFF51AFD7ED558CCD)
            inside = left[:size] >= n
            buckets.append((mixed >> np.uint64(40))[inside] % np.uint64(BUCKETS))
            owners.append(owner[:size][inside])
        return np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


def features(texts: list[str | None]) -> list[np.ndarray]:
    """For each text the mean over its words of their mean n-gram vectors; zeros without words."""
    words = Words.of(texts)
    buckets, owners = words.grams()
    order = np.argsort(owners, kind="stable")
    sizes = np.bincount(owners, minlength=len(words.distinct))
    ends = np.cumsum(sizes)
    found = []
    for start, end in zip(words.bounds, words.bounds[1:]):
        seen, times = np.unique(words.index[start:end], return_counts=True)
        lengths = sizes[seen]
        places = np.repeat(ends[seen] - np.cumsum(lengths), lengths) + np.arange(lengths.sum())
        share = np.repeat(times / np.maximum(1, lengths), lengths) / max(1, end - start)
        found.append(np.bincount(buckets[order[places]], share, BUCKETS))
    return found


def fit_svm(x: np.ndarray, positive: np.ndarray, seed: int = 7) -> tuple[np.ndarray, float]:
    """An averaged linear support vector machine by subgradient steps on the hinge loss.

    Both sides weigh the same, however many rows each has.
    """
    y = np.where(positive, 1.0, -1.0)
    weight = np.where(positive, 0.5 / positive.sum(), 0.5 / (~positive).sum()) * len(y)
    scale = 1 / max(1e-12, float(np.sqrt((x * x).sum(1)).mean()))
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, steps = np.zeros(x.shape[1]), 0.0, 0
    order, rng, size = np.arange(len(y)), np.random.default_rng(seed), 32
    for epoch in range(EPOCHS):
        rng.shuffle(order)
        for start in range(0, len(order), size):
            rows = order[start : start + size]
            batch = x[rows] * scale
            wrong = y[rows] * (batch @ w + b) < 1
            rate = 1.0 / (1 + 0.02 * (epoch * len(order) / size + start / size))
            push = (weight[rows] * y[rows] * wrong) / len(rows)
            w = w * (1 - rate * PENALTY) + rate * (push @ batch)
            b += 0.1 * rate * push.sum()
            if epoch >= EPOCHS // 2:
                steps += 1
                mean_w += (w - mean_w) / steps
                mean_b += (b - mean_b) / steps
    return mean_w * scale, mean_b


@dataclass
class Model:
    """Machines in the columns of ``weights``: families first, then the pairs of each family."""

    languages: list[str]
    families: dict[str, list[str]]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    bias: np.ndarray

    def scores(self, texts: list[str | None]) -> list[np.ndarray | None]:
        """Every machine's output for each whole text; None without words."""
        words = Words.of(texts)
        means = words.means(self.weights) + self.bias
        return [mean if count else None for mean, count in zip(means, words.counts())]

    def decide(self, scores: np.ndarray) -> tuple[str, float]:
        """The language of a text with these machine outputs, and how sure that is, 0 to 1."""
        names = list(self.families)
        margins = scores[: len(names)]
        best = int(margins.argmax())
        sure = 1.0
        if len(names) > 1:
            sure = _squash(margins[best] - np.delete(margins, best).max())
        members = self.families[names[best]]
        wins = {language: [] for language in members}
        for k, (a, b) in enumerate(self.pairs):
            if a in wins and b in wins:
                margin = scores[len(names) + k]
                wins[a].append(margin)
                wins[b].append(-margin)
        chosen = max(
            sorted(members), key=lambda m: (sum(v > 0 for v in wins[m]), sum(wins[m]))
        )
        return chosen, float(min([sure, *map(_squash, wins[chosen])]))


def _squash(margin: float) -> float:
    return float(1 / (1 + np.exp(-np.clip(SLOPE * margin, -50, 50))))


def fit(langs: list[str], x: np.ndarray) -> Model | None:
    """All machines, from rows of features and their languages."""
    if not langs:
        return None
    labels = np.array(langs)
    families: dict[str, list[str]] = {}
    for language in sorted(set(langs)):
        families.setdefault(FAMILY_OF.get(language.lower(), language), []).append(language)
    kinds = np.array([FAMILY_OF.get(language.lower(), language) for language in langs])
    machines = []
    for family in families:
        one = len(families) == 1
        machines.append((np.zeros(BUCKETS), 0.0) if one else fit_svm(x, kinds == family))
    pairs = [pair for members in families.values() for pair in combinations(members, 2)]
    for a, b in pairs:
        rows = (labels == a) | (labels == b)
        machines.append(fit_svm(x[rows], labels[rows] == a))
    weights = np.stack([w for w, _ in machines], 1).astype(np.float32)
    return Model(sorted(set(langs)), families, pairs, weights, np.array([b for _, b in machines]))


@dataclass
class Known:
    """Per language the log-likelihood of each bucket, and the middle and spread of its own texts'.

    A text's likelihood is a mean over words, so it is held against the spread of texts as varied.
    """

    languages: list[str]
    weights: np.ndarray
    middle: np.ndarray
    spread: np.ndarray

    def likely(self, means: np.ndarray, variety: np.ndarray) -> np.ndarray:
        """Whether each text with these likelihoods is as likely in each language as its labelled texts are."""
        return (self.middle - means) * _narrowing(variety)[:, None] <= MAX_SPREADS * self.spread


def _narrowing(variety: np.ndarray) -> np.ndarray:
    return np.sqrt(np.clip(variety, 1, FULL_VARIETY))


def _likelihood(sums: np.ndarray, rows: int) -> np.ndarray:
    return np.log((1 - UNSEEN) * sums * (BUCKETS / rows) + UNSEEN)


def know(langs: list[str], x: np.ndarray, variety: np.ndarray) -> Known | None:
    """Learn from rows of features, their languages and how varied each text is.

    Each labelled text is measured against the others of its language. Middle and spread are medians,
    so junk among the labelled texts does not move them; a lone text is measured against itself.
    """
    labels = np.array(langs)
    languages, weights, middle, spread = [], [], [], []
    for language in sorted(set(langs)):
        rows = np.flatnonzero((labels == language) & (variety > 0))
        if not len(rows):
            continue
        sums = x[rows].sum(0, dtype=np.float64)
        others, n = (1, len(rows) - 1) if len(rows) > 1 else (0, 1)
        found = np.array([x[k] @ _likelihood(np.maximum(0, sums - others * x[k]), n) for k in rows])
        languages.append(language)
        weights.append(_likelihood(sums, len(rows)))
        middle.append(np.median(found))
        spread.append(1.4826 * np.median(np.abs(found - middle[-1]) * _narrowing(variety[rows])))
    if not weights:
        return None
    # Few or equal texts show no spread; then that of the other languages holds.
    least = max(LEAST_SPREAD, float(np.median(spread)))
    return Known(languages, np.stack(weights, 1), np.array(middle), np.maximum(spread, least))


@dataclass
class Identifier:
    """The machines, which name a text's language, and what the labelled texts of that language are like."""

    model: Model
    known: Known

    def accepts(self, texts: list[str | None]) -> list[bool]:
        """Whether each text has words and is likely in the language that the machines name, or, if they are unsure, in any."""
        words = Words.of(texts)
        machines = self.model.weights.shape[1]
        means = words.means(np.hstack([self.model.weights, self.known.weights]))
        places = {language: k for k, language in enumerate(self.known.languages)}
        named = [self.model.decide(row) for row in means[:, :machines] + self.model.bias]
        likely = self.known.likely(means[:, machines:], words.variety())
        return [
            bool(count and (row[places[language]] if score >= SURE else row.any()))
            for count, row, (language, score) in zip(words.counts(), likely, named)
        ]


def identifier(docs: DataFrame) -> Identifier | None:
    """All machines and likelihoods, fitted on a sample of the rows with a language and words."""
    langs, x, variety = sample(docs)
    taught = np.flatnonzero(variety > 0)
    langs, x = [langs[k] for k in taught], x[taught]
    if not langs:
        return None
    return Identifier(fit(langs, x), know(langs, x, variety[taught]))


def sample(docs: DataFrame) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, features and variety of at most about ``ROWS_PER_LANGUAGE`` rows of each language, chosen by a hash of doc_id.

    ``docs`` has doc_id, text and lang. Rows without a language teach nothing. Features are made in
    the tasks; the driver gets 8 KB a sampled row. More than ``MAX_LANGUAGES`` languages are an error.
    """
    labelled = docs.where(F.col("lang").isNotNull())
    counts = labelled.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(counts) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not counts:
        return [], np.zeros((0, BUCKETS), np.float32), np.zeros(0)
    cut = F.lit(None).cast("double")
    for lang, n in counts:
        cut = F.when(F.col("lang") == lang, F.lit(min(1.0, ROWS_PER_LANGUAGE / n))).otherwise(cut)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = labelled.where(place < cut).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("x", pa.binary()), ("variety", pa.float64())])
    rows = map_columns(
        chosen,
        schema,
        lambda c: {
            "lang": c["lang"],
            "x": [
                x.astype(np.float16).tobytes()
                for rows in slices([t or "" for t in c["text"]], SLICE_BYTES)
                for x in features(c["text"][rows.start : rows.stop])
            ],
            "variety": [
                float(n)
                for rows in slices([t or "" for t in c["text"]], SLICE_BYTES)
                for n in Words.of(c["text"][rows.start : rows.stop]).variety()
            ],
        },
    ).limit(2 * ROWS_PER_LANGUAGE * len(counts)).collect()
    rows = sorted((r.lang, bytes(r.x), r.variety) for r in rows)
    x = np.array([np.frombuffer(v, np.float16) for _, v, _ in rows], np.float32).reshape(-1, BUCKETS)
    return [lang for lang, _, _ in rows], x, np.array([n for _, _, n in rows], float)


def train(docs: DataFrame) -> Model | None:
    """All machines, fitted on a sample of the rows with a language."""
    langs, x, _ = sample(docs)
    return fit(langs, x)


def scored(model: Model | None, texts: list[str | None]) -> list[np.ndarray | None]:
    """Machine outputs of whole texts, about a megabyte of text at a time."""
    if model is None:
        return [None] * len(texts)
    return [
        row for rows in slices([t or "" for t in texts], SLICE_BYTES) for row in model.scores(texts[rows.start : rows.stop])
    ]


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """Language and score of every row's whole text.

    A text that is null, empty or without letters gets ``und`` and 0, and so does every text where
    nothing could be learned. Rows of any doc_id, null or repeated, give one row each.
    """
    schema = pa.schema(
        [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("lang_pred", pa.string()), ("score", pa.float64())]
    )

    def run(c: dict[str, list]) -> dict[str, list]:
        outputs = scored(model, c["text"])
        found = [("und", 0.0) if output is None else model.decide(output) for output in outputs]
        return {
            "doc_id": c["doc_id"],
            "held_out": c["held_out"],
            "lang_pred": [lang for lang, _ in found],
            "score": [score for _, score in found],
        }

    return map_columns(docs.select("doc_id", "held_out", "text"), schema, run)


def with_fold(docs: DataFrame) -> DataFrame:
    """doc_id, text, lang and whether the row is held out: crc32 of the id's text modulo 4 is 2.

    A null doc_id is neither held out nor learned from.
    """
    doc_id = F.col("doc_id").cast("long")
    fold = F.crc32(doc_id.cast("string").cast("binary")) % 4
    return docs.select(
        doc_id.alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
        F.coalesce(fold == 2, F.lit(False)).alias("held_out"),
    )


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows not held out and predict all: doc_id, held_out, lang_pred, score."""
    rows = with_fold(docs)
    model = train(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return predict(rows, model)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language: those without letters, or too unlikely in the language the machines name, go.

    Where the machines are unsure, as of a text in two languages, it goes if unlikely in all. Rows keep all columns. Where no row has a language to learn from, nothing can be judged, and
    only the texts without letters go.
    """
    rows = with_fold(docs)
    found = identifier(rows.where(~F.col("held_out") & F.col("doc_id").isNotNull()))

    def keep(texts: list) -> list[bool]:
        if found is None:
            return [bool(n) for n in Words.of(texts).counts()]
        parts = slices([t or "" for t in texts], SLICE_BYTES)
        return [kept for rows in parts for kept in found.accepts(texts[rows.start : rows.stop])]

    return keep_rows(docs, "text", keep)

"""Toxicity of a text by a weighted lexicon.

Text is folded first (case, accents, look-alike letters of other scripts, digits and signs
written for letters). One Aho-Corasick pass then finds all entries: whole words, beginnings
of words, and exception phrases, inside which nothing counts. The summed weight and its
share of the length give a score through a logistic curve.

Entries and their weights are learned from labelled texts: an entry stays if its excess in
toxic texts is beyond what the number of tried entries would give by chance.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clickloom.functions.storage import materialise

#: Bound of the labelled sample that lexicon and curve are learned from.
LEARN_DOCS = 20_000
#: Bounds of the lexicon: entries tried (the most frequent in toxic texts) and kept.
TRIED, KEPT = 20_000, 5_000
LEAST = 5  # toxic texts an entry has to be in
PREFIXES = (4, 5)
CERTAIN = 5.0  # log odds beyond chance
THRESHOLD = 0.7

# Letters of other scripts that look like Latin ones, and what they stand for.
HOMOGLYPHS = dict(
    zip(
        "абвгеіјкмнорстухѕԁԛԝαβγεηικνορτυχωß",
        "a6breijkmhopctyxsdqwabyenikvoptuxwb",
    )
)
# Digits and signs written for letters.
SUBSTITUTES = dict(zip("0134578", "oieastb"))
# Phrases in which a word of the lexicon means no harm.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "take out the trash",
    "class clown", "clown fish", "circus clown", "sore loser", "pond scum", "soap scum",
    "not worthless", "not stupid",
)

_COMBINING = {c: None for c in range(0x300, 0x370)}
_ASCII = str.maketrans(SUBSTITUTES)
_WIDE = _COMBINING | str.maketrans(HOMOGLYPHS | SUBSTITUTES)
_SIGNS = re.compile(r"[@$](?=[^\W\d_])")
_BREAK = re.compile(r"[\W_]+")


def fold(text: str) -> str:
    """Words in plain letters, one space around each."""
    text = text.lower()
    if "@" in text or "$" in text:
        text = _SIGNS.sub(lambda m: "a" if m[0] == "@" else "s", text)
    if text.isascii():
        text = text.translate(_ASCII)
    else:
        text = unicodedata.normalize("NFKD", text).lower().translate(_WIDE)
    return f" {_BREAK.sub(' ', text).strip()} "


def entries(words: set[str]) -> set[str]:
    """What a text offers to the lexicon: `` word `` and `` begin`` of its words."""
    found = {f" {w} " for w in words}
    for n in PREFIXES:
        found.update(f" {w[:n]}" for w in words if len(w) > n)
    return found


@dataclass
class Lexicon:
    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTIONS
    #: Constant, and slopes of the logarithms of total weight and of weight per length.
    curve: tuple[float, float, float] = (-4.0, 1.0, 1.0)

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry, weight in self.weights.items():
            found.add_word(entry, (len(entry), weight))
        for phrase in self.exceptions:
            phrase = fold(phrase)
            found.add_word(phrase, (len(phrase), -1.0))
        found.make_automaton()
        return found


def measure(text: str, automaton: ahocorasick.Automaton) -> tuple[float, int, int]:
    """Summed weight, number of words that count, number of words.

    Of several entries that begin at one word the heaviest counts.
    """
    folded = fold(text)
    heaviest: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    if len(automaton):
        for end, (length, weight) in automaton.iter(folded):
            start = end - length + 1
            if weight < 0:
                excused.append((start, end))
            elif weight > heaviest.get(start, 0.0):
                heaviest[start] = weight
    for start, end in excused:
        for at in [x for x in heaviest if start <= x < end]:
            del heaviest[at]
    words = folded.count(" ") - 1 if len(folded) > 2 else 0
    return sum(heaviest.values()), len(heaviest), words


def features(total: float, words: int) -> tuple[float, float]:
    return math.log1p(total), math.log1p(100 * total / max(words, 20))


def _counts(sample: DataFrame, chosen: frozenset[str] | None) -> DataFrame:
    """Texts per entry, toxic and others; summed in each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                own = entries(set(fold(text).split()))
                found[toxic].update(own & chosen if chosen is not None else own)
        names = list(found[0] | found[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string())]
            + [pa.array([found[k][n] for n in names], pa.int64()) for k in (1, 0)],
            names=["entry", "toxic", "other"],
        )

    rows = sample.select("text", "toxic").mapInArrow(run, "entry string, toxic long, other long")
    return rows.groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _signatures(sample: DataFrame) -> DataFrame:
    """Near copies mostly share the two smallest hashes of their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = []
            for text in batch.column("text").to_pylist():
                hashes = sorted(xxhash.xxh3_64_intdigest(w) for w in set(fold(text).split()))
                marks.append(" ".join(map(str, hashes[:2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(marks, pa.string())], names=["doc_id", "mark"]
            )

    return sample.select("doc_id", "text").mapInArrow(run, "doc_id long, mark string")


def learn(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Lexicon and curve from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    At most LEARN_DOCS labelled documents are read, those with the smallest hash of their
    id; rows with a null id, text or label are left out, of several labels of one document
    the largest holds, and of near copies one document stands for all. Without documents
    of both kinds the lexicon is empty and every text scores the share of toxic ones.
    """
    drawn = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int"))
        .filter("doc_id IS NOT NULL AND toxic IN (0, 1)")
        .join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LEARN_DOCS)
    )
    # The hint is safe: the list has at most LEARN_DOCS rows.
    sample = materialise(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        .filter("text IS NOT NULL")
        .join(F.broadcast(drawn), "doc_id")
        .dropDuplicates(["doc_id"])
    )
    single = _signatures(sample).groupBy("mark").agg(F.min("doc_id").alias("doc_id"))
    sample = materialise(sample.join(F.broadcast(single.select("doc_id")), "doc_id", "left_semi"))
    sizes = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    toxic, other = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not other:
        share = toxic / max(1, toxic + other)
        level = math.log((share + 1e-6) / (1 - share + 1e-6))
        return Lexicon({}, curve=(level, 0.0, 0.0))
    tried = [
        r["entry"]
        for r in _counts(sample.filter("toxic = 1"), None)
        .filter(F.col("toxic") >= LEAST)
        .orderBy(F.desc("toxic"), "entry")
        .limit(TRIED)
        .collect()
    ]
    base = toxic / (toxic + other)
    ranked = []
    for entry, t, n in _counts(sample, frozenset(tried)).collect():
        excess = t * math.log(t / (t + n) / base)
        if n:
            excess += n * math.log(n / (t + n) / (1 - base))
        if t / (t + n) > base and excess > math.log(len(tried)) + CERTAIN:
            odds = math.log((t + 0.5) / (toxic + 1)) - math.log((n + 0.5) / (other + 1))
            ranked.append((min(odds - math.sqrt(1 / (t + 0.5) + 1 / (n + 0.5)), 8.0), entry))
    ranked = sorted((x for x in ranked if x[0] > 1.0), key=lambda x: (-x[0], x[1]))[:KEPT]
    known = Lexicon({entry: weight for weight, entry in ranked})
    measured = _measured(sample, known, ("toxic",)).select("toxic", "weight", "n_words").collect()
    x = np.array([(1.0, *features(r["weight"], r["n_words"])) for r in measured])
    y = np.array([r["toxic"] for r in measured], float)
    known.curve = _logistic(x, y)
    return known


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> tuple[float, float, float]:
    """Newton's method; a slope that would be negative is left out, so hits never lower a score."""
    used = [0, 1, 2]
    while True:
        own, beta = x[:, used], np.zeros(len(used))
        penalty = ridge * np.diag([1e-3] + [1.0] * (len(used) - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(own @ beta, -30, 30)))
            hessian = (own * (p * (1 - p))[:, None]).T @ own + penalty
            move = np.linalg.solve(hessian, own.T @ (y - p) - penalty @ beta)
            beta = beta + np.clip(move, -2, 2)
            if np.abs(move).max() < 1e-8:
                break
        low = [k for k, b in zip(used, beta) if k and b < 0]
        if not low:
            full = np.zeros(3)
            full[used] = beta
            return tuple(float(v) for v in full)
        used.remove(low[0])


def _measured(docs: DataFrame, known: Lexicon, keep: tuple[str, ...]) -> DataFrame:
    plain = docs.select(*keep, "text")
    schema = T.StructType([plain.schema[k] for k in keep])
    for name, kind in (
        ("weight", T.DoubleType()),
        ("n_hits", T.LongType()),
        ("n_words", T.LongType()),
        ("score", T.DoubleType()),
    ):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = known.automaton()
        constant, total_slope, share_slope = known.curve
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                total, hits, words = measure(text or "", automaton)
                a, b = features(total, words)
                level = constant + total_slope * a + share_slope * b
                rows.append((total, hits, words, 1 / (1 + math.exp(-max(-30, min(30, level))))))
            columns = zip(*rows) if rows else ([], [], [], [])
            kinds = (pa.float64(), pa.int64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep] + [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=[*keep, "weight", "n_hits", "n_words", "score"],
            )

    return plain.mapInArrow(run, schema)


def score(docs: DataFrame, known: Lexicon, keep: tuple[str, ...]) -> DataFrame:
    """Columns ``keep`` of ``docs``, then ``score``, ``predicted`` and what they come from.

    Null and empty texts have no hits and the score of a text without any.
    """
    found = _measured(docs, known, keep)
    predicted = (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    return found.select(*keep, "score", predicted, "weight", "n_hits", "n_words")

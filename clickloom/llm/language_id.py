"""Language of a text by a small convolutional network over its bytes.

Bytes are embedded, filters of several widths run over windows of fixed length, the
largest response of each filter in a window is kept, and a softmax layer turns these into
probabilities. The network is trained in numpy on a bounded sample of labelled documents;
prediction reads every window of every text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices, string_buffers

UNDETERMINED = "und"
#: Bounds of the training sample.
TRAIN_DOCS, TRAIN_LANGUAGES, TRAIN_WINDOWS = 2400, 200, 4
WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
#: Bytes that are scored together in a task.
CHUNK = 128 * WINDOW


@dataclass
class ByteConvNet:
    """Weights; ``kernel`` holds all filters side by side over the widest width."""

    languages: list[str]
    embedding: np.ndarray
    kernel: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    def responses(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Responses of (n, length) bytes by position and filter, and what the filters saw.

        Positions past the end are zeros.
        """
        n, length = windows.shape
        widest = max(WIDTHS)
        embedded = np.zeros((n, length + widest - 1, EMBEDDING), np.float32)
        embedded[:, :length] = self.embedding[windows]
        shifted = np.concatenate([embedded[:, j : j + length] for j in range(widest)], axis=2)
        return shifted.reshape(n * length, -1) @ self.kernel, shifted

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        n, length = windows.shape
        found, _ = self.responses(windows)
        pooled = np.maximum(found.reshape(n, length, -1).max(axis=1) + self.bias, 0)
        return softmax(pooled @ self.out + self.out_bias)


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def to_windows(raw: np.ndarray) -> np.ndarray:
    """Whole text as rows of WINDOW bytes, the last filled up with zeros."""
    n = max(1, -(-len(raw) // WINDOW))
    out = np.zeros(n * WINDOW, np.uint8)
    out[: len(raw)] = raw
    return out.reshape(n, WINDOW)


def train(texts: list[str], labels: list[str], steps: int = 240, seed: int = 7) -> ByteConvNet:
    """Adam on the cross entropy of single windows, each language drawn equally often."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(seed)
    windows, target = [], []
    for text, label in zip(texts, labels):
        rows = to_windows(np.frombuffer(text.encode(), np.uint8))
        chosen = rows[np.unique(np.linspace(0, len(rows) - 1, TRAIN_WINDOWS).astype(int))]
        windows.append(chosen)
        target += [languages.index(label)] * len(chosen)
    width, total = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.zeros((width, EMBEDDING, total), np.float32)
    for k, w in enumerate(WIDTHS):
        mask[:w, :, k * FILTERS : (k + 1) * FILTERS] = 1
    mask = mask.reshape(width * EMBEDDING, total)
    net = ByteConvNet(
        languages,
        rng.normal(0, 0.5, (256, EMBEDDING)).astype(np.float32),
        rng.normal(0, 0.3, mask.shape).astype(np.float32) * mask,
        np.zeros(total, np.float32),
        rng.normal(0, 0.1, (total, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    net.embedding[0] = 0
    if len(languages) < 2:
        return net
    x, y = np.concatenate(windows), np.array(target)
    by_language = [np.flatnonzero(y == k) for k in range(len(languages))]
    names = ("embedding", "kernel", "bias", "out", "out_bias")
    first = {k: np.zeros_like(getattr(net, k)) for k in names}
    second = {k: np.zeros_like(getattr(net, k)) for k in names}
    for step in range(1, steps + 1):
        lang = rng.integers(0, len(languages), 128)
        rows = np.array([rng.choice(by_language[k]) for k in lang])
        batch, n = x[rows], len(rows)
        found, shifted = net.responses(batch)
        found = found.reshape(n, WINDOW, total)
        at = found.argmax(axis=1)
        best = np.take_along_axis(found, at[:, None, :], 1)[:, 0] + net.bias
        pooled = np.maximum(best, 0)
        wrong = softmax(pooled @ net.out + net.out_bias)
        wrong[np.arange(n), lang] -= 1
        wrong /= n
        back = (wrong @ net.out.T) * (best > 0)
        patch = shifted[np.arange(n)[:, None], at]  # what each filter's best position saw
        to_embedding = np.einsum("nf,pf->nfp", back, net.kernel).reshape(n, total, width, EMBEDDING)
        grown = np.zeros_like(net.embedding)
        for j in range(width):
            place = at + j
            inside = place < WINDOW
            bytes_ = batch[np.arange(n)[:, None], np.minimum(place, WINDOW - 1)]
            np.add.at(grown, bytes_[inside], to_embedding[:, :, j][inside])
        grown[0] = 0
        slope = {
            "embedding": grown,
            "kernel": np.einsum("nf,nfp->pf", back, patch) * mask,
            "bias": back.sum(axis=0),
            "out": pooled.T @ wrong + 1e-4 * net.out,
            "out_bias": wrong.sum(axis=0),
        }
        for k in names:
            first[k] = 0.9 * first[k] + 0.1 * slope[k]
            second[k] = 0.99 * second[k] + 0.01 * slope[k] ** 2
            move = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-7)
            setattr(net, k, (getattr(net, k) - 0.02 * move).astype(np.float32))
    return net


def fit(labelled: DataFrame) -> ByteConvNet | None:
    """Train on ``text`` and ``lang``; other columns are ignored, null rows left out.

    The sample has at most TRAIN_DOCS documents, about as many of each language, of the
    TRAIN_LANGUAGES most frequent ones; they are those with the smallest hash of the text,
    so repeated rows count once. Without labelled rows there is no network.
    """
    rows = labelled.select("text", "lang").filter("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("_h", F.shiftrightunsigned(F.xxhash64("text"), 2))
    counts = (
        rows.groupBy("lang", "_h")
        .count()
        .groupBy("lang")
        .agg(F.sum("count").alias("rows"), F.count(F.lit(1)).alias("texts"))
        .orderBy(F.desc("rows"), "lang")
        .limit(TRAIN_LANGUAGES)
    ).collect()
    if not counts:
        return None
    share = TRAIN_DOCS // len(counts)
    # Twice the share, so that chance leaves enough; of the texts, as copies are drawn together.
    limits = {r["lang"]: int(2**62 * min(1.0, 2.0 * share / r["texts"])) for r in counts}
    limit = F.element_at(
        F.create_map(*[F.lit(x) for pair in limits.items() for x in pair]), F.col("lang")
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_h"))  # of a few drawn ones
    drawn = (
        rows.filter(F.col("_h") <= limit)
        .dropDuplicates(["_h", "lang"])
        .withColumn("_place", place)
        .filter(F.col("_place") <= share)
        .orderBy("_h", "lang")
        .collect()
    )
    taken: dict[str, list[str]] = {}
    for r in drawn:
        taken.setdefault(r["lang"], []).append(r["text"])
    pairs = [(t, lang) for lang in sorted(taken) for t in taken[lang]]
    return train([t for t, _ in pairs], [lang for _, lang in pairs])


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def predict(docs: DataFrame, net: ByteConvNet | None, keep: tuple[str, ...]) -> DataFrame:
    """Columns ``keep`` of ``docs`` with ``lang_pred`` and ``score``.

    The probabilities of all windows are averaged, weighted by their bytes; ``score`` is
    that of the language returned. Texts that are null, empty or without a letter are
    ``und`` with score 0, and so is every text if there is no network.
    """
    plain = docs.select(*keep, F.col("text").alias("_text"), has_letter(F.col("text")).alias("_letter"))
    schema = T.StructType(
        [plain.schema[k] for k in keep]
        + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    )
    languages = net.languages if net else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            names, scores = [UNDETERMINED] * rows, np.zeros(rows)
            letters = batch.column("_letter").to_numpy(zero_copy_only=False)
            if net and rows:
                raw, offsets = string_buffers(batch.column("_text"))
                sums = _score(net, raw, offsets)
                best = sums.argmax(axis=1)
                scores = np.where(letters, np.minimum(sums[np.arange(rows), best], 1.0), 0.0)
                names = [languages[k] if ok else UNDETERMINED for k, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in keep]
                + [pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    return plain.mapInArrow(run, schema)


def _score(net: ByteConvNet, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean probabilities of each row, weighted by bytes."""
    out = np.zeros((len(offsets) - 1, len(net.languages)))
    for first, last in slices(offsets, 4 * CHUNK):
        windows, owner, weight = [], [], []
        for row in range(first, last):
            own = to_windows(raw[offsets[row] : offsets[row + 1]])
            size = np.full(len(own), WINDOW, np.float64)
            size[-1] = max(1, offsets[row + 1] - offsets[row] - WINDOW * (len(own) - 1))
            windows.append(own)
            owner.append(np.full(len(own), row))
            weight.append(size / size.sum())
        x, owners, weights = np.concatenate(windows), np.concatenate(owner), np.concatenate(weight)
        for at in range(0, len(x), CHUNK // WINDOW):
            to = at + CHUNK // WINDOW
            np.add.at(out, owners[at:to], net.probabilities(x[at:to]) * weights[at:to, None])
    return out

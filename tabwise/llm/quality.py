"""Quality by supervised subword embeddings.

Every word and character n-gram is hashed into a table of learned vectors. A
document is the average of its features' vectors; a softmax layer gives the label.
Table and layer are trained with numpy by stochastic gradient descent, one
document at a time, on a bounded sample of labelled rows (``SAMPLE_LOW`` and
``SAMPLE_HIGH``, smallest hashes of their ids).

Averaging and the softmax's input are linear, so for scoring the layer is
multiplied into the table once: what remains is one number per bucket, averaged
over the features. That is the same score without the vectors. Scoring reads
every whole text in one pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm.common import fold, table
from tabwise.llm.toxicity import labelled_sample
from tabwise.llm.wordhash import AS_SPACE, PIECE, WordHasher

FOLDS = 3
HELD_OUT = 1
SAMPLE_LOW = 1000
SAMPLE_HIGH = 2000
BUCKETS = 1 << 16
DIMENSIONS = 16
GRAMS = (3, 4)
_REPEATED = 1
EPOCHS = 12
RATE = 0.6


def _buckets(text: str | None, hasher: WordHasher) -> Iterator[np.ndarray]:
    """Buckets of a text's features, repeats included, in parts.

    Words are parted by ASCII white space. N-grams are bytes of the text with
    white space as one kind of edge; an n-gram may begin or end at an edge, but
    does not run across one.
    """
    if not text:
        return
    for words in hasher.words([text]):
        if len(words):
            yield (words % np.uint64(BUCKETS)).astype(np.int64)
            # A word that repeats the one before it is one feature, whatever the word.
            yield np.full(np.count_nonzero(words[1:] == words[:-1]), _REPEATED, np.int64)
    raw = b" " + text.encode("utf-8", "replace").translate(AS_SPACE) + b" "
    longest = max(GRAMS)
    for at in range(0, len(raw), PIECE):
        data = np.frombuffer(raw[at : at + PIECE + longest - 1], np.uint8)
        edge = data == 32
        codes = data.astype(np.uint32)
        for n in GRAMS:
            # A gram belongs to the piece in which it starts.
            m = min(len(data) - n + 1, PIECE)
            if m <= 0:
                continue
            h = np.full(m, n, np.uint32)
            inner = np.zeros(m, bool)
            for j in range(n):
                h = (h ^ codes[j : j + m]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
                if 0 < j < n - 1:
                    inner |= edge[j : j + m]
            yield (h[~inner] % np.uint32(BUCKETS)).astype(np.int64)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    hasher = WordHasher(AS_SPACE)
    for pdf in batches:
        for at in range(0, len(pdf), 100):
            part = pdf.iloc[at : at + 100]
            rows = []
            for label, text in zip(part["label"], part["text"]):
                total = np.zeros(BUCKETS, np.int64)
                for b in _buckets(text, hasher):
                    total += np.bincount(b, minlength=BUCKETS)
                found = np.flatnonzero(total)
                rows.append((label, found.astype(np.int32).tobytes(), total[found].astype(np.int32).tobytes()))
            yield pd.DataFrame(rows, columns=["label", "buckets", "counts"])


@dataclass
class Model:
    """Log-odds of label 1: the average of ``table`` over the features, plus ``bias``."""

    table: np.ndarray
    bias: float


def fit_layers(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float,
               seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, layer and shift, trained. ``rows``: label, buckets and their counts per document, of both labels."""
    labels = np.array([r[0] for r in rows])
    rng = np.random.default_rng(seed)
    vectors = ((rng.random((BUCKETS, DIMENSIONS)) - 0.5) / DIMENSIONS).astype(np.float32)
    layer = np.zeros((DIMENSIONS, 2), np.float32)
    shift = np.zeros(2, np.float32)
    share = labels.mean()
    weight = {1: prior / share, 0: (1 - prior) / (1 - share)}
    steps, done = EPOCHS * len(rows), 0
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            label, buckets, counts = rows[i]
            rate = RATE * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            part = (counts / counts.sum()).astype(np.float32)
            own = vectors[buckets]
            mean = part @ own
            z = mean @ layer + shift
            p = np.exp(z - z.max())
            p /= p.sum()
            p[label] -= 1
            error = (p * min(weight[int(label)], 3.0)).astype(np.float32)
            back = layer @ error
            layer -= rate * np.outer(mean, error)
            shift -= 0.1 * rate * error
            # Features share the step by their part of the text, as in an average.
            vectors[buckets] = own - rate * np.sqrt(part)[:, None] * back
    return vectors, layer, shift


def fit(rows: list[tuple[int, np.ndarray, np.ndarray]], prior: float, seed: int = 11) -> Model:
    """Train, and fold the layer into the table: the softmax of an average is that of the folded numbers.

    ``prior`` is the share of label 1 among all labelled rows: the sample may hold
    other shares, and the rows' weights make up for it. Without rows of both
    labels every text has the prior.
    """
    if len({r[0] for r in rows}) < 2:
        return Model(np.zeros(BUCKETS, np.float32), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))))
    vectors, layer, shift = fit_layers(rows, prior, seed)
    return Model((vectors @ (layer[:, 1] - layer[:, 0])).astype(np.float32), float(shift[1] - shift[0]))


def train(docs: DataFrame, labels: DataFrame, low: int = SAMPLE_LOW, high: int = SAMPLE_HIGH) -> Model:
    sample = labelled_sample(docs, labels, "quality", {0: low, 1: high})
    share = labels.agg(F.avg(F.col("quality").cast("double"))).first()[0]
    prior = 0.5 if share is None else min(max(share, 0.0), 1.0)
    # Texts become counts where they are read: what comes to the driver is bounded by rows and buckets.
    counted = sample.mapInPandas(_counts, "label int, buckets binary, counts binary").collect()
    return fit([(r["label"], np.frombuffer(r["buckets"], np.int32), np.frombuffer(r["counts"], np.int32))
                for r in counted], prior)


def _score(model: Model):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher(AS_SPACE)
        for pdf in batches:
            scores = np.empty(len(pdf))
            for i, text in enumerate(pdf["text"]):
                total, n = 0.0, 0
                for b in _buckets(text, hasher):
                    total += float(model.table[b].sum(dtype=np.float64))
                    n += len(b)
                scores[i] = 1 / (1 + np.exp(-(total / max(n, 1) + model.bias)))
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "score": scores})

    return run


def score_quality(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score (of label 1); one row per input row.

    Null and empty texts have no features and get the layer's bias alone. Other
    columns of ``docs`` are not used.
    """
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        _score(model), "doc_id long, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.filter(fold(F.col("doc_id"), FOLDS) != HELD_OUT))
    return score_quality(docs, model).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))

"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's probability comes from the words in it: every distinct word adds the
weights of its subwords (itself and its character n-grams, edges included). A
document's is the noisy-or of its sentences, ``1 - prod(1 - p)``, so one bad
sentence is enough, and training from document labels alone finds which sentences
these are. What a sentence without any evidence would get is taken off first, so
length alone never makes a text toxic.

The model is fitted with numpy on a bounded sample of labelled rows
(``SAMPLE_TOXIC``, ``SAMPLE_CLEAN``, ``SAMPLE_BYTES``: rows with the smallest hashes of their
ids); its size is fixed. A penalty leaves a few hundred subwords with a weight.
Scoring reads every whole text in one pass, no shuffle; only sentences with a word
that speaks for toxicity are looked at closer.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwise.llm.common import fold, table

FOLDS = 5
SAMPLE_TOXIC = 1500
SAMPLE_CLEAN = 2500
#: Bytes of all whole texts of one label in the sample, at most.
SAMPLE_BYTES = 32 << 20
GRAMS = (4, 5)
#: Log-odds of a sentence without evidence; fixed.
BACKGROUND = -6.0
ROUNDS = 150
RATE = 0.5
SPARSITY = 1e-4

#: Words whose score a task remembers before it starts anew.
_REMEMBERED = 500_000

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def subwords(word: str) -> set[str]:
    """A word and its character n-grams, with ``<`` and ``>`` as its edges."""
    edged = f"<{word}>"
    parts = {edged}
    for n in GRAMS:
        parts.update(edged[i : i + n] for i in range(len(edged) - n + 1))
    return parts


def lowered(text: str) -> str:
    """Lower case, character by character, so that positions stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def sentences(text: str | None) -> Iterator[list[str]]:
    """The distinct words of each sentence that has any."""
    for m in _SENTENCE.finditer(lowered(text or "")):
        words = _WORD.findall(m.group())
        if words:
            yield list(dict.fromkeys(words))


@dataclass
class Model:
    """The subwords that have a weight."""

    weights: dict[str, float]


class WordScores(dict):
    """The score of each word seen, worked out once."""

    def __init__(self, model: Model) -> None:
        super().__init__()
        self.weight = model.weights.get

    def __missing__(self, word: str) -> float:
        score = sum(w for w in map(self.weight, subwords(word)) if w)
        self[word] = score
        return score


def fit(texts: list[str | None], toxic: np.ndarray) -> Model:
    """Proximal AdaGrad on the likelihood of the document labels under the noisy-or.

    Without rows of both labels the model is empty, and every score 0.
    """
    vocabulary: dict[str, int] = {}
    words, per_sentence, per_doc = [], [], []
    for text in texts:
        n = 0
        for tokens in sentences(text):
            words.extend(vocabulary.setdefault(t, len(vocabulary)) for t in tokens)
            per_sentence.append(len(tokens))
            n += 1
        per_doc.append(n)
    toxic = np.asarray(toxic, float)
    per_doc = np.array(per_doc, np.int64)
    if not len(words) or toxic.min() == toxic.max():
        return Model({})
    words = np.array(words, np.int32)
    grams: dict[str, int] = {}
    lengths, features = [], []
    for word in vocabulary:
        parts = [grams.setdefault(g, len(grams)) for g in sorted(subwords(word))]
        lengths.append(len(parts))
        features.extend(parts)
    lengths, features = np.array(lengths, np.int64), np.array(features, np.int32)
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    sentence_first = np.concatenate([[0], np.cumsum(per_sentence)[:-1]]).astype(np.int64)
    sentence_of = np.repeat(np.arange(len(per_sentence)), per_sentence)
    full = per_doc > 0
    doc_first = np.concatenate([[0], np.cumsum(per_doc)[:-1]])[full]
    doc_of = np.repeat(np.arange(full.sum()), per_doc[full])
    y = toxic[full]
    share = np.where(y > 0, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum())) * len(y)
    w, seen = np.zeros(len(grams)), np.full(len(grams), 1e-8)
    for _ in range(ROUNDS):
        word_score = np.add.reduceat(w[features], first)
        z = np.clip(BACKGROUND + np.add.reduceat(word_score[words], sentence_first), -30, 30)
        p = 1 / (1 + np.exp(-z))
        log_clean = np.add.reduceat(-np.logaddexp(0, z), doc_first)
        clean = np.exp(log_clean)
        # d(-log likelihood)/dz: p for a clean document; -p * clean / (1 - clean) for a toxic one.
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, 1e-12), 1.0) * share
        g_word = np.bincount(words, (p * pull[doc_of])[sentence_of], minlength=len(vocabulary))
        g = np.bincount(features, np.repeat(g_word, lengths), minlength=len(grams)) / len(y)
        seen += g * g
        step = RATE / np.sqrt(seen)
        w -= step * g
        w = np.sign(w) * np.maximum(np.abs(w) - np.minimum(step * SPARSITY, 0.05), 0)
    return Model({g: float(w[i]) for g, i in grams.items() if w[i]})


def _evidence(z: np.ndarray) -> np.ndarray:
    """A sentence's probability beyond that of one without evidence."""
    base = 1 / (1 + np.exp(-BACKGROUND))
    return np.maximum(0, (1 / (1 + np.exp(-np.clip(z, -30, 30))) - base) / (1 - base))


def sentence_scores(text: str | None, scores: WordScores) -> list[tuple[int, int, float]]:
    """(start, end, probability) of the sentences with any evidence; code points, breaks left out."""
    if not text:
        return []
    low = lowered(text)
    # Without a word that speaks for toxicity, no sentence is above the background.
    telling = {w for w in set(_WORD.findall(low)) if scores[w] > 0}
    if not telling:
        return []
    found = []
    for m in _SENTENCE.finditer(low):
        words = set(_WORD.findall(m.group()))
        if not telling.isdisjoint(words):
            found.append((*m.span(), sum(sorted(map(scores.__getitem__, words)))))
    p = _evidence(BACKGROUND + np.array([z for _, _, z in found]))
    return [(start, end, float(x)) for (start, end, _), x in zip(found, p) if x > 0]


def _score(model: Model, offending: float):
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scores = WordScores(model)
        for texts in batches:
            rows = []
            for text in texts:
                found = sentence_scores(text, scores)
                clean = np.prod([1 - p for _, _, p in found]) if found else 1.0
                rows.append((float(1 - clean), [f for f in found if f[2] >= offending]))
            yield pd.DataFrame(rows, columns=["score", "offending"])
            if len(scores) > _REMEMBERED:
                scores.clear()

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sizes: dict[int, int],
                    most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """label, text of a bounded sample: per label value, the rows with the smallest hashes of their ids.

    The ids are picked from the labels alone and sent to the documents' scan
    (``sizes`` bounds them), so no text is shuffled but the sample's. Rows without
    the label or an id are left out, and so are ids without a document; an id with
    several labels has the largest, one with several texts the smallest. Per label
    value the whole texts together have at most ``most_bytes``: a text that would
    pass that is left out of the sample.
    """
    one = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(*sizes))
           .groupBy(F.col("doc_id").alias("of")).agg(F.max(label).cast("int").alias("label")))
    picked = reduce(DataFrame.unionByName, [
        one.filter(F.col("label") == value).orderBy(F.xxhash64("of"), "of").limit(n) for value, n in sizes.items()])
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), F.col("doc_id") == F.col("of"))
    one_each = texts.groupBy("doc_id").agg(F.max("label").alias("label"), F.min("text").alias("text"))
    # At most the picked rows: a bounded window.
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    so_far = F.sum(F.coalesce(F.octet_length("text"), F.lit(0))).over(
        Window.partitionBy("label").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return (one_each.withColumn("so_far", so_far).filter(F.col("so_far") <= most_bytes)
            .orderBy(F.desc("label"), *order).select("label", "text"))


def train(docs: DataFrame, labels: DataFrame, toxic: int = SAMPLE_TOXIC, clean: int = SAMPLE_CLEAN) -> Model:
    sample = labelled_sample(docs, labels, "toxic", {1: toxic, 0: clean}).toPandas()
    return fit(sample["text"].tolist(), sample["label"].to_numpy()) if len(sample) else fit([], np.zeros(1))


def toxicity(text: Column, model: Model, offending: float = 0.5) -> Column:
    """struct(score, offending): the text's score, and (start, end, score) of its offending sentences.

    A sentence offends at or above ``offending``. Null, empty and wordless texts
    score 0. Positions are code points.
    """
    score = F.pandas_udf(_score(model, offending),
                         "score double, offending array<struct<start:long,end:long,score:double>>")
    return score(text)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.filter(fold(F.col("doc_id"), FOLDS) != 0))
    scored = (docs.select("doc_id", toxicity(F.col("text"), model).alias("found"))
              .select("doc_id", "found.score", "found.offending"))
    worst = F.element_at(F.sort_array(F.transform("offending", lambda s: F.struct(s["score"], s["start"], s["end"])),
                                      asc=False), 1)
    worst = F.when(F.size("offending") > 0, worst)
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        F.size("offending").cast("long").alias("n_offending"), worst["start"].alias("worst_start"),
        worst["end"].alias("worst_end"))

"""License scan by a positional index of the templates' words.

Templates are license texts and notices. Every template word has postings
(template, position), and an inverse document frequency counted over all
documents. A document looks up a template's words by falling IDF; places whose
distance between document and template agrees are one alignment. The look-up stops
as soon as the words left, all together, weigh too little for an alignment that
none of the rarer ones has opened to count: so common words are rarely asked for,
and nothing is lost. Open alignments are then compared word by word. The best
one's share of the template (weighted by rarity) is its score, and a label is
given for every alignment with a high share and a mandatory key phrase of the
template in the aligned stretch. Key phrases on their own are looked for as well.

Two passes over the documents: word counts of the template vocabulary (bounded by
the templates), then the look-up. No shuffle of texts.
"""

from __future__ import annotations

import math
import re
import string
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm.common import table

# Key phrases with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Label, mandatory phrases (any of them), text.
TEMPLATES = (
    ("apache", ("apache license",),
     "licensed under the apache license version 2 0 the license you may not use this file except in compliance with "
     "the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("apache", ("apache license",), "licensed under the apache license version 2 0"),
    ("gpl", ("gnu general public license",),
     "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation"),
    ("gpl", ("gnu general public license",), "this work is licensed under the gnu general public license version 3"),
    ("lgpl", ("gnu lesser general public license",),
     "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published "
     "by the free software foundation"),
    ("mit", ("permission is hereby granted free of charge",),
     "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction"),
    ("mit", ("mit license",), "released under the mit license"),
    ("bsd", ("redistribution and use in source and binary forms",),
     "redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met"),
    ("mpl", ("mozilla public license",),
     "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", ("creative commons attribution", "cc by 4 0"),
     "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", ("cc by nc",), "licensed under cc by nc 4 0"),
    ("cc-by-sa", ("cc by sa",), "licensed under cc by sa 4 0"),
)
#: Places of a text at which alignments are added up together.
BLOCK = 1 << 16
#: The look-up stops when the best alignment so far weighs this many times the words left:
#: then few others come near it and have to be compared.
_FAR = 8
#: Share of a template that has to be aligned, by weight.
SHARE = 0.8

_LOWER = bytes.maketrans(string.ascii_uppercase.encode(), string.ascii_lowercase.encode())
_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def _words(text: str | None) -> list[bytes]:
    return _WORDS.findall((text or "").encode("utf-8", "replace").translate(_LOWER))


def _parts(text: str) -> tuple[bytes, ...]:
    return tuple(text.encode().split())


def _places(at: dict[bytes, list[int]], words: list[bytes], phrase: tuple[bytes, ...]) -> list[int]:
    """Where the phrase's words stand consecutively, found from its rarest word here."""
    found = [at.get(w) for w in phrase]
    if not all(found):
        return []
    k = min(range(len(phrase)), key=lambda i: len(found[i]))
    return [i - k for i in found[k] if i >= k and tuple(words[i - k:i - k + len(phrase)]) == phrase]


class Index:
    """Postings and weights of the templates; bounded by them."""

    def __init__(self, templates: tuple = TEMPLATES, idf: dict[bytes, float] | None = None) -> None:
        self.labels = [t[0] for t in templates]
        self.keys = [[_parts(p) for p in t[1]] for t in templates]
        self.texts = [_parts(t[2]) for t in templates]
        self.postings: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for t, text in enumerate(self.texts):
            for i, word in enumerate(text):
                self.postings[word].append((t, i))
        self.vocabulary = set(self.postings) | {w for p in PHRASES for w in _parts(p)}
        self.idf = idf or {}
        self.totals = [sum(self.weight(w) for w in text) for text in self.texts]
        #: Per template its positions, rarest word first.
        self.order = [sorted(range(len(text)), key=lambda i: (-self.weight(text[i]), i)) for text in self.texts]

    def weight(self, word: bytes) -> float:
        return self.idf.get(word, 1.0)

    def share(self, t: int, words: list[bytes], start: int) -> float:
        """The share of a template that stands in the words from ``start`` on."""
        text = self.texts[t]
        inside = range(max(0, -start), min(len(text), len(words) - start))
        return sum(self.weight(text[i]) for i in inside if words[start + i] == text[i]) / self.totals[t]

    def look_up(self, words: list[bytes], share: float = SHARE) -> dict[int, tuple[float, list[int]]]:
        """Per template with an alignment: the best share, and every start with ``share`` or more."""
        at = self.places(words)
        out: dict[int, tuple[float, list[int]]] = {}
        for t, text in enumerate(self.texts):
            # Words that the document lacks belong to no alignment.
            held = [(i, self.weight(text[i]), at[text[i]]) for i in self.order[t] if text[i] in at]
            if not held:
                continue
            enough, best, starts = share * self.totals[t], 0.0, []
            for first in range(-len(text), len(words), BLOCK):
                votes: dict[int, float] = {}
                left, most = sum(weight for _, weight, _ in held), best * self.totals[t]
                for i, weight, found in held:
                    if left < enough and left < most / _FAR:
                        break
                    for place in found[bisect_left(found, first + i):bisect_left(found, first + BLOCK + i)]:
                        vote = votes[place - i] = votes.get(place - i, 0.0) + weight
                        if vote > most:
                            most = vote
                    left -= weight
                else:  # all looked up: the votes are the shares
                    left, best = 0.0, max(best, most / self.totals[t])
                    most = enough
                # What rounding may have added or taken away is far below this.
                needed = min(most, enough) - left - 1e-6
                for start, part in sorted((k, self.share(t, words, k)) for k, v in votes.items() if v >= needed):
                    best = max(best, part)
                    if part >= share:
                        starts.append(start)
            out[t] = best, starts
        return out

    def places(self, words: list[bytes]) -> dict[bytes, list[int]]:
        at: dict[bytes, list[int]] = defaultdict(list)
        for i, word in enumerate(words):
            if word in self.vocabulary:
                at[word].append(i)
        return at


def read_templates(table: DataFrame) -> tuple:
    """Templates from a table (label, phrases array, text), such as whole licence texts.

    Phrases and texts are normalised as documents are. Templates are a small set that
    every task holds; rows with a null label, without words or without a phrase are an error.
    """
    plain = lambda text: b" ".join(_words(text)).decode()
    out = tuple((r.label, tuple(filter(None, map(plain, r.phrases or ()))), plain(r.text)) for r in table.select(
        "label", "phrases", "text").collect())
    bad = [label for label, phrases, text in out if not (label and phrases and text)]
    if bad:
        raise ValueError(f"templates without label, phrase or words: {bad}")
    return tuple(sorted(out))


def _count(index: Index):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        rows = 0
        for pdf in batches:
            for text in pdf["text"]:
                rows += 1
                seen.update(index.vocabulary.intersection(_words(text)))
        yield pd.DataFrame({"word": ["", *(w.decode() for w in seen)], "n": [rows, *seen.values()]})

    return run


def rarity(docs: DataFrame, templates: tuple = TEMPLATES) -> dict[bytes, float]:
    """Inverse document frequency of the templates' words over all documents: a bounded table."""
    counted = docs.select("text").mapInPandas(_count(Index(templates)), "word string, n long")
    found = {r["word"].encode(): r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}
    rows = found.pop(b"", 0)
    return {w: math.log((rows + 1) / (found.get(w, 0) + 1)) + 1e-3 for w in Index(templates).vocabulary}


def _scan(index: Index, share: float):
    phrases = [(_parts(p), label) for p, label in PHRASES.items()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for key, text in zip(pdf["doc_id"], pdf["text"]):
                words = _words(text)
                at = index.places(words)
                base = [(i, label) for phrase, label in phrases for i in _places(at, words, phrase)]
                added, score = set(), 1.0 if base else 0.0
                for t, (part, aligned) in index.look_up(words, share).items():
                    score = max(score, min(1.0, part))
                    keys = sorted(i for key_ in index.keys[t] for i in _places(at, words, key_)) if aligned else []
                    for start in aligned:
                        k = bisect_left(keys, start)
                        if k < len(keys) and keys[k] < start + len(index.texts[t]):
                            added.add((index.labels[t], start))
                starts = [i for i, _ in base]
                labels = sorted({label for _, label in base})
                rows.append((key, len(words), len(base), min(starts, default=None), max(starts, default=None),
                             ",".join(labels), ",".join(sorted({*labels, *(x for x, _ in added)})), score,
                             sorted(added)))
            out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels",
                                              "labels", "score", "aligned"])
            for c in ("doc_id", "first_word", "last_word"):
                out[c] = out[c].astype("Int64")
            yield out

    return run


def scan_licenses(docs: DataFrame, templates: tuple = TEMPLATES, share: float = SHARE) -> DataFrame:
    """Per input row: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, aligned.

    ``aligned`` lists (label, word where the template starts) of all verified
    alignments. ``score`` is the best aligned share, 1 with a key phrase. Null,
    empty and wordless texts have no labels and score 0. Other columns of ``docs`` are not used.
    """
    index = Index(templates, rarity(docs, templates))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(
        _scan(index, share),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, aligned array<struct<label:string,start:long>>")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents")).drop("aligned")

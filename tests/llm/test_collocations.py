"""Collocations against plain counting, with numbered words and without."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwise.llm import collocations
from tests.llm import brute
from tests.llm.test_operators import EXTRA, SCHEMA, messy


def expected(data, least, covered, top):
    n, f = Counter(), Counter()
    for lang, text in data:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", brute.lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    frequent = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    rows = {}
    for (lang, p), a in frequent.items():
        if any(key == lang and len(q) > len(p) and 100 * b >= covered * a
               and any(q[i:i + len(p)] == p for i in range(len(q))) for (key, q), b in frequent.items()):
            continue
        score, k = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p)))
        rows.setdefault(lang, []).append((" ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out = []
    for lang, found in rows.items():
        found.sort(key=lambda r: (-r[5], -r[1], r[0].encode()))
        out += [(lang, i + 1, *r) for i, r in enumerate(found[:top])]
    return sorted(out)


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["a", "b", "é", "É", "New", "york", "new", "x\x00", "数据", " ", "\x1c"]
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "\x0b", "! "]
    rows = [(i, "".join(rng.choice(vocabulary) + rng.choice(marks) for _ in range(rng.randrange(60))),
             rng.choice(["en", "en", None, "und", ""]), None, None) for i in range(60)]
    rows += [(100 + i, "one two three four five. same two three", "de", None, None) for i in range(9)]
    return [*messy(), *rows, rows[0], (None, None, None, None, None)]


@pytest.mark.parametrize("numbered", [True, None, False])
@pytest.mark.parametrize("least,covered,top", [(2, 80, 1000), (4, 60, 15), (9, 100, 3)])
def test_against_plain_counting(spark, monkeypatch, numbered, least, covered, top):
    if numbered is False:
        monkeypatch.setattr(collocations, "VOCABULARY_WORDS", -1)
    if numbered is None:  # every pair counts as hot
        monkeypatch.setattr(collocations, "_HOT", 1)
    monkeypatch.setattr(collocations, "_BLOCK", 100)
    monkeypatch.setattr(collocations, "_ROWS", 300)
    monkeypatch.setattr(collocations, "_WINDOWS", 500)
    docs = spark.createDataFrame(made(least), SCHEMA)
    for c in [*EXTRA, "phrase", "a", "w1", "salt", "longer"]:
        docs = docs.withColumn(c, F.lit("x"))
    got = collocations.mine_collocations(docs.repartition(4), least, covered, top)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    data = [(r[2], r[1]) for r in made(least)]
    assert sorted(map(tuple, got.collect())) == expected(data, least, covered, top)


def test_windows_are_shuffled_once_before_the_rollup(spark):
    docs = spark.createDataFrame([(f"w{i % 7} w{i % 3} w{i % 2} x", "en") for i in range(200)], "text string, lang string")
    numbers = {"en": {f"w{i}".encode(): i + 1 for i in range(7)}}
    counted = collocations._counted_by_number(docs, numbers, np.full(8, 99), 2)
    counted.collect()
    plan = counted._jdf.queryExecution().executedPlan().toString()
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert final.count("MapInArrow") == 1 and final.count("Exchange") == 1


def test_products_beyond_64_bits(spark):
    rows = spark.createDataFrame([(1, 2, 0, 0, 2, 9 * 10**15)], "w1 int, w2 int, w3 int, w4 int, n_words int, a long")
    phrases = spark.createDataFrame([(1, 0, 0, 0, 9 * 10**15), (2, 0, 0, 0, 10**16)], "w1 int, w2 int, w3 int, w4 int, a long")
    (r,) = collocations._score(rows, phrases, [], 0).collect()
    assert r.score == 2_000_000 * 9 * 10**15 // (19 * 10**15)


def test_tables_without_phrases(spark):
    assert collocations.mine_collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame([(1, "one two", "en", None, 1), (2, None, None, None, None)], SCHEMA)
    assert collocations.mine_collocations(docs).collect() == []

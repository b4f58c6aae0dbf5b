"""Fill-in-the-middle: boundaries by ranks, forms, round trip."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwise.llm import infill
from tests.llm.test_operators import EXTRA, SCHEMA, messy


def units(text, unit):
    if unit == "character":
        return list(text)
    if unit == "line":
        return re.findall(r"[^\n]*\n|[^\n]+", text)
    return re.findall(r"^[ \t\n]+|[^ \t\n]+[ \t\n]*", text)


def test_ranks_of_the_wavelet_matrix():
    rng = np.random.default_rng(3)
    for n in (0, 1, 63, 64, 65, 1000):
        symbols = rng.integers(0, 16, n).astype(np.uint8)
        matrix = infill.WaveletMatrix(symbols, 4)
        for bits in ("", "0", "1", "01", "011", "1011"):
            mine = [format(s, "04b").startswith(bits) for s in symbols]
            for i in {0, n // 3, n}:
                assert matrix.rank(bits, i) == sum(mine[:i])


@pytest.mark.parametrize("unit", list(infill.UNITS))
def test_boundaries(unit):
    rng = random.Random(5)
    for k in range(400):
        text = "".join(rng.choice("ab \n\té数😀.") for _ in range(rng.randrange(150 if k % 20 == 0 else 10)))
        found, parts = infill.Boundaries(text.encode(), unit), units(text, unit)
        assert found.count == len(parts)
        for j in range(len(parts) + 1):
            head = "".join(parts[:j])
            assert found.after(j) == len(head.encode()) and found.characters(found.after(j)) == len(head)


def expected(doc_id, text, unit):
    text = text or ""
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * i:8 * i + 8], 16) for i in range(4)]
    parts = units(text, unit)
    n = len(parts)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if h[3] % 100 < 20:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("unit", list(infill.UNITS))
def test_operator_matches_brute_force_and_restores(spark, unit):
    data = [*messy(), *((1000 + i, t, None, None, None) for i, t in enumerate(
        ["has <P> in it", "<S>", "a<", "<P", "x<M" * 9, "P>S>M>" * 5, "<<S" * 7, "\n\n", " lead", "z" * 300_000]))]
    data += [(2000 + i, "<" * (i % 7) + "Mé>" * (i % 5) + " w\n", None, None, None) for i in range(60)]
    docs = spark.createDataFrame(data, SCHEMA)
    for c in [*EXTRA, "form", "output", "h1", "prefix_chars"]:
        docs = docs.withColumn(c, F.lit("x"))
    out = infill.fill_in_middle(docs.repartition(3), unit).withColumn(
        "restored", infill.restore(F.col("output"), F.col("form"))).collect()
    key = lambda r: repr(tuple(r))
    assert sorted((tuple(r)[:6] for r in out), key=key) == sorted((expected(r[0], r[1], unit) for r in data), key=key)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert sorted(r.restored for r in out) == sorted(r[1] or "" for r in data)


def test_parts_of_a_batch_are_all_handed_on(spark, monkeypatch):
    monkeypatch.setattr(infill, "_PART_BYTES", 40)
    docs = spark.createDataFrame([(i, "word " * (i % 9), None, None, None) for i in range(50)], SCHEMA)
    assert sorted(r.doc_id for r in infill.fill_in_middle(docs).collect()) == list(range(50))


def test_empty_table_and_text_ids(spark):
    assert infill.fill_in_middle(spark.createDataFrame([], SCHEMA)).collect() == []
    (row,) = infill.fill_in_middle(spark.createDataFrame([("k1", "abc")], "doc_id string, text string")).collect()
    assert tuple(row) == expected("k1", "abc", "character")

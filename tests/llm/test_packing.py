"""Packing: ids as the tokenizer gives them, the plan, pieces that cover every document."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabwise.llm import packing, queries
from tests.llm.test_operators import EXTRA, SCHEMA, messy

PATH = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def whole(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids


def test_ids_by_chunk_are_those_of_the_whole_text(tokenizer, monkeypatch):
    monkeypatch.setattr(packing, "_TEXT_BLOCK", 50)
    monkeypatch.setattr(packing, "_GENERATION", 40)
    rng = random.Random(4)
    ids = packing.ChunkIds(tokenizer)
    bits = ["the", "Don't", "it's.", "É", "é", "́x", "ÇA", "Straße,", "ΣΑΣ", "İ", "İ", "數據", "😀", "a.b", "x!?", "'s", "9.5",
            "...", "<|endoftext|>", "<|ENDOFTEXT|>", "<|", "|>", " ", " ", "\u0085", "\x1c", "\x00", "-", "_", "w" * 90, "ﬁ", "½;"]
    for _ in range(1500):
        text = "".join(rng.choice(bits) + rng.choice([" ", "", "\n", "\t", "  ", "\r\n", "\x0b"]) for _ in range(rng.randrange(25)))
        assert np.frombuffer(ids.of(text.encode()), ids.dtype).tolist() == whole(tokenizer, text), text
    assert len(ids) <= 41 and ids.old


def covered(histogram, capacity):
    """Check a plan piece by piece; the number of sequences."""
    runs, sequences = packing.plan(histogram, capacity)
    held, tails = defaultdict(list), defaultdict(list)
    for tail, found in runs.items():
        for rank, n, each, start, length, first, offset in found:
            for i in range(n):
                held[first + i // each].append((offset + i % each * length, length))
                tails[tail, rank + i].append((start, length))
    assert set(held) == set(range(sequences))
    assert set(tails) == {(t, r) for t, n in histogram.items() for r in range(n)}
    for size, parts in [*((None, p) for p in held.values()), *((t, p) for (t, _), p in tails.items())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at <= capacity if size is None else at == size
    return sequences


@pytest.mark.parametrize("least", [1, 4, 32])
def test_plans_place_every_token_once(monkeypatch, least):
    monkeypatch.setattr(packing, "LEAST_PIECE", least)
    rng = random.Random(least)
    for _ in range(80):
        capacity = rng.choice([8, 16, 64, 100])
        covered({rng.randrange(1, capacity): rng.randrange(1, 60) for _ in range(rng.randrange(capacity))}, capacity)


@pytest.mark.parametrize("histogram", [
    {700: 10**9}, {1500: 10**9}, {1500: 10**9, 1: 10**12}, {t: 1 + t * 7919 % 10**6 for t in range(1, 2048)},
    {t: 1 + t * 7919 % 10**6 for t in range(1300, 2048)}, {t: 10**9 // t**2 + 1 for t in range(1, 2048)}])
def test_plans_follow_the_lengths_not_the_documents(histogram):
    runs, sequences = packing.plan(histogram, 2048)
    assert sum(map(len, runs.values())) < 50 * 2048
    assert sum(t * n for t, n in histogram.items()) / 2048 / sequences > 0.99


def check_pieces(pieces, data, tokenizer, capacity):
    docs, sequences = defaultdict(list), defaultdict(list)
    for p in pieces:
        assert len(p.ids) == 4 * p.length > 0
        docs[p.doc_id].append(p)
        sequences[p.sequence_id].append((p.offset, p.length))
    wanted = Counter((k, tuple([*whole(tokenizer, t or ""), 1])) for k, t in data)
    for k, found in docs.items():  # equal ids: as many whole documents as rows
        texts = [ids for (key, ids), n in wanted.items() if key == k for _ in range(n)]
        assert Counter(x for p in found for x in np.frombuffer(p.ids, "<u4").tolist()) == Counter(x for t in texts for x in t)
        if len(texts) == 1:
            found = sorted(found, key=lambda p: p.start)
            assert [p.start for p in found] == list(np.cumsum([0, *(p.length for p in found[:-1])]))
            assert b"".join(p.ids for p in found) == np.array(texts[0], "<u4").tobytes()
            assert {p.doc_tokens for p in found} == {len(texts[0])}
    assert set(docs) == {k for k, _ in data}
    assert set(sequences) == set(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


@pytest.mark.parametrize("capacity", [7, 64, 2048])
def test_operator_covers_every_document(spark, tokenizer, capacity):
    data = messy()
    docs = spark.createDataFrame(data, SCHEMA)
    for c in [*EXTRA, "part", "tail", "ids", "start", "offset", "full"]:
        docs = docs.withColumn(c, F.lit("x"))
    pieces = packing.pack_documents(docs.repartition(6), PATH, capacity).collect()
    check_pieces(pieces, [r[:2] for r in data], tokenizer, capacity)


def test_empty_table_and_small_parts(spark, tokenizer, monkeypatch):
    assert packing.pack_documents(spark.createDataFrame([], SCHEMA), PATH).collect() == []
    monkeypatch.setattr(packing, "_PART_BYTES", 30)
    data = [(f"k{i}", "many words " * (i % 7)) for i in range(40)]
    pieces = packing.pack_documents(spark.createDataFrame(data, "doc_id string, text string"), PATH, 16).collect()
    check_pieces(pieces, data, tokenizer, 16)


def test_query_on_the_given_table(spark, tokenizer):
    got = queries.QUERIES["op12_pack"](spark, SF).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    ids = {k: np.array([*whole(tokenizer, t), 1], "<u4") for k, t in texts.items()}
    assert sum(r.length for r in got) == sum(map(len, ids.values()))
    sequences = Counter()
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        sequences[r.sequence_id] += r.length
    assert max(sequences.values()) <= 2048 and sum(sequences.values()) / 2048 / len(sequences) > 0.97

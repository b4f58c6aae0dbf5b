"""The registered queries on the given tables, against SQL or brute force."""

import hashlib
import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tabwise.llm import queries, secrets, toxicity
from tests.llm import brute

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(tables):
    return tables.execute("SELECT doc_id, text FROM documents").fetchall()


def bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(round(r[i], 9) if isinstance(r[i], float) else r[i] for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, tables, name):
    df = queries.QUERIES[name](spark, SF)
    cur = tables.execute(queries.ORACLES[name])
    columns = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, cur.fetchall())


def by_id(spark, name):
    return {r[0]: r for r in queries.QUERIES[name](spark, SF).collect()}


@pytest.mark.parametrize("name,label,fold,out", [("op1_toxicity", "toxic", 5, 0), ("op2_quality", "quality", 3, 1)])
def test_classifiers_on_held_out_rows(spark, tables, texts, name, label, fold, out):
    got = by_id(spark, name)
    assert set(got) == {k for k, _ in texts} and len(got) == len(texts)
    for k, r in got.items():
        assert r.held_out == (zlib.crc32(str(k).encode()) % fold == out)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    # The larger table holds enough labels to ask for accuracy.
    df = queries.QUERIES[name](spark, SF.replace("0.001", "0.1"))
    labels = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{SF.replace('0.001', '0.1')}/labels.parquet'").fetchall())
    hits = [r.predicted == labels[r.doc_id] for r in df.collect() if r.held_out and r.doc_id in labels]
    assert len(hits) > 500 and np.mean(hits) > 0.95


def test_toxicity_scores_repeat_by_hand(spark, tables, texts):
    got = by_id(spark, "op1_toxicity")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").filter(toxicity.fold(toxicity.F.col("doc_id"), 5) != 0)
    scores = toxicity.WordScores(toxicity.train(docs, labels))
    for k, text in texts:
        p = 1 - math.prod(1 - x for _, _, x in toxicity.sentence_scores(text, scores))
        assert got[k].score == pytest.approx(p, abs=1e-9)


def test_secrets_of_every_text(spark, texts):
    got = by_id(spark, "op3_secret_scan")
    kinds = ["assign", "access", "hex", *(c.kind for c in secrets.CLASSES)]
    for k, text in texts:
        base = brute.secret_base(text)
        spans = base + [(a, 3 + i, b, c.kind) for i, c in enumerate(secrets.CLASSES) for a, b in brute.entropy_spans(
            text, c.members, c.least, c.window, c.bits, secrets.ALLOWED, secrets.EXAMPLES)]
        joined = lambda s: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in sorted(s))
        r = got[k]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(s[3] == kind for s in base) for kind in kinds[:3]]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest() and r.spans == joined(spans)


def test_licenses_of_every_text(spark, texts):
    got = by_id(spark, "op5_license_scan")
    phrases = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
    for k, text in texts:
        w = brute.ALNUM.findall(brute.lower(text))
        places = [(i, label) for p, label in phrases.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
        r, base = got[k], {label for _, label in places}
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(base)))
        assert (r.first_word, r.last_word) == ((min(places)[0], max(places)[0]) if places else (None, None))
        assert base <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1


def test_nearest_of_every_query(spark, tables):
    data = [(i, np.array(v, float)) for i, v in tables.execute("SELECT vec_id, embedding FROM embeddings").fetchall()]
    ids, vectors = np.array([i for i, _ in data]), np.array([v for _, v in data])
    norms = np.sqrt((vectors * vectors).sum(1))
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in queries.QUERIES["op8_nearest"](spark, SF).collect()}
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        own = np.flatnonzero(ids == q)[0]
        score = (vectors * vectors[own]).sum(1) / (norms * norms[own])
        score[own] = -2
        best = np.lexsort((ids, -score))[:5]
        for rank in range(1, 6):
            vec, s = got[q, rank]
            assert s == pytest.approx(score[ids == vec][0], abs=1e-12)
            hits += vec in ids[best]
            total += 1
    assert len(got) == total and hits / total >= 0.9

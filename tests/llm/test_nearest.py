"""Nearest neighbours: what a task holds and hands on, whatever the number of blocks."""

import numpy as np
import pandas as pd
import pytest

from tabwise.llm import ann


def brute(data, queries, k):
    found = {}
    for q, own in queries:
        scored = sorted((-(v * own).sum() / (np.sqrt((v * v).sum()) * np.sqrt((own * own).sum())), i)
                        for i, v in data if i != q and len(v) == len(own))
        found |= {(q, rank + 1): (i, -s) for rank, (s, i) in enumerate(scored[:k])}
    return found


def frame(spark, vectors, kind="float"):
    return spark.createDataFrame([(i, v.tolist()) for i, v in vectors], f"vec_id long, embedding array<{kind}>")


def meetings(vectors, blocks, parts):
    """Rows as a task gets them: each part for each block."""
    for b in range(blocks):
        own = [x for x in vectors if x[0] % blocks == b]
        block = ann._index_block((vectors[0][1].size, b), pd.DataFrame(own, columns=["vec_id", "vector"]))
        for p in range(parts):
            queries = [x for x in vectors if x[0] % 10 == 0 and x[0] // 10 % parts == p]
            part = ann._query_block((vectors[0][1].size, p), pd.DataFrame(queries, columns=["vec_id", "vector"]))
            yield block.merge(part, on="dim")


def test_a_task_keeps_k_of_each_query_over_its_blocks():
    rng = np.random.default_rng(3)
    vectors = [(i, v) for i, v in enumerate(rng.normal(size=(400, 48)).astype(np.float32))]
    got = pd.concat(ann._search(4, ann.BOUND)(meetings(vectors, 8, 3)))
    assert len(got) == 40 * 4  # k per query, not per query and block
    wanted = brute([(i, v.astype(float)) for i, v in vectors], [(i, v.astype(float)) for i, v in vectors[::10]], 4)
    got = got.sort_values(["query_id", "score"], ascending=[True, False])
    assert got["vec_id"].tolist() == [i for i, _ in wanted.values()]
    assert got["score"].tolist() == pytest.approx([s for _, s in wanted.values()], abs=1e-12)


def test_queries_are_not_copied_to_every_block(spark):
    vectors = [(i, v) for i, v in enumerate(np.random.default_rng(4).normal(size=(120, 8)).astype(np.float32))]
    df = frame(spark, vectors)
    got = ann.nearest(ann.build_index(df, 20), df.filter("vec_id % 5 = 0"), 3)
    assert "Generate" not in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 24 * 3


def test_floats_are_kept_as_floats(spark):
    vectors = [(i, v) for i, v in enumerate(np.random.default_rng(4).normal(size=(50, 8)).astype(np.float32))]
    for kind, size in (("float", 4), ("double", 8)):
        kept = ann.build_index(frame(spark, vectors, kind)).collect()
        assert sum(len(r.vectors) for r in kept) == 50 * 8 * size


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_over_many_parts_and_stretches(spark, monkeypatch, kind):
    for name, value in (("PARTS_HELD", 2), ("LANES", 3), ("MEETINGS", 6), ("_TILE", 4), ("_RESCORED", 64)):
        monkeypatch.setattr(ann, name, value)
    rng = np.random.default_rng(6)
    vectors = [(i, v.astype(np.float32)) for i, v in enumerate(rng.normal(size=(500, 24)))]
    vectors += [(1000 + i, v.astype(np.float32)) for i, v in enumerate(rng.normal(size=(90, 5)))]
    vectors += [(2000 + i, vectors[50][1]) for i in range(30)]  # ties
    vectors += [(3000, np.ones(3, np.float32))]  # the only one of its length
    vectors += [(70, -vectors[70][1])]  # an id with two vectors: both are the query's own
    df = frame(spark, vectors, kind)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in
           ann.nearest(ann.build_index(df, 60), df.filter("vec_id % 10 = 0 and vec_id <> 70"), 5, block=9).collect()}
    real = [(i, v.astype(float)) for i, v in vectors]
    wanted = brute(real, [x for x in real if x[0] % 10 == 0 and x[0] != 70], 5)
    assert got.keys() == wanted.keys()
    for key, (vec, score) in wanted.items():
        assert got[key][0] == vec and got[key][1] == pytest.approx(score, abs=1e-12)

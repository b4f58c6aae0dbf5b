import random

import corpus_pipeline as P
import pytest
from pyspark.sql import functions as F

from tabwise.llm import queries, toxicity
from tests.llm import brute
from tests.llm.test_operators import prose, toxic_set

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(9)
    texts, toxic = toxic_set(rng, 200)
    clean = [t for t, x in zip(texts, toxic) if not x]
    item = prose(rng, 40, 10_000)
    texts += [clean[0], clean[0], clean[1] + " " + "more", f"{prose(rng, 30)} {item} {prose(rng, 5)}", None, "", "   ",
              f"{prose(rng, 40)} token=abcdef123456 {prose(rng, 3)}", prose(rng, 9_000, 9_000)]
    data = [(i, t, "en", rng.choice(["a", "b", None]), None if t is None else len(t)) for i, t in enumerate(texts)]
    data += [data[-1], (None, prose(rng, 50), None, "a", None)]
    d = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(data, SCHEMA).repartition(4).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 1, int(x)) for i, x in enumerate(toxic)], "doc_id long, quality int, toxic int"
                          ).write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def plain(df):
    return sorted((tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()), key=repr)


def test_each_stage_matches_brute_force_on_its_own_input(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    stages = dict(P.STAGES)

    left = spark.createDataFrame(stages["toxicity"](spark, docs, corpus).collect(), SCHEMA)
    assert left.columns == docs.columns
    model = toxicity.train(docs, spark.read.parquet(f"{corpus}/labels.parquet").filter(
        F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    scores = toxicity.WordScores(model)
    score = lambda t: 1 - __import__("math").prod(1 - p for _, _, p in toxicity.sentence_scores(t, scores))
    assert plain(left) == [r for r in plain(docs) if score(r[1]) < 0.5]
    assert 0 < left.count() < docs.count()

    before, left = left, spark.createDataFrame(stages["near_duplicates"](spark, left, corpus).collect(), SCHEMA)
    data = plain(before)
    kept = {r for r, g in zip(data, brute.groups([(r[0], r[1]) for r in data], 5)) if g[3]}
    assert plain(left) == sorted(kept, key=repr) and len(kept) < len(data)

    before, left = left, spark.createDataFrame(stages["decontamination"](spark, left, corpus).collect(), SCHEMA)
    items = [tuple(r) for r in spark.read.parquet(f"{corpus}/benchmark.parquet").collect()]
    data = plain(before)
    hit = brute.contamination([(r[0], r[1]) for r in data], items)
    assert plain(left) == [r for r, h in zip(data, hit) if not h[2]] and len(plain(left)) == len(data) - 1

    before, left = left, spark.createDataFrame(stages["secrets"](spark, left, corpus).collect(), SCHEMA)
    changed = set(plain(left)) - set(plain(before))
    assert left.count() == before.count() and len(changed) == 1
    assert all("[SECRET]" in t and "abcdef123456" not in t and n == len(t) for _, t, _, _, n in changed)

    mixed = stages["mixing"](spark, left, corpus).collect()
    sizes = {}
    for _, t, _, s, _ in plain(left):
        sizes[s] = sizes.get(s, 0) + len(brute.SPACE.findall(t or ""))
    for s, target in brute.targets(sizes).items():
        assert abs(sum(r.taken for r in mixed if r.source == s) - target) <= 1

    whole = [tuple(r) for r in P.run(spark, corpus).collect()]
    assert sorted(whole, key=repr) == sorted(map(tuple, mixed), key=repr)


def test_stages_take_empty_tables_and_clashing_columns(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    for c in ("row", "found", "id", "text_key", "words", "hits", "pieces", "masked", "secret_spans", "a.b"):
        docs = docs.withColumn(c, F.lit("keep"))
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, docs, corpus)
        assert out.columns == docs.columns, name
        assert out.filter("row <> 'keep' or secret_spans <> 'keep' or words <> 'keep'").count() == 0
        assert stage(spark, docs.limit(0), corpus).count() == 0
    assert P.mix(spark, docs, corpus).count() == docs.count()
    assert P.mix(spark, docs.limit(0), corpus).count() == 0


def test_queries_cover_the_operators():
    assert [k.split("_")[0] for k in queries.QUERIES] == [f"op{i}" for i in range(1, 11)]
    assert set(queries.ORACLES) <= set(queries.QUERIES)

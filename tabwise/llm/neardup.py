"""Near-duplicate documents by one-permutation MinHash and star-shaped candidates.

One hash of every shingle splits the shingles into ``BINS`` bins and gives each
bin's minimum (one permutation). Empty bins borrow from a bin that optimal
densification picks by hashing (bin, attempt), the same way for every document.
Bands of bins are buckets, narrow ones for recall and wide ones that part the
large buckets of related texts. Inside a bucket every member is paired with one
centre only, so a bucket of n members gives n - 1 candidates, not n(n-1)/2. The
centre is the member that shares the most buckets, as the text does that others
were made from. After the confirmed links have been joined into groups, members
that are not in their centre's group meet other centres, until a turn brings no
new link.

Documents with the same set of shingles are one class from the start, so copies
cost nothing beyond an aggregate. Candidates are confirmed on the full sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm.common import durable, table
from tabwise.llm.components import components
from tabwise.llm.wordhash import WordHasher, mix

THRESHOLD = 80  # per cent
BINS = 192


@dataclass(frozen=True)
class Bands:
    """``count`` bands of ``rows`` bins each, taken round and round from all bins."""

    count: int
    rows: int


#: Another turn of centres is worth it while one pair in so many is a link.
WORTH = 10
#: Classes with the same rare shingle that meet in one place; more are dealt out.
CHUNK = 1024
#: At a similarity of 0.8 a pair shares no narrow band with probability 2e-6.
NARROW = Bands(32, 5)
WIDE = Bands(16, 10)


def one_permutation(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """The minimum of each bin, empty bins densified; all ones for an empty set."""
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.full(bins, full, np.uint64)
    if len(shingles) == 0:
        return out
    h = mix(shingles ^ np.uint64(0xA0761D6478BD642F))
    np.minimum.at(out, (h >> np.uint64(40)) % np.uint64(bins), h)
    empty = np.flatnonzero(out == full)
    if len(empty):
        source = out.copy()
        attempt = 0
        while len(empty):
            attempt += 1
            seed = np.uint64((attempt * 0xE7037ED1A0B428DB) & 0xFFFFFFFFFFFFFFFF)
            pick = mix(empty.astype(np.uint64) + seed) % np.uint64(bins)
            got = source[pick]
            out[empty] = got
            empty = empty[got == full]
    return out


def band_keys(signature: np.ndarray, bands: Bands, seed: int) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    at = (np.arange(bands.count * bands.rows) * (1 if seed == 0 else 7) + seed) % len(signature)
    rows = signature[at].reshape(bands.count, bands.rows)
    out = mix(np.arange(bands.count, dtype=np.uint64) + np.uint64(seed * 1000 + 1))
    for j in range(bands.rows):
        out = mix(out * np.uint64(0x9FB21C651E98DF25) + rows[:, j])
    return out


def _sketches(shingle: int, narrow: Bands, wide: Bands):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in batches:
            for first in range(0, len(pdf), 256):
                part = pdf.iloc[first : first + 256]
                rows = []
                for key, text_key, words in zip(part["doc_id"], part["text_key"], hasher.words(part["text"])):
                    s = hasher.shingle_set(words, shingle)
                    signature = one_permutation(s)
                    # Two independent sums over the set name its class.
                    a = int(mix(s).sum(dtype=np.uint64)) if len(s) else 0
                    b = int(mix(s ^ np.uint64(0x8EBC6AF09C88C6E3)).sum(dtype=np.uint64)) if len(s) else 0
                    rows.append((key, text_key, len(s), _signed(a), _signed(b),
                                 band_keys(signature, narrow, 0).view(np.int64) if len(s) else [],
                                 band_keys(signature, wide, 3).view(np.int64) if len(s) else []))
                out = pd.DataFrame(rows, columns=["doc_id", "text_key", "n_shingles", "set_a", "set_b", "narrow", "wide"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

    return run


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _sets(shingle: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = WordHasher()
        for pdf in batches:
            for first in range(0, len(pdf), 64):
                part = pdf.iloc[first : first + 64]
                sets = [hasher.shingle_set(w, shingle).view(np.int64) for w in hasher.words(part["text"])]
                yield pd.DataFrame({"cls": part["cls"].to_numpy(), "shingles": sets})

    return run


def sketches(docs: DataFrame, shingle: int, narrow: Bands = NARROW, wide: Bands = WIDE) -> DataFrame:
    """doc_id, text_key, n_shingles, set_a, set_b (name the shingle set), narrow and wide band keys."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    return rows.mapInPandas(_sketches(shingle, narrow, wide),
                            "doc_id long, text_key long, n_shingles long, set_a long, set_b long, "
                            "narrow array<long>, wide array<long>")


def _shared_buckets(classes: DataFrame) -> DataFrame:
    """(cls, n_shingles, bucket, wide, company) of the buckets with two classes or more.

    ``company`` is the number of members over all buckets of the class: of related
    texts, the one that the others were made from shares the most buckets.
    """
    parts = []
    for bands in ("narrow", "wide"):
        members = classes.select("cls", "n_shingles", F.explode(bands).alias("bucket"))
        several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        parts.append(members.join(several, "bucket").select(
            "cls", "n_shingles", "bucket", F.lit(bands == "wide").alias("wide"), "n"))
    shared = durable(parts[0].unionByName(parts[1]))
    company = shared.groupBy("cls").agg(F.sum("n").alias("company"))
    return shared.drop("n").join(company, "cls")


def _stars(members: DataFrame, rank: Column, threshold: int) -> DataFrame:
    """Candidate pairs (a, b, and their groups ga, gb): every member of a bucket with its centre.

    The centre is the smallest by ``rank``. Pairs within a group are left out, and
    set sizes alone rule out those that cannot be similar enough.
    """
    centres = members.groupBy("bucket").agg(F.min(F.struct(
        rank.alias("rank"), F.col("cls").alias("centre"),
        F.col("component").alias("centre_component"), F.col("n_shingles").alias("centre_n"))).alias("c")).select(
        "bucket", "c.centre", "c.centre_component", "c.centre_n")
    sizes = (100 * F.least("n_shingles", "centre_n") >= threshold * F.greatest("n_shingles", "centre_n"))
    return (members.join(centres, "bucket").filter((F.col("component") != F.col("centre_component")) & sizes)
            .select(F.col("cls").alias("a"), F.col("centre").alias("b"), F.col("component").alias("ga"),
                    F.col("centre_component").alias("gb")).dropDuplicates(["a", "b"]))


def _confirm(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("cls").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("cls").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    union = F.size("sa") + F.size("sb") - both
    return (pairs.join(left, "a").join(right, "b").filter(100 * both >= threshold * union)
            .select("a", "b", "ga", "gb"))


def _rarest(active: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """cls, component, n, pos, shingle, indexed: of every class left, its rarest shingles.

    The order is the same for all: first what occurs in one group only (it links
    nothing and is not listed), then by the number of classes. A pair of the
    threshold shares a shingle of the first n - ceil(t n) + 1 of the larger set and
    the first n - ceil(2t / (1 + t) n) + 1 (``indexed``) of the smaller one.
    """
    left = active.select("cls", "component").distinct()
    each = sets.join(left, "cls").select("cls", "component", F.size("shingles").alias("n"),
                                         F.explode("shingles").alias("shingle"))
    several = each.groupBy("shingle").agg(
        F.count(F.lit(1)).alias("classes"), F.min("component").alias("low"), F.max("component").alias("high")).filter(
        "low < high").select("shingle", "classes")
    ranked = each.join(several, "shingle").groupBy("cls", "component", "n").agg(
        F.array_sort(F.collect_list(F.struct("classes", "shingle"))).alias("ranked"))
    before = F.col("n") - F.size("ranked")
    first = F.expr(f"n - int(({threshold} * n + 99) div 100) + 1")
    indexed = F.expr(f"n - int((2 * {threshold} * n + {99 + threshold}) div {100 + threshold}) + 1")
    kept = F.slice("ranked", F.lit(1), F.greatest(first - before, F.lit(0)))
    return (ranked.select("cls", "component", "n", before.alias("before"), F.posexplode(kept).alias("k", "r"))
            .withColumn("pos", F.col("before") + F.col("k"))
            .select("cls", "component", "n", "pos", F.col("r.shingle").alias("shingle"),
                    (F.col("pos") < indexed).alias("indexed")))


def _exact(active: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Candidate pairs (a, b, ga, gb) with every pair of the threshold in different groups.

    Two classes of one group never meet: of each shingle, those of its largest
    group meet only the others. The classes of a frequent shingle are dealt out in
    chunks, each chunk of larger sets with each of smaller ones. Set sizes and the
    places of the shared shingles rule out most pairs.
    """
    rarest = durable(_rarest(active, sets, threshold))
    of_group = rarest.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("size"))
    spread = of_group.groupBy("shingle").agg(
        F.max_by("component", F.struct("size", "component")).alias("largest"), F.sum("size").alias("size"),
        F.count(F.lit(1)).alias("groups")).filter("groups > 1").select(
        "shingle", "largest", F.ceil(F.col("size") / CHUNK).cast("int").alias("chunks"))
    rows = rarest.join(spread, "shingle").withColumn("other", F.col("component") != F.col("largest")).withColumn(
        "own", F.pmod(F.xxhash64("cls"), F.col("chunks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))
    # Meeting 0: smaller sets outside the largest group with all; meeting 1: those inside it with the others.
    larger = rows.select(
        "shingle", F.col("cls").alias("a"), F.col("component").alias("ga"), F.col("n").alias("na"),
        F.col("pos").alias("pa"), F.col("own").alias("ca"), "other", every.alias("cb")).select(
        "*", F.explode(F.when(F.col("other"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("meeting"))
    smaller = rows.filter("indexed").select(
        "shingle", F.col("cls").alias("b"), F.col("component").alias("gb"), F.col("n").alias("nb"),
        F.col("pos").alias("pb"), F.col("own").alias("cb"), F.when(F.col("other"), 0).otherwise(1).alias("meeting"),
        every.alias("ca"))
    needed = threshold * (F.col("na") + F.col("nb"))
    rest = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb"))
    met = larger.drop("other").join(smaller, ["shingle", "meeting", "ca", "cb"]).filter(
        (F.col("ga") != F.col("gb"))
        & ((F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a"))))
        & (100 * F.col("nb") >= threshold * F.col("na")) & ((100 + threshold) * rest >= needed))
    # Shared so far, and what can follow the last shared place.
    most = F.col("shared") - 1 + rest
    return (met.groupBy("a", "b", "ga", "gb", "na", "nb")
            .agg(F.count(F.lit(1)).alias("shared"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
            .filter((100 + threshold) * most >= needed).select("a", "b", "ga", "gb"))


def linked_classes(docs: DataFrame, classes: DataFrame, shingle: int, threshold: int = THRESHOLD) -> DataFrame:
    """node, component of the classes that are linked with any other.

    The first two turns make the member with the most company the centre, of the
    wide bands (the closest texts, few pairs), then of all. After that centres
    change from bucket to bucket and from turn to turn, while one pair in ``WORTH``
    is confirmed. Each turn gives one pair per member and bucket at most, and only
    for what is not yet linked. The last turn joins what is left exactly.
    """
    shared = durable(_shared_buckets(classes))
    groups = durable(shared.select(F.col("cls").alias("node")).distinct().withColumn("component", F.col("node")))
    members = classes.join(groups, F.col("cls") == F.col("node")).select("cls", "rep_id", "rep_text")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_key"), "text")
    # A representative that occurs in several equal rows is one set: first() of equal texts.
    with_text = (texts.join(members, F.col("doc_id").eqNullSafe(F.col("rep_id"))
                            & (F.col("text_key") == F.col("rep_text")))
                 .select("cls", "text").dropDuplicates(["cls"]))
    sets = durable(with_text.mapInPandas(_sets(shingle), "cls long, shingles array<long>"))
    active, tested, turn, last = shared.withColumn("component", F.col("cls")), None, 0, False
    while True:
        turn += 1
        rank = -F.col("company") if turn <= 2 else F.xxhash64("cls", "bucket", F.lit(turn))
        pairs = _exact(active, sets, threshold) if last else _stars(
            active.filter("wide") if turn == 1 else active, rank, threshold)
        pairs = durable(pairs if tested is None else pairs.join(tested, ["a", "b"], "left_anti"))
        found = durable(_confirm(pairs, sets, threshold))
        tested = pairs.select("a", "b") if tested is None else tested.unionByName(pairs.select("a", "b"))
        # Only the groups that the new links join change their names.
        renamed = durable(components(found.select(F.col("ga").alias("a"), F.col("gb").alias("b")))
                          .select(F.col("node").alias("component"), F.col("component").alias("renamed")))
        name = F.coalesce("renamed", "component")
        groups = durable(groups.join(renamed, "component", "left").select("node", name.alias("component")))
        if last:
            return groups
        active = active.join(renamed, "component", "left").withColumn("component", name).drop("renamed")
        # A bucket within one group is done with, and groups never part.
        mixed = active.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter(
            "low < high").select("bucket")
        active = durable(active.join(mixed, "bucket", "left_semi"))
        last = turn >= 2 and WORTH * found.count() < pairs.count()
        if not active.limit(1).count():
            return groups


def near_duplicates(docs: DataFrame, shingle: int = 5, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, text_key, n_shingles, component_id, kept: one row per input row.

    ``text_key`` is xxhash64 of the text, so (doc_id, text_key) names the input
    row. ``component_id`` is the smallest doc_id of the group, null ids left out;
    ``kept`` marks the row that has it. Words are lower-cased (A-Z) and parted by
    ASCII white space; a text with fewer than ``shingle`` words is one shingle.
    Null and blank texts have no shingles and are linked with nothing: each row
    is its own group, kept. A row with a null id is kept only where it is linked
    with no row that has one. Equal rows share their result. An empty table
    gives an empty result.
    """
    rows = durable(sketches(docs, shingle))
    filled = rows.filter(F.col("n_shingles") > 0)
    # Bands of equal sets are equal, and so is any row of a class.
    classes = (filled.groupBy("set_a", "set_b", "n_shingles")
               .agg(F.min("doc_id").alias("least_id"),
                    F.min(F.struct(F.col("doc_id").alias("id"), F.col("text_key").alias("text"))).alias("rep"),
                    F.first("narrow").alias("narrow"), F.first("wide").alias("wide"))
               .withColumn("cls", F.xxhash64("set_a", "set_b", "n_shingles"))
               .select("cls", "set_a", "set_b", "n_shingles", "least_id", F.col("rep.id").alias("rep_id"),
                       F.col("rep.text").alias("rep_text"), "narrow", "wide"))
    classes = durable(classes)
    groups = linked_classes(docs, classes, shingle, threshold)
    named = (classes.join(groups, F.col("cls") == F.col("node"), "left")
             .select("cls", "least_id", F.coalesce("component", "cls").alias("component")))
    least = named.groupBy("component").agg(F.min("least_id").alias("component_id"))
    of_class = named.join(least, "component").select("cls", "component_id")
    keyed = rows.select("doc_id", "text_key", "n_shingles", F.when(
        F.col("n_shingles") > 0, F.xxhash64("set_a", "set_b", "n_shingles")).alias("cls"))
    out = keyed.join(of_class, "cls", "left").withColumn(
        "component_id", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")))
    kept = F.col("component_id").isNull() | F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    return out.select("doc_id", "text_key", "n_shingles", "component_id", kept.alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle=4)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


ORACLE = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(words) >= 4 THEN list_transform(
           range(1, len(words) - 2), lambda i: array_to_string(words[i : i + 3], ' '))
         WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS shingles
  FROM d),
c AS (SELECT min(doc_id) AS cls, list_sort(shingles) AS shingles FROM s WHERE len(shingles) > 0 GROUP BY 2),
e AS (SELECT cls, len(shingles) AS n, unnest(shingles) AS shingle FROM c),
-- Rarest first: a pair at 0.8 shares a shingle among the first 20 % (and one) of each side.
f AS (SELECT e.*, row_number() OVER (PARTITION BY cls ORDER BY df, shingle) AS pos
      FROM (SELECT e.*, count(*) OVER (PARTITION BY shingle) AS df FROM e) e),
p AS (SELECT cls, n, shingle FROM f WHERE pos <= n - (80 * n + 99) // 100 + 1),
pairs AS (SELECT DISTINCT x.cls AS a, y.cls AS b FROM p x JOIN p y ON x.shingle = y.shingle AND x.cls < y.cls
          WHERE 100 * least(x.n, y.n) >= 80 * greatest(x.n, y.n)),
links AS (
  SELECT a, b FROM pairs JOIN c x ON a = x.cls JOIN c y ON b = y.cls
  WHERE 180 * len(list_intersect(x.shingles, y.shingles)) >= 80 * (len(x.shingles) + len(y.shingles))),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT cls AS start, cls AS node FROM c
  UNION SELECT r.start, b.b FROM reach r JOIN both_ways b ON r.node = b.a),
least AS (SELECT node AS cls, min(start) AS component_id FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles,
       coalesce(l.component_id, s.doc_id) AS component_id, coalesce(l.component_id, s.doc_id) = s.doc_id AS kept
FROM s LEFT JOIN c ON len(s.shingles) > 0 AND list_sort(s.shingles) = c.shingles LEFT JOIN least l ON l.cls = c.cls
"""

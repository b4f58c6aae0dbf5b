"""Benchmark decontamination: a prefix-filtered join on word shingles, then exact windows.

An item's windows are its runs of ``window`` words (a shorter item is one
window). A window occurs in a document only if each of its shingles does, so one
shingle is a sufficient prefix; taking the rarest one keeps the join small:

1. Occurrences in the documents of any shingle of the benchmark: one pass.
2. Their counts order each window's shingles by rarity; a window with a shingle
   that no document holds is gone.
3. The rarest shingle's occurrences, joined back, give the only places where the
   window can start; those where it would stick out of the document are dropped.
4. Each remaining place is compared word by word with the window.

Everything is plain DataFrame work. Shingles are joined by a 64-bit hash, which
can only add candidates; step 4 compares the words themselves.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwise.llm.common import NON_WORD_CLASS, durable, lower_ascii, table, words

WINDOW = 10
SHINGLE = 5
#: Distinct shingles of the benchmark that are sent to every executor (8 bytes each);
#: a larger benchmark is joined by a shuffle instead.
BROADCAST_SHINGLES = 1_000_000


def _words(text: Column) -> Column:
    return words(lower_ascii(text), NON_WORD_CLASS)


def _shingles(of: Column, size: int) -> Column:
    """Hash of each run of ``size`` words, in order; null when there are fewer."""
    return F.when(F.size(of) >= size, F.transform(
        F.sequence(F.lit(0), F.size(of) - size),
        lambda i: F.xxhash64(*[F.get(of, i + j) for j in range(size)])))


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """phrase (words joined by a space), length, items: each distinct window once."""
    items = (benchmark.select(F.col("item_id").cast("string").alias("item"), _words(F.col("text")).alias("words"))
             .withColumn("length", F.least(F.size("words"), F.lit(window))).filter(F.col("length") > 0))
    starts = F.sequence(F.lit(0), F.size("words") - F.col("length"))
    each = items.select("item", "length", F.explode(F.transform(
        starts, lambda i: F.array_join(F.slice(F.col("words"), i + 1, F.col("length")), " "))).alias("phrase"))
    return each.groupBy("phrase", "length").agg(F.array_sort(F.collect_set("item")).alias("items"))


def _key() -> list[Column]:
    """A document row: its id and a hash of its text. Rows that agree in both get the same result."""
    return [F.col("doc_id").alias("key_id"), F.xxhash64("text").alias("key_text")]


def _candidates(docs: DataFrame, windows: DataFrame, shingle: int) -> DataFrame:
    """key_id, key_text, places: array of (start, length, phrase, items) where a window may start."""
    spark = docs.sparkSession
    cut = durable(windows.withColumn("words", F.split("phrase", " "))
                  .withColumn("size", F.least(F.col("length"), F.lit(shingle))))
    sizes = sorted(r["size"] for r in cut.select("size").distinct().collect())  # at most `shingle` values
    per_size = [cut.filter(F.col("size") == n).select(
        "phrase", "length", "items", "size", F.posexplode(_shingles(F.col("words"), n)).alias("offset", "hash"))
        for n in sizes]
    if not per_size:
        return spark.createDataFrame([], "key_id bigint, key_text bigint, places array<struct<start:int,length:int,"
                                         "phrase:string,items:array<string>>>")
    parts = durable(reduce(DataFrame.unionByName, per_size))
    wanted = durable(parts.select("size", "hash").distinct())
    small = wanted.count() <= BROADCAST_SHINGLES
    found = []
    for n in sizes:
        of_size = wanted.filter(F.col("size") == n).select("hash")
        each = (docs.select(*_key(), _words(F.col("text")).alias("words"))
                .select("key_id", "key_text", F.size("words").alias("n_words"), F.lit(n).alias("size"),
                        F.posexplode(_shingles(F.col("words"), n)).alias("pos", "hash")))
        found.append(each.join(F.broadcast(of_size) if small else of_size, "hash"))
    occurrences = durable(reduce(DataFrame.unionByName, found))
    counts = occurrences.groupBy("size", "hash").agg(F.count(F.lit(1)).alias("n"))
    rarest = (parts.join(counts, ["size", "hash"], "left")
              .groupBy("phrase", "length", "items")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "size", "hash", "offset")).alias("rarest"))
              .filter(F.col("rarest.n") > 0)
              .select("phrase", "length", "items", "rarest.size", "rarest.hash", "rarest.offset"))
    start = F.col("pos") - F.col("offset")
    return (occurrences.join(rarest, ["size", "hash"])
            .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")))
            .groupBy("key_id", "key_text")
            .agg(F.collect_set(F.struct(start.alias("start"), "length", "phrase", "items")).alias("places")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                       shingle: int = SHINGLE) -> DataFrame:
    """The input rows with ``n_words``, ``n_hit`` (words inside any occurrence) and ``hit_items``.

    ``hit_items`` are the ids of the items with occurring windows, as text, sorted.
    Null and empty texts have no words, neither here nor as items; null item ids
    are left out of the list, their windows count. Items without words match
    nothing. Repeated rows each get the same result; an empty benchmark hits
    nothing. Columns of these names in ``docs`` are replaced.
    """
    plain = docs.drop("n_words", "n_hit", "hit_items")
    candidates = _candidates(docs.select("doc_id", "text"), item_windows(benchmark, window), shingle)
    keyed = plain.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), F.xxhash64("text").alias("text_key"))
    joined = (keyed.join(candidates, F.col("id").eqNullSafe(F.col("key_id"))
                         & (F.col("text_key") == F.col("key_text")), "left")
              .withColumn("words", _words(F.col("row.text"))))
    hits = F.filter(F.coalesce("places", F.expr("array()")), lambda p: F.array_join(
        F.slice(F.col("words"), p["start"] + 1, p["length"]), " ") == p["phrase"])
    # Places are unique and sorted by start: one sweep counts the words they cover.
    covered = F.aggregate(
        F.array_sort(F.transform("hits", lambda h: F.struct(h["start"].alias("start"), h["length"].alias("length")))),
        F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n")),
        lambda s, h: F.struct(
            F.greatest(s["end"], h["start"] + h["length"]).alias("end"),
            (s["n"] + F.greatest(F.lit(0), h["start"] + h["length"] - F.greatest(s["end"], h["start"]))).alias("n")),
        lambda s: s["n"])
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("hits", lambda h: h["items"]))))
    return (joined.withColumn("hits", hits)
            .select("row.*", F.size("words").cast("long").alias("n_words"), covered.alias("n_hit"),
                    items.alias("hit_items")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"),
                               table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
i AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark),
sized AS (SELECT *, least(len(words), 10) AS n FROM i WHERE len(words) > 0),
starts AS (SELECT item, words, n, unnest(range(len(words) - n + 1)) AS s FROM sized),
w AS (SELECT DISTINCT item, n, array_to_string(words[s + 1 : s + n], ' ') AS phrase FROM starts),
lengths AS (SELECT DISTINCT n FROM w),
places AS (
  SELECT row, words, n, unnest(range(len(words) - n + 1)) AS s FROM d JOIN lengths ON len(words) >= n),
hits AS (
  SELECT p.row, p.s, p.n, w.item
  FROM places p JOIN w ON p.n = w.n AND array_to_string(p.words[p.s + 1 : p.s + p.n], ' ') = w.phrase),
covered AS (
  SELECT row, count(DISTINCT pos) AS n_hit
  FROM (SELECT row, unnest(range(s, s + n)) AS pos FROM hits) GROUP BY row),
items AS (
  SELECT row, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items
  FROM hits GROUP BY row)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(x.n_items, 0) AS n_items, sha256(coalesce(x.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c ON d.row = c.row LEFT JOIN items x ON d.row = x.row
"""

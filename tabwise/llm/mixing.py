"""Mixing sources to target weights by a low-discrepancy schedule.

Every source gets a quota of words from its weight. Its documents, in a shuffled
order that depends on the ids alone, form one stream of words that is cut into
blocks of equal size. The schedule is a row of slots; slot ``j`` takes the point
``j`` of the base-2 van der Corput sequence, which falls into one source's part
of the cumulative weights, so that every stretch of the schedule has nearly the
right mixture. Slots are ranked per source, and rank ``r`` takes block ``r`` of
the source's stream, from the start again when the stream is used up.

The sequence misses a source's quota by a few slots at most: slots beyond the
quota are dropped, missing ones close the schedule, and a source's last slot is
cut, so each source gives exactly its quota.

No step needs a whole source in one task: stream positions and slot ranks are
sums over small stretches plus offsets. Everything is plain DataFrame work.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwise.llm.common import SPACE_CLASS, durable, table, words
from tabwise.operators.ordinal import with_ordinal, with_running_weight

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
BLOCK_WORDS = 2048
#: Rows that one stretch of a stream or of the schedule holds, about.
STRETCH = 20_000
_POINT_BITS = 53


def document_sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source, size (words of the text; 0 for null)."""
    return docs.select("doc_id", "source", F.size(words(F.col("text"), SPACE_CLASS)).cast("long").alias("size"))


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                   most: int = MOST) -> DataFrame:
    """Per source: place (by code point, null last), weight, source_size, target, quota.

    ``share`` times all words are dealt by weight. A source above ``most`` times
    its size stops there, and the excess is dealt to the others by weight, until
    none is above. Each pass is one aggregate over the sources.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = with_ordinal(totals, [F.col("source").asc_nulls_last()], "place")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          (F.col("place") % len(weights) + 1).cast("int"))
    placed = durable(placed.withColumn("weight", weight))
    size = F.col("source_size").cast("double")
    total = placed.agg(F.sum(size)).first()[0] or 0.0
    level = (0.0, 1.0)  # words, weight: of the sources that have not stopped

    def above(level: tuple) -> Column:
        return F.col("weight") * F.lit(level[0]) / F.lit(level[1]) > most * size

    stopped = -1
    while True:
        row = placed.agg(F.coalesce(F.sum(F.when(above(level), size)), F.lit(0.0)).alias("held"),
                         F.sum(F.when(above(level), 0.0).otherwise(F.col("weight"))).alias("open"),
                         F.sum(above(level).cast("long")).alias("n")).first()
        if row["n"] == stopped or not row["open"]:
            break
        stopped, level = row["n"] if stopped >= 0 else 0, (share * total - most * row["held"], row["open"])
    target = F.when(above(level), most * size).otherwise(F.col("weight") * F.lit(level[0]) / F.lit(level[1]))
    return (placed.withColumn("target", target)
            .withColumn("quota", F.least(F.floor(F.col("target") + 0.5), F.lit(most) * F.col("source_size"))))


def _point(slot: Column) -> Column:
    """The van der Corput point of a slot: its bits mirrored behind the point; exact."""
    mirrored = F.reverse(F.lpad(F.bin(slot), _POINT_BITS, "0"))
    return F.conv(mirrored, 2, 10).cast("double") / F.lit(float(1 << _POINT_BITS))


def schedule(spark: SparkSession, targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """slot, place, rank, block, epoch, words: which block each slot takes, and how much of it.

    Empty without words. ``words`` is less than the block's at a source's end.
    """
    size, quota = F.col("source_size"), F.col("quota")
    rest = F.when(size > 0, quota % size).otherwise(0)
    per_source = (targets.filter(quota > 0)
                  .withColumn("blocks", F.ceil(size / block_words))
                  .withColumn("slots", F.floor(quota / size) * F.col("blocks") + F.ceil(rest / block_words))
                  .select("place", "source_size", "quota", "blocks", "slots"))
    parts = durable(with_running_weight(per_source, ["place"], "slots", "slots_before"))
    n, sources = parts.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count(F.lit(1))).first()
    # A point finds its part by an equal join on a grid of the unit interval.
    grid = max(1024, 4 * sources)
    low, high = F.col("slots_before") / F.lit(float(n or 1)), (F.col("slots_before") + F.col("slots")) / F.lit(float(n or 1))
    cells = (parts.withColumn("low", low).withColumn("high", high)
             .select("place", "low", "high", F.explode(F.sequence(
                 F.floor(F.col("low") * grid), F.least(F.floor(F.col("high") * grid), F.lit(grid - 1)))).alias("cell")))
    points = (spark.range(n).withColumnRenamed("id", "slot").withColumn("point", _point(F.col("slot")))
              .withColumn("cell", F.floor(F.col("point") * grid)))
    dealt = (points.join(cells, "cell").filter((F.col("point") >= F.col("low")) & (F.col("point") < F.col("high")))
             .select("slot", "place", F.floor(F.col("slot") / STRETCH).alias("stretch")))
    counts = dealt.groupBy("place", "stretch").agg(F.count(F.lit(1)).alias("n"))
    along = Window.partitionBy("place").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("place", "stretch", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("place", "stretch").orderBy("slot")
    ranked = (dealt.withColumn("row", F.row_number().over(inside)).join(offsets, ["place", "stretch"])
              .select("slot", "place", (F.col("before") + F.col("row") - 1).alias("rank")))
    kept = ranked.join(parts, "place").filter(F.col("rank") < F.col("slots")).select("slot", *parts.columns, "rank")
    had = counts.groupBy("place").agg(F.sum("n").alias("had"))
    short = (parts.join(had, "place", "left").withColumn("had", F.coalesce("had", F.lit(0)))
             .filter(F.col("had") < F.col("slots")))
    closing = (short.withColumn("rank", F.explode(F.sequence(F.col("had"), F.col("slots") - 1)))
               .withColumn("slot", F.lit(n) + F.col("slots_before") + F.col("rank"))
               .select("slot", *parts.columns, "rank"))
    block, epoch = F.col("rank") % F.col("blocks"), F.floor(F.col("rank") / F.col("blocks"))
    whole = F.least(F.lit(block_words), F.col("source_size") - block * block_words)
    left = F.col("quota") - epoch * F.col("source_size") - block * block_words
    return (kept.unionByName(closing)
            .select("slot", "place", "rank", block.alias("block"), epoch.alias("epoch"),
                    F.least(whole, left).alias("words")))


def streams(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Each document's place in its source's shuffled stream: ``start``, and ``stretch`` and ``row`` as its key."""
    rows = sizes.count()
    stretches = rows // STRETCH + 1
    shuffled = (sizes.withColumn("order", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
                .withColumn("stretch", F.floor(F.conv(F.substring("order", 1, 8), 16, 10).cast("long")
                                               * stretches / F.lit(1 << 32))))
    placed = (shuffled.join(targets.select(F.col("source").alias("of"), "place", "source_size", "target"),
                            F.col("source").eqNullSafe(F.col("of"))).drop("of"))
    sums = placed.groupBy("place", "stretch").agg(F.sum("size").alias("n"))
    along = Window.partitionBy("place").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("place", "stretch", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    inside = Window.partitionBy("place", "stretch").orderBy("order", "doc_id", "size")
    return (placed.withColumn("row", F.row_number().over(inside))
            .withColumn("inner", F.coalesce(F.sum("size").over(
                inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
            .join(offsets, ["place", "stretch"])
            .withColumn("start", F.col("before") + F.col("inner")).drop("before", "inner", "order"))


def mix_sources(spark: SparkSession, docs: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE,
                most: int = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Words that the mix takes of each document.

    Returns doc_id, source, size, source_size, target, taken; one row per input
    row, repeated rows included (which copy comes first does not matter). Null
    text has no words and is taken 0 times; null sources are one source, the
    last. Ties in the shuffled order go by doc_id, then size. An empty table
    gives an empty result. Other columns of ``docs`` are not used.
    """
    sizes = durable(document_sizes(docs))
    targets = durable(source_targets(sizes, weights, share, most))
    slots = schedule(spark, targets, block_words)
    placed = streams(sizes, targets)
    end = F.col("start") + F.col("size") - 1
    block = F.explode_outer(F.when(F.col("size") > 0, F.sequence(
        F.floor(F.col("start") / block_words), F.floor(end / block_words))))
    pieces = (placed.withColumn("block", block)
              .withColumn("from", F.greatest(F.col("start") - F.col("block") * block_words, F.lit(0)))
              .withColumn("to", F.least(F.col("start") + F.col("size") - F.col("block") * block_words,
                                        F.lit(block_words))))
    taken = pieces.join(slots.select("place", "block", F.col("words").alias("cut")), ["place", "block"], "left")
    # A block without a slot gives nothing.
    part = F.greatest(F.least(F.col("to"), F.coalesce("cut", F.lit(0))) - F.col("from"), F.lit(0))
    return (taken.groupBy("place", "stretch", "row", "doc_id", "source", "size", "source_size", "target")
            .agg(F.sum(F.coalesce(part, F.lit(0))).cast("long").alias("taken"))
            .select("doc_id", "source", "size", "source_size", "target", "taken"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (mix_sources(spark, table(spark, sf_dir, "documents"))
            .select("doc_id", "size", "source_size", "target", "taken"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
           WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, 2 * source_size / weight AS ratio,
         sum(weight) OVER later AS open,
         1.5::DOUBLE * (SELECT sum(source_size) FROM s)
           - 2 * coalesce(sum(source_size) OVER earlier, 0) AS dealt
  FROM s
  WINDOW later AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING),
         earlier AS (ORDER BY 2 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT dealt, open FROM r WHERE dealt / open <= ratio ORDER BY ratio, source NULLS LAST LIMIT 1),
t AS (
  SELECT s.source, s.source_size,
         CASE WHEN s.weight * level.dealt / level.open > 2 * s.source_size THEN 2.0::DOUBLE * s.source_size
              ELSE s.weight * level.dealt / level.open END AS target
  FROM s, level),
p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         least(CAST(floor(t.target + 0.5) AS BIGINT), 2 * t.source_size) AS quota,
         coalesce(sum(d.size) OVER (PARTITION BY d.source
           ORDER BY md5(coalesce(CAST(d.doc_id AS VARCHAR), '')), d.doc_id, d.size
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(greatest(least(start + size, least(quota, source_size)) - start, 0)
          + greatest(least(start + size, greatest(quota - source_size, 0)) - start, 0) AS BIGINT) AS taken
FROM p
"""

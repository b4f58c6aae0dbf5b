"""Phrase collocations by marginalising the longest windows.

Every word opens one window: the word and its lead columns, the next three words
of its piece, padded where the piece ends. Only these windows are counted. A
shorter phrase starts a window wherever it occurs, so its frequency is the sum
over the windows that begin with it: ROLLUP over the counted windows gives all
frequencies, and no n-grams of other lengths are ever exploded.

No phrase is more frequent than its words, so a word below the threshold ends a
window as a piece's end does, and counted windows lose what is rarer before the
rollup. The words that reach the threshold are numbered and windows are
counted as numbers; where there are too many of them to send to all tasks, windows
are counted as words, with the same result.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwise.llm.common import durable, lower_ascii, table, words
from tabwise.session import scratch_path

LEAST, COVERED, TOP, SCALE = 30, 80, 2000, 2_000_000
#: At most so many words, and bytes of words, are numbered and sent to the tasks.
VOCABULARY_WORDS, VOCABULARY_BYTES = 1_000_000, 32 << 20  # numbers of 20 bits
UNKNOWN_LANG = "und"

_ENDS = rb".,;:!?" + b"\x0b\x0c\r"
_CLEAN = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_BLOCK = 1 << 20
_ROWS = 1 << 19
_W = ["w1", "w2", "w3", "w4"]
_SALT = 64
#: So many windows are counted together before the shuffle.
_WINDOWS = 1 << 21
#: Word numbers have 20 bits. A pair whose words occur k * _HOT times and more is dealt to k + 1
#: tasks; a triple whose words all do so is open: it may be in several of them.
_MOST, _SALT_BIT, _OPEN_BIT, _SALTS, _HOT = (1 << 20) - 1, 53, 62, 1 << 9, 1 << 14


def _tokens(text: bytes) -> Iterator[Iterator[bytes]]:
    """The words of a text and, as line feeds, the ends of its pieces, in blocks of about a megabyte."""
    text = text.lower().translate(_CLEAN).replace(b"\n", b" \n ")  # lower() of bytes: A-Z only
    at = 0
    while at < len(text):
        end = text.find(b" ", at + _BLOCK)
        end = len(text) if end < 0 else end
        yield filter(None, text[at:end].split(b" "))
        at = end


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = defaultdict(Counter)

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(b"\n", None)
            keys = list(found)
            for i in range(0, len(keys), _ROWS):
                part = keys[i:i + _ROWS]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(part), pa.string()), pa.array(part, pa.binary()).cast(pa.string()),
                     pa.array([found[k] for k in part], pa.int64())], ["lang", "word", "n"])
        counts.clear()

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            for block in _tokens(text.as_buffer().to_pybytes()):
                counts[lang].update(block)
            if sum(map(len, counts.values())) > _ROWS:
                yield from counted()
    yield from counted()


def _lead_windows(vocabulary: dict[str, dict[bytes, int]], counts: np.ndarray):
    """Windows of two words and more as two numbers, words 1 and 2 and words 3 and 4 (0 is padding), and their count."""
    def windows(parts: list[np.ndarray]) -> pa.RecordBatch:
        row = np.concatenate([*parts, np.zeros(3, np.int64)])
        a, b, c, d = row[:-3], row[1:-2], row[2:-1], row[3:]
        c = np.where(b > 0, c, 0)
        d = np.where(c > 0, d, 0)
        opens = (a > 0) & (b > 0)
        head, rest = (a << 32 | b)[opens], (c << 32 | d)[opens]
        # Pairs that may be hot are dealt out by their third word, triples by the fourth as well.
        rarest = np.minimum(counts[a[opens]], counts[b[opens]])
        share = np.minimum(rarest // _HOT, _SALTS - 2)
        open_ = np.minimum(rarest, counts[c[opens]]) >= _HOT
        mixed = np.where(open_, rest, rest >> 32).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)
        head |= np.where(share > 0, 1 + mixed.astype(np.int64) % (share + 1), 0) << _SALT_BIT
        head |= open_.astype(np.int64) << _OPEN_BIT
        order = np.lexsort((rest, head))
        head, rest = head[order], rest[order]
        first = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (rest[1:] != rest[:-1])])[:len(head)])
        n = np.diff(np.concatenate([first, [len(head)]]))
        return pa.RecordBatch.from_arrays([pa.array(head[first]), pa.array(rest[first]), pa.array(n)], ["head", "rest", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, none = [], 0, {}
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
                number = vocabulary.get(lang, none).get
                for block in _tokens(text.as_buffer().to_pybytes()):
                    parts.append(np.fromiter(map(number, block, repeat(0)), np.int64))
                    size += len(parts[-1])
                parts.append(np.zeros(1, np.int64))
                if size >= _WINDOWS:
                    yield windows(parts)
                    parts, size = [], 0
        if parts:
            yield windows(parts)

    return run


def _counted_by_number(rows: DataFrame, vocabulary: dict[str, dict[bytes, int]], counts: np.ndarray,
                       least: int) -> DataFrame:
    """w1..w4 (numbers, 0 behind the end), n: the windows, cut short where they are of no further use.

    No phrase is more frequent than what it begins with. The windows of a pair meet in
    one task (those of a pair that may be hot are dealt out, by triple at least), so
    the same shuffle that counts them tells which pairs, triples and windows reach
    ``least``. Rarer ones lose their last words, or go with their pair, before the rollup.
    """
    windows = rows.mapInArrow(_lead_windows(vocabulary, counts), "head long, rest long, n long")
    counted = windows.repartition("head").groupBy("head", "rest").agg(F.sum("n").alias("n"))
    third = F.shiftright("rest", 32)
    summed = (counted.withColumn("third", third)
              .withColumn("triple", F.sum("n").over(Window.partitionBy("head", "third")))
              .withColumn("pair", F.sum("n").over(Window.partitionBy("head"))))
    kept = summed.filter((F.col("pair") >= least) | (F.col("head") >= 1 << _SALT_BIT))
    cut = (F.when(F.col("n") >= least, F.col("rest"))
           .when((F.col("triple") >= least) | (F.col("head") >= 1 << _OPEN_BIT), F.shiftleft("third", 32)).otherwise(F.lit(0)))
    short = kept.select("head", cut.alias("rest"), "n").groupBy("head", "rest").agg(F.sum("n").alias("n"))

    def high(c: str) -> Column:
        return F.shiftright(c, 32).bitwiseAND(F.lit(_MOST)).cast("int")

    def low(c: str) -> Column:
        return F.col(c).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")

    return short.select(high("head").alias("w1"), low("head").alias("w2"), high("rest").alias("w3"),
                        low("rest").alias("w4"), "n")


def _counted_by_word(rows: DataFrame) -> DataFrame:
    """lang, w1..w4 (words, '' behind the end), n."""
    pieces = rows.select("lang", F.explode(F.split(lower_ascii(F.col("text")), r"[.,;:!?\x0A-\x0D]")).alias("piece"))
    found = pieces.select("lang", words(F.col("piece"), r"[\x20\x09]+").alias("w")).filter(F.size("w") > 0)
    leads = F.arrays_zip(*[F.slice("w", i + 1, F.size("w")).alias(w) for i, w in enumerate(_W)])
    return (found.select("lang", F.inline(leads)).fillna("", _W)
            .groupBy("lang", *_W).agg(F.count(F.lit(1)).alias("n")))


def _frequent(counted: DataFrame, keys: list[str], pad, least: int) -> DataFrame:
    """Phrases of up to four words with their frequency ``a``: the counted windows that begin with them, summed."""
    sums = counted.rollup(*keys, *_W).agg(
        F.sum("n").alias("a"), *[F.grouping(w).alias(f"no_{w}") for w in _W]).filter(F.col("a") >= least)
    # A prefix counts where its last word is one: not rolled away, and no padding.
    last = F.col("w1")
    for w in _W[1:]:
        last = F.when(F.col(f"no_{w}") == 0, F.col(w)).otherwise(last)
    return sums.filter((F.col("no_w1") == 0) & (last != pad)).select(
        *keys, *[F.coalesce(w, F.lit(pad)).alias(w) for w in _W], "a")


def _phrase(first: int, last: int, pad) -> list[Column]:
    """Words first..last of a row (from 1, last excluded) as the columns p1, p2, p3."""
    inside = [F.col(w) for w in _W[first - 1:last - 1]]
    return [(inside[i] if i < len(inside) else F.lit(pad)).alias(f"p{i + 1}") for i in range(3)]


def _score(candidates: DataFrame, phrases: DataFrame, keys: list[str], pad) -> DataFrame:
    """Candidates with l, r and score of their lowest-scoring cut, the first of equal ones."""
    own, part = [*keys, *_W, "a", "n_words"], ["p1", "p2", "p3"]
    cuts = [(k, side, size, _phrase(*((1, k + 1) if side == "l" else (k + 1, size + 1)), pad))
            for size in (2, 3, 4) for k in range(1, size) for side in "lr"]
    asked = candidates.select(*own, F.explode(F.filter(F.array(*[
        F.when(F.col("n_words") == size, F.struct(F.lit(k).alias("k"), F.lit(side).alias("side"), *columns))
        for k, side, size, columns in cuts]), lambda x: x.isNotNull())).alias("cut")).select(*own, "cut.*")
    known = phrases.filter(F.col("w4") == pad).select(
        *keys, *[F.col(w).alias(p) for w, p in zip(_W, part)], F.col("a").alias("found"))
    at = {(k, side): F.max(F.when((F.col("k") == k) & (F.col("side") == side), F.col("found")))
          for k in (1, 2, 3) for side in "lr"}
    cells = asked.join(known, [*keys, *part]).groupBy(*own).agg(*[c.alias(f"{side}{k}") for (k, side), c in at.items()])

    def exact(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    scored = F.array(*[F.when(F.col(f"l{k}").isNotNull(), F.struct(
        F.call_function("div", exact(F.lit(SCALE)) * exact(F.col("a")), exact(F.col(f"l{k}")) + exact(F.col(f"r{k}")))
        .cast("long").alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        for k in (1, 2, 3)])
    return cells.withColumn("cut", F.array_min(F.filter(scored, lambda x: x.isNotNull()))).select(
        *own, "cut.l", "cut.r", "cut.score")


def _uncovered(scored: DataFrame, candidates: DataFrame, keys: list[str], pad, covered: int) -> DataFrame:
    """Scored candidates that no longer candidate holds with ``covered`` percent of their frequency."""
    part = ["p1", "p2", "p3"]
    inside = [(size, _phrase(first, first + n, pad)) for size in (3, 4) for n in range(2, size)
              for first in range(1, size - n + 2)]
    held = candidates.select(*keys, F.col("a").alias("longer"), F.explode(F.filter(F.array(*[
        F.when(F.col("n_words") == size, F.struct(*columns)) for size, columns in inside]),
        lambda x: x.isNotNull())).alias("part")).select(*keys, "longer", "part.*")
    most = held.groupBy(*keys, *part).agg(F.max("longer").alias("longer")).select(
        *keys, *[F.col(p).alias(w) for p, w in zip(part, _W)], F.lit(pad).alias("w4"), "longer")
    exact = [F.col(c).cast("decimal(19,0)") * factor for c, factor in (("longer", 100), ("a", covered))]
    return scored.join(most, [*keys, *_W], "left").filter(F.col("longer").isNull() | (exact[0] < exact[1]))


def _spelled(langs: list[str], spelling: list[str]):
    """Numbers to lang and phrase."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = [batch[w].to_pylist() for w in _W]
            columns = [pa.array([langs[x] for x in ids[0]], pa.string()),
                       pa.array([" ".join(spelling[x] for x in row if x) for row in zip(*ids)], pa.string())]
            yield pa.RecordBatch.from_arrays([*columns, *(batch[c] for c in ("a", "l", "r", "score"))],
                                             ["lang", "phrase", "a", "l", "r", "score"])

    return run


def mine_collocations(docs: DataFrame, least: int = LEAST, covered: int = COVERED, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each lang's ``top`` phrases of 2 to 4 words.

    Frequencies are exact and count every occurrence, those of repeated rows too.
    A null lang is "und", a null text empty; texts of any length are read whole.
    Ties go by a, then by the phrase's bytes. Langs without candidates have no rows;
    an empty table gives an empty result. Other columns are ignored. ``least`` is 2
    or more.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce("lang", F.lit(UNKNOWN_LANG)).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    path = scratch_path(spark, "words")
    rows.mapInArrow(_count_words, "lang string, word string, n long").groupBy("lang", "word").agg(
        F.sum("n").alias("n")).write.parquet(path)
    counts = spark.read.parquet(path)
    totals = counts.groupBy("lang").agg(F.sum("n").alias("n"))
    known = counts.filter(F.col("n") >= least)
    size = known.agg(F.count(F.lit(1)).alias("words"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")).first()
    if size.words <= VOCABULARY_WORDS and size.bytes <= VOCABULARY_BYTES:
        listed = sorted(tuple(r) for r in known.select("lang", "word", "n").collect())
        numbers = defaultdict(dict)
        for i, (lang, word, _) in enumerate(listed):
            numbers[lang][word.encode()] = i + 1
        frequency = np.array([0, *(n for *_, n in listed)], np.int64)
        keys, pad, counted = [], 0, _counted_by_number(rows, dict(numbers), frequency, least)
        # Windows of rare pairs are gone, so single words keep the counts they have.
        single = spark.createDataFrame(pa.table({"w1": np.arange(1, len(frequency), dtype=np.int32), "a": frequency[1:]}))
        single = single.select("w1", *[F.lit(pad).alias(w) for w in _W[1:]], "a")
        phrases = _frequent(counted, keys, pad, least).filter(F.col("w2") != pad).unionByName(single)
    else:
        keys, pad = ["lang"], ""
        phrases = _frequent(_counted_by_word(rows), keys, pad, least)

    phrases = durable(phrases)
    n_words = reduce(lambda x, y: x + y, [(F.col(w) != pad).cast("int") for w in _W])
    candidates = phrases.withColumn("n_words", n_words).filter("n_words > 1")
    found = _uncovered(_score(candidates, phrases, keys, pad), candidates, keys, pad, covered)
    if keys:
        phrase = F.array_join(F.filter(F.array(*_W), lambda w: w != ""), " ")
        found = found.select("lang", phrase.alias("phrase"), "a", "l", "r", "score")
    else:
        langs, spelling = [""], [""]
        for lang, word, _ in listed:
            langs.append(lang)
            spelling.append(word)
        found = found.select(*_W, "a", "l", "r", "score").mapInArrow(
            _spelled(langs, spelling), "lang string, phrase string, a long, l long, r long, score long")
    # First within salted parts of a lang, so that no task sorts all of a large one.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = found.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(_SALT)))
    best = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    best = best.filter(F.col("rank") <= top).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return best.filter(F.col("rank") <= top).join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(table(spark, sf_dir, "documents").select("lang", "text"))


ORACLE = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM p),
f AS (
  SELECT lang, k, w[i:i + k - 1] AS ph, count(*) AS a FROM place, (VALUES (1), (2), (3), (4)) AS t(k)
  WHERE i + k - 1 <= len(w) GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k AS size, ph, a FROM f WHERE k > 1),
cut AS (SELECT *, unnest(range(1, size)) AS k FROM c),
scored AS (
  SELECT cut.lang, cut.ph, cut.a, cut.k, x.a AS l, y.a AS r,
         CAST((CAST(2000000 AS HUGEINT) * cut.a) // (x.a + y.a) AS BIGINT) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.ph = cut.ph[1:cut.k]
           JOIN f y ON y.lang = cut.lang AND y.ph = cut.ph[cut.k + 1:cut.size]),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY score, k) = 1),
held AS (
  SELECT c.lang, c.ph[i:i + m - 1] AS ph, max(c.a) AS longer
  FROM c, (VALUES (2), (3)) AS t(m), (VALUES (1), (2), (3)) AS u(i) WHERE m < size AND i + m - 1 <= size GROUP BY ALL),
left_over AS (
  SELECT lowest.* FROM lowest LEFT JOIN held ON held.lang = lowest.lang AND held.ph = lowest.ph
  WHERE held.longer IS NULL OR CAST(100 AS HUGEINT) * held.longer < CAST(80 AS HUGEINT) * lowest.a),
ranked AS (
  SELECT lang, array_to_string(ph, ' ') AS phrase, a, l, r, score,
         row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(ph, ' ')) AS rank FROM left_over)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

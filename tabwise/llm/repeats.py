"""Removing passages that repeat anywhere in the corpus, with Aho-Corasick automata.

A window is ``WINDOW`` consecutive words. It repeats if the same words also start
at another place of any document. Documents are dealt into blocks of a few MB by
a hash; a block is worked through by one task, and blocks talk to each other only
through small rows that Spark shuffles by hash:

1. Anchors. A window's anchor is the smallest hash among its runs of ``ANCHOR``
   words, so two equal windows have equal anchors. Blocks report the anchors of
   their windows; those that occur once in the corpus rule their windows out.
2. Confirmed passages. Blocks report the hashes of the windows whose anchor
   recurs; those counted twice or more repeat.
3. Automata. Each block cuts its repeating windows into passages (stretches of
   covered words), compiles them into its own automaton - the corpus's phrases
   are sharded by the blocks that hold them, so an automaton is bounded by its
   block - and streams its documents through it. What it locates is removed.

A block reports a hash once, whatever its number of copies, so a passage that
half of all documents share gives as many rows as there are blocks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwise.llm.common import table
from tabwise.llm.wordhash import AS_SPACE, WordHasher

WINDOW = 35
ANCHOR = 20
#: Bytes of text in a block, about; what a task holds is a small multiple of it.
BLOCK_BYTES = 4 << 20


def _slide(values: np.ndarray, width: int, pick: Callable) -> np.ndarray:
    """``pick`` (minimum or maximum) over each run of ``width`` values."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[: len(out) - step], out[step:])
        have += step
    return out


def _window_anchors(runs: np.ndarray, width: int) -> np.ndarray:
    return _slide(runs, width, np.minimum)


def _anchors(runs: np.ndarray, width: int) -> np.ndarray:
    """The anchor occurrences of a text: runs that are the smallest of some window, ties included."""
    least = _window_anchors(runs, width)
    edge = np.zeros(width - 1, np.uint64)
    return runs[_slide(np.concatenate([edge, least, edge]), width, np.maximum) == runs]


def _counted(hashes: list[np.ndarray], block: int) -> pd.DataFrame:
    values, n = np.unique(np.concatenate(hashes) if hashes else np.empty(0, np.uint64), return_counts=True)
    return pd.DataFrame({"hash": values.view(np.int64), "block": np.int64(block), "n": np.minimum(n, 2).astype(np.int32)})


def _known(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if len(known) == 0 or len(values) == 0:
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(known, values), len(known) - 1)
    return known[at] == values


def _sorted_hashes(pdf: pd.DataFrame) -> np.ndarray:
    return np.sort(pdf["hash"].to_numpy(np.int64).view(np.uint64))


def _report_anchors(window: int, anchor: int):
    width = window - anchor + 1

    def run(key: tuple, docs: pd.DataFrame) -> pd.DataFrame:
        hasher = WordHasher(AS_SPACE)
        return _counted([_anchors(hasher.runs(w, anchor), width) for w in hasher.words(docs["text"])
                         if len(w) >= window], key[0])

    return run


def _report_windows(window: int, anchor: int):
    width = window - anchor + 1

    def run(key: tuple, docs: pd.DataFrame, anchors: pd.DataFrame) -> pd.DataFrame:
        hasher, known = WordHasher(AS_SPACE), _sorted_hashes(anchors)
        return _counted([hasher.runs(w, window)[_known(_window_anchors(hasher.runs(w, anchor), width), known)]
                         for w in hasher.words(docs["text"]) if len(w) >= window], key[0] if key else 0)

    return run


def _covered(repeating: np.ndarray, window: int) -> Iterator[tuple[int, int]]:
    """Stretches of words (start, end) under the repeating windows."""
    starts = np.flatnonzero(repeating)
    if len(starts):
        new = np.flatnonzero(np.diff(starts) > window) + 1
        for part in np.split(starts, new):
            yield int(part[0]), int(part[-1]) + window


def _locate(window: int):
    def run(key: tuple, docs: pd.DataFrame, windows: pd.DataFrame) -> pd.DataFrame:
        hasher, known = WordHasher(AS_SPACE), _sorted_hashes(windows)
        automaton = ahocorasick.Automaton()
        texts = []
        for text, hashes in zip(docs["text"], hasher.words(docs["text"])):
            # One character per byte: places are bytes, and any text fits.
            words = [] if text is None else text.encode("utf-8", "replace").split()
            texts.append(words)
            for start, end in _covered(_known(hasher.runs(hashes, window), known), window):
                phrase = b" " + b" ".join(words[start:end]) + b" "
                automaton.add_word(phrase.decode("latin-1"), len(phrase))
        if len(automaton):
            automaton.make_automaton()
        rows = []
        for doc_id, words in zip(docs["doc_id"], texts):
            remove = np.zeros(len(words) + 1, np.int64)
            if len(automaton) and len(words) >= window:
                line = (b" " + b" ".join(words) + b" ").decode("latin-1")
                # The space before each word.
                at = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])
                # Passages never overlap within a text: the longest match is the passage.
                for last, length in automaton.iter_long(line):
                    first, end = np.searchsorted(at, [last - length + 1, last])
                    remove[first] += 1
                    remove[end] -= 1
            keep = np.cumsum(remove[:-1]) == 0
            kept = b" ".join([w for w, k in zip(words, keep) if k])
            rows.append((doc_id, len(words), int(len(words) - keep.sum()), kept.decode("utf-8", "replace")))
        out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_removed", "kept_text"])
        out["doc_id"] = out["doc_id"].astype("Int64")
        return out

    return run


def _recurring(counted: DataFrame) -> DataFrame:
    """(block, hash) of the hashes that occur twice or more in the corpus. A hash has a row per block at most."""
    total = F.sum("n").over(Window.partitionBy("hash"))
    return counted.withColumn("total", total).filter(F.col("total") > 1).select("block", "hash")


def remove_repeats(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR,
                   block_bytes: int = BLOCK_BYTES, digest: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (words joined by one space); one row per input row.

    Every copy of a repeating window is removed, the first one too. Words are
    parted by ASCII white space and compared as they are. Null and blank texts
    have no words; texts under ``window`` words lose none. Equal rows count as
    two places. Other columns of ``docs`` are not used; an empty table gives an
    empty result. ``digest`` gives kept_sha256 in place of the text.
    """
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = total // block_bytes + 1
    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                        F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).alias("block"))
    of_block = dealt.groupBy("block")
    schema = "hash long, block long, n int"
    anchors = _recurring(of_block.applyInPandas(_report_anchors(window, anchor), schema))
    windows = _recurring(of_block.cogroup(anchors.groupBy("block")).applyInPandas(
        _report_windows(window, anchor), schema))
    kept = of_block.cogroup(windows.groupBy("block")).applyInPandas(
        _locate(window), "doc_id long, n_words long, n_removed long, kept_text string")
    if digest:
        return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))
    return kept


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), digest=True)


ORACLE = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
w AS (
  SELECT row, s, count(*) OVER (PARTITION BY phrase) AS n
  FROM (SELECT row, s, array_to_string(words[s : s + 34], ' ') AS phrase
        FROM (SELECT row, words, unnest(range(1, len(words) - 33)) AS s FROM d WHERE len(words) >= 35))),
r AS (SELECT DISTINCT row, unnest(range(s, s + 35)) AS pos FROM w WHERE n > 1),
g AS (SELECT row, count(*) AS n, list(pos) AS gone FROM r GROUP BY row),
k AS (
  SELECT row, string_agg(word, ' ' ORDER BY pos) AS kept
  FROM (SELECT row, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM d)
  WHERE (row, pos) NOT IN (SELECT row, pos FROM r)
  GROUP BY row)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, coalesce(g.n, 0) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN g ON d.row = g.row LEFT JOIN k ON d.row = k.row
"""

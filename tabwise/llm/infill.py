"""Fill-in-the-middle: texts cut into prefix, middle and suffix at unit boundaries.

Every byte of a text has a class (continuation, word, space, line break). A
wavelet matrix over (class of the byte, class of the byte before) answers how
many symbols of any class pair lie before a position. A unit (character, word,
line) begins at certain class pairs, so the sum of a few ranks is the number of
units begun before a position, and bisection on that count finds the byte where
unit k begins. Texts stay UTF-8 bytes throughout; cuts never fall inside a
character.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabwise.llm.common import table

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN, PSM, SPM = "plain", "psm", "spm"

#: Classes of a byte, two bits: a continuation byte of UTF-8, any other, a space or tab, a line feed.
_CONTINUES, _WORD, _SPACE, _BREAK = range(4)
_CLASS = np.full(256, _WORD, np.uint8)
_CLASS[0x80:0xC0] = _CONTINUES
_CLASS[[0x20, 0x09]] = _SPACE
_CLASS[0x0A] = _BREAK
_DEPTH = 4
#: Where a unit begins: class pairs (byte, byte before) as beginnings of the symbol's
#: bits. A text begins after a line break; its first byte begins a unit in any case.
UNITS = {
    "character": ("01", "1"),
    "word": ("011",),
    "line": ("0111", "1011", "1111"),
}
#: Outputs are handed on in parts of about this many bytes.
_PART_BYTES = 8 << 20


class WaveletMatrix:
    """Ranks over a sequence of ``depth``-bit symbols: one bit vector a level, highest bit first."""

    def __init__(self, symbols: np.ndarray, depth: int):
        self.levels = []
        for shift in range(depth - 1, -1, -1):
            ones = (symbols >> shift & 1).astype(bool)
            packed = np.packbits(ones, bitorder="little")
            words = np.concatenate([packed, np.zeros(-len(packed) % 8 + 8, np.uint8)]).view("<u8")
            before = np.concatenate([[0], np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)])
            zeros = len(symbols) - int(before[-1])
            self.levels.append((words, before, zeros))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])

    def _ones(self, level: int, i: int) -> int:
        words, before, _ = self.levels[level]
        return int(before[i >> 6]) + (int(words[i >> 6]) & ((1 << (i & 63)) - 1)).bit_count()

    def _down(self, bits: str, i: int) -> int:
        for level, bit in enumerate(bits):
            ones = self._ones(level, i)
            i = self.levels[level][2] + ones if bit == "1" else i - ones
        return i

    def rank(self, bits: str, i: int) -> int:
        """How many of the first ``i`` symbols begin with ``bits``."""
        return self._down(bits, i) - self._down(bits, 0)


class Boundaries:
    """The unit boundaries of one UTF-8 text."""

    def __init__(self, text: bytes, unit: str):
        classes = _CLASS[np.frombuffer(text, np.uint8)]
        before = np.concatenate([[np.uint8(_BREAK)], np.maximum(classes[:-1], _WORD)])[:len(classes)]
        self.size = len(classes)
        self.matrix = WaveletMatrix(classes << 2 | before, _DEPTH)
        self.bits = UNITS[unit]
        # Without a boundary at the first byte the text's beginning is one more.
        self.first = int(self.size > 0 and not sum(self.matrix.rank(b, 1) for b in self.bits))
        self.count = self.begun(self.size)

    def begun(self, i: int) -> int:
        """Units that begin in the first ``i`` bytes."""
        return sum(self.matrix.rank(b, i) for b in self.bits) + (self.first if i else 0)

    def characters(self, i: int) -> int:
        return sum(self.matrix.rank(b, i) for b in UNITS["character"])

    def after(self, k: int) -> int:
        """The byte behind the first ``k`` units: the last position with no more than k begun before it."""
        low, high = k, self.size
        while low < high:
            middle = (low + high + 1) // 2
            if self.begun(middle) <= k:
                low = middle
            else:
                high = middle - 1
        return low


@dataclass(frozen=True)
class Plan:
    unit: str
    plain_from: int
    spm_below: int


def _cut(text: bytes, h: tuple[int, int, int, int], plan: Plan) -> tuple:
    """n, form, prefix and middle in code points, output."""
    found = Boundaries(text, plan.unit)
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    if not text or any(m in text for m in marks) or h[2] % 100 >= plan.plain_from:
        return found.count, PLAIN, None, None, text
    low, high = sorted((h[0] % (found.count + 1), h[1] % (found.count + 1)))
    a, b = found.after(low), found.after(high)
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    n_prefix = found.characters(a)
    spm = h[3] % 100 < plan.spm_below
    p, s, m = marks
    output = s + suffix + p + prefix + m + middle if spm else p + prefix + s + suffix + m + middle
    return found.count, SPM if spm else PSM, n_prefix, found.characters(b) - n_prefix, output


def _rearrange(plan: Plan, id_type: pa.DataType):
    names = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    types = [id_type, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, h = batch["text"], [batch[f"h{i}"].to_pylist() for i in range(1, 5)]
            start, size, rows = 0, 0, []
            for i in range(batch.num_rows):
                rows.append(_cut(texts[i].as_buffer().to_pybytes(), tuple(x[i] for x in h), plan))
                size += len(rows[-1][-1])
                if size >= _PART_BYTES or i == batch.num_rows - 1:
                    columns = [batch["doc_id"].slice(start, len(rows)).cast(id_type),
                               *(pa.array(c, t) for c, t in zip(zip(*rows), types[1:]))]
                    yield pa.RecordBatch.from_arrays(columns, names)
                    start, size, rows = i + 1, 0, []

    return run


def fill_in_middle(docs: DataFrame, unit: str = "character", plain_percent: int = 10, spm_percent: int = 20,
                   salt: str = "1:") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars (code points), output: one row per input row.

    The cuts and the form follow from the sha256 of ``salt`` and the id, so
    reruns and equal ids agree. Texts that are empty or hold one of the marks,
    and ``plain_percent`` of the others, stay plain (prefix and middle null);
    ``spm_percent`` of the rest put the suffix first. A null text is empty, a null
    id counts as an empty one. ``unit``: "character", "word" (with the white space
    behind it) or "line" (with its line feed); white space that begins a text is a
    unit of its own for words. Texts are cut whole whatever their length; other
    columns of ``docs`` are ignored. An empty table gives an empty result.
    """
    id_type = docs.schema["doc_id"].dataType
    digest = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    numbers = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *numbers)
    return rows.mapInArrow(
        _rearrange(Plan(unit, 100 - plain_percent, spm_percent), to_arrow_type(id_type)),
        f"doc_id {id_type.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(output: Column, form: Column) -> Column:
    """The text again, from an output and its form."""
    parts = F.split(output, "<[PSM]>")
    psm = F.concat(F.get(parts, 1), F.get(parts, 3), F.get(parts, 2))
    spm = F.concat(F.get(parts, 2), F.get(parts, 3), F.get(parts, 1))
    return F.when(form == PLAIN, output).when(form == PSM, psm).otherwise(spm)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fill_in_middle(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restore(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


ORACLE = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (
  SELECT doc_id, text, length(text) AS n, CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90
              THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (
  SELECT *, substring(text, 1, a) AS pre, substring(text, a + 1, b - a) AS mid, substring(text, b + 1, n - b) AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
              ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(CASE WHEN form = 'plain' THEN text ELSE pre || mid || suf END) AS restored_sha256
FROM p
"""

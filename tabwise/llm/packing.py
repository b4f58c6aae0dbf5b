"""Packing: token ids of documents laid into sequences of one fixed length.

A document's ids are cut into full sequences and a tail. Only the histogram of
tail lengths (as many rows as the sequence has tokens) goes to the driver.
There the lengths are placed longest first, each into the emptiest packs that
have room: a pattern of lengths with a count of packs, so a length held by a
billion documents is one step. Where long tails leave gaps that no short ones
fill, the emptiest packs are taken apart and their pieces, cut if need be, go in. A pattern says
which ranks of which length it takes; documents find their places by the rank of
their tail among those of equal length.
"""

from __future__ import annotations

import heapq
import re
import sys
import types
from array import array
from bisect import bisect_right, insort
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from tabwise.llm.common import table
from tabwise.session import scratch_path

CAPACITY = 2048
END_ID = 1
#: Gaps below this stay padding: no tail is cut into shorter pieces.
LEAST_PIECE = 32

# Tokenising

#: Chunks longer than this are not remembered, and of two generations each holds so many.
_CHUNK_BYTES, _GENERATION = 64, 300_000
_TEXT_BLOCK = 1 << 20
_SPACES = bytes.maketrans(b"\t\n\x0b\x0c\r", b"     ")
_MARKS = b".,;:!?"
#: Letters that stay single letters whatever stands beside them.
_LETTERS = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
_PART_BYTES = 8 << 20


def per_process(key: str, make: Callable):
    """One object per worker process and key: code that arrives by value has no globals that outlive a task."""
    kept = sys.modules.setdefault("tabwise_kept", types.ModuleType("tabwise_kept")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


class ChunkIds(dict):
    """Ids (as bytes) of the parts of a text between white space, worked out once each.

    Sound for a tokenizer that lower-cases, drops white space and splits at it and
    between a letter and the marks behind it. Two generations bound the memory:
    when the young one is full it becomes the old one, which is asked before the
    tokenizer is.
    """

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer, self.old = tokenizer, {}
        self.code = "H" if tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        # How the normalizer and the byte-level step spell a letter, asked once each.
        spell = lambda c: tokenizer.pre_tokenizer.pre_tokenize_str(tokenizer.normalizer.normalize_str(c))
        self.spelled = {i: "".join(part for part, _ in spell(chr(i))) for i in range(0x100) if _LETTERS.fullmatch(chr(i))}
        self.special = [t.content.encode() for t in tokenizer.get_added_tokens_decoder().values()]

    def __missing__(self, chunk: bytes) -> bytes:
        found = self.old.get(chunk)
        if found is None:
            found = self._encode(chunk)
        if len(chunk) <= _CHUNK_BYTES:
            if len(self) >= _GENERATION:
                self.old = dict(self)
                self.clear()
            self[chunk] = found
        return found

    def _encode(self, chunk: bytes) -> bytes:
        word = chunk.rstrip(_MARKS)
        letters = _LETTERS.fullmatch(text := word.decode("utf-8", "replace"))
        if letters and word != chunk:
            return self[word] + self[chunk[len(word):]]
        if letters:  # nothing for the splitter to do
            ids = [t.id for t in self.tokenizer.model.tokenize(text.translate(self.spelled))]
        else:
            ids = self.whole(chunk)
        return array(self.code, ids).tobytes()

    def whole(self, text: bytes) -> list[int]:
        return self.tokenizer.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids

    def of(self, text: bytes) -> bytes:
        """The ids of a text."""
        lower = text.lower()  # A-Z only
        if any(s in lower for s in self.special):  # such a token may stand inside a chunk, and cares for case
            return array(self.code, self.whole(text)).tobytes()
        lower, parts, at = lower.translate(_SPACES), [], 0
        while at < len(lower):
            end = lower.find(b" ", at + _TEXT_BLOCK)
            end = len(lower) if end < 0 else end
            parts.append(b"".join(map(self.__getitem__, filter(None, lower[at:end].split(b" ")))))
            at = end
        return b"".join(parts)


def _tokenize(vocabulary: str, capacity: int, end_id: int, id_type: pa.DataType):
    names = ["part", "doc_id", "doc_tokens", "tail", "tail_rank", "full", "full_rank", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = per_process(sha256(vocabulary.encode()).hexdigest(), lambda: ChunkIds(Tokenizer.from_str(vocabulary)))
        end, width = np.array([end_id], ids.dtype).tobytes(), ids.dtype.itemsize
        tails, fulls = defaultdict(int), 0
        for batch in batches:
            texts, start, size, rows = batch["text"], 0, 0, []
            for i in range(batch.num_rows):
                own = ids.of(texts[i].as_buffer().to_pybytes()) + end
                full, tail = divmod(len(own) // width, capacity)
                rows.append((len(own) // width, tail, tails[tail], full, fulls, own))
                tails[tail] += 1
                fulls += full
                size += len(own)
                if size >= _PART_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays(
                        [batch["part"].slice(start, len(rows)), batch["doc_id"].slice(start, len(rows)).cast(id_type),
                         *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names)
                    start, size, rows = i + 1, 0, []

    return run


# Planning

@dataclass
class Run:
    """``per_pack`` pieces of ``length`` in each of a group's packs, from tails of one length by rank."""

    tail: int
    rank: int
    per_pack: int
    start: int
    length: int


@dataclass
class Packs:
    """``count`` packs of one pattern with ``free`` tokens left in each."""

    count: int
    free: int
    runs: list[Run]

    def split(self, n: int) -> tuple[Packs, Packs]:
        """The first n packs and the others."""
        others = [Run(r.tail, r.rank + n * r.per_pack, r.per_pack, r.start, r.length) for r in self.runs]
        return Packs(n, self.free, list(self.runs)), Packs(self.count - n, self.free, others)

    def add(self, run: Run) -> Packs:
        return Packs(self.count, self.free - run.per_pack * run.length, [*self.runs, run])


def shortest_pack_first(items: list[tuple[Run, int]], capacity: int) -> list[Packs]:
    """Lengths longest first, each into the packs with most room; new packs only where none has room.

    ``items``: a run and how many pieces it has. A turn of a pattern brings its packs
    level with the next emptiest one, or uses half of what is free: so the number of
    patterns depends on the number of items and the capacity alone.
    """
    heap, order = [], 0

    def push(packs: Packs) -> None:
        nonlocal order
        order += 1
        heapq.heappush(heap, (-packs.free, order, packs))

    for run, left in sorted(items, key=lambda x: (-x[0].length, x[0].tail, x[0].rank)):
        length, rank = run.length, run.rank
        while left:
            if heap and -heap[0][0] >= length:
                packs = heapq.heappop(heap)[2]
                if packs.count > left:
                    packs, others = packs.split(left)
                    push(others)
                level = -heap[0][0] if heap else 0
                most = packs.free // length
                each = min(most, max(1, -(-(packs.free - level) // length), most // 2), left // packs.count)
            else:
                each = min(capacity // length, left)
                packs = Packs(left // each, capacity, [])
            push(packs.add(Run(run.tail, rank, each, run.start, length)))
            rank += each * packs.count
            left -= each * packs.count
    return [packs for _, _, packs in sorted(heap, key=lambda x: (x[0], x[1]))]


def fill_gaps(packs: list[Packs], capacity: int, least: int) -> list[Packs]:
    """The emptiest packs are taken apart, their pieces fill gaps of ``least`` tokens or more in the others.

    A piece that fits goes in whole, longest first; else the longest one is cut, never
    into parts shorter than ``least``. What finds no gap is packed anew.
    """
    def gap(p: Packs) -> int:
        return p.free if p.free >= least else 0

    excess = sum(p.count for p in packs) - -(-sum(p.count * (capacity - gap(p)) for p in packs) // capacity)
    kept, loose, lengths = [], defaultdict(list), []

    def free(run: Run, n: int) -> None:
        if n:
            if not loose[run.length]:
                insort(lengths, run.length)
            loose[run.length].append((run, n))

    for p in sorted(packs, key=lambda p: -p.free):
        if excess:
            taken, p = p.split(min(excess, p.count))
            excess -= taken.count
            for r in taken.runs:
                free(Run(r.tail, r.rank, 1, r.start, r.length), taken.count * r.per_pack)
        if p.count:
            kept.append(p)
    done = []
    while kept:
        p = kept.pop()  # the fullest
        at = bisect_right(lengths, p.free) if gap(p) else 0
        whole = at > 0
        if not gap(p) or not (whole or lengths and lengths[-1] >= 2 * least):
            done.append(p)
            continue
        length = lengths[at - 1] if whole else lengths[-1]
        run, n = loose[length].pop()
        if not loose[length]:
            lengths.remove(length)
        if n < p.count:
            p, others = p.split(n)
            kept.append(others)
        piece = length if whole else min(p.free, length - least)
        each = min(p.free // length, n // p.count) if whole else 1
        used = each * p.count
        free(Run(run.tail, run.rank + used, 1, run.start, length), n - used)
        if not whole:
            free(Run(run.tail, run.rank, 1, run.start + piece, length - piece), used)
        kept.append(p.add(Run(run.tail, run.rank, each, run.start, piece)))
    return done + shortest_pack_first([x for found in loose.values() for x in found], capacity)


def plan(histogram: dict[int, int], capacity: int) -> tuple[dict[int, list[tuple]], int]:
    """Per tail length the runs (rank, ranks, per pack, start, length, first sequence, offset), and the number of sequences."""
    runs, sequence = defaultdict(list), 0
    items = [(Run(tail, 0, 1, 0, tail), n) for tail, n in histogram.items()]
    for p in fill_gaps(shortest_pack_first(items, capacity), capacity, LEAST_PIECE):
        offset = 0
        for r in p.runs:
            runs[r.tail].append((r.rank, r.per_pack * p.count, r.per_pack, r.start, r.length, sequence, offset))
            offset += r.per_pack * r.length
        sequence += p.count
    return {tail: sorted(found, key=lambda x: (x[3], x[0])) for tail, found in runs.items()}, sequence


# Joining patterns back

def _pieces(runs: dict[int, list[tuple]], first_full: int, capacity: int, dtype: np.dtype, id_type: pa.DataType):
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, rows, at = 0, [], []
            cells = zip(*(batch[c].to_pylist() for c in ("doc_tokens", "tail", "rank", "full", "full_from")))
            for i, (tokens, tail, rank, full, full_from) in enumerate(cells):
                own = np.frombuffer(batch["ids"][i].as_buffer(), dtype).astype("<u4")
                places = [(k * capacity, capacity, first_full + full_from + k, 0) for k in range(full)]
                for first, n, each, start, length, sequence, offset in runs.get(tail, ()):
                    if first <= rank < first + n:
                        pack, k = divmod(rank - first, each)
                        places.append((full * capacity + start, length, sequence + pack, offset + k * length))
                for start, length, sequence, offset in places:
                    rows.append((start, length, own[start:start + length].tobytes(), tokens, sequence, offset))
                    at.append(i)
                size += 4 * tokens
                if size >= _PART_BYTES or i == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([batch["doc_id"].take(pa.array(at, pa.int64())).cast(id_type),
                                                      *(pa.array(c, t) for c, t in zip(zip(*rows), kinds))], names)
                    size, rows, at = 0, [], []

    return run


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, start, length, ids, doc_tokens, sequence_id, offset: one row per piece of a document.

    ``ids`` are little-endian unsigned 32-bit numbers; those of a document end with
    ``end_id`` and are cut into pieces, each token in exactly one. Sequences are
    numbered from 0, and a sequence's pieces lie gapless from offset 0; full sequences
    have no padding, and gaps of LEAST_PIECE tokens or more are filled by cuts. ``tokenizer`` is the path of a
    tokenizer file that lower-cases, drops white space and splits at it (read on the
    driver, sent as text). Null and empty texts are the end id alone; repeated rows
    and equal ids are packed row by row; other columns are ignored. A text and its
    ids have to fit into a value. An empty table gives an empty result.
    """
    spark, vocabulary = docs.sparkSession, Path(tokenizer).read_text(encoding="utf-8")
    id_type, id_name = to_arrow_type(docs.schema["doc_id"].dataType), docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.spark_partition_id().alias("part"), "doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    # Written once: which task counted which document, and the ids, must not change any more.
    path = scratch_path(spark, "tokens")
    rows.mapInArrow(_tokenize(vocabulary, capacity, end_id, id_type),
                    f"part int, doc_id {id_name}, doc_tokens long, tail int, tail_rank long, full long, full_rank long, "
                    "ids binary").write.option("compression", "zstd").parquet(path)
    tokens = spark.read.parquet(path)
    # A row per task and length, and a row per task: the ranks of earlier tasks come before.
    counts = tokens.groupBy("part", "tail").agg(F.count(F.lit(1)).alias("n"), F.sum("full").alias("n_full"))
    so_far = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "tail", F.coalesce(F.sum("n").over(
        Window.partitionBy("tail").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    full_before = counts.groupBy("part").agg(F.sum("n_full").alias("n_full")).select(
        "part", F.coalesce(F.sum("n_full").over(so_far), F.lit(0)).alias("full_before"))
    histogram = {r.tail: r.n for r in counts.groupBy("tail").agg(F.sum("n").alias("n")).collect() if r.tail}
    runs, sequences = plan(histogram, capacity)
    ranked = tokens.join(before, ["part", "tail"]).join(full_before, "part").select(
        "doc_id", "doc_tokens", "tail", (F.col("before") + F.col("tail_rank")).alias("rank"), "full",
        (F.col("full_before") + F.col("full_rank")).alias("full_from"), "ids")
    dtype = ChunkIds(Tokenizer.from_str(vocabulary)).dtype
    return ranked.mapInArrow(_pieces(runs, sequences, capacity, dtype, id_type),
                             f"doc_id {id_name}, start long, length long, ids binary, doc_tokens long, sequence_id long, "
                             "offset long")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")

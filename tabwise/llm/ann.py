"""Nearest neighbours with randomly rotated one-bit codes and exact reranking.

A unit vector is rotated at random (signs and Hadamard steps, fixed seed) and kept
as the signs of its components, one bit each, plus a correction scalar: the inner
product of the vector with its own code. The inner product with a query is
estimated from the bits and that scalar, with an error bound that also follows
from the scalar. A candidate whose estimate, with the bound taken twice, stays below the exact score
of the k-th best so far can't be among the k nearest. Where that leaves many, inner
products in single precision, whose error is certain, leave few; all others are
scored exactly, in double precision, on the original vectors.

Vectors are kept in blocks, queries too. A task takes some blocks and some query
parts from two checkpoints (nothing is copied per meeting), goes through the blocks
one by one and gives k neighbours per query at most.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabwise.llm.common import durable, table

BLOCK_VECTORS = 8192
BLOCK_QUERIES = 4096
#: Query parts that a task holds; stretches of the index that they meet, at least and over all tasks.
PARTS_HELD = 4
LANES = 64
MEETINGS = 1024
#: Width of the error bound, in standard errors of the estimate.
BOUND = 3.0
_SEED = 20
_STEPS = 3
#: Queries taken at once, and components rescored at once.
_TILE = 128
_RESCORED = 1 << 20
#: Single precision is asked where the codes leave more than one pair in so many.
_SPARSE = 64


def rotate(vectors: np.ndarray) -> np.ndarray:
    """Random rotation of the rows, padded with zeros to a power of two."""
    n, d = vectors.shape
    size = 1 << max(0, d - 1).bit_length()
    out = np.zeros((n, size))
    out[:, :d] = vectors
    rng = np.random.default_rng(_SEED + size)
    for _ in range(_STEPS):
        out *= rng.choice([-1.0, 1.0], size)
        half = 1
        while half < size:
            pairs = out.reshape(n, size // (2 * half), 2, half)
            out = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], 2).reshape(n, size)
            half *= 2
        out /= np.sqrt(size)
    return out


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed sign bits, and the correction scalars (inner product of vector and code)."""
    turned = rotate(units)
    bits = turned > 0
    return np.packbits(bits, axis=1), np.abs(turned).sum(1) / np.sqrt(turned.shape[1])


def _scaled(codes: np.ndarray, corrections: np.ndarray, size: int, bound: float) -> tuple[np.ndarray, np.ndarray]:
    """Codes whose inner products with turned queries are the estimates, and the error bound per vector."""
    signs = np.unpackbits(codes, axis=1, count=size).astype(np.float32) * 2 - 1
    scale = (1 / (np.sqrt(size) * corrections)).astype(np.float32)
    error = bound * np.sqrt(np.maximum(0, 1 - corrections**2)) / corrections / np.sqrt(max(1, size - 1))
    return signs * scale[:, None], error + 1e-5  # single precision


def estimate(codes: np.ndarray, corrections: np.ndarray, queries: np.ndarray,
             bound: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """(queries x vectors) estimated inner products of unit vectors, and the error bound per vector."""
    turned = rotate(queries).astype(np.float32)
    scaled, error = _scaled(codes, corrections, turned.shape[1], bound)
    return turned @ scaled.T, error


def _units(vectors: np.ndarray) -> np.ndarray:
    # Scaled first: squares of very large or small components would leave the range.
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def valid(embedding: Column) -> Column:
    """Neither null, empty nor zero; no null, NaN or infinite component."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _pack(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist())


def _unpack(packed: bytes, n: int, dim: int) -> np.ndarray:
    return np.frombuffer(packed, f"f{len(packed) // (n * dim)}").reshape(n, dim)


def _index_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    vectors = _pack(pdf["vector"])
    codes, corrections = encode(_units(vectors.astype(np.float64)))
    return pd.DataFrame({"dim": [key[0]], "block": [key[1]], "ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "codes": [codes.tobytes()], "corrections": [corrections.tobytes()],
                         "vectors": [vectors.tobytes()]})


def _query_block(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
    return pd.DataFrame({"dim": [key[0]], "part": [key[1]], "query_ids": [pdf["vec_id"].to_numpy(np.int64).tobytes()],
                         "queries": [_pack(pdf["vector"]).tobytes()]})


def _usable(vectors: DataFrame) -> DataFrame:
    """Valid rows as vec_id, vector (floats as they are, else doubles), dim."""
    kind = vectors.select("embedding").dtypes[0][1]
    return (vectors.filter(F.col("vec_id").isNotNull() & valid(F.col("embedding")))
            .select(F.col("vec_id").cast("long").alias("vec_id"),
                    F.col("embedding").cast(kind if kind == "array<float>" else "array<double>").alias("vector"))
            .withColumn("dim", F.size("vector")))


def _dealt(vectors: DataFrame, name: str, size: int) -> tuple[DataFrame, int]:
    """Usable rows, equal ones once, dealt to parts of about ``size`` rows; how many parts."""
    usable = _usable(vectors)
    # Counted by hash, so that the vectors are shuffled once less.
    parts = usable.select("vec_id", F.xxhash64("vector")).distinct().count() // size + 1
    return usable.dropDuplicates().withColumn(name, F.pmod(F.xxhash64("vec_id"), F.lit(parts))), parts


def build_index(vectors: DataFrame, block: int = BLOCK_VECTORS) -> DataFrame:
    """One row per block of about ``block`` vectors: ids (sorted), packed codes, correction scalars, vectors."""
    return _dealt(vectors, "block", block)[0].groupBy("dim", "block").applyInPandas(
        _index_block, "dim int, block long, ids binary, codes binary, corrections binary, vectors binary")


class _Block:
    def __init__(self, row, bound: float):
        self.ids = np.frombuffer(row.ids, np.int64)
        self.vectors = _unpack(row.vectors, len(self.ids), row.dim)
        doubles = self.vectors.astype(np.float64)
        self.norms = np.sqrt((doubles * doubles).sum(1))
        self.units = _units(doubles).astype(np.float32).T
        codes = np.frombuffer(row.codes, np.uint8).reshape(len(self.ids), -1)
        scaled, error = _scaled(codes, np.frombuffer(row.corrections, np.float64),
                                1 << max(0, row.dim - 1).bit_length(), bound)
        # Inner products with turned queries that end in 1 are the estimates plus twice the bound.
        self.uppers = np.column_stack([scaled, 2 * error.astype(np.float32)]).T
        #: Single-precision inner products of unit vectors are off by less.
        self.slack = (row.dim + 8) * 2.0**-23


class _Part:
    def __init__(self, row, k: int):
        self.ids = np.frombuffer(row.query_ids, np.int64)
        self.vectors = _unpack(row.queries, len(self.ids), row.dim).astype(np.float64)
        self.norms = np.array([np.sqrt((query * query).sum()) for query in self.vectors])
        units = _units(self.vectors)
        self.units = units.astype(np.float32)
        self.turned = np.column_stack([rotate(units), np.ones(len(units))]).astype(np.float32)
        self.k, self.best = k, np.zeros((len(self.ids), k), np.int64)
        self.scores = np.full((len(self.ids), k), -np.inf)

    def meet(self, block: _Block) -> None:
        for start in range(0, len(self.ids), _TILE):
            rows, columns = np.divmod(self._chosen(block, slice(start, start + _TILE)), len(block.ids))
            rows += start
            other = block.ids[columns] != self.ids[rows]
            rows, columns = rows[other], columns[other]
            if len(rows):
                self._keep(rows, block.ids[columns], self._rescored(block, rows, columns))

    def _chosen(self, block: _Block, tile: slice) -> np.ndarray:
        """Places in (queries of the tile x vectors) that may be among the k best."""
        n, own = len(block.ids), self.ids[tile]
        floor = self.scores[tile, -1].copy()
        floor[np.isnan(floor)] = -np.inf
        uppers = self.turned[tile] @ block.uppers
        open_ = np.flatnonzero(floor == -np.inf)

        def over(values: np.ndarray) -> np.ndarray:
            return values >= np.maximum(floor - block.slack, -2)[:, None].astype(np.float32)

        near = None
        if len(open_) and n > self.k:
            near = self._near(block, tile, own)
            floor[open_] = np.partition(near[open_], n - self.k, axis=1)[:, n - self.k] - block.slack
        kept = uppers >= floor[:, None].astype(np.float32)
        if near is None and np.count_nonzero(kept) * _SPARSE > kept.size:
            near = self._near(block, tile, own)
        if near is not None:
            kept &= over(near)
        return np.flatnonzero(kept)

    def _near(self, block: _Block, tile: slice, own: np.ndarray) -> np.ndarray:
        near = self.units[tile] @ block.units
        first, end = np.searchsorted(block.ids, own, "left"), np.searchsorted(block.ids, own, "right")
        for i in np.flatnonzero(end > first):
            near[i, first[i]:end[i]] = -np.inf
        return near

    def _rescored(self, block: _Block, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        # Row by row, so that equal vectors have equal scores wherever they stand.
        step = max(1, _RESCORED // self.vectors.shape[1])
        return np.concatenate([
            (block.vectors[c].astype(np.float64) * self.vectors[r]).sum(1) / (block.norms[c] * self.norms[r])
            for r, c in ((rows[i:i + step], columns[i:i + step]) for i in range(0, len(rows), step))])

    def _keep(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """The k best of a block beside those of the blocks before; equal scores of one id once."""
        rows, ids, scores = self._first(rows, ids, scores)
        some = np.unique(rows)
        held = self.scores[some] != -np.inf
        rows, ids, scores = self._first(
            np.concatenate([np.repeat(some, held.sum(1)), rows]), np.concatenate([self.best[some][held], ids]),
            np.concatenate([self.scores[some][held], scores]), once=True)
        self.scores[some] = -np.inf
        at = np.arange(len(rows)) - np.searchsorted(rows, rows)
        self.best[rows, at], self.scores[rows, at] = ids, scores

    def _first(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, once: bool = False) -> tuple:
        order = np.lexsort((ids, -scores, rows))
        rows, ids, scores = rows[order], ids[order], scores[order]
        if once:
            new = np.ones(len(rows), bool)
            new[1:] = (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])
            rows, ids, scores = rows[new], ids[new], scores[new]
        first = np.arange(len(rows)) - np.searchsorted(rows, rows) < self.k
        return rows[first], ids[first], scores[first]

    def hits(self) -> pd.DataFrame:
        rows, columns = np.nonzero(self.scores != -np.inf)
        return pd.DataFrame({"query_id": self.ids[rows], "vec_id": self.best[rows, columns],
                             "score": self.scores[rows, columns]})


def _search(k: int, bound: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: dict = {}
        block, at = None, None
        for pdf in batches:
            for row in pdf.itertuples():
                if at != (row.dim, row.block):
                    block, at = _Block(row, bound), (row.dim, row.block)
                if (row.dim, row.part) not in parts:
                    parts[row.dim, row.part] = _Part(row, k)
                parts[row.dim, row.part].meet(block)
        for part in parts.values():
            yield part.hits()

    return run


def nearest(index: DataFrame, queries: DataFrame, k: int = 5, bound: float = BOUND,
            block: int = BLOCK_QUERIES) -> DataFrame:
    """query_id, rank (from 1), vec_id, score (cosine): the k nearest of each query, itself left out.

    All candidates where there are fewer than k. Ties go to the smaller vec_id.
    Null ids, and vectors that are null, empty, zero or hold a null or non-finite
    component take no part, as queries or candidates; vectors are compared with
    those of their own length. Rows with a query's id are its own; equal rows
    count once. Empty tables give an empty result.

    The index is read once for each ``PARTS_HELD`` parts of queries: hand in a durable one.
    """
    dealt, count = _dealt(queries, "part", block)
    groups = count // PARTS_HELD + 1
    parts = durable(dealt.groupBy("dim", "part").applyInPandas(
        _query_block, "dim int, part long, query_ids binary, queries binary").repartition(groups))
    # Every part meets every block; a task streams the blocks past its parts.
    meets = index.coalesce(max(LANES, MEETINGS // groups)).join(parts.hint("shuffle_replicate_nl"), "dim")
    hits = meets.mapInPandas(_search(k, bound), "query_id long, vec_id long, score double").dropDuplicates(
        ["query_id", "vec_id", "score"])
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index = durable(build_index(vectors))
    return nearest(index, vectors.filter(F.col("vec_id") % 50 == 0))

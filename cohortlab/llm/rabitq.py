"""Nearest neighbours by randomly rotated one-bit codes (operator 7).

Every vector is normalised, padded with zeros, rotated by one seeded random
rotation and stored as the signs of its coordinates, packed, with one correction
scalar: the inner product of the vector and its code. (Padding to more
coordinates buys more bits, whose error falls with the square root of their number.) A rotated
query is quantised to a few bit planes, and its inner product with a vector is estimated
from counts of set bits of plane AND code and that scalar, with an error bound that holds with high
probability; only vectors whose upper bound reaches the k-th best score so far
are compared exactly.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from cohortlab.llm.tables import written
from cohortlab.session import scratch_path

SEED = 7
EPSILON = 4.0             #: standard errors of the bound; the estimate leaves it about once in 10^4
CODE_BITS = 256           #: coordinates after padding, at least
PLANES = 2                #: bits a rotated coordinate of a query is quantised to
STEP = 0.9957             #: step of the best uniform quantiser of a normal variable to 4 levels
TILE = 16                 #: queries whose bits are counted at a time
FIRST = 5                 #: times k: the codes whose vectors give a query its first k-th best score
SLACK = 1e-9              #: more than the rounding of a product of unit vectors
RERANK = 1 << 11          #: pairs compared exactly at a time
QUERY_BLOCK = 4096        #: queries that one pass over the vectors holds


@lru_cache(maxsize=4)
def rotation(dims: int, seed: int = SEED) -> np.ndarray:
    """The first `dims` rows of a random orthogonal matrix of `CODE_BITS` or more
    columns, whole words: padding with zeros and rotating, in one. The same wherever it is made."""
    bits = max(CODE_BITS, -(-dims // 64) * 64)
    q, r = np.linalg.qr(np.random.default_rng([seed, bits]).standard_normal((bits, bits)))
    return (q * np.sign(np.diag(r)))[:dims]


def _valid(vectors: list) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """Row numbers and matrix per dimension of the vectors that take part."""
    by_dim: dict[int, list] = {}
    for i, v in enumerate(vectors):
        if v is None or not len(v):
            continue
        by_dim.setdefault(len(v), []).append(i)
    rows, data = {}, {}
    for d, own in by_dim.items():
        x = np.array([[np.nan if c is None else c for c in vectors[i]] for i in own], np.float64)
        good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
        if good.any():
            rows[d], data[d] = np.array(own)[good], x[good]
    return rows, data


def _matrix(column) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
    """As `_valid`, without a Python object per number where all rows are whole."""
    if column.null_count == 0 and len(column):
        flat, ends = column.flatten(), np.diff(np.asarray(column.offsets))
        if flat.null_count == 0 and ends[0] and (ends == ends[0]).all():
            x = flat.to_numpy().astype(np.float64).reshape(len(column), ends[0])
            good = np.isfinite(x).all(axis=1) & (x != 0).any(axis=1)
            return ({ends[0]: np.flatnonzero(good)}, {ends[0]: x[good]}) if good.any() else ({}, {})
    return _valid(column.to_pylist())


def encode(x: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed signs, correction scalars) of the rows of `x`."""
    o = _unit(x) @ turn
    return np.packbits(o > 0, axis=1), np.abs(o).sum(axis=1) / math.sqrt(o.shape[1])


INDEX = "code binary, correction double"


def build_index(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", seed: int = SEED) -> DataFrame:
    """(key, vector, `code`, `correction`) of every row whose vector takes part:
    null, empty and zero vectors and those with null or non-finite components
    have no code. One pass without a shuffle; no sample is fitted."""
    kinds = [vectors.schema[c].dataType.simpleString() for c in (key, column)]

    def run(batches):
        for b in batches:
            rows, data = _matrix(b.column(1))
            for d, x in data.items():
                code, correction = encode(x, rotation(d, seed))
                kept = b.take(pa.array(rows[d]))
                yield pa.RecordBatch.from_arrays(
                    [kept.column(0), kept.column(1), pa.array([c.tobytes() for c in code], pa.binary()),
                     pa.array(correction)], names=[key, column, "code", "correction"])

    return vectors.select(key, column).mapInArrow(run, f"`{key}` {kinds[0]}, `{column}` {kinds[1]}, {INDEX}")


def _sums(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows, added up one component after the other: equal
    vectors give equal bits wherever they stand."""
    total = np.zeros(len(x))
    for j in range(x.shape[1]):
        total += x[:, j] * y[:, j]
    return total


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    value = _sums(x, y) / np.sqrt(_sums(x, x) * _sums(y, y))
    odd = ~np.isfinite(value)
    if odd.any():  # squares out of range: scale first
        a = x[odd] / np.abs(x[odd]).max(axis=1, keepdims=True)
        b = y[odd] / np.abs(y[odd]).max(axis=1, keepdims=True)
        value[odd] = _sums(a, b) / np.sqrt(_sums(a, a) * _sums(b, b))
    return np.clip(value, -1.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; the largest component first, so that squares neither overflow nor vanish."""
    unit = x / np.abs(x).max(axis=1, keepdims=True)
    return unit / np.sqrt((unit * unit).sum(axis=1, keepdims=True))


class QueryCodes:
    """Rotated queries of length 1 in `PLANES` bits a coordinate, as packed bit planes.

    A query's inner product with a code is then a sum of set bits of `plane AND code`.
    The quantised query is scaled to have inner product 1 with the query itself, so what is
    left over is at right angles to it and adds to the estimate's spread, but no bias.
    """

    def __init__(self, rotated: np.ndarray):
        self.bits = rotated.shape[1]
        levels = 1 << PLANES
        step = STEP / math.sqrt(self.bits)
        n = np.clip(np.floor(rotated / step) + levels // 2, 0, levels - 1).astype(np.uint8)
        value = (n - (levels - 1) / 2) * step
        scale = 1 / (rotated * value).sum(axis=1)
        left = rotated - value * scale[:, None]
        self.residual = float(np.sqrt((left * left).sum(axis=1).max(initial=0.0)))
        self.planes = [np.packbits(n >> p & 1, axis=1).view(np.uint64) for p in range(PLANES)]
        self.factor = (scale * step / math.sqrt(self.bits)).astype(np.float32)
        self.offset = (n.sum(axis=1, dtype=np.int64) - (levels - 1) / 2 * self.bits).astype(np.float32)

    def spread(self, correction: np.ndarray, epsilon: float) -> np.ndarray:
        """`epsilon` standard errors of the estimates against codes with these correction scalars."""
        variance = np.maximum(1 / correction ** 2 - 1, 0) + (self.residual / correction) ** 2
        return (epsilon * np.sqrt(variance / (self.bits - 1))).astype(np.float32)

    def estimate(self, own: slice, words: np.ndarray, correction: np.ndarray) -> np.ndarray:
        """Inner products of the queries `own` with codes, given as a row of packed words per word position."""
        set_bits = np.bitwise_count(words).sum(axis=0, dtype=np.int64)
        base = (((1 << PLANES) - 1) * set_bits).astype(np.float32)
        inverse = (1 / correction).astype(np.float32)
        first, last, _ = own.indices(len(self.factor))
        out = np.empty((last - first, words.shape[1]), np.float32)
        both, ones = np.empty((TILE, words.shape[1]), np.uint64), np.empty((TILE, words.shape[1]), np.uint8)
        for at in range(first, last, TILE):
            n = min(TILE, last - at)
            total = np.zeros((n, words.shape[1]), np.uint16 if self.bits << PLANES < 1 << 16 else np.uint32)
            for plane in reversed(self.planes):
                total <<= 1
                for w, word in enumerate(words):
                    np.bitwise_and(plane[at:at + n, w, None], word, out=both[:n])
                    np.bitwise_count(both[:n], out=ones[:n])
                    total += ones[:n]
            part = out[at - first:at - first + n]
            np.multiply(total, np.float32(2), out=part, casting="unsafe")
            part -= base
            part -= self.offset[at:at + n, None]
            part *= self.factor[at:at + n, None]
            part *= inverse
        return out


class _Queries:
    """One block of queries of one dimension, and their best so far in a task."""

    def __init__(self, ids: np.ndarray, x: np.ndarray, k: int, seed: int):
        self.ids, self.x, self.k = ids, x, k
        self.unit = _unit(x)
        self.codes = QueryCodes(self.unit @ rotation(x.shape[1], seed))
        self.best: list[list[tuple[float, int]]] = [[] for _ in ids]
        self.floor = np.full(len(ids), -np.inf)

    def _first_floor(self, new: np.ndarray, estimate: np.ndarray, ids: np.ndarray, unit: np.ndarray) -> np.ndarray:
        """A k-th best score for queries without one, from the codes that look nearest."""
        near = np.argpartition(-estimate, FIRST * self.k, axis=1)[:, :FIRST * self.k]
        score = np.einsum("ij,ikj->ik", self.unit[new], unit[near])
        score[ids[near] == self.ids[new, None]] = -np.inf
        return np.partition(score, -self.k, axis=1)[:, -self.k] - SLACK

    def offer(self, ids: np.ndarray, x: np.ndarray, code: np.ndarray, correction: np.ndarray, epsilon: float) -> None:
        words = np.ascontiguousarray(code.view(np.uint64).T)
        unit = _unit(x)
        spread = self.codes.spread(correction, epsilon)
        plain = len(np.unique(ids)) == len(ids)  # else one id could fill the k places
        for start in range(0, len(self.ids), 256):
            own = slice(start, start + 256)
            estimate = self.codes.estimate(own, words, correction)
            need = self.floor[own].copy()
            new = np.flatnonzero(np.isneginf(need))
            if len(new) and plain and len(ids) > FIRST * self.k:
                for at in np.array_split(new, -(-len(new) // 16)):
                    need[at] = self._first_floor(at + start, estimate[at], ids, unit)
            estimate += spread
            q, c = np.nonzero(estimate >= (need - 1e-5).astype(np.float32)[:, None])
            floor = need[q] - SLACK
            q += start
            other = self.ids[q] != ids[c]
            near = np.concatenate([np.einsum("ij,ij->i", self.unit[q[i:i + RERANK]], unit[c[i:i + RERANK]])
                                   for i in range(0, len(q), RERANK)] or [np.zeros(0)])
            hit = other & (near >= floor)
            q, c = q[hit], c[hit]
            score = np.concatenate([cosine(self.x[q[i:i + RERANK]], x[c[i:i + RERANK]])
                                    for i in range(0, len(q), RERANK)] or [np.zeros(0)])
            for at in np.split(np.arange(len(q)), np.flatnonzero(np.diff(q)) + 1) if len(q) else []:
                i = q[at[0]]
                keep = at[score[at] >= self.floor[i]]
                order = keep[np.lexsort((ids[c[keep]], -score[keep]))]
                merged = {v: s for s, v in self.best[i]}
                taken = 0
                for j in order:
                    v = int(ids[c[j]])
                    if v not in merged:
                        taken += 1
                    merged[v] = max(merged.get(v, -2.0), float(score[j]))
                    if taken >= self.k:
                        break
                self.best[i] = sorted(((s, v) for v, s in merged.items()), key=lambda p: (-p[0], p[1]))[:self.k]
                if len(self.best[i]) == self.k:
                    self.floor[i] = self.best[i][-1][0]

    def rows(self):
        for i, found in zip(self.ids.tolist(), self.best):
            for s, v in found:
                yield i, v, s


def search(index: DataFrame, queries: DataFrame, k: int = 5, key: str = "vec_id", column: str = "embedding",
           epsilon: float = EPSILON, block: int = QUERY_BLOCK, seed: int = SEED) -> DataFrame:
    """(`query_id`, `rank`, `vec_id`, `score`): each query's `k` nearest rows of
    `index` by cosine, nearest first, ties to the smaller id.

    Both tables come from `build_index`; `index` is best a written table, as each block
    reads it. The queries are written once, in blocks of about `block` rows
    by hash: a block is what the driver and a task hold, and each block is one job over
    the codes, where a task keeps k rows per query. A row with the query's own id is no candidate;
    rows that repeat an id count once, as the nearest (as a query: the
    least vector). Vectors of another dimension are not compared. Fewer
    candidates than k: all of them; empty tables: no rows.
    """
    spark = index.sparkSession
    rows = queries.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("long").alias("i")).agg(F.min(column).alias("v"))
    rows = written(rows, "queries")
    n = max(1, math.ceil(rows.count() / block))
    dealt, found = scratch_path(spark, "query-blocks"), scratch_path(spark, "nearest")
    if n > 1:  # a folder per block, so that each is read alone
        (rows.withColumn("block", F.pmod(F.xxhash64("i"), F.lit(n))).repartition("block")
         .write.partitionBy("block").parquet(dealt))

    def scan(own):
        def run(batches):
            groups = [_Queries(ids, x, k, seed) for ids, x in own]
            for b in batches:
                for start in range(0, b.num_rows, 4096):
                    part = b.slice(start, 4096)
                    part_rows, data = _matrix(part.column(1))
                    for g in groups:
                        d = g.x.shape[1]
                        if d in data:
                            at = pa.array(part_rows[d])
                            code = part.column(2).take(at)
                            g.offer(part.column(0).take(at).to_numpy(), data[d],
                                    np.frombuffer(b"".join(code.to_pylist()), np.uint8).reshape(len(at), -1),
                                    part.column(3).take(at).to_numpy(), epsilon)
            found = [r for g in groups for r in g.rows()]
            if found:
                q, v, s = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()),
                                                  pa.array(s, pa.float64())], names=["query_id", "vec_id", "score"])

        return index.where(F.col(key).isNotNull()).select(F.col(key).cast("long"), column, "code", "correction") \
            .mapInArrow(run, "query_id bigint, vec_id bigint, score double")

    for b in range(n):
        own = rows if n == 1 else spark.read.parquet(dealt).where(F.col("block") == b)  # prunes to its folder
        table = own.select("i", "v").toArrow()
        vectors = table["v"].combine_chunks() if table.num_rows else pa.array([], pa.list_(pa.float32()))
        by_dim, data = _matrix(vectors.chunk(0) if isinstance(vectors, pa.ChunkedArray) else vectors)
        ids = table["i"].to_numpy()
        scan([(ids[by_dim[d]], data[d]) for d in data]).write.mode("append").parquet(found)
    best = spark.read.parquet(found).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nearest = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (best.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))

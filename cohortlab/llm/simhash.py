"""SimHash near-duplicates by a segment-popcount embedding (operator 10).

A fingerprint's 64 bits are cut into segments; the bit counts of the segments
form a point on an integer grid. Flipping one bit moves the point by one, so
the Manhattan distance of two points never exceeds the Hamming distance of the
fingerprints. The range join on the grid is an equi-join: each point is sent to
every grid cell within reach, in one of the two directions of each offset, and
each meeting pair is verified by its exact bit distance inside the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from cohortlab.llm.graph import connected_components
from cohortlab.llm.tables import column_places

SEED = 42
GRID_STEP = 4_000_000   #: distinct fingerprints up to which the grid has 8 segments
SLICE = 1 << 20         #: bytes of a text whose words are held at a time
_SPACE = re.compile(rb"[\x20\x09-\x0D]")
_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


def fingerprint_of(text: bytes | None, width: int, seed: int = SEED) -> int:
    """Signed 64-bit SimHash of one UTF-8 text; no word gives 0."""
    digest = xxhash.xxh64_intdigest
    ones, count, words = 0, 0, []
    for more in _word_slices(text or b""):
        words = words[len(words) - width + 1:] + more if len(words) >= width else words + more
        if len(words) < width:
            continue
        grams = map(b" ".join, zip(*(words[i:] for i in range(width))))
        hashes = np.array([digest(g, seed) for g in grams], np.uint64)
        ones, count = ones + _ones(hashes), count + len(hashes)
    if not count:
        if not words:
            return 0
        ones, count = _ones(np.array([digest(b" ".join(words), seed)], np.uint64)), 1
    packed = np.packbits(2 * ones > count)
    return int(packed.view(">i8")[0])


def _word_slices(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text, about `SLICE` bytes at a time: on bytes, so A-Z alone are lower-cased and ASCII spaces part."""
    start = 0
    while start < len(text):
        space = _SPACE.search(text, start + SLICE)
        end = space.start() if space else len(text)
        yield text[start:end].lower().split()
        start = end


def _ones(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits set, the highest first."""
    parts = hashes.astype(">u8").view(np.uint8).reshape(-1, 8)
    return np.concatenate([np.bincount(parts[:, i], minlength=256) @ _BYTE_BITS for i in range(8)])


def with_fingerprint(docs: DataFrame, width: int, column: str = "fingerprint",
                     text: str = "text", keys: tuple[str, ...] = ("doc_id",),
                     seed: int = SEED) -> DataFrame:
    """The key columns and the fingerprint of each row. Null text counts as
    empty: fingerprint 0."""

    def run(batches):
        for b in batches:
            fps = [fingerprint_of(t.as_buffer().to_pybytes() if t.is_valid else None, width, seed)
                   for t in b.column(len(keys))]
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keys)], pa.array(fps, pa.int64())],
                                             names=[*keys, column])

    fields = [f"`{k}` {docs.schema[k].dataType.simpleString()}" for k in keys]
    return docs.select(*keys, text).mapInArrow(run, ", ".join([*fields, f"{column} bigint"]))


def grid_offsets(segments: int, distance: int) -> list[tuple[int, ...]]:
    """Integer offsets of Manhattan length <= distance, one of each +/- pair."""
    found = [()]
    for _ in range(segments):
        found = [o + (d,) for o, d in product(found, range(-distance, distance + 1))
                 if sum(map(abs, o)) + abs(d) <= distance]
    zero = (0,) * segments
    return [o for o in found if o >= zero]


def segments_for(count: int, max_distance: int) -> int:
    """Segments for so many distinct fingerprints: 8 while a cell of 8 meets few points, 16 beyond.

    Points of 8 segments share a cell within reach with about 1.3e-4 of all others at distance 2, those of
    16 with 1.7e-7, for which each is sent to 273 cells instead of 73.
    """
    return 8 if count <= GRID_STEP or _step(16, max_distance) ** 16 >= 1 << 63 else 16


def _step(segments: int, max_distance: int) -> int:
    """Values a segment's count can take with its offsets: the base in which cells are written."""
    return 64 // segments + 2 * max_distance + 1


def near_pairs(fingerprints: DataFrame, max_distance: int, segments: int | None = None) -> DataFrame:
    """Pairs (a, b) of the distinct values of column `fp` that differ in 1 to
    `max_distance` bits, each pair once. `segments` must divide 64; without it, their number follows
    from the table's."""
    if segments is None:
        segments = segments_for(fingerprints.count(), max_distance)
    bits, base = 64 // segments, _step(segments, max_distance)
    if bits * segments != 64 or base ** segments >= 1 << 63:
        raise ValueError("segments must divide 64 and their counts must fit 63 bits")
    cell = F.lit(0).cast("long")
    for i in range(segments):
        part = F.shiftrightunsigned("fp", bits * i)
        if segments > 1:
            part = part.bitwiseAND(F.lit((1 << bits) - 1))
        cell = cell + (F.bit_count(part) + F.lit(max_distance)).cast("long") * F.lit(base ** i)
    # A set number of partitions: each row becomes many below, which adaptive
    # coalescing by the size of these small rows would put into one task.
    n = int(fingerprints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    points = fingerprints.repartition(n).select("fp", cell.alias("cell"))
    offsets = [sum(d * base ** i for i, d in enumerate(o)) for o in grid_offsets(segments, max_distance)]
    probes = points.select(F.col("fp").alias("a"), F.col("cell").alias("from_cell"),
                           F.explode(F.array(*[F.lit(o).cast("long") for o in offsets])).alias("offset"))
    probes = probes.select("a", "offset", (F.col("from_cell") + F.col("offset")).alias("cell"))
    cells = points.withColumnRenamed("fp", "b")
    return probes.join(cells, "cell").where(
        (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_distance)
        & ((F.col("offset") != 0) | (F.col("a") < F.col("b")))).select("a", "b")


def _classes(prints: DataFrame, max_distance: int, segments: int | None) -> DataFrame:
    """(fp, root): every distinct fingerprint with its component's smallest one."""
    nodes = prints.select("fp").distinct()
    roots = connected_components(near_pairs(nodes, max_distance, segments))
    return (nodes.join(roots, nodes.fp == roots.node, "left")
            .select("fp", F.coalesce("root", "fp").alias("root")))


def simhash_groups(docs: DataFrame, width: int = 3, max_distance: int = 2,
                   segments: int | None = None, text: str = "text") -> DataFrame:
    """One row per input row: `doc_id`, `fingerprint` (16 hex digits),
    `component_id` (the smallest doc_id its fingerprint reaches over links).

    Equal fingerprints are one node of the graph, however many rows share it,
    so a large group of copies costs one row there. Texts of equal words link,
    as does every text without a word (null, empty, white space: fingerprint
    0). Rows that repeat a doc_id with other texts are nodes of their own; a
    null doc_id is a component_id only where a component has no other. An
    empty table gives no rows; other columns are not read.
    """
    prints = with_fingerprint(docs, width, "fp", text).checkpoint()
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = _classes(prints, max_distance, segments).join(least, "fp")
    heads = named.groupBy("root").agg(F.min("least").alias("component_id"))
    ids = named.join(heads, "root").select("fp", "component_id")
    return prints.join(ids, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def keep_one_per_group(docs: DataFrame, width: int = 3, max_distance: int = 2,
                       segments: int | None = None, text: str = "text") -> DataFrame:
    """One row of `docs` per component, with all its columns: that with the
    smallest doc_id (a null one only if there is no other); of rows that repeat
    it, the first by a hash of the whole row, and equal rows collapse. `docs`
    has one row of no words at most afterwards.
    """
    places = column_places(docs)
    names = list(places.values())
    cells = [F.col(c) for c in names]  # a hash passes over nulls, so their places go in as well
    tagged = docs.toDF(*names).withColumn("__row", F.xxhash64(*cells, *[c.isNull() for c in cells]))
    prints = with_fingerprint(tagged, width, "fp", places[text], (places["doc_id"], "__row"))
    prints = prints.toDF("doc_id", "__row", "fp").checkpoint()
    row = F.struct(F.col("doc_id").isNull().alias("void"), "doc_id", "__row")
    first = prints.groupBy("fp").agg(F.min(row).alias("row"))
    kept = (_classes(prints, max_distance, segments).join(first, "fp")
            .groupBy("root").agg(F.min("row").alias("row"))
            .select(F.col("row.doc_id").alias("__keep_id"), F.col("row.__row").alias("__keep_row")))
    same = lambda i: [F.col("__keep_row") == F.col("__row"), F.col("__keep_id").eqNullSafe(F.col(i))]
    copies = (prints.join(kept, same("doc_id")).groupBy("__keep_row", "__keep_id").agg(F.count("*").alias("__copies")))
    chosen = tagged.join(copies.checkpoint(), same(places["doc_id"]))
    once = chosen.where("__copies = 1").select(*names)
    equal = chosen.where("__copies > 1").select(*names).dropDuplicates()
    return once.union(equal).toDF(*docs.columns)

"""Benchmark decontamination by MinHash containment search (operator 4).

A test item is short and a document may be very long, so their resemblance is
near zero even where the item stands in the document word for word; containment
(the share of the item's shingles that the document has) is what counts. Items
are partitioned by their number of shingles. Under one seeded hash an item's
signature is its k smallest shingle hashes, k set by its partition: at a
containment of t or more, at most `n - ceil(t n)` shingles of the item are
missing, so of k > that number at least `k - missing` signature hashes occur in
the document. The search for signature hashes among all shingles of the
documents therefore loses nothing; each candidate is verified by the exact share of its
shingles, compared as words.
"""

from __future__ import annotations

import math
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from cohortlab.llm.text import normal_words, row_slices, shingle_hashes, utf8, word_hashes
from cohortlab.session import scratch_path

WIDTH = 5
THRESHOLD = 0.8
BLOCK_WORDS = 400_000     #: benchmark words that one pass over the documents holds, at some 460 bytes each
_BITS = 20


def _shingles(words: list[bytes], width: int) -> set[bytes]:
    return set(map(b" ".join, zip(*(words[i:] for i in range(width)))))


class ContainmentIndex:
    """Signatures of one bounded block of test items, by (id, text)."""

    def __init__(self, items, width: int = WIDTH, threshold: float = THRESHOLD):
        self.ids, self.shingles, self.need, self.widths = [], [], [], []
        by_hash: dict[tuple[int, int], list[int]] = {}
        for item_id, text in items:
            raw = (text or "").encode("utf-8", "replace")
            words = normal_words(raw)
            if not words:
                continue  # nothing to look for
            w = min(width, len(words))
            offsets = np.array([0, len(raw)])
            hashes, _ = shingle_hashes(*word_hashes(np.frombuffer(raw, np.uint8), offsets), w)
            hashes = np.unique(hashes)  # ascending: the MinHash order
            n = len(hashes)
            upper = 1 << (n - 1).bit_length()  # the item's size partition is (upper/2, upper]
            missing = n - math.ceil(threshold * n - 1e-9)
            k = min(n, 2 * (upper - math.ceil(threshold * upper - 1e-9)) + 4)
            at = len(self.ids)
            self.ids.append(item_id)
            self.shingles.append(_shingles(words, w))
            self.need.append(max(1, k - missing))
            self.widths.append(w)
            for h in hashes[:k].tolist():
                by_hash.setdefault((w, h), []).append(at)
        self.tables = {}
        for w in sorted(set(self.widths)):
            hs = np.array(sorted(h for v, h in by_hash if v == w), np.uint64)
            bitmap = np.zeros(1 << _BITS, bool)
            bitmap[(hs >> np.uint64(64 - _BITS)).astype(np.int64)] = True
            self.tables[w] = hs, bitmap, [by_hash[w, h] for h in hs.tolist()]
        self.threshold = threshold

    def search(self, texts) -> list[tuple[int, int, float, int]]:
        """(row, item, containment, shingles found) over a text column."""
        if not self.ids:
            return []
        raw, offsets = utf8(texts)
        words, rows = word_hashes(raw, offsets)
        hits: dict[tuple[int, int], int] = {}
        for w, (hashes, bitmap, owners) in self.tables.items():
            h, r = shingle_hashes(words, rows, w)
            some = bitmap[(h >> np.uint64(64 - _BITS)).astype(np.int64)]
            h, r = h[some], r[some]
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            real = hashes[at] == h
            for key in np.unique(r[real] * len(hashes) + at[real]).tolist():
                row, slot = divmod(key, len(hashes))
                for item in owners[slot]:
                    hits[row, item] = hits.get((row, item), 0) + 1
        found, last, have = [], -1, {}
        for row, item in sorted(k for k, n in hits.items() if n >= self.need[k[1]]):
            if row != last:
                words_of, have, last = normal_words(raw[offsets[row]:offsets[row + 1]].tobytes()), {}, row
            w = self.widths[item]
            if w not in have:
                have[w] = _shingles(words_of, w)
            both = len(self.shingles[item] & have[w])
            if both >= self.threshold * len(self.shingles[item]) - 1e-9:
                found.append((row, item, both / len(self.shingles[item]), both))
        return found


@lru_cache(maxsize=1)
def _index(items: tuple, width: int, threshold: float) -> ContainmentIndex:
    return ContainmentIndex(items, width, threshold)


def item_blocks(benchmark: DataFrame, block_words: int = BLOCK_WORDS, key: str = "item_id",
                text: str = "text"):
    """The benchmark as lists of (id, text), each of about `block_words` words:
    what the driver holds and a pass broadcasts is bounded, and a larger
    benchmark takes more passes. (One item's text is never split.)"""
    items = benchmark.select(F.col(key).alias("id"), F.col(text).alias("t")).where("t is not null")
    words = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, math.ceil(words / 6 / block_words))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("id", "t"), F.lit(n)))
    for b in range(n):
        rows = dealt.where(F.col("block") == b).distinct().collect()
        yield tuple(sorted(((r["id"], r["t"]) for r in rows), key=repr))


def contained_items(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                    threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS,
                    text: str = "text", key: str = "doc_id") -> DataFrame:
    """(`doc_id`, `item_id`, `containment`, `n_found`, `n_shingles`) of every pair
    where the row's whole text has `threshold` or more of the item's distinct
    shingles of `width` words (an item of fewer words is one shingle).

    Words are runs of letters and digits, ASCII letters lower-cased. Null or
    wordless texts and items match nothing; repeated document rows repeat
    their pairs, equal item rows count once; an empty table gives no pairs.
    Documents pass once per block of the benchmark, without a shuffle.
    """
    id_type = benchmark.schema["item_id"].dataType
    schema = (f"`{key}` {docs.schema[key].dataType.simpleString()}, item_id {id_type.simpleString()}, "
              "containment double, n_found int, n_shingles int")

    def scan(items):
        def run(batches):
            index = _index(items, width, threshold)
            for b in row_slices(batches, text):
                found = index.search(b.column(1))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [b.column(0).take(pa.array([f[0] for f in found])),
                         pa.array([index.ids[f[1]] for f in found], pa.int64() if id_type.simpleString() == "bigint" else None),
                         pa.array([f[2] for f in found], pa.float64()),
                         pa.array([f[3] for f in found], pa.int32()),
                         pa.array([len(index.shingles[f[1]]) for f in found], pa.int32())],
                        names=[key, "item_id", "containment", "n_found", "n_shingles"])

        return docs.select(key, text).mapInArrow(run, schema)

    out = None
    for items in item_blocks(benchmark, block_words):
        part = scan(items)
        out = part if out is None else out.unionByName(part)
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH,
                      threshold: float = THRESHOLD, block_words: int = BLOCK_WORDS,
                      text: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, that contain no item as above.

    A benchmark of one block is one pass. A larger one is searched block after
    block, a job each, whose worker holds one block; what they find (doc_id, hash and length
    of the text, so that a row is known where ids repeat) is written and taken off at the end.
    """
    def search(items, hits_only):
        def run(batches):
            index = _index(items, width, threshold)
            for b in row_slices(batches, text):
                mask = np.full(b.num_rows, not hits_only)
                mask[[f[0] for f in index.search(b.column(text))]] = hits_only
                yield b.filter(pa.array(mask))
        return run

    blocks = item_blocks(benchmark, block_words)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return docs.mapInArrow(search(first, False), docs.schema)
    path = scratch_path(docs.sparkSession, "contaminated")
    narrow = docs.select(F.col("doc_id"), F.col(text))
    for items in chain((first, second), blocks):
        (narrow.mapInArrow(search(items, True), narrow.schema)
         .select(F.col("doc_id").alias("__id"), F.xxhash64(text).alias("__hash"), F.length(text).alias("__length"))
         .distinct().write.mode("append").parquet(path))
    hits = docs.sparkSession.read.parquet(path)
    same = (F.col("d.doc_id").eqNullSafe(F.col("h.__id")) & (F.xxhash64(F.col(f"d.`{text}`")) == F.col("h.__hash"))
            & (F.length(F.col(f"d.`{text}`")) == F.col("h.__length")))
    return docs.alias("d").join(hits.alias("h"), same, "left_anti")

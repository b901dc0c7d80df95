"""Helpers over Arrow text columns: bounded slices and vectorised word hashes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BASE = np.uint64(0x9E3779B97F4A7C15)
_powers: dict[str, np.ndarray] = {}


def row_slices(batches, column: str, max_bytes: int = SLICE_BYTES):
    """Slices of the record batches with at most `max_bytes` of text each (one
    row at least), so that working arrays stay small whatever the batch size."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes.astype(np.int64)), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(ends, before + max_bytes, "right")))
            yield batch.slice(start, end - start)
            start = end


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column, the texts end to end; null is empty."""
    col = pc.fill_null(column, "")
    col = pa.concat_arrays([col.cast(pa.large_binary())])  # drops the slice's offset
    offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i < n, kept per process."""
    if "up" not in _powers or len(_powers["up"]) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        for name, base in (("up", _BASE), ("down", inverse)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64), elementwise."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_table() -> np.ndarray:
    """Byte -> normalised byte: A-Z lower-cased, digits and bytes over 127 kept,
    everything else 0 (a separator)."""
    table = np.zeros(256, np.uint8)
    for b in range(256):
        if b >= 128 or chr(b).isalnum():
            table[b] = ord(chr(b).lower()) if b < 128 else b
    return table


WORD_TABLE = word_table()


def normal_words(text: bytes) -> list[bytes]:
    """The words of one text under `WORD_TABLE`."""
    return text.translate(bytes(b or 32 for b in WORD_TABLE.tolist())).split()


def _words(raw: np.ndarray, offsets: np.ndarray):
    """(starts, ends, hash of a span) of the words; words end at row ends."""
    norm = WORD_TABLE[raw]
    inside = norm != 0
    first = np.zeros(len(norm) + 1, bool)
    first[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    up, down = _power_tables(len(norm) + 1)
    sums = np.zeros(len(norm) + 1, np.uint64)
    np.cumsum(norm.astype(np.uint64) * up[:len(norm)], out=sums[1:])
    return starts, ends, lambda a, b: mix((sums[b] - sums[a]) * down[a])


def word_hashes(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every word of the texts, in order."""
    starts, ends, span = _words(raw, offsets)
    return span(starts, ends), np.searchsorted(offsets, starts, "right") - 1


def word_and_prefix_hashes(raw: np.ndarray, offsets: np.ndarray,
                           prefixes: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """As `word_hashes`, with the longer words' first bytes, for each length of
    `prefixes`, as features of their own."""
    starts, ends, span = _words(raw, offsets)
    rows = np.searchsorted(offsets, starts, "right") - 1
    hashes, owners = [span(starts, ends)], [rows]
    for k in prefixes:
        longer = ends - starts > k
        hashes.append(mix(span(starts[longer], starts[longer] + k) + np.uint64(k)))
        owners.append(rows[longer])
    return np.concatenate(hashes), np.concatenate(owners)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of the runs of `width` words inside one row."""
    n = len(words) - width + 1
    if n <= 0:
        return words[:0], rows[:0]
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h = h * _BASE + words[i:i + n]
    whole = rows[:n] == rows[width - 1:]
    return mix(h[whole]), rows[:n][whole]

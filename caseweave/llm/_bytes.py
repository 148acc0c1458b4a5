"""NumPy kernels over the bytes of a batch of texts: words, rolling hashes, minimizers.

A batch is one flat byte buffer and the offsets of its texts.  A polynomial hash modulo 2**64 with an odd base has an
inverse base, so the hash of any span is one subtraction and one product of prefix sums: no loop over positions.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Bytes of text that one kernel call works on (a longer text is taken alone): bounds a task's memory.
CHUNK_BYTES = 2_000_000

SPACES = bytes([0x20, *range(0x09, 0x0E)])
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def is_word_table(spaces: bytes = SPACES) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(spaces)] = False
    return table


WORD = is_word_table()


def mixed(x: np.ndarray) -> np.ndarray:
    """The values with their bits spread, one to one."""
    x = x ^ (x >> U(31))
    x = x * U(0x9E3779B97F4A7C15)
    x ^= x >> U(29)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(32)
    return x


class Rolling:
    """Polynomial hash with a seeded base; ``values`` maps bytes to 64-bit values."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 2**63, 256, dtype=U) * U(2) + U(1)
        base = int(rng.integers(2**40, 2**61)) * 8 + 5
        self.base, self.inverse = U(base % 2**64), U(pow(base, -1, 2**64))
        self.up = self.down = np.ones(1, U)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            up, down = np.full(n, self.base, U), np.full(n, self.inverse, U)
            up[0] = down[0] = 1
            self.up, self.down = np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)

    def prefix(self, values: np.ndarray) -> np.ndarray:
        """Prefix sums of 64-bit values; of bytes by way of ``values``."""
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, U)
        terms = self.values[values] if values.dtype == np.uint8 else values.copy()
        terms *= self.up[: len(values)]
        np.cumsum(terms, out=sums[1:])
        return sums

    def spans(self, sums: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return (sums[hi] - sums[lo]) * self.down[lo]

    def windows(self, sums: np.ndarray, k: int) -> np.ndarray:
        """Hash of every window of ``k`` values."""
        n = len(sums) - k
        if n <= 0:
            return np.zeros(0, U)
        return (sums[k:] - sums[:n]) * self.down[:n]


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (from 0) of a text column; null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    if not len(offsets):
        offsets = np.zeros(1, np.int64)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut, without copying, so that each holds about ``limit`` bytes of text or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = flat(batch.column(batch.schema.get_field_index(text)))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            yield batch.slice(at, min(end, batch.num_rows) - at)
            at = end


def words(buf: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of each text's first word (one more than texts)."""
    inside = table[buf]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = offsets[:-1] < offsets[1:]
    heads, tails = offsets[:-1][full], offsets[1:][full] - 1
    first[heads] = inside[heads]
    last[tails] = inside[tails]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def covered(starts: np.ndarray, lengths, n: int) -> np.ndarray:
    """True at each of ``n`` positions that a span ``[start, start + length)`` covers."""
    edges = np.zeros(n + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + lengths, -1)
    return np.cumsum(edges[:-1]) > 0


def sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every window of ``width`` values, by doubling."""
    done = 1
    while done * 2 <= width:
        values = pick(values[:-done], values[done:])
        done *= 2
    rest = width - done
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each row's list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def flat_lists(column) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and lengths of a list column (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = column.chunk(0) if column.num_chunks else pa.array([], column.type)
    counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), counts


def members(group: np.ndarray, value: np.ndarray, in_group: np.ndarray, in_value: np.ndarray) -> np.ndarray:
    """For each ``(group, value)`` its index among ``(in_group, in_value)``, or -1.  Exact: values are ranked first."""
    found = np.full(len(value), -1, np.int64)
    if not len(in_value) or not len(value):
        return found
    distinct, rank = np.unique(in_value, return_inverse=True)
    near = np.searchsorted(distinct, value)
    near[near == len(distinct)] = 0
    maybe = np.flatnonzero(distinct[near] == value)
    code = in_group.astype(np.int64) * len(distinct) + rank
    order = np.argsort(code, kind="stable")
    wanted = group[maybe].astype(np.int64) * len(distinct) + near[maybe]
    place = np.searchsorted(code, wanted, sorter=order)
    place[place == len(code)] = 0
    hit = code[order[place]] == wanted
    found[maybe[hit]] = order[place[hit]]
    return found

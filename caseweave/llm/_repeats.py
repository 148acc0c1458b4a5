"""What the two exact dedup operators share: buckets of measured size, and which hashed pieces occur in several ids.

Both send hashes of small pieces of text (word windows, byte grams) to buckets and keep the pieces whose hash several
ids have.  A hash may only drop a piece that no other id has; whether two pieces are equal is decided later, from their
words or bytes.  So 32 bits within a bucket are enough: a false match costs a look, not a wrong result.

Buckets come from a count of the data.  Pieces are first counted by ``CELLS`` cells of a hash; cells are put together to
buckets of about equal size, and a cell that is larger than a bucket (a run of words that a third of all texts hold) is
split by a second hash.  The counts, at most ``CELLS`` rows whatever the input, are all that the driver sees.

A row of the input is named by its id and the 64-bit hash of its text: rows that agree in both have the same result.
Answers to rows are packed too, by buckets of rows, and made one row each before they are joined to the texts.  The join
has as many partitions as the texts' bytes, which are counted with the pieces, ask for, so its tasks don't grow with the input.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel

CELLS = 1 << 14
#: Pieces that a bucket holds, about.
BUCKET_PIECES = 2_000_000
#: Bytes of text that a task of the join of texts and answers reads, about.
TASK_BYTES = 64_000_000
#: Cell of the count that has the texts' bytes.
BYTES = -1
U = np.uint64
I64, I32 = pa.int64(), pa.int32()
COUNTED = "cell int, n long"
PACKED = "bucket int, ids array<long>, texts array<long>, counts array<int>, hashes binary"
SHARED = "bucket int, ids array<long>, texts array<long>, counts array<int>, hashes binary"
HITS = "bucket int, ids array<long>, texts array<long>, counts array<int>, starts binary, lengths binary"


def runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of the (sorted) keys begins."""
    if not len(keys[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(keys[0]), bool)
    new[0] = True
    for key in keys:
        new[1:] |= key[1:] != key[:-1]
    return np.flatnonzero(new)


def spread(values: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Each run's value at each of its places."""
    return np.repeat(values, np.diff(np.r_[starts, n]))


def several(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """At each place, whether its run holds more than one id."""
    if not len(starts):
        return np.zeros(0, bool)
    return spread(np.minimum.reduceat(ids, starts) != np.maximum.reduceat(ids, starts), starts, len(ids))


class Buckets:
    """Buckets of about equal counts: the first bucket of each cell and how many it has."""

    def __init__(self, counts: np.ndarray, size: int, text_bytes: int = 0):
        self.text_bytes = text_bytes
        self.parts = np.maximum(1, -(-counts // size))
        self.first, at, filled = np.zeros(len(counts), np.int64), 0, 0
        for cell, (n, parts) in enumerate(zip(counts.tolist(), self.parts.tolist(), strict=True)):
            if filled and (parts > 1 or filled + n > size):
                at, filled = at + 1, 0
            self.first[cell] = at
            if parts > 1:
                at, filled = at + parts, 0
            else:
                filled += n
        self.n = at + 1

    @staticmethod
    def cell(hashes: np.ndarray) -> np.ndarray:
        return (hashes % U(CELLS)).astype(np.int64)

    def whole(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket of each value that isn't split, or -1."""
        cell = self.cell(hashes)
        return np.where(self.parts[cell] > 1, -1, self.first[cell])

    def split(self, hashes: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Bucket of each value; a large cell's values are dealt by the second hash."""
        cell = self.cell(hashes)
        return self.first[cell] + ((second >> U(7)) % self.parts[cell].astype(U)).astype(np.int64)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def planned(counted: DataFrame, size: int = BUCKET_PIECES) -> Buckets:
    """Buckets for counts of cells (``cell, n``); where there is little data, still some for each shuffle partition."""
    found = {row["cell"]: row["n"] for row in counted.groupBy("cell").agg(F.sum("n").alias("n")).collect()}  # at most CELLS rows and one
    text_bytes = found.pop(BYTES, 0)
    counts = np.zeros(CELLS, np.int64)
    counts[list(found)] = list(found.values())
    return Buckets(counts, max(1, min(size, -(-int(counts.sum()) // (2 * partitions(counted.sparkSession))))), text_bytes)


def counts_of(batches, cells) -> pa.RecordBatch:
    """One row for each cell that the texts of a task have pieces in, and one for their bytes; ``cells`` gives a batch's hashes."""
    counts, text_bytes = np.zeros(CELLS, np.int64), 0
    for batch in kernel.chunks(batches, "text"):
        text_bytes += len(kernel.flat(batch.column("text"))[0])
        counts += np.bincount(Buckets.cell(cells(batch)), minlength=CELLS)
    full = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.r_[BYTES, full], I32), pa.array(np.r_[text_bytes, counts[full]], I64)], ["cell", "n"])


def dealt(packed: DataFrame, buckets: Buckets) -> DataFrame:
    """Packed rows by bucket, over as many tasks as the buckets ask for."""
    return packed.repartition(max(partitions(packed.sparkSession), buckets.n // 2), "bucket").groupBy("bucket")


def _blobs(values: np.ndarray, edges: np.ndarray) -> pa.Array:
    """One binary value for each run of 32-bit numbers."""
    offsets = (np.r_[edges, len(values)] * 4).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(values))])


def _packed(bucket: np.ndarray, ids: np.ndarray, texts: np.ndarray, *values: np.ndarray) -> list[pa.Array]:
    """One row for each bucket: the rows of the input in it, how many values each has, and the values, 32 bits each."""
    order = np.lexsort((values[0], texts, ids, bucket))
    bucket, ids, texts = bucket[order], ids[order], texts[order]
    own, edges = runs(bucket, ids, texts), runs(bucket)
    counts = np.diff(np.r_[own, len(ids)])
    sizes = np.diff(np.r_[np.searchsorted(own, edges), len(own)])
    rows = [pa.array(bucket[edges], I32)]
    rows += [kernel.lists(c, sizes, t) for c, t in ((ids[own], I64), (texts[own], I64), (counts, I32))]
    return [*rows, *(_blobs(v[order], edges) for v in values)]


def _unpacked(table: pa.Table, *columns: str) -> list[np.ndarray]:
    """Id and text hash of each value, and the values."""
    counts, _ = kernel.flat_lists(table.column("counts"))
    rows = [np.repeat(kernel.flat_lists(table.column(c))[0], counts) for c in ("ids", "texts")]
    return rows + [np.frombuffer(kernel.flat(table.column(c))[0].tobytes(), np.int32) for c in columns]


def answers(ids: np.ndarray, texts: np.ndarray, values: dict[str, np.ndarray], spread_over: int) -> pa.Table:
    """Values for rows of the input, packed by buckets of these rows."""
    bucket = (kernel.mixed(ids.view(U) * U(3) + texts.view(U)) % U(spread_over)).astype(np.int64)
    columns = _packed(bucket, ids, texts, *(v.astype(np.int32) for v in values.values()))
    return pa.table(columns, ["bucket", "ids", "texts", "counts", *values])


def _new_rows(ids: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Of a batch's rows the first of each id and text."""
    new = np.zeros(len(ids), bool)
    order = np.lexsort((texts, ids))
    new[order[runs(ids[order], texts[order])]] = True
    return new


def once(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids and text hashes of a batch, and which rows aren't repeated ones (these would send all they have again)."""
    ids, texts = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    return ids, texts, _new_rows(ids, texts)


def pack(ids: np.ndarray, texts: np.ndarray, hashes: np.ndarray, bucket: np.ndarray, spread_over: int) -> pa.RecordBatch:
    """A batch's pieces (id, text hash, 64-bit hash and bucket of each) as packed rows.

    What several ids of the batch have is known to be shared: it travels as such in a bucket below zero, and only two of
    its ids go to the bucket, so what a third of all texts hold costs two values a batch there.
    """
    low = (hashes >> U(32)).astype(np.uint32).view(np.int32)
    order = np.argsort(bucket.astype(U) << U(32) | low.view(np.uint32), kind="stable")
    bucket, ids, texts, low = bucket[order], ids[order], texts[order], low[order]
    starts = runs(bucket, low)
    both = several(ids, starts)
    least, most = (spread(f.reduceat(ids, starts), starts, len(ids)) for f in (np.minimum, np.maximum)) if len(ids) else (ids, ids)
    ends = np.zeros(len(ids), bool)
    for end in (least, most):  # the first entry of the smallest and of the largest id of each run
        at = np.flatnonzero(ids == end)
        ends[at[runs(np.searchsorted(starts, at, "right"))]] = True
    sent = ~both | ends
    rows = _packed(bucket[sent], ids[sent], texts[sent], low[sent])
    if both.any():
        below = -1 - (texts[both].astype(U) % U(spread_over)).astype(np.int64) if spread_over > 1 else np.full(both.sum(), -1)
        rows = [pa.concat_arrays(pair) for pair in zip(rows, _packed(below, ids[both], texts[both], low[both]), strict=True)]
    return pa.RecordBatch.from_arrays(rows, ["bucket", "ids", "texts", "counts", "hashes"])


def shared(bucket: int, table: pa.Table, spread_over: int) -> pa.Table:
    """Of one bucket's pieces those whose hash several ids have, as answers to their rows."""
    ids, texts, hashes = _unpacked(table, "hashes")
    if bucket >= 0:
        order = np.argsort(hashes, kind="stable")
        order = order[several(ids[order], runs(hashes[order]))]
        ids, texts, hashes = ids[order], texts[order], hashes[order]
    return answers(ids, texts, {"hashes": hashes}, spread_over)


def hashes_of_rows(table: pa.Table) -> pa.Table:
    """A row of its own, with all its shared hashes, for each row of the input."""
    ids, texts, hashes = _unpacked(table, "hashes")
    order = np.lexsort((hashes, texts, ids))
    order = order[runs(ids[order], texts[order], hashes[order])]
    ids, texts, hashes = ids[order], texts[order], hashes[order]
    own = runs(ids, texts)
    return pa.table([pa.array(ids[own], I64), pa.array(texts[own], I64), _blobs(hashes, own)], ["id", "text_hash", "hashes"])


def spans_of_rows(table: pa.Table) -> pa.Table:
    """A row of its own, with its hits merged into maximal intervals, for each row of the input."""
    ids, texts, starts, lengths = _unpacked(table, "starts", "lengths")
    order = np.lexsort((starts, texts, ids))
    ids, texts, starts, lengths = ids[order], texts[order], starts[order].astype(np.int64), lengths[order]
    own = runs(ids, texts)
    base = spread(np.arange(len(own)), own, len(ids)) << 33  # rows one after the other, too far apart to touch
    ends = np.maximum.accumulate(base + starts + lengths) if len(ids) else base
    heads = np.flatnonzero(np.r_[True, (base + starts)[1:] > ends[:-1]]) if len(ids) else own
    lasts = np.r_[heads[1:], len(ids)][: len(heads)] - 1
    starts, lengths = starts[heads].astype(np.int32), (ends[lasts] - (base + starts)[heads]).astype(np.int32)
    edges = np.searchsorted(heads, own)
    return pa.table([pa.array(ids[own], I64), pa.array(texts[own], I64), _blobs(starts, edges), _blobs(lengths, edges)], ["id", "text_hash", "starts", "lengths"])


def numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit numbers of a column of blobs, and how many each row has (null: none)."""
    buf, offsets = kernel.flat(column)
    return np.frombuffer(buf.tobytes(), np.int32), np.diff(offsets) // 4


def asked(hashes: np.ndarray, text: np.ndarray, column: pa.Array) -> np.ndarray:
    """Which pieces (64-bit hash and index of the text) have a hash that the text's blob names."""
    named, counts = numbers(column)
    if not len(named):
        return np.zeros(len(hashes), bool)
    wanted = np.repeat(np.arange(len(counts)), counts).astype(U) << U(32) | named.view(np.uint32)
    wanted.sort()
    own = text.astype(U) << U(32) | hashes >> U(32)
    place = np.searchsorted(wanted, own)
    place[place == len(wanted)] = 0
    return wanted[place] == own


def meet(texts: DataFrame, found: DataFrame, buckets: Buckets) -> DataFrame:
    """``texts`` with what ``found`` has for their row; one shuffle of the texts serves each call.

    Where the session's shuffle partitions are too few for the texts' bytes, they are dealt to more.
    """
    parts = -(-buckets.text_bytes // TASK_BYTES)
    if parts > partitions(texts.sparkSession):
        texts = texts.repartition(parts, "id", "text_hash")
    found = found.withColumnsRenamed({"id": "found_id", "text_hash": "found_hash"})
    return texts.join(found, (F.col("id") == F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left").drop("found_id", "found_hash")


def whole_number(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, text_hash, text`` of the input; ids have to be whole numbers, since their order counts."""
    kind = docs.schema[key].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"column {key} has type {kind}; ids of this operator are whole numbers")
    return docs.select(F.col(key).cast("long").alias("id"), F.xxhash64(F.col(text)).alias("text_hash"), F.col(text).alias("text"))


def found_by_row(df: DataFrame, buckets: Buckets, find, answer: str, by_row, schema: str) -> DataFrame:
    """What ``find(bucket, table)`` says of each bucket, made one row for each row of the input by ``by_row``."""
    packed = dealt(df, buckets).applyInArrow(lambda key, table: find(key[0].as_py(), table), answer)
    return dealt(packed, buckets).applyInArrow(lambda table: by_row(table), f"id long, text_hash long, {schema}")


def shared_hashes(packed: DataFrame, buckets: Buckets) -> DataFrame:
    return found_by_row(packed, buckets, lambda k, t: shared(k, t, buckets.n), SHARED, hashes_of_rows, "hashes binary")


def spans(pieces: DataFrame, buckets: Buckets, find) -> DataFrame:
    return found_by_row(pieces, buckets, find, HITS, spans_of_rows, "starts binary, lengths binary")

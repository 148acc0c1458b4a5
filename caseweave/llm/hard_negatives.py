"""Hard-negative mining by a secondary sort of packed (anchor, descending score, id) keys.

1. Blocks.  Components become ``floor(256 * x)``; rows are packed in chunks of ``CHUNK_BYTES`` and anchors in blocks of
   ``BLOCK_ANCHORS``.  Every chunk meets every block (the stated anchors against all rows) in one matrix product.  Blocks
   are broadcast while they fit in ``broadcast_bytes``; beyond it the same pairs meet by a shuffle join.
2. Positives.  Of each product only an anchor's best rows of its own label leave the task, as many as may still be
   among its first positives.  Their keys are shuffled once and sorted within the partitions
   (``repartitionAndSortWithinPartitions``); a streaming iterator takes each anchor's first ones.
3. Negatives.  A positive opens a window of scores.  Of each product only the best rows of another label in each window
   leave the task.  They and the positives go through a second such sort, and a streaming iterator opens an anchor's windows as
   its positives come by and hands each row that follows to the open windows it falls into.  It holds one anchor's open
   windows (five by default), never an anchor's rows.

Partial results are exact: the first rows of a whole are among the first rows of its parts.  A key is 26 bytes in an
order that bytes compare: anchor number, score from high to low, whether a negative (a window may begin at its positive's
own score, so the positive goes first), id, and whether it is the anchor itself.

Defined results: rows with a null id, label or vector, or with any component that is null or not finite (or whose 256-fold
is not), take no part.  Each row counts for itself: an anchor's equal twin is another row, equal anchors each have their
results, and equal negatives are ranked one after the other.  A vector that is shorter than another counts as zero in
what it lacks.  Scores are exact; one beyond 64 bits counts as the nearest 64-bit number.  No rows, no anchors, no other
labels or no scores in a window: no results.  Other columns are not looked at, whatever their names.  Ids and labels have
to be whole numbers; others raise a ``TypeError``.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

from caseweave.llm import _bytes as kernel
from caseweave.llm._spark import checkpointed

POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
ANCHOR_EVERY = 100
#: Anchors that meet a chunk of rows in one product, and bytes of a chunk's vectors.
BLOCK_ANCHORS, CHUNK_BYTES = 512, 4_000_000
#: Bytes of anchors' vectors that are broadcast at most.
BROADCAST_BYTES = 16_000_000
SCALE = 256
#: A key: anchor, score from high to low, kind, id, whether it is the anchor itself; numbers so that bytes compare.
KEY = np.dtype([("anchor", ">u8"), ("score", ">u8"), ("kind", "u1"), ("id", ">u8"), ("own", "u1")])
_KEY, _ANCHOR, _SIGN = ">QQBQB", ">qq", 1 << 63
TOP, LEAST = np.uint64(2**63 - 1), np.iinfo(np.int64).min


def pack_keys(anchor: np.ndarray, score: np.ndarray, kind: int, ids: np.ndarray, own: np.ndarray) -> pa.Array:
    keys = np.zeros(len(anchor), KEY)
    keys["anchor"], keys["kind"], keys["own"] = anchor.astype(np.uint64), kind, own
    keys["score"] = TOP - score.astype(np.int64).view(np.uint64)
    keys["id"] = ids.astype(np.int64).view(np.uint64) ^ np.uint64(_SIGN)
    ends = np.arange(len(keys) + 1, dtype=np.int32) * KEY.itemsize
    return pa.Array.from_buffers(pa.binary(), len(keys), [None, pa.py_buffer(ends), pa.py_buffer(keys.tobytes())])


def pack_key(anchor: int, score: int, kind: int, key: int) -> bytes:
    return struct.pack(_KEY, anchor, (2**63 - 1 - score) % 2**64, kind, key + _SIGN, 0)


def unpack_key(key: bytes) -> tuple[int, int, int, int, int]:
    """Anchor number, score, kind, id, whether it is the anchor itself."""
    anchor, score, kind, row, own = struct.unpack(_KEY, key)
    return anchor, 2**63 - 1 - score, kind, row - _SIGN, own


def _whole_number(df: DataFrame, name: str) -> Column:
    if not isinstance(df.schema[name].dataType, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"{name} has to be a whole number, it is {df.schema[name].dataType.simpleString()}")
    return F.col(f"`{name}`").cast("long")


def _matrix(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Rows of a list column, shorter ones filled with zeros."""
    width = int(counts.max()) if len(counts) else 0
    if (counts == width).all():
        return values.reshape(len(counts), width)
    out = np.zeros((len(counts), width))
    out[np.arange(width) < counts[:, None]] = values
    return out


_CHUNK = "dims int, ids binary, labels binary, vectors binary"


def _chunks(batches, limit: int):
    """Rows ``id, label, vector`` packed: those that take part, in order of id within a chunk."""
    for batch in batches:
        values, counts = kernel.flat_lists(batch.column(2))
        scaled = np.floor(values.astype(np.float64) * SCALE)
        sums = np.concatenate([[0], np.cumsum(~np.isfinite(scaled))])
        ends = np.cumsum(counts)
        good = np.flatnonzero(sums[ends] == sums[ends - counts])
        good = good[np.argsort(counts[good], kind="stable")]
        ids, labels = (batch.column(k).to_numpy(zero_copy_only=False).astype("<i8") for k in (0, 1))
        at = 0
        while at < len(good):
            bytes_to = (np.arange(1, len(good) - at + 1)) * np.maximum(counts[good[at:]], 1) * 8
            take = good[at : at + max(1, int(np.searchsorted(bytes_to, limit, "right")))]
            at += len(take)
            take = take[np.argsort(ids[take], kind="stable")]
            vectors = _matrix(np.concatenate([scaled[ends[k] - counts[k] : ends[k]] for k in take.tolist()]), counts[take])
            columns = [[vectors.shape[1]], [ids[take].tobytes()], [labels[take].tobytes()], [vectors.astype("<f8").tobytes()]]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), *[pa.binary()] * 3), strict=True)], ["dims", "ids", "labels", "vectors"])


def scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products, exact; the nearest 64-bit number where they don't fit."""
    width = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :width], rows[:, :width]
    if not width:
        return np.zeros((len(a), len(b)), np.int64)
    most_a, most_b = np.abs(a).max(1), np.abs(b).max(1)
    # float sums of whole numbers below 2**53 are exact
    if float(most_a.max(initial=0)) * float(most_b.max(initial=0)) * width < 2**53:
        return (a @ b.T).astype(np.int64)
    with np.errstate(all="ignore"):
        large = most_a[:, None] * most_b[None, :] * width >= 2**53
        out = np.where(large, 0, a @ b.T).astype(np.int64)
    for i, j in zip(*np.nonzero(large), strict=True):
        exact = sum(int(x) * int(y) for x, y in zip(a[i].tolist(), b[j].tolist(), strict=True))
        out[i, j] = max(-(2**63), min(2**63 - 1, exact))
    return out


def best(values: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the ``k`` highest allowed values of each row; among equal ones the first columns."""
    masked = np.where(allowed, values, LEAST)
    if masked.shape[1] > k:
        bound = np.partition(masked, masked.shape[1] - k, axis=1)[:, masked.shape[1] - k]
        allowed = allowed & (masked >= bound[:, None])
    row, column = np.nonzero(allowed)
    order = np.lexsort((column, ~masked[row, column], row))
    row, column = row[order], column[order]
    place = np.arange(len(row)) - np.searchsorted(row, row)
    return row[place < k], column[place < k]


def window(score: int, low: int, high: int) -> tuple[int, int]:
    """Scores from ``low`` to ``high`` percent of a positive's score; the first is above the second if there are none."""
    return -(-low * score // 100), high * score // 100


def _products(batches, positives: int, negatives: int, low: int, high: int, mining: bool):
    """Keys of the rows that may be among an anchor's first positives, or (``mining``) first negatives of its windows."""
    for batch in batches:
        for k in range(batch.num_rows):
            dims, ids, labels, vectors, block = (batch.column(c)[k] for c in ("dims", "ids", "labels", "vectors", "anchors"))
            ids, labels = (np.frombuffer(x.as_buffer(), "<i8") for x in (ids, labels))
            rows = np.frombuffer(vectors.as_buffer(), "<f8").reshape(len(ids), dims.as_py())
            block = block.values
            number, own, label = (block.field(c).to_numpy(zero_copy_only=False) for c in ("anchor", "id", "label"))
            anchors = _matrix(*kernel.flat_lists(block.field("vector")))
            value = scores(anchors, rows)
            same = label[:, None] == labels[None, :]
            if mining:
                found, opened = kernel.flat_lists(block.field("opened"))
                pairs = []
                for w in range(int(opened.max())):
                    starts = np.cumsum(opened) - opened
                    spans = [window(int(found[starts[i] + w]), low, high) if w < opened[i] else (1, 0) for i in range(len(opened))]
                    some = np.array([i for i, (a, b) in enumerate(spans) if a <= b], np.int64)
                    if len(some):
                        lo, hi = (np.array(x, np.int64)[:, None] for x in zip(*(spans[i] for i in some.tolist()), strict=True))
                        part = value[some]
                        i, j = best(part, ~same[some] & (part >= lo) & (part <= hi), negatives)
                        pairs.append(some[i] * len(ids) + j)
                i, j = np.divmod(np.unique(np.concatenate(pairs or [np.zeros(0, np.int64)])), max(1, len(ids)))
                self_ = np.zeros(len(i), bool)
            else:
                i, j = best(value, same, positives + 1)  # one of them may be the anchor itself
                width = max(anchors.shape[1], rows.shape[1])
                wide = [np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (anchors, rows)]
                self_ = own[i] == ids[j]
                self_[self_] = (wide[0][i[self_]] == wide[1][j[self_]]).all(1)
            if len(i):
                yield pa.RecordBatch.from_arrays([pack_keys(number[i], value[i, j], int(mining), ids[j], self_)], ["key"])


def _blocks(anchors: DataFrame, count: int) -> DataFrame:
    """Anchors in about equal blocks: ``block, anchors``."""
    blocks = max(1, -(-count // BLOCK_ANCHORS))
    return anchors.groupBy(F.pmod(F.xxhash64("anchor"), F.lit(blocks)).cast("int").alias("block")).agg(
        F.collect_list(F.struct(*anchors.columns)).alias("anchors")
    )


def _candidates(chunks: DataFrame, anchors: DataFrame, count: int, small: bool, run):
    """Keys of the candidates in the products of all chunks with all blocks."""
    blocks = _blocks(anchors, count)
    numbers = F.sequence(F.lit(0), F.lit(max(1, -(-count // BLOCK_ANCHORS)) - 1))
    dealt = chunks.withColumn("block", F.explode(numbers))
    return dealt.join(F.broadcast(blocks) if small else blocks, "block").drop("block").mapInArrow(run, "key binary")


def _sorted(spark, records):
    """Records by anchor in one partition each, sorted by key there: a single shuffle."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return records.repartitionAndSortWithinPartitions(partitions, partitionFunc=lambda key: zlib.crc32(key[:8]))


def take_positives(records, positives: int):
    """``anchor, place, id, score`` of each anchor's first positives; the anchor itself is passed over once."""
    current, taken, passed = None, 0, False
    for key, _ in records:
        if key[:8] != current:
            current, taken, passed = key[:8], 0, False
        if taken == positives:
            continue
        anchor, score, _, row, own = unpack_key(key)
        if own and not passed:
            passed = True
            continue
        taken += 1
        yield anchor, taken, row, score


def take_negatives(records, negatives: int, low: int, high: int):
    """Result rows (and the number of equal anchors): windows open as positives come by, and take the rows that follow."""
    current, open_ = None, []
    for key, value in records:
        if key[:8] != current:
            current, open_ = key[:8], []
        _, score, kind, row, _ = unpack_key(key)
        if not kind:
            open_.append([*struct.unpack(_ANCHOR, value), row, score, *window(score, low, high), 0])
            continue
        for found in open_:
            if found[4] <= score <= found[5] and found[6] < negatives:
                found[6] += 1
                yield found[0], found[2], found[6], row, found[3], score, found[1]


def mine(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", anchors: Column | None = None,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
    broadcast_bytes: int = BROADCAST_BYTES, chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    For each anchor (rows where ``anchors`` holds, ids divisible by 100 by default) and each of its first ``positives``
    rows of the same label, the first ``negatives`` rows of other labels with ``low`` to ``high`` percent of that score.
    """
    spark = rows.sparkSession
    source = rows.select(
        _whole_number(rows, key).alias("id"), _whole_number(rows, label).alias("label"), F.col(f"`{vector}`").cast("array<double>").alias("vector"),
        F.coalesce(F.col(f"`{key}`") % ANCHOR_EVERY == 0 if anchors is None else anchors, F.lit(False)).alias("anchor"),
    ).where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
    scaled = F.transform("vector", lambda x: x * SCALE)
    fine = F.forall(scaled, lambda y: F.coalesce(F.abs(y) < float("inf"), F.lit(False)))
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y))
    # Equal anchors have equal results, so they are mined once; numbers hold for good since they are written.
    chosen = source.where("anchor").where(fine).groupBy("id", "label", whole.alias("vector")).agg(F.count(F.lit(1)).alias("copies"))
    chosen = checkpointed(chosen.withColumn("anchor", F.monotonically_increasing_id()))
    count, size = chosen.agg(F.count(F.lit(1)), F.coalesce(F.sum(8 * F.size("vector") + 64), F.lit(0))).first()
    small = size <= broadcast_bytes
    chunks = source.select("id", "label", "vector").mapInArrow(lambda b: _chunks(b, chunk_bytes), _CHUNK)

    near = _candidates(chunks, chosen.select("anchor", "id", "label", "vector"), count, small, lambda b: _products(b, positives, negatives, low, high, False))
    first = _sorted(spark, near.rdd.map(lambda r: (bytes(r[0]), None))).mapPartitions(lambda r: take_positives(r, positives))
    found = checkpointed(spark.createDataFrame(first, "anchor long, place int, id long, score long", verifySchema=False))

    opened = chosen.join(found.groupBy("anchor").agg(F.collect_set("score").alias("opened")), "anchor")
    wide = _candidates(chunks, opened.select("anchor", "id", "label", "vector", "opened"), count, small, lambda b: _products(b, positives, negatives, low, high, True))
    named = found.join(chosen.select("anchor", F.col("id").alias("anchor_id"), "copies"), "anchor").select("anchor", "score", "id", "anchor_id", "copies")
    records = wide.rdd.map(lambda r: (bytes(r[0]), None)).union(named.rdd.map(lambda r: (pack_key(r[0], r[1], 0, r[2]), struct.pack(_ANCHOR, r[3], r[4]))))
    mined = _sorted(spark, records).mapPartitions(lambda r: take_negatives(r, negatives, low, high))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long, copies long"
    out = spark.createDataFrame(mined, schema, verifySchema=False)
    return out.withColumn("copies", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).drop("copies")


def hard_negatives_query(embeddings: DataFrame) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label").cast("long"))
    return mine(embeddings.select("vec_id", "embedding", label.alias("label")))


ORACLE_SQL = """
WITH rows AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, r.row, r.vec_id, a.label = r.label AS same, list_inner_product(a.vector, r.vector)::BIGINT AS score
  FROM rows a JOIN rows r ON a.vec_id % 100 = 0 AND a.row <> r.row),
positives AS (
  SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id, row_number() OVER own::INT AS rank, n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
WINDOW own AS (PARTITION BY p.anchor, p.row ORDER BY n.score DESC, n.vec_id)
QUALIFY row_number() OVER own <= 10
"""

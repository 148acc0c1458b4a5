"""Substring dedup: Rabin-Karp hashes of every window of 50 words, counted over all documents.

A word is removed when a window that covers it also starts in a document with a smaller ``doc_id``; windows are judged
on the input.  Steps:

1. Buckets.  A window's place is the least hash among its runs of four words, which neighbouring windows mostly share.
   Windows are counted by place, and buckets of about equal size are made of the places (``_repeats``).
2. Hashes.  Each task rolls a hash over the word windows of a batch.  Hashes, packed into one row per batch and bucket,
   are shuffled by bucket and counted there: windows that no other id has drop out.
3. Words.  The windows that are left are sent to their buckets with their words, neighbours together.  Windows with
   equal hashes are compared word by word there (and before, within a batch), so no hash decides a removal: all equal
   windows but those of the smallest id are hits.
4. Hits, grouped by document, meet the texts.  Covered words merge into maximal removal intervals.

Defined results: null and empty texts have no words; a text of fewer than 50 words is kept; rows with a null id are
kept whole and count for nobody; rows that share an id never remove each other's words; ids are whole numbers (another
type raises ``TypeError``); a single long text is one batch; an empty table gives no rows; other columns are not passed
on, and may have any name.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel
from caseweave.llm import _repeats as repeats

WINDOW_WORDS = 50
RUN_WORDS = 4
#: Bits that window hashes are cut to: all; tests take few, so that different windows meet.
HASH_BITS = 64
#: Bytes of text whose windows are packed together.
AT_ONCE = 4_000_000
U = np.uint64
I64, I32 = pa.int64(), pa.int32()
SEGMENTS = "bucket int, ids array<long>, texts array<long>, starts array<int>, sizes array<int>, words binary"


def word_codes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal only for equal words."""
    sizes = ends - starts
    offsets = np.r_[0, np.cumsum(sizes)]
    data = buf[np.repeat(starts - offsets[:-1], sizes) + np.arange(offsets[-1])]
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return words.dictionary_encode().indices.to_numpy()


def equal_windows(codes: np.ndarray, a: np.ndarray, b: np.ndarray, size: int) -> np.ndarray:
    """Whether the ``size`` codes from ``a`` equal those from ``b``; neighbours that move on together are compared once."""
    order = np.lexsort((a, b - a))
    a, b = a[order], b[order]
    first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1] + 1) | (b[1:] != b[:-1] + 1)])
    lengths = np.diff(np.r_[first, len(a)]) + size - 1
    at = np.cumsum(lengths) - lengths
    places = np.repeat(a[first] - at, lengths) + np.arange(lengths.sum())
    wrong = np.r_[0, np.cumsum(codes[places] != codes[places + np.repeat(b[first] - a[first], lengths)])]
    own = np.repeat(at - first, np.diff(np.r_[first, len(a)])) + np.arange(len(a))
    equal = np.zeros(len(a), bool)
    equal[order] = wrong[own + size] == wrong[own]
    return equal


def later(ids: np.ndarray, hashes: np.ndarray, codes: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Of windows ``at`` places of ``codes``, those that equal a window of a smaller id.

    Windows with one hash are compared with the first of them; those that differ from it, if any, go round again.
    """
    found, open_ = np.zeros(len(at), bool), np.arange(len(at))
    while len(open_):
        order = open_[np.argsort(hashes[open_], kind="stable")]
        starts = repeats.runs(hashes[order])
        first = repeats.spread(at[order[starts]], starts, len(order))
        equal = equal_windows(codes, at[order], first, size)
        same, group = order[equal], repeats.spread(np.arange(len(starts)), starts, len(order))[equal]
        least = np.full(len(starts), np.iinfo(np.int64).max)
        np.minimum.at(least, group, ids[same])
        found[same] = ids[same] > least[group]
        open_ = order[~equal]
    return found


class _Windows:
    """Rolling hashes of a batch; bases are fixed, so every task makes the same values."""

    def __init__(self, size: int, bits: int):
        self.size, self.bits = size, bits
        self.of_bytes, self.of_words, self.second = kernel.Rolling(11), kernel.Rolling(12), kernel.Rolling(13)

    def __call__(self, column: pa.Array) -> _Windows:
        """Word starts, ends and hashes, each text's first word, and the start word and text index of each window."""
        self.buf, offsets = kernel.flat(column)
        self.starts, self.ends, self.first = kernel.words(self.buf, offsets)
        self.values = kernel.mixed(self.of_bytes.spans(self.of_bytes.prefix(self.buf), self.starts, self.ends))
        text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        n = max(0, len(self.values) - self.size + 1)
        self.at = np.flatnonzero(text[:n] == text[self.size - 1 :]) if n else np.zeros(0, np.int64)
        self.text = text[self.at]
        return self

    def places(self) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, U)
        run = min(RUN_WORDS, self.size)
        rolled = kernel.mixed(self.second.windows(self.second.prefix(self.values), run))
        return kernel.mixed(kernel.sliding(rolled, self.size - run + 1, np.minimum)[self.at])

    def hashes(self) -> np.ndarray:
        if not len(self.at):
            return np.zeros(0, U)
        rolled = kernel.mixed(self.of_words.windows(self.of_words.prefix(self.values), self.size)[self.at])
        return rolled & ~U(2 ** (64 - self.bits) - 1)


def _count(batches, size: int):
    windows = _Windows(size, HASH_BITS)
    yield from repeats.counts_of(batches, lambda batch: windows(batch.column(2)).places())


def _pack(batches, size: int, bits: int, buckets: repeats.Buckets):
    windows = _Windows(size, bits)
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        w = windows(batch.column(2))
        if len(w.at):
            ids, texts, new = repeats.once(batch)
            hashes, k = w.hashes(), np.flatnonzero(new[w.text])
            bucket = buckets.split(w.places(), hashes)[k]
            yield repeats.pack(ids[w.text[k]], texts[w.text[k]], hashes[k], bucket, buckets.n)


def _fetch(batches, size: int, bits: int, buckets: repeats.Buckets):
    """The words of shared windows, one row for each bucket; hits found in the batch travel in buckets below zero."""
    windows, pressed = _Windows(size, bits), zstandard.ZstdCompressor(1)
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        if batch.column(3).null_count == batch.num_rows:
            continue
        w = windows(batch.column(2))
        hashes, places, (ids, texts, new) = w.hashes(), w.places(), repeats.once(batch)
        k = np.flatnonzero(repeats.asked(hashes, w.text, batch.column(3)) & new[w.text])
        if not len(k):
            continue
        bucket, hashes, at, text = buckets.split(places[k], hashes[k]), hashes[k], w.at[k], w.text[k]
        hit = later(ids[text], hashes, word_codes(w.buf, w.starts, w.ends), at, size)
        bucket = np.where(hit, -1 - text % buckets.n, bucket)
        order = np.lexsort((at, bucket))
        bucket, at, text = bucket[order], at[order], text[order]
        heads = np.flatnonzero(np.r_[True, (bucket[1:] != bucket[:-1]) | (at[1:] != at[:-1] + 1) | (text[1:] != text[:-1])])
        sizes = np.diff(np.r_[heads, len(at)])
        bucket, at, text = bucket[heads], at[heads], text[heads]
        edges = repeats.runs(bucket)
        counts = np.diff(np.r_[edges, len(bucket)])
        data, words = w.buf.tobytes(), []
        a, b = w.starts[at].tolist(), w.ends[at + sizes + size - 2].tolist()
        for begin, end in zip(edges.tolist(), np.r_[edges[1:], len(bucket)].tolist(), strict=True):
            blob = b" ".join([data[a[j] : b[j]] for j in range(begin, end)]) if bucket[begin] >= 0 else b""
            words.append(pressed.compress(blob) if blob else b"")
        columns = [(ids[text], I64), (texts[text], I64), (at - w.first[text], I32), (sizes, I32)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], I32), *(kernel.lists(c, counts, t) for c, t in columns), pa.array(words, pa.binary())],
            ["bucket", "ids", "texts", "starts", "sizes", "words"],
        )


def _compare(bucket: int, table: pa.Table, size: int, spread_over: int) -> pa.Table:
    """Hits among one bucket's windows: words of runs of windows that start in a smaller id too."""
    sizes, counts = kernel.flat_lists(table.column("sizes"))
    ids, texts, starts = (kernel.flat_lists(table.column(c))[0] for c in ("ids", "texts", "starts"))
    if bucket >= 0:
        opened = zstandard.ZstdDecompressor()
        blob = b" ".join([opened.decompress(x) for x in table.column("words").to_pylist()])
        buf = np.frombuffer(blob, np.uint8)
        begins, ends, _ = kernel.words(buf, np.array([0, len(buf)]))
        sizes = sizes.astype(np.int64)
        lengths, ahead = sizes + size - 1, np.cumsum(sizes) - sizes
        at = np.repeat(np.cumsum(lengths) - lengths - ahead, sizes) + np.arange(sizes.sum())
        codes, rolling = word_codes(buf, begins, ends), kernel.Rolling(14)
        hashes = kernel.mixed(rolling.windows(rolling.prefix(kernel.mixed(codes.astype(U))), size)[at])
        place = np.repeat(starts - ahead, sizes) + np.arange(len(at))
        segment = np.repeat(np.arange(len(sizes)), sizes)
        k = np.flatnonzero(later(ids[segment], hashes, codes, at, size))
        segment, place = segment[k], place[k]
        heads = np.flatnonzero(np.r_[True, (segment[1:] != segment[:-1]) | (place[1:] != place[:-1] + 1)]) if len(k) else k
        ids, texts, starts, sizes = ids[segment[heads]], texts[segment[heads]], place[heads], np.diff(np.r_[heads, len(k)])
    return repeats.answers(ids, texts, {"starts": starts, "lengths": sizes + size - 1}, spread_over)


def _cut(batches):
    """Texts without the covered words, joined by one space."""
    for batch in kernel.chunks(batches, "text"):
        buf, offsets = kernel.flat(batch.column(1))
        starts, ends, first = kernel.words(buf, offsets)
        (begins, counts), (lengths, _) = repeats.numbers(batch.column(2)), repeats.numbers(batch.column(3))
        gone = kernel.covered(begins + np.repeat(first[:-1], counts), lengths, len(starts))
        sums = np.r_[0, np.cumsum(gone)]
        removed = sums[first[1:]] - sums[first[:-1]]
        data, texts = buf.tobytes(), []
        for k in range(batch.num_rows):
            a, b = first[k], first[k + 1]
            if a == b:
                texts.append(b"")
            elif not removed[k]:
                texts.append(b" ".join(data[starts[a] : ends[b - 1]].split()))
            else:
                keep = a + np.flatnonzero(~gone[a:b])
                texts.append(b" ".join([data[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)]))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(np.diff(first), I64), pa.array(removed, I64), pa.array(texts, pa.binary()).cast(pa.string())],
            ["id", "n_words", "n_removed", "kept_text"],
        )


def substring_dedup(
    docs: DataFrame, text: str = "text", key: str = "doc_id", size: int = WINDOW_WORDS, bits: int = HASH_BITS, pieces: int = repeats.BUCKET_PIECES
) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_words``, ``n_removed`` and ``kept_text``."""
    source = repeats.whole_number(docs, key, text)
    filled = source.where("id is not null and text is not null")
    buckets = repeats.planned(filled.mapInArrow(lambda b: _count(b, size), repeats.COUNTED), pieces)
    packed = filled.mapInArrow(lambda b: _pack(b, size, bits, buckets), repeats.PACKED)
    met = repeats.meet(source, repeats.shared_hashes(packed, buckets), buckets)
    segments = met.mapInArrow(lambda b: _fetch(b, size, bits, buckets), SEGMENTS)
    spans = repeats.spans(segments, buckets, lambda k, t: _compare(k, t, size, buckets.n))
    last = repeats.meet(source, spans, buckets).select("id", "text", "starts", "lengths")
    return last.mapInArrow(_cut, "id long, n_words long, n_removed long, kept_text string").withColumnRenamed("id", key)


def substring_dedup_query(docs: DataFrame) -> DataFrame:
    out = substring_dedup(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id,
                  list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
w AS (SELECT r, doc_id, i, array_to_string(ws[i:i + 49], ' ') AS g
      FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM t WHERE len(ws) >= 50 AND doc_id IS NOT NULL)),
hit AS (SELECT r, i FROM w QUALIFY doc_id > min(doc_id) OVER (PARTITION BY g)),
gone AS (SELECT DISTINCT r, unnest(range(i, i + 50)) AS i FROM hit),
words AS (SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM t),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (r) LEFT JOIN n USING (r)
"""

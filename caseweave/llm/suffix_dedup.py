"""Suffix-array dedup: repeated 50-byte strings, found by sorting suffixes the deep-shallow way.

A byte is removed when a 50-byte string that covers it also starts in a document with a smaller ``doc_id``.  Texts are
UTF-8 bytes, matches stay inside a document, strings are judged on the input.

Sorting every suffix would shuffle each byte many times over, so only suffixes that may repeat are sorted:

1. Anchors.  Of the 20-byte grams in any 50-byte string the one with the least hash is its anchor (a minimizer); equal
   strings have equal anchors at equal places.  Anchors are counted by gram, and buckets of about equal size are made of
   the grams (``_repeats``).  Hashes of the anchors' grams are shuffled by bucket; grams that no other id has drop out.
2. Contexts.  An anchor that is left goes to its gram's bucket with its context, the bytes that the 50-byte strings
   around it reach: these strings are the starts of the suffixes in question.  Grams too frequent for one bucket send
   each string by itself, dealt by its hash.
3. Deep-shallow sort.  Contexts of one gram are sorted: multikey quicksort over 8-byte keys to a shallow depth of 40
   bytes, then a blind trie orders each group that is still equal.  Contexts that end in one leaf are equal, byte for
   byte; all but those of the smallest id are hits.  The different contexts' strings of one gram and place are then
   sorted in the same way, for contexts that agree in a part.  (Within a batch, contexts whose gram several ids have are
   sorted before they leave, so what a third of all texts hold travels once a batch.)
4. Hits, grouped by document, meet the texts; covered bytes merge into maximal runs.

Hashes pick buckets and drop grams that one id has; every removal comes out of a leaf of the sort.

Defined results: a null text is empty; texts of fewer than 50 bytes are kept; rows with a null id are kept whole and
count for nobody; rows that share an id never remove each other's bytes; ids are whole numbers (another type raises
``TypeError``); a single long text is one batch; an empty table gives no rows; other columns are not passed on, and may have any name.  The kept bytes
may be cut inside a character.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel
from caseweave.llm import _repeats as repeats
from caseweave.llm._repeats import runs, spread

SIZE = 50
GRAM = 20
REACH = SIZE - GRAM
#: Bytes that a context reaches at most.
WIDTH = SIZE + REACH
SHALLOW_KEYS = 5
#: Rows that one call sorts at a time, if no single group is larger.
SORT_AT_ONCE = 200_000
#: Contexts of a bucket that are compared together, if no single gram has more, and strings that are made of them at a time.
CONTEXTS_AT_ONCE, STRINGS_AT_ONCE = 65_536, 500_000
#: Contexts whose bytes are looked up together: bounds the tables of a 64-bit place for each byte.
PLACES_AT_ONCE = 8192
#: Bytes of text whose anchors are packed together.
AT_ONCE = 4_000_000
#: Bytes of text whose anchors are found together: bounds the tables of 64-bit values for each byte.
FIND_AT_ONCE = 1_000_000
NO_GRAM = np.uint64(2**64 - 1)
U = np.uint64
I64, I32 = pa.int64(), pa.int32()
CONTEXTS = "bucket int, ids array<long>, texts array<long>, starts array<int>, masks array<int>, bytes binary"


class _Anchors:
    """Anchors of a batch of texts: place, gram hash and text."""

    def __init__(self):
        self.gram = kernel.Rolling(31)

    def parts(self, column: pa.Array) -> Iterator[tuple[int, int]]:
        """Some texts at a time: the first one's row and byte, for each the anchors are here, counted from them."""
        self.buf, self.offsets = kernel.flat(column)
        row = 0
        while row < len(self.offsets) - 1:
            end = max(row + 1, int(np.searchsorted(self.offsets, self.offsets[row] + FIND_AT_ONCE, "right")) - 1)
            self._find(self.buf[self.offsets[row] : self.offsets[end]], self.offsets[row : end + 1] - self.offsets[row])
            self.rows = end - row
            yield row, int(self.offsets[row])
            row = end

    def grams_of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text and gram of each anchor."""
        found = [(self.text + row, self.grams) for row, _ in self.parts(column)]
        return tuple(np.concatenate(c) for c in zip((np.zeros(0, np.int64), np.zeros(0, U)), *found, strict=True))

    def _find(self, buf: np.ndarray, offsets: np.ndarray) -> None:
        n = len(buf)
        if n < SIZE:
            self.at = self.text = np.zeros(0, np.int64)
            self.grams = np.zeros(0, U)
            return
        text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        grams = kernel.mixed(self.gram.windows(self.gram.prefix(buf), GRAM))
        grams[text[: n - GRAM + 1] != text[GRAM - 1 :]] = NO_GRAM
        self.least = kernel.sliding(grams, REACH + 1, np.minimum)
        self.whole = text[: n - SIZE + 1] == text[SIZE - 1 :]
        reached = np.zeros(n - GRAM + 1 + REACH, U)
        reached[REACH : REACH + len(self.least)] = np.where(self.whole, self.least, U(0))
        at = np.flatnonzero(kernel.sliding(reached, REACH + 1, np.maximum) == grams)
        self.at = at[grams[at] != NO_GRAM]
        self.text, self.grams = text[self.at].astype(np.int64), grams[self.at]

    def masks(self, k: np.ndarray) -> np.ndarray:
        """Bit ``b`` of an anchor's mask: it is the anchor of the string that starts ``b`` bytes before it."""
        at, masks = self.at[k], np.zeros(len(k), np.int64)
        for back in range(REACH + 1):
            i = at - back
            fits = (i >= 0) & (i < len(self.least))
            j = np.where(fits, i, 0)
            masks |= (fits & self.whole[j] & (self.least[j] == self.grams[k])).astype(np.int64) << back
        return masks


def _reach(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes before the anchor and from it on that the strings of a mask reach."""
    lowest = np.bitwise_count((masks & -masks) - 1).astype(np.int64)
    highest = np.frexp(masks.astype(np.float64))[1].astype(np.int64) - 1
    return highest, SIZE - lowest


def _string_places(masks: np.ndarray, low: int = 0, high: int = REACH + 1) -> tuple[np.ndarray, np.ndarray]:
    """Row and bit of each bit that is set, of the bits from ``low`` to below ``high``."""
    row, bit = np.nonzero((masks[:, None] >> np.arange(low, min(high, REACH + 1))) & 1)
    return row, bit + low


def multikey_quicksort(keys: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows of ``keys`` by group and their first ``depth`` keys, and where the classes of equal rows begin.

    All groups are split at once: in each round, every unsorted segment takes its middle row's key as pivot and is
    parted in three; the middle part is done with this key and moves on to the next.
    """
    order = np.argsort(group, kind="stable")
    segment = np.cumsum(np.r_[0, group[order][1:] != group[order][:-1]]) if len(order) else order
    for column in range(depth):
        open_ = np.ones(len(order), bool)
        while True:
            sizes = np.bincount(segment) if len(segment) else np.zeros(0, int)
            begin = np.cumsum(sizes) - sizes
            live = np.flatnonzero(open_ & (sizes[segment] > 1)) if len(segment) else segment
            if not len(live):
                break
            values, mine = keys[order[live], column], segment[live]
            pivot = keys[order[begin[mine] + sizes[mine] // 2], column]
            part = np.where(values < pivot, 0, np.where(values == pivot, 1, 2))
            new = segment * 3 + 1
            new[live] = mine * 3 + part
            open_[live] = part != 1
            by = np.argsort(new, kind="stable")
            order, new, open_ = order[by], new[by], open_[by]
            segment = np.cumsum(np.r_[0, new[1:] != new[:-1]])
    return order, segment


class BlindTrie:
    """Patricia trie over strings of one length: nodes hold a place and one child a byte, leaves hold equal strings."""

    def __init__(self, strings: list[bytes]):
        self.strings = strings
        self.root: list | tuple = [0]  # a leaf is a list of rows; a node is (place, children)
        for row in range(1, len(strings)):
            self._add(row)

    def _add(self, row: int) -> None:
        string, node = self.strings[row], self.root
        while isinstance(node, tuple):  # blindly: bytes between branches are not looked at
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        other = self.strings[node[0]]
        if other == string:
            node.append(row)
            return
        place = next(i for i, (a, b) in enumerate(zip(string, other, strict=True)) if a != b)
        parent, node = None, self.root
        while isinstance(node, tuple) and node[0] < place:
            parent, node = node, node[1][string[node[0]]]
        if isinstance(node, tuple) and node[0] == place:
            node[1][string[place]] = [row]
            return
        split = (place, {string[place]: [row], other[place]: node})
        if parent:
            parent[1][string[parent[0]]] = split
        else:
            self.root = split

    def leaves(self) -> list[list[int]]:
        """Classes of equal strings in order."""
        out, stack = [], [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node, tuple):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                out.append(node)
        return out


def deep_shallow(rows: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Deep-shallow sort of rows of bytes within groups: a number for each row, equal for equal rows of a group."""
    n, width = rows.shape
    padded = np.zeros((n, -(-width // 8) * 8), np.uint8)
    padded[:, :width] = rows
    order, segment = multikey_quicksort(padded.view(">u8").astype(U), group, SHALLOW_KEYS)
    starts = runs(segment)
    sizes = np.diff(np.r_[starts, n])
    split = np.zeros(n, bool)  # where a new class begins, in the final order
    split[starts] = True
    tail = rows[:, SHALLOW_KEYS * 8 :]
    unlike = (tail[order] != tail[np.repeat(order[starts], sizes)]).any(axis=1)
    mixed = np.logical_or.reduceat(unlike, starts) if n else np.zeros(0, bool)  # a group of equal rows is one leaf
    two = starts[mixed & (sizes == 2)]
    split[two + 1] = True
    for start, size in zip(starts[mixed & (sizes > 2)].tolist(), sizes[mixed & (sizes > 2)].tolist(), strict=True):
        own, place = order[start : start + size].copy(), start
        for leaf in BlindTrie([tail[r].tobytes() for r in own]).leaves():
            order[place : place + len(leaf)] = own[leaf]
            split[place] = True
            place += len(leaf)
    classes = np.zeros(n, np.int64)
    classes[order] = np.cumsum(split)
    return classes


def _together(starts: np.ndarray, n: int, limit: int) -> Iterator[tuple[int, int]]:
    """Whole runs put together to parts of at most ``limit`` places, or of a single run: where each part begins and ends."""
    ends, begin = np.r_[starts[1:], n], 0
    while begin < n:
        end = int(ends[max(np.searchsorted(ends, begin + limit, "right") - 1, np.searchsorted(ends, begin, "right"))])
        yield begin, end
        begin = end


def _least_of_equal(ids: np.ndarray, group: np.ndarray, rows_of) -> np.ndarray:
    """For each entry the smallest id among the equal entries of its group.

    Groups are sorted some at a time; ``rows_of`` gives the bytes of the entries asked for.  A group that one
    id has holds no hit and isn't sorted.
    """
    least = ids.copy()
    order = np.argsort(group, kind="stable")
    order = order[repeats.several(ids[order], runs(group[order]))]
    for begin, end in _together(runs(group[order]), len(order), SORT_AT_ONCE):
        own = order[begin:end]
        classes = deep_shallow(rows_of(own), group[own])
        smallest = np.full(classes.max() + 1, np.iinfo(np.int64).max)
        np.minimum.at(smallest, classes, ids[own])
        least[own] = smallest[classes]
    return least


def _context_rows(buf: np.ndarray, at: np.ndarray, masks: np.ndarray) -> np.ndarray:
    """Contexts as rows of equal width: the mask, and the bytes around the anchor, zero where a context doesn't reach."""
    rows, column = np.zeros((len(at), WIDTH + 4), np.uint8), np.arange(WIDTH) - REACH
    for k in range(0, len(at), PLACES_AT_ONCE):
        some = slice(k, k + PLACES_AT_ONCE)
        before, after = _reach(masks[some])
        inside = (column >= -before[:, None]) & (column < after[:, None])
        rows[some, :WIDTH] = np.where(inside, buf[np.where(inside, at[some, None] + column, 0)], 0)
    rows[:, WIDTH:] = masks.astype("<u4").view(np.uint8).reshape(-1, 4)
    return rows


def _spans_of(buf: np.ndarray, begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The bytes of spans, one after the other."""
    stops = np.cumsum(sizes)
    out = np.empty(int(stops[-1]), np.uint8)
    for k in range(0, len(begin), PLACES_AT_ONCE):
        some = slice(k, k + PLACES_AT_ONCE)
        first, last = int(stops[k] - sizes[k]), int(stops[some][-1])
        out[first:last] = buf[np.repeat(begin[some] - (stops[some] - sizes[some]), sizes[some]) + np.arange(first, last)]
    return out


def _group(grams: np.ndarray, masks: np.ndarray) -> np.ndarray:
    return kernel.mixed(grams + masks.astype(U) * U(0xD6E8FEB86659FD93))


def _count(batches):
    anchors = _Anchors()
    yield from repeats.counts_of(batches, lambda batch: anchors.grams_of(batch.column(2))[1])


def _pack(batches, buckets: repeats.Buckets):
    anchors = _Anchors()
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        text, grams = anchors.grams_of(batch.column(2))
        if len(text):
            ids, texts, new = repeats.once(batch)
            k = np.flatnonzero(new[text])
            text, grams = text[k], grams[k]
            yield repeats.pack(ids[text], texts[text], grams, buckets.split(grams, kernel.mixed(grams)), buckets.n)


def _fetch(batches, buckets: repeats.Buckets):
    """Contexts of shared grams, one row for each bucket; hits found in the batch travel in buckets below zero."""
    anchors, strings, pressed = _Anchors(), kernel.Rolling(32), zstandard.ZstdCompressor(3)
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        if batch.column(3).null_count == batch.num_rows:
            continue
        a, (ids, texts, new), found = anchors, repeats.once(batch), []
        for row, byte in a.parts(batch.column(2)):
            k = np.flatnonzero(repeats.asked(a.grams, a.text, batch.column(3).slice(row, a.rows)) & new[a.text + row])
            found.append((a.masks(k), a.at[k] + byte, a.text[k] + row, a.grams[k]))
        masks, at, text, grams = (np.concatenate(c) for c in zip(*found, strict=True))
        if not len(at):
            continue
        bucket = buckets.whole(grams)
        if (bucket < 0).any():  # a gram too frequent for one bucket: its strings go by themselves, dealt by their hash
            alone = np.flatnonzero(bucket < 0)
            row, back = _string_places(masks[alone])
            row = alone[row]
            sums = strings.prefix(a.buf)
            hashes = kernel.mixed(strings.spans(sums, at[row] - back, at[row] - back + SIZE))
            keep = np.flatnonzero(bucket >= 0)
            bucket = np.r_[bucket[keep], buckets.split(grams[row], hashes)]
            masks = np.r_[masks[keep], np.int64(1) << back]
            at, text, grams = (np.r_[x[keep], x[row]] for x in (at, text, grams))
        own = ids[text]
        least = _least_of_equal(own, _group(grams, masks), lambda i, m=masks, p=at, b=a.buf: _context_rows(b, p[i], m[i]))
        bucket = np.where(own > least, -1 - text % buckets.n, bucket)
        order = np.lexsort((at, bucket))
        bucket, masks, at, text = bucket[order], masks[order], at[order], text[order]
        edges = runs(bucket)
        ends = np.r_[edges[1:], len(bucket)]
        before, after = _reach(masks)
        sizes = np.where(bucket < 0, 0, before + after)
        stops = np.cumsum(sizes)
        data = _spans_of(a.buf, at - before, sizes)
        bounds = np.r_[0, stops]
        blobs = [pressed.compress(data[x:y]) if x < y else b"" for x, y in zip(bounds[edges].tolist(), bounds[ends].tolist(), strict=True)]
        columns = [(ids[text], I64), (texts[text], I64), (at - a.offsets[text], I32), (masks, I32)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[edges], I32), *(kernel.lists(c.astype(t.to_pandas_dtype()), ends - edges, t) for c, t in columns), pa.array(blobs, pa.binary())],
            ["bucket", "ids", "texts", "starts", "masks", "bytes"],
        )


def _found(ids: np.ndarray, masks: np.ndarray, grams: np.ndarray, at: np.ndarray, buf: np.ndarray) -> np.ndarray:
    """For each context the mask of its strings that start in a smaller id too; the contexts are all those of their grams."""
    least = _least_of_equal(ids, _group(grams, masks), lambda i: _context_rows(buf, at[i], masks[i]))
    found = np.where(ids > least, masks, 0)
    # The different contexts, for their smallest id: strings of one gram and place, for contexts that agree in a part.
    shared = np.flatnonzero(ids == least)
    windows, bits = np.lib.stride_tricks.sliding_window_view(buf, SIZE), max(1, STRINGS_AT_ONCE // len(shared))
    for low in range(0, REACH + 1, bits):
        row, back = _string_places(masks[shared], low, low + bits)
        row = shared[row]
        string = at[row] - back
        smallest = _least_of_equal(ids[row], _group(grams[row], back), lambda i, s=string: windows[s[i]])
        hit = ids[row] > smallest
        np.bitwise_or.at(found, row[hit], np.int64(1) << back[hit])
    return found


def _sort(bucket: int, table: pa.Table, spread_over: int) -> pa.Table:
    """Hits among one bucket's contexts: bytes of the strings that start in a smaller id too.

    The strings of one context start within ``REACH`` bytes, so what they cover is one interval.  Beside the contexts
    themselves only what belongs to some grams at a time is held.
    """
    (ids, counts), (texts, _), (starts, _), (masks, _) = (kernel.flat_lists(table.column(c)) for c in ("ids", "texts", "starts", "masks"))
    masks = masks.astype(np.int64)
    if bucket >= 0:
        opened, gram = zstandard.ZstdDecompressor(), kernel.Rolling(31)
        before, after = _reach(masks)
        stops = np.cumsum(before + after)
        at, buf, grams, row, place = stops - after, np.empty(int(stops[-1]), np.uint8), np.empty(len(ids), U), 0, 0
        for n, blob in zip(counts.tolist(), table.column("bytes"), strict=True):  # what one batch of texts sent
            data = np.frombuffer(opened.decompress(blob.as_py()), np.uint8)
            own = at[row : row + n] - place
            grams[row : row + n] = gram.spans(gram.prefix(data), own, own + GRAM)
            buf[place : place + len(data)] = data
            row, place = row + n, place + len(data)
        grams = kernel.mixed(grams)
        order = np.argsort(grams, kind="stable")
        order = order[repeats.several(ids[order], runs(grams[order]))]
        found = np.zeros(len(ids), np.int64)
        for begin, end in _together(runs(grams[order]), len(order), CONTEXTS_AT_ONCE):
            own = order[begin:end]
            found[own] = _found(ids[own], masks[own], grams[own], at[own], buf)
        k = np.flatnonzero(found)
        ids, texts, starts, masks = ids[k], texts[k], starts[k], found[k]
    before, after = _reach(masks)
    return repeats.answers(ids, texts, {"starts": starts - before, "lengths": before + after}, spread_over)


def _cut(batches):
    """Texts without the covered bytes."""
    for batch in kernel.chunks(batches, "text", FIND_AT_ONCE):
        buf, offsets = kernel.flat(batch.column(1))
        (starts, counts), (lengths, _) = repeats.numbers(batch.column(2)), repeats.numbers(batch.column(3))
        gone = kernel.covered(starts + np.repeat(offsets[:-1], counts), lengths, len(buf))
        sums = np.r_[0, np.cumsum(gone)]
        removed = sums[offsets[1:]] - sums[offsets[:-1]]
        begins = gone.copy()
        begins[1:] &= ~gone[:-1]
        heads = offsets[:-1][np.diff(offsets) > 0]
        begins[heads] = gone[heads]
        spans = np.r_[0, np.cumsum(begins)]
        ends = np.r_[0, np.cumsum(np.diff(offsets) - removed)].astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(np.diff(offsets), I64),
                pa.array(removed, I64),
                pa.array(spans[offsets[1:]] - spans[offsets[:-1]], I64),
                pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends), pa.py_buffer(buf[~gone])]),
            ],
            ["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def suffix_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", pieces: int = repeats.BUCKET_PIECES // 2) -> DataFrame:
    """One row per row of ``docs``: the id, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary)."""
    source = repeats.whole_number(docs, key, text)
    filled = source.where("id is not null and text is not null")
    buckets = repeats.planned(filled.mapInArrow(_count, repeats.COUNTED), pieces)
    packed = filled.mapInArrow(lambda b: _pack(b, buckets), repeats.PACKED)
    met = repeats.meet(source, repeats.shared_hashes(packed, buckets), buckets)
    contexts = met.mapInArrow(lambda b: _fetch(b, buckets), CONTEXTS)
    spans = repeats.spans(contexts, buckets, lambda k, t: _sort(k, t, buckets.n))
    last = repeats.meet(source, spans, buckets).select("id", "text", "starts", "lengths")
    return last.mapInArrow(_cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary").withColumnRenamed("id", key)


def suffix_dedup_query(docs: DataFrame) -> DataFrame:
    out = suffix_dedup(docs)
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, substr(h, 2 * i + 1, 100) AS g
      FROM (SELECT r, doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM t WHERE length(h) >= 100 AND doc_id IS NOT NULL)),
hit AS (SELECT r, i FROM w QUALIFY doc_id > min(doc_id) OVER (PARTITION BY g)),
runs AS (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM hit),
numbered AS (SELECT r, i, sum(new) OVER (PARTITION BY r ORDER BY i) AS k FROM runs),
spans AS (SELECT r, k, min(i) AS s, max(i) + 50 AS e FROM numbered GROUP BY r, k),
sums AS (SELECT r, count(*) AS n, sum(e - s) AS m FROM spans GROUP BY r),
gaps AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS a, s AS b FROM spans
         UNION ALL SELECT r, max(e), CAST(1e15 AS BIGINT) FROM spans GROUP BY r),
kept AS (SELECT r, string_agg(substr(h, 2 * a + 1, 2 * (least(b, length(h) // 2) - a)), '' ORDER BY a) AS h
         FROM gaps JOIN t USING (r) GROUP BY r)
SELECT doc_id, CAST(length(t.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(m, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.h, t.h))) AS kept_sha256
FROM t LEFT JOIN sums USING (r) LEFT JOIN kept USING (r)
"""

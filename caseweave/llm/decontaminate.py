"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training windows.

Texts are lower-cased (A-Z only) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.  A benchmark item gives its
windows of 13 words; an item of fewer words, but not none, is one window.  Each document's word windows are rolled into
64-bit hashes and looked up in the sorted hash set; a found window is compared with the item's words, so no hash
collision counts.  A word inside any occurrence of a window is hit.  A document is contaminated when at least one word
in twenty is hit; a pipeline drops such documents, or takes ``clean_text``, the text without its hit words.

The set is broadcast only if the benchmark's texts and ids are at most ``broadcast_bytes``, which is measured first; it is
held in arrays of some six times that size (``NgramSet``).  With a larger benchmark, each document's distinct windows whose
hash passes a filter of fixed size are shuffled to the items' distinct windows and joined on their words, the frequent ones
salted: same result, any size.  Both ways a window that many items share is one entry; its items are looked up after the
search, once for each set of windows that documents have.

Defined results: null and empty texts have no words and are clean; rows with equal ids are judged each for itself; a
null id is passed on; repeated benchmark rows count once for each item id; items without words, or without id, are left
out of the item list (the words of an item without id still count as hits); ids of documents and items may have any
type, an item's is named as text; a single long text is one batch; an empty table of documents gives no rows, one of items
no hits; other columns of ``docs``, whatever their names, are passed on with ``keep`` (but those that a result's name replaces).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel
from caseweave.llm._spark import checkpointed

WINDOW_WORDS = 13
BROADCAST_BYTES = 32_000_000
#: Bits of the filter that is broadcast where the set isn't: 16 MB.
FILTER_BITS = 1 << 27
#: Bytes of text whose windows are looked up together.
AT_ONCE = 1_000_000
#: Sets of windows whose items a task remembers.
KNOWN_SETS = 4096
#: Beyond the bound, rows of one window (one a document) that are joined together, about.
TASK_HITS = 100_000
#: Digest of no items.
NO_ITEMS = hashlib.sha256(b"").hexdigest()
U = np.uint64
I64 = pa.int64()

#: Every byte of a word as it is after lower-casing, every other byte as a space.
NORMAL = bytes(kernel.LOWER[b] if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= kernel.LOWER[b] <= 0x7A else 0x20 for b in range(256))
NORMAL_ARRAY = np.frombuffer(NORMAL, np.uint8)


class _Roll:
    def __init__(self):
        self.of_bytes, self.of_words = kernel.Rolling(21), kernel.Rolling(22)

    def words(self, column: pa.Array):
        buf, offsets = kernel.flat(column)
        buf = NORMAL_ARRAY[buf]
        starts, ends, first = kernel.words(buf, offsets)
        values = kernel.mixed(self.of_bytes.spans(self.of_bytes.prefix(buf), starts, ends))
        return buf, starts, ends, first, self.of_words.prefix(values)

    def windows(self, sums: np.ndarray, n: int) -> np.ndarray:
        return kernel.mixed(self.of_words.windows(sums, n))


def _item_windows(first: np.ndarray, size: int):
    """For each length of window: the length, the first word of each window and the item it is of."""
    counts = np.diff(first)
    length = np.minimum(size, counts)
    for n in np.unique(length[length > 0]).tolist():
        items = np.flatnonzero(length == n)
        many = counts[items] - n + 1
        ahead = np.cumsum(many) - many
        yield n, np.repeat(first[:-1][items] - ahead, many) + np.arange(many.sum()), np.repeat(items, many)


def _gram(data: bytes, starts: np.ndarray, ends: np.ndarray, at: int, n: int) -> bytes:
    return b" ".join([data[s:e] for s, e in zip(starts[at : at + n].tolist(), ends[at : at + n].tolist(), strict=True)])


class NgramSet:
    """Distinct windows of a bounded set of benchmark items: by length, sorted hashes, first words and lists of item numbers.

    The items' words are held once, as bytes and the start and end of each, so that the set takes some six times the
    bytes of the items' texts.  A window that many items share is one entry with a run of ``owners``.
    """

    def __init__(self, names: list, column: pa.Array, size: int):
        roll, self.names = _Roll(), names
        buf, starts, ends, first, sums = roll.words(column)
        data, self.tables = buf.tobytes(), []
        for n, at, items in _item_windows(first, size):
            hashes = roll.windows(sums, n)[at]
            order = np.argsort(hashes, kind="stable")
            hashes, at, items = hashes[order], at[order], items[order]
            new = np.r_[True, hashes[1:] != hashes[:-1]]
            edges = np.append(np.flatnonzero(new), len(hashes))
            for k in np.flatnonzero(np.diff(edges) > 1).tolist():  # equal hashes: windows are told apart by their words
                span = slice(edges[k], edges[k + 1])
                grams = [_gram(data, starts, ends, i, n) for i in at[span].tolist()]
                if len(set(grams)) > 1:
                    again = sorted(range(len(grams)), key=grams.__getitem__)
                    at[span], items[span] = at[span][again], items[span][again]
                    new[span] = [i == 0 or grams[again[i]] != grams[again[i - 1]] for i in range(len(again))]
            heads = np.flatnonzero(new)
            self.tables.append((n, hashes[heads], at[heads].astype(np.int32), np.append(heads, len(hashes)).astype(np.int32), items.astype(np.int32)))
        del sums
        self.buf, self.starts, self.ends = buf, starts.astype(np.int32), ends.astype(np.int32)

    @property
    def nbytes(self) -> int:
        return sum(x.nbytes for x in (self.buf, self.starts, self.ends)) + sum(x.nbytes for t in self.tables for x in t[1:])

    def items(self, windows: tuple) -> tuple[int, str]:
        """Number of the items that have some of the windows ``(table, entry)``, and their ids' digest."""
        owners = [self.tables[t][4][self.tables[t][3][k] : self.tables[t][3][k + 1]] for t, k in windows]
        found = sorted({self.names[k] for k in np.unique(np.concatenate(owners)).tolist()} - {None})
        return len(found), hashlib.sha256(",".join(found).encode()).hexdigest()


def _scan(batches, shared):
    """Per document: number of words, hit words (merged, as starts and ends), number and digest of the items found.

    An occurrence of a window costs one comparison of words, however many items share it; a set of windows is turned
    into items once for all documents of the task that have the same set (or until too many sets are remembered).
    """
    roll, found_in, known = _Roll(), shared.value, {}
    item_data = found_in.buf.tobytes()
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        buf, starts, ends, first, sums = roll.words(batch.column(1))
        data, n_docs = buf.tobytes(), batch.num_rows
        text = np.repeat(np.arange(n_docs), np.diff(first))
        edges = np.zeros(len(starts) + 1, np.int64)
        windows: dict[int, set] = {}
        for table, (n, hashes, places, _, _) in enumerate(found_in.tables):
            h = roll.windows(sums, n)
            place = np.searchsorted(hashes, h)
            place[place == len(hashes)] = 0
            for i in np.flatnonzero((hashes[place] == h) & (text[: len(h)] == text[n - 1 :])).tolist():
                gram, k = _gram(data, starts, ends, i, n), int(place[i])
                while k < len(hashes) and hashes[k] == h[i]:  # one entry, but for colliding hashes
                    if _gram(item_data, found_in.starts, found_in.ends, int(places[k]), n) == gram:
                        edges[i] += 1
                        edges[i + n] -= 1
                        windows.setdefault(int(text[i]), set()).add((table, k))
                    k += 1
        inside, spans_s, spans_e, counts = np.cumsum(edges[:-1]) > 0, [], [], np.zeros(n_docs, np.int64)
        n_items, digests = np.zeros(n_docs, np.int64), [NO_ITEMS] * n_docs
        for k in sorted(windows):  # only documents with a hit
            step = np.diff(np.r_[False, inside[first[k] : first[k + 1]], False].astype(np.int8))
            spans_s.append(np.flatnonzero(step == 1))
            spans_e.append(np.flatnonzero(step == -1))
            counts[k] = len(spans_s[-1])
            own = tuple(sorted(windows[k]))
            if own not in known:
                if len(known) >= KNOWN_SETS:
                    known.clear()
                known[own] = found_in.items(own)
            n_items[k], digests[k] = known[own]
        join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(np.diff(first), I64), kernel.lists(join(spans_s), counts, I64), kernel.lists(join(spans_e), counts, I64), pa.array(n_items), pa.array(digests)],
            [*batch.schema.names, "n_words", "span_starts", "span_ends", "n_items", "items_sha256"],
        )


def _grams_of_items(batches, size: int):
    """Each window of each item: its length, hash, words and item."""
    roll = _Roll()
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        buf, starts, ends, first, sums = roll.words(batch.column(1))
        data = buf.tobytes()
        for n, at, items in _item_windows(first, size):
            grams = [_gram(data, starts, ends, i, n) for i in at.tolist()]
            arrays = [pa.array(np.full(len(at), n), pa.int32()), pa.array(roll.windows(sums, n)[at].view(np.int64), I64), pa.array(grams, pa.binary())]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(0).take(pa.array(items))], ["n", "hash", "gram", "item"])


def _filter_bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return hashes & U(FILTER_BITS - 1), (hashes >> U(32)) & U(FILTER_BITS - 1)


def _grams_of_documents(batches, lengths: list, shared):
    """Of each document its distinct windows whose hash passes the filter of the items' hashes, with their places."""
    roll, bits = _Roll(), shared.value
    passes = lambda b: (bits[b >> U(6)] >> (b & U(63))) & U(1) == 1
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        buf, starts, ends, first, sums = roll.words(batch.column(1))
        data, text = buf.tobytes(), np.repeat(np.arange(batch.num_rows), np.diff(first))
        for n in lengths:
            h = roll.windows(sums, n)
            one, two = _filter_bits(h)
            found: dict[tuple[int, bytes], list[int]] = {}
            for i in np.flatnonzero(passes(one) & passes(two) & (text[: len(h)] == text[n - 1 :])).tolist():
                found.setdefault((int(text[i]), _gram(data, starts, ends, i, n)), []).append(i)
            row = pa.array([r for r, _ in found], pa.int32())
            hashes = h[[p[0] for p in found.values()]].view(np.int64)
            places = [[i - first[r] for i in p] for (r, _), p in found.items()]
            arrays = [pa.array(np.full(len(found), n), pa.int32()), pa.array(hashes, I64), pa.array([g for _, g in found], pa.binary()), pa.array(places, pa.list_(I64))]
            yield pa.RecordBatch.from_arrays([*arrays, batch.column(0).take(row), batch.column(2).take(row)], ["n", "hash", "gram", "places", "found_id", "found_hash"])


def _count_words(batches):
    roll = _Roll()
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        yield batch.append_column("n_words", pa.array(np.diff(roll.words(batch.column(1))[3]), I64))


def _by_shuffle(source: DataFrame, bench: DataFrame, columns: str, size: int) -> DataFrame:
    """What ``_scan`` finds, for any size of benchmark: windows meet the items' windows by a join on their words.

    A filter of the items' hashes, of a fixed size, keeps most windows of the documents from the shuffle.
    """
    grams = checkpointed(bench.mapInArrow(lambda b: _grams_of_items(b, size), "n int, hash long, gram binary, item string"))
    lengths = sorted(r["n"] for r in grams.select("n").distinct().collect())  # at most ``size`` rows
    low, high = F.col("hash").bitwiseAND(F.lit(FILTER_BITS - 1)), F.shiftrightunsigned("hash", 32).bitwiseAND(F.lit(FILTER_BITS - 1))
    bit = grams.select(F.explode(F.array(low, high)).alias("bit"))
    words = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")).toArrow()
    table = np.zeros(FILTER_BITS // 64, U)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(U)
    shared = source.sparkSession.sparkContext.broadcast(table)
    items = checkpointed(grams.groupBy("n", "hash", "gram").agg(F.collect_set("item").alias("items")).withColumn("window", F.monotonically_increasing_id()))  # null items are left out
    hashed = source.select("id", "text", F.xxhash64("text").alias("text_hash"))
    kind = source.schema["id"].dataType.simpleString()
    mine = hashed.mapInArrow(lambda b: _grams_of_documents(b, lengths, shared), f"n int, hash long, gram binary, places array<long>, found_id {kind}, found_hash long")
    mine = checkpointed(mine)
    # Windows meet without their items.  One that a great many documents have is dealt to several tasks.
    hot = mine.groupBy("n", "hash").agg(F.floor(F.count(F.lit(1)) / TASK_HITS).alias("more")).where("more > 0")
    salts = items.select("n", "hash", "gram", "window").join(hot, ["n", "hash"], "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("more", F.lit(0).cast("long")))))
    salted = mine.join(hot, ["n", "hash"], "left").withColumn("salt", F.pmod(F.xxhash64("found_id", "found_hash"), F.coalesce("more", F.lit(0).cast("long")) + 1))
    hits = salted.drop("more").join(salts.drop("more"), ["n", "hash", "gram", "salt"])
    spans = hits.groupBy("found_id", "found_hash").agg(
        F.collect_set(F.struct("n", "places")).alias("found"), F.array_sort(F.collect_set("window")).alias("windows")
    )
    starts = F.flatten(F.transform("found", lambda f: f.places))
    ends = F.flatten(F.transform("found", lambda f: F.transform(f.places, lambda x: x + f.n)))
    by_row = checkpointed(spans.select("found_id", "found_hash", starts.alias("span_starts"), ends.alias("span_ends"), "windows"))
    # Each set of windows is turned into items once, however many documents have it.
    sets = by_row.select("windows").distinct().select("windows", F.explode("windows").alias("window")).join(items.select("window", "items"), "window")
    named = sets.groupBy("windows").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    named = named.select("windows", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"))
    by_row = by_row.join(named, "windows").drop("windows")
    counted = source.mapInArrow(_count_words, f"{columns}, n_words bigint").withColumn("text_hash", F.xxhash64("text"))
    same = F.col("id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash"))
    return counted.join(by_row, same, "left").drop("found_id", "found_hash", "text_hash")


def _merge(starts: list, ends: list) -> tuple[list, list]:
    merged: list[list[int]] = []
    for s, e in sorted(zip(starts, ends, strict=True)):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e])
    return [m[0] for m in merged], [m[1] for m in merged]


def _verdict(batches, min_share: int, with_cut: bool, keep: bool):
    """From the found spans to counts, the verdict and, if asked for, the text without its hit words."""
    for batch in batches:
        used = [c for c in ("n_words", "span_starts", "span_ends", "n_items", "items_sha256", "text") if c != "text" or with_cut]
        rows = batch.select(used).to_pydict()
        out: dict[str, list] = {c: [] for c in ("n_hit", "n_items", "items_sha256", "contaminated", "clean_text")}
        for k in range(batch.num_rows):
            starts, ends = _merge(rows["span_starts"][k] or [], rows["span_ends"][k] or [])
            n_hit = sum(ends) - sum(starts)
            bad = n_hit > 0 and min_share * n_hit >= rows["n_words"][k]
            out["n_hit"].append(n_hit)
            out["n_items"].append(rows["n_items"][k] or 0)
            out["items_sha256"].append(rows["items_sha256"][k] or NO_ITEMS)
            out["contaminated"].append(bad)
            if with_cut:
                out["clean_text"].append(_without(rows["text"][k], starts, ends) if starts else rows["text"][k])
        columns = [batch.column(batch.schema.get_field_index(c)) for c in ("id", "n_words")]
        columns += [pa.array(out["n_hit"], I64), pa.array(out["n_items"], I64), pa.array(out["items_sha256"], pa.string()), pa.array(out["contaminated"], pa.bool_())]
        names = ["id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
        if with_cut:
            columns, names = [*columns, pa.array(out["clean_text"], pa.string())], [*names, "clean_text"]
        rest = [c for c in batch.schema.names if c.startswith("__kept_") or (c == "text" and keep)]
        yield pa.RecordBatch.from_arrays([*columns, *(batch.column(batch.schema.get_field_index(c)) for c in rest)], [*names, *rest])


def _without(text: str, starts: list, ends: list) -> str:
    """The text without the words of the spans; what stands between words that stay is left as it is."""
    data = text.encode()
    s, e, _ = kernel.words(NORMAL_ARRAY[np.frombuffer(data, np.uint8)], np.array([0, len(data)]))
    parts, at = [], 0
    for a, b in zip(starts, ends, strict=True):
        parts.append(data[at : s[a]])
        at = int(e[b - 1])
    return b"".join([*parts, data[at:]]).decode()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", item: str = "item_id",
    size: int = WINDOW_WORDS, min_share: int = 20, keep: bool = False, with_cut: bool = False, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit``, ``n_items``, ``items_sha256``, ``contaminated``.

    ``with_cut`` adds ``clean_text``.  ``keep`` passes the other columns of ``docs`` on, and its text.
    """
    others = [c for c in docs.columns if c not in (key, text)] if keep else []
    kept = {c: f"__kept_{k}" for k, c in enumerate(others)}
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"), *(F.col(c).alias(n) for c, n in kept.items()))
    bench = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("text")).where("text is not null").distinct()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields)
    total = bench.agg(F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item"), F.lit(0)) + 64).alias("n")).first()["n"] or 0
    if total <= broadcast_bytes:
        items = bench.toArrow().combine_chunks()
        shared = docs.sparkSession.sparkContext.broadcast(NgramSet(items.column("item").to_pylist(), items.column("text"), size))
        found = "n_words bigint, span_starts array<bigint>, span_ends array<bigint>, n_items bigint, items_sha256 string"
        scanned = source.mapInArrow(lambda b: _scan(b, shared), f"{columns}, {found}")
    else:
        scanned = _by_shuffle(source, bench, columns, size)
    id_type = source.schema["id"].dataType.simpleString()
    out = f"id {id_type}, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean" + ", clean_text string" * with_cut
    out += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields if f.name != "id" and (keep or f.name != "text"))
    judged = scanned if with_cut or keep else scanned.drop("text")
    judged = judged.mapInArrow(lambda b: _verdict(b, min_share, with_cut, keep), out)
    results = [c for c in ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "clean_text") if c in judged.columns]
    names = {key: "id"} | ({text: "text"} | kept if keep else {})
    order = [c for c in docs.columns if c in names and c not in results]
    return judged.select(*(F.col(names[c]).alias(c) for c in order), *results)


def decontaminate_query(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    return decontaminate(docs, benchmark)


ORACLE_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
b AS (SELECT DISTINCT item_id, list_filter(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
g AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS g
      FROM (SELECT item_id, ws, least(13, len(ws)) AS n, unnest(range(1, len(ws) - least(13, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
w AS (SELECT r, i, n, array_to_string(ws[i:i + n - 1], ' ') AS g
      FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM g) WHERE len(ws) >= n)),
h AS (SELECT r, i, n, item_id FROM w JOIN g USING (n, g)),
hits AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + n)) AS p FROM h) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(s, ',' ORDER BY s) AS s
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM h WHERE item_id IS NOT NULL) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AND 20 * coalesce(hits.n, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

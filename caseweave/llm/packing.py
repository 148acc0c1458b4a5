"""Packing: shortest-pack-first over the length histogram.

1. Tokens.  Each text becomes the ids of the given tokenizer and a closing id.  A document is cut into pieces of 2048
   ids and a rest.  Ids leave the task only as each piece's CRC-32 (or whole, with ``with_ids``).
2. Full pieces fill a sequence each.  They are numbered within their task, and the tasks one after the other, so they
   are neither shuffled nor ranked.
3. Histogram.  The other pieces are counted by length in Spark: fewer than 2048 rows, whatever the input.  On the
   driver, lengths are placed longest first, each into the open patterns with the most room left (the shortest packs);
   a pattern is a list of lengths and a count, so whole batches of equal packs change at once and the work does not grow
   with the input.
4. Ranks.  The patterns' places for one length are numbered in a row; so are the pieces of that length.  The numbering
   runs within salts of a length, as many as its count asks for, and a small table of counts shifts each salt to its
   place, so no length, however hot, is numbered in one task.  A broadcast join of the places (bounded by the
   histogram) gives each piece its sequence.

Defined results: a null or empty text has the closing id alone; repeated rows are packed each for itself; a null id is
passed on; an empty table gives no pieces; texts are encoded whole, however long; other columns are not looked at,
whatever their names.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel
from caseweave.llm._spark import checkpointed

SEQUENCE = 2048
END_ID = 1
#: Tasks at least that a length's pieces are numbered in, and pieces that are numbered together at most, about.
SALTS = 64
RANK_ROWS = 500_000
#: Words that a task remembers the ids of; as many older ones are kept until the newer ones are full.
CACHE_WORDS = 100_000
#: Bytes of text whose words are told apart together.
AT_ONCE = 1_000_000
TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordTokens(dict):
    """Ids of texts, with one remembered entry for each word (as it is after lower-casing, in bytes).

    For texts in plain Latin letters the tokenizer's own normal form is lower-casing, and it cuts words at fixed
    patterns before any merge; so a text's ids are those of its words, and the tokenizer's model is asked once a word.
    Words are cut, lower-cased and told apart for a whole batch at once.  Any other text (other scripts, control
    characters, special tokens' strings, letters whose lower case has another length) goes through the whole tokenizer.
    Tokenizers of another make always do.
    """

    #: The word pattern of this kind of tokenizer.
    WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
    #: Characters that words are cut from at once: ASCII, and what two bytes can hold up to this code point.
    LAST = 0x24F

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        super().__init__()
        self.older: dict[bytes, bytes] = {}
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        kinds = [x["type"] for x in (made.get("normalizer") or {}).get("normalizers", [])]
        splits = (made.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        self.by_word = kinds == ["NFC", "Replace", "Lowercase"] and splits[0].get("pattern") == {"Regex": self.WORDS}
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}
        self.kind = np.full(self.LAST + 1, self.ODD, np.uint8)
        self.lower = np.arange(self.LAST + 1, dtype=np.uint16)
        for code in [*range(0x09, 0x0E), *range(0x20, 0x7F), *range(0xA0, self.LAST + 1)]:
            letter, low = chr(code), chr(code).lower()
            if len(low) == 1 and len(low.encode()) == len(letter.encode()):
                patterns = (r"\s", r"\p{L}", r"\p{N}")
                self.kind[code] = next((k for k, p in enumerate(patterns) if regex.fullmatch(p, letter)), self.OTHER)
                self.lower[code] = ord(low)

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= CACHE_WORDS:  # frequent words come back from the older ones, rare words are forgotten
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word)
        if ids is None:
            tokens = self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.letters))
            ids = np.array([t.id for t in tokens], "<u4").tobytes()
        self[word] = ids
        return ids

    def _kinds(self, buf: np.ndarray, heads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower-cased bytes and the kind of each byte (a continuing byte has its character's)."""
        ascii_, low = buf < 0x80, buf.copy()
        kind = np.full(len(buf), self.ODD, np.uint8)
        kind[ascii_], low[ascii_] = self.kind[buf[ascii_]], self.lower[buf[ascii_]]
        two = np.flatnonzero((buf >= 0xC2) & (buf <= 0xC0 | self.LAST >> 6))
        two = two[two + 1 < len(buf)]
        two = two[(buf[two + 1] & 0xC0 == 0x80) & ~np.isin(two + 1, heads)]
        code = (buf[two].astype(np.uint16) & 0x1F) << 6 | (buf[two + 1] & 0x3F)
        kind[two] = kind[two + 1] = self.kind[code]
        code = self.lower[code]
        low[two], low[two + 1] = 0xC0 | code >> 6, 0x80 | code & 0x3F
        bar = np.flatnonzero((buf[:-1] == ord("<")) & (buf[1:] == ord("|")))  # special tokens begin so
        kind[bar] = self.ODD
        return low, kind

    def _starts(self, low: np.ndarray, kind: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """True where a word begins, as ``WORDS`` finds them from left to right."""
        start = kind != self.SPACE
        start[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == self.DIGIT)
        start[heads] = kind[heads] != self.SPACE
        start &= (low & 0xC0) != 0x80
        at = np.flatnonzero((low == ord("'")) & start)
        padded, letter = np.r_[low, np.zeros(3, np.uint8)], np.r_[kind == self.LETTER, np.zeros(3, bool)]
        joined = np.ones(len(low) + 4, bool)  # whether a byte belongs to the same text as the one before
        joined[heads] = joined[len(low) :] = False
        one, two = padded[at + 1], padded[at + 2]
        inside = joined[at + 1] & letter[at + 1]
        short = inside & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = inside & joined[at + 2] & (((one == ord("r")) & (two == ord("e"))) | ((one == ord("v")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l"))))
        for found, size in ((at[short], 2), (at[long], 3)):
            start[found + 1] = False
            rest = found + size
            start[rest[joined[rest] & letter[rest]]] = True
        return start

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a batch, each with ``END_ID`` at its end, and where each text's ids begin (one more)."""
        buf, offsets = kernel.flat(column)
        n_texts, filled = len(offsets) - 1, np.diff(offsets) > 0
        odd = filled.copy() if not self.by_word else np.zeros(n_texts, bool)
        words, counts, first = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(n_texts + 1, np.int64)
        if self.by_word and len(buf):
            heads = offsets[:-1][filled]
            low, kind = self._kinds(buf, heads)
            odd[np.unique(np.searchsorted(offsets, np.flatnonzero(kind == self.ODD), "right") - 1)] = True
            for k in np.flatnonzero(odd):
                kind[offsets[k] : offsets[k + 1]] = self.SPACE
            start, inside = np.flatnonzero(self._starts(low, kind, heads)), kind != self.SPACE
            ends = np.r_[np.searchsorted(np.flatnonzero(inside), start), np.count_nonzero(inside)].astype(np.int32)
            array = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(ends), pa.py_buffer(low[inside])]).dictionary_encode()
            known = [self[w] for w in array.dictionary.to_pylist()]
            sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
            index = array.indices.to_numpy()
            words, counts = _gathered(np.frombuffer(b"".join(known), "<u4"), np.cumsum(sizes) - sizes, sizes, index)
            first = np.searchsorted(start, offsets)
        sums = np.r_[0, np.cumsum(counts)]
        begin, whole = sums[first], {}
        sizes = np.diff(begin)
        for k in np.flatnonzero(odd).tolist():
            whole[k] = self.tokenizer.encode(column[k].as_py(), add_special_tokens=False).ids
            sizes[k] = len(whole[k])
        edges = np.r_[0, np.cumsum(sizes + 1)]
        out = np.full(edges[-1], END_ID, "<u4")
        taken = np.repeat(edges[:-1] - begin[:-1], np.diff(begin)) + np.arange(begin[-1])
        out[taken] = words
        for k, ids in whole.items():
            out[edges[k] : edges[k + 1] - 1] = ids
        return out, edges


def _gathered(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``values`` that ``index`` names, one after the other, and their sizes."""
    counts = sizes[index]
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(starts[index] - (ends - counts), counts) + np.arange(total)], counts


def _pieces(batches, path: str, sequence: int, with_ids: bool):
    tokens, task, full = WordTokens(path), TaskContext.get().partitionId(), 0
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        ids, edges = tokens.batch(batch.column(1))
        sizes = np.diff(edges)
        pieces = -(-sizes // sequence)
        row = np.repeat(np.arange(batch.num_rows), pieces)
        start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * sequence
        length = np.minimum(sequence, sizes[row] - start)
        begin, data = edges[row] + start, memoryview(ids).cast("B")
        crc = [zlib.crc32(data[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist(), strict=True)]
        place = full + np.cumsum(length == sequence) - 1  # among the full pieces of this task
        full = int(place[-1]) + 1
        columns = [pa.array(c, pa.int64()) for c in (start, length, crc, sizes[row], place)]
        columns.insert(4, pa.array(np.full(len(row), task), pa.int32()))
        columns += [pa.ListArray.from_arrays(pa.array(np.r_[begin, edges[-1]], pa.int32()), pa.array(ids.view("<i4")))] * with_ids
        names = ["start", "length", "ids_crc32", "doc_tokens", "task", "place", *["ids"] * with_ids]
        yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *columns], ["id", *names])


def shortest_pack_first(histogram: dict[int, int], size: int = SEQUENCE) -> list[tuple[tuple[tuple[int, int], ...], int]]:
    """Patterns ``((length, times), ...)`` and how often each is used, for a histogram of lengths."""
    open_: dict[int, list[list]] = {}  # room left -> [pattern, count]
    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            room = max((r for r in open_ if r >= length), default=0)
            if not room:
                times = size // length
                full, rest = divmod(left, times)
                for count, each in ((full, times), (1 if rest else 0, rest)):
                    if count:
                        open_.setdefault(size - length * each, []).append([((length, each),), count])
                break
            pattern, count = open_[room].pop()
            if not open_[room]:
                del open_[room]
            times = min(room // length, max(1, left // count))
            used = min(count, left // times)
            if used < count:
                open_.setdefault(room, []).append([pattern, count - used])
            open_.setdefault(room - length * times, []).append([(*pattern, (length, times)), used])
            left -= used * times
    return [(pattern, count) for _, packs in sorted(open_.items()) for pattern, count in packs]


def places(patterns: list) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``length, first rank, end rank, times, first sequence, offset``: where pieces of a length go by rank."""
    rows, next_rank, sequence = [], {}, 0
    for pattern, count in patterns:
        offset = 0
        for length, times in pattern:
            first = next_rank.get(length, 0)
            next_rank[length] = first + count * times
            rows.append((length, first, next_rank[length], times, sequence, offset))
            offset += length * times
        sequence += count
    return rows


def ranked(pieces: DataFrame, histogram: dict[int, int], rows: int = RANK_ROWS) -> DataFrame:
    """``pieces`` with ``rank``, from 0 without gaps within each length; about ``rows`` are numbered together."""
    spark = pieces.sparkSession
    salts = spark.createDataFrame([(length, SALTS + n // rows) for length, n in histogram.items()], "length long, __salts long")
    salted = pieces.join(F.broadcast(salts), "length")  # at most 2048 rows
    salted = salted.withColumn("__salt", F.pmod(F.xxhash64("id", "start", "ids_crc32"), "__salts")).drop("__salts")
    counts = salted.groupBy("length", "__salt").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy("length").orderBy("__salt").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select("length", "__salt", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__shift"))
    own = Window.partitionBy("length", "__salt").orderBy("id", "start", "ids_crc32")
    numbered = salted.withColumn("__own", F.row_number().over(own) - 1)
    # at most 2048 lengths times the salts, and a row for each ``rows`` pieces; Spark broadcasts it or not
    return numbered.join(shifts, ["length", "__salt"]).withColumn("rank", F.col("__own") + F.col("__shift"))


def pack(
    docs: DataFrame, text: str = "text", key: str = "doc_id", tokenizer: str | None = None,
    sequence: int = SEQUENCE, with_ids: bool = False, rank_rows: int = RANK_ROWS,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``."""
    spark, path = docs.sparkSession, tokenizer or tokenizer_path()
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    schema = f"id {kind}, start long, length long, ids_crc32 long, doc_tokens long, task int, place long" + ", ids array<int>" * with_ids
    pieces = checkpointed(source.mapInArrow(lambda b: _pieces(b, path, sequence, with_ids), schema))
    counted = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    histogram = {r["length"]: r["n"] for r in counted if r["length"] < sequence}
    patterns = shortest_pack_first(histogram, sequence)
    results = ["start", "length", "ids_crc32", "doc_tokens"]
    # Full pieces fill a sequence each: numbered in their task, and the tasks one after the other (one row a task).
    at, shifts = sum(count for _, count in patterns), []
    full = pieces.where(F.col("length") == sequence)
    for r in full.groupBy("task").agg(F.count(F.lit(1)).alias("n")).orderBy("task").collect():
        shifts.append((r["task"], at))
        at += r["n"]
    placed = full.join(F.broadcast(spark.createDataFrame(shifts, "task int, __shift long")), "task").select(
        F.col("id").alias(key), *results, (F.col("__shift") + F.col("place")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"), *["ids"] * with_ids
    )
    named = spark.createDataFrame(places(patterns), "__length long, __first long, __end long, __times long, __sequence long, __offset long")
    rank = F.col("rank")
    met = ranked(pieces.where(F.col("length") < sequence).drop("task", "place"), histogram, rank_rows).join(
        F.broadcast(named), (F.col("length") == F.col("__length")) & (rank >= F.col("__first")) & (rank < F.col("__end"))
    )
    into = rank - F.col("__first")
    rest = met.select(
        F.col("id").alias(key), *results,
        (F.col("__sequence") + F.floor(into / F.col("__times"))).alias("sequence_id"),
        (F.col("__offset") + into % F.col("__times") * F.col("length")).alias("offset"),
        *["ids"] * with_ids,
    )
    return placed.unionByName(rest)


def pack_query(docs: DataFrame) -> DataFrame:
    return pack(docs)

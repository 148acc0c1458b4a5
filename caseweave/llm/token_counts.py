"""Token counts: a broadcast table of frequent pre-tokens' lengths, and worker caches for the others.

A byte-level BPE tokenizer cuts a text into pre-tokens by one fixed pattern and merges bytes inside each of them alone, so
a text's token count is the sum of its pre-tokens' lengths in tokens.

1. Frequent pre-tokens.  Each task cuts its texts and tallies them in a table of a fixed number of slots; a slot holds
   one pre-token and a count that other pre-tokens of the slot lower, so frequent ones stay (majority vote by slot).
   Tables are merged slot by slot.  What moves is at most one table a task: pre-tokens themselves are never shuffled.
2. First tier.  The driver encodes the merged table's pre-tokens (at most ``SLOTS``) and broadcasts their lengths as
   arrays: 17 bytes a slot, whatever the corpus.
3. Second tier.  Each task cuts its texts again, a batch at a time, and looks all pre-tokens up at once.  Misses go to
   the worker's own table, then to the tokenizer's model, once for each distinct one of a batch.  A new entry takes the
   place of the slot's old one, so memory stays fixed.

A pre-token of up to 16 bytes is its own key (two 64-bit numbers, compared whole), so nothing rests on hashes; longer
ones are kept by their bytes in a bounded dictionary.  The tables change the speed, never a count.

Texts with characters whose class differs between Unicode versions, NUL, or ``<|`` (special tokens begin so, and the
library takes them out of texts first) go through the whole tokenizer, as do all texts if the file is not a byte-level
BPE of this make.  ``.model`` files are read by ``sentencepiece``, others by ``tokenizers``.

Defined results: a null or empty text has no bytes and no tokens; each row counts for itself, also with a repeated or
null id; an empty table gives no rows.  Texts are cut whole, however long; a batch holds one text at least.  Other
columns pass unchanged, except those that have a result's name, which the result replaces.
"""

from __future__ import annotations

import json
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
#: Slots of the first tier, of a worker's second tier, and parts that tallies are merged in.
SLOTS, OWN_SLOTS, PARTS = 1 << 16, 1 << 18, 256
#: Longer pre-tokens that a worker remembers.
CACHE_WORDS = 50_000
#: Bytes of text whose pre-tokens are looked up together.
AT_ONCE = 1_000_000
U = np.uint64
SPACE, LETTER, DIGIT, OTHER, ODD = range(5)
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _classes() -> np.ndarray:
    """Class of each code point; ``ODD`` where Unicode 3.2 and today's Unicode disagree, or beyond the basic plane."""
    kinds = np.full(0x110000, ODD, np.uint8)
    spaces = {*range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000}

    def kind(category: str) -> int:
        return {"L": LETTER, "N": DIGIT}.get(category[0], OTHER)

    for code in range(0x10000):
        now, then = unicodedata.category(chr(code)), unicodedata.ucd_3_2_0.category(chr(code))
        if code in spaces:
            kinds[code] = SPACE
        elif "Cn" not in (now, then) and now not in ("Cs", "Co") and kind(now) == kind(then) and "Z" not in (now[0], then[0]):
            kinds[code] = kind(now)
    kinds[[0, *range(0x1C, 0x20), 0x85]] = ODD
    return kinds


class PreTokens:
    """Cuts a batch of texts into pre-tokens: where each starts, its length in bytes, its key, and each text's first."""

    def __init__(self):
        self.kinds = _classes()

    def _kinds(self, buf: np.ndarray, padded: np.ndarray) -> np.ndarray:
        kind = self.kinds[:256][buf]
        high = buf >= 0x80
        if high.any():
            kind[high] = ODD
            for first, last, size, bits in ((0xC2, 0xDF, 2, 0x1F), (0xE0, 0xEF, 3, 0x0F)):
                at = np.flatnonzero((buf >= first) & (buf <= last))
                code = (padded[at] & bits).astype(np.int32)
                for k in range(1, size):
                    code = code << 6 | (padded[at + k] & 0x3F)
                at_kind = self.kinds[code]
                for k in range(size):
                    inside = at + k < len(kind)
                    kind[at[inside] + k] = at_kind[inside]
        bar = np.flatnonzero((buf[:-1] == ord("<")) & (buf[1:] == ord("|")))
        kind[bar] = ODD
        return kind

    def cut(self, buf: np.ndarray, offsets: np.ndarray):
        """``starts, sizes, lo, hi, first, odd``: the pre-tokens of the texts that aren't odd, and which texts are."""
        n = len(buf)
        padded = np.concatenate([buf, np.zeros(24, np.uint8)])
        kind = self._kinds(buf, padded)
        odd = np.zeros(len(offsets) - 1, bool)
        strange = np.flatnonzero(kind == ODD)
        if len(strange):
            odd[np.unique(np.searchsorted(offsets, strange, "right") - 1)] = True
        heads = offsets[:-1][offsets[:-1] < offsets[1:]]
        head = np.zeros(n + 4, bool)
        head[heads] = True
        head[n:] = True
        change = np.empty(n, bool)
        change[:1], change[1:] = True, kind[1:] != kind[:-1]
        change[heads] = True
        start = np.zeros(n + 4, bool)
        begins = np.flatnonzero(change)
        begins_kind = kind[begins]
        start[begins[begins_kind == SPACE]] = True
        words = begins[begins_kind != SPACE]
        after = words[~head[words]]  # those with a character before them in the same text
        after = after[kind[after - 1] == SPACE]
        lone = np.setdiff1d(words, after, assume_unique=True)
        start[lone] = True
        blank = buf[after - 1] == 0x20
        start[after[blank] - 1] = True  # one blank belongs to the word
        bare = after[~blank]
        start[bare] = True
        last = bare - 1  # any other white space just before a word is a pre-token of its own
        for _ in range(2):
            last = np.where((padded[last] & 0xC0) == 0x80, last - 1, last)
        start[last] = True
        quote = np.flatnonzero((buf == ord("'")) & change)
        quote = quote[start[quote]]
        one, two = padded[quote + 1], padded[quote + 2]
        inside = ~head[quote + 1]
        short = inside & np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = inside & ~head[quote + 2] & np.isin(one.astype(np.uint16) << 8 | two, [ord(a) << 8 | ord(b) for a, b in ("re", "ve", "ll")])
        kinds = np.concatenate([kind, np.full(4, SPACE, np.uint8)])
        for found, size in ((quote[short], 2), (quote[long], 3)):
            start[found + 1] = False
            rest = found + size
            start[rest[~head[rest] & (kinds[rest] == LETTER)]] = True
        for k in np.flatnonzero(odd).tolist():
            start[offsets[k] : offsets[k + 1]] = False
        starts = np.flatnonzero(start[:n])
        first = np.searchsorted(starts, offsets)
        sizes = np.diff(starts, append=n)
        tail = first[1:][first[1:] > first[:-1]] - 1  # a text's last pre-token ends with the text
        sizes[tail] = offsets[1:][first[1:] > first[:-1]] - starts[tail]
        eight = np.ndarray((n + 16,), "<u8", padded, strides=(1,))
        lo = eight[starts] & MASKS[np.minimum(sizes, 8)]
        hi = eight[starts + 8] & MASKS[np.clip(sizes - 8, 0, 8)]
        return starts, sizes, lo, hi, first, odd


def slot_of(lo: np.ndarray, hi: np.ndarray, slots: int) -> np.ndarray:
    return (kernel.mixed(lo ^ kernel.mixed(hi)) >> U(64 - (slots.bit_length() - 1))).astype(np.int64)


class Tally:
    """Frequent pre-tokens of up to 16 bytes: one a slot, with the votes for it less those against it."""

    def __init__(self, slots: int = SLOTS):
        self.slots = slots
        self.lo, self.hi, self.votes = np.zeros(slots, U), np.zeros(slots, U), np.zeros(slots, np.int64)

    def add(self, lo: np.ndarray, hi: np.ndarray, votes: np.ndarray | None = None, slot: np.ndarray | None = None) -> None:
        slot = slot_of(lo, hi, self.slots) if slot is None else slot
        same = (self.lo[slot] == lo) & (self.hi[slot] == hi)
        count = lambda which: np.bincount(slot[which], None if votes is None else votes[which], self.slots)
        self.votes += (count(same) - count(~same)).astype(np.int64)
        new = np.flatnonzero(~same & (self.votes[slot] < 0))
        if votes is not None:
            new = new[np.argsort(votes[new], kind="stable")]  # the one with most votes is written last
        self.lo[slot[new]], self.hi[slot[new]] = lo[new], hi[new]
        np.abs(self.votes, out=self.votes)

    def held(self) -> np.ndarray:
        return np.flatnonzero((self.votes > 0) & ((self.lo > 0) | (self.hi > 0)))


PARTIAL = "part int, slot binary, lo binary, hi binary, votes binary"
_PARTIAL = pa.schema([("part", pa.int32()), *((c, pa.binary()) for c in ("slot", "lo", "hi", "votes"))])


def _blobs(tallies: list[tuple[int, Tally]], offset_of):
    rows = []
    for part, tally in tallies:
        held = tally.held()
        if len(held):
            rows.append((part, (held + offset_of(part)).astype("<i4").tobytes(), tally.lo[held].tobytes(), tally.hi[held].tobytes(), tally.votes[held].tobytes()))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _PARTIAL, strict=True)], schema=_PARTIAL)


def _tally(batches, slots: int):
    """A task's tally, cut into parts by slot."""
    cutter, tally = PreTokens(), Tally(slots)
    for batch in kernel.chunks(batches, "text", AT_ONCE):
        buf, offsets = kernel.flat(batch.column(0))
        if len(buf):
            _, sizes, lo, hi, _, _ = cutter.cut(buf, offsets)
            short = sizes <= 16
            tally.add(lo[short], hi[short])
    width = slots // PARTS
    parts = []
    for part in range(PARTS):
        piece, span = Tally(0), slice(part * width, (part + 1) * width)
        piece.lo, piece.hi, piece.votes = tally.lo[span], tally.hi[span], tally.votes[span]
        parts.append((part, piece))
    yield from _blobs(parts, lambda part: part * width)


def _merge(batches, slots: int):
    """Tallies of a part, merged as they come."""
    width, merged = slots // PARTS, {}
    for batch in batches:
        for row in batch.to_pylist():
            tally = merged.setdefault(row["part"], Tally(width))
            slot = np.frombuffer(row["slot"], "<i4").astype(np.int64) - row["part"] * width
            tally.add(*(np.frombuffer(row[c], U) for c in ("lo", "hi")), np.frombuffer(row["votes"], np.int64), slot)
    yield from _blobs(list(merged.items()), lambda part: part * width)


def frequent(texts: DataFrame, slots: int = SLOTS) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the frequent pre-tokens of all texts, one a slot at most."""
    partial = texts.mapInArrow(lambda b: _tally(b, slots), PARTIAL)
    merged = partial.repartition(PARTS, "part").mapInArrow(lambda b: _merge(b, slots), PARTIAL)
    rows = merged.select("lo", "hi").collect()  # PARTS rows, 16 bytes a slot
    return tuple(np.frombuffer(b"".join(bytes(r[c]) for r in rows), U) for c in ("lo", "hi"))


class Lengths:
    """Lengths in tokens by pre-token, one a slot."""

    def __init__(self, slots: int):
        self.slots = slots
        self.lo, self.hi, self.length = np.zeros(slots, U), np.zeros(slots, U), np.zeros(slots, np.uint8)

    def put(self, lo: np.ndarray, hi: np.ndarray, length: np.ndarray) -> None:
        slot = slot_of(lo, hi, self.slots)
        self.lo[slot], self.hi[slot], self.length[slot] = lo, hi, length

    def get(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Lengths, 0 for what isn't there."""
        slot = slot_of(lo, hi, self.slots)
        return np.where((self.lo[slot] == lo) & (self.hi[slot] == hi), self.length[slot], 0)


class ByteCounter:
    """Token counts of texts by a byte-level BPE file: first tier ``known``, second tier this worker's own."""

    def __init__(self, path: str, known: Lengths | None = None, own_slots: int = OWN_SLOTS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known, self.own, self.cutter = known, Lengths(own_slots), PreTokens()
        self.words: dict[bytes, int] = {}
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
        others = [b for b in range(256) if b not in plain]
        self.letters = {b: chr(b) for b in plain} | {b: chr(256 + k) for k, b in enumerate(others)}

    @staticmethod
    def fits(path: str) -> bool:
        """Whether the file cuts texts as ``PreTokens`` does, and has no special token that doesn't begin with ``<|``."""
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        cut = made.get("pre_tokenizer") or {}
        return (
            (made.get("model") or {}).get("type") == "BPE" and not made.get("normalizer") and not made["model"].get("ignore_merges")
            and not made["model"].get("dropout") and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
            and all(t["content"].startswith("<|") and not any(t[k] for k in ("lstrip", "rstrip", "single_word", "normalized")) for t in made.get("added_tokens") or [])
        )

    def encode(self, word: bytes) -> int:
        return len(self.tokenizer.model.tokenize(word.decode("latin-1").translate(self.letters)))

    def encode_keys(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        return np.fromiter((self.encode((a + b).rstrip(b"\0")) for a, b in zip(_eights(lo), _eights(hi), strict=True)), np.uint8, len(lo))

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Bytes and tokens of each text."""
        buf, offsets = kernel.flat(column)
        if not len(buf):
            return np.diff(offsets), np.zeros(len(offsets) - 1, np.int64)
        starts, sizes, lo, hi, first, odd = self.cutter.cut(buf, offsets)
        length = (self.known or self.own).get(lo, hi).astype(np.int64)
        long = sizes > 16
        length[long] = 0
        missed = np.flatnonzero((length == 0) & ~long)
        if self.known and len(missed):
            length[missed] = self.own.get(lo[missed], hi[missed])
            missed = missed[length[missed] == 0]
        if len(missed):
            order = missed[np.lexsort((hi[missed], lo[missed]))]
            new = np.r_[True, (lo[order[1:]] != lo[order[:-1]]) | (hi[order[1:]] != hi[order[:-1]])]
            one = order[new]
            encoded = self.encode_keys(lo[one], hi[one])
            self.own.put(lo[one], hi[one], encoded)
            length[order] = encoded[np.cumsum(new) - 1]
        for k in np.flatnonzero(long).tolist():
            length[k] = self._word(buf[starts[k] : starts[k] + sizes[k]].tobytes())
        sums = np.concatenate([[0], np.cumsum(length)])
        tokens = np.diff(sums[first])
        for k in np.flatnonzero(odd).tolist():
            tokens[k] = len(self.tokenizer.encode(column[k].as_py(), add_special_tokens=False).ids)
        return np.diff(offsets), tokens

    def _word(self, word: bytes) -> int:
        found = self.words.get(word)
        if found is None:
            found = self.encode(word)
            if len(word) <= 256:
                if len(self.words) >= CACHE_WORDS:
                    self.words.clear()
                self.words[word] = found
        return found


def _eights(values: np.ndarray) -> list[bytes]:
    data = values.astype("<u8").tobytes()
    return [data[k : k + 8] for k in range(0, len(data), 8)]


class WholeCounter:
    """Token counts by the library alone, for tokenizers of any other make."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            self.count = lambda texts, made=sentencepiece.SentencePieceProcessor(model_file=path): [len(x) for x in made.encode(texts, num_threads=1)]
        else:
            from tokenizers import Tokenizer

            made = Tokenizer.from_file(path)
            made.no_truncation()
            made.no_padding()
            self.count = lambda texts: [len(x.ids) for x in made.encode_batch(texts, add_special_tokens=False)]

    def batch(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = [x or "" for x in column.to_pylist()]
        return np.array([len(x.encode()) for x in texts], np.int64), np.array(self.count(texts), np.int64)


RESULTS = ("n_bytes", "n_tokens", "over_limit")


def count_tokens(
    docs: DataFrame, text: str = "text", tokenizer: str | None = None, limit: int = LIMIT, keep: bool = True, slots: int = SLOTS
) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit`` tokens); ``keep=False`` drops the text."""
    spark, path = docs.sparkSession, tokenizer or tokenizer_path()
    by_bytes = path.endswith(".json") and ByteCounter.fits(path)
    known = None
    if by_bytes:
        lo, hi = frequent(docs.select(F.col(text).alias("text")), slots)
        table = Lengths(slots)
        if len(lo):
            table.put(lo, hi, ByteCounter(path).encode_keys(lo, hi))
        known = spark.sparkContext.broadcast(table)  # 17 bytes a slot
    others = [c for c in docs.columns if c not in RESULTS and (keep or c != text)]
    names = {c: f"__column_{k}" for k, c in enumerate(others)}
    source = docs.select(F.col(text).alias("text"), *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    made = [f"{n} {source.schema[n].dataType.simpleString()}" for n in names.values()]

    def run(batches):
        counter = ByteCounter(path, known.value) if by_bytes else WholeCounter(path)
        for batch in kernel.chunks(batches, "text", AT_ONCE):
            size, tokens = counter.batch(batch.column(0))
            columns = [*batch.columns[1:], pa.array(size, pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)]
            yield pa.RecordBatch.from_arrays(columns, [*names.values(), *RESULTS])

    counted = source.mapInArrow(run, ", ".join([*made, "n_bytes long, n_tokens long, over_limit boolean"]))
    return counted.select(*(F.col(n).alias(c) for c, n in names.items()), *RESULTS)


def token_counts_query(docs: DataFrame) -> DataFrame:
    return count_tokens(docs.select("doc_id", "text"), keep=False)

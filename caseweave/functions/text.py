"""Text and time columns."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

TOKEN = r"[\p{L}\p{N}_]{2,}"


def tokens(text: Column, stop_words: tuple = ()) -> Column:
    """Lower-cased tokens of two or more word characters; null for null."""
    found = F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))
    return F.filter(found, lambda t: ~t.isin(*stop_words)) if stop_words else found


def safe_name(c: Column) -> Column:
    return F.translate(F.lower(c), " /", "__")


def strip_controls(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def month_bucket(closed: Column, opened: Column) -> Column:
    """``yyyy-MM`` of the closed time, else of the opened time, row by row; strings that are no time count as missing."""
    return F.date_format(F.coalesce(closed.try_cast("timestamp"), opened.try_cast("timestamp")), "yyyy-MM")


def coerce_timestamp(c: Column) -> Column:
    """Epoch milliseconds (over 1e12), epoch seconds (over 1e9) or text to a timestamp of whole seconds; bad is null."""
    text = c.cast("string")
    number = text.try_cast("double")
    whole = number.try_cast("bigint")
    moment = F.when(number > 1e12, F.timestamp_millis(whole)).when(number > 1e9, F.timestamp_seconds(whole))
    return F.date_trunc("second", F.when(number.isNotNull(), moment).otherwise(text.try_cast("timestamp")))


def run_time(run_id: Column) -> Column:
    """Time of a run id ``yyyyMMdd-HHmmss`` or ``yyyyMMdd_HHmmss``; null for others."""
    return F.coalesce(F.try_to_timestamp(run_id, F.lit("yyyyMMdd-HHmmss")), F.try_to_timestamp(run_id, F.lit("yyyyMMdd_HHmmss")))


def recover_json(c: Column) -> Column:
    """From the first ``{`` to the last ``}``; null if there is none."""
    return F.nullif(F.regexp_extract(c, r"(?s)\{.*\}", 0), F.lit(""))


def parse_details(c: Column, schema: str) -> Column:
    """Details written as JSON text as a struct of ``schema`` and ``raw``: the text itself where it is no JSON."""
    parsed = F.from_json(c, f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
    names = [f.split()[0] for f in schema.split(",")]
    raw = F.when(parsed["_bad"].isNotNull(), c)
    return F.when(c.isNotNull() & (c != ""), F.struct(*(parsed[n].alias(n) for n in names), raw.alias("raw")))


def present(c: Column) -> Column:
    """The text, or null if it is empty, ``None`` or ``nan``."""
    return F.when(~c.isin("", "None", "nan"), c)


#: Weight of a term that only one of two texts has: 1 + ln 1.5.
SINGLE = 1.0 + 0.4054651081081644
#: Rows whose tokens are numbered at once.
COSINE_ROWS = 256


def _cosines(lists: pa.Array, width: int, pairs: list[tuple[int, int]]) -> np.ndarray:
    """``(rows, pairs)`` cosines of ``width`` token lists a row, NaN where a list has no token."""
    n, sides = len(lists), lists.flatten()
    sizes = pc.list_value_length(sides).fill_null(0).to_numpy(zero_copy_only=False)
    codes = sides.flatten().dictionary_encode()
    terms = max(1, len(codes.dictionary))
    key, tf = np.unique(np.repeat(np.arange(n * width, dtype=np.int64), sizes) * terms + codes.indices.to_numpy(), return_counts=True)
    side, squares = key // terms, tf * tf
    total = np.bincount(side, squares, n * width).reshape(n, width)  # sums of whole numbers: exact
    filled = sizes.reshape(n, width) > 0
    out = np.full((n, len(pairs)), np.nan)
    for p, (i, j) in enumerate(pairs):
        own = np.flatnonzero(side % width == i)
        other = key[own] + (j - i) * terms
        at = np.minimum(np.searchsorted(key, other), len(key) - 1)
        met = key[at] == other
        own, at = own[met], at[met]
        row = side[own] // width
        dot, mine, theirs = (np.bincount(row, v, n) for v in (tf[own] * tf[at], squares[own], squares[at]))
        norms = (mine + SINGLE**2 * (total[:, i] - mine)) * (theirs + SINGLE**2 * (total[:, j] - theirs))
        good = filled[:, i] & filled[:, j]
        out[good, p] = dot[good] / np.sqrt(norms[good])
    return out


def token_cosines(lists: list[Column], pairs: list[tuple[int, int]]) -> Column:
    """Array of the cosines of pairs (by place) of token lists; see ``pair_cosine``.

    A row's lists go to a worker once, however many pairs they are in; their terms are numbered there, and a pair looks up
    the terms of its first list in those of its second one, so the first should be the shorter.
    """
    width = len(lists)

    @F.arrow_udf("array<double>")
    def cosines(rows: pa.Array) -> pa.Array:
        parts = [_cosines(rows.slice(k, COSINE_ROWS), width, pairs) for k in range(0, len(rows), COSINE_ROWS)]
        values = np.concatenate(parts).ravel() if parts else np.zeros(0)
        return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * len(pairs), pa.array(values, mask=np.isnan(values)))

    return cosines(F.array(*lists))


def token_cosine(ta: Column, tb: Column) -> Column:
    """Cosine over two token lists; see ``pair_cosine``."""
    return F.get(token_cosines([ta, tb], [(0, 1)]), 0)


def pair_cosine(a: Column, b: Column) -> Column:
    """Cosine of the TF-IDF vectors of two texts, fitted on these two alone; null if either has no token.

    With two texts a term in both has weight 1 and a term in one has 1 + ln 1.5, so the sums need no corpus: the shared
    distinct terms and the token counts of each text are enough.
    """
    return token_cosine(tokens(a), tokens(b))

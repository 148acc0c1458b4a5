"""Line dedup: overlapping three-line windows, hashed, counted over all documents, later occurrences removed.

A text is split at ``\\n``.  Every three consecutive lines with a word among them are a window.  A window's first
occurrence is the one with the smallest ``(doc_id, line number)``; each later occurrence is removed, which means that
every line which a later occurrence covers goes.  Windows are judged on the input, not on what is left.

Only DataFrame functions are used.  Windows leave the rows as two 64-bit hashes in different line order (128 bits).
``min`` with its map-side part finds the first occurrences, so a window that a third of all documents share is one row
a task in that shuffle; the join that finds the later ones is an inner equi-join, whose hot partitions Spark's adaptive
execution splits.  Texts are shuffled once, as arrays of lines, to meet the covered positions of their document.

Defined results: a null text stays null and has no lines; rows with a null id are left as they are and count for
nobody; rows of one id and one text get the same result; a document all of whose lines go keeps its row with an empty
text; other columns are passed on; texts are taken whole, however long; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW = 3
HAS_WORD = r"[^\x20\x09-\x0D]"


def _windows(docs: DataFrame, text: str, key: str) -> DataFrame:
    """One row per window: id, hash of the text, number of the first line, two hashes."""
    lines = F.col("__lines")
    rest = lambda start: F.slice(lines, start, F.greatest(F.size(lines) - (start - 1), F.lit(0)))
    pairs = F.zip_with(lines, rest(2), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hashed = F.zip_with(
        pairs,
        rest(3),
        lambda p, c: F.when(
            F.concat(p.a, p.b, c).rlike(HAS_WORD),
            F.struct(F.xxhash64(p.a, p.b, c).alias("h1"), F.xxhash64(F.lit("reversed"), c, p.b, p.a).alias("h2")),
        ),
    )  # the concatenation is null where fewer than three lines are left
    return (
        docs.where(F.col(key).isNotNull() & F.col(text).isNotNull())
        .select(F.col(key).alias("__id"), F.xxhash64(text).alias("__text"), F.split(text, "\n").alias("__lines"))
        .select("__id", "__text", F.posexplode(hashed).alias("__at", "__w"))
        .where(F.col("__w").isNotNull())
        .select("__id", "__text", "__at", F.col("__w.h1").alias("__h1"), F.col("__w.h2").alias("__h2"))
    )


def covered_lines(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per document with later occurrences: ``__id, __text, __covered`` (line numbers from 0, each once)."""
    windows = _windows(docs, text, key)
    first = (
        windows.groupBy("__h1", "__h2")
        .agg(F.min(F.struct("__id", "__at")).alias("__first"), F.count(F.lit(1)).alias("__n"))
        .where("__n > 1")
        .select("__h1", "__h2", "__first")
    )
    later = windows.join(first, ["__h1", "__h2"]).where(F.struct("__id", "__at") > F.col("__first"))
    around = F.transform(F.collect_set("__at"), lambda i: F.array(*(i + k for k in range(WINDOW))))
    return later.groupBy("__id", "__text").agg(F.array_distinct(F.flatten(around)).alias("__covered"))


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_lines`` and ``n_removed`` (replacing columns of these names)."""
    order = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    names = {c: f"__input_{k}" for k, c in enumerate(order)}  # no name of the input meets one of this function
    source = docs.select(*(F.col(c).alias(n) for c, n in names.items()))
    covered = covered_lines(source, names[text], names[key])
    split = source.select(*(n for c, n in names.items() if c != text), F.split(names[text], "\n").alias("__lines"), F.xxhash64(names[text]).alias("__hash"))
    joined = split.join(covered, (F.col(names[key]) == F.col("__id")) & (F.col("__hash") == F.col("__text")), "left")
    kept = F.array_except(F.sequence(F.lit(0), F.size("__lines") - 1), F.col("__covered"))
    cut = F.array_join(F.transform(kept, lambda i: F.get(F.col("__lines"), i)), "\n")
    results = {
        text: F.when(F.col("__covered").isNull(), F.array_join("__lines", "\n")).otherwise(cut),
        "n_lines": F.when(F.col("__lines").isNull(), 0).otherwise(F.size("__lines")).cast("long"),
        "n_removed": F.when(F.col("__covered").isNull(), 0).otherwise(F.size("__covered")).cast("long"),
    }
    return joined.select(*(results.get(c, F.col(names.get(c, c))).alias(c) for c in [*order, "n_lines", "n_removed"]))


def line_dedup_query(docs: DataFrame) -> DataFrame:
    """Per document: lines, removed lines and the SHA-256 of the text that is left (null: of no bytes)."""
    out = line_dedup(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS ls FROM documents),
w AS (SELECT r, doc_id, i, ls[i] || chr(10) || ls[i + 1] || chr(10) || ls[i + 2] AS g
      FROM (SELECT r, doc_id, ls, unnest(range(1, len(ls) - 1)) AS i FROM t
            WHERE len(ls) >= 3 AND doc_id IS NOT NULL)
      WHERE regexp_matches(ls[i] || ls[i + 1] || ls[i + 2], '[^\x20\x09-\x0D]')),
later AS (SELECT r, i FROM w QUALIFY (doc_id, i) > min((doc_id, i)) OVER (PARTITION BY g)),
covered AS (SELECT DISTINCT r, unnest([i, i + 1, i + 2]) AS i FROM later),
lines AS (SELECT r, unnest(ls) AS line, unnest(range(1, len(ls) + 1)) AS i FROM t),
kept AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS text FROM lines ANTI JOIN covered USING (r, i) GROUP BY r),
n AS (SELECT r, count(*) AS n FROM covered GROUP BY r)
SELECT doc_id, CAST(coalesce(len(ls), 0) AS BIGINT) AS n_lines, CAST(coalesce(n.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (r) LEFT JOIN n USING (r)
"""

"""Quality rules: a threshold table compiled into one projection, without user functions.

``RULES`` states each rule as ``name, numerator, denominator, comparison, percent``: a document breaks the rule when
``100 * numerator  <comparison>  percent * denominator``.  Whole-number products instead of quotients leave no rounding
between engines.  ``compile_rules`` turns the table into boolean columns over the metric columns; metrics and verdict
are one projection per row, so nothing is shuffled, and the text is read once.

Defined results: a null or empty text has no words, so all counts are 0 and the base rule fails it; repeated rows each
get their own equal result; a null id is passed on; other input columns are ignored by the query and kept by
``annotate``; texts are measured whole, however long; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "a", "al", "an", "and", "are", "as", "at", "au", "auf", "aus", "aux", "avec", "be", "bei", "but", "by", "ce", "con",
    "dans", "das", "de", "del", "dem", "den", "der", "des", "die", "du", "ein", "eine", "el", "en", "er", "es", "est",
    "et", "for", "from", "für", "had", "has", "have", "he", "her", "his", "ich", "il", "im", "in", "is", "ist", "it",
    "la", "las", "le", "les", "lo", "los", "más", "mit", "nicht", "no", "not", "of", "on", "or", "ou", "para", "pas",
    "por", "pour", "que", "qui", "se", "sich", "sie", "son", "su", "sur", "that", "the", "their", "they", "this", "to",
    "un", "una", "und", "une", "von", "was", "were", "which", "with", "y", "zu",
)

#: The contract's base rule and then the method's own rules.
BASE_RULES = (
    ("too_few_words", "n_words", "__one", "<", 5000),
    ("repeated_windows", "n_repeat_words", "n_words", ">", 50),
)
RULES = (
    ("short_words", "word_chars", "n_words", "<", 200),
    ("long_words", "word_chars", "n_words", ">", 2000),
    ("symbols", "n_symbols", "n_words", ">", 50),
    ("no_stop_words", "n_stop_words", "n_words", "<", 2),
    ("repeated_lines", "n_dup_lines", "n_lines", ">", 50),
)

SPACE = r"[\x20\x09-\x0D]+"


def _zipped(left: Column, right: Column, how) -> Column:
    return F.zip_with(left, right, how)


def metrics(text: Column) -> list[tuple[str, Column]]:
    """Name and expression of each metric; later ones may use the names before them."""
    words, windows, ordered = F.col("__words"), F.col("__windows"), F.col("__ordered")
    rest = lambda array, start: F.slice(array, start, F.greatest(F.size(array) - (start - 1), F.lit(0)))
    pairs = _zipped(words, rest(words, 2), lambda a, b: F.concat(a, F.lit(" "), b))
    equal = _zipped(ordered, rest(ordered, 2), lambda a, b: F.when(a.w == b.w, F.array(a.i, b.i)))
    hits = F.array_distinct(F.flatten(F.filter(equal, lambda p: p.isNotNull())))
    covered = F.array_distinct(F.flatten(F.transform(hits, lambda i: F.array(i, i + 1, i + 2))))
    lines = F.filter(F.split(F.col("__text"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    long = lambda c: c.cast("long")
    return [
        ("__text", F.coalesce(text, F.lit(""))),
        ("__words", F.array_remove(F.split(F.col("__text"), SPACE), "")),
        ("__lines", lines),
        ("__one", F.lit(1).cast("long")),
        ("n_words", long(F.size(words))),
        ("word_chars", long(F.length(F.array_join(words, "")))),
        ("n_symbols", long(F.size(F.split(F.col("__text"), r"[#*$%&|<>]")) - 1)),
        ("n_lines", long(F.size("__lines"))),
        ("n_dup_lines", long(F.size("__lines") - F.size(F.array_distinct("__lines")))),
        ("n_stop_words", long(F.size(F.filter(words, lambda w: F.lower(w).isin(*STOP_WORDS))))),
        ("__windows", F.filter(_zipped(pairs, rest(words, 3), lambda p, c: F.concat(p, F.lit(" "), c)), lambda w: w.isNotNull())),
        ("__ordered", F.sort_array(F.transform(windows, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))),
        ("n_repeat_words", long(F.size(covered))),
    ]


def compile_rules(rules: tuple) -> list[Column]:
    """One boolean column per row of a threshold table; true when the row's rule is broken."""
    columns = []
    for name, top, bottom, comparison, percent in rules:
        left, right = F.col(top) * 100, F.col(bottom) * percent
        columns.append((left < right if comparison == "<" else left > right).alias(f"broken_{name}"))
    return columns


def annotate(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the metrics, one ``broken_`` column per rule, ``base_failed`` and ``kept``.

    Columns of the same names in ``docs`` are replaced; all others are kept, whatever their names.
    """
    every = metrics(F.col("__source"))
    temporary = [name for name, _ in every if name.startswith("__")]
    results = [name for name, _ in every if name not in temporary] + [f"broken_{r[0]}" for r in BASE_RULES + RULES] + ["base_failed", "kept"]
    others = {c: f"__input_{k}" for k, c in enumerate(docs.columns) if c not in results}
    out = docs.select(*(F.col(c).alias(n) for c, n in others.items()), F.col(text).alias("__source"))
    for name, column in every:
        out = out.withColumn(name, column)
    base, own = compile_rules(BASE_RULES), compile_rules(RULES)
    any_of = lambda rules: F.greatest(*(F.col(f"broken_{r[0]}") for r in rules))
    out = out.select("*", *base, *own)
    out = out.withColumn("base_failed", any_of(BASE_RULES))
    out = out.withColumn("kept", ~F.col("base_failed") & ~any_of(RULES))
    return out.select(*(F.col(n).alias(c) for c, n in others.items()), *results)


def quality_rules(docs: DataFrame) -> DataFrame:
    """The contract's columns and the two further counts that the rules use."""
    return annotate(docs.select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines", "n_stop_words",
    )


def _sql_rules(rules: tuple) -> str:
    return " OR ".join(f"100 * {top} {comparison} {percent} * {'1' if bottom == '__one' else bottom}" for _, top, bottom, comparison, percent in rules)


ORACLE_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS r FROM documents),
w AS (SELECT r, doc_id, text, list_filter(string_split_regex(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM t),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
h AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) >= 2),
c AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM h) GROUP BY r),
m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(ls) AS BIGINT) AS n_lines,
             CAST(len(list_filter(ws, lambda x: lower(x) IN ({", ".join(f"'{s}'" for s in STOP_WORDS)}))) AS BIGINT) AS n_stop_words
      FROM w LEFT JOIN c USING (r)),
b AS (SELECT *, ({_sql_rules(BASE_RULES)}) AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT ({_sql_rules(RULES)}) AS kept, n_lines, n_stop_words FROM b
"""

"""URL filters: stated host rules, and association rules that FP-growth mines from labelled URLs.

Stated rules are a table ``verdict, host, path``: a rule fits its host and all subdomains if the URL's path starts with
the rule's; the longest fitting rule wins.  They are compiled into one expression.

Where no stated rule fits, mined rules decide.  A URL's tokens are its scheme, host labels, path parts (numbers as one
token), query keys and fragment.  Labelled URLs, with a token for a bad label added, are mined by Spark's FP-growth.
Rules ``tokens -> bad`` are pruned by support and confidence, by the significance of their bad share (chi-square), and
by dropping rules that a smaller one covers.  FP-growth would list every subset of a URL that is repeated, so it gets
baskets in which such subsets are already one:

- tokens with too few bad rows for any rule are dropped, and tokens of the very same labelled rows become one class, since a
  rule with one of them is as good as one with another of them or several (rows are told apart by 128 bits of hash);
- a class that is a rule by itself leaves, as larger rules with it add nothing;
- each basket is dealt out once for each of its classes as leader, with the more frequent classes of the basket.  Classes
  that all of the leader's rows have are left out, and those of the same rows among the leader's become one.  So nested URLs
  (``/a``, ``/a/b``, ...) give single classes too.  Items carry their leader's name, so one run mines all leaders.

What is left to mine are combinations that differ in their rows; the time grows with the number of these, and with the
square of a labelled URL's classes.  A rule is a list of groups of tokens; it fits a URL that has a token of each group.
Matching is by inverted index: each rule is listed under the tokens of its rarest group; a URL's tokens look up
candidate rules by an equi-join, and a candidate fits if the URL has a token of all its groups.  Only distinct token sets
are matched, and the sets that some rule fits are broadcast to the pages (or salted, if large), so a hot host costs its
token set once.  The rules are never collected.

Defined results: a null URL or one without ``://`` has empty host and path and no tokens, so it is allowed; repeated
rows each get their verdict; labels without a page, and pages without a label, take no part in mining; with no labelled
pages there are no mined rules; URLs are taken whole, however long; no pages give no rows; columns besides ``page_id``
and ``url`` are not looked at, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.llm._spark import checkpointed

#: The contract's rules.
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BAD = "label=bad"
#: Between a leader's name and an item's; no token begins with it, so names can't be mixed up.
SEPARATOR = "\x00"
MIN_SUPPORT = 0.002
#: Rows that a mined combination must have whatever the share, so that small tables don't mine single rows.
MIN_ROWS = 5
#: More likely bad than not.
MIN_CONFIDENCE = 0.5
#: Chi-square of a rule's bad share against that of all labelled rows: five standard deviations, which some hundred
#: thousand combinations without meaning don't reach by chance (one in 3.5 million does).
MIN_CHI_SQUARE = 25.0
#: Bytes of bad token sets that are broadcast at most, and parts that a set's pages are dealt to beyond.
BROADCAST_BYTES = 32_000_000
SALTS = 64
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def stated_rule(host: Column, path: Column, rules: tuple = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest fitting rule, or nulls."""
    name = verdict = F.lit(None).cast("string")
    for kind, suffix, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r)):
        fits = ((host == suffix) | host.endswith(f".{suffix}")) & path.startswith(start)
        name = F.when(fits, F.lit(suffix + start)).otherwise(name)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return name, verdict


def tokens_of(url: Column) -> Column:
    """Sorted distinct tokens of a URL; none for a null or a URL without ``://``."""
    named = lambda kind, parts: F.transform(F.array_remove(parts, ""), lambda x: F.concat(F.lit(f"{kind}="), x))
    path = F.transform(F.split(path_of(url), "/"), lambda x: F.regexp_replace(x, "[0-9]+", "#"))
    query = F.split(F.substring(F.regexp_extract(url, PARTS, 3), 2, 1 << 30), "&")
    keys = F.transform(query, lambda x: F.substring_index(x, "=", 1))
    fragment = F.array(F.substring(F.regexp_extract(url, PARTS, 4), 2, 1 << 30))
    scheme = F.array(F.translate(F.substring_index(url, "://", 1), UPPER, LOWER))
    every = F.concat(
        named("scheme", scheme), named("host", F.split(host_of(url), r"\.")), named("path", path), named("query", keys), named("fragment", fragment)
    )
    return F.when(url.contains("://"), F.array_sort(F.array_distinct(every))).otherwise(F.array().cast("array<string>"))


def mined_rules(
    pages: DataFrame, labels: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    min_rows: int = MIN_ROWS, min_chi_square: float = MIN_CHI_SQUARE,
) -> DataFrame:
    """Rules -> bad: ``groups`` (a URL needs a token of each), and ``antecedent``, the first token of each group, sorted."""
    judged = labels.where("quality is not null or toxic is not null")
    bad = (F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)
    judged = judged.groupBy("doc_id").agg(F.max(bad).alias("bad"))
    rows = pages.join(judged, F.col("page_id") == F.col("doc_id")).select(tokens_of(F.col("url")).alias("tokens"), F.col("bad").cast("int").alias("bad"))
    rows = checkpointed(rows.where(F.size("tokens") > 0).withColumn("row", F.monotonically_increasing_id()))
    n, n_bad = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("bad"), F.lit(0))).first()
    empty = pages.sparkSession.createDataFrame([], "antecedent array<string>, groups array<array<string>>")
    if not 0 < n_bad < n:
        return empty
    # a rule with fewer bad rows can't be significant, even if all its rows are bad
    least = max(1, math.ceil(min_support * n), min_rows, math.ceil(min_chi_square * n_bad / (n - n_bad)))

    def sure(hits: Column, fits: Column) -> Column:
        apart = F.pow(hits * n - fits * n_bad, F.lit(2)) >= F.lit(float(min_chi_square)) * fits * n_bad * (n - n_bad)
        return apart & (hits * n > fits * n_bad) & (hits >= min_confidence * fits)

    same_rows = [F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("y")]
    counts = [F.count(F.lit(1)).alias("fits"), F.sum("bad").alias("hits"), *same_rows]
    occurs = rows.select("row", "bad", F.explode("tokens").alias("token"))
    often = occurs.groupBy("token").agg(*counts).where(F.col("hits") >= least)
    classes = often.groupBy("fits", "hits", "x", "y").agg(F.min("token").alias("class"), F.array_sort(F.collect_list("token")).alias("tokens"))
    classes = checkpointed(classes.select("class", "tokens", "fits", "hits", sure(F.col("hits"), F.col("fits")).alias("alone")))
    single = classes.where("alone").select(F.array("class").alias("antecedent"), F.array("tokens").alias("groups"))
    # one token stands for its class, as it has the same rows
    held = checkpointed(occurs.join(classes.where("not alone").select(F.col("class").alias("token"), "fits"), "token").withColumnRenamed("token", "class"))
    leaders, others = held.select("row", "bad", F.col("class").alias("leader"), F.col("fits").alias("led")), held.select("row", F.col("class").alias("other"), F.col("fits").alias("n"))
    pairs = leaders.join(others, "row").where((F.col("n") > F.col("led")) | ((F.col("n") == F.col("led")) & (F.col("other") > F.col("leader"))))
    within = pairs.groupBy("leader", "led", "other").agg(*counts).where((F.col("hits") >= least) & (F.col("fits") < F.col("led")))
    alike = within.join(classes.select(F.col("class").alias("other"), "tokens"), "other").groupBy("leader", "fits", "hits", "x", "y")
    alike = checkpointed(alike.agg(F.min("other").alias("other"), F.array_sort(F.flatten(F.collect_list("tokens"))).alias("tokens")))
    item = F.concat("leader", F.lit(SEPARATOR), "other")
    baskets = pairs.join(alike.select("leader", "other"), ["leader", "other"]).groupBy("row", "leader", "bad").agg(F.collect_list(item).alias("items"))
    tag = F.concat("leader", F.lit(SEPARATOR + BAD))
    baskets = checkpointed(baskets.select(F.when(F.col("bad") == 1, F.concat("items", F.array(tag))).otherwise(F.col("items")).alias("items")))
    n_baskets = baskets.count()
    if not n_baskets:
        return checkpointed(single)
    model = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / n_baskets, minConfidence=min_confidence).fit(baskets)
    hits = F.round(F.col("support") * n_baskets)
    found = model.associationRules.where(F.col("consequent")[0].endswith(SEPARATOR + BAD) & sure(hits, F.round(hits / F.col("confidence"))))
    found = checkpointed(found.select(F.array_sort("antecedent").alias("items")))
    # a rule that contains a smaller rule adds nothing: each rule is listed under its rarest item, and looked up by all items
    spread = found.select("items", F.explode("items").alias("item"))
    listed = _rarest(spread, "items", "item", spread.groupBy("item").agg(F.count(F.lit(1)).alias("n")))
    inside = (F.size("small") < F.size("items")) & (F.size(F.array_except("small", "items")) == 0)
    larger = spread.join(listed.withColumnRenamed("items", "small"), "item").where(inside)
    minimal = found.join(larger.select("items").distinct(), "items", "left_anti").select("items", F.explode("items").alias("item"))
    named = minimal.join(alike.select(item.alias("item"), "leader", "other", "tokens"), "item").groupBy("items", "leader").agg(
        F.collect_list("other").alias("others"), F.collect_list("tokens").alias("groups")
    )
    led = classes.select(F.col("class").alias("leader"), F.col("tokens").alias("own"))
    mined = named.join(led, "leader").select(
        F.array_sort(F.concat(F.array("leader"), "others")).alias("antecedent"), F.concat(F.array("own"), "groups").alias("groups")
    )
    return checkpointed(single.unionByName(mined))


def _rarest(spread: DataFrame, of: str, token: str, often: DataFrame) -> DataFrame:
    """``of`` with its rarest ``token`` by ``often``."""
    return spread.join(often, token, "left").groupBy(of).agg(F.min_by(token, F.struct(F.coalesce("n", F.lit(0)), token)).alias(token))


def matched_sets(sets: DataFrame, rules: DataFrame) -> DataFrame:
    """Distinct ``tokens`` of ``sets`` that some rule fits."""
    spread = sets.select("tokens", F.explode("tokens").alias("token"))
    often = spread.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    listed = rules.select("groups", F.posexplode("groups").alias("at", "group")).select("groups", "at", F.explode("group").alias("token"))
    rare = listed.join(often, "token", "left").groupBy("groups", "at").agg(F.sum(F.coalesce("n", F.lit(0))).alias("n"))
    rare = rare.groupBy("groups").agg(F.min_by("at", F.struct("n", "at")).alias("at"))
    index = listed.join(rare, ["groups", "at"]).select("token", "groups")
    met = spread.join(index, "token").where(F.forall("groups", lambda g: F.arrays_overlap(g, F.col("tokens"))))
    return met.select("tokens").distinct()


def marked(pages: DataFrame, sets: DataFrame, broadcast_bytes: int = BROADCAST_BYTES, salts: int = SALTS) -> DataFrame:
    """``pages`` with ``bad``: true where ``tokens`` is one of ``sets``.

    The sets are broadcast if their measured size allows it, so that pages aren't shuffled; else both sides are salted,
    so that the pages of one set go to many tasks.
    """
    sets = checkpointed(sets.withColumn("bad", F.lit(True)))
    size = sets.agg(F.sum(F.octet_length(F.array_join("tokens", ",")) + 64)).first()[0] or 0
    if size <= broadcast_bytes:
        return pages.join(F.broadcast(sets), "tokens", "left")
    salted = pages.withColumn("__salt", F.pmod(F.xxhash64("page_id"), F.lit(salts)))
    copies = sets.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    return salted.join(copies, ["tokens", "__salt"], "left").drop("__salt")


def filter_urls(pages: DataFrame, labels: DataFrame, rules: tuple = RULES, broadcast_bytes: int = BROADCAST_BYTES, **mining) -> DataFrame:
    """One row per page: ``page_id, host, path, rule, verdict``."""
    url = F.col("url")
    judged = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), tokens_of(url).alias("tokens"))
    name, verdict = stated_rule(F.col("host"), F.col("path"), rules)
    judged = judged.withColumns({"rule": name, "stated": verdict})
    mined = mined_rules(pages, labels, **mining)
    if mined.isEmpty():
        out = judged.withColumn("bad", F.lit(False))
    else:
        out = marked(judged, matched_sets(judged.select("tokens").distinct(), mined), broadcast_bytes)
    return out.select("page_id", "host", "path", "rule", F.coalesce("stated", F.when(F.col("bad"), "block").otherwise("allow")).alias("verdict"))


def url_filter_query(pages: DataFrame, labels: DataFrame) -> DataFrame:
    return filter_urls(pages, labels)


_CASES = sorted(RULES, key=lambda r: (-len(r[1]) - len(r[2]), r))
_FITS = [(k, h + p, f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')") for k, h, p in _CASES]
_TOKENS = r"""
list_sort(list_distinct(list_concat(
  list_transform(list_filter([translate(regexp_replace(url, '(?s)://.*$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')], lambda x: x <> ''), lambda x: 'scheme=' || x),
  list_transform(list_filter(string_split(host, '.'), lambda x: x <> ''), lambda x: 'host=' || x),
  list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: 'path=' || regexp_replace(x, '[0-9]+', '#', 'g')),
  list_transform(list_filter(list_transform(string_split(regexp_extract(url, '(?s)^.*?://[^?#]*\?([^#]*)', 1), '&'), lambda x: string_split(x, '=')[1]), lambda x: x <> ''), lambda x: 'query=' || x),
  list_transform(list_filter([regexp_extract(url, '(?s)^.*?://[^#]*#(.*)$', 1)], lambda x: x <> ''), lambda x: 'fragment=' || x))))
"""
ORACLE_SQL = f"""
WITH p AS (SELECT page_id, url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
                  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
t AS (SELECT row_number() OVER () AS r, *, CASE WHEN contains(url, '://') THEN {_TOKENS} ELSE [] END AS tokens FROM p),
l AS (SELECT doc_id, bool_or(coalesce(quality, 1) = 0 OR coalesce(toxic, 0) = 1) AS bad FROM labels
      WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
b AS (SELECT r, tokens, bad FROM t JOIN l ON page_id = doc_id WHERE len(tokens) > 0),
subsets AS (SELECT r, bad, list_filter(tokens, lambda x, i: (k >> (i - 1)) & 1 = 1) AS s
            FROM (SELECT r, bad, tokens, unnest(range(1, CAST(power(2, len(tokens)) AS BIGINT))) AS k FROM b)),
c AS (SELECT count(*) AS every_row, count(*) FILTER (bad) AS every_bad FROM b),
rules AS (SELECT s FROM subsets CROSS JOIN c GROUP BY s
          HAVING count(*) FILTER (bad) >= ceil(greatest({MIN_SUPPORT}, {MIN_ROWS} / (SELECT count(*) FROM b)) * (SELECT count(*) FROM b))
             AND count(*) FILTER (bad) / count(*) >= {MIN_CONFIDENCE}
             AND count(*) FILTER (bad) * any_value(every_row) > count(*) * any_value(every_bad)
             AND power(CAST(count(*) FILTER (bad) * any_value(every_row) - count(*) * any_value(every_bad) AS DOUBLE), 2)
                 >= {MIN_CHI_SQUARE} * CAST(count(*) AS DOUBLE) * any_value(every_bad) * (any_value(every_row) - any_value(every_bad))),
hit AS (SELECT DISTINCT r FROM t JOIN rules ON list_has_all(tokens, s)),
j AS (SELECT r, page_id, host, path, CASE {" ".join(f"WHEN {c} THEN '{n}'" for _, n, c in _FITS)} END AS rule,
             CASE {" ".join(f"WHEN {c} THEN '{k}'" for k, n, c in _FITS)} END AS stated FROM t)
SELECT page_id, host, path, rule, coalesce(stated, CASE WHEN hit.r IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM j LEFT JOIN hit USING (r)
"""

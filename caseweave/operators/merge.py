"""Deduplication, merging, upserts, deletions and reconciliation by key.

"First" and "last" always take an explicit order; Spark rows have no arrival order.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.sources.shared import checkpointed

ID_NAMES = ("in_id", "incident_id", "Incident ID")


def _one_by(df: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    kept = df.groupBy(*keys).agg(pick(F.struct(*rest), F.struct(*order)).alias("__row"))
    return kept.select(*keys, *(F.col(f"__row.`{c}`").alias(c) for c in rest)).select(*df.columns)


def keep_last(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The last row of each key by a total order; an aggregation with a map-side part, so hot keys shrink early."""
    return _one_by(df, keys, order, F.max_by)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return _one_by(df, keys, order, F.min_by)


def union_checkpoints(first: DataFrame, *others: DataFrame) -> DataFrame:
    for other in others:
        first = first.unionByName(other, allowMissingColumns=True)
    return first


def merge_l123(source: DataFrame, results: DataFrame, order: list[str], key: str = "in_id") -> DataFrame:
    """Source left join the last result of each id; result columns win over source columns of the same name."""
    last = keep_last(results, [key], order)
    kept = [c for c in source.columns if c == key or c not in last.columns]
    return source.select(*kept).join(last, key, "left")


def merge_l4(base: DataFrame, parts: DataFrame, columns: list[str], policy: str = "last_non_null", key: str = "in_id", file: str = "file", seq: str = "seq") -> DataFrame:
    """Base left join level-4 results from many files, in one aggregation whatever their number.

    ``last_non_null``: of each file its last row per id, then per column the last value that is not null, in file order.
    ``first``: the first row per id over all files.
    """
    if policy == "first":
        merged = keep_first(parts, [key], [file, seq]).select(key, *columns)
    else:
        last = keep_last(parts, [key, file], [seq])
        value = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(file, seq))).alias(c)
        merged = last.groupBy(key).agg(*(value(c) for c in columns))
    kept = [c for c in base.columns if c == key or c not in columns]
    return base.select(*kept).join(merged, key, "left")


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or update by key; only columns that the source has change, also to null; others keep their value."""
    return _upsert(target, source, keys, lambda c: F.when(F.col("__hit"), F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}")), source.columns)


def guarded_upsert(target: DataFrame, source: DataFrame, keys: list[str], allow: list[str], fill_only: bool = False) -> DataFrame:
    """As ``upsert``, but only allowed columns change and no row is added; with ``fill_only`` only nulls are filled."""
    allowed = [c for c in source.columns if c in keys or c in allow]
    new = lambda c: F.coalesce(f"__t.{c}", f"__s.{c}") if fill_only else F.when(F.col("__hit"), F.col(f"__s.{c}")).otherwise(F.col(f"__t.{c}"))
    return _upsert(target, source.select(*allowed), keys, new, allowed, "left")


def _upsert(target: DataFrame, source: DataFrame, keys: list[str], new, changed: list[str], how: str = "full_outer") -> DataFrame:
    marked = source.withColumn("__hit", F.lit(True)).alias("__s")
    joined = target.alias("__t").join(marked, keys, how)
    return joined.select(*keys, *((new(c) if c in changed else F.col(f"__t.{c}")).alias(c) for c in target.columns if c not in keys)).select(*target.columns)


def delete_ids(target: DataFrame, ids: DataFrame, key: str = "in_id") -> DataFrame:
    return target.join(ids.select(key), key, "left_anti")


def id_column(df: DataFrame, names: tuple = ID_NAMES) -> str:
    return next(c for c in names if c in df.columns)


def pending(df: DataFrame, checkpoint: DataFrame) -> DataFrame:
    """Rows whose id, as text, is not in the checkpoint; null ids stay pending."""
    done = checkpoint.select(F.col(id_column(checkpoint)).cast("string").alias("__done"))
    return df.join(done, F.col(id_column(df)).cast("string") == F.col("__done"), "left_anti")


def look_back_hours(span_hours: float, buffer: int = 6, least: int = 12) -> float:
    return max(least, span_hours + buffer)


def dedup_vs_target(df: DataFrame, target: DataFrame, now: dt.datetime, hours: float, key: str = "in_id", closed: str = "closed_at") -> DataFrame:
    """Rows whose id the target does not hold among those closed within the look-back window."""
    recent = target.where(F.col(closed) >= F.lit(now - dt.timedelta(hours=hours))).select(key)
    return df.join(recent, key, "left_anti")


def fill_gaps(inputs: DataFrame, outputs: DataFrame, reason: str, labels: tuple = ("category", "subcategory", "product"), key: str = "in_id") -> DataFrame:
    """Outputs, and for every input id (null is one) without one a row of ``Uncategorized`` with the status ``pipeline_gap``."""
    given = outputs.select(F.col(key).alias("__id"))
    gaps = inputs.select(key).distinct().join(given, F.col(key).eqNullSafe(F.col("__id")), "left_anti")
    made = gaps.select(key, *(F.lit("Uncategorized").alias(c) for c in labels), F.lit("pipeline_gap").alias("validation_status"), F.lit(reason).alias("gap_reason"))
    return outputs.unionByName(made, allowMissingColumns=True)


#: Ranges of ids by hash at each level of the digest tree, and differing ranges up to which they are broadcast.
RANGES, BROADCAST_RANGES = 4096, 1_000_000


def _digests(ids: DataFrame, key: str, ranges: list[str]) -> DataFrame:
    """Count and order-free digests of the ids of each range: sums with a map-side part, so ids aren't shuffled."""
    halves = lambda h: (F.sum(h.bitwiseAND(0xFFFFFFFF)), F.sum(F.shiftrightunsigned(h, 32)))
    sums = [*halves(F.xxhash64(key)), *halves(F.xxhash64(F.lit(1), key))]
    return ids.groupBy(*ranges).agg(F.count(F.lit(1)).alias("n"), *(c.alias(f"d{k}") for k, c in enumerate(sums)))


def _differing(s: DataFrame, t: DataFrame, key: str, ranges: list[str]) -> DataFrame:
    """Ranges of which the two sides have different digests."""
    made = [c for c in ("n", "d0", "d1", "d2", "d3")]
    both = _digests(s, key, ranges).withColumn("side", F.lit(1)).unionByName(_digests(t, key, ranges).withColumn("side", F.lit(-1)))
    apart = F.lit(False)
    for c in made:
        apart = apart | (F.col(f"sum({c})") != 0)
    return both.groupBy(*ranges).agg(*(F.sum(F.col(c) * F.col("side")).alias(f"sum({c})") for c in made)).where(apart).select(*ranges)


def differing_ids(source: DataFrame, target: DataFrame, key: str = "in_id") -> tuple[DataFrame, DataFrame]:
    """The ids of both sides in those ranges where they differ, by a tree of digests of two levels.

    A range is ``RANGES`` by hash, its parts as many again.  Ranges of the same count and the same four sums (128 bits of
    hash) hold the same ids and are passed over; parts are only looked at in ranges that differ.  Repeated ids make a
    range differ, which costs a comparison, not a result.
    """
    h = F.xxhash64(F.lit(2), key)
    ranges = {"__r0": F.pmod(h, F.lit(RANGES)).cast("int"), "__r1": F.pmod(F.shiftrightunsigned(h, 32), F.lit(RANGES)).cast("int")}
    s, t = (side.select(key).where(F.col(key).isNotNull()).withColumns(ranges) for side in (source, target))
    for level in (["__r0"], ["__r0", "__r1"]):
        apart = checkpointed(_differing(s, t, key, level))
        few = F.broadcast(apart) if apart.limit(BROADCAST_RANGES + 1).count() <= BROADCAST_RANGES else apart
        s, t = (side.join(few, level, "left_semi") for side in (s, t))
    return s.select(key), t.select(key)


def reconcile_ids(source: DataFrame, target: DataFrame, key: str = "in_id") -> DataFrame:
    """One row per id that either side lacks, and where it is; null ids are left out.

    Ids meet in one full join, but only those of ranges in which the digests of the two sides differ: of large sides
    that nearly agree next to nothing is shuffled.
    """
    s, t = differing_ids(source, target, key)
    s, t = s.distinct().withColumn("__s", F.lit(True)), t.distinct().withColumn("__t", F.lit(True))
    side = F.when(F.col("__t").isNull(), "missing_in_target").when(F.col("__s").isNull(), "extra_in_target")
    return s.join(t, key, "full_outer").select(key, side.alias("side")).where("side is not null")


def time_range(df: DataFrame, key: str, closed: str) -> DataFrame:
    return df.agg(F.min(closed).alias("first_closed"), F.max(closed).alias("last_closed"), F.countDistinct(key).alias("ids"))


def id_difference(source: DataFrame, target: DataFrame, key: str = "in_id") -> DataFrame:
    return source.select(key).subtract(target.select(key))


def id_intersection(source: DataFrame, target: DataFrame, key: str = "in_id") -> DataFrame:
    """Matching ids, ids of the source, and match rate in percent."""
    ids = source.select(key).distinct()
    hit = target.select(key).distinct().withColumn("__hit", F.lit(1))
    joined = ids.join(hit, key, "left")
    return joined.agg(F.count("__hit").alias("matching"), F.count(key).alias("ids"), (F.count("__hit") * 100.0 / F.count(key)).alias("match_pct"))


def align_to_schema(df: DataFrame, aliases: dict[str, list[str]]) -> tuple[DataFrame, list[str], list[str]]:
    """Columns renamed from any known alias (whatever its case; the first one wins); also extra and missing names."""
    have = {}
    for c in df.columns:
        have.setdefault(c.lower(), c)
    chosen = {name: next((have[a.lower()] for a in [name, *others] if a.lower() in have), None) for name, others in aliases.items()}
    used = {c for c in chosen.values() if c}
    out = df.select(*(F.col(f"`{old}`").alias(new) if old else F.lit(None).cast("string").alias(new) for new, old in chosen.items()))
    return out, [c for c in df.columns if c not in used], [new for new, old in chosen.items() if not old]


def join_labelers(b: DataFrame, a: DataFrame, b_key: str, a_key: str, b_order: list[str], a_order: list[str], dedupe: bool = True, max_records: int | None = None) -> DataFrame:
    """B inner join A on the trimmed id; every column prefixed.  A keeps its last row per id, B its first."""
    b = b.withColumn(b_key, F.trim(F.col(b_key).cast("string"))).where(F.col(b_key) != "")
    if dedupe:
        b = keep_first(b, [b_key], b_order)
    if max_records is not None:
        b = b.join(b.select(b_key).distinct().orderBy(b_key).limit(max_records), b_key, "left_semi")
    a = keep_last(a, [a_key], a_order)
    left = b.select(*(F.col(c).alias(f"B_{c}") for c in b.columns))
    right = a.select(*(F.col(c).alias(f"A_{c}") for c in a.columns))
    return left.join(right, F.col(f"B_{b_key}") == F.col(f"A_{a_key}"))


def classified_context(labels: DataFrame, source: DataFrame, wanted: list[str]) -> DataFrame:
    """Labels left join source text on whatever id column each has; on a clash of names the label's column wins."""
    left, right = id_column(labels), id_column(source)
    extra = [c for c in wanted if c in source.columns and c not in labels.columns and c != right]
    text = source.select(F.col(right).cast("string").alias("__id"), *extra)
    return labels.join(text, F.col(left).cast("string") == F.col("__id"), "left").drop("__id")


def any_null(*columns: str) -> Column:
    test = F.lit(False)
    for c in columns:
        test = test | F.col(c).isNull()
    return test

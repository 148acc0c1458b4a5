"""Checking labels against taxonomies, gating, cleaning and auditing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.labels import (
    UNCATEGORIZED, UNCLASSIFIED, backfill_missing, canonical, clean_l4, missing, missing_in_target, refused_l4, uncategorized,
)

#: Rows of a taxonomy up to which it is broadcast; a larger one is joined by shuffle.
BROADCAST_TAXONOMY = 100_000


def is_small(taxonomy: DataFrame) -> bool:
    return taxonomy.limit(BROADCAST_TAXONOMY + 1).count() <= BROADCAST_TAXONOMY


def sized(taxonomy: DataFrame, small: bool | None = None) -> DataFrame:
    """``taxonomy``, broadcast if it is small; ``small`` says so of a table that it is made from, so that it isn't counted again."""
    return F.broadcast(taxonomy) if (is_small(taxonomy) if small is None else small) else taxonomy


def taxonomy_table(nested: DataFrame, column: str = "tree") -> DataFrame:
    """Nested map of map of list to rows ``l1, l2, l3``."""
    first = nested.select(F.explode(column).alias("l1", "v1"))
    return first.select("l1", F.explode("v1").alias("l2", "v2")).select("l1", "l2", F.explode("v2").alias("l3"))


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """Aliases of one canonical form that stand for different labels; ``validate_path`` takes the least label of them."""
    found = aliases.groupBy("level", canonical(F.col("alias")).alias("alias")).agg(F.array_sort(F.collect_set(canonical(F.col("label")))).alias("labels"))
    return found.where(F.size("labels") > 1)


def validate_path(df: DataFrame, taxonomy: DataFrame, aliases: DataFrame | None = None, levels: tuple = ("l1", "l2", "l3")) -> DataFrame:
    """``df`` with status, final labels, originals, a repair flag and details; one row for each row of ``df``.

    In this order: ``missing`` (a level missing), ``valid`` (the trimmed labels are a path, which they keep, whatever other
    paths have the same canonical form), ``valid_after_repair`` (their canonical or alias forms are one; of several paths
    of that form the least), ``swapped_levels_suspected`` (another order of them is one), ``invalid_hierarchy`` (each is
    known at its level), ``invalid_label``.  What is not valid ends as Uncategorized.

    The taxonomy and the aliases (``level, alias, label``) are counted once each, to choose broadcast or shuffle joins.
    """
    raw, small = [F.trim(c) for c in levels], is_small(taxonomy)
    keyed = df.withColumns({f"__k{i}": canonical(F.col(c)) for i, c in enumerate(levels)})
    if aliases is not None:
        few = is_small(aliases)
        for i, c in enumerate(levels):
            own = aliases.where(F.col("level") == c).groupBy(canonical(F.col("alias")).alias(f"__a{i}")).agg(F.min(canonical(F.col("label"))).alias(f"__l{i}"))
            keyed = keyed.join(sized(own, few), F.col(f"__k{i}") == F.col(f"__a{i}"), "left").withColumn(f"__k{i}", F.coalesce(f"__l{i}", f"__k{i}")).drop(f"__a{i}", f"__l{i}")
    as_is = taxonomy.select(*(F.col(f"l{i + 1}").alias(f"__e{i}") for i in range(3))).distinct().withColumn("__exact", F.lit(True))
    keyed = keyed.join(sized(as_is, small), [raw[i] == F.col(f"__e{i}") for i in range(3)], "left").drop("__e0", "__e1", "__e2")
    keys = taxonomy.select(*("l1", "l2", "l3"), *(canonical(F.col(f"l{i + 1}")).alias(f"__t{i}") for i in range(3)))
    path = keys.groupBy("__t0", "__t1", "__t2").agg(F.min(F.struct("l1", "l2", "l3")).alias("__path"))
    keyed = keyed.join(sized(path, small), [F.col(f"__k{i}") == F.col(f"__t{i}") for i in range(3)], "left").drop("__t0", "__t1", "__t2")
    mixed = keys.select(F.array_sort(F.array("__t0", "__t1", "__t2")).alias("__m")).distinct().withColumn("__swapped", F.lit(True))
    keyed = keyed.withColumn("__s", F.array_sort(F.array("__k0", "__k1", "__k2"))).join(sized(mixed, small), F.col("__s") == F.col("__m"), "left")
    for i in range(3):
        known = keys.select(F.col(f"__t{i}").alias(f"__n{i}")).distinct()
        keyed = keyed.join(sized(known, small), F.col(f"__k{i}") == F.col(f"__n{i}"), "left")
    exact = F.col("__exact").isNotNull()
    gone = missing(F.col(levels[0])) | missing(F.col(levels[1])) | missing(F.col(levels[2]))
    known = F.col("__n0").isNotNull() & F.col("__n1").isNotNull() & F.col("__n2").isNotNull()
    status = (
        F.when(gone, "missing").when(exact, "valid").when(F.col("__path").isNotNull(), "valid_after_repair")
        .when(F.col("__swapped"), "swapped_levels_suspected").when(known, "invalid_hierarchy").otherwise("invalid_label")
    )
    out = keyed.withColumn("validation_status", status)
    good = F.col("validation_status").isin("valid", "valid_after_repair")
    finals = [F.when(good & exact, raw[i]).when(good, F.col(f"__path.l{i + 1}")).otherwise(UNCATEGORIZED).alias(f"final_l{i + 1}") for i in range(3)]
    originals = [F.col(c).alias(f"original_l{i + 1}") for i, c in enumerate(levels)]
    details = F.to_json(F.struct(F.col("validation_status").alias("status"), *originals)).alias("validation_details")
    kept = [c for c in df.columns if c not in levels]
    return out.select(*kept, "validation_status", *finals, *originals, (F.col("validation_status") == "valid_after_repair").alias("repair_applied"), details)


def l123_audit(validated: DataFrame, run_id: str, key: str = "in_id") -> DataFrame:
    columns = [f"{kind}_l{i}" for kind in ("original", "final") for i in (1, 2, 3)]
    return validated.where("validation_status <> 'valid'").select(key, F.lit(run_id).alias("run_id"), F.col("validation_status").alias("status"), *columns, "repair_applied", F.col("validation_details").alias("details"))


def l4_valid(df: DataFrame, taxonomy: DataFrame, subcategory: str, label: str) -> DataFrame:
    """``df`` with ``l4_valid``: the label is a category of its subcategory's taxonomy, whatever its case."""
    keys = taxonomy.select(F.col("subcategory").alias("__sub"), F.lower("name").alias("__name")).distinct()
    joined = df.join(sized(keys), (F.col(subcategory) == F.col("__sub")) & (F.lower(F.trim(label)) == F.col("__name")), "left")
    return joined.withColumn("l4_valid", F.col("__name").isNotNull()).drop("__sub", "__name")


def l4_in_run_valid(df: DataFrame, taxonomy: DataFrame, subcategory: str, label: str) -> DataFrame:
    """The gate while labelling: no refused word, and the official fallback or in the taxonomy."""
    checked = l4_valid(df, taxonomy, subcategory, label)
    fallback = F.lower(F.trim(label)) == UNCLASSIFIED.lower()
    return checked.withColumn("l4_accepted", ~refused_l4(F.col(label)) & (F.coalesce(fallback, F.lit(False)) | F.col("l4_valid")))


def l4_clean(df: DataFrame, label: str) -> DataFrame:
    """The label cleaned for the end, and the label as it was where it changed."""
    new = clean_l4(F.col(label))
    return df.withColumns({"l4_original": F.when(~new.eqNullSafe(F.col(label)), F.col(label)), "l4_clean": new})


def backfill(df: DataFrame, levels: tuple) -> DataFrame:
    """Missing levels become Uncategorized; ``backfilled`` marks the rows that changed."""
    changed = F.lit(False)
    for c in levels:
        changed = changed | backfill_missing(F.col(c))
    filled = {c: F.when(backfill_missing(F.col(c)), UNCATEGORIZED).otherwise(F.col(c)) for c in levels}
    return df.withColumn("backfilled", changed).withColumns(filled)


def pre_l4_gate(df: DataFrame, subcategory: str) -> tuple[DataFrame, DataFrame]:
    """Rows that go on to level 4, and rows that do not: those get the fallback and a reason."""
    blocked = df.where(uncategorized(F.col(subcategory)))
    made = blocked.withColumns({
        "l4_category": F.lit(UNCLASSIFIED), "l4_confidence": F.lit(0.0), "is_actionable": F.lit(False), "reason": F.lit("l123_invalid_blocks_l4"),
    })
    return df.where(~uncategorized(F.col(subcategory))), made


def l4_null_reasons(df: DataFrame, label: str, original: str, run_id: str, key: str = "in_id") -> DataFrame:
    """One row for each incident whose final level 4 is missing: cleaned away (with its old value) or never there."""
    reason = F.when(F.col(original).isNotNull(), "cleaned").otherwise("missing")
    return df.where(missing(F.col(label))).select(key, F.lit(run_id).alias("run_id"), reason.alias("reason"), F.col(original).alias("original_value"))


def final_reason(reasons: DataFrame, order: list[str], key: str = "in_id") -> DataFrame:
    """At most one reason per incident, the last one; null ids are left out."""
    last = reasons.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by("reason", F.struct(*order)).alias("reason"))
    return last


def reason_breakdown(reasons: DataFrame) -> DataFrame:
    return reasons.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "reason")


def missing_l4(target: DataFrame, label: str, closed: str, start: str, end: str) -> DataFrame:
    """Target rows without level 4 closed in the window, the end date included to its last second."""
    day = F.to_date(closed)
    return target.where(missing_in_target(F.col(label)) & (day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date")))


def target_ids(target: DataFrame, closed: str, start: str, end: str, key: str = "in_id") -> DataFrame:
    day = F.to_date(closed)
    return target.where((day >= F.lit(start).cast("date")) & (day <= F.lit(end).cast("date"))).select(key).distinct()


def cohorts(df: DataFrame, audit: DataFrame, label: str, key: str = "in_id") -> DataFrame:
    """Cohort A: levels 1-3 not valid; B: level 4 missing under valid levels 1-3; others are left out."""
    status = audit.select(F.col(key).alias("__id"), F.col("status").alias("__status"))
    joined = df.join(status, F.col(key) == F.col("__id"), "left")
    bad = F.col("__status").isNotNull() & (F.col("__status") != "valid_after_repair")
    cohort = F.when(bad, "A").when(missing(F.col(label)), "B")
    return joined.withColumn("cohort", cohort).where("cohort is not null").drop("__id", "__status")


def path_integrity(df: DataFrame, reasons: DataFrame, label: str, key: str = "in_id") -> DataFrame:
    """Per incident: levels 1-3 valid, and level 4 valid, the fallback, or null with a reason."""
    known = reasons.select(F.col(key).alias("__id")).distinct()
    joined = df.join(known, F.col(key) == F.col("__id"), "left")
    good = F.col("validation_status").isin("valid", "valid_after_repair")
    fallback = F.coalesce(F.trim(label) == UNCLASSIFIED, F.lit(False))
    whole = good & (F.col("l4_valid") | fallback | (missing(F.col(label)) & F.col("__id").isNotNull()))
    return joined.select(key, good.alias("l123_ok"), whole.alias("path_ok"))


def share(test: Column) -> Column:
    return F.avg(F.coalesce(test, F.lit(False)).cast("double")) * 100

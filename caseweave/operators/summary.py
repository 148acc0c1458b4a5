"""Summaries of runs, validity, drift, and label distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.functions.labels import UNCATEGORIZED, UNCLASSIFIED, missing, usable

GOOD = ("valid", "valid_after_repair")


def fill_rates(df: DataFrame, columns: list[str]) -> DataFrame:
    """Per column: count and percent that is not null; an absent column is reported with nulls.  One pass."""
    have = [c for c in columns if c in df.columns]
    counted = df.agg(F.count(F.lit(1)).alias("__n"), *(F.count(F.col(c)).alias(c) for c in have))
    entry = lambda c: F.struct(F.lit(c).alias("column"), (F.col(c) if c in have else F.lit(None).cast("long")).alias("filled"))
    rows = counted.select("__n", F.explode(F.array(*(entry(c) for c in columns))).alias("e"))
    return rows.select("e.column", "e.filled", (F.col("e.filled") * 100.0 / F.col("__n")).alias("pct"))


def category_distribution(df: DataFrame, l1: str, l2: str, k: int = 5) -> DataFrame:
    """Per level 1 its count and share, with its commonest level-2 labels and their shares."""
    counts = df.groupBy(l1, l2).agg(F.count(F.lit(1)).alias("n"))
    by = Window.partitionBy(l1)
    total = F.sum("n").over(by)
    shares = counts.select(F.col(l1).alias("l1"), F.col(l2).alias("l2"), "n", total.alias("l1_n"), (F.col("n") / total * 100).alias("pct"),
                           F.row_number().over(by.orderBy(F.desc("n"), F.asc_nulls_first(l2))).alias("rank"))
    rows = df.agg(F.count(F.lit(1)).alias("__all"))  # one row
    return shares.where(F.col("rank") <= k).join(F.broadcast(rows)).withColumn("l1_pct", F.col("l1_n") / F.col("__all") * 100).drop("__all")


def run_summary(df: DataFrame, run: str, subcategory: str, status: str, l4: str, actionable: str) -> DataFrame:
    """Per run and subcategory, and per run: rows, validity, level 4 present, fallback or missing, actionable."""
    fallback = F.coalesce(F.trim(l4) == UNCLASSIFIED, F.lit(False))
    gone = missing(F.col(l4))
    out = df.rollup(run, subcategory).agg(
        F.grouping(subcategory).cast("int").alias("whole_run"), F.count(F.lit(1)).alias("rows"), F.count_if(F.col(status).isin(*GOOD)).alias("valid"),
        F.count_if(~F.col(status).isin(*GOOD)).alias("invalid"), F.count_if(~gone & ~fallback).alias("l4_present"), F.count_if(fallback).alias("l4_fallback"),
        F.count_if(gone).alias("l4_missing"), F.count_if(F.col(actionable)).alias("actionable"), F.grouping(run).alias("__all"),
    )
    return out.where("__all = 0").drop("__all")


def coverage_contract(summary: DataFrame, min_valid_pct: float, max_missing_pct: float) -> DataFrame:
    whole = summary.where("whole_run = 1")
    ok = (F.col("valid") * 100.0 / F.col("rows") >= min_valid_pct) & (F.col("l4_missing") * 100.0 / F.col("rows") <= max_missing_pct)
    return whole.withColumn("state", F.when(ok, "ok").otherwise("degraded"))


def validity_report(df: DataFrame, status: str, l4: str, levels: tuple) -> DataFrame:
    """Named shares in percent: paths that are valid, each status, levels filled, level-4 fallback, complete paths."""
    good = F.col(status).isin(*GOOD)
    pct = lambda test: F.avg(F.coalesce(test, F.lit(False)).cast("double")) * 100
    fallback = F.coalesce(F.trim(l4) == UNCLASSIFIED, F.lit(False))
    measures = {"valid": pct(good), "l4_fallback": pct(fallback), "complete": pct(good & ~missing(F.col(l4)) & ~fallback)}
    measures |= {f"filled_{c}": pct(F.col(c).isNotNull()) for c in (*levels, l4)}
    one = df.agg(*(v.alias(k) for k, v in measures.items()))
    shares = one.select(F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), F.col(k).alias("pct")) for k in measures))).alias("m")).select("m.*")
    n = df.agg(F.count(F.lit(1)).alias("__n"))
    states = df.groupBy(status).agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(n))
    return shares.unionByName(states.select(F.concat(F.lit("status_"), status).alias("measure"), (F.col("c") * 100.0 / F.col("__n")).alias("pct")))


def worst_pairs(df: DataFrame, status: str, upper: str, lower: str, k: int = 10) -> DataFrame:
    bad = df.where(~F.col(status).isin(*GOOD)).groupBy(upper, lower).agg(F.count(F.lit(1)).alias("n"))
    return bad.orderBy(F.desc("n"), F.asc_nulls_first(upper), F.asc_nulls_first(lower)).limit(k)


def label_drift(df: DataFrame, label: str, moment: str, unit: str) -> DataFrame:
    """Entropy in bits and share of the commonest label per period."""
    counts = df.where(usable(F.col(label))).groupBy(F.date_trunc(unit, moment).cast("date").alias("period"), label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.select("period", "n", F.sum("n").over(Window.partitionBy("period")).alias("t"))
    p = F.col("n") / F.col("t")
    return total.groupBy("period").agg(F.sum("n").alias("rows"), F.sum(-p * F.log2(p)).alias("entropy"), (F.max(p) * 100).alias("top_pct"))


def sparse_rich(df: DataFrame, status: str, text: str, min_chars: int) -> DataFrame:
    """Among invalid rows: count and share with sparse and with rich text."""
    kind = F.when(F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) >= min_chars, "rich").otherwise("sparse")
    counts = df.where(~F.col(status).isin(*GOOD)).groupBy(kind.alias("text_kind")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(Window.partitionBy(F.lit(1))))


def mode_category(df: DataFrame, l1: str, l2: str) -> DataFrame:
    """The commonest level 1 of each level 2, the smallest among equals."""
    return df.where(F.col(l1).isNotNull()).groupBy(l2).agg(F.mode(l1, True).alias("category"))


def subcategories(df: DataFrame, l2: str) -> DataFrame:
    return df.where(F.col(l2).isNotNull() & (F.col(l2) != UNCATEGORIZED)).select(l2).distinct()

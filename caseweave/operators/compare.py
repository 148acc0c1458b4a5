"""Comparison of two labelers, A and B, over a frame with ``a_l1..a_l4`` and ``b_l1..b_l4``.

Levels are stacked to rows once, so each metric is one aggregation over narrow rows instead of one pass per level.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.functions.labels import filled, norm, trueish, usable
from caseweave.sources.shared import checkpointed

LEVELS = ("L1", "L2", "L3", "L4")


def comparison_frame(joined: DataFrame, names: dict[str, str], key: str, other_key: str) -> tuple[DataFrame, Column]:
    """``joined`` renamed and ordered by ``names`` (new -> old), without the second id; and an id-mismatch test to count."""
    mismatch = ~F.trim(F.col(key).cast("string")).eqNullSafe(F.trim(F.col(other_key).cast("string")))
    kept = {new: old for new, old in names.items() if old != other_key}
    return joined.select(*(F.col(old).alias(new) for new, old in kept.items())), mismatch


def stacked(frame: DataFrame, *keep: str) -> DataFrame:
    """One row per incident and level: ``level, a, b`` and the columns to keep."""
    pairs = F.array(*(F.struct(F.lit(x).alias("level"), F.col(f"a_{x.lower()}").alias("a"), F.col(f"b_{x.lower()}").alias("b")) for x in LEVELS))
    return frame.select(*keep, F.explode(pairs).alias("p")).select(*keep, "p.level", "p.a", "p.b")


def labels_of(frame: DataFrame) -> DataFrame:
    """Usable normalised labels: ``model, level, label``."""
    both = F.array(*(F.struct(F.lit(m).alias("model"), F.col(m.lower()).alias("v")) for m in ("A", "B")))
    rows = stacked(frame).select("level", F.explode(both).alias("m")).select("m.model", "level", F.col("m.v").alias("v"))
    return rows.where(usable(F.col("v"))).select("model", "level", norm(F.col("v")).alias("label"))


def coverage(frame: DataFrame) -> DataFrame:
    share = lambda c: F.avg(usable(F.col(c)).cast("double")) * 100
    out = stacked(frame).groupBy("level").agg(share("a").alias("a_pct"), share("b").alias("b_pct"))
    return out.withColumn("difference", F.col("a_pct") - F.col("b_pct"))


def top_k(counts: DataFrame, keys: list[str], by: list[Column], k: int) -> DataFrame:
    """``keys``, ``rank`` and ``row`` (a struct of ``by``): the first ``k`` rows of each key in the order of ``by``, in two steps.

    Rows are first cut to ``k`` within salts of their key, as many as there are shuffle partitions, then within the key.
    So a key's rows are never sorted in one task, however few keys there are.
    """
    salts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    first = lambda rows: F.slice(F.sort_array(F.collect_list(rows)), 1, k)
    own = counts.select(*keys, F.struct(*by).alias("row"))
    parts = own.groupBy(*keys, F.pmod(F.xxhash64("row"), F.lit(salts)).alias("__salt")).agg(first(F.col("row")).alias("rows"))
    best = parts.select(*keys, F.explode("rows").alias("row")).groupBy(*keys).agg(first(F.col("row")).alias("rows"))
    return best.select(*keys, F.posexplode("rows").alias("rank", "row")).withColumn("rank", F.col("rank") + 1)


def _label_counts(frame: DataFrame) -> DataFrame:
    return labels_of(frame).groupBy("model", "level", "label").agg(F.count(F.lit(1)).alias("n"))


def granularity(frame: DataFrame) -> DataFrame:
    """Rows, distinct labels, share of the ten commonest labels and entropy in bits, per labeler and level.

    All of it adds up: the entropy of counts ``n`` with the sum ``t`` is log2(t) - sum(n log2(n)) / t.
    """
    counts, n = _label_counts(frame), F.col("n")
    sums = counts.groupBy("model", "level").agg(
        F.sum(n).alias("rows"), F.count(F.lit(1)).alias("labels"), (F.log2(F.sum(n)) - F.sum(n * F.log2(n)) / F.sum(n)).alias("entropy")
    )
    top = top_k(counts, ["model", "level"], [(-n).alias("m"), F.col("label")], 10).groupBy("model", "level").agg((-F.sum("row.m")).alias("top"))
    return sums.join(F.broadcast(top), ["model", "level"]).select("model", "level", "rows", "labels", (F.col("top") / F.col("rows") * 100).alias("top10_pct"), "entropy")


def top_labels(frame: DataFrame, k: int = 20) -> DataFrame:
    counts, n = _label_counts(frame), F.col("n")
    totals = counts.groupBy("model", "level").agg(F.sum(n).alias("t"))
    best = top_k(counts, ["model", "level"], [(-n).alias("m"), F.col("label")], k).join(F.broadcast(totals), ["model", "level"])
    return best.select("model", "level", "row.label", (-F.col("row.m")).alias("n"), (-F.col("row.m") / F.col("t") * 100).alias("pct"), "rank")


def _both(frame: DataFrame, *keep: str) -> DataFrame:
    rows = stacked(frame, *keep)
    return rows.select(*keep, "level", "a", "b", (usable(F.col("a")) & usable(F.col("b"))).alias("both"), (norm(F.col("a")) == norm(F.col("b"))).alias("same"))


def _agreement() -> list[Column]:
    same = F.count_if(F.col("both") & F.col("same"))
    return [F.count_if("both").alias("n_both"), (same * 100.0 / F.nullif(F.count_if("both"), F.lit(0))).alias("agreement_pct")]


def agreement(frame: DataFrame) -> DataFrame:
    return _both(frame).groupBy("level").agg(*_agreement())


def stratified_agreement(frame: DataFrame, period: str = "period", min_rows: int = 20) -> DataFrame:
    """Agreement per (A level 1, period) and per (A levels 1-3), in one pass over grouping sets.  Keys are raw labels."""
    base = frame.where(usable(F.col("a_l1")) & usable(F.col("a_l2")) & usable(F.col("a_l3")))
    rows = _both(base, "a_l1", "a_l2", "a_l3", period)
    sets = [["a_l1", period, "level"], ["a_l1", "a_l2", "a_l3", "level"]]
    cols = ["a_l1", "a_l2", "a_l3", period, "level"]
    named = F.when(F.grouping("a_l2") == 1, "l1_period").otherwise("l1_l2_l3").alias("stratum")
    out = rows.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(named, F.count(F.lit(1)).alias("rows"), *_agreement())
    dated = (F.col("stratum") != "l1_period") | filled(F.col(period).cast("string"))
    return out.where((F.col("n_both") >= min_rows) & dated)


def top_disagreements(frame: DataFrame, k: int = 25) -> DataFrame:
    """Commonest (B, A) pairs of differing labels per level, with their share of rows where both are usable."""
    rows = _both(frame).where("both").select("level", norm(F.col("b")).alias("b"), norm(F.col("a")).alias("a"))
    counts, n = rows.groupBy("level", "b", "a").agg(F.count(F.lit(1)).alias("n")), F.col("n")
    totals = counts.groupBy("level").agg(F.sum(n).alias("t"))
    best = top_k(counts.where("a <> b"), ["level"], [(-n).alias("m"), F.col("b"), F.col("a")], k).join(F.broadcast(totals), "level")
    return best.select("level", "row.b", "row.a", (-F.col("row.m")).alias("n"), (-F.col("row.m") / F.col("t") * 100).alias("pct"), "rank")


def stratum_top_pair(frame: DataFrame) -> DataFrame:
    """The single commonest differing pair of each A level-1 stratum and level."""
    base = frame.where(usable(F.col("a_l1")) & usable(F.col("a_l2")) & usable(F.col("a_l3")))
    rows = _both(base, "a_l1").where("both and not same")
    counts = rows.groupBy("a_l1", "level", norm(F.col("b")).alias("b"), norm(F.col("a")).alias("a")).agg(F.count(F.lit(1)).alias("n"))
    first = F.min(F.struct((-F.col("n")).alias("m"), "b", "a")).alias("p")
    return counts.groupBy("a_l1", "level").agg(first).select("a_l1", "level", "p.b", "p.a", (-F.col("p.m")).alias("n"))


def worst_strata(strata: DataFrame, k: int = 5) -> DataFrame:
    """Strata with the least agreement at level 4; more rows first among equals."""
    order = ["agreement_pct", F.desc("n_both"), "stratum", "a_l1", "a_l2", "a_l3", "period"]
    return strata.where("level = 'L4'").orderBy(*order).limit(k)


EXPLANATION_FIELDS = ("rationale", "l4_rationale", "keywords", "root_cause_indicator", "root_cause", "l4_resolution_action", "actionability_reason", "l4_confidence")


def exact_medians(rows: DataFrame, group: str, value: str) -> DataFrame:
    """``group`` (few values), ``median``: exact, by selection over range partitions; nulls don't count, no values: no row.

    Distinct values are counted and dealt by ranges (a histogram of about equal bins).  The bins' sums say in which bin of a
    group its middle ranks are, and only those bins are put in order, so no task holds more than a bin.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(group, value).agg(F.count(F.lit(1)).alias("n"))
    dealt = checkpointed(counts.repartitionByRange(group, value).withColumn("bin", F.spark_partition_id()))
    before = Window.partitionBy(group).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    bins = dealt.groupBy(group, "bin").agg(F.sum("n").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))  # one row a bin
    bins = bins.withColumn("total", F.sum("n").over(Window.partitionBy(group)))
    middle = F.explode(F.array_distinct(F.array(F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1))).alias("rank")
    wanted = bins.select(group, "bin", "n", "before", middle).where("rank > before and rank <= before + n").select(group, "bin", "before", "rank")
    own = dealt.join(F.broadcast(wanted), [group, "bin"])
    until = F.col("before") + F.sum("n").over(Window.partitionBy(group, "bin", "rank").orderBy(value))
    found = own.withColumn("until", until).where("until >= rank and until - n < rank")
    return found.groupBy(group).agg(F.avg(value).alias("median"))


def explainability(frame: DataFrame, fields: dict[str, str], confidence: str, actionable: str, label: str = "a_l4") -> DataFrame:
    """Per slice and field the share of filled values, and mean and exact median of the confidence.

    A row is in up to three of four slices, so slices are an exploded array of names and all of it is one aggregation.
    """
    good, yes = usable(F.col(label)), trueish(F.col(actionable))
    slices = F.array_compact(F.array(
        F.lit("all"), F.when(good, "usable"), F.when(good & yes, "usable_actionable"), F.when(good & ~yes, "usable_not_actionable")
    ))
    number = F.col(confidence).try_cast("double")
    rows = frame.select(F.explode(slices).alias("slice"), number.alias("__number"), *(filled(F.col(c).cast("string")).alias(n) for n, c in fields.items()))
    shares = [(F.avg(F.col(n).cast("double")) * 100).alias(f"{n}_pct") for n in fields]
    numeric = (F.avg(F.col("__number").isNotNull().cast("double")) * 100).alias("numeric_confidence_pct")
    sums = rows.groupBy("slice").agg(F.count(F.lit(1)).alias("rows"), *shares, numeric, F.avg("__number").alias("confidence_mean"))
    medians = exact_medians(rows, "slice", "__number").withColumnRenamed("median", "confidence_median")
    return sums.join(F.broadcast(medians), "slice", "left")  # four rows


#: Names and upper ends of the bins, each closed on the right.
CONFIDENCE_BINS = (("<0", 0.0), ("0-0.25", 0.25), ("0.25-0.5", 0.5), ("0.5-0.75", 0.75), ("0.75-1.0", 1.0), (">1.0", None))


def binned(value: Column, bins: tuple) -> Column:
    out = F.lit(bins[-1][0])
    for name, end in reversed(bins):
        if end is not None:
            out = F.when(value <= end, name).otherwise(out)
    return F.when(value.isNotNull() & ~F.isnan(value), out)


def confidence_histogram(frame: DataFrame, confidence: str, label: str = "a_l4") -> DataFrame:
    """Counts by bin over rows with a usable level 4; empty bins are shown with 0."""
    value = F.col(confidence).try_cast("double")
    found = frame.where(usable(F.col(label)) & value.isNotNull()).select(binned(value, CONFIDENCE_BINS).alias("bin"))
    counts = found.groupBy("bin").agg(F.count(F.lit(1)).alias("n"))
    names = frame.sparkSession.createDataFrame([(b[0],) for b in CONFIDENCE_BINS], "bin string")
    out = names.join(counts, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))
    total = counts.agg(F.sum("n").alias("t"))  # one row
    return out.join(F.broadcast(total)).select("bin", "n", (F.col("n") / F.col("t") * 100).alias("pct"))

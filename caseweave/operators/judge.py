"""Summaries of judge scores: verdict shares, recomputed averages, path and automation scores, calibration."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseweave.functions.labels import trueish
from caseweave.operators.compare import binned


def flatten_judge(df: DataFrame, column: str = "judge", labelers: tuple = ("a", "b"), dims: int = 7) -> DataFrame:
    """Nested scores to one wide row: ``a_d1 ... b_d7`` as text, and the verdict."""
    paths = [F.col(f"{column}.{m}.d{k}.score").alias(f"{m}_d{k}") for m in labelers for k in range(1, dims + 1)]
    return df.select("in_id", *paths, F.col(f"{column}.verdict").alias("verdict_overall"), "error")


def mean_score(*scores: Column) -> Column:
    """Mean of scores given as text; ``N`` and other non-numbers are left out of both sides; null if none is left."""
    numbers = F.array_compact(F.array(*(s.try_cast("double") for s in scores)))
    total = F.aggregate(numbers, F.lit(0.0), lambda s, x: s + x)
    return F.when(F.size(numbers) > 0, total / F.size(numbers))


def judge_rescore(df: DataFrame, section1: int = 4, dims: int = 7, tie: float = 0.25) -> DataFrame:
    """Section and overall averages from the seven scores, and the verdict with its tie margin."""
    out = df
    for m in "ab":
        scores = [F.col(f"{m}_d{k}") for k in range(1, dims + 1)]
        out = out.withColumns({f"{m}_section1": mean_score(*scores[:section1]), f"{m}_section2": mean_score(*scores[section1:]), f"{m}_overall": mean_score(*scores)})
    difference = F.col("a_overall") - F.col("b_overall")
    return out.withColumn("verdict", F.when(F.abs(difference) <= tie, "Tie").when(difference > 0, "A").when(difference < 0, "B"))


def verdict_of(c: Column) -> Column:
    text = F.upper(F.trim(c))
    return F.when(text == "TIE", "Tie").when(text.contains("LABELER A"), "A").when(text.contains("LABELER B"), "B").otherwise(text)


def judge_summary(df: DataFrame, verdicts: list[str], means: list[str], gap: str, k: int = 5) -> DataFrame:
    """Rows ``metric, item, value`` over successful rows: verdict shares, means, mean difference, commonest largest gaps."""
    ok = df.where(F.col("error").isNull() & F.col(verdicts[0]).isNotNull())
    n = ok.agg(F.count(F.lit(1)).alias("__n"))
    kinds = ok.select(F.explode(F.array(*(F.struct(F.lit(v).alias("metric"), verdict_of(F.col(v)).alias("item")) for v in verdicts))).alias("v")).select("v.*")
    share = F.col("c") * 100.0 / F.col("__n")
    shares = kinds.where("item is not null").groupBy("metric", "item").agg(F.count(F.lit(1)).alias("c")).join(F.broadcast(n)).select("metric", "item", share.alias("value"))
    one = ok.agg(*(F.avg(c).alias(c) for c in means), F.avg(F.col("a_overall") - F.col("b_overall")).alias("a_minus_b"))
    named = F.array(*(F.struct(F.lit("mean").alias("metric"), F.lit(c).alias("item"), F.col(c).alias("value")) for c in [*means, "a_minus_b"]))
    tops = ok.groupBy(F.col(gap).alias("item")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), "item").limit(k).join(F.broadcast(n))
    return shares.unionByName(one.select(F.explode(named).alias("m")).select("m.*")).unionByName(tops.select(F.lit("largest_gap").alias("metric"), "item", share.alias("value")))


def _sides(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows scored for both labelers, one row per labeler."""
    ok = df.where("a_error is null and b_error is null")
    both = F.array(*(F.struct(F.lit(m.upper()).alias("model"), *(F.col(f"{m}_{c}").alias(c) for c in columns)) for m in "ab"))
    return ok.select(F.explode(both).alias("s")).select("s.*")


def path_scores(df: DataFrame) -> DataFrame:
    parts = ["l1l2", "l2l3", "l3l4", "overall"]
    zero = F.lit(False)
    for c in parts:
        zero = zero | F.coalesce(F.col(c) == 0, F.lit(False))
    pct = lambda test: F.avg(test.cast("double")) * 100
    return _sides(df, [*parts, "weakest"]).groupBy("model").agg(
        *(F.avg(c).alias(f"mean_{c}") for c in parts), pct(F.coalesce(F.col("overall") == 3, F.lit(False))).alias("perfect_pct"), pct(zero).alias("zero_pct"),
        F.mode("weakest", True).alias("weakest"),
    )


def automation_scores(df: DataFrame) -> DataFrame:
    c = F.col("composite")
    pct = lambda test: F.avg(F.coalesce(test, F.lit(False)).cast("double")) * 100
    return _sides(df, ["action", "system", "routing", "composite"]).groupBy("model").agg(
        F.avg("composite").alias("mean_composite"), pct(c >= 5).alias("high_pct"), pct((c >= 3) & (c <= 4)).alias("medium_pct"), pct(c <= 2).alias("low_pct"),
        *(F.avg(x).alias(f"mean_{x}") for x in ("action", "system", "routing")),
    )


def calibration_join(frame: DataFrame, judged: DataFrame, confidence: str, key: str = "in_id") -> DataFrame:
    """Confidence and judge score of rows without error, both numbers."""
    scores = judged.where("error is null").select(key, F.col("a_overall").cast("string").try_cast("double").alias("score"))
    joined = frame.withColumn("confidence", F.col(confidence).cast("string").try_cast("double")).join(scores, key)
    return joined.where("confidence is not null and score is not null and not isnan(confidence) and not isnan(score)")


#: Names and upper ends of the bins, each closed on the right; confidences are first held to 0..1.
CALIBRATION_BINS = (("<0.50", 0.5), ("0.50-0.60", 0.6), ("0.60-0.70", 0.7), ("0.70-0.80", 0.8), ("0.80-0.90", 0.9), ("0.90-1.00", None))


def calibration_bins(joined: DataFrame) -> DataFrame:
    held = F.least(F.greatest("confidence", F.lit(0.0)), F.lit(1.0))
    return joined.groupBy(binned(held, CALIBRATION_BINS).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.stddev_samp("score").alias("std"))


def correlation_p(r: float, n: int) -> float:
    """Two-sided p-value of a correlation: the t distribution's tail as a regularised incomplete beta function."""
    if n < 3 or r is None or math.isnan(r):
        return float("nan")
    if abs(r) >= 1:
        return 0.0
    a, b, x = (n - 2) / 2, 0.5, 1 - r * r

    def fraction(a: float, b: float, x: float) -> float:  # Lentz's continued fraction
        c, d = 1.0, 1 - (a + b) * x / (a + 1)
        d = 1 / (d or 1e-300)
        h = d
        for m in range(1, 500):
            for term in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
                d = 1 / ((1 + term * d) or 1e-300)
                c = (1 + term / c) or 1e-300
                h *= c * d
            if abs(c * d - 1) < 1e-14:
                break
        return h

    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * fraction(a, b, x) / a
    return 1 - front * fraction(b, a, 1 - x) / b


def calibration(joined: DataFrame, actionable: str, min_r: float = 0.3, max_p: float = 0.05, gap: float = 0.3) -> DataFrame:
    """One row: r, p, whether calibrated, mean scores by the actionable flag and whether the flag tells them apart."""
    yes = trueish(F.col(actionable))
    one = joined.agg(F.corr("confidence", "score").alias("r"), F.count(F.lit(1)).alias("n"), F.avg(F.when(yes, F.col("score"))).alias("mean_actionable"), F.avg(F.when(~yes, F.col("score"))).alias("mean_other"))
    row = one.first()
    r, n = row["r"], row["n"]
    p = correlation_p(r, n) if r is not None else None
    valid = F.coalesce(F.abs(F.col("mean_actionable") - F.col("mean_other")) > gap, F.lit(False))
    calibrated = bool(r is not None and p is not None and r > min_r and p < max_p)
    return one.withColumns({"p": F.lit(p).cast("double"), "calibrated": F.lit(calibrated), "flag_valid": valid})

"""Clusters of incidents with the same label path, and their cumulative shares."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseweave.functions.labels import intervention_type, label_path, usable
from caseweave.sources.shared import checkpointed

#: Level-3 labels that catch all, compared with case.
CATCH_ALL = ("Error / Failure", "Other", "Unknown", "Error", "General", "Application/Service", "Desktop Related", "Other RFI")
MIN_CLUSTER = 3


def clusters(frame: DataFrame) -> DataFrame:
    """Rows per labeler, full path and raw levels; rows without a path are left out, null levels form groups."""
    sides = F.array(*(
        F.struct(F.lit(m.upper()).alias("model"), label_path(*(F.col(f"{m}_l{k}") for k in range(1, 5))).alias("path"),
                 *(F.col(f"{m}_l{k}").alias(f"l{k}") for k in range(1, 5)))
        for m in ("a", "b")
    ))
    rows = frame.select(F.explode(sides).alias("s")).select("s.*").where("path is not null")
    return rows.groupBy("model", "path", "l1", "l2", "l3", "l4").agg(F.count(F.lit(1)).alias("n"))


def rank_clusters(found: DataFrame, catch_all: tuple = CATCH_ALL, min_cluster: int = MIN_CLUSTER) -> DataFrame:
    """Rank by volume, share, running share, catch-all and viability; ties by path and levels.

    Clusters are sorted over range partitions.  Ranks and running sums are made within a partition's clusters of a
    labeler, and shifted by the totals of the partitions before it (one row a partition and labeler).
    """
    place = [F.desc("n"), F.col("path"), *(F.asc_nulls_first(f"l{k}") for k in range(1, 5))]
    dealt = checkpointed(found.repartitionByRange("model", *place).withColumn("__part", F.spark_partition_id()))
    totals = dealt.groupBy("model", "__part").agg(F.count(F.lit(1)).alias("__rows"), F.sum("n").alias("__sum"))
    before = Window.partitionBy("model").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    whole = F.sum("__sum").over(Window.partitionBy("model")).alias("__total")
    shifts = totals.select("model", "__part", ahead("__rows").alias("__rank"), ahead("__sum").alias("__before"), whole)
    by = Window.partitionBy("model", "__part").orderBy(*place)
    running = F.col("__before") + F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    catches = F.coalesce(F.col("l3").isin(*catch_all), F.lit(False))
    return dealt.join(shifts, ["model", "__part"]).select(
        *found.columns, (F.col("__rank") + F.row_number().over(by)).cast("int").alias("rank"), (F.col("n") / F.col("__total") * 100).alias("pct"),
        (running / F.col("__total") * 100).alias("cumulative_pct"),
        catches.alias("catch_all"), ((F.col("n") >= min_cluster) & ~catches & usable(F.col("l4"))).alias("viable"),
    )


def pareto(ranked: DataFrame) -> DataFrame:
    """Per labeler: totals, clusters needed for half and four fifths of the rows, shares, largest cluster.

    "Needed" is the number of clusters up to the share, plus one, which may exceed the number of clusters.
    """
    n = F.col("n")
    share = lambda test: F.sum(F.when(test, n).otherwise(0)) / F.sum(n) * 100
    return ranked.groupBy("model").agg(
        F.sum(n).alias("incidents"), F.countDistinct("path").alias("paths"),
        (F.count_if(F.col("cumulative_pct") <= 50) + 1).alias("to_cover_50"), (F.count_if(F.col("cumulative_pct") <= 80) + 1).alias("to_cover_80"),
        share(F.col("viable")).alias("viable_pct"), share(F.col("catch_all")).alias("catch_all_pct"),
        F.min_by("path", "rank").alias("largest_path"), F.min_by("pct", "rank").alias("largest_pct"),
    )


def top_viable(ranked: DataFrame, k: int = 20) -> DataFrame:
    by = Window.partitionBy("model").orderBy("rank")
    picked = ranked.where("viable").select("*", F.row_number().over(by).alias("r")).where(F.col("r") <= k)
    return picked.select("model", "rank", "path", "n", "pct", intervention_type(F.col("path")).alias("intervention"))

"""Repeatable samples and batches: rows are ordered by a hash of seed and id, never by arrival."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseweave.functions.labels import nonempty, usable


def seeded(key: str, seed: int) -> Column:
    """Hash order that other engines can state: MD5 of seed and id."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))


def stratified_sample(df: DataFrame, levels: list[str], month: str, key: str, k: int = 2, n: int = 500, seed: int = 7) -> DataFrame:
    """Rows with all levels and a month; at most k of each (levels, month), then n overall."""
    good = F.col(month).isNotNull()
    for c in levels:
        good = good & nonempty(F.col(c))
    by = Window.partitionBy(*levels, month).orderBy(seeded(key, seed), key)
    few = df.where(good).withColumn("__r", F.row_number().over(by)).where(F.col("__r") <= k).drop("__r")
    return few.orderBy(seeded(key, seed), key).limit(n)


def seeded_sample(df: DataFrame, a: str, b: str, key: str, n: int, seed: int) -> DataFrame:
    """n rows by seed of those with both labels usable; of all rows if there are none."""
    both = usable(F.col(a)) & usable(F.col(b))
    best = df.where(both)
    pool = df if best.isEmpty() else best
    return pool.orderBy(seeded(key, seed), key).limit(n)


Z_SCORES = {0.90: 1.645, 0.95: 1.96, 0.99: 2.576}


def sample_size(population: Column, confidence: float = 0.95, margin: float = 0.05) -> Column:
    """Cochran's size with the finite correction; capped at 300 (200 above 10 000 rows), 50 at least, never above the population."""
    infinite = Z_SCORES.get(confidence, 1.96) ** 2 * 0.25 / margin**2
    size = F.ceil(F.lit(infinite) / (1 + (infinite - 1) / population))
    cap = F.when(population > 10_000, 200).otherwise(300)
    return F.least(F.greatest(F.least(size, cap), F.lit(50)), population)


def taxonomy_sample(df: DataFrame, subcategory: str, key: str, confidence: float = 0.95, margin: float = 0.05, seed: int = 7) -> DataFrame:
    """Per subcategory a sample of that size."""
    sizes = df.groupBy(subcategory).agg(F.count(F.lit(1)).alias("population")).withColumn("wanted", sample_size(F.col("population"), confidence, margin))
    by = Window.partitionBy(subcategory).orderBy(seeded(key, seed), key)
    ranked = df.withColumn("__r", F.row_number().over(by)).where(F.col("__r") <= 300)
    picked = ranked.join(sizes.withColumnRenamed(subcategory, "__sub"), F.col(subcategory).eqNullSafe(F.col("__sub")))
    return picked.where(F.col("__r") <= F.col("wanted")).drop("__r", "__sub")


def balanced_batches(df: DataFrame, key: str, rows: int = 50_000, max_parts: int = 10, chunk: int = 1000) -> DataFrame:
    """A worker and a chunk for each row, by hash of the id, so that a rerun makes the same ones."""
    n = df.count()
    parts = max(1, min(max_parts, -(-n // rows)))
    chunks = max(1, -(-n // (parts * chunk)))
    spot = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long")
    return df.withColumns({"worker": F.pmod(spot, F.lit(parts)), "chunk": F.pmod(F.floor(spot / parts), F.lit(chunks))})

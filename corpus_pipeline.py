"""Corpus pipeline: quality classifier, line dedup, SimHash near-dedup, benchmark decontamination, packing.

``STAGES`` lists ``(name, function)``; each function takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written and reread as the next one's ``docs``.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseweave.llm import decontaminate, line_dedup, packing, quality_classifier, simhash
from caseweave.llm._spark import read_table
from caseweave.sources.shared import scratch


def _apart(docs: DataFrame, stage) -> DataFrame:
    """``stage`` on documents whose other columns have names that no operator uses; the columns come back as they were."""
    names = {c: c if c in ("doc_id", "text") else f"__column_{k}" for k, c in enumerate(docs.columns)}
    kept = stage(docs.select(*(F.col(c).alias(n) for c, n in names.items())))
    return kept.select(*(F.col(n).alias(c) for c, n in names.items()))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on labels of these documents, does not reject.

    Each row is judged by its own text (null: empty), also where ids are repeated or null; no documents: none.
    """
    model = quality_classifier.fit(docs, read_table(spark, sf_dir, "labels"))
    return _apart(docs, lambda d: quality_classifier.score(d, model).where("predicted = 1"))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later occurrences of three-line windows; ``n_chars`` follows the text.

    A null text stays null, with null ``n_chars``; rows without an id stay whole; equal rows are cut alike.
    """
    return _apart(docs, line_dedup.line_dedup).withColumn("n_chars", F.length("text").cast("long"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group.

    Null and empty texts are one group; rows without an id stay; equal rows of the smallest id all stay.
    """
    return _apart(docs, simhash.one_of_each)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated with benchmark items; null and empty texts are clean, each row counts for itself."""
    benchmark = read_table(spark, sf_dir, "benchmark")
    return _apart(docs, lambda d: decontaminate.decontaminate(d, benchmark, keep=True).where(~F.col("contaminated")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, placed in sequences; a null or empty text has its closing id alone."""
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("line_dedup", cut_repeated_lines),
    ("simhash_dedup", one_of_each_group),
    ("decontaminate", drop_contaminated),
    ("pack", pack),
]

#: SQL can state neither the classifier nor the fingerprints; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each stage's result is written to the shared folder as Parquet and reread."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES, start=1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            path = scratch(spark, name)
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
    return docs

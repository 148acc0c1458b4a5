"""Registration of queries, the shared incident frame, and pieces of DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from caseweave.functions.labels import GENERIC

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

#: Incident frame over ``documents``, ``events`` and ``labels``; one text for both engines.
#: The description is the whole text, the resolution all of it after the first line; neither has an upper length.
INCIDENTS_SQL = """
SELECT 'INC' || lpad(cast(d.doc_id AS string), 7, '0') AS in_id,
  e.ts AS opened_at,
  cast(date_trunc('week', e.ts) AS date) AS period,
  d.text AS brief_description,
  CASE WHEN instr(d.text, chr(10)) > 0 THEN substr(d.text, instr(d.text, chr(10)) + 1) END AS resolution,
  CASE WHEN d.doc_id % 50 = 3 THEN 'Uncategorized' WHEN d.doc_id % 50 = 7 THEN NULL ELSE d.lang END AS a_l1,
  d.source AS a_l2,
  CASE WHEN d.n_chars % 7 = 0 THEN 'Other' ELSE 'len' || cast(d.n_chars % 5 AS string) END AS a_l3,
  CASE WHEN l.quality IS NULL THEN NULL
       WHEN d.doc_id % 11 = 0 THEN ' None '
       WHEN d.doc_id % 13 = 0 THEN 'insufficient_information'
       WHEN d.doc_id % 17 = 0 THEN 'Unclassified_L4'
       ELSE 'fix_' || cast(d.doc_id % 6 AS string) END AS a_l4,
  cast(d.n_chars % 101 AS double) / 100 AS a_l4_confidence,
  CASE WHEN l.toxic = 1 THEN 'false' WHEN l.quality = 1 THEN 'True' ELSE 'no' END AS a_actionable,
  CASE WHEN d.doc_id % 9 = 0 THEN 'unknown' WHEN d.doc_id % 4 = 0 THEN upper(d.lang) ELSE d.lang END AS b_l1,
  CASE WHEN d.doc_id % 5 = 0 THEN 'src0' ELSE ' ' || d.source END AS b_l2,
  'len' || cast(d.n_chars % 5 AS string) AS b_l3,
  CASE WHEN l.quality = 1 THEN 'fix_' || cast(d.doc_id % 4 AS string) END AS b_l4,
  d.doc_id AS doc_id, d.n_chars AS n_chars
FROM {documents} d JOIN {events} e ON e.event_id = d.doc_id LEFT JOIN {labels} l ON l.doc_id = d.doc_id
"""
INCIDENTS = "incidents AS (" + INCIDENTS_SQL.format(documents="documents", events="events", labels="labels") + ")"


def query(oracle: str | None = None, name: str | None = None):
    """Registers ``f(spark, sf_dir)`` under its own name, with its SQL."""

    def register(f):
        key = name or f.__name__
        QUERIES[key] = f
        if oracle:
            ORACLES[key] = oracle
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(INCIDENTS_SQL, **{n: table(spark, sf_dir, n) for n in ("documents", "events", "labels")})


def sql_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def sql_usable(c: str) -> str:
    return f"coalesce(trim({c}) <> '' AND lower(trim({c})) NOT IN ({sql_list(GENERIC)}), false)"


def sql_missing(c: str) -> str:
    return f"coalesce(lower(trim({c})) IN ('', 'none'), true)"


def sql_norm(c: str) -> str:
    return f"lower(trim(coalesce({c}, '')))"


def sql_trueish(c: str) -> str:
    return f"coalesce(lower(trim({c})) IN ('true', 't', '1', 'yes', 'y'), false)"


def sql_path(*columns: str) -> str:
    return "nullif(concat_ws(' → ', " + ", ".join(f"CASE WHEN {sql_usable(c)} THEN trim({c}) END" for c in columns) + "), '')"

"""Queries of the labeler comparison: coverage, granularity, agreement, explanations, clusters."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave.functions.labels import INTERVENTIONS, DEFAULT_INTERVENTION, intervention_type, label_path
from caseweave.operators import clusters as cl
from caseweave.operators import compare as cmp
from caseweave.plans.base import INCIDENTS, incidents, query, sql_list, sql_norm, sql_path, sql_trueish, sql_usable


def rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


STACKED = f"""WITH {INCIDENTS}, s AS (
  SELECT *, 'L1' AS level, a_l1 AS a, b_l1 AS b FROM incidents UNION ALL SELECT *, 'L2', a_l2, b_l2 FROM incidents
  UNION ALL SELECT *, 'L3', a_l3, b_l3 FROM incidents UNION ALL SELECT *, 'L4', a_l4, b_l4 FROM incidents),
y AS (SELECT *, {sql_usable("a")} AND {sql_usable("b")} AS paired, {sql_norm("a")} = {sql_norm("b")} AS same FROM s)"""
LABELS = f"""{STACKED}, v AS (
  SELECT 'A' AS model, level, {sql_norm("a")} AS label FROM s WHERE {sql_usable("a")}
  UNION ALL SELECT 'B', level, {sql_norm("b")} FROM s WHERE {sql_usable("b")}),
c AS (SELECT model, level, label, count(*) AS n FROM v GROUP BY ALL),
r AS (SELECT *, sum(n) OVER (PARTITION BY model, level) AS t,
             row_number() OVER (PARTITION BY model, level ORDER BY n DESC, label) AS r FROM c)"""
THREE = " AND ".join(sql_usable(c) for c in ("a_l1", "a_l2", "a_l3"))
AGREE = "count(*) FILTER (paired) AS n_both, round(count(*) FILTER (paired AND same) * 100.0 / nullif(count(*) FILTER (paired), 0), 6) AS agreement_pct"


@query(f"""{STACKED} SELECT level, round(avg(CAST({sql_usable("a")} AS DOUBLE)) * 100, 6) AS a_pct, round(avg(CAST({sql_usable("b")} AS DOUBLE)) * 100, 6) AS b_pct,
round(avg(CAST({sql_usable("a")} AS DOUBLE)) * 100 - avg(CAST({sql_usable("b")} AS DOUBLE)) * 100, 6) AS difference FROM s GROUP BY level""")
def label_coverage(spark, sf_dir):
    return rounded(cmp.coverage(incidents(spark, sf_dir)), "a_pct", "b_pct", "difference")


@query(f"""{LABELS} SELECT model, level, CAST(sum(n) AS BIGINT) AS rows, count(*) AS labels, round(sum(n) FILTER (r <= 10) / max(t) * 100, 6) AS top10_pct,
round(sum(-(n / t) * log2(n / t)), 6) + 0.0 AS entropy FROM r GROUP BY ALL""")
def label_granularity(spark, sf_dir):
    return rounded(cmp.granularity(incidents(spark, sf_dir)), "top10_pct", "entropy")


@query(f"{LABELS} SELECT model, level, label, n, round(n / t * 100, 6) AS pct, r AS rank FROM r WHERE r <= 20")
def top_labels(spark, sf_dir):
    return rounded(cmp.top_labels(incidents(spark, sf_dir)), "pct").withColumn("rank", F.col("rank").cast("long"))


@query(f"{STACKED} SELECT level, {AGREE} FROM y GROUP BY level")
def label_agreement(spark, sf_dir):
    return rounded(cmp.agreement(incidents(spark, sf_dir)), "agreement_pct")


STRATA = f"""{STACKED}, g AS (
  SELECT CASE WHEN grouping(a_l2) = 1 THEN 'l1_period' ELSE 'l1_l2_l3' END AS stratum, a_l1, a_l2, a_l3, period, level, count(*) AS rows, {AGREE}
  FROM y WHERE {THREE} GROUP BY GROUPING SETS ((a_l1, period, level), (a_l1, a_l2, a_l3, level))),
strata AS (SELECT * FROM g WHERE n_both >= 20 AND (stratum <> 'l1_period' OR period IS NOT NULL))"""


def _strata(spark, sf_dir):
    return rounded(cmp.stratified_agreement(incidents(spark, sf_dir)), "agreement_pct")


@query(f"{STRATA} SELECT stratum, a_l1, a_l2, a_l3, CAST(period AS VARCHAR) AS period, level, rows, n_both, agreement_pct FROM strata")
def stratified_agreement(spark, sf_dir):
    out = _strata(spark, sf_dir).withColumn("period", F.col("period").cast("string"))
    return out.select("stratum", "a_l1", "a_l2", "a_l3", "period", "level", "rows", "n_both", "agreement_pct")


@query(f"""{STRATA} SELECT stratum, a_l1, a_l2, a_l3, CAST(period AS VARCHAR) AS period, n_both, agreement_pct FROM strata WHERE level = 'L4'
ORDER BY agreement_pct NULLS FIRST, n_both DESC, stratum, a_l1, a_l2 NULLS FIRST, a_l3 NULLS FIRST, period NULLS FIRST LIMIT 5""")
def worst_strata(spark, sf_dir):
    out = cmp.worst_strata(_strata(spark, sf_dir))
    return out.select("stratum", "a_l1", "a_l2", "a_l3", F.col("period").cast("string").alias("period"), "n_both", "agreement_pct")


@query(f"""{STACKED}, c AS (SELECT level, {sql_norm("b")} AS b, {sql_norm("a")} AS a, count(*) AS n FROM y WHERE paired GROUP BY ALL),
p AS (SELECT *, round(n / sum(n) OVER (PARTITION BY level) * 100, 6) AS pct FROM c)
SELECT * FROM (SELECT level, b, a, n, pct, row_number() OVER (PARTITION BY level ORDER BY n DESC, b, a) AS rank FROM p WHERE a <> b) WHERE rank <= 25""")
def top_disagreements(spark, sf_dir):
    return rounded(cmp.top_disagreements(incidents(spark, sf_dir)), "pct").withColumn("rank", F.col("rank").cast("long"))


@query(f"""{STACKED} SELECT a_l1, level, b, a, n FROM (
SELECT *, row_number() OVER (PARTITION BY a_l1, level ORDER BY n DESC, b, a) AS r FROM (
SELECT a_l1, level, {sql_norm("b")} AS b, {sql_norm("a")} AS a, count(*) AS n FROM y WHERE paired AND NOT same AND {THREE} GROUP BY ALL)) WHERE r = 1""")
def top_disagreement_in_stratum(spark, sf_dir):
    return cmp.stratum_top_pair(incidents(spark, sf_dir))


FIELDS = {
    "rationale": "brief_description", "l4_rationale": "resolution", "keywords": "a_l3", "root_cause_indicator": "a_l1", "root_cause": "b_l4",
    "l4_resolution_action": "a_l4", "actionability_reason": "a_actionable", "l4_confidence": "a_l4_confidence",
}


@query(f"""WITH {INCIDENTS}, w AS (SELECT *, {sql_usable("a_l4")} AS good, {sql_trueish("a_actionable")} AS yes FROM incidents),
s AS (SELECT *, 'all' AS slice FROM w UNION ALL SELECT *, 'usable' FROM w WHERE good
  UNION ALL SELECT *, 'usable_actionable' FROM w WHERE good AND yes UNION ALL SELECT *, 'usable_not_actionable' FROM w WHERE good AND NOT yes)
SELECT slice, count(*) AS rows, {", ".join(f"round(avg(CAST(coalesce(trim(CAST({c} AS VARCHAR)) <> '', false) AS DOUBLE)) * 100, 6) AS {n}_pct" for n, c in FIELDS.items())},
round(avg(CAST(a_l4_confidence IS NOT NULL AS DOUBLE)) * 100, 6) AS numeric_confidence_pct, round(avg(a_l4_confidence), 6) AS confidence_mean,
round(median(a_l4_confidence), 6) AS confidence_median FROM s GROUP BY slice""")
def explainability_presence(spark, sf_dir):
    out = cmp.explainability(incidents(spark, sf_dir), FIELDS, "a_l4_confidence", "a_actionable")
    return rounded(out, *(f"{n}_pct" for n in FIELDS), "numeric_confidence_pct", "confidence_mean", "confidence_median")


@query(f"""WITH {INCIDENTS}, b AS (SELECT CASE WHEN a_l4_confidence <= 0 THEN '<0' WHEN a_l4_confidence <= 0.25 THEN '0-0.25' WHEN a_l4_confidence <= 0.5 THEN '0.25-0.5'
  WHEN a_l4_confidence <= 0.75 THEN '0.5-0.75' WHEN a_l4_confidence <= 1 THEN '0.75-1.0' ELSE '>1.0' END AS bin FROM incidents WHERE {sql_usable("a_l4")})
SELECT n.bin, count(b.bin) AS n, round(count(b.bin) / (SELECT count(*) FROM b) * 100, 6) AS pct
FROM (VALUES {", ".join(f"('{b[0]}')" for b in cmp.CONFIDENCE_BINS)}) n(bin) LEFT JOIN b USING (bin) GROUP BY n.bin""")
def confidence_histogram(spark, sf_dir):
    return rounded(cmp.confidence_histogram(incidents(spark, sf_dir), "a_l4_confidence"), "pct")


@query(f"""WITH {INCIDENTS} SELECT in_id AS INC_ID, a_l1 AS A_L1, b_l1 AS B_L1, a_l4 AS A_L4, b_l4 AS B_L4, {sql_path("a_l1", "a_l2", "a_l3", "a_l4")} AS a_path,
{sql_path("b_l1", "b_l2", "b_l3", "b_l4")} AS b_path, doc_id % 10 = 0 AS mismatch FROM incidents""")
def comparison_frame(spark, sf_dir):
    base = incidents(spark, sf_dir)
    other = F.when(F.col("doc_id") % 10 == 0, F.lower("in_id")).otherwise(F.concat(F.lit(" "), "in_id"))
    names = {"INC_ID": "in_id", "A_L1": "a_l1", "B_L1": "b_l1", "A_L4": "a_l4", "B_L4": "b_l4", "a_path": "a_path", "b_path": "b_path", "mismatch": "mismatch", "OTHER_ID": "other_id"}
    paths = {f"{m}_path": label_path(*(F.col(f"{m}_l{k}") for k in range(1, 5))) for m in "ab"}
    joined = base.withColumn("other_id", other).withColumns(paths)
    test = cmp.comparison_frame(joined, {}, "in_id", "other_id")[1]
    return cmp.comparison_frame(joined.withColumn("mismatch", test), names, "in_id", "other_id")[0]


@query(f"WITH {INCIDENTS} SELECT in_id, {sql_path('a_l1', 'a_l2', 'a_l3', 'a_l4')} AS a_path, {sql_path('b_l1', 'b_l2', 'b_l3', 'b_l4')} AS b_path FROM incidents", name="label_path")
def label_path_query(spark, sf_dir):
    paths = (label_path(*(F.col(f"{m}_l{k}") for k in range(1, 5))).alias(f"{m}_path") for m in "ab")
    return incidents(spark, sf_dir).select("in_id", *paths)


CLUSTERS = f"""WITH {INCIDENTS}, m AS (
  SELECT 'A' AS model, {sql_path("a_l1", "a_l2", "a_l3", "a_l4")} AS path, a_l1 AS l1, a_l2 AS l2, a_l3 AS l3, a_l4 AS l4 FROM incidents
  UNION ALL SELECT 'B', {sql_path("b_l1", "b_l2", "b_l3", "b_l4")}, b_l1, b_l2, b_l3, b_l4 FROM incidents),
c AS (SELECT model, path, l1, l2, l3, l4, count(*) AS n FROM m WHERE path IS NOT NULL GROUP BY ALL),
k AS (SELECT *, row_number() OVER w AS rank, n / sum(n) OVER (PARTITION BY model) * 100 AS pct,
  sum(n) OVER (w ROWS UNBOUNDED PRECEDING) / sum(n) OVER (PARTITION BY model) * 100 AS cumulative_pct,
  coalesce(l3 IN ({sql_list(cl.CATCH_ALL)}), false) AS catch_all,
  n >= 3 AND NOT coalesce(l3 IN ({sql_list(cl.CATCH_ALL)}), false) AND {sql_usable("l4")} AS viable FROM c
  WINDOW w AS (PARTITION BY model ORDER BY n DESC, path, l1 NULLS FIRST, l2 NULLS FIRST, l3 NULLS FIRST, l4 NULLS FIRST))"""


@query(f"{CLUSTERS} SELECT model, path, l1, l2, l3, l4, n FROM c")
def path_clusters(spark, sf_dir):
    return cl.clusters(incidents(spark, sf_dir))


def _ranked(spark, sf_dir):
    return cl.rank_clusters(cl.clusters(incidents(spark, sf_dir))).withColumn("rank", F.col("rank").cast("long"))


@query(f"{CLUSTERS} SELECT model, path, l1, l2, l3, l4, n, rank, round(pct, 6) AS pct, round(cumulative_pct, 6) AS cumulative_pct, catch_all, viable FROM k")
def cluster_rank_cumulative(spark, sf_dir):
    return rounded(_ranked(spark, sf_dir), "pct", "cumulative_pct")


@query(f"""{CLUSTERS} SELECT model, CAST(sum(n) AS BIGINT) AS incidents, count(DISTINCT path) AS paths, count(*) FILTER (cumulative_pct <= 50) + 1 AS to_cover_50,
count(*) FILTER (cumulative_pct <= 80) + 1 AS to_cover_80, round(coalesce(sum(n) FILTER (viable), 0) / sum(n) * 100, 6) AS viable_pct,
round(coalesce(sum(n) FILTER (catch_all), 0) / sum(n) * 100, 6) AS catch_all_pct, arg_min(path, rank) AS largest_path, round(arg_min(pct, rank), 6) AS largest_pct FROM k GROUP BY model""")
def pareto_summary(spark, sf_dir):
    return rounded(cl.pareto(_ranked(spark, sf_dir)), "viable_pct", "catch_all_pct", "largest_pct")


def _sql_intervention(path: str) -> str:
    rows = " ".join(f"WHEN {' OR '.join(f'''contains(lower({path}), '{w}')''' for w in words)} THEN '{name}'" for name, words in INTERVENTIONS)
    return f"CASE {rows} ELSE '{DEFAULT_INTERVENTION}' END"


@query(f"""{CLUSTERS} SELECT model, rank, path, n, round(pct, 6) AS pct, {_sql_intervention("path")} AS intervention FROM (
SELECT *, row_number() OVER (PARTITION BY model ORDER BY rank) AS r FROM k WHERE viable) WHERE r <= 20""")
def top_viable_clusters(spark, sf_dir):
    return rounded(cl.top_viable(_ranked(spark, sf_dir)), "pct")


@query(f"SELECT page_id, {_sql_intervention('url')} AS intervention FROM pages")
def intervention_rules(spark, sf_dir):
    from caseweave.plans.base import table

    return table(spark, sf_dir, "pages").select("page_id", intervention_type(F.col("url")).alias("intervention"))

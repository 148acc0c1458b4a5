"""Queries of taxonomy checks, gates, cleaning and audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from caseweave.functions import labels as lb
from caseweave.operators import validate as va
from caseweave.plans.base import INCIDENTS, incidents, query, sql_missing, table


def sql_canonical(c: str) -> str:
    return rf"trim(regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '[_\- ]+', ' ', 'g'), '[^\p{{L}}\p{{N}} ]', '', 'g'), ' +', ' ', 'g'))"


ROWS_SQL = """SELECT p_partkey AS in_id,
  CASE p_partkey % 9 WHEN 1 THEN ' ' || lower(p_type) || ' ' WHEN 2 THEN p_name WHEN 5 THEN 'Nothing' WHEN 6 THEN 'the-' || p_type ELSE p_type END AS l1,
  CASE p_partkey % 9 WHEN 3 THEN NULL WHEN 4 THEN 'Brand#1' WHEN 7 THEN ' None' ELSE p_brand END AS l2,
  CASE p_partkey % 9 WHEN 1 THEN replace(p_name, ' ', '_') WHEN 2 THEN p_type ELSE p_name END AS l3 FROM {part}"""
TREE = f"""rows AS ({ROWS_SQL.format(part="part")}), tax AS (SELECT DISTINCT p_type AS l1, p_brand AS l2, p_name AS l3 FROM part WHERE p_partkey % 10 <> 0),
keys AS (SELECT *, {sql_canonical("l1")} AS t0, {sql_canonical("l2")} AS t1, {sql_canonical("l3")} AS t2 FROM tax),
path AS (SELECT t0, t1, t2, min(l1) AS p1, min(l2) AS p2, min(l3) AS p3 FROM keys GROUP BY ALL),
k AS (SELECT *, CASE WHEN starts_with({sql_canonical("l1")}, 'the ') THEN substr({sql_canonical("l1")}, 5) ELSE {sql_canonical("l1")} END AS k0, {sql_canonical("l2")} AS k1, {sql_canonical("l3")} AS k2 FROM rows),
s AS (SELECT k.*, p1, p2, p3, CASE WHEN {sql_missing("l1")} OR {sql_missing("l2")} OR {sql_missing("l3")} THEN 'missing'
  WHEN trim(l1) = p1 AND trim(l2) = p2 AND trim(l3) = p3 THEN 'valid' WHEN p1 IS NOT NULL THEN 'valid_after_repair'
  WHEN list_sort([k0, k1, k2]) IN (SELECT list_sort([t0, t1, t2]) FROM keys) THEN 'swapped_levels_suspected'
  WHEN k0 IN (SELECT t0 FROM keys) AND k1 IN (SELECT t1 FROM keys) AND k2 IN (SELECT t2 FROM keys) THEN 'invalid_hierarchy' ELSE 'invalid_label' END AS validation_status
  FROM k LEFT JOIN path ON k0 = t0 AND k1 = t1 AND k2 = t2),
validated AS (SELECT in_id, validation_status, {", ".join(f"CASE WHEN validation_status IN ('valid', 'valid_after_repair') THEN p{i} ELSE 'Uncategorized' END AS final_l{i}" for i in (1, 2, 3))},
  l1 AS original_l1, l2 AS original_l2, l3 AS original_l3, validation_status = 'valid_after_repair' AS repair_applied FROM s)"""


def _taxonomy(spark, sf_dir):
    return table(spark, sf_dir, "part").where("p_partkey % 10 <> 0").select(F.col("p_type").alias("l1"), F.col("p_brand").alias("l2"), F.col("p_name").alias("l3")).distinct()


def _validated(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    rows = spark.sql(ROWS_SQL, part=part)
    types = part.select("p_type").distinct()
    aliases = types.select(F.lit("l1").alias("level"), F.concat(F.lit("the "), "p_type").alias("alias"), F.col("p_type").alias("label"))
    return va.validate_path(rows, _taxonomy(spark, sf_dir), aliases)


FINALS = "in_id, validation_status, final_l1, final_l2, final_l3, original_l1, original_l2, original_l3, repair_applied"


@query(f"WITH {TREE} SELECT {FINALS} FROM validated")
def validate_path(spark, sf_dir):
    return _validated(spark, sf_dir).select(*FINALS.split(", "))


#: Paths that differ in punctuation only, rows that use either, and several aliases of one canonical form.
TWIN_ROWS = """SELECT p_partkey AS in_id, CASE p_partkey % 4 WHEN 0 THEN p_type WHEN 1 THEN replace(p_type, ' ', '-') WHEN 2 THEN lower(p_type) ELSE 'the_' || p_type END AS l1, p_brand AS l2, p_name AS l3 FROM {part}"""
TWIN_TAXONOMY = """SELECT DISTINCT p_type AS l1, p_brand AS l2, p_name AS l3 FROM {part} UNION SELECT replace(p_type, ' ', '-'), p_brand, p_name FROM {part} WHERE p_partkey % 3 <> 0"""


@query(f"""WITH tax AS ({TWIN_TAXONOMY.format(part="part")}), rows AS ({TWIN_ROWS.format(part="part")}),
path AS (SELECT {sql_canonical("l1")} AS t0, l2, l3, min(l1) AS p FROM tax GROUP BY ALL),
k AS (SELECT *, regexp_replace({sql_canonical("l1")}, '^the ', '') AS t0 FROM rows),
s AS (SELECT k.*, p, (l1, l2, l3) IN (SELECT (l1, l2, l3) FROM tax) AS exact FROM k JOIN path USING (t0, l2, l3))
SELECT in_id, CASE WHEN exact THEN 'valid' ELSE 'valid_after_repair' END AS validation_status, CASE WHEN exact THEN l1 ELSE p END AS final_l1, l2 AS final_l2, l3 AS final_l3,
l1 AS original_l1, l2 AS original_l2, l3 AS original_l3, NOT exact AS repair_applied FROM s""")
def validate_path_twins(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    types = part.select("p_type").distinct()
    forms = F.explode(F.array(*(F.concat(F.lit(f), "p_type") for f in ("the ", "The-", "the_")))).alias("alias")
    aliases = types.select(F.lit("l1").alias("level"), forms, F.col("p_type").alias("label"))
    return va.validate_path(spark.sql(TWIN_ROWS, part=part), spark.sql(TWIN_TAXONOMY, part=part), aliases).select(*FINALS.split(", "))


@query(f"WITH {TREE} SELECT in_id, 'run1' AS run_id, validation_status AS status, original_l1, original_l2, original_l3, final_l1, final_l2, final_l3, repair_applied FROM validated WHERE validation_status <> 'valid'")
def l123_audit(spark, sf_dir):
    return va.l123_audit(_validated(spark, sf_dir), "run1").drop("details")


@query(f"WITH {TREE} SELECT in_id, trim(l1) || '/' || l3 AS path, p1 IS NOT NULL AS known FROM s")
def taxonomy_semi_check(spark, sf_dir):
    rows = spark.sql(ROWS_SQL, part=table(spark, sf_dir, "part"))
    keyed = rows.withColumns({f"k{i}": lb.canonical(F.col(f"l{i + 1}")) for i in range(3)}).withColumn("k0", F.regexp_replace("k0", "^the ", ""))
    keys = _taxonomy(spark, sf_dir).select(*(lb.canonical(F.col(f"l{i + 1}")).alias(f"k{i}") for i in range(3))).distinct().withColumn("hit", F.lit(True))
    return keyed.join(va.sized(keys), ["k0", "k1", "k2"], "left").select("in_id", F.concat(F.trim("l1"), F.lit("/"), "l3").alias("path"), F.col("hit").isNotNull().alias("known"))


@query(f"SELECT p_partkey, {sql_canonical('p_name')} AS name, {sql_canonical('p_brand')} AS brand FROM part", name="canonical_label")
def canonical_label(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", lb.canonical(F.col("p_name")).alias("name"), lb.canonical(F.col("p_brand")).alias("brand"))


@query("SELECT DISTINCT p_type AS l1, p_brand AS l2, p_name AS l3 FROM part")
def taxonomy_table(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    low = part.groupBy("p_type", "p_brand").agg(F.collect_set("p_name").alias("names"))
    tree = low.groupBy("p_type").agg(F.map_from_entries(F.collect_list(F.struct("p_brand", "names"))).alias("inner"))
    nested = tree.select(F.create_map("p_type", "inner").alias("tree"))
    return va.taxonomy_table(nested)


L4TAX = "l4tax AS (SELECT DISTINCT source AS subcategory, 'FIX_' || cast(doc_id % 5 AS VARCHAR) AS name FROM documents WHERE doc_id % 2 = 0)"


def _l4tax(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").where("doc_id % 2 = 0")
    return docs.select(F.col("source").alias("subcategory"), F.concat(F.lit("FIX_"), (F.col("doc_id") % 5).cast("string")).alias("name")).distinct()


VALID4 = "coalesce((a_l2, lower(trim(a_l4))) IN (SELECT (subcategory, lower(name)) FROM l4tax), false)"
REFUSED = f"coalesce(regexp_matches(lower(trim(a_l4)), '{'|'.join(lb.REFUSED_WORDS)}') OR (contains(lower(trim(a_l4)), 'unclassif') AND lower(trim(a_l4)) <> 'unclassified'), true)"
CLEAN = f"CASE WHEN lower(a_l4) = 'unclassified_l4' THEN 'Unclassified' WHEN NOT coalesce(regexp_matches(lower(a_l4), '{lb.INVALID_L4}'), false) THEN a_l4 END"


@query(f"WITH {INCIDENTS}, {L4TAX} SELECT in_id, a_l4, a_l4 IS NOT NULL AND {VALID4} AS l4_valid FROM incidents")
def l4_in_taxonomy(spark, sf_dir):
    return va.l4_valid(incidents(spark, sf_dir), _l4tax(spark, sf_dir), "a_l2", "a_l4").select("in_id", "a_l4", "l4_valid")


@query(f"WITH {INCIDENTS}, {L4TAX} SELECT in_id, a_l4, NOT {REFUSED} AND (coalesce(lower(trim(a_l4)) = 'unclassified', false) OR {VALID4}) AS l4_accepted FROM incidents")
def l4_gate_in_run(spark, sf_dir):
    return va.l4_in_run_valid(incidents(spark, sf_dir), _l4tax(spark, sf_dir), "a_l2", "a_l4").select("in_id", "a_l4", "l4_accepted")


@query(f"WITH {INCIDENTS} SELECT in_id, CASE WHEN ({CLEAN}) IS DISTINCT FROM a_l4 THEN a_l4 END AS l4_original, {CLEAN} AS l4_clean FROM incidents")
def l4_clean_final(spark, sf_dir):
    return va.l4_clean(incidents(spark, sf_dir), "a_l4").select("in_id", "l4_original", "l4_clean")


def sql_backfill(c: str) -> str:
    return f"coalesce(trim({c}) = '' OR lower({c}) = 'none', true)"


@query(f"""WITH {INCIDENTS} SELECT in_id, {", ".join(f"CASE WHEN {sql_backfill(c)} THEN 'Uncategorized' ELSE {c} END AS {c}" for c in ("a_l1", "a_l4"))},
{sql_backfill("a_l1")} OR {sql_backfill("a_l4")} AS backfilled FROM incidents""")
def backfill_l123(spark, sf_dir):
    return va.backfill(incidents(spark, sf_dir), ("a_l1", "a_l4")).select("in_id", "a_l1", "a_l4", "backfilled")


BLOCKED = f"({sql_missing('a_l1')} OR coalesce(trim(a_l1) = 'Uncategorized', false))"


@query(f"""WITH {INCIDENTS} SELECT in_id, CASE WHEN {BLOCKED} THEN 'Unclassified' END AS l4_category, CASE WHEN {BLOCKED} THEN 0.0::DOUBLE END AS l4_confidence,
CASE WHEN {BLOCKED} THEN false END AS is_actionable, CASE WHEN {BLOCKED} THEN 'l123_invalid_blocks_l4' END AS reason FROM incidents""")
def pre_l4_gate(spark, sf_dir):
    on, off = va.pre_l4_gate(incidents(spark, sf_dir), "a_l1")
    return on.unionByName(off, allowMissingColumns=True).select("in_id", "l4_category", "l4_confidence", "is_actionable", "reason")


CLEANED = f"c AS (SELECT *, {CLEAN} AS l4_clean, CASE WHEN ({CLEAN}) IS DISTINCT FROM a_l4 THEN a_l4 END AS l4_original FROM incidents)"
REASONS = f"r AS (SELECT in_id, CASE WHEN l4_original IS NOT NULL THEN 'cleaned' ELSE 'missing' END AS reason, l4_original AS original_value FROM c WHERE {sql_missing('l4_clean')})"


def _reasons(spark, sf_dir):
    return va.l4_null_reasons(va.l4_clean(incidents(spark, sf_dir), "a_l4"), "l4_clean", "l4_original", "run1")


@query(f"WITH {INCIDENTS}, {CLEANED}, {REASONS} SELECT in_id, 'run1' AS run_id, reason, original_value FROM r")
def l4_null_reasons(spark, sf_dir):
    return _reasons(spark, sf_dir)


@query(f"WITH {INCIDENTS}, {CLEANED}, {REASONS} SELECT reason, count(*) AS n FROM r GROUP BY reason")
def reason_breakdown(spark, sf_dir):
    return va.reason_breakdown(_reasons(spark, sf_dir))


@query("SELECT user_id AS in_id, arg_max(event_type, event_id) AS reason FROM events WHERE user_id IS NOT NULL GROUP BY user_id")
def final_reason_dedupe(spark, sf_dir):
    return va.final_reason(table(spark, sf_dir, "events").select(F.col("user_id").alias("in_id"), F.col("event_type").alias("reason"), "event_id"), ["event_id"])


@query(f"""WITH {INCIDENTS} SELECT in_id, a_l4, opened_at FROM incidents WHERE (a_l4 IS NULL OR trim(a_l4) = '' OR a_l4 = 'None')
AND opened_at >= TIMESTAMP '2024-01-01' AND opened_at < TIMESTAMP '2024-01-02 00:00:00' + INTERVAL 1 DAY""")
def missing_l4(spark, sf_dir):
    return va.missing_l4(incidents(spark, sf_dir), "a_l4", "opened_at", "2024-01-01", "2024-01-02").select("in_id", "a_l4", "opened_at")


@query("SELECT DISTINCT o_custkey AS in_id FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-03-31'")
def target_ids(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "in_id")
    return va.target_ids(orders, "o_orderdate", "1997-01-01", "1997-03-31")


JOINED4 = f"""WITH {TREE}, x AS (SELECT v.*, CASE WHEN in_id % 4 = 0 THEN NULL WHEN in_id % 4 = 1 THEN 'Unclassified' ELSE 'fix_' || cast(in_id % 4 AS VARCHAR) END AS l4, in_id % 4 = 2 AS l4_valid FROM validated v)"""


def _with_l4(spark, sf_dir):
    k = F.col("in_id") % 4
    l4 = F.when(k == 1, "Unclassified").when(k > 1, F.concat(F.lit("fix_"), k.cast("string")))
    return _validated(spark, sf_dir).withColumns({"l4": l4, "l4_valid": k == 2})


@query(f"""{JOINED4} SELECT in_id, CASE WHEN validation_status NOT IN ('valid', 'valid_after_repair') THEN 'A' ELSE 'B' END AS cohort FROM x
WHERE validation_status NOT IN ('valid', 'valid_after_repair') OR l4 IS NULL""")
def remediation_cohorts(spark, sf_dir):
    rows = _with_l4(spark, sf_dir)
    return va.cohorts(rows, va.l123_audit(rows, "run1"), "l4").select("in_id", "cohort")


@query(f"""{JOINED4} SELECT in_id, validation_status IN ('valid', 'valid_after_repair') AS l123_ok,
validation_status IN ('valid', 'valid_after_repair') AND (l4_valid OR coalesce(l4 = 'Unclassified', false) OR (l4 IS NULL AND in_id % 8 = 0)) AS path_ok FROM x""")
def path_integrity(spark, sf_dir):
    rows = _with_l4(spark, sf_dir)
    reasons = rows.where("in_id % 8 = 0").select("in_id")
    return va.path_integrity(rows, reasons, "l4")


@query(f"""WITH {INCIDENTS} SELECT in_id, {sql_missing("a_l4")} AS m, a_l4 IS NULL OR trim(a_l4) = '' OR a_l4 = 'None' AS m_target, {sql_backfill("a_l4")} AS m_backfill,
{BLOCKED} AS uncategorized, coalesce(trim(a_l4) <> '' AND lower(trim(a_l4)) <> 'none', false) AS nonempty FROM incidents""")
def usable_label(spark, sf_dir):
    c = F.col("a_l4")
    return incidents(spark, sf_dir).select(
        "in_id", lb.missing(c).alias("m"), lb.missing_in_target(c).alias("m_target"), lb.backfill_missing(c).alias("m_backfill"),
        lb.uncategorized(F.col("a_l1")).alias("uncategorized"), lb.nonempty(c).alias("nonempty"),
    )

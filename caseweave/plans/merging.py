"""Queries of deduplication, merging, upserts, deletion and reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caseweave.operators import merge as mg
from caseweave.plans.base import INCIDENTS, incidents, query, table

LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
PICK = "l_orderkey, l_partkey, l_suppkey, l_shipdate"


def _sql_line(direction: str) -> str:
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"SELECT {PICK} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY {order}) AS r FROM lineitem) WHERE r = 1"


@query(_sql_line("DESC"))
def keep_last_by_id(spark, sf_dir):
    return mg.keep_last(table(spark, sf_dir, "lineitem"), ["l_orderkey"], LINE_ORDER).select(*PICK.split(", "))


@query(_sql_line("ASC"))
def keep_first_by_id(spark, sf_dir):
    return mg.keep_first(table(spark, sf_dir, "lineitem"), ["l_orderkey"], LINE_ORDER).select(*PICK.split(", "))


def _orders(spark, sf_dir, test="true"):
    return table(spark, sf_dir, "orders").where(test).withColumnRenamed("o_orderkey", "in_id")


@query("""SELECT o_orderkey AS in_id, CASE WHEN o_orderkey % 5 = 0 THEN 'done' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 3 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice
FROM orders WHERE o_orderkey % 3 <> 0 OR o_orderkey % 5 = 0""")
def upsert_by_key(spark, sf_dir):
    target = _orders(spark, sf_dir, "o_orderkey % 3 <> 0").select("in_id", "o_orderstatus", "o_totalprice")
    source = _orders(spark, sf_dir, "o_orderkey % 5 = 0").select("in_id", F.lit("done").alias("o_orderstatus"))
    return mg.upsert(target, source, ["in_id"])


@query("""SELECT o_orderkey AS in_id, CASE WHEN o_orderkey % 4 = 0 AND o_orderkey % 5 = 0 THEN 'filled' WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderstatus END AS status, o_totalprice FROM orders WHERE o_orderkey % 3 <> 0""")
def guarded_upsert(spark, sf_dir):
    status = F.when(F.col("in_id") % 4 != 0, F.col("o_orderstatus")).alias("status")
    target = _orders(spark, sf_dir, "o_orderkey % 3 <> 0").select("in_id", status, "o_totalprice")
    source = _orders(spark, sf_dir, "o_orderkey % 5 = 0").select("in_id", F.lit("filled").alias("status"), F.lit(0.0).alias("o_totalprice"))
    return mg.guarded_upsert(target, source, ["in_id"], allow=["status"], fill_only=True)


@query("SELECT o_orderkey AS in_id, o_orderstatus FROM orders WHERE o_orderkey % 7 <> 0")
def delete_by_ids(spark, sf_dir):
    ids = _orders(spark, sf_dir, "o_orderkey % 7 = 0")
    return mg.delete_ids(_orders(spark, sf_dir).select("in_id", "o_orderstatus"), ids)


@query("SELECT o_orderkey AS in_id, o_custkey FROM orders WHERE o_orderkey % 6 <> 1")
def pending_records(spark, sf_dir):
    done = table(spark, sf_dir, "orders").where("o_orderkey % 6 = 1").select(F.col("o_orderkey").cast("string").alias("incident_id"))
    return mg.pending(_orders(spark, sf_dir).select("in_id", "o_custkey"), done)


@query("""SELECT o_orderkey AS in_id, o_orderdate FROM orders o WHERE o_orderkey NOT IN (
SELECT l_orderkey FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-06-01 00:00:00' - INTERVAL 4806 HOUR)""")
def dedup_vs_target(spark, sf_dir):
    target = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("in_id"), F.col("l_shipdate").alias("closed_at"))
    hours = mg.look_back_hours(4800)
    return mg.dedup_vs_target(_orders(spark, sf_dir).select("in_id", "o_orderdate"), target, dt.datetime(2000, 6, 1), hours)


RESULTS = """results AS (SELECT l_orderkey AS in_id, l_returnflag AS category, l_linestatus AS o_orderstatus, * EXCLUDE (l_orderkey, l_returnflag, l_linestatus),
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS r
  FROM lineitem WHERE l_orderkey % 4 <> 0)"""


def _results(spark, sf_dir):
    line = table(spark, sf_dir, "lineitem").where("l_orderkey % 4 <> 0")
    ordered = mg.keep_last(line, ["l_orderkey"], LINE_ORDER)
    return ordered.select(F.col("l_orderkey").alias("in_id"), F.col("l_returnflag").alias("category"), F.col("l_linestatus").alias("o_orderstatus"), "l_shipdate")


@query(f"WITH {RESULTS} SELECT o_orderkey AS in_id, o_custkey, r.category, r.o_orderstatus, r.l_shipdate FROM orders LEFT JOIN results r ON r.in_id = o_orderkey AND r.r = 1")
def merge_l123(spark, sf_dir):
    source = _orders(spark, sf_dir).select("in_id", "o_custkey", "o_orderstatus")
    line = table(spark, sf_dir, "lineitem").where("l_orderkey % 4 <> 0").withColumnsRenamed({"l_orderkey": "in_id", "l_returnflag": "category", "l_linestatus": "o_orderstatus"})
    order = [{"l_returnflag": "category", "l_linestatus": "o_orderstatus"}.get(c, c) for c in LINE_ORDER]
    return mg.merge_l123(source, line, order).select("in_id", "o_custkey", "category", "o_orderstatus", "l_shipdate")


PARTS = """parts AS (SELECT user_id AS in_id, 'file' || cast(event_id % 5 AS VARCHAR) AS file, event_id AS seq, CASE WHEN event_id % 3 = 0 THEN NULL ELSE event_type END AS l4,
  CASE WHEN event_id % 2 = 0 THEN NULL ELSE value END AS confidence FROM events)"""


def _parts(spark, sf_dir):
    e = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.col("user_id").alias("in_id"), F.concat(F.lit("file"), (e % 5).cast("string")).alias("file"), e.alias("seq"),
        F.when(e % 3 != 0, F.col("event_type")).alias("l4"), F.when(e % 2 != 0, F.col("value")).alias("confidence"),
    )


@query(f"""WITH {PARTS}, last AS (SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY in_id, file ORDER BY seq DESC) = 1)
SELECT c_custkey AS in_id, c_mktsegment, (SELECT arg_max(l4, (file, seq)) FROM last WHERE in_id = c_custkey AND l4 IS NOT NULL) AS l4,
(SELECT arg_max(confidence, (file, seq)) FROM last WHERE in_id = c_custkey AND confidence IS NOT NULL) AS confidence FROM customer""")
def merge_l4(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("in_id"), "c_mktsegment")
    return mg.merge_l4(base, _parts(spark, sf_dir), ["l4", "confidence"])


@query(f"""WITH {PARTS} SELECT c_custkey AS in_id, l4, confidence FROM customer LEFT JOIN (
SELECT * FROM parts QUALIFY row_number() OVER (PARTITION BY in_id ORDER BY file, seq) = 1) ON in_id = c_custkey""")
def merge_l4_first(spark, sf_dir):
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("in_id"))
    return mg.merge_l4(base, _parts(spark, sf_dir), ["l4", "confidence"], policy="first")


@query("""SELECT l.o_orderkey AS incident_id, l.o_orderstatus AS subcategory, l.o_orderpriority AS category, s.o_totalprice AS resolution FROM orders l LEFT JOIN orders s ON s.o_orderkey = l.o_orderkey AND s.o_orderkey % 2 = 0 WHERE l.o_orderkey % 3 = 0""")
def classified_context(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    labels = orders.where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("incident_id"), F.col("o_orderstatus").alias("subcategory"), F.col("o_orderpriority").alias("category"))
    source = orders.where("o_orderkey % 2 = 0").select(F.col("o_orderkey").alias("in_id"), F.lit("of the source").alias("subcategory"), F.col("o_totalprice").alias("resolution"))
    return mg.classified_context(labels, source, ["subcategory", "resolution"])


@query(f"""WITH b AS (SELECT trim(CAST(o_custkey AS VARCHAR)) AS k, * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) = 1),
a AS (SELECT * FROM orders WHERE o_orderkey % 2 = 0 QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
SELECT b.k AS "B_ticket", b.o_orderstatus AS "B_label", CAST(a.o_custkey AS VARCHAR) AS "A_in_id", a.o_orderstatus AS "A_label", a.o_orderkey AS "A_seq", b.o_orderkey AS "B_seq" FROM b JOIN a ON b.o_custkey = a.o_custkey""")
def join_labelers(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    key = F.concat(F.lit(" "), F.col("o_custkey").cast("string"))
    b = orders.select(key.alias("ticket"), F.col("o_orderstatus").alias("label"), F.col("o_orderkey").alias("seq"))
    a = orders.where("o_orderkey % 2 = 0").select(F.col("o_custkey").cast("string").alias("in_id"), F.col("o_orderstatus").alias("label"), F.col("o_orderkey").alias("seq"))
    return mg.join_labelers(b, a, "ticket", "in_id", ["seq"], ["seq"])


@query("""SELECT o_orderkey AS in_id, CASE WHEN o_orderkey % 3 = 0 THEN 'missing_in_target' ELSE 'extra_in_target' END AS side FROM orders WHERE (o_orderkey % 3 = 0) <> (o_orderkey % 4 = 0)
AND (o_orderkey % 3 = 0 OR o_orderkey % 4 = 0)""")
def reconcile_ids(spark, sf_dir):
    return mg.reconcile_ids(_orders(spark, sf_dir, "o_orderkey % 3 = 0"), _orders(spark, sf_dir, "o_orderkey % 4 = 0"))


@query("SELECT min(l_shipdate) AS first_closed, max(l_shipdate) AS last_closed, count(DISTINCT l_orderkey) AS ids FROM lineitem")
def time_range(spark, sf_dir):
    return mg.time_range(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_shipdate")


@query("SELECT DISTINCT o_custkey AS in_id FROM orders WHERE o_orderkey % 2 = 0 EXCEPT SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 0")
def id_difference(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "in_id")
    return mg.id_difference(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 3 = 0"))


@query("""WITH s AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 2 = 0), t AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 9 = 0)
SELECT count(t.k) AS matching, count(s.k) AS ids, count(t.k) * 100.0 / count(s.k) AS match_pct FROM s LEFT JOIN t USING (k)""")
def id_intersection(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "in_id")
    return mg.id_intersection(orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 9 = 0")).withColumn("match_pct", F.col("match_pct").cast("double"))


@query("""SELECT o_orderkey AS in_id, o_orderstatus AS l1, NULL AS l2 FROM orders WHERE o_orderkey % 2 = 0 UNION ALL SELECT o_orderkey, NULL, o_orderpriority FROM orders WHERE o_orderkey % 3 = 0""")
def union_checkpoints(spark, sf_dir):
    one = _orders(spark, sf_dir, "o_orderkey % 2 = 0").select("in_id", F.col("o_orderstatus").alias("l1"))
    two = _orders(spark, sf_dir, "o_orderkey % 3 = 0").select(F.col("o_orderpriority").alias("l2"), "in_id")
    return mg.union_checkpoints(one, two)


@query(f"""WITH {INCIDENTS}, o AS (SELECT in_id, a_l1 AS category FROM incidents WHERE doc_id % 3 <> 0)
SELECT in_id, category, NULL AS subcategory, NULL AS product, NULL AS validation_status, NULL AS gap_reason FROM o
UNION ALL SELECT in_id, 'Uncategorized', 'Uncategorized', 'Uncategorized', 'pipeline_gap', 'no answer' FROM incidents WHERE doc_id % 3 = 0""")
def pipeline_gap_rows(spark, sf_dir):
    base = incidents(spark, sf_dir)
    answered = base.where("doc_id % 3 <> 0").select("in_id", F.col("a_l1").alias("category"))
    return mg.fill_gaps(base, answered, "no answer").select("in_id", "category", "subcategory", "product", "validation_status", "gap_reason")


@query("""SELECT o_orderkey AS in_id, o_orderstatus AS ai_l1, o_orderpriority AS ai_l2, CAST(NULL AS VARCHAR) AS ai_l4, 'o_orderdate,o_totalprice' AS extra, 'ai_l4' AS absent FROM orders""")
def align_to_schema(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("IN_ID"), F.col("o_orderstatus").alias("category"), F.col("o_orderpriority").alias("SubCategory"), "o_orderdate", "o_totalprice")
    out, extra, absent = mg.align_to_schema(orders, {"in_id": ["incident_id"], "ai_l1": ["category"], "ai_l2": ["subcategory"], "ai_l4": ["l4_category"]})
    return out.withColumns({"extra": F.lit(",".join(sorted(extra))), "absent": F.lit(",".join(absent))})

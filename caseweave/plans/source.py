"""Queries of the incident source, over orders (tickets), lineitem (facts, notes), customer (contacts), supplier (values)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from caseweave.functions import text as tx
from caseweave.operators import source as src
from caseweave.plans.base import query, table

TODAY, CUTOVER, SINCE = dt.date(2003, 6, 1), dt.datetime(1996, 4, 6), dt.datetime(1997, 6, 1)
SHAPES = {
    "tickets": """SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'REQ' ELSE 'INC' END || lpad(cast(o_orderkey AS string), 8, '0') AS in_id, o_orderdate AS open_time,
  CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate - INTERVAL 8000 DAY ELSE o_orderdate END AS start_time, o_orderdate + INTERVAL 3 DAY AS update_time,
  CASE WHEN o_orderkey % 41 = 0 THEN 'EV' END AS event_id,
  CASE o_orderkey % 5 WHEN 0 THEN 'Primary' WHEN 1 THEN 'Secondary' WHEN 2 THEN NULL ELSE 'Standard' END AS incident_type,
  CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS priority_code,
  CASE o_orderkey % 3 WHEN 0 THEN 'Break/Fix' WHEN 1 THEN 'Password Reset' ELSE 'Change' END AS category,
  o_custkey AS callback_contact, CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE o_custkey % 100 END AS opened_by_id,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey - 1 END AS parent_id, o_totalprice - 100000 AS restored_duration,
  CASE o_orderkey % 8 WHEN 0 THEN 'KB' || cast(o_orderkey % 50 AS string) WHEN 1 THEN 'KX' || cast(o_orderkey AS string) WHEN 2 THEN ' KB7 ' END AS knowledge_id,
  CASE WHEN o_orderkey % 4 = 0 THEN 'PHONE' ELSE 'Web' END AS contact_type, o_totalprice / 100000 AS complaints FROM orders""",
    "texts": """SELECT CASE WHEN o_orderkey % 97 = 0 THEN 'REQ' ELSE 'INC' END || lpad(cast(o_orderkey AS string), 8, '0') AS in_id,
  o_orderpriority || ' order of customer ' || cast(o_custkey AS string) || ' with status ' || o_orderstatus || ' and more to say' AS brief_description,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'app ' || o_orderpriority END AS app FROM orders""",
    "facts": """SELECT 'INC' || lpad(cast(l_orderkey AS string), 8, '0') AS in_id, max(l_shipdate) AS close_time,
  CASE WHEN l_orderkey % 4 = 0 THEN NULL ELSE min(l_shipdate) END AS pending_closed, max(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS volume_phone,
  max(CASE WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 1 ELSE 0 END) AS volume_chat, max(CASE WHEN l_linenumber = 3 THEN 1 ELSE 0 END) AS volume_web_portal,
  max(CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END) AS volume_integration, max(CASE WHEN l_linenumber = 6 THEN 1 ELSE 0 END) AS volume_technician,
  CASE WHEN l_orderkey % 3 = 0 THEN NULL ELSE l_orderkey % 2 END AS contacts, CASE WHEN l_orderkey % 9 = 0 THEN NULL ELSE max(l_suppkey) END AS first_assigned_id,
  CASE WHEN l_orderkey % 7 = 0 THEN 'direct' END AS fact_contact_type, CASE WHEN l_orderkey % 10 = 0 THEN 'Open' ELSE 'Closed' END AS problem_status
  FROM lineitem GROUP BY l_orderkey""",
    "notes": "SELECT 'INC' || lpad(cast(l_orderkey AS string), 8, '0') AS in_id, 'shipped ' || l_linestatus || l_returnflag || ' rco' || cast(l_linenumber AS string) AS note FROM lineitem",
    "contacts": "SELECT c_custkey AS contact_name, c_name AS full_name, c_nationkey AS location FROM customer",
    "vals": "SELECT 'INC' || lpad(cast(o_orderkey AS string), 8, '0') AS in_id, 'Group ' || cast(o_orderkey % 7 AS string) AS workgroup FROM orders WHERE o_orderkey % 11 <> 0",
}
SOURCES = {"tickets": "orders", "texts": "orders", "facts": "lineitem", "notes": "lineitem", "contacts": "customer", "vals": "orders"}
WITH = "WITH " + ", ".join(f"{k} AS ({v})" for k, v in SHAPES.items())
RULES = {
    "integration_groups": ["Group 3"], "integration_openers": ["Customer#000000007", "Customer#000000011"], "groups": ["group 1", "Group 3", "GROUP 5"],
    "openers_out": [5, 7, 11], "priorities_out": ["1", "2"], "categories": ["Break/Fix", "Password Reset"], "articles_out": ["KB7", "KB8"], "status": "Closed",
}


def shape(spark, sf_dir, name):
    source = SOURCES[name]
    sql = SHAPES[name].replace(f"FROM {source}", "FROM {source}")
    return spark.sql(sql, source=table(spark, sf_dir, source))


JOINED = f"""{WITH}, flags AS (SELECT DISTINCT in_id FROM notes WHERE contains(upper(note), 'RCO7') AND starts_with(in_id, 'INC')),
joined AS (SELECT t.*, x.* EXCLUDE (in_id), f.* EXCLUDE (in_id), CASE WHEN n.in_id IS NULL THEN 0 ELSE 1 END AS note_flag, v.workgroup,
  p1.full_name AS caller_full_name, p2.full_name AS opened_by_full_name, p3.full_name AS first_assigned_full_name, p1.location AS caller_location
  FROM tickets t JOIN texts x USING (in_id) JOIN facts f USING (in_id) LEFT JOIN flags n USING (in_id) LEFT JOIN vals v USING (in_id)
  LEFT JOIN contacts p1 ON callback_contact = p1.contact_name LEFT JOIN contacts p2 ON opened_by_id = p2.contact_name
  LEFT JOIN contacts p3 ON first_assigned_id = p3.contact_name)"""


def _joined(spark, sf_dir, tickets=None):
    parts = {k: shape(spark, sf_dir, k) for k in SHAPES}
    flags = src.note_flag(parts["notes"], "rco7")
    return src.incident_joins(parts["tickets"] if tickets is None else tickets, parts["texts"], parts["facts"], flags, parts["contacts"], parts["vals"])


@query(f"{JOINED} SELECT in_id, close_time, note_flag, workgroup, caller_full_name, opened_by_full_name, first_assigned_full_name, caller_location FROM joined")
def incident_joins(spark, sf_dir):
    return _joined(spark, sf_dir).select("in_id", "close_time", "note_flag", "workgroup", "caller_full_name", "opened_by_full_name", "first_assigned_full_name", "caller_location")


@query(f"""{WITH} SELECT in_id, CASE WHEN in_id IN (SELECT in_id FROM notes WHERE contains(upper(note), 'RCO7')) AND starts_with(in_id, 'INC') THEN 1 ELSE 0 END AS note_flag FROM tickets""")
def work_note_flag(spark, sf_dir):
    flags = src.note_flag(shape(spark, sf_dir, "notes"), "rco7")
    return shape(spark, sf_dir, "tickets").join(flags, "in_id", "left").select("in_id", F.coalesce("note_flag", F.lit(0)).alias("note_flag"))


START = "CASE WHEN start_time < TIMESTAMP '2003-06-01' - INTERVAL 7500 DAY THEN start_time + INTERVAL (2003 - year(start_time)) YEAR ELSE start_time END"
KB = "CASE WHEN open_time > TIMESTAMP '1996-04-06' AND starts_with(knowledge_id, 'KB') THEN substr(knowledge_id, 1, 40) END"
PORTAL = "CASE WHEN volume_web_portal = 1 AND coalesce(contacts, 0) = 0 THEN 1 WHEN volume_web_portal = 1 THEN 0 END"


@query(f"""{JOINED} SELECT in_id, {START} AS start_time, open_time, date_trunc('day', close_time) AS close_day, substr(brief_description, 1, 60) AS brief_description, upper(app) AS app,
CASE WHEN restored_duration >= 0 THEN restored_duration END AS restored_duration, {KB} AS knowledge_id, CASE WHEN open_time > TIMESTAMP '1996-04-06' THEN knowledge_id END AS issue_ki_id,
coalesce(fact_contact_type, lower(contact_type)) AS contact_type, {PORTAL} AS portal_nonworked, CAST(trunc(complaints) AS INTEGER) AS escalation_count, note_flag, caller_full_name,
opened_by_full_name, first_assigned_full_name, open_time AS opened_at, coalesce(pending_closed, close_time) AS closed_at, workgroup AS first_assignment_group
FROM joined WHERE event_id IS NULL AND incident_type <> 'Primary' AND starts_with(in_id, 'INC') AND (update_time >= TIMESTAMP '1997-06-01' OR parent_id IS NOT NULL)""")
def incident_base(spark, sf_dir):
    kept = src.row_filter(shape(spark, sf_dir, "tickets"), SINCE)
    return src.incident_base(_joined(spark, sf_dir, kept), TODAY, CUTOVER).withColumn("close_day", F.col("close_day").cast("timestamp_ntz"))


@query(f"""{WITH} SELECT in_id, incident_type, parent_id FROM tickets WHERE event_id IS NULL AND incident_type <> 'Primary' AND starts_with(in_id, 'INC')
AND (update_time >= TIMESTAMP '1997-06-01' OR parent_id IS NOT NULL)""")
def incident_row_filter(spark, sf_dir):
    return src.row_filter(shape(spark, sf_dir, "tickets"), SINCE).select("in_id", "incident_type", "parent_id")


@query(f"""{JOINED} SELECT in_id, workgroup, opened_by_id, priority_code FROM joined WHERE (volume_phone = 1 OR volume_chat = 1 OR volume_web_portal = 1
OR ((volume_integration = 1 OR volume_technician = 1) AND upper(workgroup) = 'GROUP 3') OR (volume_integration = 1 AND opened_by_full_name IN ('Customer#000000007', 'Customer#000000011')))
AND upper(workgroup) IN ('GROUP 1', 'GROUP 3', 'GROUP 5') AND (opened_by_id NOT IN (5, 7, 11) OR opened_by_id IS NULL) AND (priority_code NOT IN ('1', '2') OR priority_code IS NULL)
AND (incident_type = 'Standard' OR (incident_type = 'Secondary' AND first_assigned_id IS NOT NULL)) AND category IN ('Break/Fix', 'Password Reset')
AND (trim(knowledge_id) NOT IN ('KB7', 'KB8') OR knowledge_id IS NULL) AND problem_status = 'Closed'""")
def incident_scope_filter(spark, sf_dir):
    return src.scope_filter(_joined(spark, sf_dir), RULES).select("in_id", "workgroup", "opened_by_id", "priority_code")


@query("""SELECT o_orderkey, CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AS in_range, CAST(o_orderdate AS DATE) >= DATE '1998-01-01' AS since,
CAST(o_orderdate AS DATE) >= DATE '1999-06-01' - INTERVAL 9 DAY AS default_days, CAST(o_orderdate AS DATE) >= DATE '1999-06-01' AS minutes_back FROM orders""")
def incident_window(spark, sf_dir):
    day, today = F.col("o_orderdate"), dt.date(1999, 6, 1)
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", src.time_filter(day, today, start=dt.date(1996, 1, 1), end=dt.date(1996, 12, 31), days=3).alias("in_range"),
        src.time_filter(day, today, start=dt.date(1998, 1, 1), minutes=5).alias("since"), src.time_filter(day, today).alias("default_days"),
        src.time_filter(day, today, minutes=30, days=20).alias("minutes_back"),
    )


@query(f"{WITH} SELECT in_id, {START} AS start_time FROM tickets")
def stale_year_shift(spark, sf_dir):
    return shape(spark, sf_dir, "tickets").select("in_id", src.fix_start(F.col("start_time"), TODAY).alias("start_time"))


@query(f"{WITH} SELECT in_id, CASE WHEN restored_duration >= 0 THEN restored_duration END AS restored_duration FROM tickets")
def negative_to_null(spark, sf_dir):
    return shape(spark, sf_dir, "tickets").select("in_id", src.neg_to_null(F.col("restored_duration")).alias("restored_duration"))


@query(f"{WITH} SELECT in_id, {KB} AS knowledge_id FROM tickets")
def gated_reference_ids(spark, sf_dir):
    return shape(spark, sf_dir, "tickets").select("in_id", src.gated_reference(F.col("knowledge_id"), F.col("open_time"), CUTOVER).alias("knowledge_id"))


@query(f"{WITH} SELECT in_id, {PORTAL} AS portal_nonworked, coalesce(pending_closed, close_time) AS closed_at FROM facts", name="portal_nonworked")
def portal(spark, sf_dir):
    closed = src.closed_at(F.col("pending_closed"), F.col("close_time")).alias("closed_at")
    return shape(spark, sf_dir, "facts").select("in_id", src.portal_nonworked(F.col("volume_web_portal"), F.col("contacts")).alias("portal_nonworked"), closed)


@query(f"{WITH} SELECT in_id, coalesce(pending_closed, close_time) AS closed_at, close_time AS closed FROM facts")
def closed_at_coalesce(spark, sf_dir):
    return shape(spark, sf_dir, "facts").select("in_id", src.closed_at(F.col("pending_closed"), F.col("close_time")).alias("closed_at"), F.col("close_time").alias("closed"))


@query("""SELECT o_orderkey, substr(o_orderpriority, 1, 4) AS cut, upper(o_orderpriority) AS up, lower(o_orderpriority) AS low, CAST(o_orderkey AS VARCHAR) AS key_text,
CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS day, CAST(trunc(o_totalprice) AS INTEGER) AS whole FROM orders""")
def text_trim_case(spark, sf_dir):
    priority = {"cut": ("o_orderpriority", "cut", 4), "up": ("o_orderpriority", "upper"), "low": ("o_orderpriority", "lower")}
    other = {"key_text": ("o_orderkey", "text"), "day": ("o_orderdate", "day"), "whole": ("o_totalprice", "whole")}
    return src.shaped(table(spark, sf_dir, "orders"), "o_orderkey", priority | other)


@query("""WITH v AS (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(1700000000000 + event_id * 1500 AS VARCHAR) WHEN 1 THEN CAST(1700000000 + event_id AS VARCHAR)
WHEN 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') ELSE 'soon' END AS raw FROM events)
SELECT event_id, CASE WHEN event_id % 4 = 0 THEN date_trunc('second', make_timestamp((1700000000000 + event_id * 1500) * 1000)) WHEN event_id % 4 = 1 THEN make_timestamp((1700000000 + event_id) * 1000000)
WHEN event_id % 4 = 2 THEN CAST(raw AS TIMESTAMP) END AS moment FROM v""")
def coerce_timestamps(spark, sf_dir):
    e = F.col("event_id")
    raw = (
        F.when(e % 4 == 0, (1700000000000 + e * 1500).cast("string")).when(e % 4 == 1, (1700000000 + e).cast("string"))
        .when(e % 4 == 2, F.date_format("ts", "yyyy-MM-dd HH:mm:ss")).otherwise("soon")
    )
    return table(spark, sf_dir, "events").select("event_id", tx.coerce_timestamp(raw).cast("timestamp_ntz").alias("moment"))


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN '1999-12' ELSE strftime(o_orderdate, '%Y-%m') END AS month FROM orders")
def month_bucket(spark, sf_dir):
    k = F.col("o_orderkey")
    closed = F.when(k % 10 == 0, "n/a").when(k % 3 == 0, "1999-12-31 10:00:00")
    opened = F.when(k % 10 != 0, F.col("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", tx.month_bucket(closed, opened).alias("month"))

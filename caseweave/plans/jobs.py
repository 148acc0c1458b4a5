"""Queries of sources and sinks, batched functions and streams.  Files go to the cluster's shared folder."""

from __future__ import annotations

import datetime as dt
import uuid

import pandas as pd
from pyspark.sql import functions as F

from caseweave.functions import text as tx
from caseweave.operators import classify as cf
from caseweave.plans.base import INCIDENTS, incidents, query, sql_norm, sql_trueish, sql_usable, table
from caseweave.plans.comparison import rounded
from caseweave.plans.validation import L4TAX, _l4tax
from caseweave.sources import io
from caseweave.sources.shared import scratch
from caseweave.streaming import incidents as st


_DERBY = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


@query("SELECT o_orderkey, CAST(o_orderdate AS DATE) AS opened, o_orderpriority FROM orders WHERE o_orderstatus = 'F'")
def read_mart_jdbc(spark, sf_dir):
    """Orders in an embedded database (one JVM: for local sessions), read back by measured parts with a filter pushed down."""
    url = f"jdbc:derby:memory:mart{uuid.uuid4().hex};create=true"
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("open_time"), "o_orderpriority", "o_orderstatus")
    orders.write.jdbc(url, "orders", properties={"driver": _DERBY, "createTableColumnTypes": "o_orderpriority VARCHAR(32), o_orderstatus VARCHAR(8)"})
    mart = io.read_mart(spark, url, "orders", partitions=8, driver=_DERBY)
    return mart.where("o_orderstatus = 'F'").select("o_orderkey", F.col("open_time").cast("date").alias("opened"), "o_orderpriority")


def _csv_lines(spark, sf_dir, name: str) -> str:
    """Orders as CSV: lines with too many and with too few columns, line breaks inside quotes, texts for null, rows without id."""
    path, k = scratch(spark, name), F.col("o_orderkey")
    nulls = F.element_at(F.array(F.lit("None"), F.lit("N/A"), F.lit("nan")), (k % 3 + 1).cast("int"))
    label = F.when(k % 6 == 0, nulls).when(k % 6 == 1, F.concat("o_orderpriority", F.lit(",\n"), "o_orderstatus")).otherwise(F.col("o_orderpriority"))
    key = F.when(k % 14 == 3, "").otherwise(k.cast("string"))
    good = F.concat_ws(",", key, F.concat(F.lit('"'), label, F.lit('"')), F.col("o_totalprice").cast("string"))
    line = F.when(k % 10 == 0, F.concat(good, F.lit(",too,many"))).when(k % 10 == 5, key).otherwise(good)
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(path)
    return path


@query("""SELECT CASE WHEN o_orderkey % 14 <> 3 THEN o_orderkey END AS in_id, CASE WHEN o_orderkey % 6 = 0 THEN NULL WHEN o_orderkey % 6 = 1 THEN o_orderpriority || ',' || chr(10) || o_orderstatus ELSE o_orderpriority END AS label,
o_totalprice AS amount FROM orders WHERE o_orderkey % 10 NOT IN (0, 5)""")
def read_csv_tolerant(spark, sf_dir):
    return io.read_csv(spark, _csv_lines(spark, sf_dir, "csv"), "in_id long, label string, amount double", header=False, multi_line=True)


@query("""SELECT count(*) FILTER (o_orderkey % 10 NOT IN (0, 5)) AS n_rows, count(*) FILTER (o_orderkey % 10 IN (0, 5) AND NOT (o_orderkey % 14 = 3 AND o_orderkey % 10 = 5)) AS n_malformed,
count(*) FILTER (o_orderkey % 14 = 3 AND o_orderkey % 10 NOT IN (0, 5)) AS n_without_id FROM orders""")
def csv_read_counts(spark, sf_dir):
    return io.read_counts(spark, _csv_lines(spark, sf_dir, "counts"), "in_id long, label string, amount double", header=False, multi_line=True)


@query("""SELECT o_orderkey AS in_id, CASE WHEN o_orderkey % 4 <> 0 THEN 'say "' || o_orderpriority || '", ' || o_orderstatus END AS note, CASE WHEN o_orderkey % 8 <> 0 THEN o_totalprice END AS amount FROM orders WHERE o_orderkey % 8 <> 0""")
def write_csv_quoted(spark, sf_dir):
    path, k = scratch(spark, "quoted"), F.col("o_orderkey")
    note = F.when(k % 4 != 0, F.concat(F.lit('say "'), "o_orderpriority", F.lit('", '), "o_orderstatus"))
    rows = table(spark, sf_dir, "orders").select(k.alias("in_id"), note.alias("note"), F.when(k % 8 != 0, F.col("o_totalprice")).alias("amount"))
    nameless = rows.limit(5).select(F.lit(None).cast("long").alias("in_id"), F.lit("x").alias("note"), F.lit(1.0).alias("amount"))
    io.append_results(rows.where("in_id % 2 = 0").unionByName(nameless), path)
    io.append_results(rows.where("in_id % 2 = 1"), path)
    return io.read_csv(spark, path, "in_id long, note string, amount double")


@query("""WITH p AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN '/a/L4/checkpoint_1.csv' WHEN 1 THEN '/a/l123_checkpoint.csv' WHEN 2 THEN '/a/l123-Merged.csv' WHEN 3 THEN '/b/INPUT/x.csv' ELSE '/c/y.csv' END AS path FROM pages)
SELECT page_id, contains(lower(path), 'l4') AS is_l4, contains(lower(path), 'l123') AS is_l123, contains(lower(path), 'checkpoint') AS is_checkpoint, contains(lower(path), 'merged') AS is_merged,
contains(lower(path), 'input') AS is_input, page_id % 5 = 4 AS is_other FROM p""")
def route_artifacts(spark, sf_dir):
    names = ["/a/L4/checkpoint_1.csv", "/a/l123_checkpoint.csv", "/a/l123-Merged.csv", "/b/INPUT/x.csv", "/c/y.csv"]
    path = F.element_at(F.array(*map(F.lit, names)), (F.col("page_id") % 5 + 1).cast("int"))
    return io.route_artifacts(table(spark, sf_dir, "pages").select("page_id", path.alias("path"))).drop("path")


@query("""SELECT trim(CAST(o_custkey AS VARCHAR)) AS ticket_id, o_orderstatus AS domain, o_orderpriority AS category, o_orderstatus AS subcategory, o_orderpriority AS key_issue FROM orders WHERE o_orderkey % 5 <> 0""")
def read_labeler_b(spark, sf_dir):
    key = F.when(F.col("o_orderkey") % 5 == 0, "  ").otherwise(F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(" ")))
    export = table(spark, sf_dir, "orders").select(key.alias("ticket_id"), F.col("o_orderstatus").alias("domain"), F.col("o_orderpriority").alias("category"), F.col("o_orderstatus").alias("subcategory"), F.col("o_orderpriority").alias("key_issue"))
    return io.read_labeler_b(export)


@query("""SELECT DISTINCT source AS subcategory, 'fix_' || cast(doc_id % 5 AS VARCHAR) AS name, doc_id % 5 < 2 AS is_actionable FROM documents WHERE source <> 'src3'""")
def l4_taxonomy_table(spark, sf_dir):
    path, now = scratch(spark, "taxonomy"), dt.datetime(2024, 5, 2, 12)
    docs = table(spark, sf_dir, "documents").select("source", (F.col("doc_id") % 5).alias("k")).distinct()
    entry = F.struct(F.concat(F.lit("fix_"), F.col("k").cast("string")).alias("name"), (F.col("k") < 2).alias("is_actionable"))
    made = docs.groupBy("source").agg(F.collect_list(entry).alias("categories"))
    at = F.when(F.col("source") == "src3", "2024-04-30T00:00:00").when(F.col("source") != "src1", "2024-05-02T10:00:00.123456").alias("s3_uploaded_at")
    name = F.concat(F.lit("l4_"), tx.safe_name(F.col("source")), F.lit("_taxonomy.json")).alias("file")
    made.select(name, at, "categories").repartition("file").write.partitionBy("file").json(path)  # a document for each subcategory
    return io.l4_taxonomies(spark, path, now)


@query("""WITH r AS (SELECT DISTINCT strftime(date_trunc('day', o_orderdate), '%Y%m%d-%H%M%S') AS run_id, date_trunc('day', o_orderdate) AS run_at FROM orders WHERE o_orderkey % 3 = 0
UNION SELECT strftime(date_trunc('day', o_orderdate), '%Y%m%d_%H%M%S'), date_trunc('day', o_orderdate) FROM orders WHERE o_orderkey % 3 = 1)
SELECT run_id, place FROM (SELECT run_id, dense_rank() OVER (ORDER BY run_at DESC) AS place FROM r) WHERE place > 5""")
def retain_latest_runs(spark, sf_dir):
    day = F.date_trunc("day", "o_orderdate")
    k = F.col("o_orderkey") % 3
    named = F.when(k == 0, F.date_format(day, "yyyyMMdd-HHmmss")).when(k == 1, F.date_format(day, "yyyyMMdd_HHmmss")).otherwise("no run")
    runs = table(spark, sf_dir, "orders").select(named.alias("run_id"))
    return io.runs_to_delete(runs).withColumn("place", F.col("place").cast("long"))


@query("""WITH r AS (SELECT strftime(o_orderdate, '%Y') || '0101-000000' AS run_id, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL)
SELECT run_id, o_orderpriority, n FROM r WHERE run_id IN (SELECT DISTINCT run_id FROM r ORDER BY run_id DESC LIMIT 5) UNION ALL SELECT 'not a run', 'all', count(*) FROM orders""")
def delete_old_runs(spark, sf_dir):
    """A folder for each year's run and one that is no run; what is left after retention has gone over it."""
    path, orders = scratch(spark, "runs"), table(spark, sf_dir, "orders")
    run = F.concat(F.date_format("o_orderdate", "yyyy"), F.lit("0101-000000")).alias("run")
    made = orders.groupBy(run, "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    for name in [r["run"] for r in made.select("run").distinct().collect()]:
        made.where(F.col("run") == name).drop("run").write.parquet(f"{path}/{name}")
    orders.agg(F.lit("all").alias("o_orderpriority"), F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/not a run")
    io.delete_runs(spark, path)
    back = spark.read.schema("o_orderpriority string, n long").option("recursiveFileLookup", True).parquet(path)
    name = F.regexp_extract(F.replace(F.col("_metadata.file_path"), F.lit("%20"), F.lit(" ")), "/([^/]+)/[^/]+$", 1)
    return back.select(name.alias("run_id"), "o_orderpriority", "n")


@query("""SELECT 'coverage' AS report, o_orderstatus AS item, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'priorities', o_orderpriority || 'xy', count(*) FROM orders GROUP BY ALL""")
def report_tables(spark, sf_dir):
    path, orders = scratch(spark, "report"), table(spark, sf_dir, "orders")
    one = orders.groupBy(F.col("o_orderstatus").alias("item")).agg(F.count(F.lit(1)).alias("n"))
    two = orders.groupBy(F.concat("o_orderpriority", F.lit("x\x07y\x00")).alias("item")).agg(F.count(F.lit(1)).alias("n"))
    io.write_report({"coverage": one, "priorities": two}, path)
    back = [spark.read.parquet(f"{path}/{n}").select(F.lit(n).alias("report"), "item", "n") for n in ("coverage", "priorities")]
    return back[0].unionByName(back[1])


@query(r"SELECT page_id, regexp_replace(url || chr(7) || 'a' || chr(9) || 'b' || chr(31), '[\x00-\x08\x0B\x0C\x0E-\x1F]', '', 'g') AS clean FROM pages")
def strip_control_chars(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", tx.strip_controls(F.concat("url", F.lit("\x07a\tb\x1f"))).alias("clean"))


@query(f"WITH {INCIDENTS} SELECT in_id, CAST(row_number() OVER (PARTITION BY doc_id // 10 ORDER BY in_id) AS VARCHAR) || '. ' || substr(coalesce(nullif(trim(resolution), ''), nullif(trim(brief_description), ''), ''), 1, 150) AS context FROM incidents")
def context_l123(spark, sf_dir):
    rows = incidents(spark, sf_dir).withColumn("batch", F.floor(F.col("doc_id") / 10))
    return cf.context_l123(rows, ["resolution", "brief_description"], "batch", "in_id").select("in_id", "context")


#: Name, column and cut of each line.
L4_LINES = (
    ("Category", "a_l1", 200), ("Subcategory", "a_l2", 200), ("Issue", "a_l4", 200), ("Description", "brief_description", 500), ("Resolution", "resolution", 500),
    ("Action", "b_l4", 400), ("Comments", "resolution", 400), ("Updates", "resolution", 300), ("Notes", "brief_description", 300), ("Error", "a_l3", 200), ("Rationale", "b_l3", 200),
)


@query(f"""WITH {INCIDENTS} SELECT in_id, concat_ws(chr(10), CASE WHEN {sql_trueish("a_actionable")} THEN 'Self-resolved: yes' END,
{", ".join(f"'{n}: ' || CASE WHEN substr({c}, 1, {w}) NOT IN ('', 'None', 'nan') THEN substr({c}, 1, {w}) END" for n, c, w in L4_LINES)}) AS context FROM incidents""")
def context_l4(spark, sf_dir):
    return incidents(spark, sf_dir).select("in_id", cf.context_l4(list(L4_LINES), "a_actionable").alias("context"))


@query(f"""WITH {INCIDENTS} SELECT in_id, substr(coalesce(nullif(concat_ws(chr(10), nullif(trim(brief_description), ''), 'ISSUE: ' || nullif(trim(a_l4), '')), ''), '(none)'), 1, 120) AS states,
substr(coalesce(nullif(trim(resolution), ''), '(none)'), 1, 120) AS resolution_text FROM incidents""")
def context_judge(spark, sf_dir):
    parts = {"states": [("", "brief_description"), ("ISSUE", "a_l4")], "resolution_text": [("", "resolution")]}
    return incidents(spark, sf_dir).select("in_id", *cf.context_judge(parts, 120))


@query(f"WITH {INCIDENTS} SELECT in_id, a_l1, a_l2, doc_id FROM incidents")
def final_column_order(spark, sf_dir):
    wide = incidents(spark, sf_dir).select("doc_id", F.lit(1).alias("a_l1_x"), "a_l2", F.lit("s").alias("_validation_status"), "in_id", "a_l1")
    return io.order_columns(wide, ["in_id", "a_l1", "a_l2"])


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, 'so {"k": ' || json_extract_string(props, '$.k') || '} ok' AS reply, CAST(json_extract_string(props, '$.k') AS BIGINT) AS recovered,
'{"event":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS details, lower(replace(replace(event_type || ' A/b', ' ', '_'), '/', '_')) AS safe FROM events""")
def json_details(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    reply = F.concat(F.lit('so {"k": '), k, F.lit("} ok"))
    parsed = F.from_json(tx.recover_json(reply), "k long")
    details = F.to_json(F.struct(F.col("event_type").alias("event"), k.cast("long").alias("k")))
    return table(spark, sf_dir, "events").select("event_id", k.alias("k"), reply.alias("reply"), parsed.k.alias("recovered"), details.alias("details"), tx.safe_name(F.concat("event_type", F.lit(" A/b"))).alias("safe"))


@query("""SELECT event_id, CASE WHEN event_id % 5 <> 0 THEN event_type END AS event, CASE WHEN event_id % 5 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
CASE WHEN event_id % 5 = 0 THEN 'not json: ' || event_type END AS raw FROM events""")
def json_details_raw(spark, sf_dir):
    written = F.to_json(F.struct(F.col("event_type").alias("event"), F.get_json_object("props", "$.k").cast("long").alias("k")))
    text = F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("not json: "), "event_type")).otherwise(written)
    return table(spark, sf_dir, "events").select("event_id", tx.parse_details(text, "event string, k long").alias("d")).select("event_id", "d.*")


def _stub():
    """A stand-in for a model: labels from the text's length, silent on some rows."""

    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"in_id": batch["in_id"], "category": "len" + (batch["n_chars"] % 5).astype(str), "confidence": (batch["n_chars"] % 10) / 10})
        return out[batch["doc_id"] % 17 != 0]

    return answer


@query(f"""WITH {INCIDENTS} SELECT in_id, CASE WHEN doc_id % 17 <> 0 THEN 'len' || CAST(n_chars % 5 AS VARCHAR) END AS category, CASE WHEN doc_id % 17 <> 0 THEN (n_chars % 10) / 10 END AS confidence,
CASE WHEN doc_id % 17 = 0 THEN 'pipeline_gap' END AS validation_status, CASE WHEN doc_id % 17 = 0 THEN 'no answer' END AS gap_reason FROM incidents""")
def classify_batches(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("in_id", "doc_id", "n_chars")
    return cf.classify(rows, _stub, "category string, confidence double")


@query(f"""WITH {INCIDENTS} SELECT in_id, CASE WHEN doc_id % 17 <> 0 THEN 'len' || CAST(n_chars % 5 AS VARCHAR) END AS category, CASE WHEN doc_id % 17 <> 0 THEN (n_chars % 10) / 10 END AS confidence,
CASE WHEN doc_id % 17 = 0 THEN 'pipeline_gap' END AS validation_status, CASE WHEN doc_id % 17 = 0 THEN 'no answer' END AS gap_reason FROM incidents""")
def classify_resumable(spark, sf_dir):
    """A run that ends after its first wave, and is started again: the ledger's answers aren't asked for twice."""
    rows, path = incidents(spark, sf_dir).select("in_id", "doc_id", "n_chars"), scratch(spark, "ledger")
    ask = lambda part: cf.classify(part, _stub, "category string, confidence double")
    cf.resumable(rows, ask, path, "run1", task_rows=50, most_waves=1)
    return cf.resumable(rows, ask, path, "run1")


def _stub_l4():
    tried: dict = {}

    def answer(batch: pd.DataFrame, allowed: list) -> pd.DataFrame:
        labels = []
        for key, n in zip(batch["in_id"], batch["n_chars"], strict=True):
            tried[key] = tried.get(key, 0) + 1
            good = allowed[n % len(allowed)] if allowed else None
            labels.append(good if n % 3 == 0 or (n % 3 == 1 and tried[key] == 3) else "made up")
        return pd.DataFrame({"in_id": batch["in_id"], "l4": labels})

    return answer


@query(f"""WITH {INCIDENTS}, {L4TAX}, n AS (SELECT subcategory, list_sort(list(name)) AS names FROM l4tax GROUP BY subcategory)
SELECT in_id, CASE WHEN n_chars % 3 < 2 AND names IS NOT NULL THEN names[n_chars % len(names) + 1] END AS l4 FROM incidents LEFT JOIN n ON a_l2 = subcategory""")
def classify_by_subcategory(spark, sf_dir):
    rows = incidents(spark, sf_dir).select("in_id", "a_l2", "n_chars")
    return cf.classify_by_subcategory(rows, _stub_l4, _l4tax(spark, sf_dir), "a_l2", "l4 string", "l4").select("in_id", "l4")


def _stub_judge():
    def score(row: dict) -> dict:
        if row["doc_id"] % 19 == 0:
            raise ValueError("no verdict")
        return {"a_score": str(row["n_chars"] % 5), "b_score": "N" if row["n_chars"] % 7 == 0 else str(row["doc_id"] % 5)}

    return score


@query(f"""WITH {INCIDENTS} SELECT in_id, CASE WHEN doc_id % 19 <> 0 THEN CAST(n_chars % 5 AS VARCHAR) END AS a_score, CASE WHEN doc_id % 19 <> 0 THEN CASE WHEN n_chars % 7 = 0 THEN 'N' ELSE CAST(doc_id % 5 AS VARCHAR) END END AS b_score,
CASE WHEN doc_id % 19 = 0 THEN 'ValueError: no verdict' END AS error FROM incidents""")
def judge_batches(spark, sf_dir):
    return cf.judge(incidents(spark, sf_dir).select("in_id", "doc_id", "n_chars"), _stub_judge, "a_score string, b_score string")


def _events(spark, sf_dir):
    return st.file_stream(spark, f"{sf_dir}/event[s].parquet")  # a pattern: a stream takes a folder or a pattern, not a file


def _dedup(spark, sf_dir, name: str, delay: str):
    out, target = scratch(spark, name), table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id")).where("user_id % 3 = 0")
    fresh = st.incremental_dedup(_events(spark, sf_dir).select("user_id", "ts"), st.known_ids(target, "user_id", f"{out}-known"), "user_id", "ts", delay)
    st.run_once(fresh.select("user_id").writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state"))
    return spark.read.schema("user_id long").parquet(out), target


@query("SELECT DISTINCT user_id FROM events WHERE user_id % 3 <> 0")
def stream_incremental_dedup(spark, sf_dir):
    # a delay longer than the table: each id passes once, and nothing here takes away what the stream gives out twice
    return _dedup(spark, sf_dir, "dedup", "36500 days")[0]


@query("SELECT DISTINCT user_id FROM events WHERE user_id % 3 <> 0")
def stream_dedup_with_late_rows(spark, sf_dir):
    streamed, target = _dedup(spark, sf_dir, "late-dedup", "6 hours")
    return st.complete_dedup(table(spark, sf_dir, "events"), streamed, target, "user_id")


def _through(spark, rows, sink) -> int:
    """Runs a stream into a sink; the number of its last batch."""
    last = {"n": -1}

    def apply(batch, number):
        sink(batch, number)
        last["n"] = number

    st.run_once(rows.writeStream.foreachBatch(apply).option("checkpointLocation", f"{sink.path}/state"))
    return last["n"]


@query("SELECT user_id, event_type, value, event_id FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1")
def stream_upsert(spark, sf_dir):
    sink = st.VersionedUpsert(scratch(spark, "upsert"), "user_id", ["event_id"])
    rows = _events(spark, sf_dir).select("user_id", "event_type", "value", "event_id")
    return sink.read(spark, _through(spark, rows, sink), rows.schema)


@query("""SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(date_trunc('milliseconds', ts)) - INTERVAL 6 HOUR FROM events) GROUP BY ALL""")
def stream_label_counts(spark, sf_dir):
    sink = st.WindowCounts(scratch(spark, "counts"), "ts", {"L1": F.col("event_type")})
    counts = sink.read(spark, _through(spark, _events(spark, sf_dir).select("event_type", "ts"), sink), sink.schema)
    return st.closed_windows(counts).select(F.col("start").cast("timestamp_ntz").alias("start"), F.col("label").alias("event_type"), "n")


_EVENT_LEVELS = {"L1": "CASE WHEN event_id % 11 = 0 THEN ' None ' WHEN event_id % 13 = 0 THEN NULL ELSE event_type END", "L2": "CASE WHEN user_id % 9 = 0 THEN 'Other' ELSE concat('u', cast(user_id % 7 AS string)) END"}


@query(f"""WITH s AS (SELECT date_trunc('hour', ts) AS start, level, v FROM (SELECT ts, unnest([{{'level': 'L1', 'v': {_EVENT_LEVELS["L1"]}}}, {{'level': 'L2', 'v': {_EVENT_LEVELS["L2"]}}}], recursive := true) FROM events)),
c AS (SELECT start, level, CASE WHEN {sql_usable("v")} THEN {sql_norm("v")} END AS label, count(*) AS n FROM s GROUP BY ALL),
w AS (SELECT start, level, CAST(sum(n) AS BIGINT) AS rows, coalesce(sum(n) FILTER (label IS NOT NULL), 0) * 100 / sum(n) AS usable_pct, count(*) FILTER (label IS NOT NULL) AS labels,
  max(n) FILTER (label IS NOT NULL) * 100 / sum(n) FILTER (label IS NOT NULL) AS top_pct,
  log2(sum(n) FILTER (label IS NOT NULL)) - sum(n * log2(n)) FILTER (label IS NOT NULL) / sum(n) FILTER (label IS NOT NULL) AS entropy FROM c GROUP BY ALL)
SELECT start, level, rows, round(usable_pct, 6) AS usable_pct, labels, round(top_pct, 6) AS top_pct, round(entropy, 6) + 0.0 AS entropy,
  round(usable_pct - lag(usable_pct) OVER b, 6) + 0.0 AS usable_drift, round(top_pct - lag(top_pct) OVER b, 6) + 0.0 AS top_drift FROM w WINDOW b AS (PARTITION BY level ORDER BY start)""")
def stream_label_coverage(spark, sf_dir):
    sink = st.WindowCounts(scratch(spark, "coverage"), "ts", {k: F.expr(e) for k, e in _EVENT_LEVELS.items()})
    counts = sink.read(spark, _through(spark, _events(spark, sf_dir).select("event_id", "user_id", "event_type", "ts"), sink), sink.schema)
    out = st.coverage_by_window(counts).withColumn("start", F.col("start").cast("timestamp_ntz"))
    return rounded(out, "usable_pct", "top_pct", "entropy", "usable_drift", "top_drift")


@query("SELECT event_id, 'missing_in_target' AS side FROM events WHERE event_id % 10 = 0")
def stream_late_routing(spark, sf_dir):
    out = scratch(spark, "late")
    arrived = _events(spark, sf_dir).where("event_id % 10 <> 0").select("event_id")
    st.run_once(arrived.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}-state"))
    return st.late_ids(table(spark, sf_dir, "events"), spark.read.schema("event_id long").parquet(out), "event_id")




@query("SELECT event_id, lower(replace(replace(event_type || ' A/b', ' ', '_'), '/', '_')) AS safe FROM events")
def safe_name(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", tx.safe_name(F.concat("event_type", F.lit(" A/b"))).alias("safe"))


@query("""SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN props END AS found, CASE WHEN event_id % 4 <> 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""")
def recover_json(spark, sf_dir):
    reply = F.when(F.col("event_id") % 4 == 0, "nothing").otherwise(F.concat(F.lit("Sure:\n"), "props", F.lit("\nDone.")))
    found = tx.recover_json(reply)
    return table(spark, sf_dir, "events").select("event_id", found.alias("found"), F.from_json(found, "k long").k.alias("k"))

"""The three workloads end to end: incremental labelling, labeler comparison, reconcile and repair."""

from __future__ import annotations

import datetime as dt
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.operators import classify as cf
from caseweave.operators import clusters as cl
from caseweave.operators import compare as cmp
from caseweave.operators import merge as mg
from caseweave.operators import validate as va
from caseweave.plans import comparison  # noqa: F401  its queries' SQL
from caseweave.plans.base import INCIDENTS, ORACLES, incidents, query, table
from caseweave.sources.shared import checkpointed

LEVELS = ("category", "subcategory", "product")


def label_new_incidents(
    fetched: DataFrame, target: DataFrame, taxonomy: DataFrame, make_l123, make_l4, now: dt.datetime, hours: float, run_id: str,
    ledger: str | None = None,
) -> dict[str, DataFrame]:
    """Deduplicate, label, validate, gate, label level 4, clean, upsert; with the audit and the null reasons of the run.

    Texts are only carried to the labelling functions; from validation on, rows hold ids and labels.  Their answers are
    written at once, so that no plan that reads them, and no lost executor, asks a model twice.  With a ``ledger`` (a folder)
    they are saved as they come, and a run that is started again under its ``run_id`` asks for the rest only.
    """

    def answered(rows: DataFrame, make, schema: str, name: str) -> DataFrame:
        ask = lambda part: cf.classify(part, make, schema)
        return cf.resumable(rows, ask, f"{ledger}/{name}", run_id) if ledger else checkpointed(ask(rows))

    fresh = mg.dedup_vs_target(fetched, target, now, hours)
    labelled = answered(fresh, make_l123, "category string, subcategory string, product string", "l123")
    labelled = mg.fill_gaps(fresh, labelled.drop("validation_status", "gap_reason"), "no row came back").select("in_id", *LEVELS)
    checked = checkpointed(va.validate_path(labelled, checkpointed(taxonomy), levels=LEVELS))
    on, off = va.pre_l4_gate(checked, "final_l2")
    asked = on.join(fresh.drop(*[c for c in fresh.columns if c in on.columns and c != "in_id"]), "in_id")
    l4 = answered(asked, make_l4, "l4 string", "l4").select("in_id", "l4")
    merged = on.join(l4, "in_id", "left").unionByName(off.withColumnRenamed("l4_category", "l4").select(*on.columns, "l4"))
    cleaned = va.l4_clean(merged, "l4")
    final = va.backfill(cleaned, ("final_l1", "final_l2", "final_l3"))
    rows = final.select("in_id", *(F.col(f"final_l{i}").alias(f"ai_l{i}") for i in (1, 2, 3)), F.col("l4_clean").alias("ai_l4"), F.lit(run_id).alias("run_id"))
    return {
        "final": mg.upsert(target, rows, ["in_id"]),
        "audit": va.l123_audit(checked, run_id),
        "null_reasons": va.l4_null_reasons(cleaned, "l4_clean", "l4_original", run_id),
    }


def compare_labelers(frame: DataFrame) -> dict[str, DataFrame]:
    """The comparison's tables over the whole frame, which is narrow and read by all of them."""
    narrow = frame.select("in_id", "period", *(f"{m}_l{k}" for m in "ab" for k in range(1, 5)))
    ranked = cl.rank_clusters(cl.clusters(narrow))
    return {
        "coverage": cmp.coverage(narrow), "granularity": cmp.granularity(narrow), "agreement": cmp.agreement(narrow), "strata": cmp.stratified_agreement(narrow),
        "disagreements": cmp.top_disagreements(narrow), "clusters": ranked, "pareto": cl.pareto(ranked),
    }


def repair(source: DataFrame, target: DataFrame, relabel, label: str = "ai_l4") -> DataFrame:
    """Rows that the target should not have go, missing rows come from the source, null labels are filled by ``relabel``.

    ``relabel`` takes the rows without a label and gives ``in_id`` and the label; no other column of the target changes.
    """
    sides = mg.reconcile_ids(source, target)
    lean = mg.delete_ids(target, sides.where("side = 'extra_in_target'"))
    lost = source.join(sides.where("side = 'missing_in_target'").select("in_id"), "in_id", "left_semi")
    whole = lean.unionByName(lost.select(*[c for c in target.columns if c in source.columns]), allowMissingColumns=True)
    return mg.guarded_upsert(whole, relabel(whole.where(F.col(label).isNull())), ["in_id"], allow=[label], fill_only=True)


def _l123():
    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"in_id": batch["in_id"], "category": batch["a_l1"], "subcategory": batch["a_l2"], "product": batch["a_l3"]})
        return out[batch["doc_id"] % 17 != 0]

    return answer


def _l4():
    def answer(batch: pd.DataFrame) -> pd.DataFrame:
        n = batch["n_chars"]
        return pd.DataFrame({"in_id": batch["in_id"], "l4": ("fix_" + (n % 3).astype(str)).where(n % 4 != 0, "insufficient_information")})

    return answer


_KNOWN = "(a_l1, a_l2, a_l3) IN (SELECT (a_l1, a_l2, a_l3) FROM incidents WHERE doc_id % 3 = 0 AND a_l1 IS NOT NULL AND a_l1 <> 'Uncategorized')"
_FINE = f"doc_id % 17 <> 0 AND a_l1 IS NOT NULL AND coalesce({_KNOWN}, false)"


def _run(spark, sf_dir) -> dict[str, DataFrame]:
    rows = incidents(spark, sf_dir)
    old = rows.where("doc_id % 10 = 0")
    target = old.select("in_id", F.lit("old").alias("ai_l1"), F.lit("old").alias("ai_l2"), F.lit("old").alias("ai_l3"), F.lit("old").alias("ai_l4"), F.lit("run0").alias("run_id"), F.col("opened_at").alias("closed_at"))
    taxonomy = rows.where("doc_id % 3 = 0 and a_l1 is not null and a_l1 <> 'Uncategorized'").select(F.col("a_l1").alias("l1"), F.col("a_l2").alias("l2"), F.col("a_l3").alias("l3")).distinct()
    fetched = rows.select("in_id", "doc_id", "n_chars", "a_l1", "a_l2", "a_l3")
    return label_new_incidents(fetched, target, taxonomy, _l123, _l4, dt.datetime(2024, 2, 1), 24 * 60, "run1")


@query(f"""WITH {INCIDENTS} SELECT in_id, 'old' AS ai_l1, 'old' AS ai_l2, 'old' AS ai_l3, 'old' AS ai_l4, 'run0' AS run_id FROM incidents WHERE doc_id % 10 = 0
UNION ALL SELECT in_id, {", ".join(f"CASE WHEN {_FINE} THEN a_l{i} ELSE 'Uncategorized' END" for i in (1, 2, 3))},
CASE WHEN NOT ({_FINE}) THEN 'Unclassified' WHEN n_chars % 4 <> 0 THEN 'fix_' || CAST(n_chars % 3 AS VARCHAR) END, 'run1' FROM incidents WHERE doc_id % 10 <> 0""")
def workload_incremental_run(spark, sf_dir):
    return _run(spark, sf_dir)["final"].drop("closed_at")


@query(f"WITH {INCIDENTS} SELECT in_id, 'run1' AS run_id, 'cleaned' AS reason, 'insufficient_information' AS original_value FROM incidents WHERE doc_id % 10 <> 0 AND {_FINE} AND n_chars % 4 = 0")
def workload_null_reasons(spark, sf_dir):
    return _run(spark, sf_dir)["null_reasons"]


#: Tables of the comparison: the query with the same rows, what names a row, and its figures.
COMPARISON = {
    "coverage": ("label_coverage", ("level",), ("a_pct", "b_pct")),
    "granularity": ("label_granularity", ("model", "level"), ("rows", "labels", "top10_pct", "entropy")),
    "agreement": ("label_agreement", ("level",), ("n_both", "agreement_pct")),
    "strata": ("stratified_agreement", ("stratum", "a_l1", "a_l2", "a_l3", "period", "level"), ("rows", "n_both", "agreement_pct")),
    "disagreements": ("top_disagreements", ("level", "b", "a"), ("n", "pct", "rank")),
    "clusters": ("cluster_rank_cumulative", ("model", "path", "l1", "l2", "l3", "l4"), ("n", "rank", "pct", "cumulative_pct")),
    "pareto": ("pareto_summary", ("model",), ("incidents", "paths", "to_cover_50", "to_cover_80")),
}


def stacked(tables: dict[str, DataFrame]) -> DataFrame:
    """All tables of the comparison as rows ``part, row_name, figure, value``."""
    out = []
    for part, (_, keys, figures) in COMPARISON.items():
        name = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys))
        each = F.explode(F.array(*(F.struct(F.lit(f).alias("figure"), F.round(F.col(f).cast("double"), 6).alias("value")) for f in figures)))
        out.append(tables[part].select(F.lit(part).alias("part"), name.alias("row_name"), each.alias("f")).select("part", "row_name", "f.figure", "f.value"))
    return reduce(DataFrame.unionByName, out)


def _sql_stacked() -> str:
    parts = []
    for part, (query_name, keys, figures) in COMPARISON.items():
        name = ", ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
        for figure in figures:
            parts.append(f"SELECT '{part}' AS part, concat_ws('|', {name}) AS row_name, '{figure}' AS figure, round(CAST({figure} AS DOUBLE), 6) AS value FROM ({ORACLES[query_name]})")
    return " UNION ALL ".join(parts)


@query(_sql_stacked())
def workload_comparison(spark, sf_dir):
    return stacked(compare_labelers(incidents(spark, sf_dir)))


@query("""SELECT o_orderkey AS in_id, o_orderstatus AS status, CASE WHEN o_orderkey % 4 = 0 OR o_orderkey % 10 = 0 THEN 'again' ELSE o_orderpriority END AS ai_l4 FROM orders WHERE o_orderkey % 7 <> 0""")
def workload_reconcile_repair(spark, sf_dir):
    orders, k = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "in_id"), F.col("in_id")
    source = orders.where(k % 7 != 0).select("in_id", F.col("o_orderstatus").alias("status"))
    target = orders.where(k % 10 != 0).select("in_id", F.col("o_orderstatus").alias("status"), F.when(k % 4 != 0, F.col("o_orderpriority")).alias("ai_l4"))
    return repair(source, target, lambda rows: rows.select("in_id", F.lit("again").alias("ai_l4")))

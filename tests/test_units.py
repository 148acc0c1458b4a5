"""Truth tables, invariants and edge cases of the incident operators."""

import datetime as dt
import json
import math
import os
import random
import re
import time
from collections import Counter

import pandas as pd
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from caseweave.functions import labels as lb
from caseweave.functions import text as tx
from caseweave.operators import classify as cf
from caseweave.operators import clusters as cl
from caseweave.operators import judge as jd
from caseweave.operators import merge as mg
from caseweave.operators import similarity as sim
from caseweave.plans import measures
from caseweave.plans.base import incidents
from caseweave.registry import ORACLES, QUERIES
from caseweave.sources import io, shared
from caseweave.streaming import incidents as si
from tests.oracle import duck, rows_of_duck, rows_of_spark

VALUES = [None, "", "  ", "None", "none", " None ", "NONE", "unknown", "Other", "Unclassified", "Unclassified_L4", "N/A", "Uncategorized", " Uncategorized ", "uncategorized", "foo_unknown", "insufficient_x", "x_insufficient_y", "fix_1"]
TRUE = {
    "usable": {"Uncategorized", " Uncategorized ", "uncategorized", "foo_unknown", "insufficient_x", "x_insufficient_y", "fix_1"},
    "missing": {None, "", "  ", "None", "none", " None ", "NONE"},
    "missing_in_target": {None, "", "  ", "None"},
    "backfill_missing": {None, "", "  ", "None", "none", "NONE"},
    "uncategorized": {None, "", "  ", "None", "none", " None ", "NONE", "Uncategorized", " Uncategorized "},
}


@pytest.mark.parametrize("name", sorted(TRUE))
def test_truth_table(spark, name):
    rows = spark.createDataFrame([(v,) for v in VALUES], "v string").select("v", getattr(lb, name)(F.col("v")).alias("t")).collect()
    assert {r.v for r in rows if r.t} == TRUE[name]
    assert all(r.t is not None for r in rows)


def test_clean_l4_is_anchored(spark):
    rows = {r.v: r.c for r in spark.createDataFrame([(v,) for v in VALUES], "v string").select("v", lb.clean_l4(F.col("v")).alias("c")).collect()}
    assert rows["foo_unknown"] == "foo_unknown" and rows["x_insufficient_y"] == "x_insufficient_y"
    assert rows["insufficient_x"] is None and rows["NONE"] is None and rows["Unclassified_L4"] == "Unclassified"


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 9), st.one_of(st.none(), st.text("ab", max_size=2))), max_size=12))
def test_keep_and_upsert_invariants(spark, rows):
    df = spark.createDataFrame([(a, i * 10 + b, c) for i, (a, b, c) in enumerate(rows)], "in_id long, seq long, v string")
    last = mg.keep_last(df, ["in_id"], ["seq"])
    assert last.count() == df.select("in_id").distinct().count()
    once = mg.upsert(df.limit(0), last, ["in_id"])
    assert sorted(map(repr, mg.upsert(once, last, ["in_id"]).collect())) == sorted(map(repr, once.collect()))


def test_fill_gaps_gives_every_input_one_row(spark):
    inputs = spark.createDataFrame([(i,) for i in range(6)], "in_id long")
    outputs = spark.createDataFrame([(1, "a"), (4, "b")], "in_id long, category string")
    out = mg.fill_gaps(inputs, outputs, "why").collect()
    assert sorted(r.in_id for r in out) == list(range(6)) and sum(r.category == "Uncategorized" for r in out) == 4


def test_failing_batch_becomes_gap_rows(spark):
    def make():
        def answer(batch: pd.DataFrame):
            if (batch["in_id"] == 3).any():
                raise RuntimeError("down")
            return pd.concat([batch[["in_id"]].assign(label="x"), pd.DataFrame({"in_id": [None, 99], "label": ["y", "z"]})])

        return answer

    df = spark.createDataFrame([(i,) for i in range(6)], "in_id long").coalesce(1)
    rows = cf.classify(df, make, "label string", batch_size=2).collect()
    assert sorted(r.in_id for r in rows) == list(range(6))
    assert {r.in_id for r in rows if r.validation_status} == {2, 3} and all("down" in r.gap_reason for r in rows if r.validation_status)


def test_correlation_p_value():
    # r = 0.5 with 10 pairs: t = 1.632993, two-sided p = 0.141111...
    assert math.isclose(jd.correlation_p(0.5, 10), 0.14111328, abs_tol=1e-7)
    assert math.isclose(jd.correlation_p(0.9, 5), 0.03738607, abs_tol=1e-7)
    assert jd.correlation_p(1.0, 5) == 0.0 and math.isnan(jd.correlation_p(0.1, 2))


def test_similar_pairs_over_several_blocks(spark, monkeypatch):
    texts = [(i, f"alpha beta w{i % 7} w{i % 5} gamma{i % 3}") for i in range(60)]
    vectors = sim.tfidf(spark.createDataFrame(texts, "in_id long, text string"), "in_id", "text", 20).cache()
    one = {(r.i, r.j): round(r.cosine, 9) for r in sim.similar_pairs(vectors, "in_id", 0.6).collect()}
    monkeypatch.setattr(sim, "BLOCK_ROWS", 13)
    rows = sim.similar_pairs(vectors, "in_id", 0.6).collect()
    assert len(rows) == len(one) and {(r.i, r.j): round(r.cosine, 9) for r in rows} == one
    assert all(i < j for i, j in one)


def test_jdbc_source(spark):
    url = "jdbc:derby:memory:mart;create=true"
    rows = spark.createDataFrame([(i, dt.datetime(2024, 1, 1 + i % 20)) for i in range(50)], "in_id int, open_time timestamp")
    rows.write.jdbc(url, "tickets", mode="overwrite", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    back = io.read_mart(spark, url, "tickets", dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 20), partitions=3, driver="org.apache.derby.iapi.jdbc.AutoloadedDriver")
    assert back.count() == 50 and back.rdd.getNumPartitions() == 3


def test_labeler_b_must_have_its_columns(spark):
    with pytest.raises(ValueError, match="key_issue"):
        io.read_labeler_b(spark.createDataFrame([("a",)], "ticket_id string").selectExpr("*", "1 domain", "1 category", "1 subcategory"))


def test_upsert_sink_survives_replay(spark, tmp_path):
    sink = si.VersionedUpsert(str(tmp_path), "in_id", ["seq"])
    first = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "in_id long, seq long, v string")
    second = spark.createDataFrame([(2, 2, "c"), (3, 1, "d"), (2, 3, "e")], "in_id long, seq long, v string")
    sink(first, 0)
    sink(second, 1)
    sink(second, 1)
    assert {r.in_id: r.v for r in sink.read(spark, 1, first.schema).collect()} == {1: "a", 2: "e", 3: "d"}


def test_upsert_sink_writes_in_proportion_to_the_batch(spark, tmp_path):
    """A small batch of random keys writes its own rows only; compaction rewrites a row a few times in all."""
    schema, generator = "in_id long, seq long, v string", random.Random(5)
    sink = si.VersionedUpsert(str(tmp_path), "in_id", ["seq"], unit=4000)
    expected = {k: "a" for k in range(100_000)}
    sink(spark.createDataFrame([(k, 0, "a") for k in expected], schema).coalesce(1), 0)
    base = sink.written[0]
    for number in range(1, 11):
        keys = generator.sample(range(100_000), 500)
        expected |= dict.fromkeys(keys, f"b{number}")
        sink(spark.createDataFrame([(k, number, f"b{number}") for k in keys], schema).coalesce(1), number)
    assert max(sink.written[1:]) < base / 5 and sorted(sink.written[1:])[4] < base / 20
    assert {r.in_id: r.v for r in sink.read(spark, 10, schema).collect()} == expected
    assert {r.v for r in sink.read(spark, 9, schema).collect()} == {"a"} | {f"b{n}" for n in range(1, 10)}
    named = set(sink._list(spark, 10)) | set(sink._runs(spark, 9))
    assert {p.name for p in tmp_path.glob("run-*")} == named and len(sink._runs(spark, 10)) < 9
    sink(spark.createDataFrame([(3, 11, "c")], schema), 11)
    sink(spark.createDataFrame([(3, 11, "c")], schema), 11)  # a replay
    sink(spark.createDataFrame([(3, 1, "late")], schema), 12)
    assert {r.in_id: r.v for r in sink.read(spark, 12, schema).collect()} == expected | {3: "c"}


def test_taxonomy_files_by_subcategory(spark, tmp_path):
    now = dt.datetime(2024, 5, 2, 12)
    stamps = {"network": "2024-05-02T01:00:00.000001", "email_server": None, "old": "2024-04-30T00:00:00"}
    for name, stamp in stamps.items():
        doc = {"categories": [{"name": f"{name}-1", "is_actionable": True}, {"name": f"{name}-2"}]} | ({"s3_uploaded_at": stamp} if stamp else {})
        (tmp_path / "v1").mkdir(exist_ok=True)
        (tmp_path / "v1" / f"l4_{name}_taxonomy.json").write_text(json.dumps(doc, indent=2))
    (tmp_path / "v1" / "other.json").write_text("{}")
    rows = sorted(map(tuple, io.l4_taxonomies(spark, str(tmp_path), now).collect()), key=repr)
    assert rows == [("email_server", "email_server-1", True), ("email_server", "email_server-2", None), ("network", "network-1", True), ("network", "network-2", None)]


def test_csv_reads_agree_whatever_is_asked_for(spark, tmp_path):
    (tmp_path / "x.csv").write_text('in_id,label,n\n1,a,1\n2,"b, c",2\n3,d\n4,e,5,6\n,f,7\nx,g,8\n')
    schema, path = "in_id long, label string, n int", str(tmp_path / "x.csv")
    rows = io.read_csv(spark, path, schema)
    assert [tuple(r) for r in rows.collect()] == [(1, "a", 1), (2, "b, c", 2), (None, "f", 7)]
    assert rows.count() == rows.select("label").count() == 3
    assert tuple(io.read_counts(spark, path, schema).first()) == (3, 3, 1)


def test_details_that_are_no_json_are_kept_raw(spark):
    rows = [('{"a": 1}',), ("oops",), (None,), ("",), ("{}",)]
    out = spark.createDataFrame(rows, "t string").select(tx.parse_details(F.col("t"), "a int").alias("d")).collect()
    assert [r.d and tuple(r.d) for r in out] == [(1, None), (None, "oops"), None, None, (None, None)]


def test_clusters_ranked_over_range_partitions(spark):
    rows = [("A" if k % 3 else "B", f"p{k % 57}", "x", "y", "z", f"f{k % 5}") for k in range(900)]
    found = spark.createDataFrame(rows, "model string, path string, l1 string, l2 string, l3 string, l4 string").groupBy("model", "path", "l1", "l2", "l3", "l4").agg(F.count(F.lit(1)).alias("n"))
    out = cl.rank_clusters(found.repartition(7)).collect()
    for model in "AB":
        mine = sorted((r for r in out if r.model == model), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, len(mine) + 1))
        assert [(-r.n, r.path, r.l4) for r in mine] == sorted((-r.n, r.path, r.l4) for r in mine)
        total = sum(r.n for r in mine)
        assert all(math.isclose(r.cumulative_pct, sum(x.n for x in mine[: i + 1]) / total * 100) for i, r in enumerate(mine))


def test_shared_folder_has_to_be_named_on_a_cluster():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_folder(Session())


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "in_id long, seq long, v string")
    assert mg.keep_last(empty, ["in_id"], ["seq"]).count() == 0
    assert mg.upsert(empty, empty, ["in_id"]).count() == 0
    assert mg.reconcile_ids(empty, empty).count() == 0


def plain_cosine(x, y):
    a, b = Counter(x), Counter(y)
    square = lambda own, other: sum((n * (1 if t in other else 1 + math.log(1.5))) ** 2 for t, n in own.items())
    return sum(n * b[t] for t, n in a.items()) / math.sqrt(square(a, b) * square(b, a)) if a and b else None


def test_incident_texts_are_whole(spark, sf_dir):
    texts = {f"INC{r.doc_id:07}": r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = {r.in_id: r for r in incidents(spark, sf_dir).select("in_id", "brief_description", "resolution").collect()}
    assert max(map(len, texts.values())) > 10_000
    assert all(r.brief_description == texts[k] for k, r in rows.items())
    assert all(r.resolution == (texts[k].split("\n", 1)[1] if "\n" in texts[k] else None) for k, r in rows.items())
    words = {k: re.findall(r"\w{2,}", texts[k].lower()) for k in rows}
    df = Counter(t for w in words.values() for t in set(w))
    idf = {t: math.log((1 + sum(map(bool, words.values()))) / (1 + df[t])) + 1 for t in df}
    vectors = {}
    for r in measures.tfidf_vectors(spark, sf_dir).collect():
        vectors.setdefault(r.in_id, {})[r.term] = r.weight
    kept = {t for v in vectors.values() for t in v}
    for k, v in vectors.items():  # counts of the whole text
        raw = {t: n * idf[t] for t, n in Counter(words[k]).items() if t in kept}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        assert v.keys() == raw.keys() and all(math.isclose(v[t], w / norm, abs_tol=2e-6) for t, w in raw.items())


def test_pair_cosine_of_long_texts(spark):
    shared = "alpha beta " * 400
    cases = [(shared + "gamma", shared + "delta " * 9), (shared, shared), ("", "ab"), (None, "ab"), ("ab cd", "ef"), (" ".join(f"w{i % 9000}" for i in range(20_000)), " ".join(f"w{i % 7000}" for i in range(20_000)))]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "k int, a string, b string").coalesce(1)
    begun = time.perf_counter()
    rows = {r.k: r.c for r in df.select("k", tx.pair_cosine(F.col("a"), F.col("b")).alias("c")).collect()}
    assert time.perf_counter() - begun < 10  # a search through the list for every term takes minutes
    for k, (a, b) in enumerate(cases):
        expected = plain_cosine((a or "").split(), (b or "").split())
        assert rows[k] is None if expected is None else math.isclose(rows[k], expected, abs_tol=1e-9)


@pytest.mark.parametrize("name", ["stream_upsert", "stream_incremental_dedup", "stream_dedup_with_late_rows", "stream_label_counts", "stream_label_coverage"])
def test_streams_of_batches_out_of_order(spark, sf_dir, tmp_path, monkeypatch, name):
    """The newest rows come first; a watermark drops late rows from the second batch after it on."""
    os.makedirs(tmp_path / "events.parquet")
    os.symlink(f"{sf_dir}/customer.parquet", tmp_path / "customer.parquet")
    events = pq.read_table(f"{sf_dir}/events.parquet").sort_by([("ts", "ascending")])
    n = events.num_rows
    for k, part in enumerate((events.slice(n - 5), events.slice(n - 10, 5), events.slice(0, n - 10))):
        path = str(tmp_path / "events.parquet" / f"part-{k}.parquet")
        pq.write_table(part, path)
        os.utime(path, (1_700_000_000 + k,) * 2)
    stream = si.file_stream
    monkeypatch.setattr(si, "file_stream", lambda spark, path: stream(spark, path, 1))
    rows = rows_of_spark(QUERIES[name](spark, str(tmp_path)))
    assert rows == rows_of_duck(duck(str(tmp_path)), ORACLES[name])

"""Stateful streams: restart without the target, known ids that expire, windows corrected by late rows."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from caseweave.streaming import incidents as si


def write(path, rows, number):
    os.makedirs(path, exist_ok=True)
    name = f"{path}/part-{number}.parquet"
    pq.write_table(pa.table({"in_id": pa.array([r[0] for r in rows], pa.int64()), "ts": [r[1] for r in rows], "v": [r[2] for r in rows]}), name)
    os.utime(name, (1_700_000_000 + number,) * 2)


def at(hours):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=hours)


def run(spark, folder, target, **options):
    stream = si.file_stream(spark, f"{folder}/in", 1)
    fresh = si.incremental_dedup(stream, si.known_ids(target, "in_id", f"{folder}/known"), "in_id", "ts", **options)
    si.run_once(fresh.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state"))


def test_dedup_restarts_without_reading_the_target(spark, tmp_path):
    target = spark.createDataFrame([(1,), (2,), (None,), (2,)], "in_id long")
    write(f"{tmp_path}/in", [(1, at(0), "known"), (3, at(2), "later"), (3, at(1), "first")], 0)
    write(f"{tmp_path}/in", [(3, at(3), "again"), (4, at(3), "new")], 1)
    run(spark, tmp_path, target)
    assert run_rows(spark, tmp_path) == {(3, "first"), (4, "new")}
    write(f"{tmp_path}/in", [(2, at(4), "known"), (4, at(4), "again"), (5, at(4), "new"), (None, at(4), "no id"), (None, at(4), "no id")], 2)
    gone = target.where(F.raise_error(F.lit("the target is read again")).isNull())
    run(spark, tmp_path, gone)
    assert run_rows(spark, tmp_path) == {(3, "first"), (4, "new"), (5, "new"), (None, "no id")}


def run_rows(spark, folder):
    rows = spark.read.schema("in_id long, ts timestamp, v string").parquet(f"{folder}/out").collect()
    assert len(rows) == len({(r.in_id, r.v) for r in rows})
    return {(r.in_id, r.v) for r in rows}


def test_known_ids_leave_the_state_after_the_look_back(spark, tmp_path):
    target = spark.createDataFrame([], "in_id long")
    for number, hours in enumerate((0, 1, 40, 80, 81)):
        write(f"{tmp_path}/in", [(7, at(hours), f"h{hours}")] * (hours not in (40, 80)) + [(100 + number, at(hours), "x")], number)
    run(spark, tmp_path, target, delay="1 hours", look_back_hours=24)
    assert {v for key, v in run_rows(spark, tmp_path) if key == 7} == {"h0", "h81"}


def test_known_ids_with_a_closing_time_expire_too(spark, tmp_path):
    target = spark.createDataFrame([(1, at(0)), (2, at(-100)), (3, None)], "in_id long, closed timestamp")
    for number, hours in enumerate((1, 40, 41, 42)):
        write(f"{tmp_path}/in", [(100 + number, at(hours), "x")] + [(k, at(hours), f"h{hours}") for k in (1, 2, 3)] * (number == 3), number)
    stream = si.file_stream(spark, f"{tmp_path}/in", 1)
    known = si.known_ids(target, "in_id", f"{tmp_path}/known", "closed")
    fresh = si.incremental_dedup(stream, known, "in_id", "ts", "1 hours", 30)
    si.run_once(fresh.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state"))
    assert {key for key, _ in run_rows(spark, tmp_path) if key < 100} == {1, 2}


def test_late_rows_correct_their_window(spark, tmp_path):
    levels = {"L1": F.col("a"), "L2": F.col("b")}
    sink = si.WindowCounts(str(tmp_path), "ts", levels)
    schema = "ts timestamp, a string, b string"
    sink(spark.createDataFrame([(at(0.1), "X", " None "), (at(0.2), "y", "q"), (at(5), "x", None)], schema), 0)
    sink(spark.createDataFrame([(at(9), "x", "q"), (at(0.3), "x", "q")], schema), 1)
    sink(spark.createDataFrame([(at(9), "x", "q"), (at(0.3), "x", "q")], schema), 1)  # a replay
    counts = sink.read(spark, 1, sink.schema)
    changed = {(r.start, r.level, r.label): (r.n_before, r.n_after) for r in sink.updates(spark, 1).collect()}
    assert changed == {(at(9), "L1", "x"): (0, 1), (at(9), "L2", "q"): (0, 1), (at(0), "L1", "x"): (1, 2), (at(0), "L2", "q"): (1, 2)}
    by = {(r.start, r.level): r for r in si.coverage_by_window(counts).collect()}
    first, second = by[at(0), "L2"], by[at(5), "L2"]
    assert (first.rows, round(first.usable_pct, 6), first.labels, first.top_pct, first.entropy, first.usable_drift) == (3, 66.666667, 1, 100, 0, None)
    assert (second.usable_pct, second.labels, second.top_pct, second.entropy, round(second.usable_drift, 6)) == (0, 0, None, None, -66.666667)
    assert round(by[at(0), "L1"].entropy, 6) == 0.918296 and by[at(9), "L1"].top_drift == 0
    assert {r.start for r in si.closed_windows(counts).collect()} == {at(0)}


def test_ids_of_a_bucket_are_judged_in_one_call(spark, tmp_path):
    """Some hundred ids in two states; whole numbers beyond 2**53 stay exact beside nulls; ids expire one by one."""
    big = (1 << 60) + 1
    kinds = pa.schema([("in_id", pa.int64()), ("ts", pa.timestamp("us")), ("v", pa.int64()), ("w", pa.int32())])
    batches = [
        [(big + k, at(k % 7), None if k % 5 == 0 else big + k, None if k % 3 else k) for k in range(300)] + [(big + 1, at(0), -1, 0), (None, at(1), big, 1)],
        [(big + 999, at(60), 1, 1), (big + 2, at(60), 2, 2)],
        [(big + 998, at(61), 1, 1)],
        [(big + k, at(62), k, k) for k in (1, 2, 3)],
    ]
    os.makedirs(f"{tmp_path}/in")
    for number, rows in enumerate(batches):
        pq.write_table(pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types, strict=True)], schema=kinds), f"{tmp_path}/in/part-{number}.parquet")
        os.utime(f"{tmp_path}/in/part-{number}.parquet", (1_700_000_000 + number,) * 2)
    known = si.known_ids(spark.createDataFrame([(big + 10,), (big + 20,)], "in_id long"), "in_id", f"{tmp_path}/known")
    fresh = si.incremental_dedup(si.file_stream(spark, f"{tmp_path}/in", 1), known, "in_id", "ts", "1 hours", 24, buckets=2)
    si.run_once(fresh.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state"))
    rows = sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").select("in_id", "v", "w").collect()), key=repr)
    first = [(k, v, w) for k, _, v, w in batches[0] if k not in (big + 10, big + 20) and (k, v) != (big + 1, big + 1)]
    assert rows == sorted([*first, (big + 999, 1, 1), (big + 998, 1, 1), (big + 1, 1, 1), (big + 3, 3, 3)], key=repr)

"""Hard negatives against a plain search of all pairs."""

import math
import random
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from caseweave.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, anchor string, score string, copies int"


def brute(rows, positives=5, negatives=10, low=30, high=90):
    good = []
    for key, vector, label in rows:
        if key is not None and label is not None and vector is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in vector):
            good.append((key, [math.floor(256 * x) if abs(x) < 2**60 else 256 * int(x) for x in vector], label))
    out = []
    for a, (key, vector, label) in enumerate(good):
        if key % 100:
            continue
        scored = []
        for b, (other, values, kind) in enumerate(good):
            if a != b:
                score = sum(x * y for x, y in zip(vector, values, strict=False))
                scored.append((-max(-(2**63), min(2**63 - 1, score)), other, kind == label))
        scored.sort()
        for p, positive, _ in [x for x in scored if x[2]][:positives]:
            inside = [x for x in scored if not x[2] and low * -p <= 100 * -x[0] <= high * -p][:negatives]
            out += [(key, positive, k, x[1], -p, -x[0]) for k, x in enumerate(inside, start=1)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", "y", 3) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(df, **options).collect())


def test_small_whole_numbers_with_many_ties(spark):
    generator = random.Random(5)
    rows = [(k if k % 3 else 100 * (k % 4), [generator.randrange(-2, 4) / 256 for _ in range(3)], generator.randrange(3)) for k in range(240)]
    expected = brute(rows)
    assert len(expected) > 500 and run(spark, rows, chunk_bytes=500) == expected
    assert run(spark, rows, chunk_bytes=900, broadcast_bytes=0) == expected
    assert run(spark, rows, positives=2, negatives=3, low=0, high=100) == brute(rows, 2, 3, 0, 100)


def test_window_at_score_zero(spark):
    rows = [(100, [1.0, 0.0], 1), (50, [0.0, 1.0], 1), (60, [0.0, 2.0], 1), (70, [-1.0, 0.0], 1), *((k, [0.0, k / 9], 2) for k in range(40, 62)), (3, [0.5, 0.0], 2)]
    expected = brute(rows)
    assert {r[4] for r in expected} == {0} and len(expected) == 20 and run(spark, rows, chunk_bytes=64) == expected


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vector = [0.5, 0.25]
    rows = [(100, vector, 1), (100, vector, 1), (100, [0.4, 0.3], 1), (1, vector, 1), (2, [0.3, 0.1], 2), (2, [0.3, 0.1], 2), (3, [0.3], 3), (4, [], 3), (5, [0.2] * 9, 3),
            (None, vector, 1), (6, None, 2), (7, [0.3, None], 2), (8, [nan, 0.1], 2), (9, [0.1, inf], 2), (10, vector, None), (-200, [-0.1, 0.3], 2), (11, [1e308, 0.0], 2)]
    expected = brute(rows)
    assert expected and run(spark, rows) == expected
    assert run(spark, rows[3:6]) == [] and run(spark, []) == [] and run(spark, rows[:4]) == []


def test_large_components_are_exact():
    rng = np.random.default_rng(2)
    a, b = (np.floor(rng.normal(size=(n, 5)) * scale) for n, scale in ((4, 2.0**40), (6, 2.0**30)))
    a[0], b[0], b[1] = 0, 2.0**70, 3
    exact = [[max(-(2**63), min(2**63 - 1, sum(int(x) * int(y) for x, y in zip(r, s, strict=True)))) for s in b.tolist()] for r in a.tolist()]
    assert hn.scores(a, b).tolist() == exact


def test_keys_sort_as_their_numbers():
    rows = [(a, s, k, i) for a in (0, 1, 2**40) for s in (-(2**63), -1, 0, 5, 2**63 - 1) for k in (0, 1) for i in (-(2**63), -3, 0, 9)]
    packed = sorted(hn.pack_key(*r) for r in rows)
    assert [hn.unpack_key(k)[:4] for k in packed] == sorted(rows, key=lambda r: (r[0], -r[1], r[2], r[3]))
    columns = [np.array([r[c] for r in rows], np.int64) for c in (0, 1, 3)]
    for kind in (0, 1):
        assert hn.pack_keys(columns[0], columns[1], kind, columns[2], np.zeros(len(rows), bool)).to_pylist() == [hn.pack_key(a, s, kind, i) for a, s, _, i in rows]


def test_iterators_hold_no_anchor():
    def endless():
        yield hn.pack_key(1, 100, 0, 7), struct.pack(hn._ANCHOR, 100, 1)
        for k in range(10**9):
            yield hn.pack_key(1, 80, 1, k), None

    found = hn.take_negatives(endless(), 10, 30, 90)
    assert [next(found)[3] for _ in range(10)] == list(range(10))


def test_other_anchors_and_kinds(spark):
    rows = [(k, [k / 256, 1.0], k % 2) for k in range(1, 9)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = hn.mine(df, anchors=F.col("vec_id") == 3)
    assert {r.anchor_id for r in out.collect()} <= {3}
    with pytest.raises(TypeError):
        hn.mine(df.withColumn("label", F.col("label").cast("string")))

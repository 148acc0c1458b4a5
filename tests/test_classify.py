"""One output row for each input row whatever the batches, the answer ledger, and labels with several canonical twins."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from caseweave.operators import classify as cf
from caseweave.operators import merge as mg
from caseweave.operators import validate as va


def maker():
    def answer(batch):
        assert batch["in_id"].is_unique
        return pd.DataFrame({"in_id": batch["in_id"], "label": batch["v"].str.upper()})[(batch["v"] != "silent").to_numpy()]

    return answer


def test_each_row_has_one_answer_whatever_the_batches(spark):
    rows = [(1, f"v{k % 3}") for k in range(12)] + [(None, "x"), (None, "y"), (2, "silent"), (3, "b"), (3, "silent")]
    df = spark.createDataFrame(rows, "in_id long, v string")
    expected = sorted(((k, None if k is None or v == "silent" else v.upper(), "no id" if k is None else "no answer" if v == "silent" else None) for k, v in rows), key=repr)
    for size in (1, 5, 10, 100):
        for parts in (1, 3):
            out = cf.classify(df.repartition(parts), maker, "label string", batch_size=size).collect()
            assert sorted(((r.in_id, r.label, r.gap_reason) for r in out), key=repr) == expected
            assert all((r.validation_status == "pipeline_gap") == (r.gap_reason is not None) for r in out)


def test_rows_of_subcategories_have_one_answer_each(spark):
    tax = spark.createDataFrame([("s", "A"), ("s", "B")], "subcategory string, name string")
    rows = [(1, "s", "a"), (1, "s", "b"), (1, "s", "zzz"), (None, "s", "a"), (2, None, "a"), (3, "t", "a"), (4, "s", "silent")]
    df = spark.createDataFrame(rows, "in_id long, sub string, v string")

    def make():
        def answer(batch, allowed):
            return maker()(batch)

        return answer

    for size in (1, 5):
        out = cf.classify_by_subcategory(df, make, tax, "sub", "label string", "label", batch_size=size).collect()
        assert sorted(((r.in_id, r.label, r.gap_reason) for r in out), key=repr) == sorted(
            [(1, "A", None), (1, "B", None), (1, None, None), (None, None, "no id"), (2, None, None), (3, None, None), (4, None, "no answer")], key=repr
        )


def test_a_killed_run_goes_on_where_the_ledger_ends(spark, tmp_path):
    df = spark.createDataFrame([(k, f"v{k}") for k in range(600)] + [(5, "v5"), (None, "x")], "in_id long, v string")
    calls, ledger = tmp_path / "calls", str(tmp_path / "ledger")
    os.makedirs(calls)

    def asking(last_wave):
        def make():
            def answer(batch):
                for key in batch["in_id"]:
                    with open(calls / str(key), "a") as file:
                        file.write("x")
                if len(os.listdir(calls)) > last_wave:
                    raise SystemExit(1)  # the worker ends, and the job with it
                return maker()(batch).assign(label=lambda b: b["label"].where(b["in_id"] != 77))[lambda b: b["in_id"] != 78]

            return answer

        return lambda part: cf.classify(part, make, "label string")

    with pytest.raises(Exception):  # noqa: B017
        cf.resumable(df, asking(350), ledger, "r", task_rows=25, wave_tasks=4)
    saved = spark.read.parquet(ledger).count()
    assert 100 < saved < 400
    out = cf.resumable(df, asking(10_000), ledger, "r", task_rows=25, wave_tasks=4).collect()
    assert sorted(r.in_id for r in out) == list(range(600)) and {r.in_id for r in out if r.gap_reason} == {78}
    assert sum(r.label is None for r in out) == 2
    twice = sum(len((calls / name).read_text()) > 1 for name in os.listdir(calls))
    assert twice <= 600 - saved and twice < 200  # those of the wave that was lost at most
    before = {name: (calls / name).stat().st_size for name in os.listdir(calls)}
    again = cf.resumable(df, asking(10_000), ledger, "r", task_rows=25, wave_tasks=4).collect()
    assert len(again) == 600 and {n for n in before if (calls / n).stat().st_size > before[n]} == {"78"}  # only the gap is asked again
    assert cf.resumable(df.limit(0), asking(10_000), ledger, "other").count() == 0
    assert cf._ledger(spark, ledger, "other").count() == 0


def test_judge_through_the_ledger(spark, tmp_path):
    df = spark.createDataFrame([(k, k) for k in range(40)], "in_id long, n long")

    def make():
        def score(row):
            if row["n"] == 3:
                raise ValueError("no")
            return {"a": str(row["n"])}

        return score

    ask = lambda part: cf.judge(part, make, "a string")
    cf.resumable(df, ask, str(tmp_path / "l"), "r", failed="error is not null", task_rows=5, wave_tasks=2, most_waves=1)
    out = {r.in_id: (r.a, r.error) for r in cf.resumable(df, ask, str(tmp_path / "l"), "r", failed="error is not null").collect()}
    assert out == {k: (None, "ValueError: no") if k == 3 else (str(k), None) for k in range(40)}


def test_twins_and_colliding_aliases_keep_their_rows(spark):
    tax = spark.createDataFrame([("Foo-Bar", "A", "B"), ("foo bar", "A", "B"), ("Email", "C", "D")], "l1 string, l2 string, l3 string")
    aliases = spark.createDataFrame([("l1", "E-mail", "Email"), ("l1", "e mail", "Email"), ("l1", "post", "Email"), ("l1", "Post!", "foo bar")], "level string, alias string, label string")
    rows = [(1, "foo bar", "A", "B"), (2, " Foo-Bar ", "A", "B"), (3, "FOO_BAR", "A", "B"), (4, "E-Mail", "C", "D"), (5, "e_mail", "c", "d"), (5, "Email", "C", "D"), (None, "x", None, "D")]
    df = spark.createDataFrame(rows, "in_id long, l1 string, l2 string, l3 string")
    out = va.validate_path(df, tax, aliases).collect()
    assert sorted(((r.in_id, r.original_l1, r.validation_status, r.final_l1) for r in out), key=repr) == sorted(
        [(1, "foo bar", "valid", "foo bar"), (2, " Foo-Bar ", "valid", "Foo-Bar"), (3, "FOO_BAR", "valid_after_repair", "Foo-Bar"), (4, "E-Mail", "valid_after_repair", "Email"),
         (5, "e_mail", "valid_after_repair", "Email"), (5, "Email", "valid", "Email"), (None, "x", "missing", "Uncategorized")], key=repr
    )
    assert [(r.alias, r.labels) for r in va.alias_conflicts(aliases).collect()] == [("post", ["email", "foo bar"])]


def test_a_null_id_with_an_output_has_no_gap_row(spark):
    inputs = spark.createDataFrame([(None,), (1,), (None,)], "in_id long")
    outputs = spark.createDataFrame([(None, "a")], "in_id long, category string")
    out = mg.fill_gaps(inputs, outputs, "why").select("in_id", F.col("category")).collect()
    assert sorted(map(tuple, out), key=repr) == [(1, "Uncategorized"), (None, "a")]


def test_answers_of_many_calls_are_matched_at_once(monkeypatch):
    """One concatenation for all calls of a frame; an answer counts for its own call only."""
    made, original = [], pd.concat
    monkeypatch.setattr(pd, "concat", lambda *a, **k: made.append(1) or original(*a, **k))
    frame = pd.DataFrame({"in_id": [k % 900 for k in range(1000)], "v": [f"v{k}" for k in range(1000)]})

    def answer(batch):
        if 7 in set(batch["in_id"]):
            raise ValueError("seven")
        extra = pd.DataFrame({"in_id": [(batch["in_id"].iloc[0] + 10) % 900, batch["in_id"].iloc[0], 10_000], "label": "not asked or twice"})
        return original([batch.assign(label=batch["v"])[["in_id", "label"]], extra])

    batches = cf._calls(frame, "in_id", 10)
    out, why = cf._asked(batches, [answer] * len(batches), "in_id", ["label"])
    rows = cf._outcomes(frame, out, batches, why, "in_id", ["label"])
    failed = {i for b in batches if 7 in set(b["in_id"]) for i in b.index}
    assert rows["label"].tolist() == [None if i in failed else f"v{i}" for i in range(1000)]
    assert rows["gap_reason"].tolist() == ["ValueError: seven" if i in failed else None for i in range(1000)]
    assert len(made) < 5


def test_waves_do_not_grow_in_number_with_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cf, "WAVES", 2, raising=False)
    waves, original = [], cf.checkpointed
    monkeypatch.setattr(cf, "checkpointed", lambda rows: waves.append(1) or original(rows))
    df = spark.createDataFrame([(k, f"v{k}") for k in range(400)], "in_id long, v string")
    out = cf.resumable(df, lambda part: cf.classify(part, maker, "label string"), str(tmp_path / "l"), "r", task_rows=10)
    assert sorted((r.in_id, r.label) for r in out.collect()) == [(k, f"V{k}") for k in range(400)]
    assert len(waves) <= 2  # 400 rows in tasks of 10 on 4 cores were 10 waves

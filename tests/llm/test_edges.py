"""What the docstrings state of empty tables, very long texts and clashing names, for each operator."""

import hashlib

import pytest
from pyspark.sql import functions as F

from caseweave.llm import _repeats as repeats
from caseweave.llm import chat_format, line_dedup, packing, quality_rules, registry, simhash, substring_dedup, suffix_dedup
from tests.llm.test_dedup import brute_bytes, brute_words, cut_bytes, cut_words, frame, texts

#: Names that the operators use themselves, as columns of the input.
CLASHING = ["id", "text_hash", "n_words", "component_id", "fingerprint", "sequence_id", "length", "n_turns", "__id", "place", "bucket", "row", "kept"]


def with_clashes(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_empty_tables(spark, sf_dir, tmp_path, name):
    for table in ("documents", "benchmark", "pages", "labels", "conversations", "embeddings"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    out = registry.QUERIES[name](spark, str(tmp_path)).collect()
    assert [r.conv_id for r in out] == ([-7] if name == "op1_chat_format" else [])


def test_clashing_names_change_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    talks = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    for query, table in ((simhash.simhash_query, docs), (packing.pack_query, docs), (chat_format.chat_format_query, talks)):
        plain, clashing = (sorted(map(repr, query(t).collect())) for t in (table, with_clashes(table)))
        assert plain == clashing and len(plain) > 20


def test_very_long_texts(spark):
    line = "alpha beta gamma delta epsilon"
    long = "\n".join(f"{line} {k}" for k in range(40_000)) + f"\n{line} 0\n{line} 1\n{line} 2"
    df = spark.createDataFrame([(1, long), (2, f"{long}."), (3, "short text here")], "doc_id long, text string")
    cut = {r.doc_id: r.text for r in line_dedup.line_dedup(df).collect()}
    assert cut[1].count("\n") == 39_999 and cut[3] == "short text here"
    rules = {r.doc_id: r.n_words for r in quality_rules.quality_rules(df).collect()}
    assert rules == {1: 6 * 40_003, 2: 6 * 40_003, 3: 3}
    groups = {r.doc_id: r.component_id for r in simhash.simhash_query(df).collect()}
    assert groups == {1: 1, 2: 1, 3: 3}
    pieces = packing.pack_query(df).where("doc_id = 1").orderBy("start").collect()
    assert sum(p.length for p in pieces) == pieces[0].doc_tokens > 200_000 and pieces[-1].start + pieces[-1].length == pieces[0].doc_tokens


def test_join_of_texts_is_dealt_by_their_bytes(spark, monkeypatch):
    monkeypatch.setattr(repeats, "TASK_BYTES", 400)
    rows = texts(9)
    df = frame(spark, rows).repartition(3)
    parts = -(-sum(len(t.encode()) for _, t in rows) // 400)
    assert parts > 4 and cut_bytes(df) == brute_bytes(rows)
    plan = suffix_dedup.suffix_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert f", {parts}), REPARTITION_BY_NUM" in plan and plan.count("REPARTITION_BY_NUM") >= 2
    assert cut_words(df, size=5) == brute_words(rows, 5)
    assert {r.n_removed for r in substring_dedup.substring_dedup(df).collect()} >= {0}


def test_formatted_conversations_hold_long_texts(spark):
    text = "word </s>" * 200_000
    df = spark.createDataFrame([(1, 0, "user", "q"), (1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    out = chat_format.chat_format_query(df).where("conv_id = 1").first()
    assert out.loss_chars == len(text) and out.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("at_once", [1, 700, 10**6])
def test_anchors_found_some_texts_at_a_time(spark, monkeypatch, at_once):
    monkeypatch.setattr(suffix_dedup, "FIND_AT_ONCE", at_once)
    rows = texts(21)
    assert cut_bytes(frame(spark, rows).repartition(3)) == brute_bytes(rows)

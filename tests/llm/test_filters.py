"""Quality rules, decontamination, URL filters and the classifier: edges, and held-out accuracy."""

import hashlib
import itertools
import time
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from caseweave.llm import decontaminate as dc
from caseweave.llm import quality_classifier as qc
from caseweave.llm import quality_rules as qr
from caseweave.llm import url_filter as uf


def test_rules_on_nulls_long_texts_and_clashing_columns(spark):
    prose = " ".join(f"the cat{i} and dog{i} sat on mat{i}" for i in range(40))
    rows = [(1, prose, 7), (1, prose, 7), (2, None, 7), (3, "", 7), (4, "a b c " * 50, 7), (None, "é " * 20_000, 7), (5, "x\n" * 60, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_words int")
    out = [r.asDict() for r in qr.annotate(df).collect()]
    assert [r["kept"] for r in out] == [True, True, False, False, False, False, False]
    assert out[4]["n_repeat_words"] == out[4]["n_words"] == 150 and out[5]["n_words"] == 20_000 and out[6]["n_dup_lines"] == 59
    assert qr.quality_rules(df.limit(0)).count() == 0


def test_rules_keep_columns_of_any_name(spark):
    df = spark.createDataFrame([(1, "a b c", 5, "x", "y", "z")], "doc_id long, text string, one int, __words string, __source string, kept string")
    out = qr.annotate(df)
    assert out.columns[:5] == ["doc_id", "text", "one", "__words", "__source"] and out.columns.count("kept") == 1
    assert out.first()[:5] == (1, "a b c", 5, "x", "y") and out.first()["kept"] is False


def test_repeated_windows_are_told_apart_by_their_words(spark):
    rows = [(1, "ab c d x abc d e x ab c d"), (2, "a bc d x ab c d x a b cd"), (3, "p q r p q r p q r s")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.n_repeat_words for r in qr.quality_rules(df).orderBy("doc_id").collect()] == [6, 0, 9]


def test_rules_keep_good_documents(spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = qr.quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet")).join(labels, "doc_id").where("not base_failed")
    assert out.where("quality = 1 and not kept").count() == 0
    assert out.where("quality = 0 and not kept").count() > 0


def test_rules_use_no_python(spark, sf_dir):
    plan = qr.quality_rules(spark.read.parquet(f"{sf_dir}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_decontamination_in_parts_and_cut(spark):
    docs = spark.createDataFrame([(1, "a b c d", 1), (2, "x A-b,C d y", 1), (2, None, 2), (None, "a b c d", 1), (4, "", 2), (5, "p q r " * 30, 0)], "doc_id long, text string, n_words int")
    bench = spark.createDataFrame([(10, "a B c D"), (9, "A b"), (9, "A b"), (None, "y"), (3, None), (4, "--")], "item_id long, text string")
    whole = sorted(map(repr, dc.decontaminate(docs, bench, keep=True, with_cut=True).collect()))
    assert whole == sorted(map(repr, dc.decontaminate(docs, bench, keep=True, with_cut=True, broadcast_bytes=70).collect()))
    out = {(r.doc_id, r.text): r for r in dc.decontaminate(docs, bench, keep=True, with_cut=True).collect()}
    assert out[2, "x A-b,C d y"].n_hit == 5 and out[2, "x A-b,C d y"].clean_text == "x " and out[2, "x A-b,C d y"].n_items == 2
    assert out[5, "p q r " * 30].contaminated is False and out[2, None].n_words == 0
    assert dc.decontaminate(docs.limit(0), bench).count() == 0
    assert dc.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0


def test_large_set_of_items_is_held_in_bounded_arrays():
    rng = np.random.default_rng(1)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 50_000, 200)) for _ in range(3500)]
    size = sum(map(len, texts))
    found = dc.NgramSet([str(k) for k in range(len(texts))], pa.array(texts), dc.WINDOW_WORDS)
    assert size > 4_000_000 and found.nbytes < 8 * size
    assert dc.BROADCAST_BYTES * found.nbytes / size < 256_000_000


def test_item_ids_of_any_type_both_ways(spark, sf_dir):
    docs, bench = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "benchmark"))
    named = bench.withColumn("item_id", F.concat(F.lit("item-"), "item_id"))
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id")).unionByName(docs.limit(20).withColumn("doc_id", F.lit(None).cast("string"))).repartition(5)
    whole, shuffled = (sorted(map(repr, dc.decontaminate(docs, named, broadcast_bytes=n).collect())) for n in (10**9, 0))
    assert whole == shuffled and len(whole) == docs.count()
    plain = {f"d{r.doc_id}": (r.n_hit, r.n_items, r.contaminated) for r in dc.decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), bench).collect()}
    assert {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in dc.decontaminate(docs, named).where("doc_id is not null").collect()} == plain


def test_decontamination_of_one_long_text_and_a_hot_window(spark, monkeypatch):
    monkeypatch.setattr(dc.kernel, "CHUNK_BYTES", 2000)
    item = " ".join(f"q{k}" for k in range(13))
    docs = spark.createDataFrame([(k, item) for k in range(200)] + [(1000, "x " * 5000 + item)], "doc_id long, text string").repartition(3)
    bench = spark.createDataFrame([(k, f"{item} z{k}") for k in range(30)], "item_id long, text string")
    for limit in (10**9, 0):
        out = {r.doc_id: r for r in dc.decontaminate(docs, bench, broadcast_bytes=limit).collect()}
        assert all(out[k].n_hit == 13 and out[k].n_items == 30 and out[k].contaminated for k in range(200))
        assert out[1000].n_words == 5013 and out[1000].n_hit == 13 and not out[1000].contaminated


def test_url_parts_and_rules(spark):
    urls = ["HTTP://A.Example.COM/en/7?x", "https://example.com/en/8", "x://example.net/de/81", "x://b.net/de/", "x://netx/de/", None, "no scheme", "://", "x://h?q#f", "x://org/es/1"]
    df = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    out = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in uf.filter_urls(df, labels).collect()}
    assert out[0] == ("a.example.com", "/en/7", "example.com/en/7", "allow") and out[1] == ("example.com", "/en/8", "com/en/", "block")
    assert out[2][2:] == ("example.net/de/8", "block") and out[3][2:] == ("net/de/", "allow") and out[4][2:] == (None, "allow")
    assert out[5] == out[6] == ("", "", None, "allow") and out[8] == ("h", "", None, "allow") and out[9][2:] == ("org/es/", "block")
    assert uf.filter_urls(df.limit(0), labels).count() == 0


def test_mined_rules_block_what_labels_show(spark):
    pages = [(i, f"http://{'spam' if i % 4 == 0 else 'fine'}.host{i % 3}.io/p/{i}") for i in range(200)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(200)] + [(999, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rules = [r.antecedent for r in uf.mined_rules(df, labels).collect()]
    assert rules == [["host=spam"]]
    out = uf.filter_urls(df, labels)
    assert out.where("verdict = 'block'").count() == 50 and out.where("host like 'spam%' and verdict = 'allow'").count() == 0


def test_rules_without_meaning_are_pruned(spark):
    """Labels that URLs say nothing of give no rule, however many combinations there are."""
    rng = np.random.default_rng(4)
    pages = [(i, f"http://h{rng.integers(9)}.host{rng.integers(9)}.io/{rng.choice(list('abcdef'))}/p?k{rng.integers(6)}=1") for i in range(1500)]
    labels = spark.createDataFrame([(i, int(rng.random() > 0.25), 0) for i in range(1500)], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame(pages, "page_id long, url string")
    assert uf.mined_rules(df, labels, min_chi_square=0.0).count() > 0
    assert uf.mined_rules(df, labels).count() == 0 and uf.filter_urls(df, labels).where("verdict = 'block'").count() == 0


def test_hot_host_and_long_url_with_sets_broadcast_or_salted(spark):
    long = "http://spam.x.io/" + "a/" * 20_000
    pages = [(i, "http://spam.x.io/p" if i % 3 == 0 else f"http://fine{i % 40}.y.io/p") for i in range(600)] + [(600, long), (601, None)]
    df = spark.createDataFrame(pages, "page_id long, url string").repartition(5)
    labels = spark.createDataFrame([(i, int(i % 3 != 0), 0) for i in range(600)], "doc_id long, quality int, toxic int")
    whole, salted = (sorted(map(tuple, uf.filter_urls(df, labels, broadcast_bytes=n).collect())) for n in (10**9, 0))
    assert whole == salted and len(whole) == 602
    assert {r[0] for r in whole if r[4] == "block"} == {i for i in range(600) if i % 3 == 0} | {600}


def test_classifier_on_held_out_rows(spark, sf_dir):
    folder = sf_dir.replace("0.001", "0.01")
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    rows = qc.quality_classifier_query(docs, labels).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = ([r.score for r in held if r.quality == q] for q in (1, 0))
    assert sum(a > b for a in good for b in bad) / (len(good) * len(bad)) > 0.97
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.9
    assert all(r.predicted == int(r.score >= 0.7) for r in rows)


def test_classifier_edges(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    assert qc.fit(docs.limit(0), labels).constant == 1.0
    one = qc.fit(docs, labels.where("quality = 1"))
    odd = spark.createDataFrame([(1, "a b", "x"), (1, "a b", "x"), (2, None, "x"), (None, "", "x")], "doc_id long, text string, score string")
    assert [r.score for r in qc.score(odd, one).collect()] == [1.0] * 4
    model = qc.fit(docs, labels)
    out = qc.score(odd, model).collect()
    assert len(out) == 4 and all(0 <= r.score <= 1 for r in out) and out[0].score == out[1].score and out[2].score == out[3].score
    again = qc.fit(docs.repartition(5), labels.repartition(3))
    assert [r.score for r in qc.score(odd, again).collect()] == [r.score for r in out]
    flipped = labels.withColumn("quality", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert [r.score for r in qc.score(odd, qc.fit(docs, flipped)).collect()] == [r.score for r in out]


def test_classifier_is_the_same_for_repeated_rows_in_any_order(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    other = docs.select("doc_id", F.reverse("text").alias("text"))  # a second text for each id
    many = docs.select("doc_id", "text").unionByName(other).crossJoin(spark.range(16)).drop("id")
    models = [qc.fit(many.repartition(n), labels, rows=40) for n in (1, 7, 50)]
    assert models[0].constant is None
    for m in models[1:]:
        assert (m.weights == models[0].weights).all() and (m.bias, m.slope, m.shift) == (models[0].bias, models[0].slope, models[0].shift)


def test_fitting_rows_are_bounded_by_features(spark, sf_dir):
    docs, labels = (spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in ("documents", "labels"))
    whole = {r.place: r.size for r in qc.sample(docs, labels, "text", "doc_id", "quality", 30, 10**9).collect()}
    some = {r.place: r.size for r in qc.sample(docs, labels, "text", "doc_id", "quality", 30, 9000).collect()}
    assert len(whole) == 30 and 0 < len(some) < 30 and sum(some.values()) <= 9000
    assert sorted(some) == sorted(whole)[: len(some)]


def test_dual_coordinate_descent_reaches_the_optimum_of_a_dense_fit():
    rng = np.random.default_rng(3)
    dense = rng.random((60, 64)) < 0.3
    labels = (dense[:, :8].sum(axis=1) + rng.normal(0, 0.7, 60) > 2.4).astype(np.int64)
    counts = dense.sum(axis=1)
    columns = np.concatenate([np.flatnonzero(row) for row in dense]).astype(np.int32)
    model = qc.Model(columns, counts, labels, bits=6)
    smooth = [dense[labels == k].sum(axis=0) + qc.SMOOTHING for k in (0, 1)]
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    x = np.c_[dense * ratio / np.sqrt(np.maximum(1, counts))[:, None], np.ones(60)]
    side = np.where(labels == 1, 1.0, -1.0)

    def loss(w):
        return w @ w / 2 + qc.COST * np.maximum(0, 1 - side * (x @ w)).sum()

    gram, alpha = (x * side[:, None]) @ (x * side[:, None]).T, np.zeros(60)
    for _ in range(20_000):  # projected gradient on the dual
        alpha = np.clip(alpha - (gram @ alpha - 1) / np.linalg.norm(gram, 2), 0, qc.COST)
    best = loss((alpha * side) @ x)
    assert loss(np.r_[model.weights / ratio, model.bias]) < 1.01 * best


def test_a_window_that_very_many_items_share(spark, monkeypatch):
    """Cost goes by distinct windows, not by items times occurrences, and rows of a hot one-word item go to several tasks."""
    line = " ".join(f"q{k}" for k in range(13))
    names, texts = [str(k) for k in range(100_000)], [line] * 100_000
    found = dc.NgramSet(names, pa.array(texts), dc.WINDOW_WORDS)
    assert [len(t[1]) for t in found.tables] == [1]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array([f"{line} x " * 400, "clean"])], ["id", "text"])
    begun = time.perf_counter()
    (out,) = dc._scan(iter([batch]), type("Shared", (), {"value": found}))
    assert time.perf_counter() - begun < 2 and out.column("n_items").to_pylist() == [100_000, 0]
    assert out.column("items_sha256")[0].as_py() == hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
    monkeypatch.setattr(dc, "TASK_HITS", 10)
    docs = spark.createDataFrame([(k, f"the {line} a b" if k % 3 else f"the dog{k}") for k in range(120)], "doc_id long, text string")
    bench = spark.createDataFrame([(k, line) for k in range(50)] + [(50, "the"), (51, f"{line} a"), (None, "dog7")], "item_id long, text string")
    whole, shuffled = (sorted(map(tuple, dc.decontaminate(docs, bench, broadcast_bytes=n).collect())) for n in (10**9, 0))
    assert whole == shuffled and {r[3] for r in whole} == {1, 52} and all(r[5] for r in whole)


def test_colliding_hashes_are_told_apart(monkeypatch):
    monkeypatch.setattr(dc._Roll, "windows", lambda self, sums, n: np.zeros(max(0, len(sums) - n), np.uint64))
    found = dc.NgramSet(["a", "b", "c"], pa.array(["x y", "z w", "x y"]), 13)
    assert [t[3].tolist() for t in found.tables] == [[0, 2, 3]]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["k x y", "z w"])], ["id", "text"])
    (out,) = dc._scan(iter([batch]), type("Shared", (), {"value": found}))
    assert out.column("n_items").to_pylist() == [2, 1] and out.column("span_starts").to_pylist() == [[1], [0]]


def blocked_by_all_subsets(rows, pages, support=uf.MIN_SUPPORT, confidence=uf.MIN_CONFIDENCE, least=uf.MIN_ROWS, chi=uf.MIN_CHI_SQUARE):
    """Pages that some combination of tokens blocks, trying every subset of the labelled rows' tokens."""
    n, n_bad = len(rows), sum(bad for _, bad in rows)
    subsets = {frozenset(s) for tokens, _ in rows for k in range(1, len(tokens) + 1) for s in itertools.combinations(sorted(tokens), k)}
    rules = []
    for s in subsets:
        fits, hits = sum(s <= t for t, _ in rows), sum(bad and s <= t for t, bad in rows)
        enough = hits >= max(support * n, least) and hits >= confidence * fits and hits * n > fits * n_bad
        if enough and (hits * n - fits * n_bad) ** 2 >= chi * fits * n_bad * (n - n_bad):
            rules.append(s)
    return {key for key, tokens in pages.items() if any(s <= tokens for s in rules)}, len(rules)


def test_mined_verdicts_equal_those_of_all_subsets(spark):
    rng = np.random.default_rng(12)
    made = []
    for i in range(900):
        a, b, c = rng.integers(4, size=3)
        deep = "/".join("pqrs"[: rng.integers(5)])  # nested paths
        made.append((i, f"http://h{a}.k{b}.io/{deep}/x{c}" + ("?u=1" if a == b else ""), int(not ((a == 1 and c == 2) or (b == 3 and len(deep) > 4) or rng.random() < 0.15))))
    df = spark.createDataFrame([r[:2] for r in made], "page_id long, url string")
    labels = spark.createDataFrame([(i, q, 0) for i, _, q in made if i % 3], "doc_id long, quality int, toxic int")
    tokens = {r.page_id: frozenset(r.t) for r in df.select("page_id", uf.tokens_of(F.col("url")).alias("t")).collect()}
    rows = [(tokens[i], q == 0) for i, q, _ in labels.collect()]
    for options in ({}, {"min_chi_square": 4.0, "min_confidence": 0.3}):
        names = {"min_chi_square": "chi", "min_confidence": "confidence"}
        expected, n_rules = blocked_by_all_subsets(rows, tokens, **{names[k]: v for k, v in options.items()})
        out = {r.page_id for r in uf.filter_urls(df, labels, (), **options).collect() if r.verdict == "block"}
        assert out == expected and n_rules > 3 and 0 < len(out) < 900
        assert uf.mined_rules(df, labels, **options).count() < n_rules


def test_mining_ends_on_deep_repeated_and_nested_urls(spark):
    name = lambda k: f"{chr(97 + k // 26)}{chr(97 + k % 26)}"  # noqa: E731  (numbers are one token)
    parts = [f"p{name(k)}" for k in range(40)]
    deep = [(i, "http://deep.io/" + "/".join(parts)) for i in range(10)]
    nested = [(100 + 12 * d + i, "http://nest.io/" + "/".join(f"n{name(k)}" for k in range(d + 1))) for d in range(30) for i in range(12)]
    other = [(1000 + i, f"http://o{i % 7}.net/{i % 11}") for i in range(500)]
    df = spark.createDataFrame(deep + nested + other, "page_id long, url string")
    bad = {i for i, _ in deep} | {i for i, u in nested if f"n{name(20)}" in u}
    labels = spark.createDataFrame([(i, int(i not in bad), 0) for i, _ in deep + nested + other], "doc_id long, quality int, toxic int")
    begun = time.perf_counter()
    assert {r.page_id for r in uf.filter_urls(df, labels, (), min_confidence=0.95).collect() if r.verdict == "block"} == bad
    assert time.perf_counter() - begun < 60

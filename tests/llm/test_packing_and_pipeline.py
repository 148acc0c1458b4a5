import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from caseweave.llm import packing


def test_fast_path_equals_the_tokenizer(spark, sf_dir):
    path = packing.tokenizer_path()
    whole, fast = Tokenizer.from_file(path), packing.WordTokens(path)
    rng = random.Random(2)
    odd = ["", " ", "ΑΣ Σ", "e\u0301a\u0301", "İstanbul", "a\x1cb\x85c\u00a0d", "<|endoftext|> x", "don't WON'T 'Re x's1²½", "日本語", "a\u00adb", "ǅ ǆ ß ẞ", "\ufeffx", "👍🏽 ok", "½¼ 12345 --__"]
    odd += ["".join(rng.choice("aBé'1²_- \n\t.!<|ßÿ") for _ in range(60)) for _ in range(200)]
    odd += [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert fast.by_word
    letters = "aBé'1²_- \n\t.!<|ßÿsStTreEvElLmMdD''"
    for _ in range(20):
        some = letters + "".join(chr(rng.randint(9, 0x24F)) for _ in range(20))
        odd += ["".join(rng.choice(some) for _ in range(rng.randint(0, 50))) for _ in range(50)]
    ids, edges = fast.batch(pa.array(odd))
    assert len(edges) == len(odd) + 1
    for k, text in enumerate(odd):
        assert ids[edges[k] : edges[k + 1]].tolist() == [*whole.encode(text, add_special_tokens=False).ids, 1], text[:80]


def test_words_come_back_after_the_memory_is_full(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_WORDS", 7)
    path = packing.tokenizer_path()
    whole, fast = Tokenizer.from_file(path), packing.WordTokens(path)
    texts = [" ".join(f"word{k * j}" for j in range(9)) for k in range(30)]
    for _ in range(2):
        ids, edges = fast.batch(pa.array(texts))
        assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:], strict=True)] == [[*whole.encode(t).ids, 1] for t in texts]
    assert len(fast) <= 7 and len(fast.older) <= 7


@pytest.mark.parametrize("seed", range(4))
def test_patterns_place_every_piece_once(seed):
    rng = random.Random(seed)
    histogram = {rng.randint(1, 2048): rng.randint(1, 500) for _ in range(rng.choice([1, 5, 300]))}
    patterns = packing.shortest_pack_first(histogram)
    used = collections.Counter()
    for pattern, count in patterns:
        assert 0 < sum(length * times for length, times in pattern) <= 2048 and count > 0
        for length, times in pattern:
            used[length] += times * count
    assert used == histogram
    ends = collections.Counter()
    for length, first, end, *_ in packing.places(patterns):
        assert first == ends[length]
        ends[length] = end
    assert ends == histogram


def check_pieces(rows, expected):
    """Pieces tile their documents and fill their sequences without gaps."""
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for doc_id, ids in expected.items():
        at = 0
        for r in sorted(by_doc[doc_id], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    return sum(r.length for r in rows) / (2048 * len(by_sequence))


def test_pack_round_trip(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    whole = Tokenizer.from_file(packing.tokenizer_path())
    expected = {r.doc_id: [*whole.encode(r.text or "", add_special_tokens=False).ids, 1] for r in docs.collect()}
    rows = packing.pack(docs).collect()
    assert set(expected) == {r.doc_id for r in rows}
    assert check_pieces(rows, expected) > 0.97


def test_pack_edges(spark):
    rows = [(1, "a b c", 5), (2, None, 5), (2, None, 5), (None, "x", 5), (3, "", 5), (4, "zu " * 5000, 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int")
    out = packing.pack(df, with_ids=True).collect()
    assert sorted(r.doc_tokens for r in out if r.start == 0) == [1, 1, 1, 2, 4, 5001]
    assert all(len(r.ids) == r.length for r in out) and sum(r.length for r in out) == 5010
    assert len({(r.sequence_id, r.offset) for r in out}) == len(out)
    assert packing.pack(df.limit(0)).count() == 0


@pytest.mark.parametrize("rank_rows", [3, 500_000])
def test_hot_lengths_are_numbered_in_salts(spark, rank_rows):
    """A third of the pieces has one length, another third is full; every salt count gives gapless sequences."""
    rows = [(k, "zu " * 9) for k in range(200)] + [(1000 + k, "zu " * 4095) for k in range(40)] + [(2000 + k, "zu " * k) for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    whole = Tokenizer.from_file(packing.tokenizer_path())
    out = packing.pack(df, rank_rows=rank_rows).collect()
    assert check_pieces(out, {k: [*whole.encode(t).ids, 1] for k, t in rows}) > 0.97


def test_pipeline_stages_against_their_own_inputs(spark, sf_dir):
    """Each stage on what the one before kept: columns, decisions, and nothing else changed."""
    from tests.llm.test_dedup import brute_print, brute_roots

    folder = sf_dir.replace("0.001", "0.01")
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, frames = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], folder).cache())
    start, good, cut, single, clean, packed = ({r.doc_id: r for r in f.collect()} for f in frames)
    assert all(f.columns == columns for f in frames[:-1])
    assert set(good) < set(start) and all(good[k] == start[k] for k in good)
    quality = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    kept = [k in good for k, q in quality.items() if q == 1]
    gone = [k not in good for k, q in quality.items() if q == 0]
    assert sum(kept) / len(kept) > 0.95 and sum(gone) / len(gone) > 0.8
    seen, lines = {}, {k: v.text.split("\n") for k, v in sorted(good.items())}
    for k, own in lines.items():  # windows in order of document and line
        for i in range(len(own) - 2):
            if "".join(own[i : i + 3]).strip(" \t\n\x0b\x0c\r"):
                seen.setdefault(tuple(own[i : i + 3]), (k, i))
    for k, own in lines.items():
        removed = {i + j for i in range(len(own) - 2) if seen.get(tuple(own[i : i + 3]), (k, i)) < (k, i) for j in range(3)}
        assert cut[k].text == "\n".join(x for i, x in enumerate(own) if i not in removed) and cut[k].n_chars == len(cut[k].text)
    order = sorted(cut)
    roots = brute_roots([brute_print(cut[k].text) for k in order])
    assert sorted(single) == sorted({order[r] for r in roots})
    assert set(clean) < set(single)
    whole = Tokenizer.from_file(packing.tokenizer_path())
    expected = {k: [*whole.encode(r.text, add_special_tokens=False).ids, 1] for k, r in clean.items()}
    rows = corpus_pipeline.STAGES[-1][1](spark, frames[-2], folder).collect()
    assert set(packed) == set(clean) and check_pieces(rows, expected) > 0.97


def test_pipeline_is_registered():
    import __spark_entry__ as entry

    assert entry.queries()["pipeline"] is corpus_pipeline.run and "pipeline" not in entry.oracle_sql()
    assert [name for name in entry.queries() if name.startswith("op")] and len([n for n in entry.queries() if n.startswith("op")]) == 13


def test_decontaminate_stage_keeps_what_plain_python_keeps(spark, sf_dir):
    def words(text):
        return re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())

    items = [words(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    grams = {tuple(w[i : i + min(13, len(w))]) for w in items if w for i in range(len(w) - min(13, len(w)) + 1)}
    sizes = {len(g) for g in grams}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    expected = set()
    for r in docs.collect():
        own = words(r.text)
        hit = {i + j for n in sizes for i in range(len(own) - n + 1) if tuple(own[i : i + n]) in grams for j in range(n)}
        if not hit or 20 * len(hit) < len(own):
            expected.add(r.doc_id)
    stage = dict(corpus_pipeline.STAGES)["decontaminate"]
    assert {r.doc_id for r in stage(spark, docs, sf_dir).collect()} == expected
    assert 0 < len(expected) < docs.count()


def test_pipeline_rereads_each_stage_from_parquet(spark, sf_dir, monkeypatch):
    seen = []

    def stage(spark, docs, _):
        seen.append((docs.inputFiles(), docs.columns))
        return docs.where("doc_id % 7 <> 0")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("one", stage), ("two", stage), ("three", stage)])
    out = corpus_pipeline.run(spark, sf_dir)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert out.columns == docs.columns and out.count() == docs.where("doc_id % 7 <> 0").count()
    assert all(files and columns == docs.columns for files, columns in seen)
    assert len({files[0].rsplit("/", 1)[0] for files, _ in seen}) == 3


CLASHING = ("id", "score", "predicted", "n_words", "n_lines", "__id", "__lines", "__column_0", "fp", "length", "kept")


def odd_documents(spark, sf_dir):
    """Nulls in every column, empty and very long texts, repeated rows, ties, and columns with the operators' names."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.limit(30).collect()}
    rows = [(k, v, "en", "src0", len(v)) for k, v in texts.items()] * 2
    rows += [(None, next(iter(texts.values())), None, None, None), (900_001, None, "en", "x", 0), (900_001, None, "en", "x", 0), (900_002, "", None, None, None)]
    rows += [(900_003, "the long text of one word after another \n" * 9000, "en", "x", 1), (None, None, None, None, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    return frame.select("*", *(F.lit(f"own {c}").alias(c) for c in CLASHING)), rows


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_on_odd_documents(spark, sf_dir, name):
    docs, rows = odd_documents(spark, sf_dir)
    stage = dict(corpus_pipeline.STAGES)[name]
    assert stage(spark, docs.limit(0), sf_dir).count() == 0
    out = stage(spark, docs, sf_dir)
    found = collections.Counter((r.doc_id, r.text) if "text" in out.columns else r.doc_id for r in out.collect())
    given = collections.Counter((r[0], r[1]) for r in rows)
    if name == "pack":
        assert set(found) == {r[0] for r in rows} and found[900_001] == 2 and found[900_003] > 1
        return
    assert out.columns == docs.columns and all(r[c] == f"own {c}" for r in out.collect() for c in CLASHING)
    if name == "line_dedup":
        assert sum(found.values()) == len(rows) and found[900_001, None] == 2 and found[None, None] == 1 and found[900_002, ""] == 1
    else:
        assert all(found[k] == given[k] for k in found)
    if name == "simhash_dedup":
        assert (900_001, None) in found and (900_002, "") not in found and (None, None) in found
    if name == "decontaminate":
        assert (900_001, None) in found and (900_002, "") in found and (None, None) in found

"""Token counts against the library, text by text."""

import random

import numpy as np
import pyarrow as pa
import pytest

from caseweave.llm import token_counts as tc

ODD_TEXTS = [
    "", " ", "  ", "a", "it's  we've they'll I'd 'quote' ''s x'st 're'", "a\n\nb \n c\t\td  ", " 'll x", "don't've", "tab\there nbsp  em",
    "<|endoftext|> a <|endoftext|>", "a<|b", "nul\0byte", "日本語 テキスト です", "emoji 😀 👍🏽 x", "é à  ñ’s naïve", "x" * 5000, "12345 67 ½ ²", "᠎\u0085\x1c a",
    "a   b", "  b", " \n", "ends with space ", "O'S 'S 'T", "1'm 2'd", "\U00020000 ext", "mixed　wide  　x", "a  'll", "'", "''", "x'", "s's\n's",
]


def library(texts, path):
    from tokenizers import Tokenizer

    made = Tokenizer.from_file(path)
    return [len(made.encode(x or "", add_special_tokens=False).ids) for x in texts]


def test_counts_equal_the_library_on_odd_texts():
    path, generator = tc.tokenizer_path(), random.Random(3)
    letters = list("ab sS tT'mdrevl \n\t 1.,!<|é ’世") + ["'s", "'re", "  "]
    texts = ODD_TEXTS + ["".join(generator.choices(letters, k=generator.randrange(40))) for _ in range(3000)]
    size, tokens = tc.ByteCounter(path).batch(pa.array(texts))
    assert tokens.tolist() == library(texts, path)
    assert size.tolist() == [len(x.encode()) for x in texts]


def test_counts_do_not_depend_on_the_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    rows = docs.collect()
    expected = {r.doc_id: n for r, n in zip(rows, library([r.text for r in rows], tc.tokenizer_path()), strict=True)}
    for slots in (256, tc.SLOTS):
        out = tc.count_tokens(docs.repartition(5), slots=slots).collect()
        assert {r.doc_id: r.n_tokens for r in out} == expected
        assert all(r.over_limit == (r.n_tokens > 1024) and r.n_bytes == len((r.text or "").encode()) for r in out)


def test_frequent_tokens_win_their_slots():
    tally, rng = tc.Tally(256), np.random.default_rng(1)
    common = np.arange(1, 9, dtype=np.uint64) * np.uint64(7919)
    for _ in range(20):
        rare = rng.integers(1, 2**60, 3000, dtype=np.uint64)
        values = rng.permutation(np.r_[np.repeat(common, 400), rare])
        tally.add(values, np.zeros_like(values))
    assert set(common.tolist()) <= set(tally.lo[tally.held()].tolist())
    merged = tc.Tally(256)
    held = tally.held()
    for _ in range(3):
        merged.add(tally.lo[held], tally.hi[held], tally.votes[held], held)
    assert set(common.tolist()) <= set(merged.lo.tolist()) and merged.votes.max() == 3 * tally.votes.max()


def test_rows_of_any_kind(spark):
    rows = [(1, None, "x", 9), (1, None, "x", 9), (None, "", "y", 9), (2, "a b c", None, 9), (3, "word " * 300_000, "z", 9), (3, "word", "z", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, `odd.name` string, n_tokens int")
    out = tc.count_tokens(df)
    assert out.columns == ["doc_id", "text", "odd.name", "n_bytes", "n_tokens", "over_limit"]
    found = [(r.doc_id, r["odd.name"], r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect()]
    assert sorted(found, key=repr) == sorted(
        [(1, "x", 0, 0, False), (1, "x", 0, 0, False), (None, "y", 0, 0, False), (2, None, 5, 3, False), (3, "z", 1_500_000, 300_001, True), (3, "z", 4, 1, False)], key=repr
    )
    assert tc.token_counts_query(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_tokenizers_of_another_make(spark, name):
    path, texts = tc.tokenizer_path(name), ["The cat's  hat.", "", "été\n\nx", None]
    out = tc.count_tokens(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string"), tokenizer=path, limit=3)
    if name.endswith(".json"):
        expected = library(texts, path)
    else:
        import sentencepiece

        expected = [len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t or "")) for t in texts]
    assert [(r.n_tokens, r.over_limit) for r in out.orderBy("doc_id").collect()] == [(n, n > 3) for n in expected]

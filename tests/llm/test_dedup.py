"""Line, substring and suffix dedup and SimHash against brute force, with nulls, ties, repeats and empty tables."""

import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from caseweave.llm import line_dedup, simhash, substring_dedup, suffix_dedup

WORDS = " ".join(f"w{i}" for i in range(60))
SCHEMA = "doc_id long, text string, n_removed string, id string"
ROWS = [(1, WORDS), (2, f"x y {WORDS} z"), (2, WORDS), (2, WORDS), (None, WORDS), (3, None), (4, ""), (5, "a " * 200), (None, None), (6, "a " * 50)]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(*r, "old", "other") for r in rows], SCHEMA)


def texts(seed, n=40):
    """Small alphabets and copied passages: many repeats of every length, cut at every place."""
    rng = random.Random(seed)
    base = ["".join(rng.choice("ab é") for _ in range(rng.randint(0, 300))) for _ in range(6)]
    out = []
    for k in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            b = rng.choice(base)
            i = rng.randint(0, len(b))
            parts.append(b[i : i + rng.randint(0, 160)] if rng.random() < 0.7 else "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))))
        out.append((k // 2 if k % 7 == 0 else k, "".join(parts)))
    return out


def brute_bytes(rows):
    first = {}
    for d, t in rows:
        b = t.encode()
        for i in range(len(b) - 49):
            first[b[i : i + 50]] = min(d, first.get(b[i : i + 50], d))
    expected = []
    for d, t in rows:
        b = t.encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] < d:
                gone[i : i + 50] = True
        expected.append((d, len(b), int(gone.sum()), int((gone[1:] > gone[:-1]).sum() + gone[0]), bytes(x for x, g in zip(b, gone, strict=False) if not g)))
    return sorted(expected)


def cut_bytes(df, **how):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.suffix_dedup(df, **how).collect())


@pytest.mark.parametrize(("seed", "pieces"), [(0, 10**6), (1, 10**6), (2, 40), (3, 3)])
def test_suffix_dedup_equals_brute_force(spark, seed, pieces):
    """Also with buckets so small that most grams are split by their strings."""
    rows = texts(seed)
    assert cut_bytes(frame(spark, rows).repartition(3), pieces=pieces) == brute_bytes(rows)


def test_no_hash_decides_a_removal(spark, monkeypatch):
    """With gram hashes of 6 bits nearly all anchors meet others: the sort alone has to tell them apart."""
    mixed = suffix_dedup.kernel.mixed

    def few_bits(x):
        return (mixed(x) >> np.uint64(58)) * np.uint64(0x0040_1004_0100_4011)

    rows = texts(5)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array(range(len(rows))), pa.array([r[1] for r in rows])], ["id", "text_hash", "text"])
    monkeypatch.setattr(suffix_dedup.kernel, "mixed", few_bits)
    buckets = suffix_dedup.repeats.Buckets(np.ones(suffix_dedup.repeats.CELLS, np.int64), 4000)
    def each(table, find):
        keys = sorted(set(table.column("bucket").to_pylist()))
        return pa.concat_tables([find(k, table.filter(pa.compute.equal(table.column("bucket"), k))) for k in keys])

    def column(table, name):
        by_row = dict(zip(table.column("text_hash").to_pylist(), table.column(name).to_pylist(), strict=True))
        return pa.array([by_row.get(k) for k in range(len(rows))], pa.binary())

    repeats = suffix_dedup.repeats
    packed = pa.Table.from_batches(suffix_dedup._pack(iter([batch]), buckets))
    found = each(each(packed, lambda k, t: repeats.shared(k, t, 5)), lambda k, t: repeats.hashes_of_rows(t))
    asked = batch.append_column("hashes", column(found, "hashes"))
    contexts = pa.Table.from_batches(suffix_dedup._fetch(iter([asked]), buckets))
    spans = each(each(contexts, lambda k, t: suffix_dedup._sort(k, t, 5)), lambda k, t: repeats.spans_of_rows(t))
    lists = [column(spans, c) for c in ("starts", "lengths")]
    out = next(suffix_dedup._cut(iter([pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *lists], ["id", "text", "starts", "lengths"])])))
    assert sorted(map(tuple, zip(*(c.to_pylist() for c in out.columns), strict=True))) == brute_bytes(rows)


def test_hot_gram_with_many_contexts_and_one_long_text(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SORT_AT_ONCE", 500)
    rng = random.Random(8)
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    edges = [word(40) for _ in range(12)]
    rows = [(k, f"{rng.choice(edges)}as is well known to all of us here{rng.choice(edges)}") for k in range(300)]
    rows += [(1000 + k, "".join(f"{i % 700}-" for i in range(9000 + k))) for k in range(2)]
    for pieces in (200, 10**6):
        assert cut_bytes(frame(spark, rows).repartition(5), pieces=pieces) == brute_bytes(rows)


def test_a_bucket_of_many_contexts_holds_a_part_of_them_at_a_time(monkeypatch):
    """Tables that a bucket needs beside its contexts' bytes belong to some grams; parts and steps don't change the hits."""
    repeats, rng = suffix_dedup.repeats, np.random.default_rng(6)
    lines = ["".join(map(chr, rng.integers(97, 123, 400))) for _ in range(900)]
    texts = ["".join(lines[i] for i in rng.integers(0, len(lines), 10)) for _ in range(500)] + ["".join(map(chr, rng.integers(97, 100, 60))) + "as is well known to all of us" * 2 for _ in range(300)]
    ids = np.arange(len(texts), dtype=np.int64)
    batch = pa.RecordBatch.from_arrays([pa.array(ids), pa.array(ids), pa.array(texts)], ["id", "text_hash", "text"])
    buckets = repeats.Buckets(np.ones(repeats.CELLS, np.int64), 10**6)
    packed = pa.Table.from_batches(suffix_dedup._pack(iter([batch]), buckets))
    shared = pa.concat_tables([repeats.shared(k, packed.filter(pa.compute.equal(packed["bucket"], k)), 1) for k in pa.compute.unique(packed["bucket"]).to_pylist()])
    named = {r["id"]: r["hashes"] for r in repeats.hashes_of_rows(shared).to_pylist()}
    asked = batch.append_column("hashes", pa.array([named.get(i) for i in ids.tolist()], pa.binary()))
    contexts = pa.Table.from_batches([b for some in range(0, len(ids), 20) for b in suffix_dedup._fetch(iter([asked.slice(some, 20)]), buckets)])
    contexts = contexts.filter(pa.compute.equal(contexts["bucket"], 0))
    monkeypatch.setattr(suffix_dedup, "SORT_AT_ONCE", 5000)
    hits, size = [], len(contexts.column("starts").combine_chunks().flatten())
    assert size > 100_000
    for contexts_at_once, strings_at_once in ((10**9, 10**9), (4000, 20_000), (50, 1)):
        monkeypatch.setattr(suffix_dedup, "CONTEXTS_AT_ONCE", contexts_at_once, raising=False)
        monkeypatch.setattr(suffix_dedup, "STRINGS_AT_ONCE", strings_at_once, raising=False)
        if contexts_at_once == 50:
            contexts = contexts.slice(0, 2)
        tracemalloc.start()
        out = suffix_dedup._sort(0, contexts, 1)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        hits.append(out.to_pylist())
        if contexts_at_once == 4000:
            assert peak < 400 * size
    monkeypatch.setattr(suffix_dedup, "CONTEXTS_AT_ONCE", 10**9)
    assert hits[0] == hits[1] and hits[0][0]["ids"] and hits[2] == suffix_dedup._sort(0, contexts, 1).to_pylist()


def test_blind_trie_and_quicksort():
    rng = random.Random(5)
    strings = ["".join(rng.choice("ab") for _ in range(10)).encode() for _ in range(300)]
    leaves = suffix_dedup.BlindTrie(strings).leaves()
    assert [strings[x[0]] for x in leaves] == sorted(set(strings)) and sum(map(len, leaves)) == 300
    assert all(len({strings[i] for i in leaf}) == 1 for leaf in leaves)
    rows = np.array([list(("x" * 38 + s.decode()).ljust(50, "y").encode()) for s in strings], np.uint8)
    group = np.arange(300, dtype=np.uint64) % np.uint64(3)
    classes = suffix_dedup.deep_shallow(rows, group)
    assert len({(c, g, s) for c, g, s in zip(classes, group, strings, strict=True)}) == len(set(classes)) == len(set(zip(group, strings, strict=True)))


def brute_words(rows, size):
    first, expected = {}, []
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t)) for d, t in rows]
    for d, w in split:
        for i in range(len(w) - size + 1):
            first[tuple(w[i : i + size])] = min(d, first.get(tuple(w[i : i + size]), d))
    for d, w in split:
        gone = set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i : i + size])] < d:
                gone |= set(range(i, i + size))
        expected.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(expected)


def cut_words(df, **how):
    return sorted((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring_dedup.substring_dedup(df, **how).collect())


@pytest.mark.parametrize(("size", "bits", "pieces"), [(3, 64, 2_000_000), (50, 64, 100), (3, 8, 2_000_000), (50, 8, 100), (3, 1, 50)])
def test_substring_dedup_equals_brute_force(spark, size, bits, pieces):
    """Also with hashes of 8 bits and of one bit, so that nearly all windows meet others, and with small buckets."""
    rows = [(d, " ".join(t)) for d, t in texts(9)]
    assert cut_words(frame(spark, rows).repartition(3), size=size, bits=bits, pieces=pieces) == brute_words(rows, size)


def test_words_whose_hashes_collide_are_kept(spark):
    """Polynomial hashes modulo 2**64 of a Thue-Morse word and of its complement are equal for every odd base."""
    morse = "".join("ab"[k.bit_count() % 2] for k in range(1024))
    other, lead = morse.translate(str.maketrans("ab", "ba")), " ".join(f"w{k}" for k in range(49))
    rows = [(1, f"{lead} {morse}"), (2, f"{lead} {other}"), (3, f"{lead} {morse}"), (4, f"{lead} {other} {lead} {morse}")]
    for parts in (1, 4):
        assert cut_words(frame(spark, rows).repartition(parts)) == brute_words(rows, 50)
    assert [r[2] for r in brute_words(rows, 50)] == [0, 0, 50, 100]


def test_edges_of_substring_and_suffix_dedup(spark):
    words = sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in substring_dedup.substring_dedup(frame(spark)).collect())
    assert words == [(-1, 0, 0), (-1, 60, 0), (1, 60, 0), (2, 60, 60), (2, 60, 60), (2, 63, 60), (3, 0, 0), (4, 0, 0), (5, 200, 0), (6, 50, 50)]
    sizes = sorted((r.doc_id or -1, r.n_bytes, r.n_removed) for r in suffix_dedup.suffix_dedup(frame(spark)).collect())
    n = len(WORDS)
    assert sizes == [(-1, 0, 0), (-1, n, 0), (1, n, 0), (2, n, n), (2, n, n), (2, n + 6, n), (3, 0, 0), (4, 0, 0), (5, 400, 0), (6, 100, 100)]
    empty = frame(spark).limit(0)
    assert substring_dedup.substring_dedup(empty).count() == suffix_dedup.suffix_dedup(empty).count() == 0


def test_hot_passage_over_many_rows(spark):
    rows = [(k, f"{WORDS} tail{k} " + " ".join(f"u{k}_{i}" for i in range(20))) for k in range(400)]
    out = substring_dedup.substring_dedup(frame(spark, rows).repartition(7)).collect()
    assert {r.doc_id: r.n_removed for r in out} == {k: 60 if k else 0 for k in range(400)}


def test_hot_run_amid_other_words_and_one_long_text(spark, monkeypatch):
    """A run of words that all texts share with different words around it, and a text longer than a batch."""
    monkeypatch.setattr(substring_dedup, "AT_ONCE", 3000)
    rows = [(k, " ".join([*(f"a{k % 90}_{i}" for i in range(47)), "as is well known", *(f"b{k % 70}_{i}" for i in range(47))])) for k in range(300)]
    rows += [(1000 + k, " ".join(f"c{i % 700}" for i in range(5000 + k))) for k in range(2)]
    assert cut_words(frame(spark, rows).repartition(5), pieces=300) == brute_words(rows, 50)


def test_rows_of_one_id_and_ids_of_other_types(spark):
    rows = [(7, f"{WORDS} {k % 20}") for k in range(60)] + [(8, WORDS)]
    assert cut_words(frame(spark, rows).repartition(4)) == brute_words(rows, 50)
    with pytest.raises(TypeError, match="whole numbers"):
        substring_dedup.substring_dedup(frame(spark).withColumn("doc_id", F.lit("d0")))


def test_line_dedup_edges(spark):
    rows = [(1, "a\nb\nc\nd"), (2, "a\nb\nc"), (2, "a\nb\nc"), (None, "a\nb\nc"), (3, None), (4, ""), (5, "x\nx\nx\nx\nx"), (6, "\n\n\n\n"), (None, None)]
    out = line_dedup.line_dedup(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "id", "n_lines", "n_removed"]
    assert sorted((r.doc_id or -1, r.text, r.n_removed) for r in out.collect() if r.text is not None) == [
        (-1, "a\nb\nc", 0), (1, "a\nb\nc\nd", 0), (2, "", 3), (2, "", 3), (4, "", 0), (5, "x", 4), (6, "\n\n\n\n", 0),
    ]
    assert out.where("text is null").count() == 2
    assert line_dedup.line_dedup(frame(spark).limit(0)).count() == 0


def test_line_dedup_with_clashing_names_a_hot_line_and_a_long_text(spark):
    long = "\n".join(f"line {k % 9000}" for k in range(20_000))
    rows = [(k, f"own {k}\nhot 1\nhot 2\nhot 3\nend {k}", "l", "h", "i") for k in range(300)] + [(1000, long, "l", "h", "i")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __lines string, __hash string, __id string").repartition(5)
    out = {r.doc_id: r for r in line_dedup.line_dedup(df).collect()}
    assert out[0].n_removed == 0 and all(out[k].text == f"own {k}\nend {k}" for k in range(1, 300))
    assert out[1000].n_lines == 20_000 and out[1000].text == "\n".join(f"line {k}" for k in range(9000))
    assert (out[5]["__lines"], out[5]["__hash"], out[5]["__id"]) == ("l", "h", "i")


def brute_print(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] if len(w) >= 4 else [" ".join(w)] * bool(w)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_roots(prints):
    prints = np.array(prints, np.uint64)
    near, label = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 4, np.arange(len(prints))
    while True:
        new = np.array([label[near[i]].min() for i in range(len(prints))])
        if (new == label).all():
            return label
        label = new


def test_simhash_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash(docs).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    prints = [brute_print(t) for _, t in rows]
    roots = brute_roots(prints)
    assert got == {d: (f"{p:016x}", rows[root][0]) for (d, _), p, root in zip(rows, prints, roots, strict=True)}


@pytest.mark.parametrize("node_size", [10**6, 150, 12])
def test_links_of_dense_families(spark, node_size):
    rng = np.random.default_rng(1)
    bit = lambda shape: np.uint64(1) << rng.integers(0, 64, shape).astype(np.uint64)
    base = rng.integers(0, 2**63, 30, dtype=np.uint64)
    prints = np.unique(np.r_[(base[:, None] ^ bit((30, 20)) ^ bit((30, 20))).ravel(), base[0] ^ rng.integers(0, 2**12, 900, dtype=np.uint64)])
    df = spark.createDataFrame([(int(x),) for x in prints.view(np.int64)], "fp long")
    root = {r.fp: r.root for r in simhash.components(simhash.near_links(df, node_size)).collect()}
    got = [root.get(int(x), int(x)) for x in prints.view(np.int64)]
    expected = brute_roots(prints)
    assert len(set(zip(got, expected, strict=True))) == len(set(got)) == len(set(expected))


def test_masks_that_deal_fingerprints_are_apart():
    for used in (0, 0xFFF, 2**52 - 1):
        masks = simhash.deal_masks(used, 12)
        assert len(masks) == 5 and sum(m.bit_count() for m in masks) == sum(masks).bit_count() and not sum(masks) & used


def test_gray_index_prunes_and_links(spark, sf_dir):
    """On the documents of the largest tables: most pairs of groups are pruned above the leaves, links come from the index."""
    docs = spark.read.parquet(f"{sf_dir.replace('0.001', '0.1')}/documents.parquet")
    found = docs.select(F.lit(0).alias("id"), "text").mapInArrow(simhash._fingerprints, "id int, fp long").select("fp").distinct()
    prints = found.toArrow().column("fp").to_numpy().view(np.uint64)
    prints = prints[np.argsort(simhash.gray_rank(prints))]
    levels, counts = simhash.gray_tree(prints), {}
    for level, (mask, pattern) in enumerate(levels):
        owner = np.arange(len(prints)) >> level
        assert not ((prints ^ pattern[owner]) & mask[owner]).any()
    root = simhash.link_node(prints, counts)
    pairs = len(prints) * (len(prints) - 1) // 2
    assert counts["linked"] > 0 and counts["pruned"] > 0 and counts["seen"] < pairs
    near = [(i, j) for i in range(0, len(prints), 50) for j in np.flatnonzero(np.bitwise_count(prints ^ prints[i]) <= 4)]
    assert all(root[i] == root[j] for i, j in near)


def test_chain_of_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90)], "a long, b long")
    roots = {r.fp: r.root for r in simhash.components(links).collect()}
    assert roots == {i: 0 for i in range(41)} | {90: 90, 100: 90}


def test_simhash_edges(spark):
    rows = [(1, "a b c d e"), (2, None), (2, None), (None, "A b c  d e"), (3, ""), (None, "zz")]
    out = sorted((r.doc_id or -1, r.component_id or -1) for r in simhash.simhash(frame(spark, rows)).collect())
    assert out == [(-1, -1), (-1, 1), (1, 1), (2, 2), (2, 2), (3, 2)]
    kept = sorted(r.doc_id or -1 for r in simhash.one_of_each(frame(spark, rows)).collect())
    assert kept == [-1, -1, 1, 2, 2]
    assert simhash.simhash(frame(spark).limit(0)).count() == 0


def test_one_of_each_decides_by_row(spark):
    """An id with several texts loses only those that a smaller id has; other rows of the id stay."""
    rows = [(1, "a b c d e"), (5, "A b c  d e"), (5, "q r s t u v w"), (7, "a b c d e"), (None, "a b c d e"), (None, None)]
    kept = [(r.doc_id, r.text) for r in simhash.one_of_each(frame(spark, rows)).collect()]
    assert sorted(kept, key=repr) == sorted([rows[0], rows[2], rows[4], rows[5]], key=repr)
    assert simhash.one_of_each(frame(spark, rows)).columns == frame(spark, rows).columns

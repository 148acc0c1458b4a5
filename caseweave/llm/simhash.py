"""SimHash near-dedup over a Gray-order hierarchical index.

A text is lower-cased (A-Z only) and cut into words ``[^\\x20\\x09-\\x0D]+``; its shingles are every four consecutive
words, repeats included, joined by one space (fewer words: the whole sequence).  A fingerprint bit is set if it is set
in over half of the shingles' XXH64 values (seed 42); a text without words has fingerprint zero.  Fingerprints link at
four or fewer differing bits; linked documents, directly or by way of others, form a component.

1. Equal fingerprints collapse to one row with their smallest id (partial aggregation: a hot text costs a row a task).
2. Index.  Fingerprints are sorted by Gray rank, in which neighbours share many bits.  Two neighbours make a parent node
   that holds the masked bit pattern they share, two such nodes the next, up to a root.  Pairs of nodes are followed from
   the root: each pair carries the differences of the patterns so far, and at each level only bits that are newly shared
   are compared and added.  Beyond four differences the whole pair of groups is pruned; if no members can come to more,
   the whole pair is linked by one star.  No list of pairs is made: an index hands on at most one link for each member,
   a spanning forest.
3. An index holds some thousand fingerprints.  If there are more, each goes to five indexes by bits under five masks
   without common bits: two fingerprints that differ in at most four bits meet in one of them.  The masks are as wide as
   the count asks for; an index that is still too large (near copies by the thousand) is dealt out again by other bits.
4. Components over links by rounds of large-star and small-star contraction with ``min`` (partial aggregation), the
   lineage cut at each round.

Defined results: null and empty texts have fingerprint zero and are linked like any other; repeated rows each get their
result; rows with a null id get the component of the others, and a component of null ids only has a null id; texts are
taken whole, however long; an empty table gives no rows; the query looks at no other columns, whatever their names, and
``one_of_each`` passes them on.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseweave.llm import _bytes as kernel
from caseweave.llm._spark import checkpointed

SHINGLE_WORDS = 4
MAX_BITS = 4
#: Fingerprints that one Gray-order index holds, about; one of more than ``SPLIT`` times as many is dealt out again.
NODE = 2048
SPLIT = 4
#: Bits of a mask by which fingerprints are dealt to nodes, at most, and bits that bound a node when no more are unused.
WIDEST = 12
LAST_BITS = 16
#: Fingerprints of the nodes that one call works on, about.
BUCKET = 50_000
PAIRS_AT_ONCE = 200_000
ALL = np.uint64(2**64 - 1)
U = np.uint64
I64 = pa.int64()


def fingerprint(text: bytes) -> int:
    """Fingerprint of one text."""
    words = text.translate(kernel.LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n, digest = len(words) - SHINGLE_WORDS + 1, xxhash.xxh64_intdigest
    spans = zip((ends - sizes)[:n].tolist(), ends[SHINGLE_WORDS - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(line[a:b], 42) for a, b in spans), U, n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65_536):
        part = np.unpackbits(hashes[k : k + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += part.sum(axis=0, dtype=np.int64)
    return sum(1 << int(b) for b in np.flatnonzero(2 * ones > n))


def _fingerprints(batches):
    for batch in batches:
        column = batch.column(batch.num_columns - 1).cast(pa.large_binary())
        prints = np.fromiter((fingerprint(x.as_py() or b"") for x in column), U, batch.num_rows)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(prints.view(np.int64), I64)], [*batch.schema.names[:-1], "fp"])


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each 64-bit pattern in Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U(shift))
    return x


class Forest:
    """Union-find over 0..n-1 with smallest roots, in whole arrays of links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            self.flatten()
            a, b = self.root[a], self.root[b]
            apart = a != b
            a, b = a[apart], b[apart]
            np.minimum.at(self.root, np.maximum(a, b), np.minimum(a, b))

    def flatten(self) -> None:
        while True:
            up = self.root[self.root]
            if (up == self.root).all():
                return
            self.root = up


def gray_tree(prints: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Levels of an index over fingerprints in Gray order: for each node the bits its members share, as mask and pattern.

    The lowest level is the fingerprints.  Two neighbours of a level make a parent, which takes over the bits in which
    their patterns agree; the last level is the root.
    """
    levels = [(np.full(len(prints), ALL, U), prints)]
    while len(levels[-1][0]) > 1:
        mask, pattern = levels[-1]
        left, right = np.arange(0, len(mask), 2), np.minimum(np.arange(1, len(mask) + 1, 2), len(mask) - 1)
        shared = mask[left] & mask[right] & ~(pattern[left] ^ pattern[right])
        levels.append((shared, pattern[left] & shared))
    return levels


def link_node(prints: np.ndarray, counts: dict | None = None) -> np.ndarray:
    """For distinct fingerprints in Gray order: index of the root each is linked to.

    Pairs of nodes are followed from the root down.  A pair carries the differing bits counted so far; on the way down
    only bits that both nodes share, but not both of their parents did, are compared and added.  A pair with more than
    ``MAX_BITS`` is pruned with all below it; a pair that cannot come to more, whatever its members, is linked by one
    star.  ``counts`` takes the number of pairs seen, pruned, starred and linked.
    """
    n = len(prints)
    forest, levels = Forest(n), gray_tree(prints)
    counts = {} if counts is None else counts
    top = np.zeros(1, np.int64)
    stack = [(len(levels) - 1, top, top, np.zeros(1, np.int64), np.zeros(1, U))]  # level, both nodes, differences, bits compared
    while stack:
        level, a, b, differ, compared = stack.pop()
        if len(a) > PAIRS_AT_ONCE:
            parts = [slice(k, k + PAIRS_AT_ONCE) for k in range(0, len(a), PAIRS_AT_ONCE)]
            stack += [(level, a[p], b[p], differ[p], compared[p]) for p in parts]
            continue
        mask, pattern = levels[level]
        both = mask[a] & mask[b]
        differ = differ + np.bitwise_count((pattern[a] ^ pattern[b]) & both & ~compared)
        near = differ <= MAX_BITS
        close = near & (differ + (64 - np.bitwise_count(both).astype(np.int64)) <= MAX_BITS)
        counts["seen"] = counts.get("seen", 0) + len(a)
        counts["pruned"] = counts.get("pruned", 0) + int((~near).sum())
        width = 1 << level
        if level:
            for x, y in zip(a[close].tolist(), b[close].tolist(), strict=True):  # one star for the whole pair of groups
                members = np.r_[x * width : min(n, (x + 1) * width), y * width : min(n, (y + 1) * width)]
                forest.link(members, np.full(len(members), members[0]))
                counts["starred"] = counts.get("starred", 0) + 1
            go = near & ~close
            a, b, differ, both = a[go], b[go], differ[go], both[go]
            same, size = a == b, len(levels[level - 1][0])
            left, right = 2 * a, 2 * b
            c, d = np.r_[left, left + 1, left, (left + 1)[~same]], np.r_[right, right + 1, right + 1, right[~same]]
            differ, both = np.r_[differ, differ, differ, differ[~same]], np.r_[both, both, both, both[~same]]
            there = (c < size) & (d < size) & ((level > 1) | (c != d))
            if there.any():
                stack.append((level - 1, c[there], d[there], differ[there], both[there]))
        else:
            counts["linked"] = counts.get("linked", 0) + int(near.sum())
            forest.link(a[near], b[near])
    forest.flatten()
    return forest.root


def _links_of(table: pa.Table) -> pa.Table:
    """Spanning forests of the nodes of one bucket."""
    node = table.column("node").to_numpy()
    prints = table.column("fp").to_numpy().view(U)
    order = np.lexsort((gray_rank(prints), node))
    node, prints = node[order], prints[order]
    starts = np.flatnonzero(np.r_[True, node[1:] != node[:-1]]) if len(node) else np.zeros(0, np.int64)
    left, right = [np.zeros(0, U)], [np.zeros(0, U)]
    for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(node)], strict=False):
        if e - s > 1:
            part = prints[s:e]
            root = link_node(part)
            moved = np.flatnonzero(root != np.arange(e - s))
            left.append(part[moved])
            right.append(part[root[moved]])
    pair = [np.concatenate(x).view(np.int64) for x in (left, right)]
    return pa.table({"a": pa.array(pair[0], I64), "b": pa.array(pair[1], I64)})


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def deal_masks(used: int, width: int) -> list[int]:
    """``MAX_BITS + 1`` masks of ``width`` bits each, or what is left, that share no bit with ``used`` nor each other."""
    bits = [b for b in range(64) if not used >> b & 1]
    parts = MAX_BITS + 1
    width = min(width, len(bits) // parts)
    return [sum(1 << b for b in bits[k::parts][:width]) for k in range(parts)]


def near_links(prints: DataFrame, node_size: int = NODE) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints (column ``fp``) that connect all within four bits.

    Each node is one Gray-order index.  If all fingerprints are more than a node holds they are dealt out: each goes to
    five nodes, by the bits under five masks without common bits; two that differ in at most four bits agree under one of
    them.  Masks have as many bits as the count asks for.  A node that is still too large is dealt out again by bits that
    were not used for it, until it isn't, or so few bits are left that they bound it.
    """
    spark = prints.sparkSession
    total = prints.count()
    nodes = prints.select("fp", F.lit(0).cast("long").alias("used"), F.lit(0).cast("long").alias("node"))
    done, ways = [], [0]
    width = max(0, math.ceil(math.log2(max(1, total) / node_size)))
    while ways and width:
        width, again = min(width, WIDEST), {}
        for used in ways:
            again[used] = [m for m in deal_masks(used, width) if m]
        ways = sorted({used | m for used, masks in again.items() for m in masks})
        if len(again) == 1:
            masks = F.array(*(F.lit(_signed(m)) for m in again[0]))
            spread = nodes.select("fp", "used", "node", F.explode(masks).alias("mask"))
        else:  # five times as many rows a round, few rounds
            rows = [(_signed(used), [_signed(m) for m in masks]) for used, masks in again.items()]
            table = spark.createDataFrame(rows, "used long, masks array<long>")
            spread = nodes.join(F.broadcast(table), "used").select("fp", "used", "node", F.explode("masks").alias("mask"))
        nodes = spread.select(
            "fp", F.col("used").bitwiseOR(F.col("mask")).alias("used"), F.xxhash64("node", "mask", F.col("fp").bitwiseAND(F.col("mask"))).alias("node")
        )
        large = checkpointed(nodes.groupBy("node").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > SPLIT * node_size))
        if large.isEmpty() or 64 - min(w.bit_count() for w in ways) < LAST_BITS:
            break
        done.append(nodes.join(large.select("node"), "node", "left_anti").select("fp", "node"))
        nodes = nodes.join(large.select("node"), "node", "left_semi")
        width = math.ceil(math.log2(large.agg(F.max("n")).first()[0] / node_size))
    every = reduce(DataFrame.unionByName, [*done, nodes.select("fp", "node")])
    buckets = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")), 5 * total // BUCKET)
    dealt = every.withColumn("bucket", F.pmod("node", F.lit(buckets))).repartition(buckets, "bucket")
    links = dealt.groupBy("bucket").applyInArrow(lambda t: _links_of(t.select(["node", "fp"])), "a long, b long")
    return links.distinct()


def components(links: DataFrame) -> DataFrame:
    """``fp, root`` for every end of a link: root is the smallest fingerprint that can be reached.

    Rounds of large-star (each node hands its larger neighbours to its smallest) and small-star (the same for its
    smaller ones) end when a round changes nothing.  Each is a ``min`` per node and an equi-join.
    """

    def star(edges: DataFrame, larger: bool) -> DataFrame:
        if larger:
            edges = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        else:
            edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        met = edges.join(least, "a")
        if larger:
            out = met.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            out = met.select("b", "m").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            out = out.unionByName(least.select("a", F.col("m").alias("b")))
        return out.where("a <> b").distinct()

    def state(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = checkpointed(links.where("a <> b"))
    before = state(edges)
    while True:
        edges = checkpointed(star(star(edges, True), False))
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("b").alias("fp")).distinct().select("fp", F.col("fp").alias("root"))
    return edges.select(F.col("a").alias("fp"), F.col("b").alias("root")).unionByName(roots)


def simhash(docs: DataFrame, text: str = "text", key: str = "doc_id", node_size: int = NODE) -> DataFrame:
    """One row per row of ``docs``: the id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    source = docs.select(F.col(key).alias("id"), F.col(text).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    printed = checkpointed(source.mapInArrow(_fingerprints, f"id {kind}, fp long"))
    prints = checkpointed(printed.groupBy("fp").agg(F.min("id").alias("least")))
    grouped = components(near_links(prints.select("fp"), node_size))
    rooted = prints.join(grouped, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(smallest, "root").select("fp", "component_id")
    out = printed.join(labels, "fp")
    return out.select(F.col("id").alias(key), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their own fingerprint's component (and rows without an id).

    An id of which every row goes is taken out by id alone; only where an id has rows that go and rows that stay are its
    texts fingerprinted again and taken out by id and fingerprint.
    """
    named = simhash(docs, text, key).select(F.col(key).alias("__id"), "fingerprint", (F.col(key) != F.col("component_id")).alias("gone"))
    named = named.where("__id is not null")
    by_id = checkpointed(named.groupBy("__id").agg(F.min("gone").alias("every"), F.max("gone").alias("some")).where("some"))
    mixed = by_id.where("not every").select("__id")
    apart = docs.join(by_id.select("__id"), F.col(key) == F.col("__id"), "left_anti")
    if mixed.isEmpty():
        return apart
    rows = docs.join(mixed, F.col(key) == F.col("__id"), "left_semi").select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    kind = docs.schema.simpleString()
    printed = rows.mapInArrow(_fingerprints, f"row {kind}, fp long").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0")))
    gone = named.where("gone").select(F.col("__id"), F.col("fingerprint").alias("__fp")).distinct()
    same = (F.col(f"row.{key}") == F.col("__id")) & (F.col("fingerprint") == F.col("__fp"))
    return apart.unionByName(printed.join(gone, same, "left_anti").select("row.*"))


def simhash_query(docs: DataFrame) -> DataFrame:
    return simhash(docs)

"""Conversation repair against a plain search over edit strings."""

import hashlib
import random
import re
import sys
import zlib

import numpy as np
import pytest

from caseweave.llm import conversation_repair as cr

sys.setrecursionlimit(20_000)
FINAL = re.compile(r"(s?(ua)+)?")
SCHEMA = "conv_id long, turn long, role string, text string, place int, cost string, audit int"


def faults(rows):
    """Initial and first fault of each ``(role, text)``."""
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(" \t\n\x0b\x0c\r")
        out.append((role[:1], "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""))
        seen.add((role, text))
    return out


def plain(rows):
    """Cost, audit and repaired rows by backward search over (row, what has to come), strings compared whole."""
    marks = faults(rows)
    best = {}

    def options(i, state, inserts=0):
        after = {"0": "u", "s": "u", "u": "a", "a": "u"}[state]
        names = {"u": "user", "a": "assistant"}
        if i == len(rows) and state in "0a":
            yield 0, "", ()
        if inserts < 2:
            cost, audit, kept = least(i, after, inserts + 1)
            yield cost + 2, "I" + audit, ((names[after], ""), *kept)
        if i < len(rows):
            initial, fault = marks[i]
            cost, audit, kept = least(i + 1, state)
            yield cost + 3, "D" + audit, kept
            if fault not in ("blank", "duplicate"):
                extra = fault == "truncated"
                cost, audit, kept = least(i + 1, after)
                yield cost + 2 + extra, "R" + audit, ((names[after], rows[i][1]), *kept)
                if initial == after or (initial == "s" and state == "0"):
                    cost, audit, kept = least(i + 1, initial)
                    yield cost + extra, "K" + audit, (rows[i], *kept)

    def least(i, state, inserts=0):
        if (i, state, inserts) not in best:
            best[i, state, inserts] = min(options(i, state, inserts), default=(10**9, "", ()))
        return best[i, state, inserts]

    return least(0, "0")


def code(rows):
    bits = {"": 0, "blank": cr.BLANK, "duplicate": cr.DUPLICATE, "truncated": cr.CUT}
    return np.array([{"s": 1, "u": 2, "a": 3}.get(i, 0) + bits[f] for i, f in faults(rows)], np.int64)


def some_rows(generator, n):
    roles = ["user", "assistant", "system", "tool", "u2", ""]
    return [(generator.choices(roles, [6, 6, 1, 1, 1, 1])[0], generator.choice(["a.", "b!", "c", "d?  ", " \t", "", "e", "f.", "g.", "h."])) for _ in range(n)]


def test_solve_finds_the_least_audit_of_each_conversation():
    generator = random.Random(11)
    talks = [some_rows(generator, generator.randrange(13)) for _ in range(1500)]
    costs, _, (index, _, letter, _), _ = cr.solve(np.concatenate([code(t) for t in talks]), np.array([len(t) for t in talks]))
    for k, rows in enumerate(talks):
        cost, audit, kept = plain(rows)
        assert (costs[k, 0], "".join(cr.LETTERS[x] for x in letter[index == k])) == (cost, audit)
        assert FINAL.fullmatch("".join(r[:1] for r, _ in kept))


@pytest.mark.parametrize("segment", [1, 2, 5, 64])
def test_segments_give_the_same_path(segment):
    generator = random.Random(segment)
    for _ in range(60):
        rows = some_rows(generator, generator.randrange(1, 40))
        cost, layer, letter, onto = cr.solve_long(code(rows), segment)
        whole = cr.solve(code(rows), np.array([len(rows)]))
        assert (cost, "".join(cr.LETTERS[x] for x in letter)) == plain(rows)[:2]
        assert layer.tolist() == whole[2][1].tolist() and onto.tolist() == whole[2][3].tolist()


def expected_report(rows):
    """Result row but the id from a conversation's ``(turn, role, text)`` rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    said = [r[1:] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    marks = faults(said)
    count = [sum(f == kind for _, f in marks) for kind in ("blank", "duplicate", "truncated")]
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks[:-1], marks[1:], strict=True))
    cost, audit, kept = plain(said)
    return (gaps, *count, illegal, cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest())


def test_repair_of_rows_of_any_kind(spark):
    generator, talks = random.Random(8), {None: [(None, None, None), (3, "user", "x."), (3, "user", "x."), (9, "assistant", "y" * 200_000)]}
    for k in range(60):
        talks[k] = [(generator.choice([None, 0, 1, 2, 5, 7]), *r) for r in some_rows(generator, generator.randrange(1, 12))]
    talks[77] = [(k, *r) for k, r in enumerate(some_rows(generator, 300))]
    rows = [(key, *r, 1, "x", 2) for key, own in talks.items() for r in own]
    df = spark.createDataFrame(rows, SCHEMA)
    expected = {key: expected_report(own) for key, own in talks.items()}
    for segment in (cr.SEGMENT, 7):
        assert {r[0]: tuple(r[1:]) for r in cr.repair(df, segment=segment).collect()} == expected
    turns = cr.repair(df, turns=True).orderBy("conv_id", "position").collect()
    joined = {}
    for r in turns:
        joined.setdefault(r.conv_id, []).append((r.role, r.text, r.edit))
    for key, own in joined.items():
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in own).encode()).hexdigest() == expected[key][-1]
        assert [e for _, _, e in own] == [e for e in expected[key][-2] if e != "D"]
    assert cr.repair(df.limit(0)).count() == 0 and cr.conversation_repair_query(df.limit(0)).count() == 0


def damaged(rows):
    out = {}
    for key, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (key, turn))
        kind = zlib.crc32(name.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        own = out.setdefault(key, [])
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_query_equals_plain_python(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    odd = [(None, None, None, None), (None, 1, "user", None), (-5, None, "system", "a."), (-5, -1, None, "?"), *((10**6 + k, 0, "user", "only.") for k in range(60))]
    extra = spark.createDataFrame(odd, "conv_id long, turn long, role string, text string")
    both = conversations.select(*extra.columns).unionByName(extra)
    talks = damaged([tuple(r) for r in both.collect()])
    assert any(not own for own in talks.values())
    out = cr.conversation_repair_query(both).collect()
    assert {r[0]: tuple(r[1:]) for r in out} == {key: expected_report(own) for key, own in talks.items()} and len(out) == len(talks)

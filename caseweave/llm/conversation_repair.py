"""Conversation structure repair: cheapest edits to ``(s?(ua)+)?``, the least audit found by prefix-doubling path ranking.

1. Order.  Rows are dealt by ranges of (conversation, turn, role), sorted and numbered once; the numbered rows are written
   to the shared folder, since all that follows refers to their numbers.  A long conversation is spread over many tasks here.
2. Faults.  Blank and truncated are row-local; duplicate is the least number of a (conversation, role, text) by an
   aggregation with a map-side part.  A row leaves as its number, its turn and one byte.
3. Cost.  Nodes are (row, state), with four states: nothing yet, after a system row, after a user row, after an assistant
   row.  Backward dynamic programming gives each node the least cost to the end, for many conversations at once.
4. Ranks.  Of the arcs on cheapest ways only the least letter counts at a node, and a node's arcs have different letters.  Nodes are
   ranked by the first letter of what follows, then by successive powers of two: the rank of 2n letters is that of the pair
   (rank of n letters here, rank of n letters n arcs further on), with pointers that are doubled each time.  The final
   ranks select each node's arc, and the doubled pointers list the nodes of each conversation's least path.
5. Replay.  Edits and numbered texts meet in order in one shuffle and are read as a stream: no conversation's texts are held.

A conversation longer than ``SEGMENT`` rows is solved in segments from its end, each handing the costs and the order of its
four first nodes to the one before.  (Only nodes of one row are ever compared for a choice, and those reach a border
together.)  So a task holds about 20 bytes a row of the one conversation that it works on, and a segment's tables.

Defined results: null roles and texts are one space each; rows of a conversation are ordered by turn (nulls first), then role, then
text; repeated rows are rows of their own (all but the first are duplicates); rows without an id form one conversation
without id; an empty role has no initial and can't be kept; an empty table gives no conversations.  Texts are taken whole,
however long.  Other columns are not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from caseweave.llm._spark import checkpointed

#: Rows that are solved together at most; a longer conversation is cut.
SEGMENT = 1 << 16
#: Costs of the edits, and what a truncated row that stays adds.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
LETTERS = "DIKR"
#: Where an insertion and a new role lead from each state, and where keeping a row leads by its initial (-1: not allowed).
ONWARD = np.array([USER, USER, ASSISTANT, USER])
KEPT = np.array([[-1, -1, -1, -1], [SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1]])
FAR = 1 << 40
#: Bits of a row's byte: initial (0 other, 1 s, 2 u, 3 a), blank, duplicate, truncated.
BLANK, DUPLICATE, CUT = 4, 8, 16
WHITE = " \t\n\x0b\f\r"


def damage(conversations: DataFrame) -> DataFrame:
    """Rows damaged by their number: dropped, emptied, without end marks, repeated or of role user."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    copies = F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return conversations.where(kind != 0).select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), copies.alias("copy")
    ).drop("copy")


def _ordered(rows: DataFrame) -> DataFrame:
    """``id, turn, role, text, place``; places rise in the order of the rows."""
    source = rows.select(
        F.col("conv_id").alias("id"), "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text")
    )
    dealt = source.repartitionByRange("id", "turn", "role").sortWithinPartitions("id", "turn", "role", "text")
    return checkpointed(dealt.withColumn("place", F.monotonically_increasing_id()))


def _coded(ordered: DataFrame) -> DataFrame:
    """``id, place, turn, code``: initial and first fault of each row."""
    ended = F.rtrim("text", F.lit(WHITE))
    initial = F.substring("role", 1, 1)
    marks = [F.xxhash64("id", "role", "text"), F.xxhash64(F.lit(1), "id", "role", "text")]
    compact = ordered.select(
        "id", "place", "turn", *(m.alias(f"mark{k}") for k, m in enumerate(marks)), (ended == "").alias("blank"), (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0).alias("initial"),
    )
    first = compact.groupBy("mark0", "mark1").agg(F.min("place").alias("first"))
    fault = F.when(F.col("blank"), BLANK).when(F.col("place") > F.col("first"), DUPLICATE).when(F.col("cut"), CUT).otherwise(0)
    return compact.join(first, ["mark0", "mark1"]).select("id", "place", "turn", (F.col("initial") + fault).cast("int").alias("code"))


def _closed(cost: np.ndarray) -> np.ndarray:
    """Costs after up to two insertions; more are never cheapest."""
    once = np.minimum(cost, INSERT + cost[..., ONWARD])
    return np.minimum(once, INSERT + once[..., ONWARD])


def _costs(codes: np.ndarray, lengths: np.ndarray, base: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Least cost to the end for each (layer, state); ``last`` holds that of the layer after the last row."""
    cost = np.full((int(lengths.sum()) + len(lengths), 4), FAR, np.int64)
    cost[base + lengths] = last
    order = np.argsort(-lengths, kind="stable")
    ends = (base + lengths)[order]
    for step in range(1, int(lengths.max(initial=0)) + 1):
        at = ends[: np.searchsorted(-lengths[order], -step, "right")] - step
        after, code = cost[at + 1], codes[at]
        kept, stays = KEPT[code & 3], (code & (BLANK | DUPLICATE)) == 0
        extra = np.where(stays, np.where(code & CUT, TRUNCATED, 0), FAR)[:, None]
        keep = np.where(kept >= 0, np.take_along_axis(after, np.maximum(kept, 0), 1) + KEEP + extra, FAR)
        new = np.minimum(np.minimum(after + DELETE, keep), after[:, ONWARD] + REROLE + extra)
        cost[at] = np.minimum(_closed(new), FAR)
    return cost


def solve(codes: np.ndarray, lengths: np.ndarray, after: tuple[np.ndarray, np.ndarray] | None = None):
    """Least audits of conversations whose rows' bytes follow each other in ``codes``.

    ``after`` has the costs and the order of the states after the last row, if the only conversation goes on.  Returns the first
    layers' costs, the order of the first states, and the paths: for each start (the conversations; with ``after`` the
    four states) in turn its index, layer, letter and new state, and each start's last state.
    """
    layers = lengths + 1
    base = np.cumsum(layers) - layers
    has_row = np.ones(int(layers.sum()), bool)
    has_row[base + lengths] = False
    code = np.zeros(len(has_row), np.int64)
    code[has_row] = codes
    last = _closed(np.array([0, FAR, FAR, 0])) if after is None else after[0]
    cost = _costs(code, lengths, base, last)

    # arcs by letter: target node and whether it is on a cheapest way
    n = 4 * len(code)
    node = np.arange(n).reshape(-1, 4)
    state = np.arange(4)[None, :]
    stays = has_row & ((code & (BLANK | DUPLICATE)) == 0)
    extra = np.where(code & CUT, TRUNCATED, 0)[:, None]
    kept = KEPT[code & 3]
    follow = np.minimum(node + 4, n - 4 + state)  # same state, next layer
    targets = [follow, node - state + ONWARD[state], follow - state + np.maximum(kept, 0), follow - state + ONWARD[state]]
    prices = [np.full((len(code), 4), DELETE), np.full((len(code), 4), INSERT), KEEP + extra + 0 * node, REROLE + extra + 0 * node]
    allowed = [has_row[:, None] | (node < 0), node >= 0, stays[:, None] & (kept >= 0), stays[:, None] | (node < 0)]
    flat = cost.reshape(-1)
    done = np.zeros((len(code), 4), bool)
    if after is None:
        done[~has_row] = cost[~has_row] == 0
    else:
        done[~has_row] = True
    done = done.reshape(-1)
    usable = [a & (flat[t] + p == cost) & (cost < FAR) for t, p, a in zip(targets, prices, allowed, strict=True)]

    # level 0: the first letter and where it leads; finished nodes lead to themselves
    rank, pointer = np.full(n, len(LETTERS) + 1, np.int64), np.arange(n)
    for letter in reversed(range(len(LETTERS))):
        found = usable[letter].reshape(-1) & ~done
        rank[found], pointer[found] = letter + 1, targets[letter].reshape(-1)[found]
    rank[done] = 0 if after is None else np.tile(after[1], len(code))[done]
    pointers = [pointer]
    while True:
        _, rank = np.unique(rank * (n + 8) + rank[pointer], return_inverse=True)
        if np.array_equal(doubled := pointer[pointer], pointer):
            break
        pointer = doubled
        pointers.append(pointer)

    # the ranks select an arc: the least (letter, rank of what follows)
    picked, least = np.zeros(n, np.int8), np.full(n, np.iinfo(np.int64).max)
    for letter, (target, good) in enumerate(zip(targets, usable, strict=True)):
        key = np.where(good.reshape(-1), (letter + 1) * (n + 8) + rank[target.reshape(-1)], np.iinfo(np.int64).max)
        better = key < least
        picked[better], least[better] = letter, key[better]

    starts = 4 * base if after is None else np.arange(4)[flat[:4] < FAR]
    index = np.arange(len(starts)) if after is None else starts.copy()
    ends = np.full(len(starts) if after is None else 4, -1)
    ends[index] = pointer[starts] % 4
    path, step = starts[~done[starts]], np.zeros(int((~done[starts]).sum()), np.int64)
    index = index[~done[starts]]
    for level in reversed(range(len(pointers))):  # nodes at each multiple of a power of two, then of half of it
        more = pointers[level][path]
        on = ~done[more]
        path, step, index = np.r_[path, more[on]], np.r_[step, step[on] + (1 << level)], np.r_[index, index[on]]
    order = np.lexsort((step, index))
    path, index = path[order], index[order]
    letter = picked[path]
    onto = np.stack([t.reshape(-1)[path] for t in targets])[letter, np.arange(len(path))] % 4
    first = rank[:4]
    return cost[base], np.unique(first, return_inverse=True)[1], (index, path // 4, letter, onto), ends


def solve_long(codes: np.ndarray, segment: int = SEGMENT):
    """Cost and ``layer, letter, onto`` of one conversation of any length, segment by segment from its end."""
    cost, order, _, _ = solve(np.zeros(0, np.int64), np.array([0]))  # a conversation of no rows has the end's costs and order
    after, solved = (cost[0], order), []
    for at in reversed(range(0, len(codes), segment)):
        part = codes[at : at + segment]
        costs, order, (index, layer, letter, onto), ends = solve(part, np.array([len(part)]), after)
        solved.append((at, [tuple(np.asarray(c[index == q], kind) for c, kind in ((layer, np.int32), (letter, np.int8), (onto, np.int8))) for q in range(4)], ends))
        after = (costs[0], order)
    total, state, parts = int(after[0][START]), START, []
    for at, paths, ends in reversed(solved):
        layer, letter, onto = paths[state]
        parts.append((layer.astype(np.int64) + at, letter, onto))
        state = int(ends[state])
    # what is inserted after the last row
    if state in (SYSTEM, USER):
        rest = [USER, ASSISTANT] if state == SYSTEM else [ASSISTANT]
        parts.append((np.full(len(rest), len(codes)), np.full(len(rest), LETTERS.index("I"), np.int8), np.array(rest, np.int8)))
    layer, letter, onto = (np.concatenate([p[k] for p in parts]) for k in range(3))
    return total, layer, letter, onto


#: What is done at a row: states inserted before it, then its own edit with its new state, e.g. ``uR2``, ``K``.
_ROLE = {USER: "u", ASSISTANT: "a"}
_NAMES = {"u": "user", "a": "assistant"}
_PLANS = [
    "".join(_ROLE.get(x, "") for x in (first, second)) + edit
    for first in (0, USER, ASSISTANT) for second in (0, USER, ASSISTANT) for edit in ("", "D", "K", "Ru", "Ra")
]


def _planned(layers: int, layer: np.ndarray, letter: np.ndarray, onto: np.ndarray) -> np.ndarray:
    """Index in ``_PLANS`` of what is done at each layer."""
    inserts = np.flatnonzero(letter == LETTERS.index("I"))
    again = np.r_[False, layer[inserts[1:]] == layer[inserts[:-1]]] if len(inserts) else np.zeros(0, bool)
    plan = np.zeros(layers, np.int64)
    for which, weight in ((~again, 15), (again, 5)):
        plan[layer[inserts[which]]] += weight * np.where(onto[inserts[which]] == USER, 1, 2)
    rows = np.flatnonzero(letter != LETTERS.index("I"))
    edit = np.select([letter[rows] == 0, letter[rows] == 2, onto[rows] == USER], [1, 2, 3], 4)
    plan[layer[rows]] += edit
    return plan


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
REPORT = "place long, plan string, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string"
_ASCII = np.frombuffer(LETTERS.encode(), np.uint8)


class _Conversation:
    """What a task holds of a conversation: a byte and a number for each row, and its turns' summary."""

    def __init__(self, key):
        self.key, self.codes, self.places, self.rows = key, [], [], 0
        self.low = self.high = None
        self.turns = 0

    def add(self, places: np.ndarray, turns: np.ndarray, known: np.ndarray, codes: np.ndarray) -> None:
        real = codes >= 0
        self.codes.append(codes[real].astype(np.uint8))
        self.places.append(places[real])
        self.rows += int(real.sum())
        turns = turns[real & known]
        if len(turns):
            self.turns += int(np.count_nonzero(np.diff(turns))) + (self.high is None or self.high != int(turns[0]))
            self.low = int(turns[0]) if self.low is None else self.low
            self.high = int(turns[-1])

    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def _counted(codes: np.ndarray, lengths: np.ndarray) -> list[np.ndarray]:
    """Blank, duplicate and truncated rows and illegal pairs of each conversation."""
    ends = np.cumsum(lengths)
    pairs = np.r_[6, (codes[:-1] & 3) * 4 + (codes[1:] & 3)][: len(codes)]
    starts = (ends - lengths)[lengths > 0]
    pairs[starts] = 6  # a first row has none before it
    flags = [*((codes & bit) > 0 for bit in (BLANK, DUPLICATE, CUT)), ~np.isin(pairs, (6, 11, 14))]  # su, ua, au
    return [(sums := np.r_[0, np.cumsum(f)])[ends] - sums[ends - lengths] for f in flags]


def _plans(batches, kind: pa.DataType, segment: int):
    """For each conversation a report (place -1) with what is inserted at its end, and a row for each of its rows."""
    names = ["id", "place", "plan", *COUNTS, "audit"]
    types = [kind, pa.int64(), pa.string(), *[pa.int64()] * len(COUNTS), pa.string()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    plans = pa.array(_PLANS)

    def made(found: list[_Conversation], costs, index, layer, letter, onto):
        lengths = np.array([c.rows for c in found], np.int64)
        codes, places = (np.concatenate([x for c in found for x in part(c)]) for part in (lambda c: c.codes, lambda c: c.places))
        plan = _planned(int(lengths.sum()) + len(found), layer, letter, onto)
        tails = np.cumsum(lengths + 1) - 1
        edges = np.searchsorted(index, np.arange(len(found) + 1))
        audits = _ASCII[letter].tobytes().decode()
        keys = pa.array([c.key for c in found], kind)
        columns = [keys, pa.array(np.full(len(found), -1)), plans.take(pa.array(plan[tails])), pa.array([c.gaps() for c in found], pa.int64())]
        columns += [pa.array(c, pa.int64()) for c in (*_counted(codes, lengths), costs)]
        columns.append(pa.array([audits[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True)], pa.string()))
        yield pa.RecordBatch.from_arrays(columns, schema=schema)
        own, plan = np.repeat(np.arange(len(found)), lengths), np.delete(plan, tails)
        for at in range(0, len(places), segment):
            part = slice(at, at + segment)
            columns = [keys.take(pa.array(own[part])), pa.array(places[part]), plans.take(pa.array(plan[part]))]
            yield pa.RecordBatch.from_arrays([*columns, *(pa.nulls(len(columns[0]), t) for t in types[3:])], schema=schema)

    def long(found: _Conversation):
        cost, layer, letter, onto = solve_long(np.concatenate(found.codes), segment)
        return made([found], [cost], np.zeros(len(layer), np.int64), layer, letter, onto)

    def flush(found: list[_Conversation]):
        if found:
            lengths = np.array([c.rows for c in found], np.int64)
            costs, _, path, _ = solve(np.concatenate([x for c in found for x in c.codes]), lengths)
            yield from made(found, costs[:, START], *path)

    ready, held, current = [], 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        group = batch.column(0).dictionary_encode()
        ids = group.dictionary.to_pylist()
        group = group.indices.fill_null(-1).to_numpy(zero_copy_only=False)
        places, turns, codes = (batch.column(k).fill_null(0).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
        known = batch.column(2).is_valid().to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            key = ids[group[a]] if group[a] >= 0 else None
            if current is None or key != current.key:
                if current is not None and current.rows > segment:
                    yield from long(current)
                elif current is not None:
                    if held + current.rows > segment:
                        yield from flush(ready)
                        ready, held = [], 0
                    ready.append(current)
                    held += current.rows + 1
                current = _Conversation(key)
            current.add(places[a:b], turns[a:b], known[a:b], codes[a:b])
    if current is not None and current.rows > segment:
        yield from long(current)
    elif current is not None:
        ready.append(current)
    yield from flush(ready)


def _replayed(batches):
    """Events in order: ``(report row,)`` for each conversation, then ``(place, edit, role, text)`` of its repaired rows."""
    report = plan = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["place"] == -1:
                if report is not None:
                    yield from _inserted(report["plan"])
                report = row
                yield (row,)
            elif row["kind"] == 0:
                plan = row["plan"]
            else:
                edit = plan.lstrip("ua")
                yield from _inserted(plan[: len(plan) - len(edit)])
                if edit != "D":
                    yield row["place"], edit[0], _NAMES[edit[1]] if edit[0] == "R" else row["role"], row["text"]
    if report is not None:
        yield from _inserted(report["plan"])


def _inserted(letters: str):
    for letter in letters:
        yield None, "I", _NAMES[letter], ""


def _digests(batches, names: list[str], schema: pa.Schema):
    """Reports with the digest of the repaired rows, as they are read."""
    rows, report, digest, first = [], None, None, True
    for event in _replayed(batches):
        if len(event) == 1:
            if report is not None:
                rows.append([*(report[c] for c in names), digest.hexdigest()])
            if len(rows) >= 1000:
                yield _batch(rows, schema)
                rows = []
            (report,), digest, first = event, hashlib.sha256(), True
        else:
            digest.update(f"{'' if first else chr(10)}{event[2]}:".encode())
            digest.update(event[3].encode())
            first = False
    if report is not None:
        rows.append([*(report[c] for c in names), digest.hexdigest()])
    if rows:
        yield _batch(rows, schema)


def _turns(batches, schema: pa.Schema):
    """Repaired rows: id, position, role, text, edit and the place of the row they were."""
    rows, key, position, size = [], None, 0, 0
    for event in _replayed(batches):
        if len(event) == 1:
            key, position = event[0]["id"], 0
            continue
        place, edit, role, text = event
        rows.append([key, position, role, text, edit, place])
        position, size = position + 1, size + len(text)
        if len(rows) >= 1000 or size > 8_000_000:
            yield _batch(rows, schema)
            rows, size = [], 0
    if rows:
        yield _batch(rows, schema)


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def repair(conversations: DataFrame, ids: DataFrame | None = None, turns: bool = False, segment: int = SEGMENT) -> DataFrame:
    """One row per conversation: counts, cost, audit and ``repaired_sha256``; with ``turns`` the repaired rows instead.

    ``ids`` names conversations that have to appear even without rows.
    """
    ordered = _ordered(conversations)
    kind_of = ordered.schema["id"].dataType
    named, arrow = kind_of.simpleString(), to_arrow_type(kind_of)
    coded = _coded(ordered).withColumn("turn", F.col("turn").cast("long"))
    if ids is not None:
        empty = ids.select(F.col("conv_id").alias("id")).distinct()
        coded = coded.unionByName(empty.select("id", F.lit(-1).cast("long").alias("place"), F.lit(None).cast("long").alias("turn"), F.lit(-1).alias("code")))
    streamed = coded.repartition("id").sortWithinPartitions("id", "place")
    planned = streamed.mapInArrow(lambda b: _plans(b, arrow, segment), f"id {named}, {REPORT}")
    texts = ordered.select("id", "place", F.lit(1).alias("kind"), "role", "text")
    met = planned.withColumn("kind", F.lit(0)).unionByName(texts, allowMissingColumns=True)
    met = met.repartition("id").sortWithinPartitions("id", "place", "kind")
    if turns:
        parts = [("conv_id", arrow), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("edit", pa.string()), ("place", pa.int64())]
        return met.mapInArrow(lambda b: _turns(b, pa.schema(parts)), f"conv_id {named}, position long, role string, text string, edit string, place long")
    names = ["id", *COUNTS, "audit"]
    parts = [("conv_id", arrow), *((c, pa.int64()) for c in COUNTS), ("audit", pa.string()), ("repaired_sha256", pa.string())]
    return met.mapInArrow(
        lambda b: _digests(b, names, pa.schema(parts)), f"conv_id {named}, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
    )


def conversation_repair_query(conversations: DataFrame) -> DataFrame:
    return repair(damage(conversations), conversations.select("conv_id"))


def _arc(after: str, cost: str, letter: str, piece: str) -> str:
    return f"{{'c': {after}.c + {cost}, 'a': '{letter}' || {after}.a, 'r': {piece} || {after}.r}}"


def _oracle() -> str:
    none = "[]::VARCHAR[]"
    far = f"{{'c': 1000000000::BIGINT, 'a': '', 'r': {none}}}"
    end = f"{{'c': 0::BIGINT, 'a': '', 'r': {none}}}"

    def base(state: str) -> str:
        onward, role = ("a", "assistant") if state == "u" else ("u", "user")
        keeps = [("u", "u")] if state in "sa" else [("a", "a")] if state == "u" else [("s", "s"), ("u", "u")]
        arcs = [_arc(f"d.{state}", "3", "D", none)]
        arcs += [f"CASE WHEN r.initial = '{i}' AND NOT r.goes THEN {_arc(f'd.{to}', 'r.cut', 'K', "[r.role || ':' || r.text]")} ELSE {far} END" for i, to in keeps]
        arcs.append(f"CASE WHEN NOT r.goes THEN {_arc(f'd.{onward}', '2 + r.cut', 'R', f"['{role}:' || r.text]")} ELSE {far} END")
        return f"least({', '.join(arcs)}) AS {state}"

    add_u, add_a = _arc("u", "2", "I", "['user:']"), _arc("a", "2", "I", "['assistant:']")
    both = f"{{'c': a.c + 4, 'a': 'II' || a.a, 'r': ['user:', 'assistant:'] || a.r}}"
    closed = f"least(n, {add_u}, {both}) AS n, least(s, {add_u}, {both}) AS s, least(u, {add_a}) AS u, least(a, {add_u}) AS a"
    white = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
numbered AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_concat([4294967295], list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
                         lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM numbered, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place, rtrim(text, {white}) AS ended FROM damaged),
faults AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 AS again, ended = '' AS blank, lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY place) || role[1:1] AS pair FROM placed),
coded AS (
  SELECT conv_id, turn, place, role, text, role[1:1] AS initial, blank OR again AS goes, pair, blank, again AND NOT blank AS duplicate,
         CASE WHEN NOT blank AND NOT again AND ended[-1:] NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS cut FROM faults),
counts AS (
  SELECT o.conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (duplicate) AS duplicate,
         coalesce(sum(cut), 0)::BIGINT AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, coalesce(max(place), 0) AS rows
  FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN coded c ON o.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY o.conv_id),
walk AS (
  SELECT conv_id, rows AS place, {closed} FROM (SELECT conv_id, rows, {end} AS n, {far} AS s, {far} AS u, {end} AS a FROM counts)
  UNION ALL
  SELECT conv_id, place, {closed} FROM (
    SELECT d.conv_id, d.place - 1 AS place, {base("n")}, {base("s")}, {base("u")}, {base("a")}
    FROM walk d JOIN coded r ON r.conv_id IS NOT DISTINCT FROM d.conv_id AND r.place = d.place))
SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, w.n.c AS cost, w.n.a AS audit, sha256(array_to_string(w.n.r, chr(10))) AS repaired_sha256
FROM counts c JOIN walk w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.place = 0
"""


ORACLE_SQL = _oracle()


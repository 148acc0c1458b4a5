"""Chat formatting: incremental black-box rendering of conversations, turn spans and loss masks.

A template is a black box, ``render(turns) -> str``.  The turns' spans come from comparing the outputs for successive
turn prefixes: if each output begins with the one before, what is new is the new turn.  Where an output does not begin
with the one before, the template rewrites history; that is reported with the turn, and no span is given, since none
would hold.  Within a turn, two probe texts that differ in their first character show where the text begins, and an
empty text shows how much follows it.

Prefixes of a long conversation would cost the square of its length.  After ``window`` turns, rendering goes on from the
last turn of the window; at each such step, and at the end, what was put together is compared with one rendering of
the whole prefix, and if they differ the conversation is rendered prefix by prefix from the start.

Conversations are sorted within the partitions of a shuffle by id and read as a stream, so a task holds one
conversation at a time.  (A digest of a conversation is made in order, so one conversation is one task's work.)

Defined results: null texts and roles are empty; rows of one conversation are ordered by turn, then role, then text
(null turns first); repeated rows are turns of their own; rows without an id form one conversation without id;
texts are taken whole, however long; an empty table gives no conversations (the query's own one stays); other columns are
not looked at, whatever their names.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WINDOW_TURNS = 128
LOSS_ROLE = "assistant"


class BracketTemplate:
    """``<s>[INST]role[/INST]text</s>`` for each turn; control strings inside roles and texts are escaped reversibly.

    A backslash goes before every backslash and after the first character of every control string, so that escaped text
    holds no control string; taking away each backslash and keeping the character after it gives the text back.
    """

    CONTROLS = ("<s>", "</s>", "[INST]", "[/INST]")
    _special = re.compile(r"\\|<(?=/?s>)|\[(?=/?INST\])")
    _turn = re.compile(r"<s>\[INST\](.*?)\[/INST\](.*?)</s>", re.S)

    def escape(self, text: str) -> str:
        return self._special.sub(lambda m: m[0] + "\\", text)

    def unescape(self, text: str) -> str:
        return re.sub(r"(\\|<|\[)\\", r"\1", text)

    def render(self, turns: list[tuple[str, str]]) -> str:
        return "".join(f"<s>[INST]{self.escape(role)}[/INST]{self.escape(text)}</s>" for role, text in turns)

    def parse(self, output: str) -> list[tuple[str, str]]:
        return [(self.unescape(role), self.unescape(text)) for role, text in self._turn.findall(output)]


def _first_difference(a: str, b: str, low: int) -> int:
    """Where two strings that agree before ``low`` begin to differ, by halving."""
    high = min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def locate(render, turns: list, window: int = WINDOW_TURNS) -> tuple[str, list[tuple[int, int, int, int]] | None, int]:
    """Output, spans ``(start, end, text start, text end)`` of the turns or None, and the turn that rewrites history or -1."""
    output = render(turns)
    spans, parts = [], ""
    for start in range(0, max(1, len(turns)), window):
        end = min(start + window, len(turns))
        base = max(0, start - 1)
        first = render(turns[base:start])
        shift = len(parts) - len(first)
        found, bad, last = _spans(render, turns[base:end], start - base, first, shift)
        if found is None:
            break
        parts += last[len(first) :]
        if not output.startswith(parts) or (start and render(turns[:end]) != parts):
            break
        spans += found
    else:
        if parts == output:
            return output, spans, -1
    found, bad, _ = _spans(render, turns, 0, render([]), 0)
    return output, found, bad


def _spans(render, turns: list, start: int, before: str, shift: int):
    spans = []
    for k in range(start, len(turns)):
        now = render(turns[: k + 1])
        if not now.startswith(before):
            return None, k, before
        role = turns[k][0]
        one, two, none = (render([*turns[:k], (role, text)]) for text in ("a", "b", ""))
        head = _first_difference(one, two, 0)
        head = min(head, len(none))
        tail = len(none) - head
        spans.append((shift + len(before), shift + len(now), shift + head, shift + len(now) - tail))
        before = now
    return spans, -1, before


SCHEMA = (
    "conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, "
    "rewrites_at long, formatted string, span_starts array<long>, span_ends array<long>, loss_starts array<long>, loss_ends array<long>"
)


def _digest(parts) -> str:
    digest = hashlib.sha256()
    for part in parts:
        digest.update(part.encode())
    return digest.hexdigest()


def _format(template, key, turns: list) -> tuple:
    output, spans, rewrites = locate(template.render, turns)
    read = template.parse(output)
    masked = [(s[2], s[3]) for s, (role, _) in zip(spans or [], turns, strict=False) if role == LOSS_ROLE]
    loss = [template.unescape(output[a:b]) for a, b in masked]
    return (
        key, len(read), _digest(f"{role}\n{text}\n" for role, text in read), sum(map(len, loss)), _digest(loss), len(output),
        rewrites if rewrites >= 0 else None, output, [s[0] for s in spans or []], [s[1] for s in spans or []],
        [a for a, _ in masked], [b for _, b in masked],
    )


def _stream(batches, template, schema: pa.Schema):
    """One row per conversation from rows sorted by conversation."""
    key, turns, begun, rows, size = None, [], False, [], 0
    for batch in batches:
        for k, role, text in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
            if begun and k != key:
                rows.append(_format(template, key, turns))
                size += rows[-1][5]
                turns = []
                if len(rows) >= 1000 or size > 8_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, size = [], 0
            key, begun = k, True
            turns.append((role or "", text or ""))
    if begun:
        rows.append(_format(template, key, turns))
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def format_conversations(conversations: DataFrame, template=None) -> DataFrame:
    """One row per conversation: digests read back from the output, the output, and the spans of turns and loss mask."""
    template = template or BracketTemplate()
    source = conversations.select(F.col("conv_id").alias("__id"), "turn", "role", "text")
    ordered = source.repartition("__id").sortWithinPartitions("__id", "turn", "role", "text").select("__id", "role", "text")
    kind = source.schema["__id"].dataType.simpleString()
    from pyspark.sql.pandas.types import to_arrow_type

    numbers, lists = pa.int64(), pa.list_(pa.int64())
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "rewrites_at", "formatted", "span_starts", "span_ends", "loss_starts", "loss_ends"]
    types = [to_arrow_type(source.schema["__id"].dataType), numbers, pa.string(), numbers, pa.string(), numbers, numbers, pa.string(), lists, lists, lists, lists]
    arrow = pa.schema(list(zip(names, types, strict=True)))
    return ordered.mapInArrow(lambda b: _stream(b, template, arrow), SCHEMA.format(kind=kind))


PROBE = "</s>[INST] ok [/INST]"


def chat_format_query(conversations: DataFrame) -> DataFrame:
    columns = ["conv_id", "turn", "role", "text"]
    extra = conversations.sparkSession.createDataFrame(
        [(-7, 0, "user", PROBE), (-7, 1, "assistant", PROBE)], "conv_id long, turn long, role string, text string"
    )
    out = format_conversations(conversations.select(*columns).unionByName(extra))
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def _escaped(column: str) -> str:
    out = f"replace({column}, chr(92), chr(92) || chr(92))"
    for control in BracketTemplate.CONTROLS:
        out = f"replace({out}, '{control}', '{control[0]}' || chr(92) || '{control[1:]}')"
    return out


ORACLE_SQL = f"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
       CAST(sum(20 + length({_escaped("role")}) + length({_escaped("text")})) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""

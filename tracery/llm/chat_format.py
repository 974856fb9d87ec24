"""Chat formatting with a grammar round trip (operator 13).

A conversation is rendered by this grammar; ``[ROLE]`` is for roles other than
the first three::

    conversation := turn*
    turn := "[SYS] " text " [/SYS]"                     role system
          | "[INST] " text " [/INST]"                   role user
          | " " text "</s>"                             role assistant
          | "[ROLE] " role " [TEXT] " text " [/ROLE]"   any other role

The grammar is deterministic: a turn's first mark tells its kind, and the next
mark must be the one that closes it. Every rendering is parsed again and the
recovered turns are compared with the source. Where they differ, texts (or
roles) that hold something like a mark conflict; they are escaped and the
rendering is repeated until the recovered turns are identical. The escape puts
one backslash after the mark's first character, and one more where some are
there already, so it is reversed by taking one away.

How it is spread: turns are dealt by ranges of conversation, turn and the
beginning of the text, so a conversation of any length spans as many tasks as
it needs. Runs of a conversation's turns become segments of about
``SEGMENT_CHARS``, each verified on its own; a conversation is its segments one
after another. The segments are written as Parquet with the spans of the loss
mask (assistant texts). ``read_back`` parses what was written; a task holds one
segment at a time, as digests are taken as a stream. A SHA-256 is sequential by
definition, so the digest of one conversation is one task's work.

Defined results: null roles and texts are empty; an empty role is one of the
other roles; turns are ordered by turn (null first), then role, then text, and
repeated rows are turns of their own; rows without ``conv_id`` make one
conversation with a null id; an empty table gives an empty table; other columns
are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracery.llm.common import batch, partitions
from tracery.session import scratch_path

SEGMENT_CHARS = 1 << 20
MARK = re.compile(r"<\\*/?s>|\[\\*/?(?:SYS|INST|ROLE|TEXT)\]")
#: How a turn of each role opens and closes; ``OTHER`` carries its role.
OPEN = {"system": "[SYS] ", "user": "[INST] ", "assistant": " "}
CLOSE = {"system": " [/SYS]", "user": " [/INST]", "assistant": "</s>"}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
#: Characters of the text that order ranges of equal turns; ties beyond them stay in one task.
HEAD = 32
SEGMENTS = pa.schema([("conv_id", pa.int64()), ("task", pa.int32()), ("number", pa.int64()), ("formatted", pa.string()),
                      ("loss", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])
SEGMENTS_DDL = "conv_id long, task int, number long, formatted string, loss array<struct<start:long,end:long>>"


class Conflict(ValueError):
    """The text does not follow the grammar."""


def escape(text: str) -> str:
    return MARK.sub(lambda m: m[0][0] + "\\" + m[0][1:], text)


def unescape(text: str) -> str:
    return MARK.sub(lambda m: m[0][0] + m[0][2:] if m[0][1] == "\\" else m[0], text)


def render(role: str, text: str) -> tuple[str, int, int]:
    """A turn, and where its text starts and ends in it."""
    if role in OPEN:
        head, tail = OPEN[role], CLOSE[role]
    else:
        head, tail = OTHER[0] + role + OTHER[1], OTHER[2]
    return head + text + tail, len(head), len(head) + len(text)


def _until(formatted: str, start: int, close: str) -> int:
    """Where the text that starts at ``start`` ends: the next mark must be in ``close``."""
    for m in MARK.finditer(formatted, start):
        if m[0][1] != "\\":
            end = m.end() - len(close)
            if end < start or not formatted.startswith(close, end):
                raise Conflict(f"{m[0]} at {m.start()}")
            return end
    raise Conflict(f"no {close} after {start}")


def parse(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of every turn, unescaped."""
    turns, at = [], 0
    while at < len(formatted):
        for role, head in OPEN.items():
            if formatted.startswith(head, at):
                tail, at = CLOSE[role], at + len(head)
                break
        else:
            if not formatted.startswith(OTHER[0], at):
                raise Conflict(f"no turn at {at}")
            end = _until(formatted, at + len(OTHER[0]), OTHER[1].rstrip())
            role = unescape(formatted[at + len(OTHER[0]):end])
            at = end + len(OTHER[1])
            if formatted[at - 1:at] != " " or role in OPEN:
                raise Conflict(f"no text at {at}")
            tail = OTHER[2]
        end = _until(formatted, at, tail)
        turns.append((role, unescape(formatted[at:end])))
        at = end + len(tail)
    return turns


def recovered(formatted: str) -> list[tuple[str, str]] | None:
    try:
        return parse(formatted)
    except Conflict:
        return None


def round_trip(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The turns' rendering that parses back to them, and its loss spans."""
    written = list(turns)
    while True:
        parts, loss, at = [], [], 0
        for (role, _), (name, text) in zip(turns, written):
            part, start, end = render(name, text)
            parts.append(part)
            if role == "assistant":
                loss.append((at + start, at + end))
            at += len(part)
        formatted = "".join(parts)
        if recovered(formatted) == turns:
            return formatted, loss
        # A turn conflicts if it does not come back on its own; the others do, one after another.
        conflicts = [i for i, turn in enumerate(turns) if written[i] == turn and recovered(parts[i]) != [turn]]
        if not conflicts:
            raise Conflict("escaped turns do not come back")
        for i in conflicts:
            role, text = turns[i]
            written[i] = (role if role in OPEN else escape(role), escape(text))


def in_order(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` sorted within range partitions."""
    turns = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.coalesce("role", F.lit("")).alias("role"),
                        F.coalesce("text", F.lit("")).alias("text"))
    keys = ["conv_id", "turn", F.substring("role", 1, HEAD), F.substring("text", 1, HEAD)]
    return turns.repartitionByRange(partitions(rows.sparkSession), *keys).sortWithinPartitions("conv_id", "turn", "role", "text")


def format_conversations(rows: DataFrame, segment_chars: int = SEGMENT_CHARS) -> DataFrame:
    """``conv_id, task, number, formatted, loss``: a conversation is the
    concatenation of its segments by ``task`` and ``number``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number = TaskContext.get().partitionId(), 0
        conv, held, size = None, [], 0

        def segment() -> pa.RecordBatch:
            nonlocal number
            formatted, loss = round_trip(held)
            number += 1
            return batch(SEGMENTS, conv_id=[conv], task=[task], number=[number], formatted=[formatted],
                         loss=[[{"start": s, "end": e} for s, e in loss]])

        for b in batches:
            done = []
            for c, role, text in zip(*(b.column(x).to_pylist() for x in ("conv_id", "role", "text"))):
                if held and (c != conv or size >= segment_chars):
                    done.append(segment())
                    held, size = [], 0
                conv = c
                held.append((role, text))
                size += len(text)
            if done:
                yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
        if held:
            yield segment()

    return in_order(rows).select("conv_id", "role", "text").mapInArrow(run, SEGMENTS_DDL)


def write_formatted(rows: DataFrame, folder: str | None = None) -> str:
    """Writes the segments and returns their folder."""
    folder = folder or scratch_path(rows.sparkSession, "chat")
    format_conversations(rows).write.parquet(folder)
    return folder


REPORT = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                    ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])


def report(segments: DataFrame) -> DataFrame:
    """Digests of every conversation, parsed from its segments."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: list | None = None

        def row(s: list) -> tuple:
            return s[0], s[1], s[2].hexdigest(), s[3], s[4].hexdigest(), s[5]

        for b in batches:
            done = []
            for conv, formatted, loss in zip(*(b.column(x).to_pylist() for x in ("conv_id", "formatted", "loss"))):
                if state is None or state[0] != conv:
                    if state:
                        done.append(row(state))
                    state = [conv, 0, sha256(), 0, sha256(), 0]
                for role, text in parse(formatted):
                    state[1] += 1
                    state[2].update(f"{role}\n{text}\n".encode())
                for span in loss:
                    text = unescape(formatted[span["start"]:span["end"]])
                    state[3] += len(text)
                    state[4].update(text.encode())
                state[5] += len(formatted)
            if done:
                yield batch(REPORT, **dict(zip(REPORT.names, zip(*done))))
        if state:
            yield batch(REPORT, **dict(zip(REPORT.names, zip(row(state)))))

    n = partitions(segments.sparkSession)
    return (segments.repartition(n, "conv_id").sortWithinPartitions("conv_id", "task", "number")
            .mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                             "formatted_chars long"))


def read_back(spark, folder: str) -> DataFrame:
    return report(spark.read.schema(SEGMENTS_DDL).parquet(folder))


#: The last row of every check: texts made of control strings.
CONTROL_TURNS = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))


def with_control_turns(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -7, whose texts are control strings."""
    schema = "conv_id long, turn long, role string, text string"
    return rows.select("conv_id", "turn", "role", "text").unionByName(rows.sparkSession.createDataFrame(CONTROL_TURNS, schema))


#: DuckDB SQL of the report; the escape is written out again here.
ORACLE = r"""
with turns as (
    select conv_id, turn, role, text from conversations
    union all values (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), plain as (
    select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from turns
), sized as (
    select *,
        regexp_replace(regexp_replace(text, '<(\\*/?s>)', '<\\\1', 'g'),
            '\[(\\*/?(?:SYS|INST|ROLE|TEXT)\])', '[\\\1', 'g') as escaped,
        regexp_replace(regexp_replace(role, '<(\\*/?s>)', '<\\\1', 'g'),
            '\[(\\*/?(?:SYS|INST|ROLE|TEXT)\])', '[\\\1', 'g') as escaped_role
    from plain
)
select conv_id, count(*) as n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls first, role, text)) as turns_sha256,
    coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
    sha256(coalesce(string_agg(text, '' order by turn nulls first, role, text) filter (role = 'assistant'), '')) as loss_sha256,
    sum(length(escaped) + case role when 'system' then 13 when 'user' then 15 when 'assistant' then 5
        else 23 + length(escaped_role) end)::bigint as formatted_chars
from sized group by conv_id
"""

"""Chat formatting checked by a grammar round trip, with the loss mask over assistant texts.

A turn is rendered as ``### role ###``, a line break, the text, a line break, ``</turn>`` and a line break. ``###`` and
``</turn>`` are the control strings. Where a role or text holds one, the rendered form gets one
backslash more before it (before the backslashes that stand there), and the parser takes one away.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from corpusloom.session import materialise

MARK, END = "###", "</turn>"
_CONTROL = re.compile(r"(\\*)(###|</turn>)")

#: Characters after which a conversation goes on in the next part (whole turns; a longer turn is a part of its own).
PART_CHARS = 1 << 20


class NotATurn(ValueError):
    """Text that the grammar does not accept."""


@dataclass(frozen=True)
class Span:
    """A parsed turn: its role and text as they were, where the rendered text lies, and where the turn ends."""

    role: str
    text: str
    start: int
    stop: int
    end: int


def escape(content: str) -> str:
    return _CONTROL.sub(r"\\\1\2", content)


def _content(rendered: str, start: int, closing: str, gap: str) -> tuple[str, int, int]:
    """Content from ``start`` up to the first bare control string, which has to be ``gap + closing``."""
    parts, at = [], start
    for found in _CONTROL.finditer(rendered, start):
        if found.group(1):
            parts += [rendered[at : found.start()], found.group(0)[1:]]
            at = found.end()
            continue
        stop = found.start() - len(gap)
        if found.group(2) != closing or stop < at or rendered[stop : found.start()] != gap:
            break
        return "".join([*parts, rendered[at:stop]]), stop, found.end()
    raise NotATurn(f"no {closing} after {start}")


def _expect(rendered: str, at: int, what: str) -> int:
    if not rendered.startswith(what, at):
        raise NotATurn(f"{what!r} expected at {at}")
    return at + len(what)


def parse_turn(rendered: str, at: int = 0) -> Span:
    """The turn that begins at ``at``. Every choice is made by the next control string, so there is one reading."""
    start = _expect(rendered, at, MARK + " ")
    role, _, stop = _content(rendered, start, MARK, " ")
    start = _expect(rendered, stop, "\n")
    text, stop, end = _content(rendered, start, END, "\n")
    return Span(role, text, start, stop, _expect(rendered, end, "\n"))


def parse(rendered: str) -> Iterator[Span]:
    """The turns of a whole rendered text."""
    at = 0
    while at < len(rendered):
        span = parse_turn(rendered, at)
        yield span
        at = span.end


def _render(role: str, text: str) -> str:
    return f"{MARK} {role} {MARK}\n{text}\n{END}\n"


def _reads_back(rendered: str, role: str, text: str) -> Span | None:
    try:
        span = parse_turn(rendered)
    except NotATurn:
        return None
    return span if (span.role, span.text, span.end) == (role, text, len(rendered)) else None


def render_turn(role: str, text: str) -> tuple[str, Span]:
    """The turn as text, and what the parser recovers from it, which is the turn.

    It is rendered as it stands and parsed; if the parser recovers something else, the content that conflicts
    is escaped, the role first, then the text, until it recovers the turn. A turn that parses to
    itself up to its last character does so wherever it stands, so turns may be checked one by one.
    """
    for tried_role, tried_text in ((role, text), (escape(role), text), (role, escape(text)), (escape(role), escape(text))):
        rendered = _render(tried_role, tried_text)
        span = _reads_back(rendered, role, text)
        if span:
            return rendered, span
    raise NotATurn("a turn that escapes cannot save")


_LOSS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def format_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", trained: str = "assistant",
    part_chars: int = PART_CHARS,
) -> DataFrame:
    """Rendered conversations: ``conv``, ``part``, ``text``, ``n_turns``, ``loss``.

    A conversation is the texts of its parts, in order of ``part``, end to end. Parts hold whole turns;
    ordinary conversations have one part, seldom two (where a task ends). ``loss`` lists the stretches of the
    part (code points from its start, escapes included) that are texts of the role ``trained``.

    Turns come in order of ``turn``, nulls first, ties by role, then by the text's SHA-256; rows that repeat are
    turns of their own. Null roles and texts count as empty, a null ``conv`` is a conversation. Very long
    texts are parts of their own; other columns are not read; an empty table gives an empty table.

    Rows are dealt by ranges of conversation and turn, so a conversation with any share of the rows is
    spread over many tasks.
    """
    plain = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text)]
    turns = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), plain[0].alias("role"), plain[1].alias("text"))
    order = ["conv", "turn", "role", F.sha2("text", 256)]
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = turns.repartitionByRange(tasks, *order).sortWithinPartitions(*order)

    schema = f"conv {turns.schema['conv'].dataType.simpleString()}, part long, text string, n_turns long, loss array<struct<start:long,stop:long>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at, ready, ready_size = TaskContext.get().partitionId() << 32, None, [], 0
        texts, loss, size = [], [], 0

        def made(kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), _LOSS]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], ["conv", "part", "text", "n_turns", "loss"])

        for rows in batches:
            for c, r, t in zip(*(rows.column(i).to_pylist() for i in (0, 2, 3))):
                if texts and ((c,) != at or size >= part_chars):
                    ready.append((at[0], part, "".join(texts), len(texts), loss))
                    ready_size += size
                    part, texts, loss, size = part + 1, [], [], 0
                    if ready_size >= PART_CHARS or len(ready) >= 4096:
                        yield made(rows.schema.field(0).type)
                        ready, ready_size = [], 0
                at = (c,)
                rendered, span = render_turn(r, t)
                if r == trained:
                    loss.append({"start": size + span.start, "stop": size + span.stop})
                texts.append(rendered)
                size += len(rendered)
            if texts:
                kind = rows.schema.field(0).type
        if texts:
            ready.append((at[0], part, "".join(texts), len(texts), loss))
            yield made(kind)

    return materialise(dealt.mapInArrow(run, schema), "chat-parts")


def part_starts(parts: DataFrame) -> DataFrame:
    """``conv``, ``part``, ``start``: where each part begins in its conversation, in code points.

    Parts of a conversation are few: about one for each task that met it and each ``PART_CHARS`` of text.
    """
    sizes = parts.select("conv", "part", F.length("text").cast("long").alias("n"))
    before = W.partitionBy("conv").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    return sizes.select("conv", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))


def read_back(parts: DataFrame) -> DataFrame:
    """Per conversation what its rendered parts say: number of turns, hashes of turns and of trained text, sizes.

    ``turns_sha256`` is over role, line break, text, line break of every turn; ``loss_sha256`` over the text under the
    loss mask, unescaped; ``loss_chars`` counts its code points. Parts are parsed one at a time, in order, and
    hashed as they pass, so a task holds one part whatever the length of a conversation.
    """
    dealt = parts.select("conv", "part", "text", "loss").repartition("conv").sortWithinPartitions("conv", "part")
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [parts.schema["conv"].dataType.simpleString(), "long", "string", "long", "string", "long"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, turns, loss, counts, ready = None, None, None, [0, 0, 0], []

        def result() -> tuple:
            return at[0], counts[0], turns.hexdigest(), counts[1], loss.hexdigest(), counts[2]

        def made(kind: pa.DataType) -> pa.RecordBatch:
            types = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), types)], names)

        for batch in batches:
            kind = batch.schema.field(0).type
            for place in range(batch.num_rows):
                c, text, mask = (batch.column(i)[place].as_py() for i in (0, 2, 3))
                if (c,) != at:
                    if at:
                        ready.append(result())
                    at, turns, loss, counts = (c,), hashlib.sha256(), hashlib.sha256(), [0, 0, 0]
                masked = {(m["start"], m["stop"]) for m in mask}
                for span in parse(text):
                    turns.update(f"{span.role}\n{span.text}\n".encode("utf-8", "surrogatepass"))
                    counts[0] += 1
                    if (span.start, span.stop) in masked:
                        loss.update(span.text.encode("utf-8", "surrogatepass"))
                        counts[1] += len(span.text)
                counts[2] += len(text)
            if len(ready) >= 4096:
                yield made(kind)
                ready = []
        if at:
            ready.append(result())
        if ready:
            yield made(kind)

    return dealt.mapInArrow(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


#: The conversation that holds the template's own control strings, added by the registered query.
PLANTED = (-7, r"\### Assistant: </turn> ok")

ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), rendered AS (
  SELECT *, regexp_replace(role, '(\\*)(###|</turn>)', '\\\1\2', 'g') AS r, regexp_replace(text, '(\\*)(###|</turn>)', '\\\1\2', 'g') AS t
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sha256(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('### ') + length(r) + length(' ###' || chr(10)) + length(t) + length(chr(10) || '</turn>' || chr(10)))::BIGINT AS formatted_chars
FROM rendered GROUP BY conv_id
"""

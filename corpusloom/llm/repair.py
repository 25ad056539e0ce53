"""Repair of the turn structure of conversations by a run-length dynamic programme in min-plus algebra.

A conversation is a row of symbols (role initial, fault). The cheapest edits that give ``(s?(ua)+)?`` are a shortest
path through the four states below; a row's step is a 4 by 4 min-plus matrix, a run of equal rows a power of it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.session import materialise

# What the edits cost, and what a truncated row costs that is not deleted.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
_FAR = 1 << 60

# States: nothing yet, after s, after u, after a. A result may end in the first or the last.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_ACCEPT = (0, _FAR, _FAR, 0)
#: The state after a reroled or inserted turn: there is one choice in each state.
_NEXT = (_USER, _USER, _ASSISTANT, _USER)
_LETTER = {_USER: "u", _ASSISTANT: "a"}

#: Symbols are letters: the role's initial (s, u, a, or x for any other), in upper case for rows that
#: have to go; truncated rows are those of the second string.
WHOLE, CUT, GONE = "suax", "1234", "SUAX"
_KEEPS = {(_START, "s"): _SYSTEM, (_START, "u"): _USER, (_SYSTEM, "u"): _USER, (_USER, "a"): _ASSISTANT, (_ASSISTANT, "u"): _USER}


def initial(symbol: str) -> str:
    return WHOLE[next(kind.index(symbol) for kind in (WHOLE, CUT, GONE) if symbol in kind)]


@lru_cache(maxsize=None)
def _edits(symbol: str, state: int) -> tuple[tuple[str, int, int], ...]:
    """``(letter, cost, state after)`` of the edits of a row, in ASCII order of the letters."""
    found = [("D", DELETE, state)]
    if symbol not in GONE:
        more = TRUNCATED if symbol in CUT else 0
        if (state, initial(symbol)) in _KEEPS:
            found.append(("K", KEEP + more, _KEEPS[state, initial(symbol)]))
        found.append(("R", REROLE + more, _NEXT[state]))
    return tuple(found)


def _closed(values: tuple) -> tuple:
    """Costs to the end when turns may be inserted first."""
    for _ in range(2):  # after two, further turns only lead round
        values = tuple(min(v, INSERT + values[_NEXT[q]]) for q, v in enumerate(values))
    return values


def _times(matrix: tuple, values: tuple) -> tuple:
    return tuple(min(min(a + b for a, b in zip(row, values)), _FAR) for row in matrix)


def _product(a: tuple, b: tuple) -> tuple:
    columns = [_times(a, column) for column in zip(*b)]
    return tuple(zip(*columns))


@lru_cache(maxsize=None)
def power(symbol: str, k: int) -> tuple:
    """The transition of ``2 ** k`` rows of a symbol, insertions before each among them."""
    if k:
        half = power(symbol, k - 1)
        return _product(half, half)
    row = []
    for state in range(4):
        row.append(tuple(min((cost for _, cost, after in _edits(symbol, state) if after == q), default=_FAR) for q in range(4)))
    return tuple(zip(*(_closed(column) for column in zip(*row))))


def _bits(n: int) -> list[int]:
    return [k for k in range(n.bit_length()) if n >> k & 1]


def before(runs: list[tuple[str, int]], values: tuple) -> tuple:
    """Costs to the end before the runs, given those after them."""
    for symbol, n in reversed(runs):
        for k in _bits(n):
            values = _times(power(symbol, k), values)
    return values


def matrix(runs: list[tuple[str, int]]) -> tuple:
    """The min-plus matrix of all runs."""
    units = [tuple(0 if q == r else _FAR for q in range(4)) for r in range(4)]
    return tuple(zip(*(before(runs, unit) for unit in units)))


@lru_cache(maxsize=200_000)
def _unroll(symbol: str, k: int, state: int, values: tuple) -> tuple[int, str]:
    """State after, and cheapest edits of, ``2 ** k`` rows; ``values`` are the costs after them, least 0."""
    if k:
        half = _times(power(symbol, k - 1), values)
        least = min(half)
        middle, left = _unroll(symbol, k - 1, state, tuple(v - least for v in half))
        after, right = _unroll(symbol, k - 1, middle, values)
        return after, left + right
    audit = ""
    while True:
        options = [(cost + values[after], letter, after) for letter, cost, after in _edits(symbol, state)]
        one, two = _NEXT[state], _NEXT[_NEXT[state]]
        here = min(options)[0]
        through = [min(cost + values[after] for _, cost, after in _edits(symbol, q)) for q in (one, two)]
        inserted = min(INSERT + through[0], 2 * INSERT + through[1])
        # ASCII order: D before I before K before R.
        if inserted < here or (inserted == here and min(o[1] for o in options if o[0] == here) > "I"):
            audit, state = audit + "I", one
            continue
        _, letter, after = min(o for o in options if o[0] == here)
        return after, audit + letter


def _ending(state: int) -> tuple[int, str]:
    """Turns inserted at the end, where the state is not a last one."""
    added = ""
    while state in (_SYSTEM, _USER):
        state, added = _NEXT[state], added + "I"
    return state, added


def unroll(runs: list[tuple[str, int]], state: int, values: tuple) -> tuple[int, str]:
    """State after the runs, and the edits: of the cheapest the ASCII-least. ``values``: costs after the runs."""
    pieces = [(symbol, k) for symbol, n in runs for k in reversed(_bits(n))]
    after = [values]
    for symbol, k in reversed(pieces[1:]):
        after.append(_times(power(symbol, k), after[-1]))
    audit = []
    for (symbol, k), known in zip(pieces, reversed(after)):
        least = min(known)
        state, part = _unroll(symbol, k, state, tuple(v - least for v in known))
        audit.append(part)
    return state, "".join(audit)


def illegal_pairs(runs: list[tuple[str, int]]) -> int:
    """Neighbouring rows whose initials are not su, ua or au."""
    letters = [initial(symbol) for symbol, _ in runs]
    return sum(n - 1 for _, n in runs) + sum(a + b not in ("su", "ua", "au") for a, b in zip(letters, letters[1:]))


def solve(runs: list[tuple[str, int]]) -> tuple[int, str, int]:
    """Cost, audit and illegal pairs of a whole conversation."""
    end = _closed(_ACCEPT)
    state, audit = unroll(runs, _START, end)
    return before(runs, end)[_START], audit + _ending(state)[1], illegal_pairs(runs)


@lru_cache(maxsize=100_000)
def _solved(runs: tuple[tuple[str, int], ...]) -> tuple[int, str, int]:
    return solve(list(runs))


#: The characters that are not part of words.
WHITE = " \t\n\x0b\f\r"

#: Runs up to which a conversation's result is remembered by a Python worker.
REMEMBERED_RUNS = 64


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``text``, ``copies`` of every row, damaged by crc32 of ``conv:turn`` modulo 20.

    0 drops the row (no copies), 1 empties its text, 2 takes out ``[.!?]``, 3 doubles it, 4 sets role user. Null values
    count as one space.
    """
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn, role, text)]
    kind = F.crc32(F.concat(filled[0], F.lit(":"), filled[1]).cast("binary")) % 20
    changed = rows.select(
        F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), filled[2].alias("role"), filled[3].alias("text"), kind.alias("kind"),
    )
    text_after = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    return changed.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), text_after.alias("text"),
        F.when(F.col("kind") == 0, 0).when(F.col("kind") == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def _symbol(fault: Column) -> Column:
    letter = F.substring("role", 1, 1)
    place = F.when(letter.isin("s", "u", "a"), letter).otherwise("x")
    return F.when(fault.isin("blank", "duplicate"), F.upper(place)).when(fault == "truncated", F.translate(place, WHOLE, CUT)).otherwise(place)


def faults(rows: DataFrame) -> DataFrame:
    """``conv``, ``turn``, ``role``, ``digest``, ``copies``, ``fault`` and ``symbol`` of the distinct rows of each conversation.

    The fault is that of the first copy (null if none); further copies of a row that is not blank are duplicates.
    A row has been seen if its role and text occur at a smaller turn, which is found by a minimum for each
    role and text, joined on all of its columns, so no row, text or conversation makes a hot key.
    """
    bare = F.rtrim("text", F.lit(WHITE))
    kept = rows.select(
        "conv", "turn", "role", "digest", "copies", (F.length(bare) == 0).alias("blank"), (~F.substring(bare, -1, 1).rlike("[.!?]")).alias("cut"),
    )
    at = F.struct(F.col("turn").isNotNull().alias("known"), F.coalesce("turn", F.lit(0)).alias("value"))
    first = kept.groupBy("conv", "role", "digest").agg(F.min(at).alias("first"))
    place = first.select(
        F.col("conv").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"),
        F.when(F.col("first.known"), F.col("first.value")).alias("t"),
    )
    same = F.col("conv").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    fault = F.when(F.col("blank"), "blank").when(F.col("d").isNull(), "duplicate").when(F.col("cut"), "truncated")
    judged = kept.join(place, same, "left").select("conv", "turn", "role", "digest", "copies", fault.alias("fault"))
    return judged.withColumn("symbol", _symbol(F.coalesce("fault", F.lit("none"))))


def _chunks(symbols: DataFrame) -> DataFrame:
    """``conv``, ``chunk``, ``runs`` (symbols) and ``lengths``: rows in order, in as many chunks as tasks met the conversation."""
    order = ["conv", "turn", "role", "digest"]
    tasks = int(symbols.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = symbols.repartitionByRange(tasks, *order).sortWithinPartitions(*order).select("conv", "symbol", "copies")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk, at, letters, lengths, ready, size = TaskContext.get().partitionId(), None, [], [], [], 0

        def made(kind: pa.DataType) -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.list_(pa.int64())]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), kinds)], ["conv", "chunk", "runs", "lengths"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, symbol, copies in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv,) != at:
                    if at:
                        ready.append((at[0], chunk, "".join(letters), lengths))
                        size += len(letters)
                        if len(ready) >= 8192 or size >= 1 << 20:
                            yield made(kind)
                            ready, size = [], 0
                    at, letters, lengths = (conv,), [], []
                # Copies after the first of a row are duplicates, which like blank rows have to go.
                for letter, n in ((symbol, 1), (symbol if symbol in GONE else GONE[WHOLE.index(initial(symbol))], copies - 1)):
                    if n and letters and letters[-1] == letter:
                        lengths[-1] += n
                    elif n:
                        letters.append(letter)
                        lengths.append(n)
        if at:
            ready.append((at[0], chunk, "".join(letters), lengths))
            yield made(kind)

    schema = f"conv {symbols.schema['conv'].dataType.simpleString()}, chunk long, runs string, lengths array<long>"
    return dealt.mapInArrow(run, schema)


def _audits(chunks: DataFrame) -> DataFrame:
    """``conv``, ``chunk``, ``audit``, ``cost``, ``illegal``; the last two add up over the chunks of a conversation.

    Only conversations cut by the edge of a task, and so at most as many as tasks, have several chunks; what
    they exchange is a 4 by 4 matrix a chunk and the state at its edges, never rows.
    """
    conv_type = chunks.schema["conv"].dataType.simpleString()
    chunks = materialise(chunks, "repair-chunks")
    edges = chunks.groupBy("conv").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    marked = chunks.join(edges.select(F.col("conv").alias("c"), "n"), F.col("conv").eqNullSafe(F.col("c")), "left").drop("c")
    names = ["conv", "chunk", "audit", "cost", "illegal"]
    schema = f"conv {conv_type}, chunk long, audit string, cost long, illegal long"

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            found = [_solved(tuple(zip(r, n))) if len(r) <= REMEMBERED_RUNS else solve(list(zip(r, n))) for r, n in both]
            columns = [pa.array([f[i] for f in found], t) for i, t in ((1, pa.string()), (0, pa.int64()), (2, pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], names)

    single = marked.filter(F.col("n").isNull()).drop("n").mapInArrow(whole, schema)

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, inside, ends = [], [], []
            for r, n in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                runs = list(zip(r, n))
                flat.append([v for row in matrix(runs) for v in row])
                inside.append(illegal_pairs(runs))
                ends.append(initial(r[0]) + initial(r[-1]))
            columns = [pa.array(flat, pa.list_(pa.int64())), pa.array(inside, pa.int64()), pa.array(ends)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["conv", "chunk", "steps", "inside", "ends"])

    cut = marked.filter(F.col("n").isNotNull()).drop("n")
    steps = cut.mapInArrow(summary, f"conv {conv_type}, chunk long, steps array<long>, inside long, ends string")

    def scan(found: pa.Table) -> pa.Table:
        found = found.sort_by("chunk")
        values, after, costs = _closed(_ACCEPT), [], []
        for flat in reversed(found["steps"].to_pylist()):
            after.append(values)
            values = _times(tuple(tuple(flat[4 * q : 4 * q + 4]) for q in range(4)), values)
        costs = [values[_START]] + [0] * (found.num_rows - 1)
        ends = found["ends"].to_pylist()
        edge = [0] + [int(a[1] + b[0] not in ("su", "ua", "au")) for a, b in zip(ends, ends[1:])]
        last = [False] * (found.num_rows - 1) + [True]
        illegal = [n + e for n, e in zip(found["inside"].to_pylist(), edge)]
        return pa.table({
            "conv": found["conv"], "chunk": found["chunk"], "after": pa.array([list(a) for a in reversed(after)], pa.list_(pa.int64())),
            "cost": pa.array(costs, pa.int64()), "illegal": pa.array(illegal, pa.int64()), "last": pa.array(last),
        })

    known = steps.groupBy("conv").applyInArrow(scan, f"conv {conv_type}, chunk long, after array<long>, cost long, illegal long, last boolean")
    known = known.withColumnsRenamed({"conv": "c", "chunk": "k"})
    met = cut.join(known, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k"))).drop("c", "k")

    def choices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's edits for each state it may begin in."""
        for batch in batches:
            audits, states = [], []
            for r, n, after, last in zip(*(batch.column(c).to_pylist() for c in ("runs", "lengths", "after", "last"))):
                found = [unroll(list(zip(r, n)), state, tuple(after)) for state in range(4)]
                if last:
                    found = [(_ending(state)[0], audit + _ending(state)[1]) for state, audit in found]
                states.append([state for state, _ in found])
                audits.append([audit for _, audit in found])
            columns = [pa.array(audits, pa.list_(pa.string())), pa.array(states, pa.list_(pa.int64()))]
            kept = [batch.column(c) for c in ("conv", "chunk", "cost", "illegal")]
            yield pa.RecordBatch.from_arrays(kept + columns, ["conv", "chunk", "cost", "illegal", "audits", "states"])

    tried = materialise(met.mapInArrow(choices, f"conv {conv_type}, chunk long, cost long, illegal long, audits array<string>, states array<long>"), "repair-choices")

    def chain(found: pa.Table) -> pa.Table:
        found = found.sort_by("chunk")
        state, begins = _START, []
        for after in found["states"].to_pylist():
            begins.append(state)
            state = after[state]
        return found.select(["conv", "chunk"]).append_column("begin", pa.array(begins, pa.int32()))

    begun = tried.select("conv", "chunk", "states").groupBy("conv").applyInArrow(chain, f"conv {conv_type}, chunk long, begin int")
    begun = begun.withColumnsRenamed({"conv": "c", "chunk": "k"})
    several = tried.join(begun, F.col("conv").eqNullSafe(F.col("c")) & (F.col("chunk") == F.col("k")))
    return single.unionByName(several.select("conv", "chunk", F.get("audits", F.col("begin")).alias("audit"), "cost", "illegal"))


def _hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """``conv``, ``audit`` and ``repaired_sha256``: the audit read along the rows, in order, hashing what stays.

    A task holds the audit of one conversation and one batch of texts, whatever the conversation's length.
    """
    conv_type = rows.schema["conv"].dataType.simpleString()
    texts = rows.select("conv", F.lit(None).cast("long").alias("chunk"), "turn", "role", "digest", "copies", "text")
    edits = audits.select("conv", "chunk", *[F.lit(None).cast(t).alias(n) for n, t in (("turn", "long"), ("role", "string"), ("digest", "string"), ("copies", "long"))], F.col("audit").alias("text"))
    order = ["conv", F.col("chunk").asc_nulls_last(), "turn", "role", "digest"]
    dealt = texts.unionByName(edits).repartition("conv").sortWithinPartitions(*order).select("conv", "chunk", "role", "copies", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, audit, place, state, digest, ready = None, "", 0, _START, None, []

        def add(role: str, text: str) -> None:
            digest.update(("" if state == _START else "\n").encode())
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))

        def inserted() -> None:
            nonlocal place, state
            while audit[place : place + 1] == "I":
                after = _NEXT[state]
                add("user" if after == _USER else "assistant", "")
                place, state = place + 1, after

        def close() -> None:
            inserted()
            ready.append((at[0], audit, digest.hexdigest()))

        def made(kind: pa.DataType) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*ready), (kind, pa.string(), pa.string()))], ["conv", "audit", "repaired_sha256"])

        for batch in batches:
            kind = batch.schema.field(0).type
            for conv, chunk, role, copies, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (conv,) != at:
                    if at:
                        close()
                    at, audit, place, state, digest = (conv,), "", 0, _START, hashlib.sha256()
                if chunk is not None:
                    audit += text
                    continue
                left = copies
                while left:
                    inserted()
                    letter, place, left = audit[place], place + 1, left - 1
                    if letter == "D":
                        # The other copies of a row are never kept, and no turn is inserted among rows that go.
                        run_of = len(audit[place : place + left]) - len(audit[place : place + left].lstrip("D"))
                        place, left = place + run_of, left - run_of
                        continue
                    after = _NEXT[state] if letter == "R" else _KEEPS[state, role[0]]
                    add(("user" if after == _USER else "assistant") if letter == "R" else role, text)
                    state = after
            if len(ready) >= 4096:
                yield made(kind)
                ready = []
        if at:
            close()
        if ready:
            yield made(kind)

    return dealt.mapInArrow(run, f"conv {conv_type}, audit string, repaired_sha256 string")


def repair(damaged: DataFrame) -> DataFrame:
    """One row for each ``conv`` of ``damaged``: its faults, the cheapest edits, and a hash of the repaired rows.

    ``damaged``: ``conv``, ``turn``, ``role``, ``text``, ``copies``, where ``copies`` (0 or more) says how often the row
    stands there; further columns are not read. Rows come in order of turn, nulls first, ties by role, then by the text's SHA-256,
    so copies are neighbours. A null ``conv`` is a conversation; a null role or text is not expected
    (``damage`` fills them). Conversations without copies give zeros, an empty audit and the hash of nothing; an
    empty table gives an empty table.

    Rows that are equal are counted before they travel. Conversations are cut into chunks where the ranges
    of rows that tasks sort end, so one with any share of all rows is spread over many tasks; only its audit and
    its hash, which run from first to last, are put together in order, one batch at a time.
    """
    rows = damaged.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("digest", F.sha2("text", 256))
    rows = materialise(rows, "repair-rows")
    there = rows.filter(F.col("copies") > 0)
    judged = materialise(faults(there), "repair-faults")
    again = F.when(F.col("fault") == "blank", 0).otherwise(F.col("copies") - 1)
    counts = judged.groupBy("conv").agg(
        (F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")).alias("gaps"),
        F.sum(F.when(F.col("fault") == "blank", F.col("copies")).otherwise(0)).alias("blank"),
        F.sum(F.when(F.col("fault") == "duplicate", 1).otherwise(0) + again).alias("duplicate"),
        F.sum(F.when(F.col("fault") == "truncated", 1).otherwise(0)).alias("truncated"),
    )
    audits = materialise(_audits(_chunks(judged)), "repair-audits")
    sums = audits.groupBy("conv").agg(F.sum("cost").alias("cost"), F.sum("illegal").alias("illegal"))
    hashes = _hashes(there, audits)
    joined = rows.select("conv").distinct()
    for part, name in ((counts, "a"), (sums, "b"), (hashes, "c")):
        joined = joined.join(part.withColumnRenamed("conv", name), F.col("conv").eqNullSafe(F.col(name)), "left").drop(name)
    zero = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return joined.select("conv", *zero, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))


ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
    lambda acc, k: CASE WHEN acc & 1 = 1 THEN xor(acc >> 1, 3988292384) ELSE acc >> 1 END)) AS steps
), filled AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '') AS letters
  FROM conversations
), hit AS (
  SELECT conv_id, turn, role, text, xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], list_transform(letters, lambda c: ascii(c)::BIGINT)),
    lambda acc, b: xor(steps[(xor(acc, b) & 255) + 1], acc >> 8))) % 20 AS kind
  FROM filled, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM hit
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS i, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
  FROM damaged
), judged AS (
  SELECT *, CASE WHEN bare = '' THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(right(bare, 1), '[.!?]') THEN 'truncated' END AS fault,
         substr(role, 1, 1) AS initial, lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS previous
  FROM placed
), counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM judged GROUP BY conv_id
), best AS (
  SELECT conv_id, n AS i, [{'c': 0, 't': ''}, {'c': 10, 't': 'II'}, {'c': 5, 't': 'I'}, {'c': 0, 't': ''}] AS v FROM counts
  UNION ALL
  SELECT conv_id, i, [list_min([o[1], {'c': o[3].c + 5, 't': 'I' || o[3].t}, {'c': o[4].c + 10, 't': 'II' || o[4].t}]),
                      list_min([o[2], {'c': o[3].c + 5, 't': 'I' || o[3].t}, {'c': o[4].c + 10, 't': 'II' || o[4].t}]),
                      list_min([o[3], {'c': o[4].c + 5, 't': 'I' || o[4].t}, {'c': o[3].c + 10, 't': 'II' || o[3].t}]),
                      list_min([o[4], {'c': o[3].c + 5, 't': 'I' || o[3].t}, {'c': o[4].c + 10, 't': 'II' || o[4].t}])] AS v
  FROM (
    SELECT b.conv_id, b.i - 1 AS i, list_transform([1, 2, 3, 4], lambda q: list_min(list_filter([
        {'c': v[q].c + 2, 't': 'D' || v[q].t},
        CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate') AND [q::VARCHAR || initial] && ['1s', '1u', '2u', '3a', '4u']
             THEN {'c': v[CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].c + extra, 't': 'K' || v[CASE initial WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END].t} END,
        CASE WHEN coalesce(fault, '') NOT IN ('blank', 'duplicate')
             THEN {'c': v[CASE q WHEN 3 THEN 4 ELSE 3 END].c + 1 + extra, 't': 'R' || v[CASE q WHEN 3 THEN 4 ELSE 3 END].t} END
      ], lambda x: x IS NOT NULL))) AS o
    FROM best b JOIN (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM judged) j ON j.conv_id IS NOT DISTINCT FROM b.conv_id AND j.i = b.i
  )
), audits AS (SELECT conv_id, v[1].c::BIGINT AS cost, v[1].t AS audit FROM best WHERE i = 0
), edits AS (
  SELECT conv_id, place, substr(audit, place, 1) AS edit, length(replace(substr(audit, 1, place), 'I', '')) AS i
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS place FROM audits)
), kept AS (
  SELECT e.conv_id, e.edit, row_number() OVER w AS o, j.role, CASE WHEN e.edit = 'I' THEN '' ELSE j.text END AS text,
         CASE WHEN first_value(e.edit) OVER w = 'K' AND first_value(j.initial) OVER w = 's' THEN 1 ELSE 0 END AS led
  FROM edits e LEFT JOIN judged j ON j.conv_id IS NOT DISTINCT FROM e.conv_id AND j.i = e.i
  WHERE e.edit <> 'D' WINDOW w AS (PARTITION BY e.conv_id ORDER BY e.place)
), hashes AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN edit = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY o)) AS repaired
  FROM kept GROUP BY conv_id
)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN audits d ON d.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN hashes h ON h.conv_id IS NOT DISTINCT FROM a.conv_id
"""

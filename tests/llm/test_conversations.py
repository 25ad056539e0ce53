"""Repair, formatting and hard negatives against plain Python."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib

import pytest

from corpusloom.llm import chat, hard_negatives, repair

TURNS = "conv_id long, turn long, role string, text string, conv string, copies string, symbol int, digest int, chunk int, part int, n int"
EXTRA = ("c", "k", 1, 2, 3, 4, 5)


def conversations(seed: int = 3, n: int = 40) -> list[tuple]:
    rng = random.Random(seed)
    roles, texts = ["user", "assistant", "user", "assistant", "system", "tool", "", "agent", None], ["Yes.", "no", "why? ", "a.b", "", " \n\t", None, "x!"]
    out = []
    for conv in range(n):
        plain = rng.random() < 0.5
        for turn in range(rng.randint(1, 9)):
            role = ("user", "assistant")[turn % 2] if plain else rng.choice(roles)
            out.append((conv, turn if rng.random() < 0.9 else rng.choice([None, 3, 3, 70]), role, rng.choice(texts) if rng.random() < 0.6 else f"t{turn}."))
    out += [out[5], out[5], out[6], (None, 0, "user", "hi."), (None, 1, "assistant", "ho."), (None, None, None, None)]
    out += [(500, None, "user", "a"), (501, 4, "system", "only."), (502, 1, "assistant", "x" * 100_000 + " " * 100_000 + ".")]
    # One conversation with most rows: it is cut where tasks end.
    out += [(600, i // 2, rng.choice(["user", "user", "assistant", "tool"]), rng.choice(["Go.", f"{i}.", f"{i}", ""])) for i in range(700)]
    return out + [(601, 7, "user", "Same.")] * 300


def table(spark, rows, parts=4):
    return spark.createDataFrame([(*r, *EXTRA) for r in rows], TURNS).repartition(parts)


def order(row):
    _, turn, role, text = row
    return (turn is not None, turn or 0, role.encode(), hashlib.sha256(text.encode()).hexdigest())


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def plain_repair(rows) -> tuple:
    """Row by row, (cost, audit) pairs compared as such, turns inserted one after the other."""
    rows = sorted(rows, key=order)
    seen, fault = set(), []
    for _, _, role, text in rows:
        bare = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    goes = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    then = {"": "u", "s": "u", "u": "a", "a": "u"}

    def insert(best):
        for _ in range(3):
            best = {q: min(best[q], (best[then[q]][0] + 5, "I" + best[then[q]][1])) for q in best}
        return best

    best = insert({"": (0, ""), "a": (0, ""), "s": (math.inf, ""), "u": (math.inf, "")})
    for (_, _, role, _), f in zip(reversed(rows), reversed(fault)):
        new = {}
        for q in best:
            ways = [(2 + best[q][0], "D" + best[q][1])]
            if f not in ("blank", "duplicate"):
                more = 5 if f else 0
                if role[:1] in goes[q]:
                    after = best[goes[q][role[:1]]]
                    ways.append((after[0] + more, "K" + after[1]))
                ways.append((best[then[q]][0] + 1 + more, "R" + best[then[q]][1]))
            new[q] = min(ways)
        best = insert(new)
    cost, audit = best[""]
    out, state, at = [], "", 0
    for letter in audit:
        if letter == "I":
            state = then[state]
            out.append(("user" if state == "u" else "assistant") + ":")
            continue
        _, _, role, text = rows[at]
        at += 1
        if letter != "D":
            state = then[state] if letter == "R" else goes[state][role[0]]
            out.append((role if letter == "K" else "user" if state == "u" else "assistant") + ":" + text)
    turns = [r[1] for r in rows if r[1] is not None]
    illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults = [fault.count(f) for f in ("blank", "duplicate", "truncated")]
    return gaps, *faults, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest()


def test_repair_equals_plain_python(spark):
    rows = conversations()
    want = {c: plain_repair([r for r in damaged(rows) if r[0] == c]) for c in {r[0] for r in rows}}
    got = repair.repair(repair.damage(table(spark, rows))).collect()
    assert {r[0]: tuple(r[1:]) for r in got} == want and len(got) == len(want)
    assert any(not v[6] for v in want.values()) and {*"".join(v[6] for v in want.values())} == set("DKR")


def test_a_conversation_is_cut_into_chunks(spark):
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], f"{i}.") for i in range(400)] + [(2, 0, "user", "a.")]
    damage = repair.damage(table(spark, rows))
    counted = damage.groupBy("conv", "turn", "role", "text").agg({"copies": "sum"}).withColumnRenamed("sum(copies)", "copies")
    from pyspark.sql import functions as F

    chunks = repair._chunks(repair.faults(counted.withColumn("digest", F.sha2("text", 256)).filter("copies > 0")))
    assert chunks.filter("conv = 1").count() > 2
    got = {r[0]: tuple(r[1:]) for r in repair.repair(damage).collect()}
    assert got == {c: plain_repair([r for r in damaged(rows) if r[0] == c]) for c in (1, 2)}


def test_repair_of_empty_tables(spark):
    assert repair.repair(repair.damage(table(spark, []))).collect() == []


def test_long_runs_take_binary_powers():
    cost, audit, illegal = repair.solve([("U", 1 << 20), ("u", 1 << 20), ("a", 3)])
    assert len(audit) >= (1 << 21) and cost >= 1 << 21 and illegal == (1 << 21) - 1 + 2
    for symbols in itertools.product("suax1234U", repeat=4):
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        whole = repair.solve(runs)
        # The same through two chunks.
        end = repair._closed(repair._ACCEPT)
        middle = repair.before(runs[1:], end)
        state, left = repair.unroll(runs[:1], repair._START, middle)
        state, right = repair.unroll(runs[1:], state, end)
        assert left + right + repair._ending(state)[1] == whole[1]
        assert repair._times(repair.matrix(runs), end)[repair._START] == whole[0]


@pytest.fixture
def cheap_insertions(monkeypatch):
    """With the fixed costs an insertion never pays, so its branch is tested with others."""
    caches = (repair._edits, repair.power, repair._unroll, repair._solved)
    monkeypatch.setattr(repair, "INSERT", 1)
    monkeypatch.setattr(repair, "REROLE", 2)
    for c in caches:
        c.cache_clear()
    yield
    monkeypatch.undo()
    for c in caches:
        c.cache_clear()


def test_insertions_equal_a_search(cheap_insertions):
    def cheapest(symbols, state="", spare=3):
        """All edits of the rows, up to three insertions in a row."""
        then = {"": "u", "s": "u", "u": "a", "a": "u"}
        ways = [(0, "")] if not symbols and state in ("", "a") else []
        if spare:
            ways += [(1 + c, "I" + t) for c, t in cheapest(symbols, then[state], spare - 1)]
        if symbols:
            symbol, rest = symbols[0], symbols[1:]
            ways += [(2 + c, "D" + t) for c, t in cheapest(rest, state)]
            if not symbol.isupper():
                more = 5 if symbol.isdigit() else 0
                if repair.initial(symbol) in {"": "su", "s": "u", "u": "a", "a": "u"}[state]:
                    ways += [(more + c, "K" + t) for c, t in cheapest(rest, repair.initial(symbol))]
                ways += [(2 + more + c, "R" + t) for c, t in cheapest(rest, then[state])]
        return [min(ways)] if ways else []

    used = ""
    for symbols in itertools.product("suax2A", repeat=3):
        runs = [(s, len(list(g))) for s, g in itertools.groupby(symbols)]
        assert [repair.solve(runs)[:2]] == cheapest(symbols)
        used += repair.solve(runs)[1]
    assert set(used) == set("DIKR")


PIECES = ["###", "</turn>", "\\", "\\\\", "#", " ", "\n", "a", "</", "turn>", "### ", " ###\n", "\n</turn>\n", "é", "日", ""]


def test_round_trip_of_conflicting_content():
    rng = random.Random(5)
    for _ in range(3000):
        turns = [tuple("".join(rng.choices(PIECES, k=rng.randint(0, 7))) for _ in range(2)) for _ in range(3)]
        rendered = "".join(chat.render_turn(*t)[0] for t in turns)
        spans = list(chat.parse(rendered))
        assert [(s.role, s.text) for s in spans] == turns
        assert all(s.text == rendered[s.start : s.stop] or "\\" in rendered[s.start : s.stop] for s in spans)


def test_clean_text_is_not_changed():
    assert chat.render_turn("user", r"a \ b # </x>")[0] == "### user ###\na \\ b # </x>\n</turn>\n"


@pytest.mark.parametrize("broken", ["x", "### user", "### user ###\nhi", "### user ###hi\n</turn>\n", "### u </turn> ###\n", "### a ###\n###\n</turn>\n"])
def test_broken_texts_are_refused(broken):
    with pytest.raises(chat.NotATurn):
        list(chat.parse(broken))


def plain_digest(rows) -> tuple:
    rows = sorted([(c, t, r or "", x or "") for c, t, r, x in rows], key=order)
    turns = "".join(f"{r}\n{x}\n" for _, _, r, x in rows)
    loss = "".join(x for _, _, r, x in rows if r == "assistant")
    size = sum(len("###  ###\n\n</turn>\n") + len(chat.escape(r)) + len(chat.escape(x)) for _, _, r, x in rows)
    return len(rows), hashlib.sha256(turns.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), size


@pytest.mark.parametrize("part_chars", [1, 60, 1 << 20])
def test_formatted_conversations_read_back(spark, part_chars):
    rows = conversations() + [(-7, 0, "user", chat.PLANTED[1]), (-7, 1, "assistant", chat.PLANTED[1])]
    rows += [(700, 0, "assistant", "x### \\</turn>" * 60_000), (700, 1, "###", "\\"), (700, 2, "a: \\", "### ###")]
    parts = chat.format_turns(table(spark, rows), part_chars=part_chars)
    got = {r[0]: tuple(r[1:]) for r in chat.read_back(parts).collect()}
    assert got == {c: plain_digest([r for r in rows if r[0] == c]) for c in {r[0] for r in rows}}
    starts = {(r.conv, r.part): r.start for r in chat.part_starts(parts).collect()}
    at: dict = {}
    for r in sorted(parts.collect(), key=lambda r: r.part):
        assert starts[r.conv, r.part] == at.get(r.conv, 0)
        at[r.conv] = at.get(r.conv, 0) + len(r.text)


def test_format_of_empty_tables(spark):
    assert chat.read_back(chat.format_turns(table(spark, []))).collect() == []


VECTORS = "vec_id long, embedding array<float>, label int, id string, v int, block int, part int, anchor_id int, place int"


def vectors(seed: int = 9, n: int = 400, dim: int = 6) -> list[tuple]:
    rng = random.Random(seed)
    out = [(i, [rng.choice([0.0, -0.5, 0.25, rng.gauss(0, 1)]) for _ in range(dim)], rng.randrange(10)) for i in range(n)]
    out += [(1000 + i, out[100][1], i % 3) for i in range(40)]  # one very common vector
    out += [(2000, None, 1), (2001, [1.0] * dim, None), (2002, [1.0, None, 0, 0, 0, 0], 1), (2003, [math.nan] * dim, 1), (2004, [math.inf] * dim, 1)]
    out += [(2100, [0.0] * dim, 2), (2200, [], 3), (2300, [1.0, -2.0], 4), (None, [1.0] * dim, 4), out[200], out[200]]
    return out


def plain_negatives(rows, floor=lambda x: math.floor(256 * x)) -> list[tuple]:
    kept = {}
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept[i] = ((label + 1) % 10 if i % 7 == 0 else label, [floor(x) for x in v])
    out = []
    for a, (label, v) in kept.items():
        if a % 100:
            continue
        score = {i: sum(x * y for x, y in zip(v, w)) for i, (_, w) in kept.items() if i != a}
        ranked = sorted(score, key=lambda i: (-score[i], i))
        for p in [i for i in ranked if kept[i][0] == label][:5]:
            fits = [i for i in ranked if kept[i][0] != label and 30 * score[p] <= 100 * score[i] <= 90 * score[p]]
            out += [(a, p, k + 1, i, score[p], score[i]) for k, i in enumerate(fits[:10])]
    return sorted(out)


def embeddings(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3, 4, 5) for r in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("block, anchors", [(4096, 1024), (50, 2)])
def test_hard_negatives_equal_plain_python(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "BLOCK_ANCHORS", anchors)
    rows = [(i, v and [x if x is None else float(f"{x:.3f}") for x in v], label) for i, v, label in vectors()]
    import numpy as np

    single = [(i, v and [x if x is None else float(np.float32(x)) for x in v], label) for i, v, label in rows]
    got = hard_negatives.mine(embeddings(spark, rows), label_rule=hard_negatives.moved_labels())
    assert sorted(map(tuple, got.collect())) == plain_negatives(single)
    assert len(plain_negatives(single)) > 50


def test_hard_negatives_of_large_components(spark):
    """Bounds beyond 64 bits, scores within; and scores beyond, which are cut off."""
    rows = [(100, [0.0, 1.0], 3), (200, [0.0, -2.0], 3)] + [(i, [2.0**50, i / 8], i % 10) for i in range(1, 90)]
    got = hard_negatives.mine(embeddings(spark, rows), label_rule=hard_negatives.moved_labels())
    assert sorted(map(tuple, got.collect())) == plain_negatives(rows) != []
    rows = [(100 * i, [2.0**40], 1) for i in range(4)]
    assert hard_negatives.mine(embeddings(spark, rows)).collect() == []


def test_hard_negatives_of_empty_tables(spark):
    assert hard_negatives.mine(embeddings(spark, [])).collect() == []
    assert hard_negatives.mine(embeddings(spark, [(100, [1.0], 1)])).collect() == []


def test_the_threshold_stops_before_the_end():
    import numpy as np

    rng = np.random.default_rng(1)
    lists = hard_negatives.SortedLists(rng.integers(-500, 500, (20_000, 2)).astype(np.float64), np.arange(20_000))
    anchor, read = np.array([300.0, -200.0]), 0
    for rows, scores, threshold in lists.walk(anchor):
        read += len(rows)
        rest = np.setdiff1d(np.arange(20_000), rows)
        if threshold is not None and threshold < 100_000:
            break
    assert read < 20_000 and len(rest)
    labels = rng.integers(0, 3, 20_000)
    ids, scores = hard_negatives.nearest_same(lists, labels, anchor, 7, 1, 5)
    all_scores = lists.vectors @ anchor
    same = np.flatnonzero((labels == 1) & (np.arange(20_000) != 7))
    want = same[np.lexsort((same, -all_scores[same]))[:5]]
    assert ids.tolist() == want.tolist() and scores.tolist() == all_scores[want].tolist()

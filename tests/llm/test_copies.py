"""Near duplicates and repeated passages against plain Python."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pyarrow as pa

from corpusloom.llm import arrow_text, bagminhash, suffix_dedup
from tests.llm import data


def shingles(text: str | None) -> collections.Counter:
    words = data.words(text)
    return collections.Counter(tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1))))


def similarity(a: collections.Counter, b: collections.Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def plain_classes(rows: list[tuple]) -> dict[int, int]:
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if rows[a][0] == rows[b][0] and rows[a][1] == rows[b][1] or sets[a] and similarity(sets[a], sets[b]) >= 0.8:
                parent[root(a)] = root(b)
    first: dict[int, int] = {}
    for i, r in enumerate(rows):
        first[root(i)] = min(first.get(root(i), r[0]), r[0])
    return {r[0]: first[root(i)] for i, r in enumerate(rows)}


def near_copies(n: int, edits: int, seed: int, words: int = 150, start: int = 1000) -> list[tuple]:
    rng = random.Random(seed)
    base = data.prose(rng, words).split()
    out = []
    for i in range(n):
        own = list(base)
        for k in rng.sample(range(words), rng.randint(0, edits)):
            own[k] = f"x{rng.randrange(10**6)}"
        out.append((start + i, " ".join(own), "en", "s"))
    return out


def test_signatures_estimate_the_weighted_similarity():
    rng = random.Random(1)
    base = [f"w{rng.randrange(300)}" for _ in range(400)] + ["a"] * 60
    texts = [" ".join(base), " ".join(base[:-60]), " ".join(base + ["a"] * 120), " ".join(base[:200] + ["q"] + base[201:]), "one"]
    words = arrow_text.words_of(*arrow_text.text_bytes(pa.array(texts)))
    signs = bagminhash.signatures(*bagminhash.multisets(words), len(texts), places=6000)
    sets = [shingles(t) for t in texts]
    for i in range(1, len(texts)):
        assert abs(float((signs[0] == signs[i]).mean()) - similarity(sets[0], sets[i])) < 0.03
    pairs = [arrow_text.words_of(*arrow_text.text_bytes(pa.array(x))) for x in ([texts[0]] * 4, texts[1:])]
    assert np.allclose(bagminhash.similarity(*pairs), [similarity(sets[0], s) for s in sets[1:]])


def test_classes_equal_plain_comparison(spark, monkeypatch):
    monkeypatch.setattr(bagminhash, "BLOCK", 7)  # so that left-over members meet in several blocks
    groups = near_copies(25, 4, 1) + near_copies(25, 2, 2, start=1100) + near_copies(12, 9, 3, start=1200)
    short = [(1300, "one two", "en", "s"), (1301, "one  two", "en", "s"), (1302, "one two three", "en", "s")]
    long = [(1400, data.prose(random.Random(9), 8000), "en", "s")]
    rows = [r for r in data.rows() if r[0] is not None] + groups + short + long + [(1401, long[0][1] + " end", "en", "s")]
    docs = data.documents(spark, rows)
    want = plain_classes(rows)
    got = bagminhash.near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in got} == want
    assert len(set(want.values())) < len(want) - 30
    for r in got:
        assert r["kept"] == (r["doc_id"] == r["class_id"])
    kept = bagminhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_pairs_just_below_the_limit_hide_no_link(spark):
    base = [f"w{i}" for i in range(1000)]

    def edited(mark: str, places: list[int]) -> str:
        return " ".join(f"{mark}{i}" if i in places else w for i, w in enumerate(base))

    far = [edited(f"f{k}x", [10 + k + 40 * i for i in range(22)] + [998]) for k in range(20)]
    texts = [" ".join(base), *far, edited("n", [10 + 40 * i for i in range(16)])]
    near = [similarity(shingles(texts[0]), shingles(t)) for t in texts[1:]]
    assert all(0.795 <= x < 0.8 for x in near[:-1]) and near[-1] > 0.84
    table = spark.createDataFrame([(bytes([k]), t) for k, t in enumerate(texts)], "node binary, text string").coalesce(1)
    names = bagminhash.shingle_sets(table)
    kind = np.uint64 if len(names.first()["shingles"]) == 8 * 996 else np.uint32
    sets = [np.frombuffer(r["shingles"], kind) for r in names.orderBy("node").collect()]
    roots = np.array([1] * (len(texts) - 1))
    assert bagminhash._links(sets[:1], sets[1:], np.array([0]), roots) == [(0, len(texts) - 2)]
    # The same through the tables: the text stands alone, the others are in one component already.
    members = table.selectExpr("1L as band", "node")
    labels = spark.createDataFrame([(bytes([k]), bytes([1])) for k in range(1, len(texts))], "node binary, root binary")
    found = bagminhash.verified(bagminhash.left_over_pairs(members, labels, names), table).collect()
    assert [(bytes(r["a"]), bytes(r["b"])) for r in found] == [(b"\0", bytes([len(texts) - 1]))]


def test_rows_without_ids_and_empty_tables(spark):
    docs = data.documents(spark, [(None, "a b c d e f", "en", "s"), (None, None, "en", "s"), (None, "a b c d e f", "en", "s")])
    assert bagminhash.near_duplicates(docs).count() == 3
    assert bagminhash.one_of_each(docs).count() == 2
    assert bagminhash.near_duplicates(data.empty(spark)).collect() == []
    assert bagminhash.one_of_each(data.empty(spark)).collect() == []


# ---- repeated passages -----------------------------------------------------------------------


def plain_removal(rows: list[tuple], length: int) -> dict:
    bodies = [(r[1] or "").encode() for r in rows]
    count = collections.Counter(b[i : i + length] for b in bodies for i in range(len(b) - length + 1))
    out = {}
    for r, b in zip(rows, bodies):
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        gone = np.cumsum(gone[:-1]) > 0 if len(b) else np.zeros(0, bool)
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[r[0]] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def passages(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    common = [data.prose(rng, n) for n in (60, 40, 33, 30)]
    out = []
    for i in range(30):
        parts = [data.prose(rng, rng.randint(1, 60)) for _ in range(3)] + rng.sample(common, rng.randint(0, 3))
        rng.shuffle(parts)
        out.append((2000 + i, " ".join(parts), "en", "s"))
    out += [(2100, "ab" * 400, "en", "s"), (2101, "z" * 199, "en", "s"), (2102, "z" * 199, "en", "s"), (2103, "y" * 200, "en", "s"), (2104, "y" * 200, "en", "s")]
    edge = data.prose(rng, 80)
    out += [(2105, edge[:200], "en", "s"), (2106, "é" + edge[:200], "en", "s"), (2107, edge[1:201] + "q", "en", "s"), (2108, "日本語" * 60 + edge[:230], "en", "s")]
    return out


def removed(df) -> dict:
    return {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in df.collect()}


def test_removal_equals_plain_search(spark, monkeypatch):
    rows = [r for r in data.rows() if r[0] is not None] + passages(1) + near_copies(12, 2, 5, start=2500)
    docs = data.documents(spark, rows)
    want = plain_removal(rows, 200)
    assert sum(w[1] for w in want.values()) > 5000
    assert removed(suffix_dedup.remove_repeats(docs)) == want
    # Batches, merged levels and the path for very large groups change nothing.
    monkeypatch.setattr(suffix_dedup, "GROUP", 2)
    assert removed(suffix_dedup.remove_repeats(docs, batches=3)) == want


def test_levels_merge_geometrically(spark):
    family = suffix_dedup.SuffixFamily(spark)
    for k in range(5):
        family.add(data.documents(spark, passages(k)[:5]))
    assert sorted(family.levels) == [0, 2]


def test_anchors_are_the_same_in_equal_passages():
    rng = np.random.default_rng(0)
    passage = rng.integers(97, 123, 200, dtype=np.uint8)
    for trial in range(20):
        texts = [np.concatenate([rng.integers(97, 123, rng.integers(0, 300), dtype=np.uint8), passage, rng.integers(97, 123, rng.integers(0, 300), dtype=np.uint8)]) for _ in range(2)]
        keys = [set(suffix_dedup.anchors(t, np.array([0, len(t)]))["key"].tolist()) for t in texts]
        assert keys[0] & keys[1]


def test_no_rows_and_no_texts(spark):
    assert removed(suffix_dedup.remove_repeats(data.empty(spark))) == {}
    none = hashlib.sha256(b"").hexdigest()
    docs = data.documents(spark, [(1, None, None, None), (2, "", "en", "s")])
    assert removed(suffix_dedup.remove_repeats(docs)) == {1: (0, 0, 0, none), 2: (0, 0, 0, none)}

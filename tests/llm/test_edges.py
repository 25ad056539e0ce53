"""Rows that once gave wrong or unbounded results."""

from __future__ import annotations

import base64
import collections
import math
import random
import re
import time
import tracemalloc

import numpy as np
import public_tokenizers

from corpusloom.llm import bagminhash, neighbours, pieces, secret_scan
from corpusloom.llm import url_filter
from corpusloom.llm.queries import URL_RULES
from tests.llm.data import documents, prose
from tests.llm.test_tables import plain_verdicts, urls


def test_texts_that_look_like_names_of_blank_ones(spark):
    rows = [(5, None, "en", "a"), (6, "", "en", "a"), (7, "no words 5", "en", "a"), (8, "no words 6", "en", "a"), (9, " \t", "en", "a"), (None, "", "en", "a")]
    df = documents(spark, rows)
    got = {r.doc_id: (r.class_id, r.class_size) for r in bagminhash.near_duplicates(df).collect()}
    assert got == {i: (i, 1) for i in (5, 6, 7, 8, 9, None)}
    assert bagminhash.one_of_each(df).count() == 6


def test_collinear_vectors_tie_by_id(spark):
    rows = [(i, [1.0 * 2**i, -1.0 * 2**i]) for i in range(30)] + [(100 + i, [1.0, 0.5 * i]) for i in range(10)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {}
    for r in neighbours.nearest(df, every=10).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
    assert [v for _, v in sorted(got[0])] == [1, 2, 3, 4, 5]
    assert [v for _, v in sorted(got[10])] == [0, 1, 2, 3, 4]
    assert [v for _, v in sorted(got[20])] == [0, 1, 2, 3, 4]


def test_long_shared_paths_do_not_multiply(spark):
    schema = "page_id long, url string"
    for n, support, limit in ((5, 0.02, None), (40, 0.002, 60)):
        # A dictionary word per segment, since digits count as one token.
        words = ["".join("abcdefghij"[int(c)] for c in f"{i:03d}") for i in range(n)]
        site = [f"http://site.example.com/de/{'/'.join(words)}/end{'abc'[i]}" for i in range(3)]
        partly = [f"http://other.net/{words[1]}/x", f"http://other.net/{words[-1]}/{words[0]}"]
        all_urls = urls()[:250] + site + site[:1] + partly
        start = time.perf_counter()
        rows = url_filter.judge_urls(spark.createDataFrame(list(enumerate(all_urls)), schema), URL_RULES, support=support, confidence=0.8).collect()
        got = [r.verdict for r in sorted(rows, key=lambda r: r.page_id)]
        if limit is None:
            assert got == plain_verdicts(all_urls, support, 0.8)
        else:
            assert time.perf_counter() - start < limit
            assert got[-2:] == ["block", "block"]  # any token of the site's path says the same


def test_a_long_text_takes_bounded_memory(spark):
    model = pieces.read_model(spark, str(public_tokenizers.path("piece_bpe_32k.model")))
    rng = random.Random(2)
    long = " ".join(prose(rng, 2000) for _ in range(300)).encode()
    data, offsets = np.frombuffer(long, np.uint8), np.array([0, len(long)])
    tracemalloc.start()
    ids, count = model.encode(data, offsets)
    body, ends = model.decode(ids, count)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert body.tobytes() == long and ends.tolist() == [0, len(long)]
    assert peak < 50 * len(long) + 100 * pieces.PART_BYTES
    # The same ids as those of its words on their own.
    few = long[:2000].rsplit(b" ", 1)[0]
    assert model.encode(np.frombuffer(few, np.uint8), np.array([0, len(few)]))[0].tolist() == ids[: len(model.encode(np.frombuffer(few, np.uint8), np.array([0, len(few)]))[0])].tolist()


def plain_features(value: str, words: dict[str, int]) -> tuple[float, float]:
    """Transitions and coverage of a value from their definitions."""
    pairs, firsts = collections.Counter(), collections.Counter()
    for word, n in words.items():
        for a, b in zip(word, word[1:]):
            pairs[a + b] += n
            firsts[a] += n
    low = re.sub("[A-Z]", lambda m: m[0].lower(), value)
    steps = [math.log((pairs[a + b] + 1) / (firsts[a] + 64)) if pairs[a + b] else -10.0 for a, b in zip(low, low[1:])]
    spots = {i + k for i in range(len(low)) for n in range(3, 13) if len(low[i : i + n]) == n and low[i : i + n] in words for k in range(n)}
    return sum(steps) / len(steps) if steps else -10.0, len(spots) / max(1, len(value))


def test_features_of_values_equal_the_definition(spark):
    rng = random.Random(3)
    words = {"the": 5, "then": 2, "token": 9, "abcdefghijkl": 1, "ken": 3, "nth": 1}
    values = ["", "x", "theTOKENthen", "a1b2c3d4", "abcdefghijklm", "é" * 9 + "the", "𐍈then𐍈", "x" * 998 + "token" + "y" * 30, "x" * 1000, "the" * 700]
    values += ["".join(rng.choices("thenokTHE19/ ab", k=rng.randint(1, 2500))) for _ in range(20)]
    found = spark.createDataFrame([(v, f"b{i}", None) for i, v in enumerate(values + values[:3])], "value string, before string, after string")
    for known in (words, {}):
        table = spark.createDataFrame(list(known.items()), "word string, n long")
        rows = secret_scan.features(found, table).collect()
        assert len(rows) == len(values) + 3
        for r in rows:
            transitions, coverage = plain_features(r.value, known)
            assert math.isclose(r.transitions, transitions, abs_tol=1e-9) and math.isclose(r.coverage, coverage, abs_tol=1e-9), r.value[:50]


def test_a_very_long_run_takes_linear_time(spark):
    rng = random.Random(4)
    image = base64.b64encode(rng.randbytes(750_000)).decode()
    rows = [(1, f"see data:image/png;base64,{image} end", "en", "a"), (2, prose(rng, 300), "en", "a"), (3, 'token = "kJ8vQ2mZx9rTaa91"', "en", "a")]
    start = time.perf_counter()
    found = secret_scan.scan(documents(spark, rows)).collect()
    assert time.perf_counter() - start < 30
    assert max(len(r.value) for r in found) >= len(image) and {r.doc_id for r in found} == {1, 3}

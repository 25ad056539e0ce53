"""Token counts, quality rules, pieces and languages against the libraries and plain Python."""

from __future__ import annotations

import collections
import functools
import itertools
import math
import random
import string
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.llm import arrow_text, language, perplexity, pieces, token_counts
from corpusloom.llm.queries import tokenizer_path
from tests.llm import data


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


# ---- slices and words ------------------------------------------------------------------------


def test_words_slices_and_runs():
    texts = ["a b  a", None, "", " x\ny ", "é z"]
    column = pa.array(texts)
    found = arrow_text.words_of(*arrow_text.text_bytes(column))
    got = [[] for _ in texts]
    for code, doc in zip(found.code, found.doc):
        got[doc].append(found.distinct[int(code)].as_py().decode())
    assert got == [data.words(t) for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(["aaaa", "bb", None, "c" * 9, "d"])], ["t"])
    assert [p.column(0).to_pylist() for p in arrow_text.slices(batch, "t", 6)] == [["aaaa", "bb", None], ["c" * 9], ["d"]]
    assert list(arrow_text.slices(batch.slice(0, 0), "t")) == []


# ---- token counts ----------------------------------------------------------------------------


def test_token_counts_equal_the_library(spark):
    from tokenizers import Tokenizer

    special = [(200, "a<|endoftext|>b <|startoftext|> c", "en", "s"), (201, "it's WE'LL x y 123 Σας ÉÀ é", "en", "s")]
    docs = data.documents(spark, data.rows() + special)
    path = tokenizer_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    rows = token_counts.token_counts(docs, path, limit=100).collect()
    assert len(rows) == docs.count()
    texts = collections.defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"] or "")
    for r in rows:
        text = texts[r["doc_id"]][0]
        n = len(library.encode(text, add_special_tokens=False))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(text.encode()), n, n > 100)
    assert token_counts.token_counts(data.empty(spark), path).collect() == []


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(token_counts, "REMEMBERED", 3)
    path = tokenizer_path("word_bpe_49k.json")
    token_counts._known.clear()
    first = token_counts._piece_lengths(path, [b"abc", b"hello", b"x", b"yy", b"zzz"])
    assert len(token_counts._known[path]) <= 3
    assert (token_counts._piece_lengths(path, [b"abc", b"hello", b"x", b"yy", b"zzz"]) == first).all()
    token_counts._known.clear()


# ---- quality rules ---------------------------------------------------------------------------


def base_counts(text: str | None) -> tuple:
    words = data.words(text)
    windows = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    seen, again = set(), 0
    for line in (text or "").split("\n"):
        if data.words(line):
            again += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), again, len(inside)


def plain_grams(text: str | None) -> list[bytes]:
    line = b"".join(w.encode() + b" " for w in data.words(text))
    return [(bytes(perplexity.ORDER) + line)[i + 1 : i + 1 + perplexity.ORDER] for i in range(len(line))]


def plain_kneser_ney(texts: list):
    """Probability of the last byte of an n-gram after those before it, from the definition."""
    levels = {perplexity.ORDER: collections.Counter(g for t in texts for g in set(plain_grams(t)))}
    for order in range(perplexity.ORDER - 1, 0, -1):
        levels[order] = collections.Counter(g[1:] for g in levels[order + 1])
    cut, after = {}, collections.defaultdict(list)
    for order, level in levels.items():
        cut[order] = [0.0, *perplexity.discounts([sum(n == k for n in level.values()) for k in range(1, 5)])]
        if order > 1:
            cut[order][1] = 1.0
        for g, n in level.items():
            after[g[:-1], order].append(n)

    @functools.cache
    def p(gram: bytes) -> float:
        if not gram:
            return 1 / 256
        order = len(gram)
        others = after.get((gram[:-1], order))
        if not others:
            return p(gram[1:])
        n, d = levels[order].get(gram, 0), cut[order]
        return (n - d[min(n, 3)] + sum(d[min(x, 3)] for x in others) * p(gram[1:])) / sum(others)

    return p


def plain_log_perplexity(p, text: str | None) -> float | None:
    found = plain_grams(text)
    return -sum(math.log(p(g)) for g in found) / len(found) if found else None


def test_streams_and_grams(monkeypatch):
    texts = [" ab  c\n", None, "", "\t ", "é", "x y", "abcdefgh " * 3]
    for part in (5, 1 << 20):
        monkeypatch.setattr(perplexity, "PART", part)
        doc, code, n = perplexity.text_grams(*arrow_text.text_bytes(pa.array(texts)))
        got = [collections.Counter() for _ in texts]
        for d, c, k in zip(doc.tolist(), code.tolist(), n.tolist()):
            got[d][c.to_bytes(perplexity.ORDER, "big")] += k
        assert got == [collections.Counter(plain_grams(t)) for t in texts]


def test_kneser_ney_equals_the_definition(spark, monkeypatch):
    texts = [r[1] for r in data.rows()] + ["the other of the others", "\0 null bytes \0"]
    docs = data.documents(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    p = plain_kneser_ney(texts)
    model = perplexity.fit_kneser_ney(perplexity.materialise(perplexity.ngram_counts(docs, "text"), "counts"))
    table = {r["code"].to_bytes(perplexity.ORDER, "big"): r["log_p"] for r in model.collect()}
    assert set(table) == {g for t in texts for g in plain_grams(t)}
    assert all(math.isclose(v, math.log(p(g)), rel_tol=1e-9, abs_tol=1e-12) for g, v in table.items())
    # Probabilities after any context sum to one.
    for context in (b"the ", b" of ", bytes(perplexity.ORDER - 1), b"zzzz"):
        assert math.isclose(sum(p(context + bytes([b])) for b in range(256)), 1)
    # Sent to tasks or joined, every row gets the same perplexity.
    for rows in (perplexity.SENT_ROWS, 0):
        monkeypatch.setattr(perplexity, "SENT_ROWS", rows)
        got = {r["doc_id"]: r["log_perplexity"] for r in perplexity.quality_counts(docs, "doc_id", "text", "lang").collect()}
        for i, t in enumerate(texts):
            want = plain_log_perplexity(p, t)
            assert got[i] is None if want is None else math.isclose(got[i], want, rel_tol=1e-9)


def test_shuffled_words_and_noise_are_less_likely(spark):
    rng = random.Random(9)
    follow = {a: rng.sample(string.ascii_lowercase, 7) for a in string.ascii_lowercase}

    def ordered(n: int) -> list[str]:
        out = ["a"]
        while len(out) < n:
            out.append(rng.choice(follow[out[-1]]))
        return [c + "o" for c in out]

    texts = [ordered(120) for _ in range(60)]
    salad = rng.sample(texts[0], len(texts[0]))
    noise = ["".join(rng.choices(string.ascii_letters, k=5)) for _ in range(120)]
    rows = [(i, " ".join(t), "en", "s") for i, t in enumerate([*texts, salad, noise])]
    got = {r["doc_id"]: r for r in perplexity.quality_rules(data.documents(spark, rows)).collect()}
    assert got[60]["log_perplexity"] > max(got[i]["log_perplexity"] for i in range(60))
    assert not got[60]["kept"] and not got[61]["kept"]
    assert all(got[i]["kept"] for i in range(60))


def test_quality_rules(spark):
    odd = [(300, "same line here\nsame line here\n\n# * same line here", "en", "s"), (301, "| | " * 80, "en", "s")]
    noise = [(302, " ".join("xqzvkjwq"[i % 5 :] + "qx" * (i % 3) for i in range(90)), "en", "s")]
    base = [(i, data.prose(random.Random(i), 90), "en", "s") for i in range(400, 440)]
    docs = data.documents(spark, data.rows() + odd + noise + base)
    got = perplexity.quality_rules(docs).collect()
    assert len(got) == docs.count()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in got:
        n = base_counts(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        inside = r["low"] is not None and r["log_perplexity"] is not None and r["low"] <= r["log_perplexity"] <= r["high"]
        assert r["kept"] == (not r["base_failed"] and inside)
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not kept[302] and not kept[301] and not kept[103]
    assert all(kept[i] for i in range(400, 440))
    assert perplexity.quality_rules(data.empty(spark)).collect() == []


# ---- pieces ----------------------------------------------------------------------------------


def raw_model() -> bytes:
    with open(tokenizer_path("piece_bpe_32k.model"), "rb") as file:
        return file.read()


def plain_viterbi(model: pieces.PieceModel, text: str) -> list[int]:
    """Best path by trying every piece at every place; of equal sums the longest last piece."""
    body = (" " + text).replace("▁", " ").encode() if text else b""
    known = {p.replace("▁".encode(), b" "): i for i, p in enumerate(model.pieces) if model.kinds[i] == pieces.NORMAL}
    longest = max(map(len, known))
    starts = [i for i in range(len(body)) if body[i] & 0xC0 != 0x80] + [len(body)]
    best = {0: (0.0, None, None)}
    for a, b in zip(starts, starts[1:]):
        for end in range(a + 1, min(len(body), a + longest) + 1):
            piece = known.get(body[a:end])
            if piece is None and end == b:
                piece = model.unknown
            if piece is not None:
                total = best[a][0] + (model.unknown_score if piece == model.unknown else model.scores[piece])
                if end not in best or total > best[end][0]:
                    best[end] = (total, a, piece)
    out, at = [], len(body)
    while at:
        _, back, piece = best[at]
        out.append([int(model.byte_ids[c]) for c in body[back:at]] if piece == model.unknown else [piece])
        at = back
    return list(itertools.chain(*reversed(out)))


def test_best_paths_equal_plain_viterbi():
    model = pieces.load_model(raw_model())
    texts = [r[1] for r in data.rows() if r[1] is not None and len(r[1]) < 900] + ["", " ", "  a   b ", "\n\t", "𐍈𐍈 x", "▁▁a", "ab" * 200]
    ids, count = model.encode(*arrow_text.text_bytes(pa.array(texts)))
    ends = np.concatenate([[0], np.cumsum(count)])
    for k, text in enumerate(texts):
        assert ids[ends[k] : ends[k + 1]].tolist() == plain_viterbi(model, text), text


def test_paths_equal_the_library_where_its_sums_are_exact():
    import sentencepiece

    # Sums in single precision need small scores; the file's kind of model is set to unigram.
    raw = raw_model().replace(struct.pack("<f", -1e9), struct.pack("<f", -40000.0))
    unigram = raw.replace(b"\x12\x06tok_v0\x18\x02", b"\x12\x06tok_v0\x18\x01")
    assert unigram != raw
    library, model = sentencepiece.SentencePieceProcessor(model_proto=unigram), pieces.load_model(raw)
    words = sorted({w for r in data.rows() for w in data.words(r[1]) if len(w) < 60})
    ids, count = model.encode(*arrow_text.text_bytes(pa.array(words)))
    ends = np.concatenate([[0], np.cumsum(count)])
    plain = [w for w in words if "▁" not in w and "\u0001" not in w]
    assert plain and all(ids[ends[words.index(w)] : ends[words.index(w) + 1]].tolist() == library.encode(w) for w in plain)


def test_documents_round_trip(spark):
    model = pieces.load_model(raw_model())
    docs = data.documents(spark)
    coded = pieces.encode_documents(docs, model)
    assert coded.columns[: len(docs.columns) - 1] == [c for c in docs.columns if c != "pieces"]
    back = pieces.decode_documents(coded.withColumnRenamed("text", "old"), model).collect()
    assert len(back) == docs.count()
    for r in back:
        same = (r["old"] or "") == r["text"]
        assert r["exact"] == same == ("▁" not in (r["old"] or ""))
        assert r["n_pieces"] == len(r["pieces"]) and (r["n_pieces"] == 0) == (not r["old"])
    assert pieces.encode_documents(data.empty(spark), model).collect() == []


def test_models_that_normalise_are_refused():
    raw = raw_model()
    at = raw.rindex(b"\x0a\x08identity")
    with pytest.raises(ValueError):
        pieces.load_model(raw[: at - 2] + b"\x1a\x14" + b"\x0a\x08identity\x12\x02ab\x18\x01\x20\x00" + raw[at + 18 :])


# ---- languages -------------------------------------------------------------------------------


def test_language_of_held_out_documents(spark):
    rng = random.Random(3)
    rows = [(i + 1000, data.prose(rng, 60, lang), lang, "s") for i in range(480) for lang in [("en", "de", "fr", "es")[i % 4]]]
    docs = data.documents(spark, rows + data.rows()[24:])
    got = language.identify(docs, per_language=100).collect()
    assert len(got) == docs.count()
    truth = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert len(held) > 30 and sum(truth[r["doc_id"]] == r["lang_pred"] for r in held) >= 0.95 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got)
    blank = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in got if r["doc_id"] in (103, 104, 105, 106)}
    assert blank == {i: ("und", 0.0) for i in (103, 104, 105, 106)}
    assert all(not r["held_out"] for r in got if r["doc_id"] is None)
    # Labels and ids of held-out rows change nothing.
    other = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang")))
    again = by_id(language.identify(other, per_language=100))
    assert all(again[r["doc_id"]]["lang_pred"] == r["lang_pred"] for r in got if r["doc_id"] in truth)


def test_every_language_is_learned(spark, monkeypatch):
    fitted = []

    class Separator:  # stands for the fit, which takes long for many pairs
        intercept = 0.0

        def __init__(self, **_):
            pass

        def fit(self, rows):
            fitted.append(rows)
            self.coefficients = type("Vector", (), {"toArray": lambda _: np.zeros(language.N_FEATURES)})()
            return self

    monkeypatch.setattr(language, "LinearSVC", Separator)
    known = sorted(language.FAMILIES)[:90] + ["x-rare"]
    # The last languages are the rarest.
    rows = [(i, f"text {i} {x}", x, "s") for k, x in enumerate(known) for i in range(1000 * k, 1000 * k + (2 if k < 64 else 1))]
    model = language.fit(data.documents(spark, rows))
    assert model.languages == sorted(known)
    families = collections.Counter(model.families.values())
    pairs = math.comb(len(families), 2) + sum(math.comb(n, 2) for n in families.values())
    assert len(model.pairs) == len(fitted) == pairs < math.comb(len(known), 2) / 3


def test_nothing_to_learn(spark):
    assert language.identify(data.empty(spark)).collect() == []
    docs = data.documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {(r["lang_pred"], r["score"]) for r in language.identify(docs).collect()} == {("und", 0.0)}


def test_a_text_that_is_kept_travels_to_the_encoder_once(spark):
    docs = spark.createDataFrame([(1, "one two"), (2, None)], "doc_id int, text string")
    model = pieces.read_model(spark, tokenizer_path("piece_bpe_32k.model"))
    kept = pieces.encode_documents(docs, model)
    sent = kept._jdf.queryExecution().optimizedPlan().children().head()
    assert list(sent.schema().fieldNames()) == ["doc_id", "text"]
    alone = pieces.encode_documents(docs, model, keep=["doc_id"])
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "pieces", "exact").orderBy("doc_id").collect()]
    assert rows(kept) == rows(alone)
    assert [r.text for r in kept.orderBy("doc_id").collect()] == ["one two", None]

from __future__ import annotations

import re
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corpusloom.functions import columns as C
from corpusloom.functions import text as X
from corpusloom.functions import tokens as N
from corpusloom.functions.wordlists import LEMMAS


def apply(spark, fn, values, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]


# Raw text and what heavy cleaning makes of it, before lower-casing.
CLEANED = [
    ("A<BR />b<br>c<bR/>d", "A b c d"), ('<b class="x">bold</b>', "bold"), ("&lt;b&gt;", "<b>"), ("&amp;lt;", "&lt;"),
    ("a < b > c", "a c"), ("x\u00a0\u2003\x1c\x85y", "x y"), ("\ufb01ne \u2460 \u00bd", "fine 1 1\u20442"), ("", ""), (None, ""),
    ("  pad  ", "pad"), ("caf\u00e9 \u2013 \u201cQuote\u201d \u20ac", "caf\u00e9 \u2013 \u201cQuote\u201d \u20ac"),
    ("e\u0301", "\u00e9"), ("&amp &copy; &#8217;", "& \u00a9 \u2019"), ("tab\tnew\nline", "tab new line"), ("<br\n/>", ""),
    ("\uff21\uff22", "AB"), ("x<y", "x<y"), ("<>", "<>"), ("a<b\nc>d", "a d"), ("\u200bzero", "\u200bzero"), ("K\u212a", "KK"),
]


@pytest.mark.parametrize("lowercase", [True, False])
def test_heavy_clean(spark, lowercase):
    got = apply(spark, lambda c: X.heavy_clean(c, lowercase), [raw for raw, _ in CLEANED])
    assert got == [clean.lower() if lowercase else clean for _, clean in CLEANED]


def test_light_clean_keeps_case(spark):
    assert apply(spark, X.light_clean, ["A<br>B"]) == ["A B"]


def test_plain_text_class_holds_only_stable_characters():
    plain = re.compile(X.PLAIN_TEXT.replace("*+$", "*$"))
    for code in range(0x3000):
        char = chr(code)
        if plain.match(char):
            assert unicodedata.normalize("NFKC", char) == char and char != "&"
            assert not unicodedata.combining(char)


def test_decode_bytes(spark):
    raw = [b"\xff\xfeab", b"caf\xc3", b"a\r\nb\rc\nd", "h\u00e9".encode(), b"", b"\xe2\x82x", b"\xf0\x9f\x98\x80"]
    got = apply(spark, X.decode_bytes, [bytearray(r) for r in raw], "binary")
    want = [r.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n") for r in raw]
    assert got == want


def test_feature_tokens_equal_python(spark):
    texts = ["It's a GOOD, good film_1 \u00e9t\u00e9 x", "", None, "a b c", "10/10 \u0391\u0392\u03a3 \u00bd\u00bd", "na\u00efve\u2014test"]
    want = [re.findall(r"\b\w\w+\b", (t or "").lower()) for t in texts]
    assert apply(spark, N.feature_tokens, texts) == want


@pytest.mark.parametrize("tokens", [[], ["a"], ["a", "b"], ["a", "b", "c"], ["a", "a", "a", "b"]])
def test_ngrams(spark, tokens):
    want = [" ".join(tokens[i:i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)]
    assert apply(spark, N.ngrams, [tokens], "array<string>") == [want]
    assert apply(spark, lambda c: N.ngrams(c, 2, 2), [tokens], "array<string>") == [
        [" ".join(tokens[i:i + 2]) for i in range(len(tokens) - 1)]
    ]
    assert apply(spark, lambda c: N.ngrams_of(c, 3), [tokens], "array<string>") == [
        [" ".join(tokens[i:i + 3]) for i in range(len(tokens) - 2)]
    ]


def test_words_and_symbols(spark):
    got = apply(spark, N.words_and_symbols, [
        "i don't know, it's 'smart' ... $5 + 3", "they\u2019re o'clock we'd've", "can't won't", "", "!!! ??", "well-known",
    ])
    assert got[0] == ["i", "do", "n't", "know", "it", "'s", "smart", "$", "5", "+", "3"]
    assert got[1][:2] == ["they", "'re"]
    assert got[2] == ["ca", "n't", "wo", "n't"]
    assert got[3] == [] and got[4] == []
    assert got[5] == ["well", "known"]


def test_lemmas_and_stop_words(spark):
    stop = ["the", "not", "no", "be", "a"]
    fn = lambda c: N.preprocess_text(c, stop_words=stop)
    got = apply(spark, fn, ["The films weren't a good film; no, never the BEST", "the a", None, "not not a nor"])
    assert got == ["film not good film no never good", "", "", "not not nor"]
    assert "n't" in LEMMAS and len(LEMMAS) < 200


def test_switches(spark):
    text = ["The Films ARE bad"]
    plain = lambda c: N.preprocess_text(c, lowercase=False, use_lemmas=False, use_stop_words=False)
    assert apply(spark, plain, text) == ["The Films ARE bad"]
    assert apply(spark, lambda c: N.preprocess_text(c, stop_words=[]), text) == ["the film be bad"]


def test_empty_lemma_is_dropped(spark):
    fn = lambda c: N.lemmatize(c, {"x": "", "w": "v"})
    assert apply(spark, fn, [["X", "y", "w"]], "array<string>") == [["y", "v"]]


def test_joined_lemmas_equal_inline_lemmas(spark):
    lemmas = {"films": "film", "is": "be", "gone": "go"}
    rows = [(1, ["Films", "is", "Films", "x"]), (2, []), (3, ["gone"]), (3, ["is"]), (3, ["is"]), (None, ["films"]), (None, None)]
    docs = spark.createDataFrame(rows, "k int, t array<string>")
    table = spark.createDataFrame([*lemmas.items(), ("films", "movie")], "form string, lemma string")
    key = lambda df: sorted((tuple(r) for r in df.collect()), key=str)
    joined = key(N.lemmatize_with_table(docs, "t", table))
    assert joined == key(docs.select("k", N.lemmatize(F.col("t"), lemmas).alias("t")))
    assert (None, ["film"]) in joined and (None, None) in joined and len(joined) == len(rows)


def test_joined_stop_words_keep_repeats_and_negations(spark):
    tokens = spark.createDataFrame([("the",), ("good",), ("good",), ("not",)], "t string")
    words = spark.createDataFrame([("the",), ("not",), ("the",)], "word string")
    assert sorted(r["t"] for r in N.drop_stop_words_joined(tokens, "t", words).collect()) == ["good", "good", "not"]


def test_oracle_stop_words_equal_spark_list(spark):
    from corpusloom.plans.stopwords import SPARK_ENGLISH

    assert list(SPARK_ENGLISH) == N.default_stop_words()


def test_safe_name(spark):
    got = apply(spark, C.safe_name, ["caf\u00e9", "it's", "its", " Not Good ", "x" * 100, "a\u00a0\tb"])
    assert got == ["bow_caf", "bow_its", "bow_its", "bow_not_good", "bow_" + "x" * 76, "bow_a_b"]
    assert apply(spark, C.without_prefix, ["bow_bow_x", "x"]) == ["bow_x", "x"]


def test_ids(spark):
    assert apply(spark, C.id_number, ["POS12", " NEG007 "]) == [12, 7]
    assert apply(spark, C.id_prefix, [" NEG007"]) == ["NEG"]
    assert apply(spark, C.folder_of_label, ["1", " 1 ", "0", "x"]) == ["pos", "pos", "neg", "neg"]
    assert apply(spark, C.yes_no, [True, False], "boolean") == ["TRUE", "FALSE"]
    assert apply(spark, C.is_digits, ["12", "", "1a", "-1", "1.5"]) == [True, False, False, False, False]


def test_argmax_prefers_the_first(spark):
    assert apply(spark, C.argmax, [[1.0, 3.0, 3.0], [2.0, 2.0], [-1.0, -2.0]], "array<double>") == [1, 0, 0]


def test_truncate_and_pad(spark):
    rows = spark.createDataFrame([(1, 0, ["a", "b", "c"]), (2, 0, []), (3, 1, ["d"])], "k int, b int, t array<string>")
    padded = {r["k"]: r["t"] for r in C.pad_batches(rows, "t", "b", "_").collect()}
    assert padded == {1: ["a", "b", "c"], 2: ["_", "_", "_"], 3: ["d"]}
    assert apply(spark, lambda c: N.truncate_tokens(c, 2), [["a", "b", "c"], ["a"]], "array<string>") == [["a", "b"], ["a"]]


def test_timestamp_text(spark):
    assert re.fullmatch(r"\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d", spark.range(1).select(C.timestamp_text()).first()[0])


def test_decoding_holds_few_texts_as_strings():
    """A batch of pages is decoded part by part; nulls stay."""
    texts = pa.array([None] + [f"{i} &amp; ﬁ " + "x" * 5000 for i in range(4000)], pa.string())
    tracemalloc.start()
    found = X._unescape_nfkc.func(texts)
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert found[0].as_py() is None and found[1].as_py()[:7] == "0 & fi " and len(found) == 4001
    assert peak < 8 << 20
    assert X._unescape_nfkc.func(texts.slice(0, 0)).type == pa.string()

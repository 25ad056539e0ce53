"""Language of a text: its family first, then one-versus-one linear support vector machines inside it."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.llm.arrow_text import Words, add_columns, mix, text_bytes, words_of
from corpusloom.session import materialise

#: Languages of each family, by their two-letter or, without one, three-letter codes.
_FAMILY_MEMBERS = {
    "germanic": "de en nl sv da no nb nn is fo af fy lb yi sco nds",
    "romance": "es fr it pt ro ca gl oc ast co sc rm wa an ht la scn vec",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg sh hsb dsb rue",
    "baltic": "lt lv ltg",
    "celtic": "ga gd gv cy br kw",
    "hellenic": "el",
    "armenian": "hy hyw",
    "albanian": "sq",
    "iranian": "fa ku ckb ps tg os",
    "indic": "hi ur bn pa gu mr ne or as sd si sa ks mai bho gom dv",
    "dravidian": "ta te kn ml tcy",
    "uralic": "fi et hu se kv koi mhr udm",
    "turkic": "tr az kk ky uz tk tt ba cv ug sah crh",
    "mongolic": "mn bxr xal",
    "caucasian": "ka xmf ab ce av lez",
    "basque": "eu",
    "semitic": "ar he mt am ti arz",
    "cushitic": "so om aa",
    "chadic": "ha",
    "niger-congo": "sw zu xh st tn ts ss ve nr nso sn ny rw rn lg ln kg yo ig ak tw ee wo ff bm",
    "austronesian": "id ms tl jv su ceb ilo mg mi sm to fj haw war pam min",
    "austroasiatic": "vi km mnw",
    "kra-dai": "th lo shn za",
    "tibeto-burman": "my bo dz",
    "sinitic": "zh yue wuu nan hak",
    "japonic": "ja",
    "koreanic": "ko",
    "american": "qu ay gn nah nv iu kl",
    "constructed": "eo io ia ie vo",
}
#: Family of a language; a language that is not listed is a family of its own.
FAMILIES = {x: family for family, members in _FAMILY_MEMBERS.items() for x in members.split()}
#: Features of a text: its 2- and 3-grams of byte classes, hashed.
N_FEATURES = 2048
UNKNOWN = "und"
#: Classes in an n-gram of a word, and bits of a class.
ORDER, BITS = 4, 6


def _byte_classes() -> np.ndarray:
    """0 is the edge of a word, 1-26 letters, 27 digits, 28-31 other ASCII, 32-63 bytes beyond ASCII."""
    table = np.zeros(256, np.int64)
    for b in range(256):
        if b >= 128:
            table[b] = 32 + (b & 31)
        elif chr(b).isalpha():
            table[b] = ord(chr(b).lower()) - 96
        elif chr(b).isdigit():
            table[b] = 27
        else:
            table[b] = 28 + b % 4
    return table


CLASS = _byte_classes()


def word_ngrams(distinct: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the 4-grams of every distinct word, edges included, and the index of each one's word.

    A word of n bytes has n + 1: one for every byte and one for its end, each with 3 classes before it.
    """
    data, offsets = text_bytes(distinct)
    n = len(distinct)
    at = np.arange(len(data)) + np.repeat(np.arange(1, n + 1) * (ORDER - 1), np.diff(offsets)) + np.repeat(np.arange(n), np.diff(offsets))
    line = np.zeros(len(data) + n * ORDER + ORDER, np.int64)
    line[at] = CLASS[data]
    ends = offsets[1:] + np.arange(1, n + 1) * (ORDER - 1) + np.arange(n)
    real = np.zeros(len(line), bool)
    real[at] = True
    real[ends] = True
    places = np.flatnonzero(real)
    code = np.zeros(len(places), np.int64)
    for back in range(ORDER - 1, -1, -1):
        code = code << BITS | line[places - back]
    return code, np.repeat(np.arange(n), np.diff(offsets) + 1)


def word_features(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the distinct words, and the word of each."""
    code, word = word_ngrams(words.distinct)
    two = mix(code.astype(np.uint64) & np.uint64((1 << 2 * BITS) - 1))
    three = mix((code.astype(np.uint64) & np.uint64((1 << 3 * BITS) - 1)) + np.uint64(1 << 40))
    number = np.concatenate([two, three]) % np.uint64(N_FEATURES)
    return number.astype(np.int64), np.concatenate([word, word])


def text_vectors(words: Words) -> np.ndarray:
    """One row per document: the share of each feature, times 100."""
    number, word = word_features(words)
    order = np.argsort(word, kind="stable")
    number = number[order]
    n_of = np.bincount(word, minlength=len(words.distinct))
    first = np.concatenate([[0], np.cumsum(n_of)[:-1]]) if len(n_of) else np.zeros(0, np.int64)
    times = n_of[words.code]
    at = np.repeat(first[words.code] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(times) else times
    cells = np.repeat(words.doc, times) * N_FEATURES + number[at]
    found = np.bincount(cells, minlength=words.n_docs * N_FEATURES).reshape(words.n_docs, N_FEATURES)
    return 100.0 * found / np.maximum(found.sum(1, keepdims=True), 1)


@dataclass
class LanguageModel:
    """Linear separators of families and of the languages of each family; ``(a, b)`` is positive for ``a``."""

    languages: list[str]
    families: dict[str, str]
    pairs: list[tuple[str, str]]
    weights: np.ndarray
    intercepts: np.ndarray

    def predict(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and its score from the separators' margins of each row."""
        p = 1 / (1 + np.exp(-np.clip(4 * margins, -30, 30)))
        names = sorted({self.families[x] for x in self.languages})
        score = np.zeros((len(margins), len(self.languages)))
        family = self._share(p, names)
        best_family = family.argmax(1)
        for k, name in enumerate(names):
            inside = [x for x in self.languages if self.families[x] == name]
            own = self._share(p, inside)
            for j, x in enumerate(inside):
                score[:, self.languages.index(x)] = np.where(best_family == k, family[:, k] * own[:, j], -1.0)
        best = score.argmax(1)
        return best, np.clip(score[np.arange(len(score)), best], 0, 1)

    def _share(self, p: np.ndarray, names: list[str]) -> np.ndarray:
        """Mean probability of each name against each of the others; 1 for a single name."""
        if len(names) == 1:
            return np.ones((len(p), 1))
        out = np.zeros((len(p), len(names)))
        for i, j in combinations(range(len(names)), 2):
            win = p[:, self.pairs.index((names[i], names[j]))]
            out[:, i] += win
            out[:, j] += 1 - win
        return out / (len(names) - 1)


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_sample(docs: DataFrame, text: str, lang: str, per_language: int) -> DataFrame:
    """``lang`` and ``text`` of at most ``per_language`` distinct texts of each language.

    Texts are picked by the order of their hash, from narrow rows; copies count once.
    """
    rows = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter(F.col("lang").isNotNull() & has_letter(F.col("text")))
    rows = rows.withColumn("h", F.xxhash64("text"))
    distinct = rows.select("lang", "h").distinct()
    place = F.row_number().over(W.partitionBy("lang").orderBy("h"))
    picked = distinct.withColumn("place", place).filter(F.col("place") <= per_language)
    picked = materialise(picked.select("lang", "h"), "language-sample")
    return rows.join(picked, ["lang", "h"], "left_semi").groupBy("lang", "h").agg(F.first("text").alias("text"))


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", families: Mapping[str, str] = FAMILIES, per_language: int = 800,
) -> LanguageModel:
    """Separators fitted by Spark on a sample of ``per_language`` texts of each language; every language that occurs is learned.

    There is a separator for each pair of families and for each pair of languages of a family.
    """
    fields = [T.StructField("features", T.ArrayType(T.DoubleType()))]

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        found = text_vectors(words_of(*text_bytes(piece.column(1))))
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * N_FEATURES), pa.array(found.ravel()))]

    sample = training_sample(docs, text, lang, per_language).select("lang", F.col("text").alias("__text"))
    sample = materialise(add_columns(sample, "__text", fields, work, keep=["lang"]), "language-vectors")
    languages = sorted(r.lang for r in sample.select("lang").distinct().collect())  # one row for each language
    family_of = {x: families.get(x, x) for x in languages}
    names = sorted(set(family_of.values()))
    tasks = [(pair, {x: family_of[x] for x in languages}) for pair in combinations(names, 2)]
    for name in names:
        tasks += [(pair, {x: x for x in languages}) for pair in combinations([x for x in languages if family_of[x] == name], 2)]
    weights, intercepts = [], []
    # Every iteration of a fit is a job over the bounded sample; in four partitions it has one stage.
    vectors = sample.select("lang", array_to_vector("features").alias("features")).coalesce(4)
    for (a, b), group in tasks:
        one, other = ([x for x in languages if group[x] == side] for side in (a, b))
        rows = vectors.filter(F.col("lang").isin(one + other)).select("features", F.col("lang").isin(one).cast("double").alias("label"))
        svm = LinearSVC(maxIter=25, regParam=1e-3, aggregationDepth=2).fit(rows)
        weights.append(svm.coefficients.toArray())
        intercepts.append(svm.intercept)
    return LanguageModel(languages, family_of, [pair for pair, _ in tasks], np.array(weights).reshape(len(tasks), N_FEATURES), np.array(intercepts))


def with_language(docs: DataFrame, model: LanguageModel, text: str = "text", prediction: str = "lang_pred", score: str = "score", keep: list[str] | None = None) -> DataFrame:
    """``docs`` (or its columns ``keep``) with the predicted language and a score from 0 to 1, in one pass.

    A text that is null, has no letter, or meets a model without languages is ``und`` with score 0.
    Only the text is an input.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = [T.StructField(prediction, T.StringType()), T.StructField(score, T.DoubleType())]
    shown = list(docs.columns if keep is None else keep)
    inner = {"__text": F.col(text), "__letters": has_letter(F.col(text))}

    def work(piece: pa.RecordBatch) -> list[pa.Array]:
        model = sent.value
        words = words_of(*text_bytes(piece.column(piece.schema.get_field_index("__text"))))
        letters = piece.column(piece.schema.get_field_index("__letters")).to_numpy(zero_copy_only=False).astype(bool)
        if not model.languages:
            return [pa.array([UNKNOWN] * piece.num_rows, pa.string()), pa.array(np.zeros(piece.num_rows))]
        number, word = word_features(words)
        n_of = words.sums(np.bincount(word, minlength=len(words.distinct)))
        margins = np.empty((piece.num_rows, len(model.pairs)))
        for k, w in enumerate(model.weights):
            of_word = np.bincount(word, w[number], minlength=len(words.distinct))
            margins[:, k] = 100.0 * words.sums(of_word) / np.maximum(n_of, 1) + model.intercepts[k]
        best, sure = model.predict(margins)
        name = np.where(letters, np.array(model.languages, object)[best], UNKNOWN)
        return [pa.array(name.tolist(), pa.string()), pa.array(np.where(letters, sure, 0.0))]

    rows = docs.select(*[F.col(c) for c in shown if c not in inner], *[v.alias(k) for k, v in inner.items()])
    return add_columns(rows, "__text", fields, work, keep=[c for c in shown if c not in (prediction, score)])


def held_out(key: Column) -> Column:
    """Whether a key is kept from learning: CRC-32 of its text leaves remainder 1 by 3; never for null."""
    return F.coalesce(F.crc32(key.cast("string")) % 3 == 1, F.lit(False))


def fit_held(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **bounds) -> LanguageModel:
    """The model of rows that have a key and are not held out."""
    return fit(docs.filter(F.col(key).isNotNull() & ~held_out(F.col(key))), text, lang, **bounds)


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", **bounds) -> DataFrame:
    """``key``, ``held_out``, ``lang_pred`` and ``score`` of every row.

    Learns from rows with a language that are not held out. Null texts and texts without a letter are
    ``und`` with score 0, as is everything where nothing can be learned. Repeated rows are judged each,
    an empty table gives an empty table, other columns are not read.
    """
    model = fit_held(docs, key, text, lang, **bounds)
    rows = docs.select(F.col(key).alias(key), held_out(F.col(key)).alias("held_out"), F.col(text).alias("__text"))
    return with_language(rows, model, text="__text", keep=[key, "held_out"])

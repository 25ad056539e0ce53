"""Secrets in texts: candidates by pattern, false positives removed by a random forest.

All work is DataFrame operations. A text is cut at its candidates with a marker, so each candidate has
the text before and after it at hand without any positions; only texts with a candidate go further.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.functions.columns import let
from corpusloom.session import materialise

_KEYS = r"(?:token|secret|password|passwd|api[_-]?key|access[_-]?key|auth[_-]?key|bearer)"
#: The key word may stand anywhere in a name; the look-ahead only saves time.
_GIVEN = rf"(?=[AaBbPpSsTt])(?i:{_KEYS})[A-Za-z0-9_\-]*[\"']?[ \t]{{0,3}}[=:][ \t]{{0,3}}[\"']?"
_RUN = r"A-Za-z0-9+/_\-"
#: A value that a name with a key word is given, or a run of 16 or more such characters that holds a digit and isn't such a name.
CANDIDATE = (
    rf"{_GIVEN}[^\s\"']{{8,}}"
    rf"|(?<![{_RUN}])(?=[A-Za-z+/_\-]*[0-9])(?=[{_RUN}]{{16}})(?![{_RUN}]*?{_GIVEN}[^\s\"']{{8}})[{_RUN}]{{16,}}={{0,2}}(?![{_RUN}=])"
)
_SECRET_WORDS = r"(?i)(token|secret|passw|api[_-]?key|access|auth|bearer|credential|private|\b(key|sig(nature)?)[\"']?[ \t]*[=:])"
_PLAIN_WORDS = r"(?i)(sha-?\d*|md5|checksum|commit|digest|uuid|isbn|invoice|order|phone|card|account|version)"
#: Labelled findings that the forest is fitted on, at most, for each label.
TRAINING_ROWS = 20_000
MASK = "<SECRET>"
#: Characters of a value that are looked at together.
PART = 1000
#: Log probability of neighbouring characters that no word of the dictionary has.
RARE = -10.0
FEATURES = (
    "length", "digits", "upper", "symbols", "distinct", "hex", "transitions", "coverage",
    "path_before", "path_inside", "suffix_after", "secret_word", "plain_word", "given", "quoted",
)


def cut_at_candidates(text: Column) -> Column:
    """The text as an array in which every second element is a candidate; null counts as empty."""
    body = F.translate(F.coalesce(text, F.lit("")), "\u0001\u0002", "\u0003\u0003")
    return F.split(F.regexp_replace(body, CANDIDATE, "\u0001$0\u0002"), "[\u0001\u0002]", -1)


def candidates(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``text_hash``, ``nth``, ``value``, ``before`` (up to 60 characters), ``after`` (up to 30) of each candidate.

    Rows that are equal in key and text have the same candidates and stand for each other.
    """
    body = F.col(text)
    rows = docs.filter(body.rlike(CANDIDATE)).select(F.col(key).alias("id"), F.xxhash64(body).alias("text_hash"), cut_at_candidates(body).alias("parts"))
    around = F.transform(
        F.sequence(F.lit(1), F.size("parts") - 2, F.lit(2)),
        lambda i: F.struct(i.alias("at"), F.get("parts", i).alias("value"), F.right(F.get("parts", i - 1), F.lit(60)).alias("before"), F.left(F.get("parts", i + 1), F.lit(30)).alias("after")),
    )
    rows = rows.filter(F.size("parts") > 2).select("id", "text_hash", F.explode(around).alias("c"))
    lead = F.regexp_extract("c.value", "^" + _GIVEN, 0)
    return rows.select(
        "id", "text_hash", F.expr("(c.at + 1) div 2").cast("int").alias("nth"), F.regexp_replace("c.value", "^" + _GIVEN, "").alias("value"),
        F.concat("c.before", lead).alias("before"), F.col("c.after").alias("after"),
    )


def dictionary(docs: DataFrame, text: str, share: float = 1e-6) -> DataFrame:
    """``word``, ``n``: runs of 3 to 12 letters a-z that make up ``share`` of all such runs, so 1 / ``share`` at most.

    Counted over all texts; each task sums its own words before the shuffle.
    """
    words = docs.select(F.explode(F.split(F.lower(F.col(text)), "[^a-z]+")).alias("word")).filter(F.length("word").between(3, 12))
    counts = materialise(words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") > 1), "secret-words")
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).filter(F.col("n") >= F.col("total") * share).select("word", "n")  # one row of totals


def _pairs(word: Column) -> Column:
    return F.transform(F.sequence(F.lit(1), F.length(word) - 1), lambda i: F.substr(word, i, F.lit(2)))


def _small(text: Column) -> Column:
    """ASCII letters in lower case; the length stays."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def _parts(values: DataFrame) -> DataFrame:
    """``vid``, ``k``, ``part``, ``follow`` of values: parts of ``PART`` characters and up to 11 characters after each.

    What is done to a part takes bounded time and memory, so a value costs in proportion to its length.
    Parts are dealt out, since few rows may hold very long values.
    """
    cut = let(
        F.regexp_extract_all("value", F.lit(f"(?s).{{1,{PART}}}"), F.lit(0)),
        lambda parts: F.transform(
            parts, lambda part, k: F.struct(k.alias("k"), part.alias("part"), F.left(F.coalesce(F.get(parts, k + 1), F.lit("")), F.lit(11)).alias("follow"))
        ),
    )
    n = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return values.select("vid", F.explode(cut).alias("p")).select("vid", "p.*").repartition(n, "vid", "k")


def _transition_table(words: DataFrame) -> DataFrame:
    """One row with ``log_p``: 26 * 26 log probabilities of a letter after another, by the words' letters."""
    pairs = words.select(F.explode(_pairs(F.col("word"))).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n"))
    code = lambda c: F.ascii(c) - 97
    cell = code(F.left("pair", F.lit(1))) * 26 + code(F.right("pair", F.lit(1)))
    counts = pairs.agg(F.map_from_entries(F.collect_list(F.struct(cell, "n"))).alias("n"))
    all_counts = F.transform(F.sequence(F.lit(0), F.lit(26 * 26 - 1)), lambda i: F.coalesce(F.element_at("n", i), F.lit(0)))
    counts = counts.select(all_counts.alias("n")).select("n", F.transform(F.sequence(F.lit(0), F.lit(25)), lambda i: F.aggregate(F.slice("n", i * 26 + 1, 26), F.lit(0).cast("long"), lambda x, y: x + y)).alias("all"))
    log_p = F.transform("n", lambda n, i: F.when(n > 0, F.log((n + 1) / (F.get("all", F.floor(i / 26).cast("int")) + 64))).otherwise(RARE))
    return counts.select(log_p.alias("log_p"))


def _transitions(parts: DataFrame, words: DataFrame) -> DataFrame:
    """``vid``, ``transitions``: the mean over a value's neighbouring characters, ``RARE`` where they aren't letters."""
    codes = F.transform(F.split(_small(F.concat("part", F.left("follow", F.lit(1)))), ""), lambda c: F.ascii(c) - 97)

    def total(codes: Column) -> Column:
        def log_p(i: Column) -> Column:
            a, b = F.get(codes, i), F.get(codes, i + 1)
            return F.when(a.between(0, 25) & b.between(0, 25), F.get("log_p", a * 26 + b)).otherwise(RARE)

        steps = F.sequence(F.lit(0), F.size(codes) - 2)
        some = F.size(codes) >= 2
        return F.struct(
            F.when(some, F.aggregate(steps, F.lit(0.0), lambda x, i: x + log_p(i))).otherwise(0.0).alias("sum"), (F.size(codes) - 1).alias("n"))

    # One row of 26 * 26 numbers.
    sums = parts.crossJoin(F.broadcast(_transition_table(words))).select("vid", let(codes, total).alias("t"))
    return sums.groupBy("vid").agg(F.try_divide(F.sum("t.sum"), F.sum("t.n")).alias("transitions"))


def _covered(parts: DataFrame, words: DataFrame) -> DataFrame:
    """``vid``, ``covered``: characters of a value inside words of the dictionary, found as stretches of 3 to 12 letters."""
    body = _small(F.concat("part", "follow"))
    lead = lambda body, i: F.regexp_extract(F.substr(body, i, F.lit(12)), "^[a-z]+", 0)
    starts = let(body, lambda body: F.transform(
        F.sequence(F.lit(1), F.length("part")), lambda i: F.struct((F.col("k") * PART + i).alias("at"), lead(body, i).alias("run"))))
    runs = parts.select("vid", F.explode(starts).alias("s")).select("vid", "s.*").filter(F.length("run") >= 3)
    each = F.explode(F.transform(F.sequence(F.lit(3), F.length("run")), lambda n: F.left("run", n)))
    met = runs.select("vid", "at", each.alias("word")).join(words.select("word"), "word")
    spots = met.groupBy("vid", "at").agg(F.max(F.length("word")).alias("n"))  # shorter words lie inside the longest
    spots = spots.select("vid", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("spot")).distinct()
    return spots.groupBy("vid").agg(F.count("*").alias("covered"))


def features(found: DataFrame, words: DataFrame) -> DataFrame:
    """``found`` (with ``value``, ``before``, ``after``) and a column for each of ``FEATURES``.

    ``transitions``: mean log probability of a character after the one before, by the words' letters.
    ``coverage``: share of characters inside words of the dictionary. Both are worked out once for each
    distinct value, in parts of bounded length; rows travel with a number instead of the value.
    """
    values = materialise(found.select("value").distinct().withColumn("vid", F.monotonically_increasing_id()), "secret-values")
    parts = materialise(_parts(values), "secret-parts")
    known = values.join(_transitions(parts, words), "vid", "left").join(_covered(parts, words), "vid", "left").drop("vid")
    v, n = F.col("value"), F.greatest(F.length("value"), F.lit(1))
    count = lambda pattern: F.length(F.regexp_replace(v, pattern, "")) / n  # noqa: E731  share of characters that are left
    flag = lambda test: test.cast("double")
    near = F.right("before", F.lit(40))
    return found.join(known, "value", "left").select(
        *found.columns,
        F.length("value").cast("double").alias("length"), count("[^0-9]").alias("digits"), count("[^A-Z]").alias("upper"), count("[A-Za-z0-9]").alias("symbols"),
        (F.size(F.array_distinct(F.split(v, ""))) / n).alias("distinct"), flag(v.rlike("^[0-9a-fA-F]+$")).alias("hex"),
        F.coalesce("transitions", F.lit(RARE)).alias("transitions"), F.coalesce(F.col("covered") / n, F.lit(0.0)).alias("coverage"),
        flag(F.col("before").rlike(r"(://|[/@.\\])[^\s=]*$")).alias("path_before"), flag(v.rlike("/")).alias("path_inside"),
        flag(F.col("after").rlike(r"^[@/.][A-Za-z0-9]")).alias("suffix_after"), flag(near.rlike(_SECRET_WORDS)).alias("secret_word"),
        flag(near.rlike(_PLAIN_WORDS)).alias("plain_word"), flag(F.col("before").rlike(r"[=:][ \t]*[\"']?$")).alias("given"),
        flag(F.col("before").rlike(r"[\"']$") & F.col("after").rlike(r"^[\"']")).alias("quoted"),
    )


def label_findings(scored: DataFrame) -> Column:
    """Labels where a rule is certain, else null: 1 for a value without words given to a secret's name, 0 for plain numbers, paths, hosts, mail addresses and words."""
    given = (F.col("secret_word") == 1) & (F.col("given") == 1) & (F.col("coverage") < 0.5)
    plain = (F.col("digits") == 1) | (F.col("path_before") == 1) | (F.col("suffix_after") == 1) | (F.col("coverage") >= 0.7)
    return F.when(given & ~plain, 1.0).when(plain & (F.col("secret_word") == 0), 0.0)


def fit_forest(labelled: DataFrame, rows: int = TRAINING_ROWS, trees: int = 25, seed: int = 5):
    """A forest from rows with ``FEATURES`` and ``label``, of at most ``rows`` distinct findings a label (by hash); None if a label is missing."""
    place = F.row_number().over(W.partitionBy("label").orderBy("h"))
    drawn = labelled.select("label", *FEATURES, F.xxhash64("value", "before", "after").alias("h")).distinct()
    drawn = materialise(drawn.withColumn("place", place).filter(F.col("place") <= rows).drop("place"), "secret-labels")
    if drawn.select("label").distinct().count() < 2:
        return None
    vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(drawn)
    return RandomForestClassifier(numTrees=trees, maxDepth=6, seed=seed, minInstancesPerNode=2).fit(vectors)


def scan(docs: DataFrame, key: str = "doc_id", text: str = "text", labels: DataFrame | None = None, threshold: float = 0.5) -> DataFrame:
    """``key``, ``text_hash``, ``nth``, ``value``, ``score``, ``secret`` of every candidate.

    ``nth`` numbers the candidates of a text from 1. ``score`` is the forest's probability; a candidate
    is a secret from ``threshold`` on. The forest learns from ``labels`` (``value``, ``before``,
    ``after``, ``label`` 0 or 1), or from the candidates themselves where ``label_findings`` is certain.
    Without both labels there is nothing to learn, and the score is the label, or 0. Texts that are
    null, empty or without candidates give no rows; rows equal in key and text are reported once;
    texts are read whole, and a value costs in proportion to its length; other columns are not read.
    """
    found = materialise(candidates(docs, key, text).distinct(), "secret-candidates")
    words = materialise(dictionary(docs, text), "secret-dictionary")
    scored = materialise(features(found, words), "secret-features")
    own = scored.withColumn("label", label_findings(scored))
    taught = own.filter(F.col("label").isNotNull()) if labels is None else features(labels.select("value", "before", "after", "label"), words)
    forest = fit_forest(taught)
    if forest is None:
        judged = own.withColumn("score", F.coalesce("label", F.lit(0.0)))
    else:
        vectors = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(own)
        judged = forest.transform(vectors).withColumn("score", vector_to_array("probability")[1])
    return judged.select(F.col("id").alias(key), "text_hash", "nth", "value", "score", (F.col("score") >= threshold).alias("secret"))


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK`` (and ``n_chars``, if there, counted anew where the text changed).

    All rows and columns stay. Only texts with a candidate are matched with their findings, by key and
    text, so equal rows are treated alike.
    """
    columns = docs.columns
    found = scan(docs, key, text, **options).filter("secret").groupBy(F.col(key).alias("found_id"), F.col("text_hash").alias("found_hash"))
    found = materialise(found.agg(F.collect_set("nth").alias("hidden")), "secret-found")
    has = F.coalesce(F.col(text).rlike(CANDIDATE), F.lit(False))
    rows = docs.filter(has).select(F.struct(*[F.col(c) for c in columns]).alias("row"), F.col(key).alias("id"), F.xxhash64(text).alias("text_hash"))
    rows = rows.join(found, F.col("id").eqNullSafe(F.col("found_id")) & (F.col("text_hash") == F.col("found_hash")), "left")
    old = F.col(f"row.`{text}`")
    rows = rows.withColumn("parts", F.when(F.col("hidden").isNotNull(), cut_at_candidates(old)))
    lead = lambda part: F.regexp_extract(part, "^" + _GIVEN, 0)
    masked = F.transform(
        "parts", lambda part, i: F.when((i % 2 == 1) & F.array_contains("hidden", ((i + 1) / 2).cast("int")), F.concat(lead(part), F.lit(MASK))).otherwise(part)
    )
    rows = rows.withColumn("masked", F.when(F.col("hidden").isNotNull(), F.array_join(masked, "")).otherwise(old))
    out = []
    for c in columns:
        value = F.col(f"row.`{c}`")
        if c == text:
            value = F.col("masked")
        elif c == "n_chars":
            value = F.when(F.col("hidden").isNotNull(), F.length("masked").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return docs.filter(~has).union(rows.select(*out))

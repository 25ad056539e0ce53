"""URL verdicts: a given list of host and path rules, then association rules mined from labelled URLs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from corpusloom.session import materialise

#: (rule, verdict); a rule is a host, then a path that begins with ``/``.
Rules = Sequence[tuple[str, str]]
_LABEL = "verdict="
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_rule(host: Column, path: Column, rules: Rules) -> Column:
    """The longest rule that fits the host or a parent domain of it and the start of the path, else null."""
    cases = []
    for rule, _ in sorted(rules, key=lambda r: -len(r[0])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        cases.append(F.when(fits, F.lit(rule)))
    return F.coalesce(*cases, F.lit(None).cast("string"))


def verdict_of_rule(rule: Column, rules: Rules) -> Column:
    return F.coalesce(*[F.when(rule == r, F.lit(v)) for r, v in rules], F.lit(None).cast("string"))


def url_tokens(host: Column, path: Column, url: Column) -> Column:
    """Distinct tokens of a URL: words of the host, path segments, query parts; digits count as ``#``."""
    words = F.split(host, r"[.\-]")
    segments = F.split(path, "/")
    query = F.split(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*\?([^#]*)", 1), F.lit("")), "&")
    named = lambda name, parts: F.transform(
        F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit(name), F.regexp_replace(x, r"[0-9]+", "#"))
    )
    return F.array_sort(F.array_distinct(F.concat(named("host=", words), named("path=", segments), named("query=", query))))


def token_classes(labelled: DataFrame, support: float) -> DataFrame:
    """``token``, ``item``: the tokens of at least ``support`` of the rows, and the first of those in the very same rows.

    Tokens that always come together, such as the segments of one long path, say the same, and every subset of
    them is a frequent set of its own; as one item they are mined once. Rows are compared by their number and two sums
    of 64-bit hashes.
    """
    row = [F.xxhash64("tokens", "verdict", F.lit(n)).cast("decimal(38,0)").alias(f"h{n}") for n in (1, 2)]
    seen = labelled.select(*row, F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"), F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))
    seen = seen.filter(F.col("n") >= support * labelled.count())
    firsts = seen.groupBy("n", "h1", "h2").agg(F.min("token").alias("item"))
    return seen.join(firsts, ["n", "h1", "h2"]).select("token", "item")


def mine_rules(labelled: DataFrame, classes: DataFrame, support: float = 0.002, confidence: float = 0.9) -> DataFrame:
    """Association rules ``items -> verdict`` from rows of (``tokens``, ``verdict``) with FP-growth over token classes.

    Kept are rules of at least ``support`` of the rows and ``confidence``; of these, a rule goes if one
    with fewer of the same items says the same at no lower confidence. Columns: ``items``, ``verdict``,
    ``rule_confidence``, ``rule_support``, ``key`` (the item with the smallest support of all, the
    rule's posting list in the inverted index). An item stands for any token of its class. No labelled rows give no rules.
    """
    spark = labelled.sparkSession
    empty = spark.createDataFrame([], "items array<string>, verdict string, rule_confidence double, rule_support double, key string")
    if labelled.isEmpty():
        return empty
    rows = materialise(labelled.select(F.monotonically_increasing_id().alias("id"), "tokens", "verdict"), "url-baskets")
    found = rows.select("id", F.explode("tokens").alias("token")).join(classes, "token").groupBy("id").agg(F.collect_set("item").alias("found"))
    said = F.array(F.concat(F.lit(_LABEL), "verdict"))
    baskets = rows.join(found, "id", "left").select(F.concat(F.coalesce("found", F.array().cast("array<string>")), said).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence).fit(baskets)
    single = model.freqItemsets.filter(F.size("items") == 1).select(F.col("items")[0].alias("item"), "freq")
    said = F.col("consequent")[0]
    found = model.associationRules.filter(said.startswith(_LABEL)).select(
        F.array_sort("antecedent").alias("items"), F.regexp_replace(said, "^" + _LABEL, "").alias("verdict"),
        F.col("confidence").alias("rule_confidence"), F.col("support").alias("rule_support"),
    )
    found = materialise(found, "url-rules")
    rarest = (
        found.select("items", "verdict", F.explode("items").alias("item")).join(single, "item")
        .groupBy("items", "verdict").agg(F.min_by("item", F.struct("freq", "item")).alias("key"))
    )
    found = materialise(found.join(rarest, ["items", "verdict"]), "url-rules")
    part = found.select(*[F.col(c).alias(f"part_{c}") for c in found.columns])
    smaller = (
        (F.size("part_items") < F.size("items")) & (F.col("part_verdict") == F.col("verdict"))
        & (F.col("part_rule_confidence") >= F.col("rule_confidence")) & (F.size(F.array_except("part_items", "items")) == 0)
    )
    redundant = (
        found.select("*", F.explode("items").alias("item")).join(part, (F.col("item") == F.col("part_key")) & smaller, "left_semi")
        .select("items", "verdict").distinct()
    )
    return found.join(redundant, ["items", "verdict"], "left_anti").select(*empty.columns)


def match_rules(tokens: DataFrame, classes: DataFrame, rules: DataFrame) -> DataFrame:
    """``tokens`` (distinct token sets) with the ``verdict``, ``items`` and ``rule_confidence`` of their best rule.

    A set has an item if it holds a token of its class, the last of which by name is shown. A set meets only rules whose
    key is one of its items. Best is the highest confidence, then more items, more support, then the tokens shown. Sets
    that no rule fits are left out.
    """
    held = tokens.select("tokens", F.explode("tokens").alias("token")).join(classes, "token").groupBy("tokens", "item").agg(F.max("token").alias("token"))
    own = held.groupBy("tokens").agg(F.map_from_entries(F.collect_list(F.struct("item", "token"))).alias("own"))
    hits = (
        own.select("tokens", "own", F.explode(F.map_keys("own")).alias("key")).join(rules, "key")
        .filter(F.forall("items", lambda i: F.map_contains_key("own", i)))
        .withColumn("items", F.array_sort(F.transform("items", lambda i: F.element_at("own", i))))
    )
    best = F.struct("rule_confidence", F.size("items"), "rule_support", "items", "verdict")
    return hits.groupBy("tokens").agg(F.max_by(F.struct("verdict", "items", "rule_confidence"), best).alias("best")).select("tokens", "best.*")


def judge_urls(
    pages: DataFrame, rules: Rules, key: str = "page_id", url: str = "url", support: float = 0.002,
    confidence: float = 0.9, default: str = "allow", labels: DataFrame | None = None,
) -> DataFrame:
    """``key``, ``host``, ``path``, ``rule``, ``verdict``, ``mined`` of every row.

    A URL that a listed rule fits has that rule's verdict. The others get that of the best mined rule
    (``mined`` has its tokens), or ``default``. Rules are mined from ``labels`` (``url``, ``verdict``);
    without it, from the distinct URLs that the listed rules judge. Null URLs and URLs without ``://``
    have an empty host and path; repeated rows are judged each; an empty table gives an empty table.
    """
    address = F.col("url")
    rows = pages.select(F.col(key).alias("id"), F.col(url).alias("url"))
    rows = rows.select("id", "url", host_of(address).alias("host"), path_of(address).alias("path"))
    rows = rows.withColumn("rule", listed_rule(F.col("host"), F.col("path"), rules))
    rows = rows.withColumn("tokens", url_tokens(F.col("host"), F.col("path"), address)).drop("url")
    rows = materialise(rows, "url-rows")
    if labels is None:
        known = rows.filter(F.col("rule").isNotNull())
        labelled = known.select("host", "path", "tokens", verdict_of_rule(F.col("rule"), rules).alias("verdict")).distinct()
    else:
        address = F.col("url")
        labelled = labels.select("url", "verdict").distinct().select(
            url_tokens(host_of(address), path_of(address), address).alias("tokens"), "verdict"
        )
    labelled = materialise(labelled.select("tokens", "verdict"), "url-labelled")
    classes = materialise(token_classes(labelled, support), "url-classes")
    mined = materialise(mine_rules(labelled, classes, support, confidence), "url-rules")
    sets = rows.filter(F.col("rule").isNull()).select("tokens").distinct()
    said = match_rules(sets, classes, mined).select("tokens", F.col("verdict").alias("said"), F.col("items").alias("mined"))
    out = rows.join(said, "tokens", "left")
    free = F.col("rule").isNull()
    return out.select(
        F.col("id").alias(key), "host", "path", "rule",
        F.coalesce(verdict_of_rule(F.col("rule"), rules), F.when(free, F.col("said")), F.lit(default)).alias("verdict"),
        F.when(free, F.array_join("mined", " ")).alias("mined"),
    )

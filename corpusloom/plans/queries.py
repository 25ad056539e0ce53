"""The registered queries. Each takes ``(spark, folder)`` and reads the whole tables it names."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import columns as C
from corpusloom.functions import text as X
from corpusloom.functions import tokens as N
from corpusloom.functions.wordlists import LEMMAS
from corpusloom.operators import batches, classify, head, integrity, metrics, quality, ranking, selection, split, svm, vectorize
from corpusloom.operators import lemmas as rules
from corpusloom.operators import stages
from corpusloom.operators.vocabulary import Vocabulary, fit_vocabulary, term_statistics
from corpusloom.plans import inputs, runner
from corpusloom.session import fresh_path, materialise
from corpusloom.sources import folders, labelled_files, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Inverse regularization of the registered SVM; with a few hundred rows the published value keeps every weight near zero.
SVM_C = 10.0


def registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def r6(name: str) -> Column:
    return F.round(F.col(name), 6).alias(name)


def _split_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return split.add_validation_split(inputs.reviews(spark, folder), "doc_id", "pos")


def _split_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """Split reviews as token arrays, written once.

    Fitting and vectorizing both read them, some passes more than once; the join with the
    labels and the tokenizing are not repeated.
    """
    tokens = N.feature_tokens(F.col("text")).alias("tokens")
    rows = _split_reviews(spark, folder).select("doc_id", "pos", "validation_set", tokens)
    return materialise(rows, "split_tokens")


def _fitted(spark: SparkSession, folder: str, **options) -> tuple[DataFrame, Vocabulary]:
    """Split reviews with their counts in ``bow``, and the vocabulary of the training rows."""
    rows = _split_tokens(spark, folder)
    vocab = fit_vocabulary(split.train_rows(rows), "tokens", **options)
    return vectorize.bow_features(rows, "tokens", vocab).drop("tokens"), vocab


# ---- sources and ids -------------------------------------------------------------------------


@registered
def parse_review_path(spark, folder):
    """Split, folder, number and score of a file path (S3)."""
    part = quality.parse_path(F.col("path"))
    return inputs.file_listing(spark, folder).select(
        "path", *[part[n].alias(n) for n in ("split", "folder", "n_parts", "number", "score")]
    )


@registered
def review_ids(spark, folder):
    """Labels, folders and composite ids, forth and back."""
    rows = inputs.reviews(spark, folder).select(C.folder_of_label(F.col("pos")).alias("folder"), "doc_id")
    rows = rows.withColumn("pos", C.label_of_folder(F.col("folder")))
    rows = rows.withColumn("unique_id", C.composite_id(C.prefix_of_label(F.col("pos")), F.col("doc_id")))
    return rows.select(
        "unique_id", C.id_prefix(F.col("unique_id")).alias("prefix"), C.id_number(F.col("unique_id")).alias("number"),
        "pos", C.folder_of_label(F.col("pos").cast("string")).alias("folder"),
    )


@registered
def reviews_sorted_by_id(spark, folder):
    """The raw table in the order of prefix and number."""
    return labelled_files.sort_by_id(inputs.raw_reviews(spark, folder)).select("POS", "Unique_ID", "Score")


@registered
def labelled_files_round_trip(spark, folder):
    """The labelled documents written as files in folders, listed and read back."""
    rows = inputs.reviews(spark, folder)
    name = F.concat(F.when(F.col("lang") == "en", "train").otherwise("test"), F.lit("/"), C.folder_of_label(F.col("pos")), F.lit("/"),
                    F.col("doc_id"), F.lit("_"), F.col("n_chars") % 11, F.lit(".txt"))
    root = fresh_path(spark, "corpus")
    folders.write_texts(rows.withColumn("name", name), "name", "text", root)
    return labelled_files.read_labelled_text(spark, root)


@registered
def csv_round_trip(spark, folder):
    """The raw table written as fully quoted CSV and read back."""
    path = fresh_path(spark, "reviews") + ".csv"
    tables.write_csv(inputs.raw_reviews(spark, folder), path, quote_all=True)
    strict = tables.read_csv_strict(spark, path)
    return strict.select(
        F.col("POS").cast("int").alias("POS"), "Unique_ID", F.col("Score").cast("int").alias("Score"),
        F.coalesce("Review", F.lit("")).alias("Review"), F.col(tables.BAD_ROW).isNotNull().alias("bad_row"),
    )


@registered
def csv_minimal_round_trip(spark, folder):
    """The split table written with quotes only where needed and read back with types."""
    path = fresh_path(spark, "split") + ".csv"
    tables.write_csv(_split_reviews(spark, folder).select("doc_id", "pos", "text", "validation_set"), path)
    return tables.read_csv_typed(spark, path, "doc_id long, pos int, text string, validation_set int")


@registered
def csv_bad_rows(spark, folder):
    """All documents as quoted CSV lines, some with too few or too many fields, read strictly."""
    docs = inputs.documents(spark, folder)
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    start = F.concat((F.col("doc_id") % 2).cast("string"), F.lit(",D"), "doc_id")
    whole = F.concat(start, F.lit(","), (F.col("n_chars") % 10).cast("string"), F.lit(","), quoted)
    line = F.when(F.col("n_chars") % 7 == 0, start).when(F.col("n_chars") % 7 == 1, F.concat(whole, F.lit(",more"))).otherwise(whole)
    parts = 8
    rows = docs.select((F.col("doc_id") % parts).alias("part"), F.lit(1).alias("place"), line.alias("value"))
    first = spark.range(parts).select(F.col("id").alias("part"), F.lit(0).alias("place"), F.lit(",".join(tables.FOUR_NAMES)).alias("value"))
    path = fresh_path(spark, "lines")
    named = rows.union(first).withColumn("part", F.concat("part", F.lit(".csv")))
    named.repartition("part").sortWithinPartitions("part", "place").select("part", "value").write.partitionBy("part").text(path)
    strict = tables.read_csv_strict(spark, f"{path}/part=*.csv")
    bad = F.col(tables.BAD_ROW).isNotNull()
    return strict.select(
        "Unique_ID", F.col("POS").cast("int").alias("POS"), bad.alias("bad_row"), F.when(~bad, F.col("Score").cast("int")).alias("Score"),
        F.when(~bad, F.md5(F.coalesce("Review", F.lit("")))).alias("review_md5"),
    )


# ---- cleaning --------------------------------------------------------------------------------


@registered
def heavy_clean_pages(spark, folder):
    """Tags, entities, Unicode, whitespace and case."""
    pages = inputs.spread(inputs.table(spark, folder, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", X.heavy_clean(F.col("html")).alias("text"))


@registered
def light_clean_pages(spark, folder):
    """The light cleaning, which keeps the case (F8)."""
    pages = inputs.spread(inputs.table(spark, folder, "pages").select("page_id", "html"), "page_id")
    return pages.select("page_id", X.light_clean(F.col("html")).alias("text"))


@registered
def clean_steps_pages(spark, folder):
    """Lengths after each cleaning step."""
    pages = inputs.spread(inputs.table(spark, folder, "pages").select("page_id", "html"), "page_id")
    steps = pages.withColumn("a", X.strip_breaks(F.col("html"))).withColumn("b", X.strip_tags(F.col("a")))
    steps = steps.withColumn("c", X.decode_entities(F.col("b"))).withColumn("d", X.collapse_space(F.col("c")))
    return steps.select(
        "page_id", *[F.length(c).cast("long").alias(n) for c, n in
                     (("a", "no_breaks"), ("b", "no_tags"), ("c", "decoded"), ("d", "collapsed"))],
    )


@registered
def empty_after_cleaning(spark, folder):
    """Texts that cleaning leaves empty."""
    rows = inputs.documents(spark, folder).select(N.preprocess_text(F.col("text")).alias("clean"))
    return quality.count_empty(rows, "clean")


@registered
def words_and_symbols(spark, folder):
    """Tokens without spaces and punctuation."""
    tokens = N.words_and_symbols(X.heavy_clean(F.col("text")))
    return inputs.documents(spark, folder).select(
        "doc_id", F.size(tokens).cast("long").alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


@registered
def lemmas(spark, folder):
    """Lemmas by dictionary lookup, unknown forms kept."""
    tokens = N.lemmatize(N.words_and_symbols(X.heavy_clean(F.col("text"))), lowered=True)
    return inputs.documents(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("lemmas"))


@registered
def lemmas_from_table(spark, folder):
    """The same with the dictionary as a table, for dictionaries of any size."""
    table = spark.createDataFrame(sorted(LEMMAS.items()), "form string, lemma string")
    return N.lemmatize_with_table(_words(spark, folder), "t", table).select("doc_id", F.array_join("t", " ").alias("lemmas"))


def _words(spark: SparkSession, folder: str) -> DataFrame:
    return materialise(inputs.documents(spark, folder).select("doc_id", N.words_and_symbols(X.heavy_clean(F.col("text"))).alias("t")), "words")


@registered
def lemma_rules(spark, folder):
    """Form, lemma and rule of every inflected form of the documents."""
    return rules.lemma_table(_words(spark, folder), "t")


@registered
def lemmas_by_rules(spark, folder):
    """The documents' words as lemmas by those rules."""
    found = rules.lemmatize_by_rules(_words(spark, folder), "t")
    return found.select("doc_id", F.array_join("t", " ").alias("lemmas"))


@registered
def preprocessed_text(spark, folder):
    """Clean, tokenize, lemmatize, drop stop words but keep negations, join."""
    return inputs.documents(spark, folder).select(
        "doc_id", N.preprocess_text(F.col("text")).alias("text_preprocessed")
    )


@registered
def stop_word_anti_join(spark, folder):
    """Counts of the tokens that are no stop words, with the list as a table."""
    words = spark.createDataFrame([(w,) for w in N.default_stop_words()], "word string")
    docs = inputs.documents(spark, folder)
    counts = docs.select(F.explode(N.words_and_symbols(X.heavy_clean(F.col("text")))).alias("token"))
    counts = counts.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    return N.drop_stop_words_joined(counts, "token", words)


@registered
def feature_tokens(spark, folder):
    """Lower-cased runs of two or more word characters."""
    tokens = N.feature_tokens(F.col("text"))
    return inputs.documents(spark, folder).select("doc_id", F.array_join(tokens, " ").alias("tokens"))


@registered
def document_ngrams(spark, folder):
    """Number and hash of all 1- to 3-grams of each document, in order."""
    grams = N.ngrams(N.feature_tokens(F.col("text")))
    return inputs.documents(spark, folder).withColumn("g", grams).select(
        "doc_id", F.size("g").cast("long").alias("n_grams"), F.md5(F.array_join("g", "|")).alias("grams_md5")
    )


@registered
def truncated_tokens(spark, folder):
    """The first 500 tokens."""
    tokens = N.truncate_tokens(N.feature_tokens(F.col("text")), 500)
    return inputs.documents(spark, folder).select(
        "doc_id", F.size(tokens).cast("long").alias("n_tokens"), F.md5(F.array_join(tokens, " ")).alias("tokens_md5")
    )


@registered
def padded_batches(spark, folder):
    """Batches of 32 documents padded to the longest one."""
    docs = inputs.documents(spark, folder).select(
        "doc_id", F.expr("doc_id div 32").alias("batch"), N.feature_tokens(F.col("text")).alias("tokens")
    )
    padded = C.pad_batches(docs, "tokens", "batch")
    return padded.select(
        "doc_id", "batch", F.size("tokens").cast("long").alias("width"),
        F.size(F.filter("tokens", lambda t: t == "<pad>")).cast("long").alias("n_pad"),
    )


@registered
def length_batches(spark, folder):
    """Batches of 32 documents of nearly equal length, and their padding."""
    docs = inputs.documents(spark, folder).select("doc_id", F.size(N.feature_tokens(F.col("text"))).alias("n_tokens"))
    return batches.batch_by_length(docs, "n_tokens", "doc_id", 32)


@registered
def length_batch_waste(spark, folder):
    """What padding costs with and without batches of equal length."""
    docs = inputs.documents(spark, folder).select("doc_id", F.size(N.feature_tokens(F.col("text"))).alias("n_tokens"))
    by_length = batches.padding(batches.batch_by_length(docs, "n_tokens", "doc_id", 32), "n_tokens", "batch")
    by_id = batches.padding(docs.withColumn("batch", F.expr("doc_id div 32")), "n_tokens", "batch")
    return by_length.select(F.lit("length").alias("batched_by"), "*").union(by_id.select(F.lit("id").alias("batched_by"), "*"))


# ---- hashes and small functions --------------------------------------------------------------


@registered
def text_hashes(spark, folder):
    """SHA-256 and MD5 of each text."""
    return inputs.table(spark, folder, "documents").select(
        "doc_id", C.sha256_text(F.col("text")).alias("sha256"), C.md5_bytes(F.col("text")).alias("md5")
    )


@registered
def scalar_rules(spark, folder):
    """Digit test, casts, length, strip, null filling, flags as text, over names of all documents, good and bad."""
    kind = F.col("doc_id") % 6
    number = F.when(kind == 0, F.concat(F.lit("x"), "doc_id")).when(kind == 1, F.concat(F.lit(" "), "doc_id", F.lit(" ")))
    number = number.when(kind == 2, "").when(kind == 3, F.concat("doc_id", F.lit("000000000"))).when(kind == 4, F.col("doc_id").cast("string"))
    rows = inputs.documents(spark, folder).select("doc_id", number.alias("t"), F.col("n_chars"))
    return rows.select(
        "doc_id", C.yes_no(C.is_digits(F.coalesce("t", F.lit("")))).alias("is_digits"), F.coalesce(F.col("t").try_cast("int"), F.lit(-1)).alias("whole"),
        F.coalesce(F.length("t"), F.lit(0)).alias("length"), F.trim(F.coalesce("t", F.lit(" none "))).alias("stripped"),
        C.yes_no(F.col("t").isNull()).alias("missing"), (F.col("n_chars") % 2).cast("boolean").alias("odd"),
    )


@registered
def embedding_argmax(spark, folder):
    """Position of the largest value of a score array."""
    return inputs.table(spark, folder, "embeddings").select("vec_id", C.argmax(F.col("embedding")).alias("best"))


# ---- split and counts ------------------------------------------------------------------------


@registered
def validation_split(spark, folder):
    """Exact-size split per class, row ids kept."""
    return _split_reviews(spark, folder).select("doc_id", "pos", "validation_set")


@registered
def split_counts(spark, folder):
    """Rows per class on each side of the split."""
    rows = _split_reviews(spark, folder)
    return rows.groupBy("pos").agg(
        F.count_if(F.col("validation_set") == 0).alias("n_train"),
        F.count_if(F.col("validation_set") == 1).alias("n_validation"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@registered
def split_checks(spark, folder):
    """The checks of the split column (Q22, Q23)."""
    return quality.split_report(_split_reviews(spark, folder), label="pos")


@registered
def distinct_values(spark, folder):
    """Distinct values and their number (A2)."""
    rows = inputs.reviews(spark, folder)
    return rows.groupBy("lang").agg(
        F.count_distinct("pos").alias("n_labels"), F.count_distinct("doc_id").alias("n_ids"),
        F.count(F.lit(1)).alias("n_rows"),
    )


# ---- checks ----------------------------------------------------------------------------------


@registered
def file_structure_report(spark, folder):
    """All structure checks of the file listing (Q2-Q9)."""
    return quality.file_report(inputs.file_listing(spark, folder))


@registered
def first_bad_files(spark, folder):
    """Up to five files per folder that are not text files."""
    return quality.first_offenders(inputs.file_listing(spark, folder))


@registered
def duplicate_file_ids(spark, folder):
    """Structure checks where ids repeat: one file per turn of a conversation (Q9)."""
    turns = inputs.table(spark, folder, "conversations")
    name = F.concat(
        F.lit("/corpus/train/"), F.when(F.col("role") == "user", "pos").otherwise("neg"), F.lit("/0"),
        F.col("conv_id"), F.lit("_"), F.col("turn"), F.lit(".txt"),
    )
    return quality.file_report(turns.select(name.alias("path")))


def _turns(spark: SparkSession, folder: str) -> DataFrame:
    return inputs.table(spark, folder, "conversations").select(
        F.col("conv_id").alias("Unique_ID"), F.when(F.col("role") == "user", "1").otherwise("0").alias("POS"),
        F.col("turn").cast("string").alias("Score"), F.col("text").alias("Review"),
    )


@registered
def conversation_table_report(spark, folder):
    """All checks of a labelled table on turns of conversations, where ids repeat (Q13-Q19)."""
    return quality.table_report(_turns(spark, folder), "train")


@registered
def review_table_report(spark, folder):
    """The same checks on the raw reviews (Q13-Q19, U4)."""
    return quality.table_report(inputs.raw_reviews(spark, folder), "train")


@registered
def lineitem_table_report(spark, folder):
    """The same checks on a large table: order lines with the line number as score (Q13-Q19)."""
    lines = inputs.table(spark, folder, "lineitem").select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("Unique_ID"),
        F.when(F.col("l_returnflag") == "R", "1").otherwise("0").alias("POS"),
        F.col("l_quantity").cast("int").alias("Score"), F.col("l_returnflag").alias("Review"),
    )
    return quality.table_report(lines, "train")


@registered
def table_summary(spark, folder):
    """The measured values of the raw reviews in one row (Q20)."""
    return quality.table_summary(inputs.raw_reviews(spark, folder))


def _hash_checked(spark: SparkSession, folder: str) -> DataFrame:
    """Raw reviews against source texts that differ for some rows and lack others."""
    rows = inputs.raw_reviews(spark, folder)
    files = inputs.reviews(spark, folder).where(F.col("lang") != "es").select(
        F.lit("train").alias("split"), C.folder_of_label(F.col("pos")).alias("folder"),
        F.col("doc_id").alias("number"), (1 + F.col("n_chars") % 10).alias("score"),
        F.when(F.col("lang") == "fr", F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"),
    )
    return integrity.hash_check(rows, files, split="train")


@registered
def hash_check(spark, folder):
    """Text hashes of table and source files, joined on four keys."""
    return _hash_checked(spark, folder).select("Unique_ID", "hash_csv_review", "hash_original_file", "hash_match")


@registered
def hash_match_counts(spark, folder):
    """How many hashes match (Q25)."""
    return integrity.match_counts(_hash_checked(spark, folder))


# ---- vocabulary and features -----------------------------------------------------------------


@registered
def term_counts_per_document(spark, folder):
    """Term frequency of every n-gram in every document (A3)."""
    return vectorize.term_counts(inputs.documents(spark, folder), "text", "doc_id")


@registered
def train_term_statistics(spark, folder):
    """Document and corpus frequency over the training rows (A4, A5)."""
    return term_statistics(split.train_rows(_split_reviews(spark, folder)), "text")


@registered
def vocabulary_fit(spark, folder):
    """The bounded vocabulary of the training rows."""
    vocab = fit_vocabulary(split.train_rows(_split_tokens(spark, folder)), "tokens")
    return vocab.table(spark).select("term", "idx", "df", "cf", r6("idf"))


@registered
def bag_of_words(spark, folder):
    """Counts of the vocabulary's terms in all rows, joined back to the row's columns."""
    docs, vocab = _fitted(spark, folder)
    long = vectorize.long_features(docs, "bow", ["doc_id", "pos", "validation_set"], "tf")
    return vectorize.with_terms(long, vocab).select(
        "doc_id", "pos", "validation_set", "term", F.col("tf").cast("long").alias("tf")
    )


@registered
def bag_of_words_wide(spark, folder):
    """The export with one column per term, read back as its cells above zero and its number of term columns."""
    docs, vocab = _fitted(spark, folder)
    wide = vectorize.wide_features(docs.select("doc_id", "pos", "validation_set", "bow"), "bow", vocab)
    stored = materialise(wide, "bow_wide", form="orc")
    names = vectorize.feature_names(stored.columns)
    filled = vectorize.filled_cells(stored, "doc_id", names)
    width = stored.agg(F.lit(None).cast("long").alias("doc_id"), F.lit("columns").alias("ngram_column"), F.lit(len(names)).cast("long").alias("tf"))
    return filled.union(width)


@registered
def safe_column_names(spark, folder):
    """Terms as column names, and back without the prefix."""
    stats = term_statistics(split.train_rows(_split_reviews(spark, folder)), "text")
    named = stats.select("term", C.safe_name(F.col("term")).alias("ngram_column"))
    return named.withColumn("ngram", C.without_prefix(F.col("ngram_column")))


@registered
def tfidf_weights(spark, folder):
    """TF-IDF of all rows with the training vocabulary."""
    docs, vocab = _fitted(spark, folder)
    weighted = vectorize.tfidf_features(docs, "bow", vocab)
    long = vectorize.long_features(weighted, "tfidf", ["doc_id", "validation_set"], "tfidf")
    return vectorize.with_terms(long, vocab).select("doc_id", "validation_set", "term", r6("tfidf"))


@registered
def tfidf_of_new_texts(spark, folder):
    """TF-IDF of unlabelled texts with the stored vocabulary."""
    vocab = fit_vocabulary(split.train_rows(_split_tokens(spark, folder)), "tokens")
    new = inputs.spread(inputs.table(spark, folder, "benchmark"), "item_id")
    weighted = vectorize.tfidf_features(vectorize.bow_features(new, "text", vocab), "bow", vocab)
    long = vectorize.long_features(weighted, "tfidf", ["item_id"], "tfidf")
    return vectorize.with_terms(long, vocab).select("item_id", "term", r6("tfidf"))


def _reloaded(spark: SparkSession, folder: str, *later: Estimator) -> PipelineModel:
    """A pipeline of the vocabulary and ``later`` stages, fitted on the training rows, saved and loaded again."""
    train = split.train_rows(_split_tokens(spark, folder)).withColumnRenamed("tokens", "text")
    path = fresh_path(spark, "pipeline")
    Pipeline(stages=[stages.NgramVocabulary(inputCol="text", outputCol="bow"), *later]).fit(train).save(path)
    return PipelineModel.load(path)


@registered
def saved_tfidf_of_new_texts(spark, folder):
    """TF-IDF of unlabelled texts by a pipeline that was saved and loaded."""
    model = _reloaded(spark, folder, stages.TfIdf())
    new = model.transform(inputs.spread(inputs.table(spark, folder, "benchmark"), "item_id"))
    long = vectorize.long_features(new, "tfidf", ["item_id"], "tfidf")
    return vectorize.with_terms(long, model.stages[0].fitted).select("item_id", "term", r6("tfidf"))


@registered
def saved_naive_bayes_new_texts(spark, folder):
    """Predicted class of unlabelled texts by a pipeline that was saved and loaded."""
    model = _reloaded(spark, folder, stages.MultinomialNB())
    new = inputs.spread(inputs.table(spark, folder, "benchmark"), "item_id")
    return model.transform(new).select("item_id", "prediction")


# ---- rankings --------------------------------------------------------------------------------


@registered
def top_ngrams_total(spark, folder):
    """Top 50 n-grams per class by total count."""
    docs, vocab = _fitted(spark, folder)
    return ranking.top_bow_total(docs, "bow", "pos", vocab)


@registered
def top_ngrams_distinctive(spark, folder):
    """Top 50 n-grams per class by difference of mean counts."""
    docs, vocab = _fitted(spark, folder)
    top = ranking.top_bow_distinctive(docs, "bow", "pos", vocab)
    return top.select(
        "class", "rank", "ngram_column", "ngram", r6("mean_bow_pos"), r6("mean_bow_neg"), r6("distinctiveness_score")
    )


@registered
def top_tfidf_mean(spark, folder):
    """Top 50 n-grams per class by mean TF-IDF of the training rows."""
    docs, vocab = _fitted(spark, folder)
    top = ranking.top_tfidf(vectorize.tfidf_features(docs, "bow", vocab), "tfidf", "pos", vocab)
    return top.select("class", "rank", "ngram", r6("mean_tfidf"))


@registered
def top_tfidf_distinctive(spark, folder):
    """Top 50 n-grams per class by difference of mean TF-IDF."""
    docs, vocab = _fitted(spark, folder)
    top = ranking.top_tfidf_distinctive(vectorize.tfidf_features(docs, "bow", vocab), "tfidf", "pos", vocab)
    return top.select("class", "rank", "ngram", r6("mean_tfidf_pos"), r6("mean_tfidf_neg"), r6("distinctiveness_score"))


@registered
def top_preprocessed_ngrams(spark, folder):
    """Top 50 n-grams per class of the cleaned, lemmatized text."""
    tokens = N.feature_tokens(N.preprocess_text(F.col("text"))).alias("tokens")
    rows = materialise(_split_reviews(spark, folder).select("doc_id", "pos", "validation_set", tokens), "clean_tokens")
    vocab = fit_vocabulary(split.train_rows(rows), "tokens")
    return ranking.top_bow_total(vectorize.bow_features(rows, "tokens", vocab), "bow", "pos", vocab)


# ---- models ----------------------------------------------------------------------------------


def _naive_bayes(spark: SparkSession, folder: str):
    docs, vocab = _fitted(spark, folder)
    model = classify.fit_naive_bayes(split.train_rows(docs), "bow", "pos", len(vocab))
    return docs, vocab, model


@registered
def class_term_totals(spark, folder):
    """How often each term occurs in the training rows of each class."""
    docs, vocab = _fitted(spark, folder)
    totals = classify.class_totals(split.train_rows(docs), "bow", "pos")
    return vectorize.with_terms(totals, vocab).select("pos", "term", F.col("total").cast("long").alias("total"))


@registered
def naive_bayes_model(spark, folder):
    """Log probabilities and class priors (M5)."""
    _, vocab, model = _naive_bayes(spark, folder)
    weights = model.weights(spark).join(F.broadcast(model.priors(spark)), "pos")
    return vectorize.with_terms(weights, vocab).select("pos", "term", r6("logp"), r6("log_prior"))


@registered
def naive_bayes_predictions(spark, folder):
    """Predicted class of every row (M6)."""
    docs, _, model = _naive_bayes(spark, folder)
    scored = model.predict(docs, "bow")
    return scored.select(
        "doc_id", "pos", "validation_set", "prediction",
        F.round(F.col("scores")[0], 4).alias("score_neg"), F.round(F.col("scores")[1], 4).alias("score_pos"),
    )


@registered
def naive_bayes_new_texts(spark, folder):
    """Predicted class of unlabelled texts with the stored vocabulary (M9)."""
    _, vocab, model = _naive_bayes(spark, folder)
    new = inputs.spread(inputs.table(spark, folder, "benchmark"), "item_id")
    return model.predict(vectorize.bow_features(new, "text", vocab), "bow").select("item_id", "prediction")


@registered
def naive_bayes_validation_metrics(spark, folder):
    """Confusion counts and quality on the validation rows."""
    docs, _, model = _naive_bayes(spark, folder)
    scored = model.predict(split.validation_rows(docs), "bow")
    row = metrics.evaluate(scored, "MNB_BOW")
    return row.select("model", *metrics.COUNTS, *[r6(c) for c in metrics.TEST_COLUMNS[6:]])


def _compared(spark: SparkSession, folder: str) -> DataFrame:
    """Naive Bayes with two smoothings, on the validation rows."""
    docs, vocab, model = _naive_bayes(spark, folder)
    other = classify.fit_naive_bayes(split.train_rows(docs), "bow", "pos", len(vocab), alpha=0.1)
    rows = other.predict(model.predict(split.validation_rows(docs), "bow", "one").drop("scores"), "bow", "tenth")
    return metrics.compare_predictions(rows, "pos", {"MNB_BOW": "one", "MNB_BOW_0.1": "tenth"})


@registered
def model_comparison(spark, folder):
    """One row of measures per model."""
    return _compared(spark, folder).select("model", *metrics.COUNTS, *[r6(c) for c in metrics.TEST_COLUMNS[6:]])


@registered
def best_model(spark, folder):
    """The model with the best F-score."""
    return metrics.best_run(_compared(spark, folder)).select("model", *metrics.COUNTS, r6("f-score"))


@registered
def naive_bayes_grid(spark, folder):
    """Every smoothing and prior on every fold of the training rows."""
    docs, vocab = _fitted(spark, folder)
    scores = selection.grid_scores(split.train_rows(docs), "bow", "pos", "doc_id", len(vocab))
    return scores.select("alpha", "prior", "fold", *metrics.COUNTS, *[r6(c) for c in metrics.TEST_COLUMNS[6:]])


@registered
def naive_bayes_best_setting(spark, folder):
    """The setting with the best mean F-score over the folds."""
    docs, vocab = _fitted(spark, folder)
    scores = selection.grid_scores(split.train_rows(docs), "bow", "pos", "doc_id", len(vocab))
    return selection.best_setting(scores).select("alpha", "prior", r6("f-score"))


def _svm(spark: SparkSession, folder: str) -> tuple[DataFrame, Vocabulary, svm.LinearSVM]:
    """TF-IDF rows, and the SVM with balanced classes fitted on the training rows, closely enough to compare digits."""
    docs, vocab = _fitted(spark, folder)
    weighted = materialise(vectorize.tfidf_features(docs, "bow", vocab).drop("bow"), "tfidf")
    model = svm.fit_squared_hinge(split.train_rows(weighted), "pos", "tfidf", len(vocab), SVM_C, "balanced", tolerance=1e-8)
    return weighted, vocab, model


@registered
def linear_svm_predictions(spark, folder):
    """Linear SVM with squared hinge loss on TF-IDF: prediction and margin of every row (M7, M8)."""
    weighted, _, model = _svm(spark, folder)
    scored = model.predict(weighted, "tfidf")
    return scored.select("doc_id", "pos", "validation_set", "prediction", F.round("margin", 3).alias("margin"))


@registered
def linear_svm_weights(spark, folder):
    """The fitted weights by term, the intercept and the objective, and whether the gradient vanishes there (M7)."""
    _, vocab, model = _svm(spark, folder)
    weights = vectorize.with_terms(model.table(spark), vocab).select("term", F.round("weight", 4).alias("weight"))
    rest = [("# intercept", round(model.intercept, 4)), ("# objective", round(model.objective, 4)), ("# gradient", round(model.gradient_norm, 4))]
    return weights.union(spark.createDataFrame(rest, "term string, weight double"))


@registered
def linear_margin_predictions(spark, folder):
    """Prediction from given weights: the difference of the classes' mean TF-IDF on the training rows (M8)."""
    docs, vocab = _fitted(spark, folder)
    weighted = materialise(vectorize.tfidf_features(docs, "bow", vocab).drop("bow"), "tfidf")
    train = split.train_rows(weighted)
    sizes = {r["pos"]: r["count"] for r in train.groupBy("pos").count().collect()}
    long = vectorize.long_features(train, "tfidf", ["pos"], "tfidf")
    mean = F.when(F.col("pos") == 1, F.col("tfidf") / sizes.get(1, 1)).otherwise(-F.col("tfidf") / sizes.get(0, 1))
    weights = {r["idx"]: r["w"] for r in long.groupBy("idx").agg(F.sum(mean).alias("w")).collect()}
    scored = classify.predict_linear([weights.get(i, 0.0) for i in range(len(vocab))], 0.0, weighted, "tfidf")
    return scored.select("doc_id", "pos", "validation_set", F.round("margin", 6).alias("margin"))


@registered
def vector_head_predictions(spark, folder):
    """Classification head on given text vectors."""
    rows = inputs.table(spark, folder, "embeddings").withColumn("pos", (F.col("label") < 5).cast("int"))
    rows = split.add_validation_split(rows, "vec_id", "pos")
    model = head.fit_vector_head(split.train_rows(rows), "embedding", "pos")
    return model.predict(rows, "embedding").select("vec_id", "pos", "validation_set", "prediction", F.round("probability", 4).alias("probability"))


@registered
def naive_bayes_run_rows(spark, folder):
    """Results table of two runs, one of them repeated, read back without its clock columns."""
    docs, vocab = _fitted(spark, folder)
    train, path = split.train_rows(docs), fresh_path(spark, "validation_metrics")
    for run, alpha in (("first", 1.0), ("second", 0.1), ("first", 1.0)):
        model, seconds = classify.timed(classify.fit_naive_bayes, train, "bow", "pos", len(vocab), alpha)
        scored = model.predict(split.validation_rows(docs), "bow")
        tables.append_run(metrics.evaluate(scored, "MNB_BOW", training_seconds=seconds), path, run)
    schema = "timestamp string, model string, TP long, FP long, TN long, FN long, accuracy double, " \
             "precision double, recall double, `f-score` double, training_time_seconds double"
    runs = tables.read_runs(spark, path, schema)
    return runs.select("run", "model", *metrics.COUNTS, *[r6(c) for c in metrics.TEST_COLUMNS[6:]])


@registered
def run_metadata(spark, folder):
    """Nested run metadata as JSON text."""
    docs, _, model = _naive_bayes(spark, folder)
    scored = model.predict(docs, "bow")
    counts = metrics.with_quality(metrics.confusion_counts(split.validation_rows(scored), "pos", "prediction"))
    sizes = scored.agg(
        F.count_if(F.col("validation_set") == 0).alias("t"), F.count_if(F.col("validation_set") == 1).alias("v")
    ).first()
    nested = metrics.run_metadata(
        counts, model_name="MNB_BOW", max_length=500, epochs=1, lr=0.00001, weight_decay=0.01,
        train_size=sizes["t"], val_size=sizes["v"], training_seconds=0.0,
    )
    return nested.select(
        F.to_json(F.struct("model_name", "train_size", "val_size", "confusion_matrix")).alias("metadata")
    )


@registered
def end_to_end_run(spark, folder):
    """Every step in order, each with counts of what it made: (step, measure, value).

    Only the call of an external model is left out, which the tables cannot feed.
    """
    violations = F.sum("violations").alias("violations")
    steps = {
        "check_files": file_structure_report(spark, folder).agg(violations),
        "check_table": review_table_report(spark, folder).agg(violations),
        "check_hashes": hash_match_counts(spark, folder),
        **runner.run_on_tables(spark, folder),
    }

    def lines(step: str, row: DataFrame) -> DataFrame:
        pairs = F.array(*[F.struct(F.lit(c).alias("measure"), F.col(c).cast("long").alias("value")) for c in row.columns])
        return row.select(F.lit(step).alias("step"), F.explode(pairs).alias("p")).select("step", "p.*")

    return reduce(DataFrame.union, [lines(step, row) for step, row in steps.items()])

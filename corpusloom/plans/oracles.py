"""SQL for each registered query, written independently for a second engine (DuckDB dialect)."""

from __future__ import annotations

from corpusloom.functions.wordlists import DETACHMENTS, LEMMAS, NEGATIONS
from corpusloom.plans.stopwords import SPARK_ENGLISH

ORACLES: dict[str, str] = {}

# Characters that count as white space, and a run of two or more word characters.
WS = r"[\s\x1c-\x1f\x85\p{Z}]"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def _list(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


REVIEWS = """
reviews AS (
  SELECT d.doc_id, d.text, d.lang, d.n_chars, CAST(l.quality AS INTEGER) AS pos
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""

RAW = """
raw AS (
  SELECT pos AS "POS", (CASE WHEN pos = 1 THEN 'POS' ELSE 'NEG' END) || doc_id AS "Unique_ID",
         CAST(1 + n_chars % 10 AS INTEGER) AS "Score", text AS "Review", lang
  FROM reviews
)"""

LISTING = """
listing AS (
  SELECT d.doc_id,
         '/corpus/' || CASE WHEN d.lang = 'en' THEN 'train' ELSE 'test' END || '/' ||
         CASE WHEN l.quality = 1 THEN 'pos' ELSE 'neg' END || '/' || d.doc_id || '_' || (d.n_chars % 12) ||
         CASE WHEN l.toxic = 1 THEN '_x.md' ELSE '.txt' END AS path
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id
)"""


def _split(source: str, key: str, label: str, out: str, column: str = "validation_set", seed: int = 20260225) -> str:
    return f"""
{out} AS (
  SELECT * EXCLUDE (_rn, _n), CAST(CASE WHEN _rn <= floor(_n * CAST(0.2 AS DOUBLE)) THEN 1 ELSE 0 END AS INTEGER) AS {column}
  FROM (
    SELECT *, row_number() OVER (PARTITION BY {label} ORDER BY md5('{seed}|' || {key}), {key}) AS _rn,
           count(*) OVER (PARTITION BY {label}) AS _n
    FROM {source}
  )
)"""


def _grams(source: str, key: str, text: str, out: str) -> str:
    return f"""
{out}_tok AS (SELECT {key}, regexp_extract_all(lower({text}), '{TOKEN}') AS t FROM {source}),
{out} AS (
  SELECT {key}, term, count(*) AS tf FROM (
    SELECT {key}, unnest(list_concat(t,
        list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]),
        list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2]))) AS term
    FROM {out}_tok)
  GROUP BY {key}, term
)"""


SPLIT = REVIEWS + "," + _split("reviews", "doc_id", "pos", "split")
TF = SPLIT + "," + _grams("split", "doc_id", "text", "tf")
STATS = TF + """,
stats AS (
  SELECT term, count(*) AS df, CAST(sum(tf) AS BIGINT) AS cf
  FROM tf JOIN split USING (doc_id) WHERE validation_set = 0 GROUP BY term
)"""


def _vocab(split: str = "split", k: int = 7500) -> str:
    return f"""
n_train AS (SELECT count(*) AS n FROM {split} WHERE validation_set = 0),
vocab AS (
  SELECT term, CAST(row_number() OVER (ORDER BY term) - 1 AS INTEGER) AS idx, df, cf,
         ln((1 + n) / CAST(1 + df AS DOUBLE)) + 1 AS idf
  FROM (
    SELECT *, row_number() OVER (ORDER BY cf DESC, term) AS r FROM stats, n_train
    WHERE df >= 2 AND df <= CAST(0.95 AS DOUBLE) * CAST(n AS DOUBLE)
  ) WHERE r <= {k}
)"""


VOCAB = STATS + "," + _vocab()
BOW = VOCAB + """,
bow AS (SELECT doc_id, pos, validation_set, term, idx, idf, tf FROM tf JOIN vocab USING (term) JOIN split USING (doc_id))"""

SAFE = (
    f"substring('bow_' || regexp_replace(regexp_replace(lower(regexp_replace(term, '^{WS}+|{WS}+$', '', 'g')), "
    f"'{WS}+', '_', 'g'), '[^a-z0-9_]+', '', 'g'), 1, 80)"
)
# The name of the exported column: repeated names get the index appended.
NAMED = f"""
named AS (
  SELECT term, idx, CASE WHEN row_number() OVER (PARTITION BY safe ORDER BY idx) = 1 THEN safe
                         ELSE safe || '_' || idx END AS ngram_column
  FROM (SELECT term, idx, {SAFE} AS safe FROM vocab)
)"""

TFIDF = BOW + """,
weighted AS (SELECT *, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM bow),
tfidf AS (
  SELECT doc_id, pos, validation_set, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM weighted
)"""


def _sql(ctes: str, query: str) -> str:
    return f"WITH {ctes.strip()}\n{query.strip()}"


def _svm(c: float, cost: str) -> str:
    """The minimum of the dual of the squared hinge SVM, by accelerated projected gradients over ``split`` and ``tfidf``."""
    return f"""
svm_rows AS MATERIALIZED (
  SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, CASE WHEN pos = 1 THEN 1 ELSE -1 END AS y, CAST({cost} AS DOUBLE) AS cost
  FROM split WHERE validation_set = 0),
svm_pairs AS (
  SELECT a.i, b.i AS j, sum(s.tfidf * t.tfidf) AS k
  FROM tfidf s JOIN tfidf t USING (term) JOIN svm_rows a ON a.doc_id = s.doc_id JOIN svm_rows b ON b.doc_id = t.doc_id GROUP BY a.i, b.i),
svm_lines AS (
  SELECT a.i, any_value(1 / (2 * {c} * a.cost)) AS d, list(CAST(a.y * b.y * (1 + COALESCE(k, 0)) + CASE WHEN a.i = b.i THEN 1 / (2 * {c} * a.cost) ELSE 0 END AS DOUBLE) ORDER BY b.i) AS q
  FROM svm_rows a CROSS JOIN svm_rows b LEFT JOIN svm_pairs p ON p.i = a.i AND p.j = b.i GROUP BY a.i),
svm_matrix AS MATERIALIZED (
  SELECT list(q ORDER BY i) AS m, max(list_sum(list_transform(q, lambda v: abs(v)))) AS big, min(d) AS small FROM svm_lines),
svm_steps AS (
  SELECT 0 AS step, list_transform(m, lambda r: CAST(0 AS DOUBLE)) AS a, list_transform(m, lambda r: CAST(0 AS DOUBLE)) AS z FROM svm_matrix
  UNION ALL
  SELECT step + 1, new, list_transform(list_zip(new, a), lambda p: p[1] + momentum * (p[1] - p[2]))
  FROM (
    SELECT step, a, (sqrt(big / small) - 1) / (sqrt(big / small) + 1) AS momentum,
           list_transform(list_zip(m, z), lambda p: greatest(0, p[2] - (list_dot_product(p[1], z) - 1) / big)) AS new
    FROM svm_steps, svm_matrix WHERE step < 28 * sqrt(big / small))),
svm_dual AS MATERIALIZED (
  SELECT doc_id, y, cost, a[i] AS a FROM svm_rows CROSS JOIN (SELECT a FROM svm_steps ORDER BY step DESC LIMIT 1)),
svm_weights AS MATERIALIZED (SELECT term, sum(a * y * tfidf) AS w FROM svm_dual JOIN tfidf USING (doc_id) GROUP BY term),
svm_intercept AS (SELECT sum(a * y) AS b FROM svm_dual)"""


def _svm_margins(rows: str, tfidf: str) -> str:
    return f"""SELECT s.*, b + COALESCE(f, 0) AS margin, CAST(CASE WHEN b + COALESCE(f, 0) > 0 THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM {rows} s CROSS JOIN svm_intercept LEFT JOIN (SELECT doc_id, sum(tfidf * w) AS f FROM {tfidf} JOIN svm_weights USING (term) GROUP BY doc_id) USING (doc_id)"""


_BALANCED = "count(*) OVER () / (2.0 * count(*) OVER (PARTITION BY pos))"


def _top(source: str, pos: str, neg: str, order: str = "round(score, 12)") -> str:
    return f"""
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY class ORDER BY {order} DESC, term) AS INTEGER) AS rank FROM (
    SELECT *, 'POS' AS class, {pos} AS score FROM {source}
    UNION ALL SELECT *, 'NEG' AS class, {neg} AS score FROM {source})
  QUALIFY rank <= 50
)"""


# ---- sources and ids -------------------------------------------------------------------------

ORACLES["parse_review_path"] = _sql(REVIEWS + "," + LISTING, r"""
SELECT path, split_part(path, '/', 3) AS split, split_part(path, '/', 4) AS folder,
       CAST(CASE WHEN path LIKE '%_x.md' THEN 3 ELSE 2 END AS INTEGER) AS n_parts,
       CASE WHEN path LIKE '%_x.md' THEN NULL ELSE CAST(doc_id AS BIGINT) END AS number,
       CASE WHEN path LIKE '%_x.md' THEN NULL
            ELSE CAST(regexp_extract(path, '_(\d+)\.txt$', 1) AS INTEGER) END AS score
FROM listing""")

ORACLES["review_ids"] = _sql(REVIEWS, """
SELECT CASE WHEN pos = 1 THEN 'POS' ELSE 'NEG' END || doc_id AS unique_id,
       CASE WHEN pos = 1 THEN 'POS' ELSE 'NEG' END AS prefix, doc_id AS number, pos,
       CASE WHEN pos = 1 THEN 'pos' ELSE 'neg' END AS folder
FROM reviews""")

ORACLES["reviews_sorted_by_id"] = _sql(REVIEWS + "," + RAW, """
SELECT "POS", "Unique_ID", "Score" FROM raw
ORDER BY substring("Unique_ID", 1, 3), CAST(substring("Unique_ID", 4) AS BIGINT)""")

ORACLES["labelled_files_round_trip"] = _sql(REVIEWS, """
SELECT CASE WHEN lang = 'en' THEN 'train' ELSE 'test' END AS split, pos AS "POS", (CASE WHEN pos = 1 THEN 'POS' ELSE 'NEG' END) || doc_id AS "Unique_ID",
       CAST(n_chars % 11 AS INTEGER) AS "Score", text AS "Review" FROM reviews""")
ORACLES["csv_round_trip"] = _sql(REVIEWS + "," + RAW, """
SELECT "POS", "Unique_ID", "Score", "Review", false AS bad_row FROM raw""")

ORACLES["csv_bad_rows"] = """
SELECT 'D' || doc_id AS "Unique_ID", CAST(doc_id % 2 AS INTEGER) AS "POS", n_chars % 7 IN (0, 1) AS bad_row,
       CASE WHEN n_chars % 7 NOT IN (0, 1) THEN CAST(n_chars % 10 AS INTEGER) END AS "Score",
       CASE WHEN n_chars % 7 NOT IN (0, 1) THEN md5(text) END AS review_md5 FROM documents"""
ORACLES["csv_minimal_round_trip"] = _sql(SPLIT, "SELECT doc_id, pos, text, validation_set FROM split")

# ---- cleaning --------------------------------------------------------------------------------

_NO_BREAKS = f"regexp_replace(html, '(?i)<br{WS}*/?>', ' ', 'g')"
_NO_TAGS = f"regexp_replace({_NO_BREAKS}, '<[^>]+>', ' ', 'g')"
# The pages hold these four entities only, some without their semicolon, which HTML allows for
# them; their text is in NFKC form already.
_DECODED = _NO_TAGS
for _entity, _char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '&{_entity};?', '{_char}', 'g')"
_COLLAPSED = f"trim(regexp_replace({_DECODED}, '{WS}+', ' ', 'g'))"

ORACLES["heavy_clean_pages"] = f"SELECT page_id, lower({_COLLAPSED}) AS text FROM pages"
ORACLES["light_clean_pages"] = f"SELECT page_id, {_COLLAPSED} AS text FROM pages"
ORACLES["clean_steps_pages"] = f"""
SELECT page_id, length({_NO_BREAKS}) AS no_breaks, length({_NO_TAGS}) AS no_tags, length({_DECODED}) AS decoded,
       length({_COLLAPSED}) AS collapsed FROM pages"""

# The documents hold no entities and no tags.
_WORDS = rf"""
words AS (
  SELECT doc_id, list_transform(regexp_extract_all(s, 'n’t|’(?:ll|re|ve|s|m|d)|[\p{{L}}\p{{N}}_]+|\p{{S}}'),
                                lambda x: replace(x, '’', '''')) AS w
  FROM (
    SELECT doc_id, regexp_replace(regexp_replace(replace(
             lower(trim(regexp_replace(text, '{WS}+', ' ', 'g'))), '’', ''''),
             '(\p{{L}})n''t', '\1 n’t', 'g'),
             '([\p{{L}}\p{{N}}])''(ll|re|ve|s|m|d)([^\p{{L}}\p{{N}}_]|$)', '\1 ’\2\3', 'g') AS s
    FROM documents)
)"""
_LEMMA_MAP = "lemma_map AS (SELECT * FROM (VALUES " + ", ".join(
    "('" + f.replace("'", "''") + "', '" + m + "')" for f, m in LEMMAS.items()
) + ") AS v(form, lemma))"
_LEMMAS = _WORDS + ", " + _LEMMA_MAP + """,
tokens AS (SELECT doc_id, unnest(w) AS form, unnest(range(len(w))) AS i FROM words),
lemmas AS (SELECT doc_id, i, COALESCE(lemma, form) AS lemma FROM tokens LEFT JOIN lemma_map USING (form))"""
_STOP = f"""
stop AS (SELECT word FROM (SELECT unnest([{_list(SPARK_ENGLISH)}]) AS word) WHERE word NOT IN ({_list(NEGATIONS)}))"""
_CLEAN = _LEMMAS + "," + _STOP + """,
kept AS (SELECT doc_id, i, lemma FROM lemmas WHERE lemma NOT IN (SELECT word FROM stop)),
joined AS (SELECT doc_id, string_agg(lemma, ' ' ORDER BY i) AS text FROM kept GROUP BY doc_id),
clean AS (SELECT d.doc_id, COALESCE(j.text, '') AS text FROM documents d LEFT JOIN joined j USING (doc_id))"""

ORACLES["words_and_symbols"] = _sql(
    _WORDS, "SELECT doc_id, len(w) AS n_tokens, array_to_string(w, ' ') AS tokens FROM words")
ORACLES["lemmas"] = _sql(_LEMMAS, """
SELECT d.doc_id, COALESCE(l.lemmas, '') AS lemmas FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(lemma, ' ' ORDER BY i) AS lemmas FROM lemmas GROUP BY doc_id) l USING (doc_id)""")
ORACLES["lemmas_from_table"] = ORACLES["lemmas"]
_DETACHED = ",\n".join(
    f"  ({n}, CASE WHEN ends_with(form, '{ending}') AND length(form) > {len(ending) + doubled}" + (
        f" AND form[-{len(ending) + 1}] = form[-{len(ending) + 2}] AND form[-{len(ending) + 1}] NOT IN ('a', 'e', 'i', 'o', 'u')" if doubled else ""
    ) + (" AND form[-2] NOT IN ('s', 'u', 'i')" if ending == "s" else "")
    + f" THEN form[:length(form) - {len(ending) + doubled}] || '{put}' END)"
    for n, (ending, put, doubled) in enumerate(DETACHMENTS, 1))
_BY_RULE = _WORDS + ", " + _LEMMA_MAP + f""",
tokens AS (SELECT doc_id, unnest(w) AS form, unnest(range(len(w))) AS i FROM words),
forms AS (SELECT form, count(*) AS n FROM tokens WHERE form <> '' GROUP BY form),
ways AS (
  SELECT form, rule, lemma FROM (SELECT form FROM forms WHERE regexp_full_match(form, '\\p{{L}}+') AND form NOT IN (SELECT form FROM lemma_map)),
  LATERAL (VALUES {_DETACHED}) AS v(rule, lemma)),
attested AS (
  SELECT form, rule, lemma FROM ways WHERE length(lemma) >= 3 AND lemma IN (SELECT form FROM forms WHERE n >= 2)
  QUALIFY row_number() OVER (PARTITION BY form ORDER BY rule) = 1),
lemma_rules AS (
  SELECT form, lemma, rule FROM attested
  UNION ALL SELECT form, lemma, 0 FROM forms JOIN lemma_map USING (form) WHERE form <> lemma)"""
ORACLES["lemma_rules"] = _sql(_BY_RULE, "SELECT form, lemma, CAST(rule AS INTEGER) AS rule FROM lemma_rules")
ORACLES["lemmas_by_rules"] = _sql(_BY_RULE, """
SELECT d.doc_id, COALESCE(l.lemmas, '') AS lemmas FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(COALESCE(lemma, form), ' ' ORDER BY i) AS lemmas FROM tokens LEFT JOIN lemma_rules USING (form) GROUP BY doc_id) l USING (doc_id)""")
ORACLES["preprocessed_text"] = _sql(_CLEAN, "SELECT doc_id, text AS text_preprocessed FROM clean")
ORACLES["empty_after_cleaning"] = _sql(_CLEAN, """
SELECT count(*) FILTER (WHERE length(text) = 0) AS empty_count, count(*) AS row_count FROM clean""")
ORACLES["stop_word_anti_join"] = _sql(_WORDS + "," + _STOP, """
SELECT token, count(*) AS n FROM (SELECT unnest(w) AS token FROM words)
WHERE token NOT IN (SELECT word FROM stop) GROUP BY token""")

_ALL_TOKENS = f"toks AS (SELECT doc_id, regexp_extract_all(lower(text), '{TOKEN}') AS t FROM documents)"

ORACLES["feature_tokens"] = _sql(_ALL_TOKENS, "SELECT doc_id, array_to_string(t, ' ') AS tokens FROM toks")
ORACLES["document_ngrams"] = _sql(_ALL_TOKENS + """,
grams AS (
  SELECT doc_id, list_concat(t,
    list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]),
    list_transform(range(1, len(t) - 1), lambda i: t[i] || ' ' || t[i + 1] || ' ' || t[i + 2])) AS g FROM toks)""", """
SELECT doc_id, len(g) AS n_grams, md5(array_to_string(g, '|')) AS grams_md5 FROM grams""")
ORACLES["truncated_tokens"] = _sql(_ALL_TOKENS, """
SELECT doc_id, len(t[1:500]) AS n_tokens, md5(array_to_string(t[1:500], ' ')) AS tokens_md5 FROM toks""")
ORACLES["padded_batches"] = _sql(_ALL_TOKENS, """
SELECT doc_id, doc_id // 32 AS batch, max(len(t)) OVER (PARTITION BY doc_id // 32) AS width,
       max(len(t)) OVER (PARTITION BY doc_id // 32) - len(t) AS n_pad FROM toks""")

_LENGTHS = _ALL_TOKENS + """,
lengths AS (SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens FROM toks),
batched AS (SELECT *, (row_number() OVER (ORDER BY n_tokens, md5(CAST(doc_id AS VARCHAR)), doc_id) - 1) // 32 AS batch FROM lengths)"""
ORACLES["length_batches"] = _sql(_LENGTHS, """
SELECT doc_id, n_tokens, batch, max(n_tokens) OVER (PARTITION BY batch) AS width FROM batched""")
_PADDING = """
SELECT '{name}' AS batched_by, count(*) AS batches, CAST(sum(t) AS BIGINT) AS tokens, CAST(sum(n * w) AS BIGINT) AS padded, round(1 - sum(t) / CAST(sum(n * w) AS DOUBLE), 6) AS waste
FROM (SELECT count(*) AS n, sum(n_tokens) AS t, max(n_tokens) AS w FROM batched GROUP BY {batch})"""
ORACLES["length_batch_waste"] = _sql(_LENGTHS, _PADDING.format(name="length", batch="batch") + " UNION ALL " + _PADDING.format(name="id", batch="doc_id // 32"))

# ---- hashes and small functions --------------------------------------------------------------

ORACLES["text_hashes"] = "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents"

ORACLES["scalar_rules"] = """
SELECT doc_id, CASE WHEN regexp_full_match(COALESCE(t, ''), '[0-9]+') THEN 'TRUE' ELSE 'FALSE' END AS is_digits,
       COALESCE(TRY_CAST(NULLIF(trim(t), '') AS INTEGER), -1) AS whole, CAST(COALESCE(length(t), 0) AS INTEGER) AS length,
       trim(COALESCE(t, ' none ')) AS stripped, CASE WHEN t IS NULL THEN 'TRUE' ELSE 'FALSE' END AS missing, n_chars % 2 = 1 AS odd
FROM (SELECT doc_id, n_chars, CASE doc_id % 6 WHEN 0 THEN 'x' || doc_id WHEN 1 THEN ' ' || doc_id || ' ' WHEN 2 THEN ''
                              WHEN 3 THEN doc_id || '000000000' WHEN 4 THEN CAST(doc_id AS VARCHAR) END AS t FROM documents)"""

ORACLES["embedding_argmax"] = """
SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS INTEGER) AS best FROM embeddings"""

# ---- split and counts ------------------------------------------------------------------------

ORACLES["validation_split"] = _sql(SPLIT, "SELECT doc_id, pos, validation_set FROM split")
ORACLES["split_counts"] = _sql(SPLIT, """
SELECT pos, count(*) FILTER (WHERE validation_set = 0) AS n_train,
       count(*) FILTER (WHERE validation_set = 1) AS n_validation, count(*) AS n_rows FROM split GROUP BY pos""")
ORACLES["split_checks"] = _sql(SPLIT + """,
per AS (
  SELECT count(*) FILTER (WHERE validation_set = 1) AS v, count(*) FILTER (WHERE validation_set = 0) AS t,
         CAST(floor(count(*) * CAST(0.2 AS DOUBLE)) AS BIGINT) AS e FROM split GROUP BY pos),
totals AS (SELECT CAST(sum(v) AS BIGINT) AS v, CAST(sum(t) AS BIGINT) AS t, CAST(sum(e) AS BIGINT) AS e FROM per),
rows AS (
  SELECT 'split_null' AS "check", CAST(0 AS BIGINT) AS violations, CAST(NULL AS VARCHAR) AS sample FROM totals
  UNION ALL SELECT 'split_invalid', 0, NULL FROM totals
  UNION ALL SELECT 'no_train_rows', CASE WHEN t = 0 THEN 1 ELSE 0 END, CAST(t AS VARCHAR) FROM totals
  UNION ALL SELECT 'no_validation_rows', CASE WHEN v = 0 THEN 1 ELSE 0 END, CAST(v AS VARCHAR) FROM totals
  UNION ALL SELECT 'validation_count', abs(v - e), CAST(v AS VARCHAR) FROM totals)""", """
SELECT 'train' AS subset, "check", violations = 0 AS ok, violations, sample FROM rows""")
ORACLES["distinct_values"] = _sql(REVIEWS, """
SELECT lang, count(DISTINCT pos) AS n_labels, count(DISTINCT doc_id) AS n_ids, count(*) AS n_rows
FROM reviews GROUP BY lang""")

# ---- checks ----------------------------------------------------------------------------------

_CHECKS = ["not_txt", "name_parts", "id_not_digits", "score_not_digits", "id_out_of_range", "score_out_of_range"]


def _file_report(listing: str) -> str:
    """Checks over ``listing(path)``, one grouped query per check."""
    flagged = rf"""
parsed AS (
  SELECT path, split_part(path, '/', 3) || '_' || split_part(path, '/', 4) AS subset, split_part(path, '/', 5) AS name,
         string_split(regexp_replace(split_part(path, '/', 5), '\.[^.]*$', ''), '_') AS parts FROM {listing}),
typed AS (
  SELECT *, CASE WHEN len(parts) = 2 AND regexp_full_match(parts[1], '[0-9]+') THEN CAST(parts[1] AS BIGINT) END AS number,
         CASE WHEN len(parts) = 2 AND regexp_full_match(parts[2], '[0-9]+') THEN CAST(parts[2] AS INTEGER) END AS score
  FROM parsed),
expected AS (SELECT unnest(['train_pos', 'train_neg', 'test_pos', 'test_neg']) AS subset),
flags AS (
  SELECT subset, name, lower(name) NOT LIKE '%.txt' AS not_txt, len(parts) <> 2 AS name_parts,
         len(parts) = 2 AND number IS NULL AS id_not_digits, len(parts) = 2 AND score IS NULL AS score_not_digits,
         COALESCE(number < 0 OR number > 12499, false) AS id_out_of_range,
         COALESCE(score < 1 OR score > 10, false) AS score_out_of_range FROM typed),
counted AS (SELECT subset, count(*) AS n FROM typed GROUP BY subset),
again AS (
  SELECT subset, CAST(sum(k - 1) AS BIGINT) AS n, min(name) AS name FROM (
    SELECT subset, number, count(*) AS k, min(name) AS name FROM typed WHERE number IS NOT NULL
    GROUP BY subset, number HAVING count(*) > 1) GROUP BY subset),
report AS (
  SELECT subset, 'folder_missing' AS "check", CAST(CASE WHEN n IS NULL THEN 1 ELSE 0 END AS BIGINT) AS violations,
         CAST(NULL AS VARCHAR) AS sample FROM expected LEFT JOIN counted USING (subset)
  UNION ALL SELECT subset, 'file_count', abs(COALESCE(n, 0) - 12500), CAST(COALESCE(n, 0) AS VARCHAR)
            FROM expected LEFT JOIN counted USING (subset)
  UNION ALL SELECT subset, 'duplicate_id', COALESCE(n, 0), name FROM expected LEFT JOIN again USING (subset)"""
    for check in _CHECKS:
        flagged += f"""
  UNION ALL SELECT e.subset, '{check}', count(name), min(name)
            FROM expected e LEFT JOIN (SELECT * FROM flags WHERE {check}) f USING (subset) GROUP BY e.subset"""
    return flagged + ")"


_REPORT = 'SELECT subset, "check", violations = 0 AS ok, violations, sample FROM report'

ORACLES["file_structure_report"] = _sql(LISTING + "," + _file_report("listing"), _REPORT)
ORACLES["first_bad_files"] = _sql(LISTING, """
SELECT subset, name, CAST(rank AS INTEGER) AS rank FROM (
  SELECT split_part(path, '/', 3) || '_' || split_part(path, '/', 4) AS subset, split_part(path, '/', 5) AS name,
         row_number() OVER (PARTITION BY split_part(path, '/', 3), split_part(path, '/', 4)
                            ORDER BY split_part(path, '/', 5)) AS rank
  FROM listing WHERE lower(path) NOT LIKE '%.txt') WHERE rank <= 5""")
ORACLES["duplicate_file_ids"] = _sql("""
turns AS (SELECT '/corpus/train/' || CASE WHEN role = 'user' THEN 'pos' ELSE 'neg' END || '/0' || conv_id || '_' ||
                 turn || '.txt' AS path FROM conversations),""" + _file_report("turns"), _REPORT)


def _table_report(source: str) -> str:
    """Checks over ``t(id, label, score, text)``, all text."""
    return f"""
t AS ({source}),
bad AS (
  SELECT 'empty_text' AS "check", id FROM t WHERE text IS NULL OR regexp_full_match(text, '{WS}*')
  UNION ALL SELECT 'label_not_0_1', id FROM t WHERE label NOT IN ('0', '1')
  UNION ALL SELECT 'score_not_int', id FROM t WHERE try_cast(score AS INTEGER) IS NULL
  UNION ALL SELECT 'score_out_of_range', id FROM t WHERE try_cast(score AS INTEGER) NOT BETWEEN 1 AND 10),
names AS (SELECT unnest(['empty_text', 'label_not_0_1', 'score_not_int', 'score_out_of_range']) AS "check"),
report AS (
  SELECT "check", count(id) AS violations, min(id) AS sample FROM names LEFT JOIN bad USING ("check") GROUP BY "check"
  UNION ALL SELECT 'duplicate_id', CAST(COALESCE(sum(k - 1), 0) AS BIGINT), min(id)
            FROM (SELECT id, count(*) AS k FROM t GROUP BY id HAVING count(*) > 1)
  UNION ALL SELECT 'row_count', abs(count(*) - 25000), CAST(count(*) AS VARCHAR) FROM t
  UNION ALL SELECT 'pos_count', abs(count(*) - 12500), CAST(count(*) AS VARCHAR) FROM t WHERE label = '1'
  UNION ALL SELECT 'neg_count', abs(count(*) - 12500), CAST(count(*) AS VARCHAR) FROM t WHERE label = '0')"""


_TABLE_REPORT = """SELECT 'train' AS subset, "check", violations = 0 AS ok, violations, sample FROM report"""

ORACLES["conversation_table_report"] = _sql(_table_report("""
  SELECT CAST(conv_id AS VARCHAR) AS id, CASE WHEN role = 'user' THEN '1' ELSE '0' END AS label,
         CAST(turn AS VARCHAR) AS score, text FROM conversations"""), _TABLE_REPORT)
ORACLES["review_table_report"] = _sql(REVIEWS + "," + RAW + "," + _table_report("""
  SELECT "Unique_ID" AS id, CAST("POS" AS VARCHAR) AS label, CAST("Score" AS VARCHAR) AS score, "Review" AS text
  FROM raw"""), _TABLE_REPORT)
ORACLES["lineitem_table_report"] = _sql(_table_report("""
  SELECT l_orderkey || '-' || l_linenumber AS id, CASE WHEN l_returnflag = 'R' THEN '1' ELSE '0' END AS label,
         CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS score, l_returnflag AS text FROM lineitem"""), _TABLE_REPORT)
ORACLES["table_summary"] = _sql(REVIEWS + "," + RAW, """
SELECT count(*) AS row_count, count(*) FILTER (WHERE "POS" = 1) AS pos_count, count(*) FILTER (WHERE "POS" = 0) AS neg_count,
       bool_and(length(trim("Review")) > 0) AS all_have_text, count(DISTINCT "Unique_ID") AS unique_ids,
       '[1-10]' AS score_range FROM raw""")

_HASHED = REVIEWS + "," + RAW + """,
files AS (SELECT "Unique_ID", sha256(CASE WHEN lang = 'fr' THEN "Review" || '!' ELSE "Review" END) AS h FROM raw WHERE lang <> 'es'),
checked AS (
  SELECT "Unique_ID", sha256("Review") AS hash_csv_review, h AS hash_original_file,
         CASE WHEN sha256("Review") = h THEN 'TRUE' ELSE 'FALSE' END AS hash_match
  FROM raw LEFT JOIN files USING ("Unique_ID"))"""

ORACLES["hash_check"] = _sql(_HASHED, "SELECT * FROM checked")
ORACLES["hash_match_counts"] = _sql(_HASHED, """
SELECT count(*) FILTER (WHERE hash_match = 'TRUE') AS match_true,
       count(*) FILTER (WHERE hash_match = 'FALSE') AS match_false FROM checked""")

# ---- vocabulary and features -----------------------------------------------------------------

ORACLES["term_counts_per_document"] = "WITH " + _grams("documents", "doc_id", "text", "tf") + " SELECT doc_id, term, tf FROM tf"
ORACLES["train_term_statistics"] = _sql(STATS, "SELECT term, df, cf FROM stats")
ORACLES["vocabulary_fit"] = _sql(VOCAB, "SELECT term, idx, df, cf, round(idf, 6) AS idf FROM vocab")
ORACLES["bag_of_words"] = _sql(BOW, "SELECT doc_id, pos, validation_set, term, tf FROM bow")
ORACLES["safe_column_names"] = _sql(STATS, f"""
SELECT term, safe AS ngram_column, substring(safe, 5) AS ngram FROM (SELECT term, {SAFE} AS safe FROM stats)""")
ORACLES["bag_of_words_wide"] = _sql(BOW + "," + NAMED, """
SELECT b.doc_id, n.ngram_column, CAST(b.tf AS BIGINT) AS tf FROM bow b JOIN named n USING (term)
UNION ALL SELECT NULL, 'columns', count(*) FROM named""")
ORACLES["tfidf_weights"] = _sql(TFIDF, "SELECT doc_id, validation_set, term, round(tfidf, 6) AS tfidf FROM tfidf")
ORACLES["tfidf_of_new_texts"] = _sql(VOCAB + "," + _grams("benchmark", "item_id", "text", "new_tf") + """,
w AS (SELECT item_id, term, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM new_tf JOIN vocab USING (term))""", """
SELECT item_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY item_id)), 6) AS tfidf FROM w""")

ORACLES["saved_tfidf_of_new_texts"] = ORACLES["tfidf_of_new_texts"]

# ---- rankings --------------------------------------------------------------------------------

_SUMS = """
sizes AS (SELECT count(*) FILTER (WHERE pos = 1) AS n_pos, count(*) FILTER (WHERE pos = 0) AS n_neg FROM {rows}),
means AS (
  SELECT v.term, v.idx, COALESCE(sum(b.{v}) FILTER (WHERE b.pos = 1), 0) AS pos_total,
         COALESCE(sum(b.{v}) FILTER (WHERE b.pos = 0), 0) AS neg_total,
         COALESCE(sum(b.{v}) FILTER (WHERE b.pos = 1), 0) / CAST(min(n_pos) AS DOUBLE) AS mean_pos,
         COALESCE(sum(b.{v}) FILTER (WHERE b.pos = 0), 0) / CAST(min(n_neg) AS DOUBLE) AS mean_neg
  FROM vocab v CROSS JOIN sizes LEFT JOIN {features} b ON b.term = v.term GROUP BY v.term, v.idx)"""
_BOW_SUMS = BOW + "," + _SUMS.format(rows="split", v="tf", features="bow") + "," + NAMED
_TFIDF_SUMS = TFIDF + "," + _SUMS.format(
    rows="(SELECT * FROM split WHERE validation_set = 0)", v="tfidf",
    features="(SELECT * FROM tfidf WHERE validation_set = 0)")
_TOTAL = """
SELECT class, rank, ngram_column, substring(ngram_column, 5) AS ngram, CAST(score AS BIGINT) AS bow_total_count
FROM ranked JOIN named USING (term)"""

ORACLES["top_ngrams_total"] = _sql(_BOW_SUMS + "," + _top("means", "pos_total", "neg_total", "score"), _TOTAL)
ORACLES["top_ngrams_distinctive"] = _sql(_BOW_SUMS + "," + _top("means", "mean_pos - mean_neg", "mean_neg - mean_pos"), """
SELECT class, rank, ngram_column, substring(ngram_column, 5) AS ngram, round(mean_pos, 6) AS mean_bow_pos,
       round(mean_neg, 6) AS mean_bow_neg, round(score, 6) AS distinctiveness_score FROM ranked JOIN named USING (term)""")
ORACLES["top_tfidf_mean"] = _sql(_TFIDF_SUMS + "," + _top("means", "mean_pos", "mean_neg"), """
SELECT class, rank, term AS ngram, round(score, 6) AS mean_tfidf FROM ranked""")
ORACLES["top_tfidf_distinctive"] = _sql(_TFIDF_SUMS + "," + _top("means", "mean_pos - mean_neg", "mean_neg - mean_pos"), """
SELECT class, rank, term AS ngram, round(mean_pos, 6) AS mean_tfidf_pos, round(mean_neg, 6) AS mean_tfidf_neg,
       round(score, 6) AS distinctiveness_score FROM ranked""")


def _clean_bow(split_ctes: str) -> str:
    """Features of cleaned text for a ``split`` that holds ``doc_id, pos, validation_set, text``."""
    return split_ctes + "," + _grams("split", "doc_id", "text", "tf") + STATS[len(TF):] + "," + _vocab() + BOW[len(VOCAB):]


_CLEAN_REVIEWS = _CLEAN + """,
reviews AS (
  SELECT d.doc_id, d.text, CAST(l.quality AS INTEGER) AS pos FROM clean d JOIN labels l ON d.doc_id = l.doc_id
)"""
ORACLES["top_preprocessed_ngrams"] = _sql(
    _clean_bow(_CLEAN_REVIEWS + "," + _split("reviews", "doc_id", "pos", "split"))
    + "," + _SUMS.format(rows="split", v="tf", features="bow") + "," + NAMED
    + "," + _top("means", "pos_total", "neg_total", "score"), _TOTAL)

# ---- models ----------------------------------------------------------------------------------

_MNB = """,
class_n AS (SELECT pos, count(*) AS n, sum(count(*)) OVER () AS total FROM split WHERE validation_set = 0 GROUP BY pos),
n_ct AS (
  SELECT c.pos, v.term, COALESCE(b.n, 0) AS n FROM class_n c CROSS JOIN vocab v
  LEFT JOIN (SELECT pos, term, sum(tf) AS n FROM bow WHERE validation_set = 0 GROUP BY pos, term) b
    ON b.pos = c.pos AND b.term = v.term),
logp AS (
  SELECT pos, term, ln(CAST(n + 1 AS DOUBLE)) - ln(CAST(sum(n + 1) OVER (PARTITION BY pos) AS DOUBLE)) AS logp FROM n_ct),
priors AS (SELECT pos, ln(n / CAST(total AS DOUBLE)) AS log_prior FROM class_n)"""
MNB = BOW + _MNB


def _scores(docs: str, counts: str, key: str, out: str) -> str:
    return f"""
{out}_class AS (
  SELECT d.{key}, p.pos AS class, p.log_prior + COALESCE(s.s, 0) AS score
  FROM {docs} d CROSS JOIN priors p LEFT JOIN (
    SELECT t.{key}, l.pos, sum(t.tf * l.logp) AS s FROM {counts} t JOIN logp l USING (term) GROUP BY t.{key}, l.pos) s
    ON s.{key} = d.{key} AND s.pos = p.pos),
{out} AS (
  SELECT {key}, max(score) FILTER (WHERE class = 0) AS score_neg, max(score) FILTER (WHERE class = 1) AS score_pos,
         CAST(CASE WHEN max(score) FILTER (WHERE class = 1) > max(score) FILTER (WHERE class = 0) THEN 1 ELSE 0 END
              AS INTEGER) AS prediction FROM {out}_class GROUP BY {key})"""


def _measures(source: str, keys: str, group: str = "") -> str:
    """Confusion counts and measures of ``source(label, prediction)``."""
    return f"""
SELECT {keys}, "TP", "FP", "TN", "FN",
       round(CASE WHEN "TP" + "FP" + "TN" + "FN" > 0 THEN ("TP" + "TN") / CAST("TP" + "FP" + "TN" + "FN" AS DOUBLE) ELSE 0 END, 6) AS accuracy,
       round(CASE WHEN "TP" + "FP" > 0 THEN "TP" / CAST("TP" + "FP" AS DOUBLE) ELSE 0 END, 6) AS precision,
       round(CASE WHEN "TP" + "FN" > 0 THEN "TP" / CAST("TP" + "FN" AS DOUBLE) ELSE 0 END, 6) AS recall,
       round(CASE WHEN 2 * "TP" + "FP" + "FN" > 0 THEN 2 * "TP" / CAST(2 * "TP" + "FP" + "FN" AS DOUBLE) ELSE 0 END, 6) AS "f-score"
FROM (
  SELECT {group or "1 AS one"}, count(*) FILTER (WHERE label = 1 AND prediction = 1) AS "TP",
         count(*) FILTER (WHERE label = 0 AND prediction = 1) AS "FP",
         count(*) FILTER (WHERE label = 0 AND prediction = 0) AS "TN",
         count(*) FILTER (WHERE label = 1 AND prediction = 0) AS "FN"
  FROM {source} {("GROUP BY " + group) if group else ""})"""


_SCORED = MNB + "," + _scores("split", "tf", "doc_id", "scored")
_MNB_VALIDATION = _SCORED + """,
judged AS (SELECT pos AS label, prediction FROM split JOIN scored USING (doc_id) WHERE validation_set = 1)"""


_TENTH = """,
logp_tenth AS (
  SELECT pos, term, ln(n + 0.1::DOUBLE) - ln(sum(n + 0.1::DOUBLE) OVER (PARTITION BY pos)) AS logp FROM n_ct)"""
_COMPARED = _SCORED + _TENTH + "," + _scores("split", "tf", "doc_id", "tenth").replace("JOIN logp l", "JOIN logp_tenth l") + """,
judged AS (
  SELECT 'MNB_BOW' AS model, pos AS label, prediction FROM split JOIN scored USING (doc_id) WHERE validation_set = 1
  UNION ALL SELECT 'MNB_BOW_0.1', pos, prediction FROM split JOIN tenth USING (doc_id) WHERE validation_set = 1)"""

ORACLES["class_term_totals"] = _sql(BOW, """
SELECT pos, term, CAST(sum(tf) AS BIGINT) AS total FROM bow WHERE validation_set = 0 GROUP BY pos, term""")
ORACLES["naive_bayes_model"] = _sql(MNB, """
SELECT pos, term, round(logp, 6) AS logp, round(log_prior, 6) AS log_prior FROM logp JOIN priors USING (pos)""")
ORACLES["naive_bayes_predictions"] = _sql(_SCORED, """
SELECT doc_id, pos, validation_set, prediction, round(score_neg, 4) AS score_neg, round(score_pos, 4) AS score_pos
FROM split JOIN scored USING (doc_id)""")
ORACLES["naive_bayes_new_texts"] = _sql(
    MNB + "," + _grams("benchmark", "item_id", "text", "new_tf") + "," + _scores("benchmark", "new_tf", "item_id", "scored"),
    "SELECT item_id, prediction FROM scored")
ORACLES["saved_naive_bayes_new_texts"] = ORACLES["naive_bayes_new_texts"]
ORACLES["naive_bayes_validation_metrics"] = _sql(_MNB_VALIDATION, _measures("judged", "'MNB_BOW' AS model"))
ORACLES["linear_margin_predictions"] = _sql(TFIDF + """,
sizes AS (SELECT count(*) FILTER (WHERE pos = 1) AS n_pos, count(*) FILTER (WHERE pos = 0) AS n_neg FROM split WHERE validation_set = 0),
weights AS (
  SELECT term, sum(CASE WHEN pos = 1 THEN tfidf / n_pos ELSE -tfidf / n_neg END) AS w
  FROM tfidf CROSS JOIN sizes WHERE validation_set = 0 GROUP BY term)""", """
SELECT s.doc_id, s.pos, s.validation_set, round(COALESCE(m.margin, 0), 6) AS margin FROM split s LEFT JOIN (
  SELECT doc_id, sum(tfidf * w) AS margin FROM tfidf JOIN weights USING (term) GROUP BY doc_id) m USING (doc_id)""")
ORACLES["linear_svm_predictions"] = _sql("RECURSIVE " + TFIDF.strip() + "," + _svm(10, _BALANCED), f"""
SELECT doc_id, pos, validation_set, prediction, round(margin, 3) AS margin FROM ({_svm_margins("split", "tfidf")})""")
ORACLES["linear_svm_weights"] = _sql("RECURSIVE " + TFIDF.strip() + "," + _svm(10, _BALANCED), f"""
SELECT v.term, round(COALESCE(w, 0), 4) AS weight FROM vocab v LEFT JOIN svm_weights USING (term)
UNION ALL SELECT '# intercept', round(b, 4) FROM svm_intercept
UNION ALL SELECT '# objective', round((SELECT sum(w * w) FROM svm_weights) / 2 + (SELECT b * b FROM svm_intercept) / 2
    + (SELECT 10 * sum(cost * greatest(0, 1 - y * margin) ** 2) FROM ({_svm_margins("split", "tfidf")}) JOIN svm_dual USING (doc_id)), 4)
UNION ALL SELECT '# gradient', 0.0""")
_GRID = BOW + """,
folded AS (SELECT doc_id, pos, CAST(CAST('0x' || md5('20260301|' || doc_id)[:8] AS BIGINT) % 5 AS INTEGER) AS fold FROM split WHERE validation_set = 0),
settings AS (SELECT alpha, prior FROM (VALUES (0.01::DOUBLE), (0.1), (1), (10)) a(alpha), (VALUES ('counted'), ('equal')) p(prior)),
folds AS (SELECT CAST(range AS INTEGER) AS fold FROM range(5)),
learned AS (SELECT f.fold, d.doc_id, d.pos FROM folds f JOIN folded d ON d.fold <> f.fold),
sizes AS (SELECT fold, pos, count(*) AS n, sum(count(*)) OVER (PARTITION BY fold) AS total FROM learned GROUP BY fold, pos),
seen AS (SELECT fold, l.pos, term, sum(tf) AS n FROM learned l JOIN bow USING (doc_id) GROUP BY ALL),
model AS (
  SELECT s.fold, s.pos, v.term, alpha, ln(COALESCE(n.n, 0) + alpha) - ln(sum(COALESCE(n.n, 0) + alpha) OVER (PARTITION BY s.fold, s.pos, alpha)) AS logp
  FROM sizes s CROSS JOIN vocab v CROSS JOIN (SELECT DISTINCT alpha FROM settings)
  LEFT JOIN seen n ON n.fold = s.fold AND n.pos = s.pos AND n.term = v.term),
summed AS (
  SELECT d.doc_id, m.pos, alpha, sum(tf * logp) AS s FROM folded d JOIN bow b USING (doc_id) JOIN model m ON m.fold = d.fold AND m.term = b.term
  GROUP BY ALL),
scored AS (
  SELECT d.doc_id, d.pos AS label, d.fold, t.alpha, t.prior, z.pos,
         COALESCE(s, 0) + CASE WHEN prior = 'counted' THEN ln(z.n / CAST(z.total AS DOUBLE)) ELSE 0 END AS score
  FROM folded d CROSS JOIN settings t JOIN sizes z ON z.fold = d.fold LEFT JOIN summed s ON s.doc_id = d.doc_id AND s.pos = z.pos AND s.alpha = t.alpha),
judged AS (
  SELECT doc_id, label, fold, alpha, prior,
         CASE WHEN max(score) FILTER (pos = 1) > COALESCE(max(score) FILTER (pos = 0), '-infinity'::DOUBLE) THEN 1 ELSE 0 END AS prediction
  FROM scored GROUP BY ALL)"""
ORACLES["naive_bayes_grid"] = _sql(_GRID, _measures("judged", "alpha, prior, fold", "alpha, prior, fold"))
ORACLES["naive_bayes_best_setting"] = _sql(_GRID, f"""
SELECT alpha, prior, round(avg(f), 6) AS "f-score" FROM (
  SELECT alpha, prior, CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / CAST(2 * tp + fp + fn AS DOUBLE) ELSE 0 END AS f FROM (
    SELECT alpha, prior, fold, count(*) FILTER (label = 1 AND prediction = 1) AS tp, count(*) FILTER (label = 0 AND prediction = 1) AS fp,
           count(*) FILTER (label = 1 AND prediction = 0) AS fn FROM judged GROUP BY ALL))
GROUP BY alpha, prior ORDER BY round(avg(f), 12) DESC, alpha DESC, prior LIMIT 1""")
ORACLES["model_comparison"] = _sql(_COMPARED, _measures("judged", "model", "model"))
ORACLES["naive_bayes_run_rows"] = _sql(_COMPARED, f"""
SELECT CASE model WHEN 'MNB_BOW' THEN 'first' ELSE 'second' END AS run, * REPLACE ('MNB_BOW' AS model) FROM ({_measures("judged", "model", "model")})""")
_HEADED = _split("heads", "vec_id", "pos", "headed")
ORACLES["vector_head_predictions"] = f"""WITH RECURSIVE
heads AS (SELECT vec_id, CAST(label < 5 AS INTEGER) AS pos, list_append(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), CAST(1 AS DOUBLE)) AS v FROM embeddings),
{_HEADED},
data AS MATERIALIZED (SELECT list(v ORDER BY vec_id) AS x, list(CAST(pos AS DOUBLE) ORDER BY vec_id) AS y, count(*) AS n FROM headed WHERE validation_set = 0),
across AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS xt, sum(list_dot_product(c, c)) / any_value(len(c)) / 4 + 0.01 AS big
  FROM (SELECT i, list(x[i] ORDER BY r) AS c FROM (SELECT unnest(x) AS x, unnest(range(n)) AS r FROM data), range(1, (SELECT len(x[1]) FROM data) + 1) t(i) GROUP BY i)),
steps AS (
  SELECT 0 AS step, list_transform(xt, lambda c: CAST(0 AS DOUBLE)) AS w, list_transform(xt, lambda c: CAST(0 AS DOUBLE)) AS z FROM across
  UNION ALL
  SELECT step + 1, new, list_transform(list_zip(new, w), lambda p: p[1] + (sqrt(big / 0.01) - 1) / (sqrt(big / 0.01) + 1) * (p[1] - p[2]))
  FROM (
    SELECT step, w, big, list_transform(list_zip(z, xt, range(1, len(z) + 1)), lambda p:
             p[1] - (list_dot_product(p[2], rest) / n + CASE WHEN p[3] < len(z) THEN 0.01 * p[1] ELSE 0 END) / big) AS new
    FROM (
      SELECT step, w, z, list_transform(list_zip(x, y), lambda p: 1 / (1 + exp(-list_dot_product(p[1], z))) - p[2]) AS rest, n
      FROM steps, data WHERE step < 30 * (SELECT sqrt(big / 0.01) FROM across)), across)),
last AS MATERIALIZED (SELECT w FROM steps ORDER BY step DESC LIMIT 1)
SELECT vec_id, pos, validation_set, round(p, 4) AS probability, CAST(CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS INTEGER) AS prediction
FROM (SELECT vec_id, pos, validation_set, 1 / (1 + exp(-list_dot_product(v, w))) AS p FROM headed, last)"""
ORACLES["best_model"] = _sql(_COMPARED + ", runs AS (" + _measures("judged", "model", "model") + ")", """
SELECT model, "TP", "FP", "TN", "FN", "f-score" FROM runs ORDER BY "f-score" DESC, model LIMIT 1""")
ORACLES["run_metadata"] = _sql(_MNB_VALIDATION, """
SELECT '{"model_name":"MNB_BOW","train_size":' || (SELECT count(*) FROM split WHERE validation_set = 0) ||
       ',"val_size":' || count(*) || ',"confusion_matrix":[[' ||
       count(*) FILTER (WHERE label = 0 AND prediction = 0) || ',' || count(*) FILTER (WHERE label = 0 AND prediction = 1) ||
       '],[' || count(*) FILTER (WHERE label = 1 AND prediction = 0) || ',' ||
       count(*) FILTER (WHERE label = 1 AND prediction = 1) || ']]}' AS metadata FROM judged""")

# A fifth of each class is held out for the test before the training rows are split again.
_RUN = _CLEAN + """,
ided AS (
  SELECT (CASE WHEN l.quality = 1 THEN 'POS' ELSE 'NEG' END) || c.doc_id AS doc_id, c.text, CAST(l.quality AS INTEGER) AS pos
  FROM clean c JOIN labels l ON c.doc_id = l.doc_id),""" + _split("ided", "doc_id", "pos", "held", "held_out", 20260228) + """,
reviews AS (SELECT doc_id, text, pos FROM held WHERE held_out = 0),
unseen AS (SELECT doc_id, text, pos FROM held WHERE held_out = 1),""" + _split("reviews", "doc_id", "pos", "split")
_CONFUSED = """count(*) FILTER (WHERE pos = 1 AND prediction = 1) AS "TP", count(*) FILTER (WHERE pos = 0 AND prediction = 1) AS "FP",
       count(*) FILTER (WHERE pos = 0 AND prediction = 0) AS "TN", count(*) FILTER (WHERE pos = 1 AND prediction = 0) AS "FN" """
_RUN_CTES = (
    "RECURSIVE " + _clean_bow(_RUN).strip() + _MNB + "," + _grams("unseen", "doc_id", "text", "unseen_tf")
    + "," + _scores("split", "tf", "doc_id", "scored") + "," + _scores("unseen", "unseen_tf", "doc_id", "tested")
    + "," + _SUMS.format(rows="split", v="tf", features="bow") + "," + _top("means", "pos_total", "neg_total", "score") + """,
unseen_bow AS (SELECT doc_id, term FROM unseen_tf JOIN vocab USING (term)),
validated AS (SELECT pos, prediction FROM split JOIN scored USING (doc_id) WHERE validation_set = 1),
unseen_judged AS (SELECT pos, prediction FROM unseen JOIN tested USING (doc_id)),
weighted AS (SELECT *, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM bow),
tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM weighted),
unseen_weighted AS (SELECT doc_id, term, (1 + ln(CAST(tf AS DOUBLE))) * idf AS w FROM unseen_tf JOIN vocab USING (term)),
unseen_tfidf AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS tfidf FROM unseen_weighted),""" + _svm(10, "1.0"))
_RUN_STEPS = {
    "check_files": f"SELECT sum(violations) AS violations FROM ({ORACLES['file_structure_report']})",
    "check_table": f"SELECT sum(violations) AS violations FROM ({ORACLES['review_table_report']})",
    "check_hashes": f"SELECT match_true, match_false FROM ({ORACLES['hash_match_counts']})",
    "convert": "SELECT count(*) AS rows FROM ided",
    "split": "SELECT count(*) FILTER (WHERE validation_set = 0) AS train, count(*) FILTER (WHERE validation_set = 1) AS validation FROM split",
    "clean": "SELECT count(*) AS rows, count(*) FILTER (WHERE text = '') AS empty FROM ided",
    "clean_light": "SELECT count(*) AS rows FROM ided",
    "bow": "SELECT (SELECT count(*) FROM vocab) AS terms, (SELECT count(*) FROM bow) + (SELECT count(*) FROM unseen_bow) AS cells",
    "tfidf": "SELECT (SELECT count(DISTINCT doc_id) FROM bow) + (SELECT count(DISTINCT doc_id) FROM unseen_bow) AS unit_rows",
    "train_mnb": f"SELECT {_CONFUSED} FROM validated",
    "train_svm": f"SELECT {_CONFUSED} FROM ({_svm_margins('split', 'tfidf')}) WHERE validation_set = 1",
    "top_bow": "SELECT count(*) AS rows, sum(score) AS total FROM ranked",
    "top_tfidf": "SELECT 2 * least(50, count(*)) AS rows FROM vocab",
    "test": f"SELECT {_CONFUSED} FROM unseen_judged",
    "test_svm": f"SELECT {_CONFUSED} FROM ({_svm_margins('unseen', 'unseen_tfidf')})",
}
ORACLES["end_to_end_run"] = _sql(_RUN_CTES, " UNION ALL ".join(
    f"SELECT '{step}' AS step, measure, CAST(value AS BIGINT) AS value FROM (UNPIVOT (SELECT CAST(COLUMNS(*) AS BIGINT) FROM ({sql})) "
    "ON COLUMNS(*) INTO NAME measure VALUE value)" for step, sql in _RUN_STEPS.items()))

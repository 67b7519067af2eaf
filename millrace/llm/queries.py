"""Queries of the training-data operators, each over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import backoff, cross_polytope, cube, decontaminate, jaccard_join, langid, outliers, periodic, pii, token_files, url_filter, weak_labels, whitening

TOKENIZER = "word_bpe_49k.json"
END = 2
#: The key of surrogates is a secret of whoever runs the job; this one serves the sample tables.
KEY = "sample key"
RULES = (
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _texts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _table(spark, sf_dir, "documents").select("doc_id", "text", *columns)


def tokenizer() -> str:
    """The file of the tokenizer; its package holds public vocabularies and need not be there for the rest."""
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(_texts(spark, sf_dir), KEY)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = token_files.token_digests(_texts(spark, sf_dir), tokenizer(), END)
    return digests.select("doc_id", "start", "n_tokens", "ids_crc32")


def op3_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = backoff.scores(_texts(spark, sf_dir))
    return found.select("doc_id", "n_chars", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op4_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.neighbours(_table(spark, sf_dir, "embeddings"), every=50)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.judged(_texts(spark, sf_dir), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = langid.held_out(F.col("doc_id"))
    models = langid.fit(_texts(spark, sf_dir, "lang").where(~held))
    found = langid.identify(_texts(spark, sf_dir), models)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "host string, path string, action string")
    return url_filter.verdicts(_table(spark, sf_dir, "pages"), rules)


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked(_texts(spark, sf_dir))


def op9_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = weak_labels.scored(_texts(spark, sf_dir))
    return found.select("doc_id", "posterior", "score", "keep")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cube.mix_sizes(_texts(spark, sf_dir, "source"))
    return found.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digests(periodic.periodic_runs(periodic.with_periods(_texts(spark, sf_dir))))


def op12_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = outliers.judged(_texts(spark, sf_dir, "lang", "source"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (
        op1_surrogates, op2_token_files, op3_backoff, op4_cross_polytope, op5_decontamination, op6_language_id, op7_url_rules,
        op8_jaccard_join, op9_weak_labels, op10_mixing, op11_periodic_runs, op12_outliers, op13_whitening,
    )
    return {query.__name__: query for query in every}


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UNSPACED = r"[^\x20\x09-\x0D]+"

DECONTAMINATION_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_ALNUM}') AS w FROM benchmark),
bs AS (SELECT item_id, w, least(len(w), {decontaminate.WINDOW}) AS k FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
       FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM bs)),
dw AS (SELECT r, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
       FROM (SELECT r, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM bw) WHERE len(w) >= k)),
h AS (SELECT r, i, dw.k, item_id FROM dw JOIN bw ON dw.k = bw.k AND dw.g = bw.g),
n AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + k - 1)) AS j FROM h) GROUP BY r),
m AS (SELECT r, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
      FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM h) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""

URL_SQL = f"""
WITH rules(rule_host, rule_path, action) AS (VALUES {", ".join(str(r) for r in RULES)}),
p AS (
  SELECT page_id, row_number() OVER () AS r,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
),
f AS (
  SELECT r, rule_host || rule_path AS rule, action,
    row_number() OVER (PARTITION BY r ORDER BY length(rule_host || rule_path) DESC, rule_host || rule_path) AS place
  FROM p JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM f WHERE place = 1) USING (r)
"""

JACCARD_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_UNSPACED}') AS w FROM documents),
g AS (SELECT doc_id, w, least(len(w), {jaccard_join.SHINGLE}) AS k FROM d WHERE len(w) > 0),
s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS x
      FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM g)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (x) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * shared >= {jaccard_join.SIMILARITY} * (na.n + nb.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON e.a = reach.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""


def oracle_sql() -> dict[str, str]:
    """Surrogates, coded tokens, approximate neighbours, fitted models and drawn mixes have no SQL, and that of
    backoff scores is too slow on whole texts; tests hold them against plain versions.
    """
    return {
        op5_decontamination.__name__: DECONTAMINATION_SQL,
        op7_url_rules.__name__: URL_SQL,
        op8_jaccard_join.__name__: JACCARD_SQL,
    }

"""The queries of this subpackage, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decision_list, language_id, lm_scoring, url_filter
from ._spark import documents, new_folder, ship
from .feistel import pseudonymise
from .jaccard_join import jaccard_components
from .line_dedup import dedup_lines
from .packing import pack
from .token_store import read_keys, write_store
from .winnow import hits


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: A session setting names the file of a deployment's secret; without it the registered query
#: takes this key, which makes its results repeatable.
KEY_FILE, DEMO_KEY = "spark.treeflow.pseudonymKeyFile", b"treeflow demonstration key"


def pseudonym_key(spark: SparkSession) -> bytes:
    place = spark.conf.get(KEY_FILE, None)
    return Path(place).read_bytes() if place else DEMO_KEY


def op1_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir), pseudonym_key(spark))


def op2_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    uri = new_folder(spark, "token-store")
    write_store(docs, uri, tokenizer_path("word_bpe_49k.json"), splitting="words", end_id=2)
    return read_keys(docs, uri)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


def op4_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    marked = lm_scoring.mark_target(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), where="quality = 1 and toxic = 0")
    return lm_scoring.score(marked)


def op5_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = decision_list.statistics(documents(spark, sf_dir))
    rules = decision_list.learn(stats, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return decision_list.judge(stats, rules).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = hits(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(documents(spark, sf_dir), output="kept_sha256")


def op8_language_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language_id.train(docs)
    rows = docs.select("doc_id", "text", language_id.held_out().alias("held_out"))
    return language_id.predict(rows, model, keep=["doc_id", "held_out"])


def op9_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(ship(spark).read.parquet(f"{sf_dir}/pages.parquet"))


def op10_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"), splitting="byte_level", end_id=0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_feistel": op1_feistel,
    "op2_token_store": op2_token_store,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_cross_entropy": op4_cross_entropy,
    "op5_decision_list": op5_decision_list,
    "op6_winnowing": op6_winnowing,
    "op7_line_dedup": op7_line_dedup,
    "op8_language_spans": op8_language_spans,
    "op9_url_vocabulary": op9_url_vocabulary,
    "op10_best_fit": op10_best_fit,
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP6 = rf"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("text")}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
bw AS (SELECT DISTINCT item_id, k, w[p:p + k - 1] AS g FROM (SELECT item_id, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0)),
dw AS (SELECT doc_id, k, p, w[p:p + k - 1] AS g FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM bw))),
m AS (SELECT doc_id, item_id, k, p FROM dw JOIN bw USING (k, g)),
h AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM m) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

_OP7 = f"""
WITH l AS (SELECT doc_id, p, ls[p] AS line, {_LOWER.format(f"trim(ls[p], {_WHITE})")} AS k
           FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS p FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))),
hot AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(hot.k)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE hot.k IS NULL), '')) AS kept_sha256
FROM l LEFT JOIN hot USING (k) GROUP BY doc_id
"""

_OP3 = rf"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (
        SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [w] ELSE list_transform(range(1, len(w) - 3), lambda p: w[p:p + 4]) END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 80 * (a.n + b.n - o)),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT x AS doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(y) AS component_id FROM r LEFT JOIN n ON n.doc_id = r.x GROUP BY x
"""

_NAMED = lambda terms: ", ".join(f"('{t}')" for t in terms)
_OP9 = rf"""
WITH u AS (SELECT page_id, url, {_LOWER.format("coalesce(regexp_extract(url, '^(?s:.*?)://([^/?#]*)', 1), '')")} AS host,
                  coalesce(regexp_extract(url, '^(?s:.*?)://[^/?#]*([^?#]*)', 1), '') AS path, {_LOWER.format("coalesce(url, '')")} AS low FROM pages),
rules(rule, verdict) AS (VALUES {", ".join(f"('{r}', '{v}')" for r, v in url_filter.RULES)}),
parts AS (SELECT *, split_part(rule, '/', 1) AS rh, substr(rule, strpos(rule, '/')) AS rp FROM rules),
best AS (SELECT page_id, url, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict FROM u JOIN parts
         ON (host = rh OR suffix(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id, url),
strict(t) AS (VALUES {_NAMED(url_filter.STRICT)}),
soft(t) AS (VALUES {_NAMED(url_filter.SOFT)}),
ns AS (SELECT page_id, url, sum(CASE WHEN starts_with(substr(low, p), t) AND NOT regexp_matches(coalesce(nullif(substr(' ' || low, p, 1), ''), ' '), '[a-z0-9]')
              AND NOT regexp_matches(coalesce(nullif(substr(low, p + length(t), 1), ''), ' '), '[a-z0-9]') THEN 1 ELSE 0 END)::BIGINT AS n_strict
       FROM (SELECT page_id, url, low, unnest(range(1, length(low) + 1)) AS p FROM u), strict GROUP BY page_id, url),
nf AS (SELECT page_id, url, count(DISTINCT t)::BIGINT AS n_soft FROM u JOIN soft ON regexp_matches(low, '(^|[^a-z0-9])' || t || '([^a-z0-9]|$)') GROUP BY page_id, url)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN coalesce(n_strict, 0) > 0 OR coalesce(n_soft, 0) >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END) AS verdict,
       coalesce(n_strict, 0) AS n_strict, coalesce(n_soft, 0) AS n_soft
FROM u LEFT JOIN best USING (page_id, url) LEFT JOIN ns USING (page_id, url) LEFT JOIN nf USING (page_id, url)
"""

ORACLE_SQL: dict[str, str] = {"op3_ngram_jaccard": _OP3, "op6_winnowing": _OP6, "op7_line_dedup": _OP7, "op9_url_vocabulary": _OP9}

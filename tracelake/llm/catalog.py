"""The registered queries of this subpackage and their SQL, where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import byte_bpe
from .common import table
from .decontaminate import contamination
from .importance import BUCKETS, MIN_WORDS, PERCENT, SEED, importance
from .language_id import language_id
from .licenses import MIN_DICE, TEMPLATES, scan, size_bounds, template_bigrams
from .near_dedup import near_duplicates
from .packing import pack_documents
from .suffix_dedup import without_repeats
from .token_alignment import token_alignment
from .token_count import token_counts
from .top_k import top_k
from .toxicity import toxicity
from .url_filter import judge_urls


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "license", "score", "n_units", F.array_join(F.col("licenses.name"), ",").alias("licenses"))


def op7_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"))


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dedup": op1_near_dedup,
    "op2_language_id": op2_language_id,
    "op3_decontaminate": op3_decontaminate,
    "op4_url_filter": op4_url_filter,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_license_scan": op6_license_scan,
    "op7_top_k": op7_top_k,
    "op8_toxicity": op8_toxicity,
    "op9_token_count": op9_token_count,
    "op10_best_fit_packing": op10_best_fit_packing,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_token_alignment": op13_token_alignment,
}

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20"""


def _importance_sql() -> str:
    entries = []
    for value in range(256):
        for _ in range(8):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        entries.append(value)
    table = ", ".join(map(str, entries))

    def features(name: str) -> str:
        return f"""
  SELECT k, unnest([w, w || ' ' || w2, w || ' ' || w2 || ' ' || w3]) AS f
  FROM (SELECT k, w, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3
        FROM (SELECT k, unnest(w) AS w, unnest(range(len(w))) AS i FROM {name}) WINDOW o AS (PARTITION BY k ORDER BY i))"""

    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {words} AS w FROM documents),
b AS (SELECT row_number() OVER () AS k, {words} AS w FROM benchmark),
df AS (SELECT * FROM ({features("d")}) WHERE f IS NOT NULL),
bf AS (SELECT * FROM ({features("b")}) WHERE f IS NOT NULL),
x AS (SELECT f, hex(encode(f)) AS h FROM (SELECT f FROM df UNION SELECT f FROM bf)),
u AS (
  SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
    lambda c, y: xor(c >> 8, ([{table}]::BIGINT[])[xor(c & 255, y) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM x),
s AS (SELECT bucket, count(*) AS s FROM df JOIN u USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM bf JOIN u USING (f) GROUP BY bucket),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM df) + {BUCKETS})::DOUBLE
    / ((coalesce(s, 0) + 1) * ((SELECT count(*) FROM bf) + {BUCKETS})::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT unnest(range({BUCKETS})) AS bucket) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
w AS (SELECT k, count(*) AS n, sum(gain) AS weight FROM df JOIN u USING (f) JOIN g USING (bucket) GROUP BY k),
r AS (
  SELECT doc_id, len(w) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM d LEFT JOIN w USING (k)),
o AS (SELECT *, n_words >= {MIN_WORDS} AS enough, row_number() OVER (PARTITION BY n_words >= {MIN_WORDS} ORDER BY score DESC, doc_id) AS place FROM r)
SELECT doc_id, n_features, weight, score,
  CASE WHEN enough AND place <= {PERCENT} * (SELECT count(*) FROM r WHERE n_words >= {MIN_WORDS}) // 100 THEN place END AS rank, n_words
FROM o"""


def _license_sql() -> str:
    rows = []
    for name, text in TEMPLATES:
        bigrams = template_bigrams(text)
        quoted = ", ".join(f"'{b}'" for b in bigrams)
        rows.append(f"('{name}', [{quoted}], {', '.join(map(str, size_bounds(len(bigrams), MIN_DICE)))})")
    return rf"""
WITH t(name, tb, low, high) AS (VALUES {", ".join(rows)}),
u AS (
  SELECT doc_id, unnest(list_concat(string_split_regex(text, '\r?\n'),
    list_filter(string_split_regex(text, '\r?\n[ \t]*\r?\n\s*'), lambda b: contains(trim(b), chr(10))))) AS unit
  FROM documents),
w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(unit, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM u),
b AS (
  SELECT doc_id, row_number() OVER () AS k,
    list_distinct(CASE WHEN len(w) > 1 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) ELSE w END) AS b
  FROM w),
d AS (
  SELECT doc_id, k, name, 2.0 * len(list_intersect(b, tb)) / (len(b) + len(tb)) AS dice
  FROM b JOIN t ON len(b) BETWEEN low AND high),
m AS (SELECT * FROM d WHERE dice >= {MIN_DICE} QUALIFY row_number() OVER (PARTITION BY k ORDER BY dice DESC, name) = 1),
n AS (SELECT doc_id, name, max(dice) AS score, count(*) AS units FROM m GROUP BY ALL),
g AS (
  SELECT doc_id, arg_min(name, (-score, name)) AS license, max(score) AS score, CAST(sum(units) AS INTEGER) AS n_units,
    string_agg(name, ',' ORDER BY score DESC, name) AS licenses
  FROM n GROUP BY doc_id)
SELECT doc_id, license, score, coalesce(n_units, 0) AS n_units, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN g USING (doc_id)""".replace("\\\\", "\\")


ORACLES: dict[str, str] = {"op6_license_scan": _license_sql(), "op7_top_k": TOP_K_SQL, "op11_importance_resampling": _importance_sql()}

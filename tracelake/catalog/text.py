"""Text extraction, tokens and term weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import text as op
from ..operators.known import not_known_good
from ..session import materialize, spread
from . import views as v


def pages(spark, sf) -> DataFrame:
    """Web pages as entries with content; pages whose number ends in 7 are known good."""
    p = v.table(spark, sf, "pages").select("page_id", "html")
    marked = p.select("page_id", F.col("html").cast("binary").alias("content"), (F.col("page_id") % 10 == 7).alias("nsrl"))
    return spread(marked, "page_id")


def extract_text(spark, sf):
    out = op.extract_text(not_known_good(pages(spark, sf)))
    return out.select("page_id", "text", "failed")


def encoded_documents(spark, sf) -> DataFrame:
    """The documents as files of four charsets: UTF-8 or UTF-16 with a mark, UTF-16 without one, and, if they hold nothing else, Latin letters of one byte."""
    docs = v.documents(spark, sf, heavy=True).select("doc_id", "text").where("text IS NOT NULL")
    kind = F.pmod("doc_id", F.lit(4))
    latin = F.col("text").rlike(r"\A[\x00-\x7F\x{A0}-\x{FF}]*\z")
    content = (
        F.when(kind == 0, F.concat(F.lit(b"\xfe\xff"), F.encode("text", "UTF-16BE")))
        .when(kind == 1, F.encode("text", "UTF-16LE"))
        .when((kind == 2) & latin, F.encode("text", "ISO-8859-1"))
        .otherwise(F.concat(F.lit(b"\xef\xbb\xbf"), F.col("text").cast("binary")))
    )
    return docs.select("doc_id", content.alias("content"))


def extract_charsets(spark, sf):
    """Texts of files in several charsets, found again from their bytes."""
    return op.extract_text(encoded_documents(spark, sf)).select("doc_id", "charset", "text", "failed")


def token_rows(spark, sf) -> DataFrame:
    return op.tokens(v.documents(spark, sf, heavy=True).select("doc_id", "text"))


def tokens(spark, sf):
    rows = token_rows(spark, sf)
    return rows.select("doc_id", F.size("tokens").cast("bigint").alias("n"), F.array_join("tokens", " ").alias("tokens"))


def vectors(spark, sf) -> DataFrame:
    return op.term_vectors(token_rows(spark, sf))


def document_frequency(spark, sf):
    return op.document_frequency(vectors(spark, sf)).where(F.col("cf") >= op.MIN_SUPPORT)


def dictionary(spark, sf):
    return op.dictionary(op.document_frequency(vectors(spark, sf)))


def tfidf(spark, sf):
    weights, _ = op.weighted_terms(materialize(vectors(spark, sf), "term-vectors"))
    return weights.withColumn("weight", F.round("weight", 6))


QUERIES = {
    "extract_text": extract_text,
    "extract_charsets": extract_charsets,
    "tokens": tokens,
    "tf": lambda s, d: op.term_frequencies(vectors(s, d)),
    "document_frequency": document_frequency,
    "dictionary": dictionary,
    "tfidf": tfidf,
}

_STOP = ", ".join(f"'{w}'" for w in ["", *op.STOP_WORDS])
_T = rf"""WITH tok AS (SELECT doc_id, list_filter(string_split_regex(lower(text), '[^\p{{L}}\p{{N}}]+'),
      lambda w: w NOT IN ({_STOP})) AS l FROM documents),
    tf0 AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(l) AS term FROM tok) GROUP BY ALL),
    st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS cf, count(*) AS df FROM tf0 GROUP BY term HAVING sum(tf) >= 2) """

_PAGE = r"""SELECT page_id, regexp_replace(html, '(?is)<head\b.*?</head>|<!--.*?-->|<script\b.*?</script>|<style\b.*?</style>|<!doctype[^>]*>', '', 'g') AS t
  FROM pages WHERE page_id % 10 <> 7"""
_TAGS = "address|article|aside|blockquote|br|dd|div|dl|dt|fieldset|figcaption|figure|footer|form|h[1-6]|header|hr|li|main|nav|ol|option|p|pre|section|table|tbody|td|tfoot|th|thead|tr|ul"
_PLAIN = rf"regexp_replace(regexp_replace(t, '(?i)</?({_TAGS})(\s[^>]*)?/?>', chr(10), 'g'), '</?[a-zA-Z][^>]*>', '', 'g')"
_CODES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&nbsp;", " "), ("&amp;", "&")]
_ENTITIES = _PLAIN
for _code, _char in _CODES:
    _ENTITIES = f"replace({_ENTITIES}, '{_code}', '{_char}')"
_TIDY = rf"trim(regexp_replace(regexp_replace({_ENTITIES}, '[ \t\r\f\x0B\x{{A0}}]+', ' ', 'g'), ' ?\n[ \n]*', chr(10), 'g'), ' ' || chr(10))"

ORACLES = {
    "extract_charsets": """SELECT doc_id, text, false AS failed,
        CASE doc_id % 4 WHEN 0 THEN 'UTF-16BE' WHEN 1 THEN 'UTF-16LE'
          WHEN 2 THEN CASE WHEN regexp_full_match(text, '[\\x00-\\x7F]*') THEN 'UTF-8'
            WHEN regexp_full_match(text, '[\\x00-\\x7F\\x{A0}-\\x{FF}]*') THEN 'windows-1252' ELSE 'UTF-8' END
          ELSE 'UTF-8' END AS charset
      FROM documents WHERE text IS NOT NULL""",
    "extract_text": f"SELECT page_id, {_TIDY} AS text, false AS failed FROM ({_PAGE})",
    "tokens": _T + "SELECT doc_id, len(l) AS n, array_to_string(l, ' ') AS tokens FROM tok",
    "tf": _T + "SELECT term, doc_id, tf FROM tf0 JOIN st USING (term)",
    "document_frequency": _T + "SELECT term, cf, df FROM st",
    "dictionary": _T + "SELECT term, row_number() OVER (ORDER BY term) - 1 AS idx, df FROM st",
    "tfidf": _T
    + """, n AS (SELECT count(DISTINCT doc_id) AS n FROM tf0)
      SELECT doc_id, term, round(sqrt(tf) * (ln(n / (df + 1)) + 1), 6) AS weight
      FROM tf0 JOIN st USING (term), n WHERE df >= 5 AND df * 100.0 <= 40.0 * n""",
}

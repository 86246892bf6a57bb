"""Pattern search over the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as op
from ..session import materialize, scratch_path
from ..sources import make_patterns, read_pattern_rows
from ..sources.patterns import Pattern
from . import views as v

# The unbalanced one is there to show that an invalid pattern keeps its number and never matches.
PATTERN_LINES = [r"\bthe\b", "", "(unclosed", r"\band\b", "licen[sc]e"]
_VALID = {0: r"\bthe\b", 2: r"\band\b", 3: "licen[sc]e"}


def patterns(spark) -> list[Pattern]:
    return make_patterns(spark, PATTERN_LINES)


def with_hits(spark, sf, *columns: str):
    e = v.entries(spark, sf, heavy=True).select("doc_id", "entry_id", "path", "name", "text", *columns)
    return op.grep_hits(e, patterns(spark))


def grep_hits(spark, sf):
    hits = with_hits(spark, sf)
    joined = F.array_join(F.transform("hits", lambda h: F.concat(h["a"].cast("string"), F.lit(":"), h["p"])), "|")
    return hits.select("entry_id", F.size("hits").cast("bigint").alias("n"), joined.alias("hits"))


def grep_counts(spark, sf):
    return op.grep_counts(v.documents(spark, sf, heavy=True).select("text"), patterns(spark))


def search_hits(spark, sf):
    return op.search_hits(with_hits(spark, sf), patterns(spark))


def hit_corpus(spark, sf):
    corpus = op.hit_corpus(with_hits(spark, sf))
    return corpus.select("entry_id", "doc", F.md5("text").alias("text_md5"))


def search_hits_page(spark, sf):
    """Second page of the hit table."""
    rows = search_hits(spark, sf).select("a", "p", "fP")
    return op.report_page(rows, ["fP", "a", "p"], page=1)


# Words of the pattern file, of at least four letters: the most frequent ones and many of any frequency. Each makes a line, in one of three forms.
FREQUENT_WORDS = 120
OTHER_WORDS = 1880
# Lines without a required literal, which are tried on every text.
_SHORT_LINES = ["[0-9]+", "x.z", "(unclosed"]


def pattern_file(spark, sf) -> str:
    """A pattern file of many lines; nearly every line is made of one of the documents' own words."""
    docs = v.documents(spark, sf, heavy=True).select("text")
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]{4,}"), F.lit(0))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    words = materialize(words, "words")
    top = words.orderBy(F.desc("n"), "w").limit(FREQUENT_WORDS).union(words.orderBy(F.md5("w")).limit(OTHER_WORDS)).select("w").distinct()
    first, rest = F.left("w", F.lit(1)), F.substring("w", 2, 1 << 20)
    line = F.element_at(
        F.array(F.concat("w", F.lit("[a-z]*")), F.concat(F.lit("["), first, F.upper(first), F.lit("]"), rest), F.concat("w", F.lit("|"), F.upper(first), rest)),
        F.pmod(F.length("w"), F.lit(3)) + 1,
    )
    path = scratch_path(spark, "pattern-file")
    short = spark.createDataFrame([(x,) for x in _SHORT_LINES], "value string")
    top.select(line.alias("value")).union(short).orderBy("value").write.text(path)
    return path


def file_patterns(spark, sf):
    """Hits of each line of a pattern file, written and read again as rows."""
    docs = v.documents(spark, sf, heavy=True).select("doc_id", "text")
    return op.match_counts(docs, read_pattern_rows(spark, pattern_file(spark, sf)), "doc_id").select("kw", "n")


def file_pattern_hits(spark, sf):
    """What each line of the pattern file finds in each document: how often, and the first and last match with context."""
    docs = v.documents(spark, sf, heavy=True).select("doc_id", "text")
    hits = op.match_rows(docs, read_pattern_rows(spark, pattern_file(spark, sf)), "doc_id", contexts=True)
    return hits.select("doc_id", "kw", "n", F.element_at("hits", 1).alias("first"), F.element_at("hits", -1).alias("last"))


QUERIES = {
    "file_patterns": file_patterns,
    "file_pattern_hits": file_pattern_hits,
    "grep_hits": grep_hits,
    "grep_counts": grep_counts,
    "grep_counts_stored": lambda s, d: op.hit_counts(with_hits(s, d), patterns(s)),
    "search_hits": search_hits,
    "hit_corpus": hit_corpus,
    "hit_totals": lambda s, d: op.hit_totals(with_hits(s, d)),
    "search_hits_page": search_hits_page,
}


def _pattern_hits(a: int, p: str) -> str:
    # Matches and the text between them, then running lengths for the start of each match.
    return f"""SELECT doc_id, {a} AS a, '{p}' AS kw, i,
        substring(text, CAST(greatest(st - 20, 0) + 1 AS BIGINT), CAST(st + length(m[i]) + 20 - greatest(st - 20, 0) AS BIGINT)) AS p
      FROM (SELECT *, list_sum(list_transform(q[1:i], lambda x: length(x)))
                + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS st
            FROM (SELECT doc_id, text, m, q, unnest(range(1, len(m) + 1)) AS i
                  FROM (SELECT doc_id, text, regexp_extract_all(text, '{p}') AS m,
                               string_split(regexp_replace(text, '{p}', chr(1), 'g'), chr(1)) AS q FROM e WHERE text <> '')))"""


_HITS = f"WITH {v.ENTRIES_SQL}, h AS (" + " UNION ALL ".join(_pattern_hits(a, p) for a, p in _VALID.items()) + ") "

_FILE_LINES = f"""WITH w AS (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS w FROM documents),
      f AS (SELECT w FROM w GROUP BY w ORDER BY count(*) DESC, w LIMIT {FREQUENT_WORDS}),
      o AS (SELECT DISTINCT w FROM w ORDER BY md5(w) LIMIT {OTHER_WORDS}),
      t AS (SELECT w, substring(w, 2) AS rest, substring(w, 1, 1) AS c FROM (SELECT w FROM f UNION SELECT w FROM o)),
      p AS (SELECT rest, CASE length(w) % 3 WHEN 0 THEN w || '[a-z]*' WHEN 1 THEN '[' || c || upper(c) || ']' || rest ELSE w || '|' || upper(c) || rest END AS kw FROM t
            UNION ALL SELECT '', unnest({[x for x in _SHORT_LINES if not x.startswith("(")]}))"""

ORACLES = {
    "file_patterns": _FILE_LINES
    + """, c AS (SELECT kw, sum(len(regexp_extract_all(text, kw))) AS n FROM documents, p WHERE contains(lower(text), rest) GROUP BY kw)
      SELECT kw, CAST(n AS BIGINT) AS n FROM c WHERE n > 0""",
    "file_pattern_hits": _FILE_LINES
    + """, h AS (SELECT doc_id, text, kw, regexp_extract_all(text, kw) AS m, string_split(regexp_replace(text, kw, chr(1), 'g'), chr(1)) AS q
        FROM documents, p WHERE contains(lower(text), rest)),
      s AS (SELECT *, length(q[1]) AS a, length(text) - length(q[len(q)]) - length(m[len(m)]) AS b FROM h WHERE len(m) > 0)
      SELECT doc_id, kw, len(m) AS n, substring(text, CAST(greatest(a - 20, 0) + 1 AS BIGINT), CAST(a + length(m[1]) + 20 - greatest(a - 20, 0) AS BIGINT)) AS first,
        substring(text, CAST(greatest(b - 20, 0) + 1 AS BIGINT), CAST(b + length(m[len(m)]) + 20 - greatest(b - 20, 0) AS BIGINT)) AS last FROM s""",
    "grep_hits": _HITS
    + """, g AS (SELECT doc_id, count(*) AS n, string_agg(a || ':' || p, '|' ORDER BY a, i) AS hits FROM h GROUP BY doc_id)
      SELECT entry_id, coalesce(n, 0) AS n, coalesce(hits, '') AS hits FROM e LEFT JOIN g USING (doc_id) WHERE text <> ''""",
    "grep_counts": _HITS + "SELECT a, count(*) AS n, kw FROM h GROUP BY a, kw",
    "grep_counts_stored": _HITS + "SELECT a, count(*) AS n, kw FROM h GROUP BY a, kw",
    "search_hits": _HITS + 'SELECT a, kw, p, full_path AS "fP", entry_id AS "fId" FROM h JOIN e USING (doc_id)',
    "hit_corpus": _HITS + "SELECT entry_id, full_path AS doc, md5 AS text_md5 FROM e WHERE doc_id IN (SELECT doc_id FROM h)",
    "hit_totals": _HITS
    + """, g AS (SELECT doc_id, count(*) AS n FROM h GROUP BY doc_id)
      SELECT CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_hits, count(*) AS n_files, count(n) AS n_files_hit, max(coalesce(n, 0)) AS max_hits
      FROM e LEFT JOIN g USING (doc_id) WHERE text <> ''""",
    "search_hits_page": _HITS
    + 'SELECT a, p, full_path AS "fP" FROM h JOIN e USING (doc_id) ORDER BY full_path, a, p LIMIT 25 OFFSET 25',
}

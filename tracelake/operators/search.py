"""Search of texts with many regular expressions.

Patterns are Java regular expressions and run as built-in expressions; no Python is involved and
nothing is shuffled: each document keeps its hits in its own row.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import full_path, once
from ..session import BROADCAST_BYTES, materialize, stored_bytes
from ..sources.patterns import GRAM, Pattern, pattern_frame

# Fixed value: characters of context on each side of a hit.
CONTEXT = 20

# Pieces on one side of a hit that are sure to hold CONTEXT characters, if the text has them: at
# least one of any two neighbouring pieces is not empty.
_REACH = 2 * CONTEXT + 2

HIT = "struct<a:int,p:string>"


def _contexts(matches: Column, parts: Column) -> Column:
    """Each match with its surroundings, from the matches of a pattern and the text between them.

    ``parts`` has one element more than ``matches``: the text is part, match, part, ..., part.
    """
    around = F.arrays_zip(
        matches.alias("m"),
        F.slice(parts, F.lit(1), F.size(matches)).alias("before"),
        F.slice(parts, F.lit(2), F.size(matches)).alias("after"),
    )

    def end(piece: Column) -> Column:
        # The bytes that hold the last characters; a long piece is not counted through for them.
        return F.right(F.substring(piece.cast("binary"), -4 * CONTEXT, 4 * CONTEXT).cast("string"), F.lit(CONTEXT))

    def left(x: Column, i: Column) -> Column:
        # i counts from 0: parts 1..i+1 and matches 1..i lie to the left
        first = F.greatest(i - F.lit(_REACH), F.lit(0))
        near = F.zip_with(
            F.slice(parts, first + 1, i - first + 1),
            F.slice(matches, first + 1, i - first),
            lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))),
        )
        return F.when(F.length(end(x["before"])) >= CONTEXT, end(x["before"])).otherwise(end(F.array_join(near, "")))

    def right(x: Column, i: Column) -> Column:
        near = F.zip_with(
            F.slice(parts, i + 2, F.lit(_REACH)),
            F.slice(matches, i + 2, F.lit(_REACH)),
            lambda p, m: F.concat(F.coalesce(p, F.lit("")), F.coalesce(m, F.lit(""))),
        )
        start = F.left(x["after"], F.lit(CONTEXT))
        return F.when(F.length(start) >= CONTEXT, start).otherwise(F.left(F.array_join(near, ""), F.lit(CONTEXT)))

    return F.transform(around, lambda x, i: F.concat(left(x, i), x["m"], right(x, i)))


def _hits_of(pattern: Pattern, matches: Column, parts: Column) -> Column:
    """Hits of one pattern from its matches and the text between them."""
    return F.transform(_contexts(matches, parts), lambda p: F.struct(F.lit(pattern.a).alias("a"), p.alias("p")))


# Patterns that one combined pattern stands for in the test whether a text can have a hit at all.
GROUP = 32

# Combining numbers groups anew and carries flags over, so patterns with references, names or flags stay alone.
_NOT_COMBINED = re.compile(r"\\[1-9k]|\(\?[<a-zA-Z-]|\\[QE]")


def _guards(patterns: list[Pattern], text: str) -> dict[int, Column]:
    """For each pattern's number a test that every text with a hit passes: one for each group of patterns, made of their alternatives."""
    together = [p for p in patterns if not _NOT_COMBINED.search(p.kw)]
    guards = {p.a: F.lit(True) for p in patterns}
    for at in range(0, len(together), GROUP):
        part = together[at : at + GROUP]
        if len(part) > 1:
            any_of = F.col(text).rlike("|".join(f"(?:{p.kw})" for p in part))
            guards |= {p.a: any_of for p in part}
    return guards


def grep_hits(texts: DataFrame, patterns: list[Pattern], text: str = "text") -> DataFrame:
    """Add ``hits``, an array of ``(a, p)``: pattern number and the match with its context.

    Every non-overlapping match of every valid pattern is kept, in order. Documents without text
    are left out; documents without a match keep an empty array. A document is cut at the matches
    of a pattern, which gives both the matches and their surroundings; documents that a pattern
    does not match are scanned by it once.
    """
    out = texts.where(F.length(text) > 0)
    base = out.columns
    none = F.array().cast(f"array<{HIT}>")
    valid = [p for p in patterns if p.valid]
    if not valid:
        return out.withColumn("hits", none)

    def each(value) -> Column:
        return F.struct(*[value(p).alias(f"p{p.a}") for p in valid])

    def matches(p: Pattern) -> Column:
        return F.col(f"_m.p{p.a}")

    def parts(p: Pattern) -> Column:
        # A match of no characters at the very start gives no leading part.
        cut = F.col(f"_c.p{p.a}")
        return F.when(F.size(cut) == F.size(matches(p)), F.concat(F.array(F.lit("")), cut)).otherwise(cut)

    guards = _guards(valid, text)
    tests = list({id(g): g for g in guards.values()}.values())
    number = {id(g): i for i, g in enumerate(tests)}
    out = once(out, "_g", F.struct(*[g.alias(f"g{i}") for i, g in enumerate(tests)]))
    found = lambda p: F.regexp_extract_all(text, F.lit(p.kw), F.lit(0))
    out = once(out, "_m", each(lambda p: F.when(F.col(f"_g.g{number[id(guards[p.a])]}"), found(p)).otherwise(F.array().cast("array<string>"))))
    out = once(out, "_c", each(lambda p: F.when(F.size(matches(p)) > 0, F.split(text, p.kw, -1))))
    out = once(out, "_q", each(lambda p: F.when(F.size(matches(p)) > 0, parts(p))))
    hits = [
        F.when(F.size(matches(p)) > 0, _hits_of(p, matches(p), F.col(f"_q.p{p.a}"))).otherwise(none)
        for p in valid
    ]
    return once(out, "hits", F.concat(*hits).cast(f"array<{HIT}>")).select(*base, "hits")


def grep_counts(texts: DataFrame, patterns: list[Pattern], text: str = "text") -> DataFrame:
    """Rows ``a, n, kw``: hits per pattern that has any, without building the hits."""
    valid = [p for p in patterns if p.valid]
    if not valid:
        return pattern_frame(texts.sparkSession, []).selectExpr("a", "cast(0 as bigint) n", "kw")
    guards = _guards(valid, text)
    tests = list({id(g): g for g in guards.values()}.values())
    number = {id(g): i for i, g in enumerate(tests)}
    guarded = once(texts.where(F.length(text) > 0).select(text), "_g", F.struct(*[g.alias(f"g{i}") for i, g in enumerate(tests)]))
    totals = guarded.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(f"_g.g{number[id(guards[p.a])]}"), F.regexp_count(text, F.lit(p.kw))).cast("bigint")), F.lit(0)).alias(f"_n{p.a}")
            for p in valid
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(p.a).alias("a"), F.col(f"_n{p.a}").alias("n"), F.lit(p.kw).alias("kw"))
            for p in valid
        ]
    )
    return totals.select(F.inline(rows)).where("n > 0").orderBy("a")


def hit_counts(with_hits: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """The same counts from stored hits."""
    labels = pattern_frame(with_hits.sparkSession, patterns)
    counts = with_hits.select(F.explode("hits.a").alias("a")).groupBy("a").agg(F.count("*").alias("n"))
    # As many label rows as patterns, which the plan holds one by one anyway.
    return counts.join(F.broadcast(labels), "a").select("a", "n", "kw").orderBy("a")


def search_hits(with_hits: DataFrame, patterns: list[Pattern]) -> DataFrame:
    """One row per hit: pattern number and text, context, full path and id of the file."""
    labels = pattern_frame(with_hits.sparkSession, patterns)
    rows = with_hits.select(
        F.col("entry_id").alias("fId"), full_path().alias("fP"), F.inline("hits")
    )
    return rows.join(F.broadcast(labels), "a").select("a", "kw", "p", "fP", "fId")


def has_hit(patterns: list[Pattern], text: str = "text") -> Column:
    """True for texts that some pattern matches; each pattern stops at its first match."""
    found = F.lit(False)
    valid = [p for p in patterns if p.valid]
    together = [p.kw for p in valid if not _NOT_COMBINED.search(p.kw)]
    alone = [p.kw for p in valid if _NOT_COMBINED.search(p.kw)]
    for kw in ["|".join(f"(?:{kw})" for kw in together[at : at + GROUP]) for at in range(0, len(together), GROUP)] + alone:
        found = found | F.col(text).rlike(kw)
    return (F.length(text) > 0) & found


# Bits of the filter that keeps a text's grams from the join if no pattern asks for them.
_FILTER_BITS = 1 << 16


def _gram_filter(index: DataFrame) -> Column:
    """A test of a gram's hash ``g`` that all grams of the index pass; as large whatever the number of patterns."""
    words = [0] * (_FILTER_BITS // 64)
    for r in index.select(F.pmod("gram", F.lit(_FILTER_BITS)).alias("bit")).distinct().collect():  # _FILTER_BITS rows at most
        words[r.bit // 64] |= 1 << r.bit % 64
    table = F.array(*[F.lit(w - (1 << 64) if w >> 63 else w) for w in words]).cast("array<bigint>")

    def test(g: Column) -> Column:
        bit = F.pmod(g, F.lit(_FILTER_BITS))
        return F.getbit(F.get(table, F.floor(bit / 64).cast("int")), F.pmod(bit, F.lit(64))) == 1

    return test


def gram_index(patterns: DataFrame) -> DataFrame:
    """Stored rows ``gram, literal, earlier, a, kw`` of patterns with required literals: one gram of each literal, that which fewest literals have.

    ``earlier`` holds the pattern's literals before this one.
    """
    numbered = patterns.where("valid AND literals IS NOT NULL").withColumn("_all", F.array_distinct("literals"))
    literals = numbered.select("a", "kw", "_all", F.posexplode("_all").alias("_i", "literal"))
    literals = literals.select("a", "kw", "literal", F.slice("_all", F.lit(1), F.col("_i")).alias("earlier"))
    grams = F.array_distinct(F.when(F.length("literal") >= LONG_GRAM, _grams("literal", LONG_GRAM)).otherwise(_grams("literal", GRAM)))
    listed = literals.select("*", F.explode(grams).alias("_gram"))
    common = listed.groupBy("_gram").agg(F.count("*").alias("_n"))
    rarest = listed.join(common, "_gram").groupBy("a", "kw", "literal", "earlier").agg(F.min(F.struct("_n", "_gram")).alias("_g"))
    return materialize(rarest.select(F.xxhash64("_g._gram").alias("gram"), "literal", "earlier", "a", "kw"), "gram-index")


# Literals of so many characters are looked up by grams of this size, which fewer texts hold.
LONG_GRAM = 5


def _grams(text: str, size: int) -> Column:
    """Every ``size`` characters that stand together."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{size}}}))"), F.lit(1))


def candidates(texts: DataFrame, patterns: DataFrame, key: str, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows ``key, _text, a, kw`` from ``(key, _text)``: each text with each pattern of which it holds a required literal.

    A text's different grams pass a filter of fixed size and are joined with the index. A small index is broadcast, and each text is
    compared with the literals found where it lies. Beyond that grams and index are shuffled, and what is found is joined with the texts by ``key``.
    """
    index = gram_index(patterns)
    asked_for = _gram_filter(index)
    hashes = [F.array_distinct(F.filter(F.transform(F.array_distinct(_grams("_text", n)), lambda g: F.xxhash64(g)), asked_for)) for n in (GRAM, LONG_GRAM)]
    grams = once(texts.where(F.length("_text") >= GRAM), "_grams", F.concat(*hashes))
    if stored_bytes(index) <= max_broadcast_bytes:
        found = grams.select(key, "_text", F.explode("_grams").alias("gram")).join(F.broadcast(index), "gram")
    else:
        listed = grams.select(key, F.explode("_grams").alias("gram")).join(index, "gram").drop("gram").distinct()
        found = texts.join(listed, key)
    first = F.contains("_text", "literal") & ~F.exists("earlier", lambda x: F.contains("_text", x))
    return found.where(first).select(key, "_text", "a", "kw")


def match_rows(texts: DataFrame, patterns: DataFrame, key: str, text: str = "text", contexts: bool = False, max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Rows ``key, a, kw, n`` and, if asked for, ``hits``: each pattern of ``patterns`` (rows of ``sources.pattern_rows``) with each document that it matches.

    Only candidates are tried: those found over the grams of a literal that the pattern requires, and all documents for a pattern without one. The size of the plan
    follows the number of the latter only. ``hits`` holds every match with its context, as ``grep_hits`` gives it. ``key`` names a document; rows that share it
    are searched each.
    """
    if key in ("a", "kw", "n", "hits", "literal", "earlier", "gram"):
        raise ValueError(f"rename the key {key!r}")
    rows = texts.where(F.length(text) > 0).select(key, F.col(text).alias("_text"))
    found = candidates(rows, patterns, key, max_broadcast_bytes)
    for p in _without_literals(patterns):
        found = found.unionByName(rows.where(F.col("_text").rlike(p.kw)).select(key, "_text", F.lit(p.a).cast("long").alias("a"), F.lit(p.kw).alias("kw")))
    if not contexts:
        return once(found, "n", F.regexp_count("_text", "kw").cast("long")).where("n > 0").select(key, "a", "kw", "n")
    found = once(found, "_m", F.regexp_extract_all("_text", "kw", F.lit(0))).where(F.size("_m") > 0)
    found = once(found, "_cut", F.split("_text", F.col("kw"), -1))
    parts = F.when(F.size("_cut") == F.size("_m"), F.concat(F.array(F.lit("")), "_cut")).otherwise(F.col("_cut"))
    found = once(found, "_parts", parts)
    return once(found, "hits", _contexts(F.col("_m"), F.col("_parts"))).select(key, "a", "kw", F.size("_m").cast("long").alias("n"), "hits")


def _without_literals(patterns: DataFrame) -> list[Pattern]:
    """The patterns that every text must be tried with; they are part of the plan."""
    return [Pattern(r.a, r.kw, True) for r in patterns.where("valid AND literals IS NULL").select("a", "kw").collect()]


def match_counts(texts: DataFrame, patterns: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Rows ``a, n, kw``: hits of each pattern that has any, for patterns given as rows."""
    listed = match_rows(texts, patterns.where("literals IS NOT NULL"), key, text).groupBy("a", "kw").agg(F.sum("n").alias("n"))
    tried = _without_literals(patterns)
    counts = listed.select("a", "n", "kw")
    return counts.unionByName(grep_counts(texts, tried, text).withColumn("a", F.col("a").cast("long"))) if tried else counts


def hit_corpus(with_hits: DataFrame, text: str = "text") -> DataFrame:
    """Documents that have at least one hit."""
    return with_hits.where(F.col(text).isNotNull() & (F.size("hits") > 0)).select(
        "entry_id", full_path().alias("doc"), F.col(text).alias("text")
    )


def hit_totals(with_hits: DataFrame) -> DataFrame:
    """Totals over all patterns: hits, files searched, files with hits, most hits in one file."""
    n = F.size("hits").cast("bigint")
    return with_hits.agg(
        F.coalesce(F.sum(n), F.lit(0)).cast("bigint").alias("n_hits"),
        F.count("*").alias("n_files"),
        F.count_if(n > 0).alias("n_files_hit"),
        F.coalesce(F.max(n), F.lit(0)).cast("bigint").alias("max_hits"),
    )


def report_page(rows: DataFrame, sort_by: list[str], page: int = 0, page_rows: int = 25) -> DataFrame:
    """One page of a report table, sorted ascending."""
    return rows.orderBy(*sort_by).offset(page * page_rows).limit(page_rows)

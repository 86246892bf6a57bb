"""Search patterns: one Java regular expression per line."""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..session import materialize
from .lines import numbered_lines

#: Characters of a literal by which texts are looked up; a pattern whose literals are shorter is tried on every text.
GRAM = 3


class Pattern(NamedTuple):
    a: int
    kw: str
    valid: bool


def _compiles(spark: SparkSession, texts: list[str]) -> bool:
    try:
        spark.range(1).select(*[F.lit("").rlike(t) for t in texts]).collect()
    except PySparkException:
        return False
    return True


def make_patterns(spark: SparkSession, lines: list[str]) -> list[Pattern]:
    """Number the non-blank lines from 0. An invalid one keeps its number but never matches."""
    texts = [t for t in lines if t != ""]
    valid = {t for at in range(0, len(texts), 100) for t in _valid(spark, texts[at : at + 100])}
    return [Pattern(i, t, t in valid) for i, t in enumerate(texts)]


def _valid(spark: SparkSession, texts: list[str]) -> list[str]:
    """The patterns that compile; a list with a bad one is halved until the bad ones stand alone."""
    if not texts or _compiles(spark, texts):
        return texts
    half = len(texts) // 2
    return _valid(spark, texts[:half]) + _valid(spark, texts[half:]) if half else []


def load_patterns(spark: SparkSession, path: str) -> list[Pattern]:
    """The lines of the files under ``path``, file by file. Patterns are part of the plan of a search, so the driver holds the list."""
    rows = spark.read.text(path, wholetext=True).collect()
    lines = [line for row in rows for line in row.value.split("\n")]
    return make_patterns(spark, [line.rstrip("\r") for line in lines])


def pattern_frame(spark: SparkSession, patterns: list[Pattern]) -> DataFrame:
    return spark.createDataFrame([(p.a, p.kw) for p in patterns], "a int, kw string")


def read_pattern_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The same patterns as stored rows ``a, kw, valid, literals``; neither the driver nor a plan holds the list.

    Blank lines are left out and the others numbered from 0, file by file in the order of their names: the files' numbers of lines are few rows, each line's place within its file comes
    from its line number.
    """
    lines = numbered_lines(spark, path).select("file", "line_no", F.rtrim("value", F.lit("\r")).alias("kw"))
    lines = materialize(lines.where("kw <> ''"), "pattern-lines")
    sizes = lines.groupBy("file").agg(F.count("*").alias("n"))
    first = sizes.select("file", F.coalesce(F.sum("n").over(W.orderBy("file").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_first"))
    place = F.row_number().over(W.partitionBy("file").orderBy("line_no"))
    return pattern_rows(lines.join(first, "file").select((F.col("_first") + place - 1).alias("a"), "kw"))


def pattern_rows(patterns: DataFrame) -> DataFrame:
    """Stored rows ``a, kw, valid, literals`` from ``(a, kw)``.

    ``valid``: it compiles. ``literals``: every match of the pattern holds one of them; null if no such list is known.
    """
    compiled = F.try_reflect(F.lit("java.util.regex.Pattern"), F.lit("matches"), F.col("kw"), F.lit("")).isNotNull()

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            yield frame.assign(literals=frame["kw"].map(required_literals))

    rows = patterns.select(F.col("a").cast("long"), "kw", compiled.alias("valid"))
    return materialize(rows.mapInPandas(read, "a long, kw string, valid boolean, literals array<string>"), "patterns")


# Escapes whose argument follows, numbered references, and quoting: such patterns are not read.
_UNREAD = re.compile(r"\\[pPxukc0-9NoQE]|\(\?[a-zA-Z-]|\[\^?\]")


def required_literals(kw: str) -> list[str] | None:
    """For each alternative of a Java regular expression the longest run of plain characters that every match holds; None unless each has ``GRAM`` of them."""
    if _UNREAD.search(kw):
        return None
    best, found, run, at = "", [], "", 0
    while at < len(kw):
        c = kw[at]
        at += 1
        if c == "\\":
            if at < len(kw) and not kw[at].isalnum():
                run += kw[at]
            else:
                best, run = max(best, run, key=len), ""
            at += 1
        elif c in "[(":
            at = _closed(kw, at - 1)
            best, run = max(best, run, key=len), ""
        elif c == "|":
            found.append(max(best, run, key=len))
            best = run = ""
        elif c in "*?{+":
            # What stands before may be missing, or come again.
            best, run = max(best, run if c == "+" else run[:-1], key=len), ""
            if c == "{":
                at = kw.find("}", at) + 1 or len(kw)
            if kw[at : at + 1] in ("?", "+"):
                at += 1
        elif c in ".^$)":
            best, run = max(best, run, key=len), ""
        else:
            run += c
    found.append(max(best, run, key=len))
    return found if all(len(x) >= GRAM for x in found) else None


def _closed(kw: str, at: int) -> int:
    """Where the group or class that opens at ``at`` is over; the end, if it never is."""
    groups = classes = 0
    while at < len(kw):
        c = kw[at]
        at += 1
        if c == "\\":
            at += 1
        elif c == "[":
            classes += 1
        elif classes:
            classes -= c == "]"
        else:
            groups += (c == "(") - (c == ")")
        if not groups and not classes:
            break
    return at

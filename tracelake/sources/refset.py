"""Reference hash set: four quoted CSV tables with a header line.

Each ``parse_*`` takes rows ``(file, line_no, value)`` without the header and returns ``(good, bad)``;
``bad`` has the file, the line number, the reason and the line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import once
from .lines import numbered_lines

_CSV = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "escape": '"'}


def _fields(lines: DataFrame, n: int) -> DataFrame:
    """Split each line into ``c0 .. c{n-1}``; ``_bad`` is set when the number of fields differs."""
    schema = ", ".join(f"c{i} string" for i in range(n)) + ", _bad string"
    return once(lines, "_f", F.from_csv("value", schema, _CSV)).select(
        "file",
        "line_no",
        "value",
        *[F.coalesce(F.col(f"_f.c{i}"), F.lit("")).alias(f"c{i}") for i in range(n)],
        F.col("_f._bad").alias("_bad"),
    )


def _width_reason(n: int) -> Column:
    # commas outside quotes; evaluated on malformed lines only
    n_fields = F.regexp_count("value", F.lit(r',(?=(?:[^"]*"[^"]*")*[^"]*\z)')) + 1
    return F.when(
        F.col("_bad").isNotNull(),
        F.when(n_fields < n, "too few columns").when(n_fields > n, "too many columns").otherwise("malformed line"),
    )


def _split(checked: DataFrame, *good: Column) -> tuple[DataFrame, DataFrame]:
    return (
        checked.where("reason is null").select(*good),
        checked.where("reason is not null").select("file", "line_no", "reason", F.col("value").alias("line")),
    )


def _whole(column: str, kind: str) -> Column:
    # Only plain decimal digits with an optional sign count as a number.
    return F.when(F.col(column).rlike(r"^[+-]?\d+\z"), F.col(column)).try_cast(kind)


def _digest(column: str) -> Column:
    return F.when(F.length(column) % 2 == 0, F.unhex(F.when(F.col(column).rlike("^[0-9A-Fa-f]*\\z"), F.col(column))))


def parse_ref_files(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Eight columns: sha1, md5, crc32, name, size, product code, OS code, special code."""
    rows = _fields(lines, 8)
    size, prod = _whole("c4", "bigint"), _whole("c5", "int")
    sha1, md5, crc32 = _digest("c0"), _digest("c1"), _digest("c2")
    digests_ok = (F.octet_length(sha1) == 20) & (F.octet_length(md5) == 16) & (F.octet_length(crc32) == 4)
    reason = F.coalesce(
        _width_reason(8),
        F.when(size.isNull(), "size is not a number")
        .when(size < 0, "size < 0")
        .when(prod.isNull(), "prod_code is not a number")
        .when(prod < 0, "prod_code < 0")
        .when(sha1.isNull() | md5.isNull() | crc32.isNull(), "digest is not hex")
        .when(~digests_ok, "wrong digest length"),
    )
    return _split(
        rows.withColumn("reason", reason),
        sha1.alias("sha1"),
        md5.alias("md5"),
        crc32.alias("crc32"),
        F.col("c3").alias("name"),
        size.alias("size"),
        prod.alias("prod_code"),
        F.col("c6").alias("os_code"),
        F.col("c7").alias("special_code"),
    )


def _last_wins(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    picked = rows.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct("file", "line_no")).alias("_r"))
    return picked.select(key, *[F.col(f"_r.{c}").alias(c) for c in columns])


def parse_mfg(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Manufacturers: code, name. The last line of a code wins."""
    good, bad = _split(
        _fields(lines, 2).withColumn("reason", _width_reason(2)),
        F.col("file"),
        F.col("line_no"),
        F.col("c0").alias("code"),
        F.col("c1").alias("name"),
    )
    return _last_wins(good, "code", ["name"]), bad


def parse_os(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Operating systems: code, name, version, manufacturer code. The last line of a code wins."""
    good, bad = _split(
        _fields(lines, 4).withColumn("reason", _width_reason(4)),
        F.col("file"),
        F.col("line_no"),
        F.col("c0").alias("code"),
        F.col("c1").alias("name"),
        F.col("c2").alias("version"),
        F.col("c3").alias("mfg_code"),
    )
    return _last_wins(good, "code", ["name", "version", "mfg_code"]), bad


def parse_products(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Products: code, name, version, OS, manufacturer, language, type. All rows of a code are kept."""
    code = _whole("c0", "int")
    reason = F.coalesce(
        _width_reason(7), F.when(code.isNull(), "code is not a number").when(code < 0, "code < 0")
    )
    return _split(
        _fields(lines, 7).withColumn("reason", reason),
        code.alias("code"),
        F.col("c1").alias("name"),
        F.col("c2").alias("version"),
        F.col("c3").alias("os_code"),
        F.col("c4").alias("mfg_code"),
        F.col("c5").alias("language"),
        F.col("c6").alias("app_type"),
    )


def _body(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines after the header; the first data line has number 1."""
    return (
        numbered_lines(spark, path)
        .where("line_no > 1")
        .select("file", (F.col("line_no") - 1).alias("line_no"), "value")
    )


def read_ref_files(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    # The file list repeats its header in every volume, so it is recognised by its text.
    lines = numbered_lines(spark, path).where(~F.col("value").startswith('"SHA-1"'))
    return parse_ref_files(lines)


def read_mfg(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_mfg(_body(spark, path))


def read_os(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_os(_body(spark, path))


def read_products(spark: SparkSession, path: str | list[str]) -> tuple[DataFrame, DataFrame]:
    return parse_products(_body(spark, path))

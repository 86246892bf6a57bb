"""File-system entries: JSON lines in, typed rows out; and the scan of stored entries."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import once, positive_timestamp
from ..schema import ATTRS


class ParsedEntries(NamedTuple):
    good: DataFrame
    rejects: DataFrame


def _kind(doc: Column, path: str) -> Column:
    """Type name of a JSON value, NULL when the field is absent."""
    return F.schema_of_variant(F.try_variant_get(doc, path, "variant"))


def _is_number(kind: Column) -> Column:
    return kind.rlike("^(BIGINT|DECIMAL|DOUBLE|FLOAT)")


def _long(doc: Column, path: str) -> Column:
    return F.try_variant_get(doc, path, "bigint")


# column -> path of optional whole numbers, copied as they are
_OPTIONAL = {
    "name_flags": "$.name.flags",
    "meta_seq": "$.name.meta_seq",
    "name_type": "$.name.type",
    "fs_byte_offset": "$.fs.byteOffset",
    "fs_block_size": "$.fs.blockSize",
    "meta_flags": "$.meta.flags",
    "uid": "$.meta.uid",
    "gid": "$.meta.gid",
    "meta_type": "$.meta.type",
    "seq": "$.meta.seq",
    "mode": "$.meta.mode",
    "content_len": "$.meta.content_len",
    "meta_addr": "$.meta.addr",
    "nlink": "$.meta.nlink",
}

_STAMPS = {
    "created": "$.meta.crtime",
    "written": "$.meta.mtime",
    "accessed": "$.meta.atime",
    "updated": "$.meta.ctime",
}


def _reject_reason(doc: Column) -> Column:
    """Why a line is not an entry; NULL for a good one."""
    return (
        F.when(doc.isNull() | ~F.schema_of_variant(doc).startswith("OBJECT"), "not a JSON object")
        .when(F.coalesce(_kind(doc, "$.path"), F.lit("")) != "STRING", "path is not a string")
        .when(~F.coalesce(_kind(doc, "$.name"), F.lit("")).startswith("OBJECT"), "name is not an object")
        .when(F.coalesce(_kind(doc, "$.name.name"), F.lit("")) != "STRING", "name.name is not a string")
        .when(~_kind(doc, "$.fs").startswith("OBJECT"), "fs is not an object")
        .when(~_kind(doc, "$.meta").startswith("OBJECT"), "meta is not an object")
        .when(
            _kind(doc, "$.meta").isNotNull()
            & ~F.coalesce(_is_number(_kind(doc, "$.meta.size")), F.lit(False)),
            "meta.size is not a number",
        )
    )


def parse_entry_lines(lines: DataFrame, column: str = "value", keep: list[str] | None = None) -> ParsedEntries:
    """Parse one JSON object per row into the entries schema.

    Rows are independent of each other. ``keep`` names further input columns to carry along.
    """
    keep = keep or []
    doc = F.col("_doc")
    parsed = once(lines.select(*keep, F.col(column).alias("_line")), "_doc", F.try_parse_json("_line"))
    checked = parsed.withColumn("_reason", _reject_reason(doc))

    stamps = [
        positive_timestamp(F.when(_is_number(_kind(doc, path)), _long(doc, path))).alias(name)
        for name, path in _STAMPS.items()
    ]
    columns = {name: _long(doc, path).alias(name) for name, path in _OPTIONAL.items()}
    has_meta = _kind(doc, "$.meta").isNotNull()
    good = checked.where("_reason is null").select(
        *keep,
        F.try_variant_get(doc, "$.path", "string").alias("path"),
        F.try_variant_get(doc, "$.name.name", "string").alias("name"),
        _long(doc, "$.name.dirIndex").alias("dir_index"),
        columns["name_flags"],
        columns["meta_seq"],
        columns["name_type"],
        columns["fs_byte_offset"],
        F.try_variant_get(doc, "$.fs.fsID", "string").alias("fs_id"),
        columns["fs_block_size"],
        *stamps,
        F.when(has_meta, _long(doc, "$.meta.size")).otherwise(F.lit(0).cast("bigint")).alias("size"),
        *[columns[c] for c in list(_OPTIONAL)[5:]],
        has_meta.alias("has_meta"),
        F.try_variant_get(doc, "$.attrs", ATTRS).alias("attrs"),
    )
    rejects = checked.where("_reason is not null").select(
        *keep, F.col("_reason").alias("reason"), F.col("_line").alias("line")
    )
    return ParsedEntries(good, rejects)


def read_entries(spark: SparkSession, path: str | list[str]) -> ParsedEntries:
    """Read JSON-lines files of entries."""
    return parse_entry_lines(spark.read.text(path))


def scan_entries(entries: DataFrame, image_id: str | None = None) -> DataFrame:
    """Entries of one image, or of all. On a table partitioned by ``image_id`` this prunes partitions."""
    return entries if image_id is None else entries.where(F.col("image_id") == image_id)

"""What is in an image: counts, sizes, listings, timeline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import extension, full_path
from .content import is_away, load_content, placed

# Fixed value: name type of a regular file.
REGULAR_FILE = 5

# Names of the time columns, in output order.
STAMPS = ["created", "accessed", "written", "updated"]

COOKIE_FIELDS = ["name", "value", "domain", "flags"]


def folder_count(entries: DataFrame) -> DataFrame:
    return entries.groupBy("path").agg(F.count("*").alias("n"))


def dir_sizes(entries: DataFrame) -> DataFrame:
    """Bytes per folder; entries without a size are left out."""
    known = entries.where("path is not null and size is not null")
    return known.groupBy("path").agg(F.sum("size").alias("total_size"))


def ext_count(entries: DataFrame) -> DataFrame:
    return entries.groupBy(extension().alias("ext")).agg(F.count("*").alias("n"))


def ext_size(entries: DataFrame) -> DataFrame:
    """Bytes, files and mean size per extension."""
    sized = entries.where("size is not null").groupBy(extension().alias("ext"))
    return sized.agg(
        F.sum("size").alias("size"), F.count("*").alias("count"), F.avg("size").alias("avg_size")
    )


def ext_paths(entries: DataFrame) -> DataFrame:
    """Every full path under its extension, in key order.

    A range-partitioned sort on both columns: a very common extension spans several partitions.
    """
    return entries.select(extension().alias("ext"), full_path().alias("full_path")).orderBy("ext", "full_path")


def random_per_key(rows: DataFrame, key: str, value: str, row_id: str, seed: int = 0) -> DataFrame:
    """One uniformly chosen row per key; repeatable for a seed.

    Each row draws a number from its id and the smallest draw wins, so the choice is an ordinary
    minimum with partial aggregation before the shuffle.
    """
    draw = F.struct(F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed)))).alias("d"), F.col(row_id).alias("i"), F.col(value).alias("v"))
    return rows.groupBy(key).agg(F.min(draw)["v"].alias(value))


def timeline(entries: DataFrame) -> DataFrame:
    """Rows ``epoch, label``, one per time stamp that is set, in time order."""
    events = F.filter(
        F.array(
            *[
                F.struct(
                    F.unix_seconds(F.col(c)).alias("epoch"),
                    F.concat(F.lit(f"{c}: "), full_path()).alias("label"),
                )
                for c in STAMPS
            ]
        ),
        lambda e: e["epoch"].isNotNull(),
    )
    return entries.select(F.inline(events)).orderBy("epoch", "label")


def is_regular_file(entries: DataFrame) -> Column:
    """Regular files with content, in the row or in the image."""
    return (F.col("name_type") == REGULAR_FILE) & (F.col("size") >= 0) & (F.col("content").isNotNull() | is_away(entries))


def regular_files(entries: DataFrame) -> DataFrame:
    return entries.where(is_regular_file(entries))


def has_extension(extensions: list[str]) -> Column:
    return extension().isin([e.lower() for e in extensions])


def export_by_ext(entries: DataFrame, extensions: list[str] | DataFrame) -> DataFrame:
    """Files with one of the extensions, with digests and content.

    Content that is stored by path is not copied: ``data`` is empty and ``hdfs_path`` is set. Content that lies
    in the image is read by its extents. Files with none of these are left out. ``extensions`` may be a one-column DataFrame when the list is long.
    """
    if isinstance(extensions, DataFrame):
        wanted = extensions.select(F.lower(F.col(extensions.columns[0])).alias("_ext")).distinct()
        kept = entries.withColumn("_ext", extension()).join(wanted, "_ext", "left_semi")
    else:
        kept = entries.where(has_extension(extensions))
    by_path = F.col("content_path").isNotNull()
    found = kept.where(by_path | F.col("content").isNotNull() | is_away(kept)).select(
        "entry_id",
        full_path().alias("full_path"),
        extension().alias("extension"),
        F.coalesce("sha1", F.lit("")).alias("sha1"),
        F.coalesce("md5", F.lit("")).alias("md5"),
        "content",
        "content_path",
        *[F.when(~by_path, F.col(c)).alias(c) for c in placed(kept)],
    )
    return load_content(found).select(
        "entry_id",
        "full_path",
        "extension",
        "sha1",
        "md5",
        F.when(by_path, F.lit("").cast("binary")).otherwise(F.col("content")).alias("data"),
        F.coalesce("content_path", F.lit("")).alias("hdfs_path"),
    )


def cookies(entries: DataFrame, text: str = "content") -> DataFrame:
    """First four lines of cookie files: name, value, domain, flags.

    A cookie file has extension ``txt``, a path with ``Cookies`` after its first character and at
    least four lines.
    """
    body = F.col(text).cast("string")
    lines = F.split(F.regexp_replace(body, r"\n\z", ""), "\n", -1)
    candidates = entries.where(
        (extension() == "txt") & (F.instr("path", "Cookies") > 1) & (F.length(body) > 0)
    ).withColumn("_lines", lines)
    return candidates.where(F.size("_lines") >= 4).select(
        "entry_id",
        *[
            F.regexp_replace(F.element_at("_lines", i + 1), r"^\s+|\s+\z", "").alias(field)
            for i, field in enumerate(COOKIE_FIELDS)
        ],
    )

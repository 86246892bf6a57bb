"""Report datasets: the rows that the report pages show."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def device_info(entries: DataFrame, images: DataFrame) -> DataFrame:
    """Key/value rows per image: name, md5, load time, number of files, size, volumes.

    Volumes are the file systems of an image; they are summed per (image, file system) first.
    """
    volumes = entries.groupBy("image_id", "fs_id").agg(
        F.count("*").alias("files"),
        F.sum("size").alias("n"),
        F.sum(F.when(F.col("name_type") == 5, F.col("size")).otherwise(0)).alias("alloc"),
    )
    volume = F.struct(F.col("fs_id").alias("a"), F.col("n"), F.col("alloc"))
    per_image = volumes.groupBy("image_id").agg(
        F.sum("files").alias("files"), F.to_json(F.array_sort(F.collect_list(volume))).alias("volumes")
    )
    rows = images.join(per_image, "image_id", "left")
    pairs = {
        "deviceName": F.col("friendly_name"),
        "md5": F.col("image_id"),
        "loadedOn": F.date_format("loaded_on", "yyyy-MM-dd HH:mm:ss"),
        "totalFiles": F.coalesce("files", F.lit(0)).cast("string"),
        "size": F.col("size").cast("string"),
        "volumeList": F.coalesce("volumes", F.lit("[]")),
    }
    kv = F.array(*[F.struct(F.lit(k).alias("a"), v.alias("n")) for k, v in pairs.items()])
    return rows.select("image_id", F.inline(kv)).where("n is not null")


def unregistered_entries(entries: DataFrame, images: DataFrame) -> DataFrame:
    """Images that entries name but the registry lacks, with their entries and bytes: no report shows these."""
    lost = entries.join(images.select("image_id").distinct(), "image_id", "left_anti")
    return lost.groupBy("image_id").agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("size"))


def volume_usage(entries: DataFrame, images: DataFrame) -> DataFrame:
    """Used and unused bytes of an image and the rounded share in use, which an image without bytes lacks."""
    used = entries.groupBy("image_id").agg(F.sum("size").alias("used"))
    rows = images.join(used, "image_id", "left").withColumn("used", F.coalesce("used", F.lit(0)))
    return rows.select(
        "image_id",
        F.col("size").alias("size"),
        "used",
        F.greatest(F.col("size") - F.col("used"), F.lit(0)).alias("unused"),
        F.floor(F.try_divide(F.col("used") * 100.0, F.col("size")) + 0.5).cast("bigint").alias("percent"),
    )


def column_total(rows: DataFrame, column: str = "n") -> DataFrame:
    """Sum of a report column."""
    return rows.agg(F.coalesce(F.sum(column), F.lit(0)).alias("total"))


def column_max(rows: DataFrame, column: str = "n", round_to: int = 100) -> DataFrame:
    """Axis limit for a report column: ``round_to``, or twice the largest value once that reaches it."""
    top = F.coalesce(F.max(column), F.lit(0)).cast("bigint")
    return rows.agg(F.when(top >= round_to, top * 2).otherwise(round_to).cast("bigint").alias("limit"))


def csv_lines(rows: DataFrame) -> DataFrame:
    """Each row as a CSV line with every field quoted and quotes doubled."""
    fields = [
        F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
        for c in rows.columns
    ]
    return rows.select(F.concat_ws(",", *fields).alias("value"))

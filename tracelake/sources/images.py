"""Raw images as files and as byte ranges. Bytes are read by positioned reads inside tasks."""

from __future__ import annotations

import os
from urllib.parse import unquote, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

RANGE_BYTES = 64 * 1024 * 1024


def image_files(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Columns ``image, length`` of the files under ``path``; contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    return files.select(F.col("path").alias("image"), F.col("length"))


def image_ranges(images: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row ``image, start, length`` per byte range; the ranges cover each image exactly once."""
    starts = F.sequence(F.lit(0).cast("bigint"), F.col("length") - 1, F.lit(range_bytes).cast("bigint"))
    return (
        images.where("length > 0")
        .select("image", F.col("length").alias("_total"), F.explode(starts).alias("start"))
        .select(
            "image",
            "start",
            F.least(F.lit(range_bytes).cast("bigint"), F.col("_total") - F.col("start")).alias("length"),
        )
    )


def open_filesystem(uri: str):
    """Arrow file system and path for a local path or any URI Arrow knows (hdfs, s3, gs)."""
    from pyarrow import fs

    if uri.startswith("file:"):
        return fs.LocalFileSystem(), unquote(urlparse(uri).path)
    if "://" not in uri:
        return fs.LocalFileSystem(), os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


def open_image(uri: str):
    """Random-access file."""
    filesystem, path = open_filesystem(uri)
    return filesystem.open_input_file(path)

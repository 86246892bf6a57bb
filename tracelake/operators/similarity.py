"""Similarity of images by the files they share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _md5_pairs(file_hashes: DataFrame) -> DataFrame:
    return file_hashes.where(F.col("hash_type") == "md5").select("hash", "image_id")


def shared_pairs(file_hashes: DataFrame, image_id: str) -> DataFrame:
    """Distinct ``(hash, image)`` pairs over the hashes that occur in the reference image.

    The semi join comes first: it drops most rows before anything is regrouped. Its right side has
    the distinct hashes of one image; Spark broadcasts it only if its measured size allows. A hash
    that occurs in a large part of all files collapses to one row per image before the shuffle.
    """
    pairs = _md5_pairs(file_hashes)
    wanted = pairs.where(F.col("image_id") == image_id).select("hash").distinct()
    return pairs.join(wanted, "hash", "left_semi").distinct()


def shared_hashes(file_hashes: DataFrame, image_id: str) -> DataFrame:
    """Per hash of the reference image, the images that have it."""
    return (
        shared_pairs(file_hashes, image_id)
        .groupBy("hash")
        .agg(F.array_sort(F.collect_list("image_id")).alias("images"), F.count("*").alias("n_images"))
    )


def files_in_image(file_hashes: DataFrame, image_id: str) -> DataFrame:
    """Number of files (not of distinct hashes) of an image."""
    return _md5_pairs(file_hashes).where(F.col("image_id") == image_id).agg(F.count("*").alias("n_files"))


def iif_scores(file_hashes: DataFrame, images: DataFrame, image_id: str) -> DataFrame:
    """Score every image against the reference image by inverse image frequency.

    A shared hash that occurs in k of N images adds ln(N/k). ``c`` divides the sum by the largest
    value it could have, ln N times the number of files of the reference image. The reference image
    scores itself; that row has ``is_self``. With one image nothing tells files apart: ``iif`` and ``c`` are 0.
    """
    pairs = materialize(shared_pairs(file_hashes, image_id), "shared-pairs")
    spread = pairs.groupBy("hash").agg(F.count("*").alias("k"))
    n_images = images.select("image_id").distinct().agg(F.count("*")).scalar()
    n_files = files_in_image(file_hashes, image_id).scalar()
    sums = (
        pairs.join(spread, "hash")
        .groupBy("image_id")
        .agg(F.sum(F.log(n_images / F.col("k"))).alias("iif"))
    )
    return sums.select(
        F.col("image_id").alias("id"),
        F.coalesce(F.try_divide("iif", F.log(n_images) * n_files), F.lit(0.0)).alias("c"),
        "iif",
        (F.col("image_id") == image_id).alias("is_self"),
    )


def device_links(scores: DataFrame, images: DataFrame, image_id: str) -> DataFrame:
    """Star of devices around the reference: one weighted link per other image.

    The weight is the score, four times that when there are fewer than five links.
    """
    others = scores.where(~F.col("is_self"))
    n_links = others.agg(F.count("*")).scalar()
    names = images.select(F.col("image_id").alias("id"), F.col("friendly_name").alias("target_name"))
    factor = F.when(n_links < 5, 4.0).otherwise(1.0)
    return others.join(names, "id", "left").select(
        F.lit(image_id).alias("source"),
        F.col("id").alias("target"),
        "target_name",
        F.lit(1).alias("target_group"),
        (F.col("iif") * factor).alias("weight"),
    )

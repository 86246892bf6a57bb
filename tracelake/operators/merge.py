"""Writing into existing datasets: image registry and entry columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def register_images(images: DataFrame, candidates: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split candidates into new images and ids that are registered already.

    Of several candidates with one new id, one is taken and the others are rejected.
    """
    tagged = candidates.join(
        images.select("image_id").distinct().withColumn("_known", F.lit(True)), "image_id", "left"
    )
    cols = candidates.columns
    fresh = tagged.where("_known is null")
    picked = fresh.groupBy("image_id").agg(F.min(F.struct(*[c for c in cols if c != "image_id"])).alias("_r"), F.count("*").alias("_n"))
    accepted = picked.select(*[F.col("image_id") if c == "image_id" else F.col(f"_r.{c}").alias(c) for c in cols])
    rejected = (
        tagged.where("_known is not null").groupBy("image_id").agg(F.count("*").alias("n"))
        .unionByName(picked.where("_n > 1").select("image_id", (F.col("_n") - 1).alias("n")))
    )
    return accepted, rejected


def upsert_entries(base: DataFrame, changes: DataFrame, key: str = "entry_id") -> DataFrame:
    """Apply a change set: a non-null changed value wins, new keys are added, empty changes are skipped.

    ``changes`` has one row per key and any subset of the columns of ``base``, and may add columns.
    When both tables are bucketed by the key, the join needs no shuffle.
    """
    cols = [c for c in changes.columns if c != key]
    puts = changes.where(" or ".join(f"`{c}` is not null" for c in cols)).select(
        key, *[F.col(c).alias(f"_new_{c}") for c in cols]
    )
    merged = base.join(puts, key, "full_outer")
    out = [
        F.coalesce(f"_new_{c}", c).alias(c) if c in cols else F.col(c)
        for c in base.columns
    ]
    extra = [F.col(f"_new_{c}").alias(c) for c in cols if c not in base.columns]
    return merged.select(*out, *extra)


def last_writes(changes: DataFrame, order: str, key: str = "entry_id") -> DataFrame:
    """Fold a log of changes to one row per key: per column, the latest value that is not null."""
    cols = [c for c in changes.columns if c not in (key, order)]
    return changes.groupBy(key).agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(c) for c in cols]
    )

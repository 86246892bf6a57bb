"""From an entry dump and a raw image to stored entries, extents and hashes."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import content as content_op
from ..operators import known, merge
from ..session import materialize
from ..sinks import write_entries, write_extents, write_report, write_sorted_hashes
from ..sources import ParsedEntries, read_entries


class AlreadyRegistered(ValueError):
    """The image is in the registry, so its entries are stored."""


class BeingIngested(ValueError):
    """Another run is at work on the image."""


class Ingested(NamedTuple):
    entries: DataFrame
    extents: DataFrame
    file_hashes: DataFrame
    rejects: DataFrame
    stats: DataFrame


def identify(parsed: DataFrame, image_id: str) -> DataFrame:
    """Add image id, entry id, byte extents and the content that lies in attributes."""
    key = fn.entry_key(F.unhex(F.lit(image_id)), "path", "dir_index")
    return parsed.withColumns(
        {
            "image_id": F.lit(image_id),
            "entry_id": F.lower(F.hex(key)),
            "extents": fn.byte_extents(),
            "runs_overflow": fn.runs_overflow(),
            "content": fn.resident_content(),
        }
    )


def one_per_key(entries: DataFrame) -> DataFrame:
    """Of rows with one entry id, one whole row: the largest by its hash. A dump may repeat lines."""
    columns = entries.columns
    row = F.struct(*columns)
    picked = entries.groupBy("entry_id").agg(F.max_by(row, F.xxhash64(*columns)).alias("_row"))
    return picked.select("_row.*")


def is_registered(spark: SparkSession, out: str, image_id: str) -> bool:
    try:
        return not spark.read.parquet(f"{out}/images").where(F.col("image_id") == image_id).isEmpty()
    except AnalysisException:  # the first image
        return False


def register(spark: SparkSession, out: str, image_id: str, friendly_name: str | None, run_ts: str) -> None:
    """Add the image to the registry under ``out``: id, name, load time. An image that is there is refused."""
    if is_registered(spark, out, image_id):
        raise AlreadyRegistered(image_id)
    row = spark.range(1).select(
        F.lit(image_id).alias("image_id"), F.lit(friendly_name or image_id).alias("friendly_name"), F.lit(run_ts).cast("timestamp").alias("loaded_on")
    )
    row.write.mode("append").parquet(f"{out}/images")


@contextmanager
def claimed(spark: SparkSession, out: str, image_id: str) -> Iterator[None]:
    """Keep other runs from the image until this one is over, however it ends.

    The claim is a file that the store creates only if it isn't there. One left by a driver that was killed has to be deleted by hand: nobody else can
    tell whether that run is still alive.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{out}/claims/{image_id}")
    store = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not store.createNewFile(path):
        raise BeingIngested(f"{image_id}: see {path.toString()}")
    try:
        yield
    finally:
        store.delete(path, False)


def ingest(
    spark: SparkSession,
    lines: str | ParsedEntries,
    image_id: str,
    image_uri: str,
    nsrl: DataFrame,
    bad: DataFrame,
    run_ts: str,
    out: str | None = None,
    friendly_name: str | None = None,
) -> Ingested:
    """Parse entries, read their content from the image, digest it and mark known files.

    Every parsed entry is kept, with or without extents, once for its key. Rows without a valid key are rejected, and runs that
    can't be addressed are reported, while their entry stays. ``out`` names a folder to write entries, extents, hashes and rejects to, each below
    ``image_id=...``, and last the image's row of the registry. An image that is registered there, or that another run has claimed, is refused before anything is
    read; a run that failed is run again, and overwrites what the image's folders hold.
    """
    if out is None:
        return _ingested(spark, lines, image_id, image_uri, nsrl, bad, run_ts)
    with claimed(spark, out, image_id):
        if is_registered(spark, out, image_id):
            raise AlreadyRegistered(image_id)
        done = _ingested(spark, lines, image_id, image_uri, nsrl, bad, run_ts)
        write_entries(done.entries.drop("image_id"), f"{out}/entries/image_id={image_id}", "overwrite")
        write_extents(done.extents, f"{out}/extents/image_id={image_id}", "overwrite")
        write_sorted_hashes(done.file_hashes.drop("image_id"), f"{out}/file_hashes/image_id={image_id}", mode="overwrite")
        write_report(done.rejects, f"{out}/rejects/image_id={image_id}")
        register(spark, out, image_id, friendly_name, run_ts)
    return done


def _ingested(
    spark: SparkSession, lines: str | ParsedEntries, image_id: str, image_uri: str, nsrl: DataFrame, bad: DataFrame, run_ts: str
) -> Ingested:
    parsed = read_entries(spark, lines) if isinstance(lines, str) else lines
    found = identify(parsed.good, image_id)
    entries = one_per_key(found.where("entry_id is not null")).withColumn("image_uri", F.lit(image_uri))
    line = F.to_json(F.struct("path", "name", "dir_index")).alias("line")
    keyless = found.where("entry_id is null").select(F.lit("no valid directory index").alias("reason"), line)
    keyless = keyless.unionByName(found.where("runs_overflow").select(F.lit("runs beyond 64 bits").alias("reason"), line))
    extents = content_op.extents_of(entries.withColumnRenamed("image_uri", "image"))
    extracted = materialize(content_op.extract_content(extents), "extracted")
    resident = content_op.content_hashes(entries.where("content is not null").select("entry_id", "content"))
    from_image = extracted.select(F.col("id").alias("entry_id"), "content", "md5", "sha1", "problem")
    # Content in attributes comes first, as it is the default stream then.
    changes = from_image.join(resident.select("entry_id"), "entry_id", "left_anti").unionByName(
        resident.withColumn("problem", F.lit(False))
    )
    merged = merge.upsert_entries(entries, changes)
    marked = materialize(known.mark_known(merged, nsrl, bad), "entries")
    hashes = content_op.file_hash_rows(marked, run_ts)
    rejects = parsed.rejects.unionByName(keyless)
    return Ingested(marked, extents, hashes, rejects, content_op.extract_stats(extracted))

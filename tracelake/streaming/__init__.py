"""Ingest of entry dumps as they arrive, with the parser of the batch job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.ingest import identify
from ..sources import parse_entry_lines


def stream_entries(spark: SparkSession, folder: str, image_id: str) -> DataFrame:
    """Entries of the JSON-lines files that appear in a folder. No state is kept between rows."""
    lines = spark.readStream.text(folder)
    return identify(parse_entry_lines(lines).good, image_id).where("entry_id is not null")


def stream_rejects(spark: SparkSession, folder: str, image_id: str) -> DataFrame:
    """``reason, line`` of what ``stream_entries`` leaves out, as the batch job reports it."""
    parsed = parse_entry_lines(spark.readStream.text(folder))
    keyless = identify(parsed.good, image_id).where("entry_id is null")
    line = F.to_json(F.struct("path", "name", "dir_index")).alias("line")
    return parsed.rejects.select("reason", "line").unionByName(keyless.select(F.lit("no valid directory index").alias("reason"), line))


def write_stream(entries: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to the entries table, one folder per image; takes what is there and stops."""
    return (
        entries.withColumn("ingested", F.current_timestamp())
        .writeStream.format("parquet")
        .partitionBy("image_id")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

"""Writers. All outputs are partitioned datasets; none goes through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_entries(entries: DataFrame, path: str, mode: str = "append") -> None:
    """Entries as Parquet under one folder per image, so that a scan of one image reads only its files; without the column, ``path`` is one image's folder."""
    writer = entries.write.mode(mode)
    (writer.partitionBy("image_id") if "image_id" in entries.columns else writer).parquet(path)


def write_sorted_hashes(rows: DataFrame, path: str, partitions: int | None = None, mode: str = "append") -> None:
    """Hash rows sorted by hash across files: point and range lookups skip row groups by statistics.

    Rows with all labels of a file, from ``known.product_lists`` with repeats, are shuffled so and written as one row for each label.
    """
    keys = ["hash_type", "hash"]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys)
    if "set_labels" in rows.columns:
        ordered = ordered.select(*[c for c in rows.columns if c != "set_labels"], F.inline("set_labels"))
    ordered.write.mode(mode).option("compression", "zstd").parquet(path)


def write_extents(extents: DataFrame, path: str, mode: str = "append") -> None:
    """Extents in address order across files."""
    keys = ["image", "first_addr"]
    extents.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode(mode).parquet(path)


def write_pairs(pairs: DataFrame, path: str, fmt: str = "text", mode: str = "errorifexists") -> None:
    """Output of scripted jobs: ``text`` is key, tab, value; ``parquet`` is compressed and typed."""
    if fmt == "text":
        line = F.concat_ws("\t", F.col("key").cast("string"), F.col("value").cast("string"))
        pairs.select(line.alias("value")).write.mode(mode).text(path)
    elif fmt == "parquet":
        pairs.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown format {fmt!r}")


def write_export(files: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Exported files with their content, compressed."""
    files.write.mode(mode).option("compression", "zstd").parquet(path)


def write_dump(lines: DataFrame, path: str, mode: str = "errorifexists") -> None:
    lines.write.mode(mode).text(path)


def write_report(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Report rows as JSON lines."""
    rows.write.mode(mode).json(path)


def write_csv(lines: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Lines of ``plans.reports.csv_lines`` with CRLF ends."""
    lines.write.mode(mode).option("lineSep", "\r\n").text(path)

"""What the writers store, read back: script output, report rows, CSV lines, hash rows and extents in their order."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from .. import sinks
from ..operators.known import product_lists
from ..session import lookup_join, materialize, scratch_path
from . import reports, scripts
from . import views as v
from .known import ORACLES as KNOWN
from .known import digest_texts


def script_output(spark, sf):
    """The pairs of a mapper as text lines and as typed rows."""
    pairs = scripts.nested_mapper(spark, sf)
    text, typed = scratch_path(spark, "pairs-text"), scratch_path(spark, "pairs-typed")
    sinks.write_pairs(pairs, text)
    sinks.write_pairs(pairs, typed, "parquet")
    cells = F.split("value", "\t", 2)
    lines = spark.read.text(text).select(F.lit("text").alias("format"), cells[0].alias("key"), cells[1].alias("value"))
    return lines.unionByName(spark.read.parquet(typed).select(F.lit("parquet").alias("format"), "key", "value"))


def report_output(spark, sf):
    path = scratch_path(spark, "report")
    rows = reports.QUERIES["device_info"](spark, sf)
    sinks.write_report(rows, path)
    return spark.read.schema(rows.schema).json(path)


def csv_output(spark, sf):
    path = scratch_path(spark, "csv")
    sinks.write_csv(reports.csv_export(spark, sf), path)
    return spark.read.option("lineSep", "\r\n").text(path)


def _greater(before: list[pa.Array], after: list[pa.Array]) -> pa.Array:
    """Whether keys are larger than those they are compared with, in Spark's order: nulls first."""
    out = pa.repeat(False, len(after[0]))
    for x, y in zip(reversed(before), reversed(after), strict=True):
        larger = pc.or_(pc.and_(pc.is_null(y), pc.is_valid(x)), pc.fill_null(pc.greater(x, y), False))
        same = pc.or_(pc.and_(pc.is_null(x), pc.is_null(y)), pc.fill_null(pc.equal(x, y), False))
        out = pc.or_(larger, pc.and_(same, out))
    return out


def _late_rows(narrow: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Stored places ``_file, _row`` of the rows of ``narrow`` (keys and places, as they are read) whose key is smaller than that of the row before in the file.

    A task reads pieces of files from start to end and passes on the rows out of order in them, and the first and last row of each piece, which are then compared with one another.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            joined = rows if last is None else pa.concat_tables([last, rows])
            columns = {c: joined[c].combine_chunks() for c in joined.column_names}
            n = joined.num_rows
            before, after = ({c: x.slice(i, n - 1) for c, x in columns.items()} for i in (0, 1))
            next_ = pc.and_(pc.equal(before["_file"], after["_file"]), pc.equal(pc.add(before["_row"], 1), after["_row"]))
            late = pc.and_(next_, _greater([before[k] for k in keys], [after[k] for k in keys]))
            starts, ends = joined.slice(1).filter(pc.invert(next_)), joined.slice(0, n - 1).filter(pc.invert(next_))
            if last is None:
                starts = pa.concat_tables([joined.slice(0, 1), starts])
            for kind, found in ((0, starts), (1, ends), (2, joined.slice(1).filter(late))):
                yield from found.append_column("_kind", pa.repeat(pa.scalar(kind, pa.int32()), found.num_rows)).combine_chunks().to_batches()
            last = joined.slice(n - 1)
        if last is not None:
            yield from last.append_column("_kind", pa.repeat(pa.scalar(1, pa.int32()), 1)).combine_chunks().to_batches()

    found = materialize(narrow.mapInArrow(read, StructType([*narrow.schema.fields, StructField("_kind", IntegerType())])), "piece-ends")
    key = F.struct(*keys)
    before = F.lag(key).over(Window.partitionBy("_file").orderBy("_row", "_kind"))
    ends = found.where("_kind < 2").withColumn("_late", before > key).where("_late AND _kind = 0")
    late = ends.select("_file", "_row").unionByName(found.where("_kind = 2").select("_file", "_row"))
    return materialize(late.withColumn("_late", F.lit(True)), "late-rows")


def _shared_ranges(narrow: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Stored rows ``_file, _lo, _hi``: the keys of a file that may be in another one too, as the ranges of the files tell. There are as many rows as files at most."""
    key = F.struct(*keys)
    ranges = narrow.groupBy("_file").agg(F.min(key).alias("_min"), F.max(key).alias("_max"))
    order = Window.orderBy("_min", "_file")
    placed = ranges.select("*", F.max("_max").over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("_below"), F.lead("_min").over(order).alias("_above"))
    below, above = (F.coalesce(x, F.lit(False)) for x in (F.col("_below") >= F.col("_min"), F.col("_above") <= F.col("_max")))
    least = F.when(F.col("_below") < F.col("_max"), F.col("_below")).otherwise(F.col("_max"))
    shared = placed.where(below | above).select(
        "_file", F.when(below, F.col("_min")).otherwise(F.col("_above")).alias("_lo"), F.when(above, F.col("_max")).otherwise(least).alias("_hi")
    )
    return materialize(shared, "shared-ranges")


def _in_order(stored: DataFrame, *keys: str) -> DataFrame:
    """The rows with ``in_order``: whether the row before in the same file is not larger, and ``n_files``: the files that hold rows of these keys.

    Rows stay where they are read, and their order is checked there. Only keys in ranges that files share, few in a sorted set, are shuffled; the places of rows out of order and the keys
    found in several files are then looked up for each row.
    """
    place = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row")]
    narrow = stored.select(*keys, *place)
    late = _late_rows(narrow, keys)
    whole = narrow.dropna(subset=list(keys)).select(*keys, "_file")
    in_doubt = lookup_join(whole, _shared_ranges(whole, keys), "_file").where(F.struct(*keys).between(F.col("_lo"), F.col("_hi")))
    several = in_doubt.groupBy(*keys).agg(F.countDistinct("_file").alias("_n")).where("_n > 1")
    rows = stored.select("*", *place).dropna(subset=list(keys))
    found = lookup_join(lookup_join(rows, late, ["_file", "_row"], "left"), materialize(several, "file-counts"), list(keys), "left")
    others = [c for c in stored.columns if c not in keys]
    return found.select(*keys, *others, F.col("_late").isNull().alias("in_order"), F.coalesce("_n", F.lit(1)).cast("bigint").alias("n_files"))


def sorted_hashes(spark, sf):
    """Hash rows as stored for look-ups: in order within each file, and no hash in two files. Digests are stored as bytes, and shuffled with all labels of a file together."""
    path = scratch_path(spark, "hashes")
    sinks.write_sorted_hashes(product_lists(v.ref_files(spark, sf), v.ref_products(spark, sf), v.ref_mfgs(spark, sf), repeats=True), path)
    return _in_order(spark.read.parquet(path), "hash_type", "hash").withColumns(digest_texts("hash", "other_hash", "crc32"))


def sorted_extents(spark, sf):
    """Address ranges of the files with content, an image's one after the other."""
    path = scratch_path(spark, "extents")
    found = v.entries(spark, sf).where("size > 0")
    sinks.write_extents(found.select(F.col("image_id").alias("image"), F.col("doc_id").alias("first_addr"), F.col("size").alias("length")), path)
    return _in_order(spark.read.parquet(path), "image", "first_addr")


QUERIES = {
    "script_output": script_output,
    "report_output": report_output,
    "csv_output": csv_output,
    "sorted_hashes": sorted_hashes,
    "sorted_extents": sorted_extents,
}

ORACLES = {
    "script_output": f"SELECT f.format, p.key, p.value FROM ({scripts.ORACLES['nested_mapper']}) p, (VALUES ('text'), ('parquet')) f(format)",
    "report_output": reports.ORACLES["device_info"],
    "csv_output": reports.ORACLES["csv_export"],
    "sorted_hashes": f"SELECT *, true AS in_order, 1 AS n_files FROM ({KNOWN['nsrl_products']})",
    "sorted_extents": f"""WITH {v.ENTRIES_SQL}
      SELECT image_id AS image, doc_id AS first_addr, size AS length, true AS in_order, 1 AS n_files FROM e WHERE size > 0""",
}

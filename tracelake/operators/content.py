"""File content: digests, extraction from raw images, block hashes."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import full_path
from ..session import small_batches, tasks_for
from ..sources.images import image_ranges, open_image

# Largest content kept in a row, bytes read at once, and the hashed block.
INLINE_BYTES = 1024 * 1024
READ_BYTES = 64 * 1024 * 1024
BLOCK_BYTES = 512

# Extracted bytes handed to Spark in one Arrow batch.
_BATCH_BYTES = 4 * 1024 * 1024


def content_hashes(entries: DataFrame, content: str = "content") -> DataFrame:
    """Add hex digests ``md5`` and ``sha1`` of content that is in the row."""
    return entries.withColumns({"md5": F.md5(content), "sha1": F.sha1(content)})


def keep_inline(entries: DataFrame, content: str = "content") -> DataFrame:
    """Keep content of at most 1 MiB in the row; larger files stay where their extents are."""
    small = F.col("size") <= INLINE_BYTES
    return entries.withColumns(
        {content: F.when(small, F.col(content)), "storage": F.when(small, F.lit("inline")).otherwise(F.lit("extents"))}
    )


def file_hash_rows(entries: DataFrame, run_ts) -> DataFrame:
    """Two rows per file, md5 and sha1, with one time stamp for the whole run."""
    kinds = F.array(
        *[F.struct(F.lit(k).alias("hash_type"), F.col(k).alias("hash")) for k in ("md5", "sha1")]
    )
    return (
        entries.select("image_id", "entry_id", F.inline(kinds))
        .where("hash is not null")
        .select("hash_type", "hash", "image_id", "entry_id", F.lit(run_ts).cast("timestamp").alias("ts"))
    )


def verify_md5(entries: DataFrame, content: str = "content") -> DataFrame:
    """Stored against recomputed digest; ``matches`` is false also when only one of them exists.

    Content that is not in the row is read by its extents, in pieces.
    """
    away = is_away(entries, content)
    stored = ["entry_id", full_path().alias("full_path"), F.col("md5").alias("stored")]
    digests = entries.where(~away).select(*stored, F.md5(content).alias("computed"))
    if len(placed(entries)) == len(PLACE):
        columns = ["entry_id", "full_path", "stored", "computed"]
        far = entries.select(*stored, content, *PLACE)
        digests = digests.unionByName(map_away(far, lambda row, pieces: [*(row[c] for c in columns[:3]), _md5_of(pieces)], columns, digests.schema, content))
    return digests.withColumn("matches", F.col("computed").eqNullSafe(F.col("stored")))


def stored_hashes(entries: DataFrame, kind: str) -> DataFrame:
    """Full path and stored digest, for entries that have one."""
    return entries.where(F.length(kind) > 0).select(full_path().alias("full_path"), F.col(kind))


def calculated_md5s(entries: DataFrame, content: str = "content") -> DataFrame:
    """Full path and digest computed from content, in the row or in the image, for files that are not empty."""
    digests = entries.where((F.col("size") > 0) & F.col(content).isNotNull()).select(
        full_path().alias("full_path"), F.md5(content).alias("md5")
    )
    if len(placed(entries)) < len(PLACE):
        return digests
    far = entries.select(full_path().alias("full_path"), content, *PLACE)
    return digests.unionByName(map_away(far, lambda row, pieces: [row["full_path"], _md5_of(pieces)], digests.columns, digests.schema, content))


def extents_of(entries: DataFrame) -> DataFrame:
    """Extents frame of the entries that have byte extents; entries without stay in the entries table."""
    return entries.where(F.size("extents") > 0).select(
        "image",
        F.get("extents", F.lit(0))["addr"].alias("first_addr"),
        F.col("entry_id").alias("id"),
        full_path().alias("fp"),
        "size",
        "extents",
    )


EXTRACTED = (
    "image string, id string, fp string, size bigint, n_extents int, bytes_read bigint, "
    "problem boolean, md5 string, sha1 string, content binary"
)


def _read_extents(image, extents, size: int) -> Iterator[bytes]:
    """Bytes of the extents in order, at most ``size``; an extent that lies outside of the image ends it."""
    left = size if size is not None and size == size else 0
    end = image.size()
    for extent in extents:
        at, length = extent["addr"], extent["len"]
        if at is None or length is None or at < 0 or length < 0:
            return
        todo = min(length, left)
        while todo > 0:
            if at >= end:
                return
            data = image.read_at(min(todo, READ_BYTES, end - at), at)
            if not data:
                return
            yield data
            at += len(data)
            todo -= len(data)
            left -= len(data)


def _extract_one(image, row) -> tuple:
    md5, sha1 = hashlib.md5(), hashlib.sha1()
    inline = row.size <= INLINE_BYTES
    kept, n = [], 0
    for data in _read_extents(image, row.extents, row.size):
        md5.update(data)
        sha1.update(data)
        n += len(data)
        if inline:
            kept.append(data)
    return (
        row.image, row.id, row.fp, row.size, len(row.extents), n, n != row.size,
        md5.hexdigest(), sha1.hexdigest(), b"".join(kept) if inline else None,
    )


def extract_content(extents: DataFrame) -> DataFrame:
    """Read files from raw images by their extents; both digests come from the same pass.

    Files are range-partitioned by image and first address, so a task reads one stretch of an image
    and opens it once. Content above 1 MiB is digested in pieces and not kept. ``problem`` marks
    files of which fewer bytes than ``size`` could be read.
    """
    columns = [c.split()[0] for c in EXTRACTED.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uri, image = None, None
        out, held = [], 0
        try:
            for frame in frames:
                for row in frame.itertuples(index=False):
                    if row.image != uri:
                        if image is not None:
                            image.close()
                        uri, image = row.image, open_image(row.image)
                    out.append(_extract_one(image, row))
                    held += len(out[-1][-1] or b"") + 200
                    if held > _BATCH_BYTES:
                        yield pd.DataFrame(out, columns=columns)
                        out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=columns)
        finally:
            if image is not None:
                image.close()

    small_batches(extents)
    n = tasks_for(extents.sparkSession, extents.agg(F.sum("size")).first()[0])
    placed = extents.select("image", "first_addr", "id", "fp", "size", "extents")
    placed = placed.repartitionByRange(n, "image", "first_addr").sortWithinPartitions("image", "first_addr")
    return placed.mapInPandas(run, EXTRACTED)


PLACE = ("size", "extents", "image_uri")


def placed(entries: DataFrame) -> list[str]:
    """Columns of ``entries`` that say where content lies, as far as it has them."""
    return [c for c in PLACE if c in entries.columns]


def is_away(entries: DataFrame, content: str = "content") -> Column:
    """Content that is not in the row but in the image, by its extents; false for tables without these columns."""
    if len(placed(entries)) < len(PLACE):
        return F.lit(False)
    return F.coalesce(F.col(content).isNull() & (F.size("extents") > 0) & (F.col("size") > 0) & F.col("image_uri").isNotNull(), F.lit(False))


def map_away(entries: DataFrame, make: Callable[[dict, Iterator[bytes]], list], columns: list[str], schema, content: str = "content") -> DataFrame:
    """Rows ``make(row, pieces)`` of the entries whose content is away; ``pieces`` are its bytes in order.

    Files are read in address order by tasks of about ``TASK_BYTES``, and batches are bounded by bytes, so a task holds what ``make`` keeps of one file.
    Narrow the columns before: what is in the row passes through Python.
    """
    far = entries.where(is_away(entries, content)).withColumn("_addr", F.get("extents", F.lit(0))["addr"])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        uri, image, out, held = None, None, [], 0
        try:
            for frame in frames:
                for row in frame.to_dict("records"):
                    if row["image_uri"] != uri:
                        if image is not None:
                            image.close()
                        uri, image = row["image_uri"], open_image(row["image_uri"])
                    out.append(make(row, _read_extents(image, row["extents"], row["size"])))
                    held += sum(len(x) for x in out[-1] if isinstance(x, (bytes, str)))
                    if held > _BATCH_BYTES:
                        yield pd.DataFrame(out, columns=columns)
                        out, held = [], 0
            if out:
                yield pd.DataFrame(out, columns=columns)
        finally:
            if image is not None:
                image.close()

    small_batches(entries)
    n = tasks_for(entries.sparkSession, far.agg(F.sum("size")).first()[0])
    return far.repartitionByRange(n, "image_uri", "_addr").sortWithinPartitions("image_uri", "_addr").mapInPandas(run, schema)


def load_content(entries: DataFrame, content: str = "content") -> DataFrame:
    """``entries`` with all content in the row; its columns ``extents`` and ``image_uri`` are used up.

    Content that ``keep_inline`` left in the image is read by its extents (``map_away``). A file is one row, since a match of a pattern may lie
    anywhere in it.
    """
    if len(placed(entries)) < len(PLACE):
        return entries
    kept = [c for c in entries.columns if c not in ("extents", "image_uri")]

    def whole(row: dict, pieces: Iterator[bytes]) -> list:
        data = b"".join(pieces)
        return [data if c == content else row[c] for c in kept]

    read = map_away(entries, whole, kept, entries.select(*kept).schema, content)
    return entries.where(~is_away(entries, content)).select(*kept).unionByName(read)


def _md5_of(pieces: Iterator[bytes]) -> str:
    digest = hashlib.md5()
    for data in pieces:
        digest.update(data)
    return digest.hexdigest()


def extract_stats(extracted: DataFrame) -> DataFrame:
    """Counters of an extraction run."""
    return extracted.agg(
        F.count_if(F.col("size") <= INLINE_BYTES).alias("small"),
        F.count_if(F.col("size") > INLINE_BYTES).alias("big"),
        F.count_if(F.col("n_extents") > 1).alias("fragmented"),
        F.count_if("problem").alias("problems"),
        F.coalesce(F.sum("bytes_read"), F.lit(0)).alias("bytes"),
    )


def block_hashes(images: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``image, offset, md5`` of every block of every image; the last block may be short."""
    piece = max(block_bytes, 4 * 1024 * 1024 // block_bytes * block_bytes)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                with open_image(row.image) as image:
                    stop = row.start + row.length
                    for at in range(row.start, stop, piece):
                        data = image.read_at(min(piece, stop - at), at)
                        starts = range(0, len(data), block_bytes)
                        yield pd.DataFrame(
                            {
                                "image": row.image,
                                "offset": [at + s for s in starts],
                                "md5": [hashlib.md5(data[s : s + block_bytes]).hexdigest() for s in starts],
                            }
                        )

    range_bytes = READ_BYTES // block_bytes * block_bytes or block_bytes
    ranges = image_ranges(images, range_bytes)
    ranges = ranges.repartition(tasks_for(images.sparkSession, ranges.agg(F.sum("length")).first()[0]), "image", "start")
    return ranges.mapInPandas(run, "image string, offset bigint, md5 string")


def content_block_hashes(entries: DataFrame, content: str = "content", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Block hashes of content in rows. Digests are made inside the row, so content is not repeated per block."""
    size = F.octet_length(content)
    last = F.floor((size - 1) / block_bytes).cast("int")
    digests = F.transform(
        F.sequence(F.lit(0), last),
        lambda b: F.md5(F.substring(F.col(content), b * block_bytes + 1, F.lit(block_bytes))),
    )
    hashed = entries.where(size > 0).select("entry_id", digests.alias("_d"))
    return hashed.select("entry_id", F.posexplode("_d").alias("_b", "md5")).select(
        "entry_id", (F.col("_b").cast("bigint") * block_bytes).alias("offset"), "md5"
    )


def image_digest(images: DataFrame) -> DataFrame:
    """md5 of each image file, read in pieces. A digest is sequential, so one file is one task's work."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for row in frame.itertuples(index=False):
                digest = hashlib.md5()
                with open_image(row.image) as image:
                    for at in range(0, row.length, READ_BYTES):
                        digest.update(image.read_at(min(READ_BYTES, row.length - at), at))
                yield pd.DataFrame({"image": [row.image], "length": [row.length], "md5": [digest.hexdigest()]})

    n = tasks_for(images.sparkSession, images.agg(F.sum("length")).first()[0])
    return images.select("image", "length").repartition(n, "image").mapInPandas(
        run, "image string, length bigint, md5 string"
    )

"""Entries: parsing, keys, names, attributes, scans, export, registry and upsert."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import inventory, merge
from ..session import scratch_path
from ..sources import parse_entry_lines, read_entries, scan_entries
from . import views as v


def _json_lines(spark, sf) -> DataFrame:
    """Documents as entry lines; some lines are broken in the ways the parser has to notice."""
    kind = F.pmod("doc_id", F.lit(11))
    meta = F.struct(
        F.octet_length("text").alias("size"),
        (F.col("doc_id") * 1000 - 5000).alias("crtime"),
        (F.col("doc_id") * 86400).alias("mtime"),
        F.lit(5).alias("flags"),
        F.lit(519).alias("gid"),
    )
    fs = F.struct(F.lit(987).alias("byteOffset"), F.col("fs_id").alias("fsID"), F.lit(512).alias("blockSize"))
    name = F.struct("name", F.col("dir_index").alias("dirIndex"), F.lit(3).alias("flags"), F.col("name_type").alias("type"))
    good = F.to_json(F.struct("path", name.alias("name"), fs.alias("fs"), meta.alias("meta")))
    line = (
        F.when(kind == 0, F.to_json(F.struct(F.col("doc_id").alias("path"), name.alias("name"))))
        .when(kind == 1, F.to_json(F.struct("path", "name")))
        .when(kind == 2, F.to_json(F.struct("path", name.alias("name"), F.struct(F.lit(2).alias("flags")).alias("meta"))))
        .when(kind == 3, F.substring(good, F.lit(1), F.length(good) - 5))
        .when(kind == 4, F.to_json(F.struct("path", name.alias("name"))))
        .otherwise(good)
    )
    return v.entries(spark, sf, heavy=True).select(line.alias("value"))


def _show(e: DataFrame) -> DataFrame:
    none = F.lit(-1)
    return e.select(
        "path",
        "name",
        "dir_index",
        "name_type",
        F.coalesce("fs_byte_offset", none).alias("fs_byte_offset"),
        F.coalesce("fs_id", F.lit("")).alias("fs_id"),
        "size",
        F.coalesce("gid", none).alias("gid"),
        F.coalesce(F.unix_seconds("created"), none).alias("created"),
        F.coalesce(F.unix_seconds("written"), none).alias("written"),
        "has_meta",
    )


def read_entries_query(spark, sf):
    """JSON lines written by Spark, read back as files."""
    path = scratch_path(spark, "entry-lines")
    _json_lines(spark, sf).write.text(path)
    return _show(read_entries(spark, path).good)


def read_entries_rejects(spark, sf):
    rejects = parse_entry_lines(_json_lines(spark, sf)).rejects
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


def entry_keys(spark, sf):
    e = v.entries(spark, sf)
    return e.select(
        "entry_id",
        F.lower(F.hex(fn.entry_key_image(F.unhex("entry_id")))).alias("image_id"),
        fn.entry_text_id().alias("text_id"),
    )


def hash_keys(spark, sf):
    """Long hash keys of both types, built and taken apart again."""
    e = v.hashed_entries(spark, sf)

    def parts(kind: str) -> Column:
        key = fn.hash_key(F.unhex(kind), kind, F.unhex("entry_id"))
        return F.struct(
            F.lower(F.hex(key)).alias("key"),
            fn.hash_key_length(key).cast("bigint").alias("hash_length"),
            F.lower(F.hex(fn.hash_key_hash(key))).alias("hash"),
            F.lower(F.hex(fn.hash_key_entry_id(key))).alias("entry_id"),
            F.lower(F.hex(fn.hash_key_image(key))).alias("image_id"),
            fn.is_long_hash_key(key).alias("is_long"),
        )

    return e.select(F.inline(F.array(parts("md5"), parts("sha1"))))


def hash_fanout(spark, sf):
    return v.documents(spark, sf).select("doc_id", fn.hash_fanout(F.md5("text")).alias("folder"))


def _attributed(spark, sf) -> DataFrame:
    """Entries with a resident attribute (odd ids) or data runs, after one that does not qualify."""

    def attr(flags, type_, name, rd_buf, runs):
        return F.struct(
            F.lit(flags).cast("bigint").alias("flags"),
            F.lit(type_).cast("bigint").alias("type"),
            F.lit(name).alias("name"),
            rd_buf.alias("rd_buf"),
            runs.alias("nrd_runs"),
        )

    def run(addr, offset, length):
        return F.struct(
            F.lit(1).cast("bigint").alias("flags"),
            addr.cast("bigint").alias("addr"),
            offset.cast("bigint").alias("offset"),
            length.cast("bigint").alias("len"),
        )

    no_runs = F.array().cast("array<struct<flags:bigint,addr:bigint,offset:bigint,len:bigint>>")
    n = F.ceil(F.col("size") / 512)
    runs = F.array(run(F.col("doc_id") * 7, F.lit(0), n), run(F.col("doc_id") * 7 + 100000, n, F.lit(1)))
    e = v.entries(spark, sf)
    attrs = F.array(
        attr(4, 48, "$Name", F.lit("00"), no_runs),
        attr(5, 128, "$Data", F.when(F.col("doc_id") % 2 == 1, F.hex("content")).otherwise(F.lit("")), no_runs),
        attr(3, 128, "$Data", F.lit(""), F.when(F.col("doc_id") % 2 == 0, runs).otherwise(no_runs)),
    )
    return e.withColumns(
        {"attrs": attrs, "fs_byte_offset": F.lit(32256).cast("bigint"), "fs_block_size": F.lit(512).cast("bigint")}
    )


def resident_content(spark, sf):
    e = _attributed(spark, sf).select("entry_id", fn.resident_content("attrs").alias("c"))
    return e.where("c is not null").select("entry_id", F.octet_length("c").cast("bigint").alias("n"), F.md5("c").alias("md5"))


def byte_extents(spark, sf):
    e = _attributed(spark, sf).select("entry_id", fn.byte_extents().alias("x"))
    return e.select("entry_id", F.posexplode("x").alias("pos", "x")).select(
        "entry_id", F.col("pos").cast("bigint").alias("pos"), "x.flags", "x.addr", "x.offset", "x.len"
    )


def _listing(e: DataFrame) -> DataFrame:
    return e.select("entry_id", fn.full_path().alias("full_path"), "size")


def export_by_ext(spark, sf):
    out = inventory.export_by_ext(v.hashed_entries(spark, sf), ["HTML", "jpg"])
    return out.withColumns({"data": F.md5("data"), "n": F.octet_length("data").cast("bigint")})


def register_images(spark, sf):
    """Images of the documents against a registry that already has those of labelled toxic ones."""
    registry = (
        v.table(spark, sf, "documents").select("doc_id", "source")
        .join(v.table(spark, sf, "labels").where("toxic = 1"), "doc_id", "left_semi")
        .where("source < 'src15'")
        .select(F.md5("source").alias("image_id")).distinct()
    )
    accepted, rejected = merge.register_images(registry, v.image_names(spark, sf))
    return accepted.select("image_id", F.lit("accepted").alias("status")).unionByName(
        rejected.select("image_id", F.lit("rejected").alias("status"))
    )


def upsert_entries(spark, sf):
    """Label columns written into entries: new values win, absent ones keep what was there."""
    base = v.entries(spark, sf).select("entry_id", "name", "size", F.lit("unknown").alias("grade"))
    labels = v.table(spark, sf, "labels")
    ids = v.entries(spark, sf).select("doc_id", "entry_id")
    changes = ids.join(labels, "doc_id").select(
        "entry_id",
        F.when(F.col("quality") == 1, "good").alias("grade"),
        F.when(F.col("toxic") == 1, F.lit(0).cast("bigint")).alias("size"),
    )
    return merge.upsert_entries(base, changes)


QUERIES = {
    "read_entries": read_entries_query,
    "read_entries_rejects": read_entries_rejects,
    "entry_keys": entry_keys,
    "entry_extension": lambda s, d: v.entries(s, d).select("name", fn.extension().alias("ext")),
    "entry_full_path": lambda s, d: v.entries(s, d).select("doc_id", fn.full_path().alias("full_path")),
    "hash_keys": hash_keys,
    "hash_fanout": hash_fanout,
    "resident_content": resident_content,
    "byte_extents": byte_extents,
    "scan_entries": lambda s, d: _listing(scan_entries(v.entries(s, d), v.REFERENCE_IMAGE)),
    "regular_files": lambda s, d: _listing(inventory.regular_files(v.entries(s, d))),
    "export_by_ext": export_by_ext,
    "register_images": register_images,
    "upsert_entries": upsert_entries,
}

_E = f"WITH {v.ENTRIES_SQL} "

ORACLES = {
    "read_entries": _E
    + """SELECT path, name, dir_index, name_type,
      CASE WHEN doc_id % 11 = 4 THEN -1 ELSE 987 END AS fs_byte_offset,
      CASE WHEN doc_id % 11 = 4 THEN '' ELSE fs_id END AS fs_id,
      CASE WHEN doc_id % 11 = 4 THEN 0 ELSE size END AS size,
      CASE WHEN doc_id % 11 = 4 THEN -1 ELSE 519 END AS gid,
      CASE WHEN doc_id % 11 = 4 OR doc_id * 1000 - 5000 <= 0 THEN -1 ELSE doc_id * 1000 - 5000 END AS created,
      CASE WHEN doc_id % 11 = 4 OR doc_id <= 0 OR doc_id * 86400 > 9223372036854 THEN -1 ELSE doc_id * 86400 END AS written,
      doc_id % 11 <> 4 AS has_meta
    FROM e WHERE doc_id % 11 >= 4""",
    "read_entries_rejects": """SELECT CASE doc_id % 11 WHEN 0 THEN 'path is not a string' WHEN 1 THEN 'name is not an object'
      WHEN 2 THEN 'meta.size is not a number' ELSE 'not a JSON object' END AS reason, count(*) AS n
      FROM documents WHERE doc_id % 11 < 4 GROUP BY 1""",
    "entry_keys": _E + "SELECT entry_id, image_id, path || name || '-' || dir_index AS text_id FROM e",
    "entry_extension": _E + "SELECT name, ext FROM e",
    "entry_full_path": _E + "SELECT doc_id, full_path FROM e",
    "hash_keys": _E
    + """SELECT md5 || '0000000000' || entry_id AS key, 16 AS hash_length, md5 AS hash, entry_id, image_id, true AS is_long FROM e
      UNION ALL SELECT sha1 || '01' || entry_id, 20, sha1, entry_id, image_id, true FROM e""",
    "hash_fanout": "SELECT doc_id, substr(md5(text), 1, 2) || '/' || substr(md5(text), 3, 2) AS folder FROM documents",
    "resident_content": _E + "SELECT entry_id, size AS n, md5 FROM e WHERE doc_id % 2 = 1 AND size > 0",
    "byte_extents": _E
    + """SELECT entry_id, 0 AS pos, 1 AS flags, doc_id * 7 * 512 + 32256 AS addr, 0 AS "offset",
      CAST(ceil(size / 512.0) AS BIGINT) * 512 AS len FROM e WHERE doc_id % 2 = 0
      UNION ALL SELECT entry_id, 1, 1, (doc_id * 7 + 100000) * 512 + 32256, CAST(ceil(size / 512.0) AS BIGINT) * 512, 512
      FROM e WHERE doc_id % 2 = 0""",
    "scan_entries": _E + f"SELECT entry_id, full_path, size FROM e WHERE image_id = '{v.REFERENCE_IMAGE}'",
    "regular_files": _E + "SELECT entry_id, full_path, size FROM e WHERE name_type = 5 AND size >= 0",
    "export_by_ext": _E
    + """SELECT entry_id, full_path, ext AS extension, sha1, md5, md5 AS data, '' AS hdfs_path, size AS n
      FROM e WHERE ext IN ('html', 'jpg')""",
    "register_images": """WITH known AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id)
      WHERE toxic = 1 AND source < 'src15')
      SELECT DISTINCT md5(source) AS image_id,
        CASE WHEN source IN (SELECT source FROM known) THEN 'rejected' ELSE 'accepted' END AS status FROM documents""",
    "upsert_entries": _E
    + """SELECT entry_id, name, CASE WHEN toxic = 1 THEN 0 ELSE size END AS size,
      CASE WHEN quality = 1 THEN 'good' ELSE 'unknown' END AS grade FROM e LEFT JOIN labels USING (doc_id)""",
}

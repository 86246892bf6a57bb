"""The given tables seen as evidence: entries, images, hash sets. Each view exists in Spark and in SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import entry_key, extension, positive_timestamp
from ..session import ship_package, spread

INDEX_RANGE = 2**31
ENDINGS = [".txt", ".html", ".tar.gz", "", ".Html", ".", ".jpg"]

REFERENCE_SOURCE = "src0"
REFERENCE_IMAGE = hashlib.md5(REFERENCE_SOURCE.encode()).hexdigest()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """``doc_id, text, lang, source``; ``heavy`` spreads the rows for work that is slow per row."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return spread(docs, "doc_id") if heavy else docs


def entries(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    """One entry per document. Columns that a query does not use are never read."""
    docs = documents(spark, sf_dir, heavy)
    ending = F.get(F.array(*[F.lit(e) for e in ENDINGS]), F.pmod(F.col("doc_id"), F.lit(len(ENDINGS))).cast("int"))
    # The directory index is 32 bits wide: beyond that, documents go to numbered sub-folders.
    folder = F.when(F.col("doc_id") >= INDEX_RANGE, F.concat(F.lit("/"), F.floor(F.col("doc_id") / INDEX_RANGE).cast("string")))
    named = docs.select(
        "doc_id",
        "text",
        "lang",
        "source",
        F.concat(F.lit("/"), "source", F.lit("/"), "lang", F.coalesce(folder, F.lit(""))).alias("path"),
        F.concat(F.lit("doc"), F.col("doc_id").cast("string"), ending).alias("name"),
        F.pmod(F.col("doc_id"), F.lit(INDEX_RANGE)).alias("dir_index"),
    )
    key = entry_key(F.unhex(F.md5("source")), "path", "dir_index")
    return named.select(
        F.lower(F.hex(key)).alias("entry_id"),
        F.md5("source").alias("image_id"),
        "doc_id",
        "path",
        "name",
        "dir_index",
        F.when(extension("name") == "", 3).otherwise(5).cast("bigint").alias("name_type"),
        F.octet_length("text").cast("bigint").alias("size"),
        F.col("lang").alias("fs_id"),
        F.col("text"),
        F.col("text").cast("binary").alias("content"),
        F.lit(None).cast("string").alias("content_path"),
    )


ENTRIES_SQL = """e0 AS (
  SELECT doc_id, text, lang, source,
         '/' || source || '/' || lang
           || CASE WHEN doc_id >= 2147483648 THEN '/' || (doc_id // 2147483648) ELSE '' END AS path,
         'doc' || doc_id || CASE doc_id % 7 WHEN 0 THEN '.txt' WHEN 1 THEN '.html' WHEN 2 THEN '.tar.gz'
           WHEN 3 THEN '' WHEN 4 THEN '.Html' WHEN 5 THEN '.' ELSE '.jpg' END AS name,
         doc_id % 2147483648 AS dir_index
  FROM documents),
e AS (
  SELECT substr(md5(path), 1, 2) || md5(source) || substr(md5(path), 3) || printf('%08x', dir_index) AS entry_id,
         md5(source) AS image_id, doc_id, path, name, dir_index, path || '/' || name AS full_path,
         CASE doc_id % 7 WHEN 0 THEN 'txt' WHEN 1 THEN 'html' WHEN 2 THEN 'gz' WHEN 4 THEN 'html'
           WHEN 6 THEN 'jpg' ELSE '' END AS ext,
         CASE WHEN doc_id % 7 IN (3, 5) THEN 3 ELSE 5 END AS name_type,
         octet_length(encode(text)) AS size, lang AS fs_id, text, source, md5(text) AS md5, sha1(text) AS sha1
  FROM e0)"""


def hashed_entries(spark: SparkSession, sf_dir: str, heavy: bool = False) -> DataFrame:
    e = entries(spark, sf_dir, heavy)
    return e.withColumns({"md5": F.md5("content"), "sha1": F.sha1("content")})


def images(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One image per source; its capacity is the content plus a third, in whole MiB."""
    total = F.sum(F.octet_length("text").cast("bigint"))
    mib = 1024 * 1024
    number = F.regexp_extract("source", r"(\d+)\z", 1).cast("int")
    return (
        documents(spark, sf_dir)
        .groupBy("source")
        .agg(((F.floor(total * 4 / (3 * mib)) + 1) * mib).alias("size"))
        .select(
            F.md5("source").alias("image_id"),
            F.col("source").alias("friendly_name"),
            "size",
            F.dateadd(F.lit("2024-01-01").cast("date"), number).cast("timestamp").alias("loaded_on"),
        )
    )


IMAGES_SQL = """images AS (
  SELECT md5(source) AS image_id, source AS friendly_name,
         CAST((floor(sum(octet_length(encode(text))) * 4 / (3 * 1048576)) + 1) * 1048576 AS BIGINT) AS size,
         strftime(DATE '2024-01-01' + CAST(regexp_extract(source, '(\\d+)$', 1) AS INTEGER), '%Y-%m-%d 00:00:00') AS loaded_on
  FROM documents GROUP BY source)"""


def image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids and names only; reads one small column."""
    return (
        table(spark, sf_dir, "documents").select("source").distinct()
        .select(F.md5("source").alias("image_id"), F.col("source").alias("friendly_name"))
    )


def file_hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """md5 rows of the files, as a stored ``file_hashes`` table would give them."""
    return documents(spark, sf_dir).select(
        F.lit("md5").alias("hash_type"), F.md5("text").alias("hash"), F.md5("source").alias("image_id")
    )


def labelled_hashes(spark: SparkSession, sf_dir: str, condition: str) -> DataFrame:
    """Hash set of the documents whose label meets a condition: rows ``hash_type, hash``."""
    wanted = table(spark, sf_dir, "labels").where(condition).select("doc_id")
    docs = documents(spark, sf_dir).select("doc_id", "text").join(wanted, "doc_id", "left_semi")
    kinds = F.array(
        F.struct(F.lit("md5").alias("hash_type"), F.md5("text").alias("hash")),
        F.struct(F.lit("sha1").alias("hash_type"), F.sha1("text").alias("hash")),
    )
    return docs.select(F.inline(kinds))


# ---- reference hash set from the star schema ----


def _identity() -> Column:
    return F.concat_ws("|", F.col("l_suppkey").cast("string"), F.col("l_linenumber").cast("string"), F.col("l_quantity").cast("bigint").cast("string"))


def line_items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Keys and some columns of the line items, dealt to tasks of bounded size."""
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *columns)
    return spread(rows, "l_orderkey", "l_linenumber")


def ref_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listed files, one per line item. Equal identities give equal digests."""
    i = _identity()
    return line_items(spark, sf_dir, "l_partkey", "l_suppkey", "l_quantity").select(
        F.unhex(F.sha1(i.cast("binary"))).alias("sha1"),
        F.unhex(F.md5(i.cast("binary"))).alias("md5"),
        F.unhex(F.substring(F.md5(F.concat(i, F.lit("c")).cast("binary")), 1, 8)).alias("crc32"),
        F.concat(F.lit("file"), F.col("l_orderkey").cast("string")).alias("name"),
        (F.col("l_quantity").cast("bigint") * 1024).alias("size"),
        F.col("l_partkey").cast("int").alias("prod_code"),
        F.pmod("l_suppkey", F.lit(25)).cast("string").alias("os_code"),
        F.lit("").alias("special_code"),
    )


def ref_mfgs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("code"), F.col("s_name").alias("name"))


def ref_oses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"),
        F.col("n_name").alias("name"),
        F.lit("1.0").alias("version"),
        F.col("n_regionkey").cast("string").alias("mfg_code"),
    )


def ref_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One to three versions of each part; the brand number is the manufacturer."""
    versions = F.sequence(F.lit(1), F.pmod("p_size", F.lit(3)) + 1)
    return (
        table(spark, sf_dir, "part")
        .select("*", F.explode(versions).alias("v"))
        .select(
            F.col("p_partkey").cast("int").alias("code"),
            F.col("p_name").alias("name"),
            F.concat(F.col("v").cast("string"), F.lit(".0")).alias("version"),
            F.pmod("p_size", F.lit(25)).cast("string").alias("os_code"),
            F.regexp_extract("p_brand", r"(\d+)", 1).alias("mfg_code"),
            F.lit("en").alias("language"),
            F.col("p_type").alias("app_type"),
        )
    )


REF_SQL = """files AS (
  SELECT sha1(i) AS sha1, md5(i) AS md5, substr(md5(i || 'c'), 1, 8) AS crc32, name, size, prod_code, os_code
  FROM (SELECT l_suppkey || '|' || l_linenumber || '|' || CAST(l_quantity AS BIGINT) AS i,
               'file' || l_orderkey AS name, CAST(l_quantity AS BIGINT) * 1024 AS size,
               l_partkey AS prod_code, CAST(l_suppkey % 25 AS VARCHAR) AS os_code FROM lineitem)),
mfgs AS (SELECT CAST(s_suppkey AS VARCHAR) AS code, s_name AS name FROM supplier),
oses AS (SELECT CAST(n_nationkey AS VARCHAR) AS code, n_name AS name, '1.0' AS version,
                CAST(n_regionkey AS VARCHAR) AS mfg_code FROM nation),
prods AS (
  SELECT p_partkey AS code, p_name AS name, v || '.0' AS version, CAST(p_size % 25 AS VARCHAR) AS os_code,
         regexp_extract(p_brand, '(\\d+)', 1) AS mfg_code, 'en' AS language, p_type AS app_type
  FROM (SELECT *, unnest(range(1, CAST(p_size % 3 + 2 AS BIGINT))) AS v FROM part)),
labels_ AS (
  SELECT p.code AS prod_code, m.name || '/' || p.name || ' ' || p.version AS set_label
  FROM prods p JOIN mfgs m ON m.code = p.mfg_code)"""


# ---- entries with time stamps ----


def _epoch(column: str) -> Column:
    return F.expr(f"timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {column})")


def dated_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One entry per line item with up to four time stamps."""
    ship = _epoch("l_shipdate")
    day = 86400
    return line_items(spark, sf_dir, "l_shipdate", "l_returnflag", "l_linestatus").select(
        F.concat(F.lit("/orders/"), F.col("l_orderkey").cast("string")).alias("path"),
        F.concat(F.lit("item"), F.col("l_linenumber").cast("string"), F.lit(".dat")).alias("name"),
        positive_timestamp(ship).alias("created"),
        positive_timestamp(F.when(F.col("l_returnflag") == "R", ship + F.col("l_linenumber") * day).otherwise(0)).alias("accessed"),
        positive_timestamp(F.when(F.col("l_linestatus") == "F", ship - day)).alias("written"),
        positive_timestamp(F.when(F.col("l_returnflag") == "A", ship + 60).otherwise(-ship)).alias("updated"),
    )


DATED_SQL = """d AS (
  SELECT '/orders/' || l_orderkey || '/item' || l_linenumber || '.dat' AS fp, CAST(epoch(l_shipdate) AS BIGINT) AS ship,
         l_returnflag, l_linestatus, l_linenumber FROM lineitem),
stamps AS (
  SELECT ship AS epoch, 'created: ' || fp AS label FROM d
  UNION ALL SELECT ship + l_linenumber * 86400, 'accessed: ' || fp FROM d WHERE l_returnflag = 'R'
  UNION ALL SELECT ship - 86400, 'written: ' || fp FROM d WHERE l_linestatus = 'F'
  UNION ALL SELECT ship + 60, 'updated: ' || fp FROM d WHERE l_returnflag = 'A')"""

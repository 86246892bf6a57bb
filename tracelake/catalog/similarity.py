"""Similarity of images."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import similarity as op
from . import views as v


def shared_hashes(spark, sf):
    rows = op.shared_hashes(v.file_hashes(spark, sf), v.REFERENCE_IMAGE)
    return rows.select("hash", F.array_join("images", ",").alias("images"), "n_images")


def scores(spark, sf):
    return op.iif_scores(v.file_hashes(spark, sf), v.image_names(spark, sf), v.REFERENCE_IMAGE)


def iif_scores(spark, sf):
    return scores(spark, sf).withColumns({"c": F.round("c", 6), "iif": F.round("iif", 6)})


def similarity_scores(spark, sf):
    """Report rows: scores with the device name."""
    names = v.image_names(spark, sf).select(F.col("image_id").alias("id"), F.col("friendly_name").alias("a"))
    return iif_scores(spark, sf).join(names, "id", "left").select("a", "id", "c", "iif")


def device_links(spark, sf):
    links = op.device_links(scores(spark, sf), v.image_names(spark, sf), v.REFERENCE_IMAGE)
    return links.withColumn("weight", F.round("weight", 6))


QUERIES = {
    "shared_hashes": shared_hashes,
    "iif_scores": iif_scores,
    "similarity_scores": similarity_scores,
    "device_links": device_links,
}

_S = f"""WITH pairs AS (SELECT DISTINCT md5(text) AS hash, md5(source) AS image_id, source FROM documents),
  sh AS (SELECT * FROM pairs WHERE hash IN (SELECT hash FROM pairs WHERE image_id = '{v.REFERENCE_IMAGE}')),
  k AS (SELECT hash, count(*) AS k FROM sh GROUP BY hash),
  n AS (SELECT count(DISTINCT source) AS n, count(*) FILTER (WHERE source = '{v.REFERENCE_SOURCE}') AS files FROM documents),
  s AS (SELECT source AS a, image_id AS id, sum(ln(n / k)) AS iif, any_value(n) AS n, any_value(files) AS files
        FROM sh JOIN k USING (hash), n GROUP BY ALL) """
_SCORE = "round(iif / (ln(n) * files), 6) AS c, round(iif, 6) AS iif"

ORACLES = {
    "shared_hashes": _S + "SELECT hash, string_agg(image_id, ',' ORDER BY image_id) AS images, count(*) AS n_images FROM sh GROUP BY hash",
    "iif_scores": _S + f"SELECT id, {_SCORE}, id = '{v.REFERENCE_IMAGE}' AS is_self FROM s",
    "similarity_scores": _S + f"SELECT a, id, {_SCORE} FROM s",
    "device_links": _S
    + f""", o AS (SELECT *, count(*) OVER () AS n_links FROM s WHERE id <> '{v.REFERENCE_IMAGE}')
      SELECT '{v.REFERENCE_IMAGE}' AS source, id AS target, a AS target_name, 1 AS target_group,
        round(iif * CASE WHEN n_links < 5 THEN 4 ELSE 1 END, 6) AS weight FROM o""",
}

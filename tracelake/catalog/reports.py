"""Report datasets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import inventory
from ..plans import reports as op
from . import views as v


def csv_export(spark, sf):
    """Parts as CSV lines; a quote in the name shows the doubling."""
    rows = v.table(spark, sf, "part").select("p_partkey", F.concat("p_name", F.lit(' 5"')).alias("p_name"), "p_brand", "p_size")
    return op.csv_lines(rows)


def unregistered_entries(spark, sf):
    """A third of the images is taken from the registry first."""
    return op.unregistered_entries(v.entries(spark, sf), v.images(spark, sf).where(F.substring("image_id", 1, 1) >= "6"))


QUERIES = {
    "unregistered_entries": unregistered_entries,
    "device_info": lambda s, d: op.device_info(v.entries(s, d), v.images(s, d)),
    "volume_usage": lambda s, d: op.volume_usage(v.entries(s, d), v.images(s, d)),
    "report_total": lambda s, d: op.column_total(inventory.folder_count(v.entries(s, d))),
    "report_limit": lambda s, d: op.column_max(inventory.folder_count(v.entries(s, d))),
    "csv_export": csv_export,
}

_I = f"WITH {v.ENTRIES_SQL}, {v.IMAGES_SQL} "

ORACLES = {
    "device_info": _I
    + """, vol AS (SELECT image_id, fs_id, count(*) AS files, sum(size) AS n,
        sum(CASE WHEN name_type = 5 THEN size ELSE 0 END) AS alloc FROM e GROUP BY ALL),
      pi AS (SELECT image_id, sum(files) AS files,
        '[' || string_agg('{"a":"' || fs_id || '","n":' || n || ',"alloc":' || alloc || '}', ',' ORDER BY fs_id) || ']' AS vols
        FROM vol GROUP BY image_id)
      SELECT image_id, 'deviceName' AS a, friendly_name AS n FROM images
      UNION ALL SELECT image_id, 'md5', image_id FROM images
      UNION ALL SELECT image_id, 'loadedOn', loaded_on FROM images
      UNION ALL SELECT image_id, 'size', CAST(size AS VARCHAR) FROM images
      UNION ALL SELECT image_id, 'totalFiles', CAST(CAST(files AS BIGINT) AS VARCHAR) FROM pi
      UNION ALL SELECT image_id, 'volumeList', vols FROM pi""",
    "unregistered_entries": _I
    + """SELECT image_id, count(*) AS files, CAST(sum(size) AS BIGINT) AS size FROM e
      WHERE image_id NOT IN (SELECT image_id FROM images WHERE substr(image_id, 1, 1) >= '6') GROUP BY image_id""",
    "volume_usage": _I
    + """, u AS (SELECT image_id, CAST(sum(size) AS BIGINT) AS used FROM e GROUP BY image_id)
      SELECT image_id, size, used, greatest(size - used, 0) AS unused,
        CAST(floor(used * 100.0 / size + 0.5) AS BIGINT) AS percent FROM images JOIN u USING (image_id)""",
    "report_total": "SELECT count(*) AS total FROM documents",
    "report_limit": """SELECT CASE WHEN max(n) >= 100 THEN max(n) * 2 ELSE 100 END AS "limit"
      FROM (SELECT count(*) AS n FROM documents GROUP BY source, lang)""",
    "csv_export": 'SELECT concat(\'"\', p_partkey, \'","\', p_name, \' 5""","\', p_brand, \'","\', p_size, \'"\') AS value FROM part',
}

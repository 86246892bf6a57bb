"""Counts, sizes, listings, timeline."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import functions as fn
from ..operators import inventory as op
from . import views as v


def ext_size(spark, sf):
    return op.ext_size(v.entries(spark, sf)).withColumn("avg_size", F.round("avg_size", 4))


def random_per_key(spark, sf):
    e = v.entries(spark, sf).select("entry_id", fn.extension().alias("ext"), fn.full_path().alias("full_path"))
    return op.random_per_key(e, "ext", "full_path", "entry_id", seed=7)


def cookies(spark, sf):
    e = v.entries(spark, sf)
    return op.cookies(e.withColumn("path", F.concat("path", F.lit("/Cookies"))), "text")


def timeline_ctime(spark, sf):
    """Time line with readable times."""
    return op.timeline(v.dated_entries(spark, sf)).select(fn.ctime_text("epoch").alias("time"), "label")


QUERIES = {
    "folder_count": lambda s, d: op.folder_count(v.entries(s, d)),
    "dir_sizes": lambda s, d: op.dir_sizes(v.entries(s, d)),
    "ext_count": lambda s, d: op.ext_count(v.entries(s, d)),
    "ext_size": ext_size,
    "ext_paths": lambda s, d: op.ext_paths(v.entries(s, d)),
    "random_per_key": random_per_key,
    "timeline": lambda s, d: op.timeline(v.dated_entries(s, d)),
    "timeline_ctime": timeline_ctime,
    "cookies": cookies,
}

_E = f"WITH {v.ENTRIES_SQL} "


def _line(n: int) -> str:
    # blanks as in the operator; RE2's \\s has no vertical tab
    return rf"regexp_replace(l[{n}], '^[\s\x0B]+|[\s\x0B]+$', '', 'g')"


ORACLES = {
    "folder_count": _E + "SELECT path, count(*) AS n FROM e GROUP BY path",
    "dir_sizes": _E + "SELECT path, CAST(sum(size) AS BIGINT) AS total_size FROM e GROUP BY path",
    "ext_count": _E + "SELECT ext, count(*) AS n FROM e GROUP BY ext",
    "ext_size": _E + 'SELECT ext, CAST(sum(size) AS BIGINT) AS size, count(*) AS "count", round(avg(size), 4) AS avg_size FROM e GROUP BY ext',
    "ext_paths": _E + "SELECT ext, full_path FROM e",
    "random_per_key": _E + "SELECT ext, arg_min(full_path, (md5(entry_id || ':7'), entry_id)) AS full_path FROM e GROUP BY ext",
    "timeline": f"WITH {v.DATED_SQL} SELECT epoch, label FROM stamps",
    "timeline_ctime": f"WITH {v.DATED_SQL}"
    + """ SELECT strftime(make_timestamp(epoch * 1000000), '%a %b ')
      || lpad(CAST(day(make_timestamp(epoch * 1000000)) AS VARCHAR), 2, ' ')
      || strftime(make_timestamp(epoch * 1000000), ' %H:%M:%S %Y') AS time, label FROM stamps""",
    "cookies": _E
    + f""", c AS (SELECT entry_id, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS l FROM e
        WHERE ext = 'txt' AND length(text) > 0)
      SELECT entry_id, {_line(1)} AS name, {_line(2)} AS value, {_line(3)} AS domain, {_line(4)} AS flags
      FROM c WHERE len(l) >= 4""",
}

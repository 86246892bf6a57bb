"""User scripts and external commands, each next to SQL that gives the same result."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import full_path
from ..operators import scripting as op
from . import views as v


def largest_mapper(key, entry, context):
    """The file with its size, under its folder."""
    if entry.get("size", 0) > 0:
        context.emit(entry["path"], {"bytes": entry["size"], "name": entry["name"]})


def keep_largest(folder, files, context):
    """Of a folder's files the largest, the first by name of equals. Fit for its own output, so it also combines."""
    best = min(files, key=lambda f: (-f["bytes"], f["name"]), default=None)
    if best is not None:
        context.emit(folder, best)


def span_mapper(key, entry, context):
    """Seconds between the first and the last time stamp of an entry, under its id."""
    known = [entry[c] for c in ("created", "accessed", "written", "updated") if c in entry]
    if known:
        context.emit(max(known) - min(known), key)


def length_mapper(key, entry, context):
    """One count for each length of a file name."""
    context.emit(len(entry["name"]), 1)


def run_mapper(spark, sf):
    e = v.dated_entries(spark, sf)
    stamps = {c: F.unix_seconds(c) for c in ("created", "accessed", "written", "updated")}
    return op.run_mapper(e.withColumns({"entry_id": full_path(), **stamps}).select("entry_id", *stamps), span_mapper, "long", "text")


def nested_mapper(spark, sf):
    """Extents as a script sees them: a list of dicts, passed on as JSON."""
    run = F.struct(F.col("doc_id").alias("addr"), F.col("size").alias("len"))
    e = v.entries(spark, sf).select("entry_id", F.when(F.col("size") > 0, F.array(run, run)).alias("runs"))
    return op.run_mapper(e, lambda key, entry, context: context.emit(key, [[r["addr"], r["len"]] for r in entry.get("runs", [])]), "text", "json")


def run_reducer(spark, sf):
    pairs = op.run_mapper(v.entries(spark, sf), largest_mapper, "text", "json", columns=["path", "name", "size"])
    out = op.run_reducer(pairs, keep_largest, "text", "json", input_value_type="json", combinable=True)
    return out.select(
        F.col("key").alias("path"),
        F.get_json_object("value", "$.name").alias("name"),
        F.get_json_object("value", "$.bytes").cast("bigint").alias("size"),
    )


def run_long_sum(spark, sf):
    pairs = op.run_mapper(v.entries(spark, sf), length_mapper, "long", "long", columns=["name"])
    return op.run_reducer(pairs, "LongSumReducer")


def run_command(spark, sf):
    return op.run_command(v.entries(spark, sf, heavy=True), ["md5sum", "-"]).withColumn("exit_code", F.col("exit_code").cast("bigint"))


QUERIES = {
    "run_mapper": run_mapper,
    "nested_mapper": nested_mapper,
    "run_reducer": run_reducer,
    "run_long_sum": run_long_sum,
    "run_command": run_command,
}

_E = f"WITH {v.ENTRIES_SQL} "

ORACLES = {
    "run_mapper": f"""WITH {v.DATED_SQL}, x AS (SELECT fp, list_filter([ship,
        CASE WHEN l_returnflag = 'R' THEN ship + l_linenumber * 86400 END, CASE WHEN l_linestatus = 'F' THEN ship - 86400 END,
        CASE WHEN l_returnflag = 'A' THEN ship + 60 END], lambda s: s > 0) AS s FROM d)
      SELECT list_max(s) - list_min(s) AS key, fp AS value FROM x WHERE len(s) > 0""",
    "nested_mapper": _E
    + """SELECT entry_id AS key, CASE WHEN size > 0
        THEN '[[' || doc_id || ', ' || size || '], [' || doc_id || ', ' || size || ']]' ELSE '[]' END AS value FROM e""",
    "run_reducer": _E
    + """SELECT path, arg_min(name, (-size, name)) AS name, max(size) AS size FROM e WHERE size > 0 GROUP BY path""",
    "run_long_sum": _E + "SELECT length(name) AS key, count(*) AS value FROM e GROUP BY ALL",
    "run_command": _E + "SELECT entry_id, md5 || '  -' || chr(10) AS stdout, '' AS stderr, 0 AS exit_code FROM e WHERE name_type = 5",
}

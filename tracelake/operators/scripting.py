"""User-supplied Python mappers and reducers, and external commands per file.

These run user code row by row inside Arrow batches. Whatever the built-in operators can express
is faster there.
"""

from __future__ import annotations

import io
import json
import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .content import PLACE, is_away, map_away, placed
from .inventory import is_regular_file

# Type names a script may declare.
TYPES = {"text": "string", "long": "bigint", "double": "double", "json": "string", "bytes": "binary"}

_ARROW = {"text": pa.string(), "long": pa.int64(), "double": pa.float64(), "json": pa.string(), "bytes": pa.binary()}

# Keys a map-side combine holds before it passes them on.
_COMBINE_KEYS = 50_000


def spark_type(name: str) -> str:
    if name not in TYPES:
        raise ValueError(f"unknown type {name!r}; use one of {', '.join(TYPES)}")
    return TYPES[name]


class JobCounters:
    """Counts of a scripted job. Retried tasks may count twice."""

    NAMES = ("input_records", "output_records", "warnings", "errors")

    def __init__(self, spark: SparkSession):
        self._acc = {n: spark.sparkContext.accumulator(0) for n in self.NAMES}

    def add(self, name: str, n: int = 1) -> None:
        self._acc[name] += n

    def values(self) -> dict[str, int]:
        return {n: a.value for n, a in self._acc.items()}


class Context:
    """What a script sees as ``context``."""

    def __init__(self, value_type: str, counters: JobCounters | None = None):
        self.rows: list[tuple] = []
        self._json = value_type == "json"
        self._counters = counters

    def emit(self, key, value) -> None:
        self.rows.append((key, json.dumps(value, sort_keys=True) if self._json else value))

    def _count(self, name: str) -> None:
        if self._counters is not None:
            self._counters.add(name)

    def warning(self, message: str) -> None:
        self._count("warnings")

    def error(self, message: str) -> None:
        self._count("errors")

    def take_batch(self, schema: pa.Schema) -> pa.RecordBatch:
        if self._counters is not None:
            self._counters.add("output_records", len(self.rows))
        columns = [pa.array([r[i] for r in self.rows], type=field.type) for i, field in enumerate(schema)]
        self.rows = []
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def take(self) -> pd.DataFrame:
        if self._counters is not None:
            self._counters.add("output_records", len(self.rows))
        frame = pd.DataFrame(self.rows, columns=["key", "value"])
        self.rows = []
        return frame


class Entry:
    """What a mapper sees as ``entry``: ``entry['column']`` raises KeyError for an absent value."""

    def __init__(self, row: dict):
        self._row = row

    def __getitem__(self, name: str):
        value = self._row.get(name)
        if value is None:
            raise KeyError(name)
        return value

    def get(self, name: str, default=None):
        try:
            return self[name]
        except KeyError:
            return default

    def __contains__(self, name: str) -> bool:
        return self.get(name) is not None

    def fullPath(self) -> str:
        path = self["path"]
        return path + ("/" if path and not path.endswith("/") else "") + self["name"]

    def extension(self) -> str:
        return self["name"].rpartition(".")[2].lower() if "." in self["name"] else ""

    def getStream(self, name: str = "content"):
        data = self[name]
        return io.BytesIO(data.encode() if isinstance(data, str) else bytes(data))


def run_mapper(
    entries: DataFrame,
    mapper: Callable,
    key_type: str,
    value_type: str,
    columns: list[str] | None = None,
    counters: JobCounters | None = None,
) -> DataFrame:
    """Run ``mapper(key, entry, context)`` on every entry; ``context.emit(k, v)`` makes output rows.

    ``columns`` limits what is read and sent to Python. ``key`` is the hex entry id. Values reach the mapper
    with their own types: whole numbers stay whole beside nulls, and nested columns are dicts and lists.
    """
    schema = pa.schema([("key", _ARROW[key_type]), ("value", _ARROW[value_type])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = Context(value_type, counters)
        for batch in batches:
            if counters is not None:
                counters.add("input_records", batch.num_rows)
            for row in batch.to_pylist():
                mapper(row["entry_id"], Entry(row), context)
            yield context.take_batch(schema)

    used = entries if columns is None else entries.select("entry_id", *[c for c in columns if c != "entry_id"])
    return used.mapInArrow(run, f"key {spark_type(key_type)}, value {spark_type(value_type)}")


def _combine(pairs: DataFrame, reducer: Callable, value_type: str) -> DataFrame:
    """Run a reducer on the rows of each task first, as far as they fit in a bounded table."""
    is_json = value_type == "json"

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        partial: dict = {}

        def flush() -> pd.DataFrame:
            rows = [(k, json.dumps(v, sort_keys=True) if is_json else v) for k, vs in partial.items() for v in vs]
            partial.clear()
            return pd.DataFrame(rows, columns=["key", "value"])

        for frame in frames:
            for key, group in frame.groupby("key", sort=False, dropna=False):
                values = [json.loads(v) for v in group["value"]] if is_json else group["value"].to_list()
                context = Context("text")
                reducer(key, iter(partial.get(key, []) + values), context)
                partial[key] = [v for _, v in context.rows]
            if len(partial) > _COMBINE_KEYS:
                yield flush()
        yield flush()

    return pairs.mapInPandas(run, pairs.schema)


def run_reducer(
    pairs: DataFrame,
    reducer: str | Callable,
    key_type: str = "text",
    value_type: str = "text",
    input_value_type: str = "text",
    combinable: bool = False,
) -> DataFrame:
    """Reduce ``(key, value)`` rows.

    ``reducer`` is ``'none'``, ``'identity'`` (sort by key), ``'LongSumReducer'``, or a function
    ``reducer(key, values, context)`` that gets the values of a key as a lazy iterator. Set
    ``combinable`` when a function may be applied to its own output, as a sum can: then it also
    runs on each task's rows before the shuffle, which keeps very common keys cheap.
    """
    if reducer == "none":
        return pairs
    if reducer == "identity":
        return pairs.orderBy("key", "value")
    if reducer == "LongSumReducer":
        return pairs.groupBy("key").agg(F.sum("value").alias("value"))
    if isinstance(reducer, str):
        raise ValueError(f"unknown reducer {reducer!r}")
    if combinable:
        pairs = _combine(pairs, reducer, input_value_type)
    is_json = input_value_type == "json"

    def run(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def values():
            for frame in frames:
                for value in frame["value"]:
                    yield json.loads(value) if is_json else value

        context = Context(value_type)
        reducer(key[0], values(), context)
        yield context.take()

    from collections.abc import Iterator as It
    from typing import Any

    run.__annotations__ = {"key": tuple[Any, ...], "frames": It[pd.DataFrame], "return": It[pd.DataFrame]}
    return pairs.groupBy("key").applyInPandas(run, f"key {spark_type(key_type)}, value {spark_type(value_type)}")


def run_command(
    entries: DataFrame, command: list[str], timeout: float | None = None, content: str = "content"
) -> DataFrame:
    """Run an external command per regular file with the content on stdin; content in the image is read by its extents.

    Output: ``entry_id, stdout, stderr, exit_code``. A command that cannot be started or runs out of a given
    ``timeout`` (seconds) gives exit code -1 and the reason in ``stderr``; what it had written by then is kept.
    """

    def one(data: bytes) -> tuple[str, str, int]:
        try:
            done = subprocess.run(command, input=data, capture_output=True, timeout=timeout, check=False)
        except subprocess.TimeoutExpired as e:
            return (e.stdout or b"").decode(errors="replace"), "timed out", -1
        except OSError as e:
            return "", str(e), -1
        return done.stdout.decode(errors="replace"), done.stderr.decode(errors="replace"), done.returncode

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(i, *one(bytes(c))) for i, c in zip(frame["entry_id"], frame["content"])]
            yield pd.DataFrame(rows, columns=["entry_id", "stdout", "stderr", "exit_code"])

    schema = "entry_id string, stdout string, stderr string, exit_code int"
    files = entries.where(is_regular_file(entries)).select("entry_id", F.col(content).cast("binary").alias("content"), *placed(entries))
    ran = files.where(~is_away(files)).select("entry_id", "content").mapInPandas(run, schema)
    if len(placed(files)) < len(PLACE):
        return ran
    return ran.unionByName(map_away(files, lambda row, pieces: [row["entry_id"], *one(b"".join(pieces))], ran.columns, schema))

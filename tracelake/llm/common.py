"""Shared helpers: tables, hashing of whole texts in numpy, connected components."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, ship_package

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

_rng = np.random.Generator(np.random.PCG64(20240611))
BYTE_VALUES = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
LOWER_BYTES = np.arange(256, dtype=np.uint8)
LOWER_BYTES[65:91] += 32
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER_VALUES = BYTE_VALUES[LOWER_BYTES]

_powers = {"up": np.ones(1, dtype=np.uint64), "down": np.ones(1, dtype=np.uint64)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    found = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    small_batches(found)
    return found


#: Rows that go to a Python worker at once. Whole texts are long, so Spark's default would fill a worker's memory; results don't depend on it.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> None:
    """Have the session send at most ``BATCH_ROWS`` rows at once; a smaller setting stays."""
    conf = df.sparkSession.conf
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the hash base and of its inverse; kept and extended by doubling."""
    if len(_powers["up"]) < n:
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            values = _powers[name]
            while len(values) < n:
                values = np.concatenate((values, values * np.uint64(pow(base, len(values), 1 << 64))))
            _powers[name] = values
    return _powers["up"][:n], _powers["down"][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finish that spreads all 64 bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``values[start:end]``, independent of where the span lies."""
    up, down = powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[:-1], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes other than blank and 09-0D."""
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = ~IS_SPACE[data]
    step = np.diff(inside)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash for each word of a whole text, A-Z lower-cased."""
    if not text:
        return np.zeros(0, dtype=np.uint64)
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    starts, ends = word_spans(data)
    return span_hashes(_LOWER_VALUES[data], starts, ends)


_SHINGLE_FACTORS = np.array([0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F, 0xEB44ACCAB455D165, 0x9FB21C651E98DF25], dtype=np.uint64)


def word_windows(words: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` words; of a shorter text, one hash of all its words."""
    if len(words) == 0:
        return words
    k = min(size, len(words))
    total = np.full(len(words) - k + 1, k, dtype=np.uint64)
    for j in range(k):
        total += words[j : len(words) - k + 1 + j] * _SHINGLE_FACTORS[j]
    return mix(total)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``(a, b)``: ``(node, comp)``, comp being the smallest node reachable.

    Each round takes the smallest label among the neighbours and then the label of that label, so
    the number of rounds follows the logarithm of a chain's length. Labels and edges stay in tables.
    """
    both = materialize(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("comp")), "labels")
    while True:
        near = both.join(labels.select(F.col("node").alias("b"), F.col("comp").alias("seen")), "b").groupBy("a").agg(F.min("seen").alias("seen"))
        low = labels.join(near, labels["node"] == near["a"]).select("node", F.col("comp").alias("was"), F.least("comp", "seen").alias("comp"))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("next"))
        after = materialize(
            low.join(jump, "comp").select("node", "was", F.least("comp", "next").alias("comp")), "labels"
        )
        if after.where(F.col("comp") != F.col("was")).isEmpty():
            return after.select("node", "comp")
        labels = after.select("node", "comp")


#: Bytes of text that are worked on at once; a longer single text is a block of its own.
BLOCK_BYTES = 1 << 20


def byte_blocks(texts, block_bytes: int = BLOCK_BYTES):
    """Whole texts joined by line feeds, a block at a time: ``(first row, end row, bytes, starts of rows)``."""
    parts, size, first = [], 0, 0
    for at, text in enumerate(texts):
        data = text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""
        if parts and size + len(data) > block_bytes:
            yield first, at, *_joined(parts)
            parts, size, first = [], 0, at
        parts.append(data)
        size += len(data) + 1
    if parts:
        yield first, first + len(parts), *_joined(parts)


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter((len(p) + 1 for p in parts), dtype=np.int64, count=len(parts))
    starts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(lengths)))
    return np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8), starts


def runs(inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True."""
    padded = np.zeros(len(inside) + 2, dtype=np.int8)
    padded[1:-1] = inside
    step = np.diff(padded)
    return np.flatnonzero(step == 1), np.flatnonzero(step == -1)


def lower_values(data: np.ndarray) -> np.ndarray:
    """The hash value of each byte, A-Z lower-cased."""
    return _LOWER_VALUES[data]

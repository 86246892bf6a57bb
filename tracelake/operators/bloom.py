"""A Bloom filter over a column, as an expression that the rows of a large table are tested with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

# Bits for each key that are aimed at, and hash functions.
KEY_BITS = 12
FUNCTIONS = 4
# The whole filter has at most 16 MiB. With fewer than LEAST_KEY_BITS for a key too many rows would pass, and no filter is made.
MAX_BITS = 1 << 27
LEAST_KEY_BITS = 4


def _bits(value: Column, n_bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(seed), value), F.lit(n_bits)) for seed in range(FUNCTIONS)]


def bloom_filter(keys: DataFrame, column: str, n_keys: int, max_bits: int = MAX_BITS) -> Callable[[Column], Column] | None:
    """A test that every value of ``column`` passes, and few others; None if the filter would be too large. Null never passes.

    The bits are set by partial aggregates: a row for each word of 64 bits leaves a task. The filter reaches the tasks as the result of a scalar subquery, so the plan is as
    small for any number of keys.
    """
    n_bits = min(max_bits, 1 << max(10, (KEY_BITS * max(1, n_keys) - 1).bit_length()))
    if n_bits < LEAST_KEY_BITS * n_keys:
        return None
    spark = keys.sparkSession
    places = keys.select(F.explode(F.array(*_bits(F.col(column), n_bits))).alias("bit"))
    words = places.groupBy((F.col("bit") / 64).cast("int").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(bit, 64) AS int))")).alias("bits"))
    all_words = spark.range(n_bits // 64).select(F.col("id").cast("int").alias("word"))
    dense = materialize(all_words.join(words, "word", "left").select("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits")), "bloom-words")
    table = dense.agg(F.transform(F.array_sort(F.collect_list(F.struct("word", "bits"))), lambda x: x["bits"]).alias("t"))
    stored = materialize(table, "bloom").scalar()  # at most MAX_BITS / 8 bytes

    def test(value: Column) -> Column:
        found = F.lit(True)
        for bit in _bits(value, n_bits):
            found = found & (F.getbit(F.get(stored, (bit / 64).cast("int")), F.pmod(bit, F.lit(64)).cast("int")) == 1)
        return value.isNotNull() & found

    return test

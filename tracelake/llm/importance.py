"""Importance resampling: draw the documents whose hashed word n-grams are likelier under a target corpus.

Every run of 1 to ``RUN`` words is a feature, hashed by CRC-32 into ``BUCKETS`` buckets. Both corpora are counted into an array of buckets in each task, and the arrays are summed
by bucket. A bucket's gain is the logarithm of the smoothed ratio of its shares; a document's weight is the sum of the gains of its features, read from the array of gains, and its score adds
Gumbel noise from a hash of its id, so that the highest scores are a draw without replacement.

The lowest score to be drawn is found without sorting the corpus: a quantile sketch gives a bracket of scores around its place, exact counts above and inside the
bracket show whether the place is in it (if not, the bracket is widened), and only the bracket is sorted. The drawn rows are then numbered by range partitions.

CRCs of a block's n-grams are made in numpy: the CRC of a concatenation is that of the left part, shifted by the length of the right part, combined with that of the right
part, and the shift by a power of two of bytes is a linear map kept as four tables.

Defined cases: a null or empty text has no words; with no features the weight is 0; rows that share an id are documents of their own with the same noise; a null id
counts as an empty string in the hash and ranks after other ids of its score; rows that tie in score and id are in any order, each with a rank of its own; a text of any length is counted in parts of
``PART_WORDS`` words that overlap; an empty table of documents gives an empty table, an empty target makes all features count as unseen there; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import materialize
from .common import LOWER_BYTES, byte_blocks, runs

BUCKETS = 10_000
RUN = 3
SEED = 42
MIN_WORDS = 20
#: Share of the documents with ``MIN_WORDS`` words or more that is drawn, in percent.
PERCENT = 5
#: The sketch is off by one part in so many at most.
ACCURACY = 2000
#: Words that are hashed at once.
PART_WORDS = 1 << 18

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[0x30:0x3A] = _IS_WORD[0x61:0x7B] = _IS_WORD[0x80:] = True
_IS_WORD[0x41:0x5B] = True  # lower-cased before they are hashed
_SHORT = 24  # words up to so many bytes are hashed together, byte by byte


@functools.cache
def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


def _apply(tables: np.ndarray, crc: np.ndarray) -> np.ndarray:
    return tables[0][crc & 255] ^ tables[1][(crc >> 8) & 255] ^ tables[2][(crc >> 16) & 255] ^ tables[3][crc >> 24]


@functools.cache
def _shift_tables(power: int) -> np.ndarray:
    """The map that appends 2**power zero bytes, by the bytes of the CRC."""
    if power:
        half = _shift_tables(power - 1)
        return _apply(half, half)
    places = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    return (places >> 8) ^ _byte_table()[places & 255]


def _shifted(crc: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    crc = crc.copy()
    for power in range(int(lengths.max(initial=0)).bit_length()):
        at = np.flatnonzero((lengths >> power) & 1)
        crc[at] = _apply(_shift_tables(power), crc[at])
    return crc


def _crc_of_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    table = _byte_table()
    crc = np.full(len(starts), 0xFFFFFFFF, dtype=np.uint32)
    order = np.argsort(-np.minimum(sizes, _SHORT + 1), kind="stable")
    by_size, begin = sizes[order], starts[order]
    long_ = int(np.count_nonzero(sizes > _SHORT))
    for step in range(int(by_size[long_]) if long_ < len(order) else 0):
        last = np.searchsorted(-by_size, -step, side="left")  # spans of more than step bytes
        now = crc[long_:last]
        crc[long_:last] = (now >> 8) ^ table[(now ^ data[begin[long_:last] + step]) & 255]
    out = np.empty(len(starts), dtype=np.uint32)
    out[order] = ~crc
    for i in order[:long_].tolist():
        out[i] = zlib.crc32(data[starts[i] : starts[i] + sizes[i]])
    return out


def text_features(texts, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Part by part: the buckets of the features, the numbers of the texts that they are in, and the number of the text of each word; any text's parts come one after the other."""
    for first, _, data, rows in byte_blocks(texts):
        starts, ends = runs(_IS_WORD[data])
        data = LOWER_BYTES[data]
        row = first + np.searchsorted(rows, starts, side="right") - 1
        for at in range(0, len(starts), PART_WORDS):
            part = slice(at, at + PART_WORDS + RUN - 1)  # with the words that runs from here end in
            own = min(PART_WORDS, len(starts) - at)
            of, sizes = row[part], (ends - starts)[part]
            crc = _crc_of_spans(data, starts[part], sizes)
            after_blank = _shifted(np.full(len(crc), zlib.crc32(b" "), dtype=np.uint32), sizes) ^ crc
            found, texts_of, run = [crc[:own]], [of[:own]], crc
            for more in range(1, RUN):
                run = _shifted(run[: len(crc) - more], sizes[more:] + 1) ^ after_blank[more:]
                same = (of[:-more] == of[more:])[:own]
                found.append(run[:own][same])
                texts_of.append(of[:-more][:own][same])
            yield np.concatenate(found) % np.uint32(buckets), np.concatenate(texts_of), of[:own]


def bucket_counts(docs: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts each bucket holds. What reaches the driver is one row for each bucket at most."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for found, _, _ in text_features(batch.column("text").to_pylist(), buckets):
                total += np.bincount(found, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], ["bucket", "n"])

    counts = np.zeros(buckets, dtype=np.int64)
    for r in docs.select("text").mapInArrow(count, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[r.bucket] = r.n
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The gain of each bucket, in thousandths."""
    all_corpus, all_target, n = float(corpus.sum()), float(target.sum()), len(corpus)
    return np.array([math.floor(1000 * math.log((t + 1) * (all_corpus + n) / ((s + 1) * (all_target + n)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], dtype=np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise of an id, in thousandths."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of each row of ``docs`` (``doc_id, text``)."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, features, weight = (np.zeros(n, dtype=np.int64) for _ in range(3))
            for found, texts_of, of in text_features(batch.column("text").to_pylist(), len(gain)):
                words += np.bincount(of, minlength=n)
                features += np.bincount(texts_of, minlength=n)
                order = np.argsort(texts_of, kind="stable")
                sums = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(gain[found[order]])))
                cuts = np.searchsorted(texts_of[order], np.arange(n + 1))
                weight += sums[cuts[1:]] - sums[cuts[:-1]]
            ids = batch.column("doc_id")
            score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], dtype=np.int64)
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, (words, features, weight, score))], ["doc_id", "n_words", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, "doc_id long, n_words long, n_features long, weight long, score long")




def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("_row")]


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` with ``name``, their place from 1 on. Rows are dealt by ranges of the order; each range adds the sizes of those before it."""
    dealt = materialize(rows.repartitionByRange(*_order()).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = sorted((r["_range"], r["count"]) for r in dealt.groupBy("_range").count().collect())  # a row for each partition
    before = np.cumsum([0] + [n for _, n in sizes]).tolist()
    offsets = dealt.sparkSession.createDataFrame([(k, b) for (k, _), b in zip(sizes, before)], "_range int, _before long")
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_range").orderBy(*_order()))
    return dealt.join(F.broadcast(offsets), "_range").withColumn(name, place.cast("long")).drop("_range", "_before")


def bracket(rows: DataFrame, n: int, k: int, accuracy: int = ACCURACY, margin: float | None = None) -> tuple[int | None, int | None, int]:
    """``(lowest score, highest score, rows above)`` of a bracket that holds the ``k``-th highest of ``n`` scores; None: open."""
    margin = 2 / accuracy if margin is None else margin
    while True:
        low_at, high_at = 1 - k / n - margin, 1 - k / n + margin
        low, high = rows.agg(F.percentile_approx("score", [max(0.0, low_at), min(1.0, high_at)], accuracy)).first()[0]
        low, high = None if low_at <= 0 else low, None if high_at >= 1 else high
        inside, above = F.lit(True), F.lit(False)
        if low is not None:
            inside &= F.col("score") >= low
        if high is not None:
            inside &= F.col("score") <= high
            above = F.col("score") > high
        counts = rows.agg(F.count_if(above).alias("above"), F.count_if(inside).alias("inside")).first()
        if counts.above < k <= counts.above + counts.inside:
            return low, high, counts.above
        margin = 4 * margin + 1 / n


def last_drawn(rows: DataFrame, n: int, k: int, **how):
    """The row at the ``k``-th place of the order."""
    low, high, above = bracket(rows, n, k, **how)
    inside = rows
    if low is not None:
        inside = inside.where(F.col("score") >= low)
    if high is not None:
        inside = inside.where(F.col("score") <= high)
    return numbered(inside.select("score", "doc_id", "_row"), "_place").where(F.col("_place") == k - above).first()


def importance(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank, n_words`` of each row of ``docs``; ``rank`` is the place among the drawn rows, else null."""
    gain = gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    scored = materialize(scores(docs, gain, seed).withColumn("_row", F.monotonically_increasing_id()), "scores")
    columns = ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    enough = F.col("n_words") >= min_words
    n = scored.where(enough).count()
    k = percent * n // 100
    if k == 0:
        return scored.withColumn("rank", F.lit(None).cast("long")).select(columns)
    last = last_drawn(scored.where(enough), n, k)
    place = F.struct(-F.col("score"), F.col("doc_id").isNull(), F.coalesce("doc_id", F.lit(0).cast("long")), F.col("_row"))
    bound = F.struct(F.lit(-last["score"]).cast("long"), F.lit(last["doc_id"] is None), F.lit(last["doc_id"] or 0).cast("long"), F.lit(last["_row"]).cast("long"))
    drawn = enough & (place <= bound)
    return numbered(scored.where(drawn), "rank").select(columns).unionByName(scored.where(~drawn).withColumn("rank", F.lit(None).cast("long")).select(columns))


def resampled(docs: DataFrame, target: DataFrame, **how) -> DataFrame:
    """The ids of the drawn documents with their ranks."""
    return importance(docs, target, **how).where("rank IS NOT NULL").select("doc_id", "rank")

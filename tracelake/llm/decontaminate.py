"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits (A-Z lower-cased; bytes from 80 on count as letters). Runs of
``MIN_MATCH`` words that a document shares with a test item are the seeds, found by one rolling hash over every text.
For each pair of a document and an item with a seed the tiling marks the longest match that touches no marked word, again and again, until none of
``MIN_MATCH`` words is left. Since every tile counts wherever it stands, passages whose sentences were moved are found too.
An item is in a document when the tiles cover at least ``MIN_COVERAGE`` of its words.

The test items go to the tasks in blocks of at most ``BLOCK_BYTES`` of text, so what is broadcast is bounded; all blocks
are matched in one pass over the documents.

Defined cases: null and empty texts, and items without a word, match nothing; an item of fewer than ``MIN_MATCH`` words
is in a document that has all its words in a row; repeated items give their id once; rows keep their number and order of columns;
an empty benchmark finds nothing.
"""

from __future__ import annotations

import heapq
import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, lower_values, runs, span_hashes, word_windows

MIN_MATCH = 5
MIN_COVERAGE = 0.5
BLOCK_BYTES = 32 << 20

_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def texts_words(texts) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """For blocks of texts: first and end row, word hashes, and where each row's words begin."""
    for first, end, data, rows in byte_blocks(texts):
        starts, ends = runs(_IS_WORD[data])
        yield first, end, span_hashes(lower_values(data), starts, ends), np.searchsorted(starts, rows)


class TestItems:
    """A block of items with the places of their seeds."""

    __test__ = False

    def __init__(self, ids: list[int], texts: list[str | None]):
        self.ids, self.words, seeds = [], [], defaultdict(list)
        for first, end, words, cuts in texts_words(texts):
            for i in range(first, end):
                own = words[cuts[i - first] : cuts[i - first + 1]]
                if not len(own):
                    continue
                for place, seed in enumerate(word_windows(own, MIN_MATCH).tolist()):
                    seeds[min(len(own), MIN_MATCH), seed].append((len(self.ids), place))
                self.ids.append(ids[i])
                self.words.append(own.tolist())
        self.seeds = seeds
        self.sizes = sorted({size for size, _ in seeds})
        self.sorted = {size: np.sort(np.array([s for k, s in seeds if k == size], dtype=np.uint64)) for size in self.sizes}

    def seeds_in(self, words: np.ndarray, cuts: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """``row, place, size, seed`` of every seed in a block of texts."""
        row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
        for size in self.sizes:
            if len(words) < size:
                continue
            windows = word_windows(words, size)
            known = self.sorted[size]
            hit = known[np.minimum(np.searchsorted(known, windows), len(known) - 1)] == windows
            hit &= row[: len(windows)] == row[size - 1 :]
            for at in np.flatnonzero(hit).tolist():
                yield int(row[at]), at - int(cuts[row[at]]), size, int(windows[at])

    def covered(self, item: int, words: list[int], places: list[tuple[int, int]], size: int) -> int:
        """How many words of the item the tiles cover. places: of equal runs of ``size`` words, in the item and in the text."""
        own = self.words[item]
        by_diagonal = defaultdict(list)
        for mine, theirs in places:
            by_diagonal[theirs - mine].append(mine)
        matches = []
        for shift, starts in by_diagonal.items():
            starts.sort()
            begin = end = starts[0]
            for at in [*starts[1:], None]:
                if at is not None and at <= end + size:
                    end = at
                    continue
                matches.append((-(end + size - begin), begin, begin + shift))
                if at is not None:
                    begin = end = at
        heapq.heapify(matches)
        mine_marked, their_marked, total = bytearray(len(own)), set(), 0
        while matches:
            length, mine, theirs = heapq.heappop(matches)
            free = [not mine_marked[mine + j] and theirs + j not in their_marked and own[mine + j] == words[theirs + j] for j in range(-length)]
            if all(free):
                total -= length
                for j in range(-length):
                    mine_marked[mine + j] = 1
                    their_marked.add(theirs + j)
                continue
            at = 0
            while at < -length:  # what is left of it may still be a tile
                if free[at]:
                    stop = at
                    while stop < -length and free[stop]:
                        stop += 1
                    if stop - at >= size:
                        heapq.heappush(matches, (at - stop, mine + at, theirs + at))
                    at = stop
                at += 1
        return total

    def found(self, texts) -> tuple[list[list[int]], list[float]]:
        """For each text the ids of the items in it, and the largest coverage of any item."""
        ids, best = [[] for _ in range(len(texts))], [0.0] * len(texts)
        for first, _, words, cuts in texts_words(texts):
            pairs = defaultdict(list)
            for row, place, size, seed in self.seeds_in(words, cuts):
                for item, mine in self.seeds[size, seed]:
                    pairs[row, item, size].append((mine, place))
            own = {row: words[cuts[row] : cuts[row + 1]].tolist() for row, _, _ in pairs}
            for (row, item, size), places in pairs.items():
                share = self.covered(item, own[row], places, size) / len(self.words[item])
                best[first + row] = max(best[first + row], share)
                if share >= MIN_COVERAGE and self.ids[item] is not None:
                    ids[first + row].append(self.ids[item])
        return [sorted(set(x)) for x in ids], best


def _blocks(benchmark: DataFrame) -> list[TestItems]:
    items = benchmark.where("text IS NOT NULL").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, math.ceil(total / BLOCK_BYTES * 1.5))
    blocks = []
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect() if n > 1 else items.collect()
        if rows:
            blocks.append(TestItems([r["item_id"] for r in rows], [r["text"] for r in rows]))
    return blocks


def _found(docs: DataFrame, benchmark: DataFrame) -> Column:
    """``struct<items array<long>, coverage double>`` from the column ``text``."""
    columns = [_search(docs.sparkSession.sparkContext.broadcast(block)) for block in _blocks(benchmark)]  # each bounded by BLOCK_BYTES
    if not columns:
        return F.struct(F.array().cast("array<long>").alias("items"), F.lit(0.0).alias("coverage"))
    if len(columns) == 1:
        return columns[0]
    return F.struct(
        F.array_sort(F.array_distinct(F.concat(*[c["items"] for c in columns]))).alias("items"), F.greatest(*[c["coverage"] for c in columns]).alias("coverage")
    )


def _search(shared) -> Column:
    @F.pandas_udf("struct<items: array<long>, coverage: double>")
    def search(texts: pd.Series) -> pd.DataFrame:
        items, best = shared.value.found(texts)
        return pd.DataFrame({"items": pd.Series(items, dtype="object"), "coverage": pd.Series(best, dtype="float64")})

    return search("text")


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``doc_id, contaminated, item_ids, coverage`` for each row of ``docs``."""
    found = docs.select("doc_id", _found(docs, benchmark).alias("found"))
    return found.select("doc_id", (F.col("found.coverage") >= MIN_COVERAGE).alias("contaminated"), F.col("found.items").alias("item_ids"), "found.coverage")


def without_test_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` in which no item was found, with their own columns."""
    own = docs.select(F.struct("*").alias("row"), "text")
    return own.withColumn("found", _found(docs, benchmark)).where(F.col("found.coverage") < MIN_COVERAGE).select("row.*")

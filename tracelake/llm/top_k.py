"""Exact top-k inner products by reading sorted lists without random access.

Vector components become integers, ``floor(SCALE * x)``. Candidates stand in blocks of ``BLOCK`` vectors, and a block is stored as its lists: for each dimension the
places of the candidates and their values by falling value. A query reads a list from the top where its own component is positive, from the bottom where it is
negative, and not at all where it is zero, so every list brings its best contributions first.

Contributions are counted from the worst value of their list, so none is negative. A candidate's running sum of what was read is then its lower bound,
and the upper bound adds, for each list that has not shown it yet, what the value read last would give. Lists are read in growing steps. Once a candidate that no list has shown
cannot reach the k-th best lower bound that the query has, only candidates whose upper bound reaches it are in doubt. While they are many, reading goes on; the rest of the lists
is added up for a few of them alone. A query that cannot gain from a block at all reads nothing there. The vectors themselves are not kept.

The queries of a block read together: what the lists show in a step is laid out by candidate once, and a product with the components of all queries that are still reading adds it
to their running sums. Every pair of a query and a block costs some of that, so the work grows with the number of queries times the number of candidates.

Queries and candidates meet in blocks: every block of candidates is sent once to each block of queries. A task keeps the k best of each query over all blocks it
sees and passes them on at its end; a window keeps the best k of them.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows without an id, nor candidates whose length differs
from the query's (each length is searched by itself); with fewer than k candidates all are returned; equal scores go to the smaller id; a repeated id is a candidate as often as
it occurs, but no row is a candidate for a query with its own id; of rows that repeat a query's id the least vector is the query; other columns are ignored; an empty table gives
no rows. Very long vectors only make wider blocks. Sums are kept as numbers that hold them exactly (``NUMBERS``), at last as integers of any
length, so bounds are always exact; a score among a block's k best that does not fit in a long ends the job with ``OverflowError``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 20
SCALE = 64
BLOCK = 2048
QUERY_BLOCK = 2048
BLOCKS_PER_TASK = 4
#: The lists are read to 1/FIRST of their length before the first look at the bounds, then to twice that depth each time, by a quarter at most.
FIRST = 16
#: Kinds of numbers, below what sums they are exact (sums are estimated, so the larger limits keep a distance), and how many queries read a block together.
NUMBERS = ((np.float32, 2**24, 2048), (np.float64, 2**52, 1024), (np.int64, 2**62, 1024), (object, math.inf, 64))
#: Cells of lists that are added up at once for candidates in doubt.
CELLS = 1 << 21
#: Blocks of queries whose results a task holds at once.
HELD = 64


def whole_numbers(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """``id, dims, v`` of the usable vectors."""
    x = F.col(vector_column)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e.cast("double")) | (F.abs(e.cast("double")) == float("inf")))
    usable = vectors.where(F.col(id_column).isNotNull() & x.isNotNull() & (F.size(x) > 0)).where(~bad)
    return usable.select(F.col(id_column).cast("long").alias("id"), F.size(x).alias("dims"), F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("v"))


def _query_block(group: pd.DataFrame) -> pd.DataFrame:
    data = np.array(list(group["v"]), dtype=np.int64)
    ids = group["id"].to_numpy(dtype=np.int64)
    first = group.iloc[0]
    return pd.DataFrame({"dims": [first["dims"]], "query_ids": [ids.tobytes()], "queries": [data.tobytes()], "query_block": [first["query_block"]]})


class SortedLists:
    """A block of candidates as one list for each dimension, by falling value."""

    def __init__(self, ids: np.ndarray, order: np.ndarray, values: np.ndarray):
        self.ids, self.order, self.values = ids, order, values
        self.top, self.bottom = values[:, 0].copy(), values[:, -1].copy()

    def gains(self, number: type, start: int, end: int) -> np.ndarray:
        """Values counted from the worst that the lists show between two depths: of the lists from the top, then of the same lists from the bottom."""
        exact = object if number is object else np.int64
        up = self.values[:, start:end].astype(exact) - self.bottom.astype(exact)[:, None]
        down = self.top.astype(exact)[:, None] - self.values[:, ::-1][:, start:end].astype(exact)
        return np.concatenate((up, down)).astype(number)

    def by_place(self, number: type, start: int, end: int, shown: np.ndarray | int, other: int) -> np.ndarray:
        """By list and candidate, what a list shows between two depths, and ``other`` elsewhere."""
        places = np.concatenate((self.order[:, start:end], self.order[:, ::-1][:, start:end]))
        found = np.full((len(places), len(self.ids)), other, dtype=number)
        np.put_along_axis(found, places, shown, axis=1)
        return found

    @classmethod
    def of(cls, ids, vectors) -> SortedLists:
        columns = np.array(list(vectors), dtype=np.int64).T
        order = np.argsort(~columns, axis=1, kind="stable").astype(np.int32)
        return cls(np.asarray(ids, dtype=np.int64), order, np.take_along_axis(columns, order, axis=1))

    def row(self) -> pd.DataFrame:
        return pd.DataFrame({"dims": [len(self.order)], "ids": [self.ids.tobytes()], "places": [self.order.tobytes()], "listed": [self.values.tobytes()]})

    @classmethod
    def of_row(cls, row) -> SortedLists:
        ids = np.frombuffer(row.ids, dtype=np.int64)
        return cls(ids, np.frombuffer(row.places, dtype=np.int32).reshape(row.dims, -1), np.frombuffer(row.listed, dtype=np.int64).reshape(row.dims, -1))


def kinds(block: SortedLists, queries: np.ndarray) -> np.ndarray:
    """For each query the place in ``NUMBERS`` of the first kind that is exact for all its sums over a block."""
    reach = np.abs(queries.astype(np.float64)) @ (np.abs(block.top.astype(np.float64)) + np.abs(block.bottom.astype(np.float64)))
    return np.searchsorted([limit for _, limit, _ in NUMBERS], reach, side="right")


class Reader:
    """The way of a query, or of several (one a row), through the lists of a block. What a list shows is read once for all of them."""

    def __init__(self, block: SortedLists, query: np.ndarray):
        self.block, self.size = block, len(block.ids)
        self.number = NUMBERS[np.max(kinds(block, query))][0]
        top, bottom, own = (x.astype(object if self.number is object else np.int64) for x in (block.top, block.bottom, query))
        # From the top where a component is positive, from the bottom where it is negative.
        self.factor = np.concatenate((np.maximum(own, 0), np.maximum(-own, 0)), axis=-1).astype(self.number)
        self.base = np.asarray(np.maximum(own, 0) @ bottom + np.minimum(own, 0) @ top)
        self.last = np.concatenate((top - bottom, top - bottom)).astype(self.number)
        self.sums, self.depth = np.zeros((*query.shape[:-1], self.size), dtype=self.number), 0

    def read(self, depth: int) -> None:
        """Read all lists on to this depth."""
        gains = self.block.gains(self.number, self.depth, depth)
        self.sums = self.sums + self.factor @ self.block.by_place(self.number, self.depth, depth, gains, 0)
        if gains.size:
            self.last = gains[:, -1]
        self.depth = depth

    def outsider(self, depth: int | None = None) -> np.ndarray:
        """What a candidate that no list has shown can add at most, here or at a depth ahead."""
        last = self.last if depth is None else self.block.gains(self.number, depth - 1, depth)[:, 0]
        return self.factor @ (last if (depth or self.depth) < self.size else np.zeros_like(last))

    def upper(self, queries=...) -> np.ndarray:
        """Upper bounds of all candidates, from the lists that have not shown them."""
        if self.depth == self.size:
            return self.sums[queries]
        return self.sums[queries] + (self.factor[queries] * self.last) @ self.block.by_place(self.number, 0, self.depth, 0, 1)

    def finish(self, queries: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The whole sums of these pairs of a query and a candidate: the rest of the lists is added up for them alone."""
        sums = self.sums[queries, places]
        if self.depth < self.size and len(sums):
            rest = self.block.by_place(self.number, self.depth, self.size, self.block.gains(self.number, self.depth, self.size), 0).T.copy()
            step = max(1, CELLS // rest.shape[1])
            for start in range(0, len(sums), step):
                part = slice(start, start + step)
                sums[part] += (self.factor[queries[part]] * rest[places[part]]).sum(axis=1)
        return sums

    def keep(self, queries: np.ndarray) -> None:
        """Go on with these queries alone."""
        self.factor, self.sums, self.base = self.factor[queries], self.sums[queries], self.base[queries]

    def least(self, floors: np.ndarray) -> np.ndarray:
        """Floors of scores as floors of sums. Sums are counted from the worst values, so zero is a floor of all; one beyond the kind of number is beyond all sums too."""
        if self.number in (np.float32, np.float64):
            return np.maximum(floors.astype(np.float64) - self.base, 0).astype(self.number)
        above = [0 if f == -math.inf else max(0, int(f) - int(b)) for f, b in zip(floors, self.base, strict=True)]
        return np.array([min(a, 2**63 - 1) for a in above] if self.number is np.int64 else above, dtype=self.number)


def best_of_blocks(query_ids: np.ndarray, queries: np.ndarray, block: SortedLists, k: int, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of queries, ids and scores: for each query at most k candidates, best first, all that belong to the k best of the block and reach its floor (an integer or minus infinity)."""
    reader, n = Reader(block, queries), len(block.ids)
    base, least, at, own = reader.base, reader.least(floors), np.arange(len(queries)), query_ids[:, None] == block.ids
    found = [(at[:0], at[:0], reader.sums[:0, 0])]

    def go_on(rows: np.ndarray) -> None:
        nonlocal least, at, own
        reader.keep(rows)
        least, at, own = least[rows], at[rows], own[rows]

    go_on(np.flatnonzero(reader.outsider() >= least))  # the others read nothing here
    depth = -(-n // FIRST)
    while len(at):
        # Where nearly all queries have a floor and could not stop, nobody looks.
        while depth < n and ((reader.outsider(depth) < least) | (least <= 0)).mean() < 1 / FIRST:
            depth = _deeper(depth, n)
        reader.read(min(depth, n))
        depth = _deeper(reader.depth, n)
        whole = reader.depth == n
        loose = np.flatnonzero((reader.outsider() >= least) | whole)
        if len(loose) and n >= k:
            sure = np.where(own[loose], -1, reader.sums[loose])
            least[loose] = np.maximum(least[loose], np.partition(sure, n - k, axis=1)[:, n - k])
        closed = np.flatnonzero((reader.outsider() < least) | whole)
        if len(closed):
            doubt = (reader.upper(closed) >= least[closed, None]) & ~own[closed]
            few = whole | (doubt.sum(axis=1) <= max(k, n // FIRST))  # where many are in doubt, all lists are read on
            rows, places = np.nonzero(doubt[few])
            rows = closed[few][rows]
            sums = reader.finish(rows, places)
            can = sums >= least[rows]
            found.append((at[rows[can]], places[can], sums[can]))
            go_on(np.setdiff1d(np.arange(len(at)), closed[few]))
    rows, places, sums = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.argsort(block.ids[places], kind="stable")
    order = order[np.argsort(-sums[order], kind="stable")]
    order = order[np.argsort(rows[order], kind="stable")]
    order = order[_ranks(rows[order]) < k]
    rows, places, sums = rows[order], places[order], sums[order]
    return rows, block.ids[places], np.array([int(s) + int(b) for s, b in zip(sums, base[rows], strict=True)], dtype=np.int64)


def best_of_block(query_id: int, query: np.ndarray, block: SortedLists, k: int, floor: float = -math.inf) -> tuple[np.ndarray, np.ndarray]:
    """The same for a single query: ids and scores."""
    _, ids, scores = best_of_blocks(np.array([query_id]), query[None, :], block, k, np.array([floor], dtype=object))
    return ids, scores


def _deeper(depth: int, n: int) -> int:
    return min(2 * depth, depth + -(-n // 4))


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Places within each run of equal values, from 0."""
    return np.arange(len(groups)) - np.searchsorted(groups, groups)


def _packed(rows: DataFrame) -> DataFrame:
    """Blocks of at most ``BLOCK`` vectors of one length, sorted where the rows are read: ``dims, ids, places, listed``."""

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}
        for batch in batches:
            for i, dims, v in zip(batch["id"], batch["dims"], batch["v"], strict=True):
                part = held.setdefault(dims, [])
                part.append((i, v))
                if len(part) == BLOCK:
                    yield SortedLists.of(*zip(*part, strict=True)).row()
                    part.clear()
        for part in held.values():
            if part:
                yield SortedLists.of(*zip(*part, strict=True)).row()

    return rows.mapInPandas(pack, "dims int, ids binary, places binary, listed binary")


class Best:
    """The k best of each query of a block, over all blocks of candidates so far."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.at = self.ids = self.scores = np.empty(0, dtype=np.int64)

    def see(self, block: SortedLists) -> None:
        floors = np.full(len(self.queries), -math.inf, dtype=object)
        last = np.flatnonzero(_ranks(self.at) == self.k - 1)
        floors[self.at[last]] = self.scores[last]
        found, kind = [(self.at, self.ids, self.scores)], kinds(block, self.queries)
        for place, (_, _, together) in enumerate(NUMBERS):
            rows = np.flatnonzero(kind == place)
            for start in range(0, len(rows), together):
                part = rows[start : start + together]
                at, ids, scores = best_of_blocks(self.query_ids[part], self.queries[part], block, self.k, floors[part])
                found.append((part[at], ids, scores))
        at, ids, scores = (np.concatenate(x) for x in zip(*found, strict=True))
        order = np.lexsort((ids, ~scores, at))
        order = order[_ranks(at[order]) < self.k]
        self.at, self.ids, self.scores = at[order], ids[order], scores[order]

    def rows(self) -> pd.DataFrame:
        return pd.DataFrame({"query_id": self.query_ids[self.at], "vec_id": self.ids, "score": self.scores})


def _search(k: int):
    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], Best] = {}
        for batch in batches:
            for row in batch.itertuples():
                key = (row.query_block, row.dims)
                if key not in held:
                    if len(held) == HELD:
                        for best in held.values():
                            yield best.rows()
                        held.clear()
                    held[key] = Best(np.frombuffer(row.query_ids, dtype=np.int64), np.frombuffer(row.queries, dtype=np.int64).reshape(-1, row.dims), k)
                held[key].see(SortedLists.of_row(row))
        for best in held.values():
            yield best.rows()

    return search


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the k rows with the highest inner product for each query row, its own id excepted."""
    rows = whole_numbers(vectors, id_column, vector_column)
    wanted = whole_numbers(vectors.where(is_query), id_column, vector_column).groupBy("id").agg(F.min(F.struct("dims", "v")).alias("x")).select("id", "x.dims", "x.v")
    n_rows, n_queries = rows.count(), wanted.count()
    query_blocks = max(1, math.ceil(n_queries / QUERY_BLOCK))
    slices = max(1, math.ceil(n_rows / (BLOCK * BLOCKS_PER_TASK)))
    numbered = wanted.withColumn("query_block", F.pmod(F.xxhash64("id"), F.lit(query_blocks)))
    queries = numbered.groupBy("query_block", "dims").applyInPandas(_query_block, "dims int, query_ids binary, queries binary, query_block long")
    # Each block of candidates is in one slice; (block of queries, slice) is dealt to tasks.
    queries = queries.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")))
    candidates = _packed(rows).withColumn("slice", F.pmod(F.xxhash64("ids"), F.lit(slices)))
    candidates = candidates.withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)).cast("array<long>")))
    found = candidates.join(queries, ["query_block", "slice", "dims"]).mapInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

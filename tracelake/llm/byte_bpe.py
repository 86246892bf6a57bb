"""Byte-level BPE: encoding by merge replay over the words of many texts together, and decoding.

Texts are cut into words by the vocabulary's pattern. The different words of a block of texts that are not known yet lie one after the other
in one array of symbols, and an inverted index leads from each mergeable pair of tokens (by the rank of what it makes) to the positions where it stands. Ranks
are replayed in order over all words at once: the positions of the lowest rank are merged from left to right, and only the two neighbours of a merged position get
new entries in the index; entries that a merge has made stale are passed over. If a merge makes a pair of a lower rank than the one at work, what is left of
the work goes back to the index, so each word sees its merges in the very order of the library. A word that is in the vocabulary whole is that token.

Words and their ids stay with the worker for its next texts, up to ``TABLE_WORDS``; nothing is shuffled, because a corpus-wide dictionary would have to be joined with
every word of every text to save merges that take less time than the join.

Decoding gathers the tokens' bytes.

Defined cases: a null or empty text has no ids; a text of any length is cut at white space into windows of about ``BLOCK_CHARS`` characters, where no word can span; a single word of any
length is merged in a number of steps that follows its length; repeated rows and ids are rows of their own; an empty table gives an empty table; other columns are ignored; ids outside of the
vocabulary cannot be decoded and raise an error.
"""

from __future__ import annotations

import base64
import functools
from array import array
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import vocabulary_path

#: Characters whose words are replayed together.
BLOCK_CHARS = 1 << 20
#: Words that a worker remembers, and their characters at most; beyond that it starts anew. Costs time only.
TABLE_WORDS = 400_000
TABLE_CHARS = 1 << 24
#: Ids that are decoded at once.
BLOCK_IDS = 1 << 18


def byte_bpe_path() -> str:
    return vocabulary_path("byte_bpe_50k.tiktoken")


def word_pattern() -> str:
    """The pattern whose matches are encoded each for itself."""
    import public_tokenizers

    return public_tokenizers.PATTERN


class Vocabulary:
    """Tokens by rank, which is also their id; all pairs of tokens that make a token."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.shift = max(self.tokens).bit_length()
        self.single = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.made: dict[int, int] = {}  # left token << shift | right token -> rank of both together
        first = np.full((256, 256), -1, dtype=np.int32)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                first[token[0], token[1]] = rank
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.made[left << self.shift | right] = rank
        self.first = first
        size = max(self.tokens) + 1
        self.sizes = np.zeros(size, dtype=np.int64)
        for rank, token in self.tokens.items():
            self.sizes[rank] = len(token)
        self.begin = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(self.tokens.get(r, b"") for r in range(size)), dtype=np.uint8)

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words, none empty, one after the other, and how many each word has."""
        data = np.frombuffer(b"".join(words), dtype=np.uint8)
        stops = np.cumsum([len(w) for w in words])
        symbols = array("i", self.single[data].tobytes())
        after = np.arange(1, len(data) + 1, dtype=np.int32)
        after[stops - 1] = -1
        before = np.arange(-1, len(data) - 1, dtype=np.int32)
        before[np.concatenate((np.zeros(1, dtype=np.int64), stops[:-1]))] = -1
        rank = self.first[data[:-1], data[1:]]
        rank[stops[:-1] - 1] = -1
        index = _by_rank(rank)
        self._merge(symbols, array("i", after.tobytes()), array("i", before.tobytes()), index)
        left = np.frombuffer(symbols, dtype=np.int32)
        alive = left >= 0
        return left[alive], np.add.reduceat(alive, np.concatenate((np.zeros(1, dtype=np.int64), stops[:-1])), dtype=np.int64)

    def _merge(self, symbols: array, after: array, before: array, index: dict[int, array]) -> None:
        """Replay all merges; a symbol that was joined to its left neighbour becomes -1."""
        made, shift = self.made.get, self.shift
        ranks = list(index)
        heapify(ranks)
        while ranks:
            rank = heappop(ranks)
            places = sorted(index.pop(rank))
            for done, at in enumerate(places, 1):
                left, right = symbols[at], after[at]
                if left < 0 or right < 0 or made(left << shift | symbols[right]) != rank:
                    continue  # stale
                symbols[at], symbols[right] = rank, -1
                next_ = after[at] = after[right]
                lower = False
                if next_ >= 0:
                    before[next_] = at
                    new = made(rank << shift | symbols[next_])
                    if new is not None:
                        _enter(index, ranks, new, at)
                        lower = new < rank
                last = before[at]
                if last >= 0:
                    new = made(symbols[last] << shift | rank)
                    if new is not None:
                        _enter(index, ranks, new, last)
                        lower = lower or new < rank
                if lower:
                    for place in places[done:]:
                        _enter(index, ranks, rank, place)
                    break

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the tokens one after the other."""
        parts = []
        for at in range(0, len(ids), BLOCK_IDS):
            part = np.asarray(ids[at : at + BLOCK_IDS], dtype=np.int64)
            if len(part) and (part.min() < 0 or part.max() >= len(self.sizes) or not self.sizes[part].all()):
                raise ValueError("an id is not in the vocabulary")
            sizes = self.sizes[part]
            ends = np.cumsum(sizes)
            parts.append(self.data[np.arange(ends[-1]) + np.repeat(self.begin[part] - ends + sizes, sizes)].tobytes())
        return b"".join(parts)


def _by_rank(rank: np.ndarray) -> dict[int, array]:
    """The positions of each rank of 0 or more."""
    order = np.argsort(rank, kind="stable").astype(np.int32)
    order = order[np.searchsorted(rank[order], 0) :]
    if not len(order):
        return {}
    cuts = np.flatnonzero(np.diff(rank[order])) + 1
    return {int(rank[places[0]]): array("i", places.tobytes()) for places in np.split(order, cuts)}


def _enter(index: dict[int, array], ranks: list[int], rank: int, place: int) -> None:
    places = index.get(rank)
    if places is None:
        index[rank] = array("i", (place,))
        heappush(ranks, rank)
    else:
        places.append(place)


@functools.lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes texts; words once merged are kept."""

    def __init__(self, path: str, pattern: str):
        import regex

        self.vocabulary = vocabulary(path)
        self.cut = regex.compile(pattern).findall
        self.breaks = regex.compile(r"(?<=\S)\s")
        self._clear()

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.chars = 0
        self.begin = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.int32)

    def windows(self, text: str) -> Iterator[str]:
        """A text in parts of about ``BLOCK_CHARS``; each but the first begins with white space that follows something else."""
        at = 0
        while len(text) - at > BLOCK_CHARS and (found := self.breaks.search(text, at + BLOCK_CHARS)):
            yield text[at : found.start()]
            at = found.start()
        yield text[at:] if at else text

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """The ids of each text."""
        parts: list[list[np.ndarray]] = []
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for row, text in enumerate(texts):
            parts.append([])
            for window in self.windows(text or ""):
                if waiting and size + len(window) > BLOCK_CHARS:
                    self._flush(waiting, parts)
                    waiting, size = [], 0
                waiting.append((row, self.cut(window)))
                size += len(window)
        self._flush(waiting, parts)
        return [p[0] if len(p) == 1 else np.concatenate(p) for p in parts]

    def _flush(self, waiting: list[tuple[int, list[str]]], parts: list[list[np.ndarray]]) -> None:
        if len(self.known) > TABLE_WORDS or self.chars > TABLE_CHARS:
            self._clear()
        new = {w for _, words in waiting for w in words if w not in self.known}
        if new:
            self._learn(list(new))
        known = self.known
        for row, words in waiting:
            rows = np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words))
            count = self.count[rows]
            ends = np.cumsum(count)
            total = int(ends[-1]) if len(ends) else 0
            parts[row].append(self.ids[np.arange(total) + np.repeat(self.begin[rows] - ends + count, count)])

    def _learn(self, words: list[str]) -> None:
        data = [w.encode("utf-8", "surrogatepass") for w in words]
        whole = [self.vocabulary.ranks.get(d, -1) for d in data]
        merged = [i for i, rank in enumerate(whole) if rank < 0]
        direct = [i for i, rank in enumerate(whole) if rank >= 0]
        ids, count = np.array([whole[i] for i in direct], dtype=np.int32), np.ones(len(direct), dtype=np.int64)
        if merged:
            replayed, counts = self.vocabulary.replay([data[i] for i in merged])
            ids, count = np.concatenate((ids, replayed)), np.concatenate((count, counts))
        begin = len(self.ids) + np.cumsum(count) - count
        at = len(self.known)
        self.known.update((words[i], at + k) for k, i in enumerate(direct + merged))
        self.chars += sum(map(len, words))
        self.ids = np.concatenate((self.ids, ids))
        self.begin, self.count = np.concatenate((self.begin, begin)), np.concatenate((self.count, count))


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """``doc_id, ids`` of each row of ``docs`` (``doc_id, text``)."""
    path, pattern = path or byte_bpe_path(), pattern or word_pattern()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = encoder(path, pattern).encode(batch.column("text").to_pylist())
            offsets = np.concatenate((np.zeros(1, dtype=np.int32), np.cumsum([len(x) for x in found], dtype=np.int32)))
            ids = pa.ListArray.from_arrays(offsets, np.concatenate([*found, np.zeros(0, dtype=np.int32)]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """``encoded`` (``doc_id, ids``) with ``data``, the bytes that the ids stand for."""
    path = path or byte_bpe_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("ids")
            data = [vocabulary(path).decode(np.asarray(x.values) if x.is_valid else np.zeros(0)) for x in ids]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids, pa.array(data, pa.binary())], ["doc_id", "ids", "data"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids array<int>, data binary")


def byte_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of each row: digests of its ids and of what they decode to."""
    both = decode(encode(docs, path), path)
    decimal = F.array_join(F.col("ids").cast("array<string>"), " ")
    return both.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal, 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))

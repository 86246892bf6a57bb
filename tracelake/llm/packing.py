"""Best-fit packing of token sequences with a bounded number of open bins.

Documents become token ids (by the tokenizer, then id ``END``); only longer ones than ``CAPACITY`` are cut. Pieces go, in the order of a hash, to the open bin
with the least free space that still holds them. A bitset with a bit for each amount of free space finds that bin in a
few word operations. ``OPEN_BINS`` bins are open at most; when another is needed, the fullest closes first.

Pieces are dealt to groups of about ``GROUP_TOKENS`` tokens by a hash, and each group is packed by one task. What a group leaves open is at
most ``OPEN_BINS`` bins, of which any two together hold more than one bin would.

Words are encoded once for each batch and kept in a bounded table, so the ids are the tokenizer's own while the time follows the number of different words. Texts that
the tables of ``words`` can't cut are encoded whole.

Defined cases: a null or empty text is the one id ``END``; rows that share an id are packed as documents of their own; an empty
table gives no piece; other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import Words, split_words, tokenizer, vocabulary_path

CAPACITY = 4096
END = 1
OPEN_BINS = 2048
GROUP_TOKENS = 1 << 26
#: Different words that a worker remembers; beyond that it starts anew. Costs time only.
TABLE_WORDS = 1_000_000


class WordIds:
    """The token ids of words, by their hashes."""

    def __init__(self, path: str):
        self.path = path
        self.clear()

    def clear(self) -> None:
        self.known = np.zeros(0, dtype=np.uint64)
        self.begin = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.ids = np.zeros(0, dtype=np.uint32)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and where each text's ids begin."""
        different, one, place = np.unique(words.hashes, return_index=True, return_inverse=True)
        if len(self.known) > TABLE_WORDS:
            self.clear()
        new = ~np.isin(different, self.known, assume_unique=True)
        if new.any():
            self._learn(different[new], [words.word(i) for i in one[new].tolist()])
        row = np.searchsorted(self.known, different)[place]
        count = self.count[row]
        cuts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(count)))
        at = np.arange(cuts[-1]) + np.repeat(self.begin[row] - cuts[:-1], count)
        return self.ids[at], cuts[words.cuts]

    def _learn(self, hashes: np.ndarray, words: list[str]) -> None:
        found = [e.ids for e in tokenizer(self.path).encode_batch_fast(words, add_special_tokens=False)]
        count = np.array([len(x) for x in found], dtype=np.int64)
        begin = len(self.ids) + np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(count)))[:-1]
        self.ids = np.concatenate((self.ids, np.array([i for x in found for i in x], dtype=np.uint32)))
        order = np.argsort(np.concatenate((self.known, hashes)), kind="stable")
        self.known = np.concatenate((self.known, hashes))[order]
        self.begin = np.concatenate((self.begin, begin))[order]
        self.count = np.concatenate((self.count, count))[order]


_tables: dict[str, WordIds] = {}


def document_ids(texts, path: str) -> Iterator[np.ndarray]:
    """Each text's token ids and the end, in order."""
    table = _tables.setdefault(path, WordIds(path))
    end = np.array([END], dtype=np.uint32)
    for block in split_words(texts, path):
        if isinstance(block, tuple):
            ids = tokenizer(path).encode(block[1], add_special_tokens=False).ids
            yield np.append(np.array(ids, dtype=np.uint32), end)
            continue
        ids, cuts = table.of(block)
        for at, stop in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            yield np.append(ids[at:stop], end)


def pieces(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids`` of each piece of each row of ``docs``."""
    path = path or vocabulary_path()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, ids in zip(batch["doc_id"], document_ids(batch["text"], path), strict=True):
                for number, start in enumerate(range(0, len(ids), CAPACITY)):
                    data = ids[start : start + CAPACITY].astype("<u4").tobytes()
                    rows.append((doc_id, number, start, len(data) // 4, zlib.crc32(data), data))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32", "ids"]).astype({"doc_id": "Int64"})

    return docs.select("doc_id", "text").mapInPandas(cut, "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary")


class BestFit:
    """Places lengths one after the other; ``open_bins`` bins at most are open."""

    def __init__(self, capacity: int = CAPACITY, open_bins: int = OPEN_BINS):
        self.capacity, self.open_bins = capacity, open_bins
        self.bits, self.open, self.made = 0, 0, 0
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _take(self, free: int) -> int:
        stack = self.bins[free]
        number = stack.pop()
        if not stack:
            self.bits &= ~(1 << free)
        self.open -= 1
        return number

    def place(self, length: int) -> tuple[int, int]:
        """The bin and the offset in it."""
        fitting = self.bits >> length
        if fitting:
            free = length + (fitting & -fitting).bit_length() - 1
            number = self._take(free)
        else:
            free, number = self.capacity, self.made
            self.made += 1
        left = free - length
        if left:
            if self.open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            self.bins[left].append(number)
            self.bits |= 1 << left
            self.open += 1
        return number, self.capacity - free


def place_pieces(cut: DataFrame) -> DataFrame:
    """``cut`` (stored: it is read twice) with ``sequence_id`` and ``offset``; its columns need ``doc_id, piece, start, length``."""
    total = cut.agg(F.sum("length")).first()[0] or 0
    groups = max(1, math.ceil(total / GROUP_TOKENS))
    columns = [c for c in cut.columns if c != "ids"]
    order = F.xxhash64(*columns)
    dealt = cut.select(*columns, F.pmod(order, F.lit(groups)).alias("_group"))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["ids_crc32", "doc_id", "piece"], kind="stable", ignore_index=True)
        fit = BestFit()
        placed = np.array([fit.place(n) for n in group["length"].tolist()], dtype=np.int64).reshape(-1, 2)
        return group[columns].assign(sequence_id=group["_group"] * (1 << 40) + placed[:, 0], offset=placed[:, 1])

    schema = ", ".join(f"{c} {cut.schema[c].dataType.simpleString()}" for c in columns)
    return dealt.groupBy("_group").applyInPandas(pack, f"{schema}, sequence_id long, offset long")


def pack_documents(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for each piece."""
    return place_pieces(materialize(pieces(docs, path).drop("ids"), "pieces"))

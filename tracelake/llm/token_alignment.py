"""Alignment of two tokenizers' tokens over the same texts, and how well each link is borne out by the corpus.

A text's tokens of both tokenizers are laid out by the bytes they stand for. Offsets where a token of either ends cut the text into groups; every two tokens of a group are linked.

The two lists of ends are merged in lockstep: one state vector holds a pointer into each list, the start of the open group and where to stop, for all documents of a block together (a long
document has a lane for each ``LANE_BYTES`` bytes). A step compares the ends under all pointers, emits a cut and the links of its group where they are equal, moves the pointer with the
smaller end, and takes finished lanes out of the vector. Links are emitted as ranges of tokens. Large groups become pairs of different ids with how often they occur, never pairs of
occurrences.

How many documents hold a pair of ids linked is counted over the corpus. Documents are gathered in blocks of about ``BLOCK_BYTES`` bytes of text: a pair is shuffled once for each block, with its
number of documents there, joined with its total, and goes back to the block as a dictionary. So no key has more rows than there are blocks. The highest count of each A id is a
row for each entry of the A vocabulary at most, and is broadcast.

Defined cases: a null or empty text, and one that either tokenizer does not give back byte by byte, has no tokens, groups or links, and an empty string of groups; strings of
special tokens are plain text; a text of any length is tokenized in windows cut at white space, where no token of either tokenizer spans; repeated rows and ids are documents of their own; an
empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .byte_bpe import word_pattern
from .token_count import byte_characters
from .words import tokenizer, vocabulary_path

#: Bytes of a document that one lane merges.
LANE_BYTES = 2048
#: Bytes of text that are merged together.
MERGE_BYTES = 1 << 20
#: Bytes of text whose pairs make a block.
BLOCK_BYTES = 1 << 23
#: Characters of a text that are tokenized at once.
WINDOW_CHARS = 1 << 20
#: Links of a group that are listed one by one; those of a larger one are counted by id first.
LISTED_LINKS = 256

_LONG_SPACE = re.compile(r"\s{5000}")
_BREAK = re.compile(r"(?<=[^\s]) ")


class ByteTokens:
    """A byte-level vocabulary: ids of a blank and a text, and the bytes of each id."""

    def __init__(self, path: str):
        self.library = tokenizer(path)
        self.library.encode_special_tokens = True
        byte_of = {c: b for b, c in enumerate(byte_characters())}
        self.bytes = [b""] * self.library.get_vocab_size()
        for token, i in self.library.get_vocab(with_added_tokens=False).items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        self.sizes = np.array([len(x) for x in self.bytes], dtype=np.int64)
        self.by_rank = self._by_rank(path)

    def _by_rank(self, path: str):
        """An encoder that joins any two tokens whose bytes make a token, lowest id first, where that is sure to be the same; else None.

        If ids follow the order of the merges and each token's own characters are merged to that token, it is: as long as the two ways have
        not differed and no token reaches over the ends of a stretch, its merges are those of the stretch alone. So where the bytes of a token stand as two tokens at the turn of its id, they are
        the two of its merge.
        """
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"] or {}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        alone = all(len(self.library.model.tokenize(token)) == 1 for token in model["vocab"])
        usual = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space") and not spec["normalizer"]
        singles = sorted(i for token, i in model["vocab"].items() if len(token) == 1)
        if not usual or not alone or singles + made != list(range(len(model["vocab"]))):
            return None
        import tiktoken

        ranks = {token: i for i, token in enumerate(self.bytes) if token}
        return tiktoken.Encoding("by rank", pat_str=word_pattern(), mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        if self.by_rank:  # its pattern engine gives up at very long white space
            return [self.by_rank.encode_ordinary(t) if not _LONG_SPACE.search(t) else self.library.encode(t, add_special_tokens=False).ids for t in texts]
        return [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]


class PieceTokens:
    """A vocabulary of pieces; the library itself puts a blank before a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.library.id_to_piece(i) for i in range(self.library.get_piece_size())]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else b"" if self.library.is_control(i) or self.library.is_unknown(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.sizes = np.array([len(x) for x in self.bytes], dtype=np.int64)
        #: No piece holds a blank after something else, so none spans a cut before a single blank.
        self.can_be_cut = not any(re.search("[^▁]▁", p) for p in pieces)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.library.encode(texts, num_threads=1)


@functools.lru_cache(maxsize=2)
def tokenizers(path_a: str, path_b: str) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(path_a), PieceTokens(path_b)


def windows(text: str) -> Iterator[str]:
    """A text cut before blanks that follow something else and precede no white space, without those blanks, as both tokenizers are given one before each window."""
    at = 0
    while len(text) - at > WINDOW_CHARS:
        found = next((m for m in _BREAK.finditer(text, at + WINDOW_CHARS) if not text[m.end() : m.end() + 1].isspace()), None)
        if found is None or found.end() == len(text):
            break
        yield text[at : found.start()]
        at = found.end()
    yield text[at:]


def token_ids(texts: list[str | None], a: ByteTokens, b: PieceTokens) -> list[tuple[np.ndarray, np.ndarray]]:
    """The ids of both tokenizers for each text; none where either doesn't give back a blank and the text."""
    parts = [list(windows(t)) if t and b.can_be_cut else [t] if t else [] for t in texts]
    flat = [p for own in parts for p in own]
    ids_a, ids_b = a.encode([f" {p}" for p in flat]), b.encode(flat)
    out, at = [], 0
    for text, own in zip(texts, parts, strict=True):
        found_a = [i for x in ids_a[at : at + len(own)] for i in x]
        found_b = [i for x in ids_b[at : at + len(own)] for i in x]
        at += len(own)
        whole = f" {text}".encode("utf-8", "surrogatepass") if own else b""
        if b"".join(map(a.bytes.__getitem__, found_a)) != whole or b"".join(map(b.bytes.__getitem__, found_b)) != whole:
            found_a, found_b = [], []
        out.append((np.array(found_a, dtype=np.int32), np.array(found_b, dtype=np.int32)))
    return out


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The groups of two ascending lists of ends: rows ``first A, end A, first B, end B``, in order.

    ``starts`` and ``stops`` are the bytes where each document begins and ends; both lists have an end at each stop.
    """
    lanes = np.maximum(1, -(-(stops - starts) // LANE_BYTES))
    number = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
    begin = np.repeat(starts, lanes) + number * LANE_BYTES
    stop = np.minimum(begin + LANE_BYTES, np.repeat(stops, lanes))
    last = np.iinfo(np.int64).max
    ends_a, ends_b = np.append(ends_a, last), np.append(ends_b, last)
    at_a, at_b = np.searchsorted(ends_a, begin, side="right"), np.searchsorted(ends_b, begin, side="right")
    # A lane inside a document may begin inside a group, whose start is that after the cut before it.
    from_a, from_b = np.where(number, -1, at_a), np.where(number, -1, at_b)
    found = []
    while True:
        end_a, end_b = ends_a[at_a], ends_b[at_b]
        open_ = np.minimum(end_a, end_b) <= stop
        if not open_.all():
            at_a, at_b, from_a, from_b, stop, end_a, end_b = (x[open_] for x in (at_a, at_b, from_a, from_b, stop, end_a, end_b))
            if not len(at_a):
                break
        cut = np.flatnonzero(end_a == end_b)
        found.append(np.stack((from_a[cut], at_a[cut] + 1, from_b[cut], at_b[cut] + 1)))
        at_a, at_b = at_a + (end_a <= end_b), at_b + (end_b <= end_a)
        from_a[cut], from_b[cut] = at_a[cut], at_b[cut]
    groups = np.concatenate(found, axis=1) if found else np.zeros((4, 0), dtype=np.int64)
    groups = groups[:, np.argsort(groups[1], kind="stable")]
    split = np.flatnonzero(groups[0] < 0)
    groups[0, split], groups[2, split] = groups[1, split - 1], groups[3, split - 1]
    return groups


def linked_ids(groups: np.ndarray, of: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, n_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different linked pairs of ids of each document: its number, ``A id * n_b + B id``, and how many links they are."""
    first_a, end_a, first_b, end_b = groups
    size_a, size_b = end_a - first_a, end_b - first_b
    links = size_a * size_b
    listed = np.flatnonzero(links <= LISTED_LINKS)
    count = links[listed]
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    width = np.repeat(size_b[listed], count)
    keys = [ids_a[np.repeat(first_a[listed], count) + at // width].astype(np.int64) * n_b + ids_b[np.repeat(first_b[listed], count) + at % width]]
    docs, times = [np.repeat(of[listed], count)], [np.ones(len(at), dtype=np.int64)]
    for g in np.flatnonzero(links > LISTED_LINKS).tolist():
        a, many_a = np.unique(ids_a[first_a[g] : end_a[g]], return_counts=True)
        b, many_b = np.unique(ids_b[first_b[g] : end_b[g]], return_counts=True)
        keys.append((a.astype(np.int64)[:, None] * n_b + b).ravel())
        times.append((many_a[:, None] * many_b).ravel())
        docs.append(np.full(len(a) * len(b), of[g]))
    docs, keys, times = map(np.concatenate, (docs, keys, times))
    order = np.lexsort((keys, docs))
    docs, keys, times = docs[order], keys[order], times[order]
    new = np.flatnonzero(np.concatenate((np.ones(min(1, len(docs)), dtype=bool), (docs[1:] != docs[:-1]) | (keys[1:] != keys[:-1]))))
    return docs[new], keys[new], np.add.reduceat(times, new) if len(new) else times


@functools.lru_cache(maxsize=4)
def _decimals(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The digits of all numbers of so many bits, with a column for a mark, and which of these count."""
    numbers, columns = np.arange(1 << bits), len(str((1 << bits) - 1))
    powers = 10 ** np.arange(columns - 1, -1, -1)
    digits = np.zeros((len(numbers), columns + 1), dtype=np.uint8)
    digits[:, :columns] = numbers[:, None] // powers % 10 + ord("0")
    shown = np.ones(digits.shape, dtype=bool)
    shown[:, : columns - 1] = numbers[:, None] >= powers[:-1]
    return digits, shown


def group_texts(groups: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, cuts_a: np.ndarray, cuts_b: np.ndarray) -> list[str]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
    first_a, end_a, first_b, end_b = groups
    ids = np.empty(len(ids_a) + len(ids_b), dtype=np.int64)
    mark = np.full(len(ids), ord(","), dtype=np.uint8)
    ids[np.arange(len(ids_a)) + np.repeat(first_b, end_a - first_a)] = ids_a
    ids[np.arange(len(ids_b)) + np.repeat(end_a, end_b - first_b)] = ids_b
    mark[end_a + first_b - 1] = ord("|")
    mark[end_a + end_b - 1] = ord(";")
    table, visible = _decimals(int(ids.max(initial=0)).bit_length())
    digits, shown = table[ids], visible[ids]
    digits[:, -1] = mark
    text = digits[shown].tobytes().decode("ascii")
    ends = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(shown.sum(axis=1))))[cuts_a + cuts_b].tolist()
    return [text[s : max(s, e - 1)] for s, e in zip(ends[:-1], ends[1:], strict=True)]


@dataclass
class Aligned:
    """What the alignment of some texts gives; a row or list item for each text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    pair_cuts: np.ndarray  # where each text's pairs begin, and the end
    pairs: np.ndarray
    times: np.ndarray


def align(texts: list[str | None], a: ByteTokens, b: PieceTokens) -> Aligned:
    """Tokens, groups, links and linked pairs of ids of each text."""
    found = token_ids(texts, a, b)
    n_a, n_b = (np.array([len(x[k]) for x in found], dtype=np.int64) for k in (0, 1))
    ids_a, ids_b = (np.concatenate([x[k] for x in found] + [np.zeros(0, dtype=np.int32)]) for k in (0, 1))
    cuts_a, cuts_b = (np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(n))) for n in (n_a, n_b))
    ends_a, ends_b = np.cumsum(a.sizes[ids_a]), np.cumsum(b.sizes[ids_b])
    full = np.flatnonzero(n_a)
    bytes_at = np.concatenate((np.zeros(1, dtype=np.int64), ends_a))
    groups = lockstep(ends_a, ends_b, bytes_at[cuts_a[full]], bytes_at[cuts_a[full + 1]])
    of = np.searchsorted(cuts_a, groups[0], side="right") - 1
    docs, pairs, times = linked_ids(groups, of, ids_a, ids_b, len(b.bytes))
    links = (groups[1] - groups[0]) * (groups[3] - groups[2])
    n_links = np.zeros(len(texts), dtype=np.int64)
    np.add.at(n_links, of, links)
    return Aligned(
        n_a, n_b, np.bincount(of, minlength=len(texts)), n_links, group_texts(groups, ids_a, ids_b, cuts_a, cuts_b),
        np.searchsorted(docs, np.arange(len(texts) + 1)), pairs, times,
    )


def _paths(path_a: str | None, path_b: str | None) -> tuple[str, str]:
    return path_a or vocabulary_path("byte_bpe_50k.json"), path_b or vocabulary_path("piece_bpe_32k.model")


def alignments(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times, block`` of each row of ``docs`` (``doc_id, text``).

    ``groups`` is the alignment itself as text; ``pairs`` are the different linked pairs (``A id * size of B + B id``) and ``times`` their numbers of links; ``block`` numbers the
    block of documents that a row belongs to.
    """
    paths = _paths(path_a, path_b)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, filled = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            texts, ids = batch.column("text").to_pylist(), batch.column("doc_id")
            sizes = np.array([len(t) if t else 0 for t in texts], dtype=np.int64)
            first = 0
            while first < len(texts):
                end = first + max(1, int(np.searchsorted(np.cumsum(sizes[first:]), MERGE_BYTES)))
                x = align(texts[first:end], *tokenizers(*paths))
                cuts = pa.array(x.pair_cuts.astype(np.int32))
                columns = [ids.slice(first, end - first), *map(pa.array, (x.n_a, x.n_b, x.n_groups, x.n_links)), pa.array(x.groups)]
                columns += [pa.ListArray.from_arrays(cuts, pa.array(v)) for v in (x.pairs, x.times.astype(np.int32))]
                columns.append(pa.array(np.full(end - first, block)))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times", "block"])
                filled += int(sizes[first:end].sum())
                if filled >= BLOCK_BYTES:
                    block, filled = block + 1, 0
                first = end

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>, block long"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)


def pair_counts(block_pairs: DataFrame, n_b: int) -> DataFrame:
    """``pair, n_docs, best`` from ``(block, pair, n)``: documents with the pair, and whether no other pair of its A id has more."""
    counts = block_pairs.groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn("a", F.expr(f"pair div {n_b}"))
    highest = counts.groupBy("a").agg(F.max("n_docs").alias("most"))  # as many rows as the A vocabulary at most
    return counts.join(F.broadcast(highest), "a").select("pair", "n_docs", (F.col("n_docs") == F.col("most")).alias("best"))


def _scored(key: tuple, docs: pa.Table, counts: pa.Table) -> pa.Table:
    """The documents of a block with ``n_best`` and ``count_sum``, from the counts of the block's pairs."""
    pairs, n_docs, best = (counts.column(c).to_numpy() for c in ("pair", "n_docs", "best"))
    order = np.argsort(pairs)
    lists = docs.column("pairs").combine_chunks()
    own, times = lists.flatten().to_numpy(), docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
    ends = np.cumsum(np.concatenate((np.zeros(1, dtype=np.int64), lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64))))
    row = order[np.searchsorted(pairs[order], own)] if len(own) else np.zeros(0, dtype=np.int64)

    def sums(values: np.ndarray) -> pa.Array:
        total = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(values, dtype=np.int64)))
        return pa.array(total[ends[1:]] - total[ends[:-1]])

    kept = docs.drop_columns(["pairs", "times", "block"])
    return kept.append_column("n_best", sums(times * best[row])).append_column("count_sum", sums(times * n_docs[row]))


def token_alignment(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, groups_sha256, n_best, count_sum`` of each row of ``docs``."""
    paths = _paths(path_a, path_b)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    found = alignments(docs, *paths).select("doc_id", "n_a", "n_b", "n_groups", "n_links", digest, "pairs", "times", "block")
    stored = materialize(found, "alignments")
    listed = materialize(stored.select("block", F.explode("pairs").alias("pair")).groupBy("block", "pair").agg(F.count("*").alias("n")), "block-pairs")
    counted = listed.select("block", "pair").join(pair_counts(listed, len(tokenizers(*paths)[1].bytes)), "pair").select("block", "pair", "n_docs", "best")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    return stored.groupBy("block").cogroup(counted.groupBy("block")).applyInArrow(_scored, schema)

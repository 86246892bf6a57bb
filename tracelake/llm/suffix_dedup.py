"""Removal of repeated byte strings by suffix arrays.

A byte of a document goes if some string of ``LENGTH`` bytes that covers it also starts in a document with
a smaller id. The work is dealt out so that equal strings meet in one place:

1. Every string of ``LENGTH`` bytes has an anchor: the ``GRAM``-byte gram in it with the smallest hash, the
   leftmost of equals. Equal strings have equal anchors, and consecutive strings mostly share theirs, so a text has
   about one anchor for every 16 bytes. Anchor hashes are dealt to buckets; those seen in one document only are done.
2. Around each other anchor the text goes, with the string starts that have this anchor, to the anchor's bucket.
   Equal pieces of a batch are sent once.
3. A bucket's pieces are taken in shards of ``SHARD_PIECES``. Each shard gets a suffix array (ranks by eight
   bytes, refined by doubling as Larsson and Sadakane do, only for suffixes that are still tied), and common prefixes of neighbours
   in it as Kasai's array has them, which part the strings into classes. The shards of a bucket are merged by binary
   search of each one's sorted strings in the others.
4. A string that has a smaller document in its class marks its bytes.

Documents with equal texts are found beforehand: all but the first go whole (from ``LENGTH`` bytes on), and only the first takes part
above, which changes no result, as it has the smallest id.

Defined cases: a null text counts as empty; a row without ``doc_id`` takes no part and stays whole; rows with
one id never remove from each other; texts shorter than ``LENGTH`` stay whole; other columns are ignored by
``without_repeats`` and kept by ``cut_repeats``; an empty table gives an empty result.
"""

from __future__ import annotations

import ctypes
import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BYTE_VALUES, small_batches, span_hashes

LENGTH = 50
GRAM = 20
SPREAD = LENGTH - GRAM  # a string's anchor starts at most so many bytes after it
#: Text for each bucket of anchors. Sets the number of buckets; results don't depend on it.
BUCKET_BYTES = 4 << 20
PIECE_BUCKETS = 4  # buckets of pieces for each bucket of anchors
SHARD_PIECES = 30_000
#: Text from which hashes or pieces are gathered before they are sent; bounds a worker's memory, results don't depend on it.
SLICE_BYTES = 8 << 20
#: Bytes of a text, or of the pieces of a bucket, that are hashed at once; at most ``_POSITION``. Bounds memory, results don't depend on it.
WINDOW = 1 << 18
_BATCH_ROWS = 1 << 16
_WHOLE = -1
_POSITION = np.uint64((1 << 28) - 1)
_BASE = 0xC2B2AE3D27D4EB4F


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a text: each anchor's place, its hash, and the first and last string start that has it.

    The strings are taken in windows of ``WINDOW`` starts; an anchor of strings on both sides of a window's edge is put together again.
    """
    strings = len(data) - LENGTH + 1
    if strings <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none.astype(np.uint64), none, none
    parts = []
    for at in range(0, strings, WINDOW):
        place, gram, first, last = _window_anchors(data[at : at + WINDOW + LENGTH - 1])
        parts.append((place + at, gram, first + at, last + at))
    if len(parts) == 1:
        return parts[0]
    place, gram, first, last = (np.concatenate(p) for p in zip(*parts, strict=True))
    new = np.concatenate((np.ones(1, dtype=bool), place[1:] != place[:-1]))
    return place[new], gram[new], first[new], last[np.append(new[1:], True)]


def _window_anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    strings = len(data) - LENGTH + 1
    one = BYTE_VALUES[data]
    powers = {n: np.uint64(pow(_BASE, n, 1 << 64)) for n in (1, 2, 4, 8)}
    two = one[:-1] * powers[1] + one[1:]
    four = two[:-2] * powers[2] + two[2:]
    eight = four[:-4] * powers[4] + four[4:]
    sixteen = eight[:-8] * powers[8] + eight[8:]
    n = len(data) - GRAM + 1
    gram = sixteen[:n] * powers[4] + four[16 : 16 + n]
    gram ^= gram >> np.uint64(32)
    gram *= np.uint64(0x9FB21C651E98DF25)
    gram ^= gram >> np.uint64(35)
    low = (gram & ~_POSITION) | np.arange(n, dtype=np.uint64)
    for step in (1, 2, 4, 8):  # the smallest of 16
        low = np.minimum(low[:-step], low[step:])
    place = (np.minimum(low[:strings], low[15 : 15 + strings]) & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.concatenate((np.ones(1, dtype=bool), place[1:] != place[:-1])))
    last = np.concatenate((first[1:] - 1, np.array([strings - 1])))
    return place[first], gram[place[first]], first, last


def _trimmed(rows: pd.DataFrame) -> pd.DataFrame:
    """Gives what a group's arrays have left free back to the system, where the C library can."""
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    return rows


def _piece_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """``span_hashes`` of the bytes of short pieces in order of ``start``, a window at a time."""
    found = np.empty(len(start), dtype=np.uint64)
    at = 0
    while at < len(start):
        base = int(start[at])
        to = int(np.searchsorted(start, base + WINDOW))
        found[at:to] = span_hashes(BYTE_VALUES[data[base : int(end[to - 1])]], start[at:to] - base, end[at:to] - base)
        at = to
    return found


def packed(values: np.ndarray) -> bytes:
    """Numbers as a small blob: differences, split into planes of bytes, compressed."""
    step = np.diff(values, prepend=values[:1] * 0)
    planes = np.ascontiguousarray(step.view(np.uint8).reshape(len(values), values.itemsize).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpacked(blob: bytes, dtype: type) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8).reshape(np.dtype(dtype).itemsize, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view(dtype).ravel(), dtype=dtype)


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The same rows in batches of about ``SLICE_BYTES`` of text."""
    held, size, rows = [], 0, 0
    for batch in batches:
        for at in range(0, len(batch), _BATCH_ROWS):
            part = batch.iloc[at : at + _BATCH_ROWS]
            n = sum(len(t) for t in part["text"] if isinstance(t, str))
            if held and (size + n > SLICE_BYTES or rows + len(part) > _BATCH_ROWS):
                yield pd.concat(held, ignore_index=True)
                held, size, rows = [], 0, 0
            held.append(part)
            size, rows = size + n, rows + len(part)
    if held:
        yield pd.concat(held, ignore_index=True)


def _deal_anchors(bits: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A row for each batch and bucket: an entry for each anchor hash, and hits already sure."""

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            batch = batch.sort_values("doc_id")  # ids in order make the smaller blob
            ids = batch["doc_id"].to_numpy(dtype=np.int64)
            found = []
            for i, text in enumerate(batch["text"]):
                hashes = anchors(np.frombuffer(_bytes(text), dtype=np.uint8))[1]
                found.append((hashes & ~np.uint64(0xFFFF)) | np.uint64(i))
            entries = np.unique(np.concatenate(found)) if found else np.zeros(0, dtype=np.uint64)
            if not len(entries):
                continue
            hashes = entries >> np.uint64(16)
            new = np.concatenate((np.ones(1, dtype=bool), hashes[1:] != hashes[:-1]))
            several = ~new
            several[:-1] |= ~new[1:]
            cuts = np.searchsorted(entries, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else np.zeros(1, dtype=np.int64)
            cuts = np.append(cuts, len(entries))
            rows, all_ids = {"bucket": [], "entries": [], "ids": [], "hits": []}, packed(ids)
            for bucket in range(1 << bits):
                part = slice(cuts[bucket], cuts[bucket + 1])
                if part.start == part.stop:
                    continue
                sure = entries[part][several[part]]
                rows["bucket"].append(bucket)
                rows["entries"].append(packed(entries[part][new[part]]))
                rows["ids"].append(all_ids)
                rows["hits"].append(packed(sure))
            yield pd.DataFrame(rows)

    return deal


def _shared_anchors(bucket: pd.DataFrame) -> pd.DataFrame:
    """``doc_id, h`` for the anchors of a bucket that are in several documents; 32 bits tell the anchors of one document apart."""
    entries, ids, sure_entries, sure_ids = [], [], [], []
    for row in bucket.itertuples():
        own = unpacked(row.ids, np.int64)
        for blob, to, to_ids in ((row.entries, entries, ids), (row.hits, sure_entries, sure_ids)):
            values = unpacked(blob, np.uint64)
            to.append(values >> np.uint64(16))
            to_ids.append(own[(values & np.uint64(0xFFFF)).astype(np.int64)])
    hashes, docs = np.concatenate(entries), np.concatenate(ids)
    order = np.argsort(hashes, kind="stable")
    hashes, docs = hashes[order], docs[order]
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = hashes[1:] == hashes[:-1]
    same[:-1] |= same[1:]
    found = {"doc_id": np.concatenate([docs[same], *sure_ids]), "h": np.concatenate([hashes[same], *sure_entries]).astype(np.uint32).view(np.int32)}
    del entries, ids, sure_entries, sure_ids, hashes, docs, order
    return _trimmed(pd.DataFrame(found))


def _deal_pieces(bits: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """A row for each batch and bucket: different pieces, and where each of them occurs.

    A use names the text only where rows with one id have several texts; else 0 stands for it.
    """

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _slices(batches):
            parts = []
            for i, (text_id, text, shared, copies) in enumerate(zip(batch["text_id"], batch["text"], batch["hashes"], batch["copies"], strict=True)):
                if copies is not None and text_id in copies:
                    continue
                data = np.frombuffer(_bytes(text), dtype=np.uint8)
                _, hashes, first, last = anchors(data)
                wanted = np.isin((hashes >> np.uint64(16)).astype(np.uint32), np.asarray(shared, dtype=np.int32).view(np.uint32))
                if wanted.any():
                    hashes, first, last = hashes[wanted], first[wanted], last[wanted]
                    keys = _piece_hashes(data, first, last + LENGTH) ^ hashes
                    parts.append((i, data, hashes, first, last, keys))
            if parts:
                yield from _piece_rows(parts, bits, batch)

    return deal


def _piece_rows(parts: list, bits: int, batch: pd.DataFrame) -> Iterator[pd.DataFrame]:
    base = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum([len(p[1]) for p in parts])))
    data = np.concatenate([p[1] for p in parts])
    owner = np.repeat([p[0] for p in parts], [len(p[2]) for p in parts])
    anchor, first, last, key = (np.concatenate([p[k] for p in parts]) for k in (2, 3, 4, 5))
    start = first + np.repeat(base[:-1], [len(p[2]) for p in parts])
    size = last - first + LENGTH
    bucket = (anchor >> np.uint64(64 - bits)).astype(np.int64)
    _, one, same = np.unique(key, return_index=True, return_inverse=True)
    ids, texts = batch["doc_id"].to_numpy(dtype=np.int64), np.where(batch["several"], batch["text_id"], 0)
    by_bucket = np.argsort(bucket[one], kind="stable")
    piece_cuts = np.searchsorted(bucket[one][by_bucket], np.arange((1 << bits) + 1))
    number = np.empty(len(one), dtype=np.int64)
    number[by_bucket] = np.arange(len(one))
    uses = np.argsort(number[same], kind="stable")
    use_cuts = np.searchsorted(number[same][uses], piece_cuts)
    rows = {c: [] for c in ("bucket", "sizes", "data", "piece", "docs", "texts", "starts")}
    squeeze = zstandard.ZstdCompressor(level=3).compress
    for b in range(1 << bits):
        mine = one[by_bucket[piece_cuts[b] : piece_cuts[b + 1]]]
        if not len(mine):
            continue
        used = uses[use_cuts[b] : use_cuts[b + 1]]
        rows["bucket"].append(b)
        rows["sizes"].append(size[mine].astype(np.uint8).tobytes())
        rows["data"].append(squeeze(_gather(data, start[mine], size[mine])[0].tobytes()))
        rows["piece"].append(packed((number[same[used]] - piece_cuts[b]).astype(np.int32)))
        rows["docs"].append(packed(ids[owner[used]]))
        rows["texts"].append(packed(texts[owner[used]]))
        rows["starts"].append(packed(first[used].astype(np.int32)))
    yield pd.DataFrame(rows)


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pieces one after the other, and where each begins."""
    cuts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(size)))
    return data[np.arange(cuts[-1]) + np.repeat(start - cuts[:-1], size)], cuts


def suffix_ranks(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """The rank of each suffix by its first ``depth`` bytes; equal up to there, equal rank.

    ``ends``: for each place, the end of its piece. Only suffixes with ``depth`` bytes in their piece get a rank, others -1.
    Ranks by eight bytes are refined by doubling; a suffix that is alone with its rank is settled.
    """
    n = len(data)
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    key = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        key <<= np.uint64(8)
        key |= padded[j : j + n]
    have, room = 8, (ends - np.arange(n)).astype(np.int32)
    at = np.flatnonzero(room >= have)
    rank = np.full(n, -1, dtype=np.int32)  # a shard has far less than 2**31 bytes
    rank[at] = _ranked(key[at])
    del key, padded
    while have < depth:
        step = min(have, depth - have)
        at = np.flatnonzero(room >= have + step)
        tied = np.bincount(rank[at])[rank[at]] > 1
        ask = at[tied]
        finer = rank.copy()
        finer[(room < have + step)] = -1
        # A rank is the number of suffixes before its class, so classes can be split in place.
        pair = rank[ask].astype(np.uint64) << np.uint64(32) | rank[ask + step].astype(np.uint64)
        order = np.argsort(pair)
        sorted_pair, group = pair[order], rank[ask][order]
        new_group = np.concatenate((np.ones(1, dtype=bool), group[1:] != group[:-1])) if len(group) else np.zeros(0, dtype=bool)
        new_pair = np.concatenate((np.ones(1, dtype=bool), sorted_pair[1:] != sorted_pair[:-1])) if len(group) else new_group
        index = np.arange(len(group))
        begin = np.maximum.accumulate(np.where(new_group, index, 0))
        within = np.maximum.accumulate(np.where(new_pair, index, 0)) - begin
        finer[ask[order]] = group + within
        rank, have = finer, have + step
    return rank


def _ranked(key: np.ndarray) -> np.ndarray:
    """For each key the number of smaller ones."""
    order = np.argsort(key)
    new = np.concatenate((np.ones(1, dtype=bool), key[order][1:] != key[order][:-1])) if len(key) else np.zeros(0, dtype=bool)
    out = np.empty(len(key), dtype=np.int64)
    out[order] = np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))
    return out


def common_prefixes(data: np.ndarray, suffixes: np.ndarray, limit: int) -> np.ndarray:
    """For sorted suffixes, how many bytes each has in common with the one before, up to ``limit``.

    Kasai's array; instead of one byte after the other all pairs are compared together, and pairs drop out at their first difference.
    """
    common = np.zeros(len(suffixes), dtype=np.int64)
    open_ = np.arange(1, len(suffixes))
    for j in range(limit):
        open_ = open_[data[suffixes[open_] + j] == data[suffixes[open_ - 1] + j]]
        if not len(open_):
            break
        common[open_] = j + 1
    return common


def string_classes(data: np.ndarray, cuts: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a shard: the string starts in suffix order, the class of each, where each class begins, and its smallest document."""
    size = np.diff(cuts)
    ends = np.repeat(cuts[1:], size)
    rank = suffix_ranks(data, ends, LENGTH)
    starts = np.flatnonzero(rank >= 0)
    order = starts[np.argsort(rank[starts], kind="stable")]
    new = common_prefixes(data, order, LENGTH) < LENGTH
    begin = np.flatnonzero(new)
    owner = np.repeat(np.arange(len(size)), size)
    smallest = np.minimum.reduceat(docs[owner[order]], begin) if len(order) else docs[:0]
    return order, np.cumsum(new) - 1, begin, smallest


def _mark(bucket: pd.DataFrame) -> pd.DataFrame:
    """``doc_id, text_id, mark``: a mark is a start in the upper and a mask in the lower 31 bits; bit j tells that the string at ``start + j`` has a smaller document."""
    pieces, uses, count = [], [], 0
    for row in bucket.itertuples():
        size = np.frombuffer(row.sizes, dtype=np.uint8).astype(np.int64)
        pieces.append((size, np.frombuffer(zstandard.ZstdDecompressor().decompress(row.data), dtype=np.uint8)))
        uses.append((unpacked(row.piece, np.int32) + count, unpacked(row.docs, np.int64), unpacked(row.texts, np.int64), unpacked(row.starts, np.int32)))
        count += len(size)
    size, data = (np.concatenate([p[k] for p in pieces]) for k in range(2))
    piece, docs, texts, starts = (np.concatenate([u[k] for u in uses]) for k in range(4))
    ends = np.cumsum(size)
    _, one, same = np.unique(_piece_hashes(data, ends - size, ends), return_index=True, return_inverse=True)
    piece = same[piece]
    smallest = np.full(len(one), np.iinfo(np.int64).max)
    np.minimum.at(smallest, piece, docs)
    least = _least_by_string(data, (ends - size)[one], size[one], smallest)  # pieces x (SPREAD + 1)
    mask = np.empty(len(piece), dtype=np.int64)
    for at in range(0, len(piece), _BATCH_ROWS):
        part = slice(at, at + _BATCH_ROWS)
        mask[part] = (least[piece[part]] < docs[part, None]) @ (1 << np.arange(SPREAD + 1))
    hit = mask > 0
    found = pd.DataFrame({"doc_id": docs[hit], "text_id": texts[hit], "mark": starts[hit].astype(np.int64) << 31 | mask[hit]})
    del pieces, uses, size, data, piece, docs, texts, starts, ends, least, mask
    return _trimmed(found)


def _least_by_string(data: np.ndarray, begin: np.ndarray, size: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """For each piece and string in it the smallest document of the string's class over all shards."""
    least = np.full((len(begin), SPREAD + 1), np.iinfo(np.int64).max)
    shards = []
    for at in range(0, len(begin), SHARD_PIECES):
        part = slice(at, at + SHARD_PIECES)
        text, cuts = _gather(data, begin[part], size[part])
        order, number, heads, smallest = string_classes(text, cuts, docs[part])
        shards.append((at, text, cuts, order, number, heads, smallest))
    if len(shards) > 1:
        _merge(shards)
    for at, _, cuts, order, number, _, smallest in shards:
        piece = np.searchsorted(cuts, order, side="right") - 1
        least[at + piece, order - cuts[piece]] = smallest[number]
    return least


def _merge(shards: list) -> None:
    """Give classes of equal strings in different shards the smallest document of them all: binary search of sorted strings.

    The first and the last shard with a string know it once they have met, and every shard in between meets the last one after that.
    """
    sorted_strings = []
    for _, text, _, order, _, heads, _ in shards:
        rows = np.lib.stride_tricks.sliding_window_view(text, LENGTH)[order[heads]]
        sorted_strings.append(np.ascontiguousarray(rows).view(f"S{LENGTH}").ravel())
    for i, left in enumerate(sorted_strings):
        for j in range(i + 1, len(sorted_strings)):
            right = sorted_strings[j]
            if not len(left) or not len(right):
                continue
            place = np.minimum(np.searchsorted(right, left), len(right) - 1)
            equal = np.flatnonzero(right[place] == left)
            low = np.minimum(shards[i][6][equal], shards[j][6][place[equal]])
            shards[i][6][equal] = low
            shards[j][6][place[equal]] = low


def _kept(data: bytes, text_id: int, marks, texts) -> tuple[bytes, int]:
    """The bytes that stay, and the number of runs removed. texts: for each mark the text it is for, 0 if there is only one."""
    if marks is None:
        return data, 0
    texts = np.asarray(texts, dtype=np.int64)
    own = np.asarray(marks, dtype=np.int64)[(texts == 0) | (texts == text_id)]
    if not len(own) or len(data) < LENGTH:
        return data, 0
    if (own == _WHOLE).any():
        return b"", 1
    start, mask = own >> 31, own & ((1 << 31) - 1)
    at = (start[:, None] + np.arange(SPREAD + 1))[(mask[:, None] >> np.arange(SPREAD + 1)) & 1 == 1]
    step = np.zeros(len(data) + 1, dtype=np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + LENGTH, -1)
    gone = np.cumsum(step[:-1]) > 0
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, dtype=np.uint8)[~gone].tobytes(), runs


def _digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for doc_id, text_id, text, marks, texts in zip(batch["doc_id"], batch["text_id"], batch["text"], batch["marks"], batch["mark_texts"], strict=True):
            data = _bytes(text)
            kept, spans = _kept(data, text_id, marks, texts)
            out.append((doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
        yield pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]).astype({"doc_id": "Int64"})


def marks(docs: DataFrame) -> DataFrame:
    """For each id with repeats ``doc_id, marks, mark_texts``: a mark as in ``_mark``, or ``_WHOLE``, and the text it is for, 0 standing for the only text with the id."""
    small_batches(docs)
    known = docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    total = known.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    bits = max(2, math.ceil(math.log2(max(1, total / BUCKET_BYTES))))
    piece_bits = bits + int(math.log2(PIECE_BUCKETS))
    texts = known.select("doc_id", F.unhex(F.sha2("text", 256)).alias("sha"), F.xxhash64("text").alias("text_id"))
    firsts = texts.groupBy("sha").agg(F.min("doc_id").alias("first"))
    copies = texts.join(firsts, "sha").where("doc_id > first").select("doc_id", "text_id").distinct()
    dealt = known.mapInPandas(_deal_anchors(bits), "bucket int, entries binary, ids binary, hits binary")
    hits = dealt.groupBy("bucket").applyInPandas(_shared_anchors, "doc_id long, h int")
    by_doc = hits.groupBy("doc_id").agg(F.collect_set("h").alias("hashes"))
    copies_by_doc = copies.groupBy("doc_id").agg(F.collect_list("text_id").alias("copies"))
    several = texts.groupBy("doc_id").agg((F.min("text_id") != F.max("text_id")).alias("several")).where("several")
    about = by_doc.join(copies_by_doc, "doc_id", "left").join(several, "doc_id", "left").withColumn("several", F.col("several").isNotNull())
    wanted = _by_id(docs).join(about, "doc_id")
    schema = "bucket int, sizes binary, data binary, piece binary, docs binary, texts binary, starts binary"
    pieces = wanted.select("doc_id", F.xxhash64("text").alias("text_id"), "text", "hashes", "copies", "several").mapInPandas(_deal_pieces(piece_bits), schema)
    found = pieces.groupBy("bucket").applyInPandas(_mark, "doc_id long, text_id long, mark long")
    whole = copies.select("doc_id", "text_id", F.lit(_WHOLE).cast("long").alias("mark"))
    both = F.collect_list(F.struct("mark", "text_id"))
    return found.unionByName(whole).groupBy("doc_id").agg(both.alias("m")).select("doc_id", F.col("m.mark").alias("marks"), F.col("m.text_id").alias("mark_texts"))


def _by_id(docs: DataFrame) -> DataFrame:
    """Both joins take the texts from this one shuffle."""
    return docs.select("doc_id", "text")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` for each row of ``docs``."""
    joined = _by_id(docs).join(marks(docs), "doc_id", "left").select("doc_id", F.xxhash64("text").alias("text_id"), "text", "marks", "mark_texts")
    return joined.mapInPandas(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeats cut out of ``text`` (pieces of characters left at a cut go too) and ``n_chars`` to match."""

    @F.pandas_udf("string")
    def kept_text(text_id: pd.Series, text: pd.Series, found: pd.Series, texts: pd.Series) -> pd.Series:
        rows = zip(text_id, text, found, texts, strict=True)
        return pd.Series([t if m is None or not isinstance(t, str) else _kept(_bytes(t), i, m, own)[0].decode("utf-8", "ignore") for i, t, m, own in rows], dtype="object")

    # The row is one struct on the way, so no column of it meets another of its name.
    rows = docs.select(F.col("doc_id").alias("id"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col("row").getField("text")
    joined = rows.join(marks(docs).toDF("id", "found", "texts"), "id", "left").withColumn("kept", kept_text(F.xxhash64(text), text, "found", "texts"))
    new = {"text": F.col("kept")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length("kept").cast(docs.schema["n_chars"].dataType)
    return joined.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])

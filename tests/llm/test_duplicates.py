"""Near copies and repeated strings against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from tracelake.llm import near_dedup, suffix_dedup
from tracelake.llm.near_dedup import near_duplicates, overlaps, without_near_duplicates
from tracelake.llm.suffix_dedup import cut_repeats, packed, string_classes, suffix_ranks, unpacked, without_repeats


def shingles(text):
    raw = (text or "").encode()
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in raw)
    words = re.findall(rb"[^\x20\x09-\x0d]+", lower)
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def linked_rows(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & sets[j]) >= 75 * len(a | sets[j]):
                parent[find(i)] = find(j)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return Counter((r[0], len(sets[i]), low.get(find(i)), r[0] == low.get(find(i))) for i, r in enumerate(rows))


def test_near_duplicates_are_those_of_brute_force(docs, corpus):
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == linked_rows(corpus)


@pytest.mark.parametrize("size", [40, 10**6])
def test_blocks_of_any_size_give_the_same_links(spark, docs, corpus, monkeypatch, size):
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", size)
    monkeypatch.setattr(near_dedup, "BUCKET_SHINGLES", 64)
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == linked_rows(corpus)


def test_overlaps_by_products_and_by_pairs(monkeypatch):
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 30)).astype(np.uint64) for _ in range(40)]
    want = np.array([[len(np.intersect1d(a, b)) for b in sets[20:]] for a in sets[:20]])
    sizes = np.array([len(s) for s in sets])
    for least in (1, 50, 10**9):
        monkeypatch.setattr(near_dedup, "DENSE_PAIRS", least)
        assert (overlaps(np.concatenate(sets[:20]), sizes[:20], np.concatenate(sets[20:]), sizes[20:]) == want).all()


def test_every_pair_within_the_distance_shares_a_key():
    rng = np.random.default_rng(2)
    one = rng.integers(0, 1 << 16, near_dedup.VALUES).astype(np.uint16)
    for _ in range(300):
        other = one.copy()
        at = rng.permutation(near_dedup.VALUES)[: 2 * near_dedup.CHUNKS - 1]
        other[at] ^= 1
        keys = near_dedup.chunk_keys(np.array([one, other]))
        assert np.intersect1d(keys[0], keys[1]).size


def test_anchors_and_hashes_by_windows_are_those_of_the_whole_text(monkeypatch):
    rng = np.random.default_rng(5)
    for data in (rng.integers(0, 4, 5000).astype(np.uint8), np.zeros(700, dtype=np.uint8), rng.integers(0, 256, 50).astype(np.uint8)):
        whole = suffix_dedup.anchors(data)
        hashes = suffix_dedup._piece_hashes(data, whole[2], whole[3] + suffix_dedup.LENGTH)
        for window in (1, 31, 500):
            monkeypatch.setattr(suffix_dedup, "WINDOW", window)
            assert all((a == b).all() for a, b in zip(suffix_dedup.anchors(data), whole, strict=True))
            assert (suffix_dedup._piece_hashes(data, whole[2], whole[3] + suffix_dedup.LENGTH) == hashes).all()
            monkeypatch.undo()


def test_near_copies_leave_and_columns_stay(docs, nothing):
    kept = without_near_duplicates(docs)
    assert kept.columns == docs.columns
    gone = {r.doc_id for r in near_duplicates(docs).where("NOT kept").collect()}
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - gone
    assert near_duplicates(nothing).count() == without_near_duplicates(nothing).count() == 0


def repeated(rows):
    first = {}
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            if doc_id is not None:
                first[data[p : p + 50]] = min(first.get(data[p : p + 50], doc_id), doc_id)
    out = Counter()
    for doc_id, text, *_ in rows:
        data, end, kept, spans, inside = (text or "").encode(), 0, bytearray(), 0, False
        for p in range(len(data)):
            if doc_id is not None and p + 50 <= len(data) and first[data[p : p + 50]] < doc_id:
                end = p + 50
            spans += p < end and not inside
            inside = p < end
            if not inside:
                kept.append(data[p])
        out[doc_id, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("shard", [3, 30_000])
def test_removed_bytes_are_those_of_brute_force(docs, corpus, monkeypatch, shard):
    monkeypatch.setattr(suffix_dedup, "SHARD_PIECES", shard)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 40_000)
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in without_repeats(docs).collect())
    assert got == repeated(corpus)


def test_cut_texts_and_empty_table(docs, nothing):
    cut = cut_repeats(docs)
    assert cut.columns == docs.columns and cut.count() == docs.count()
    assert all(r.n_chars == len(r.text) for r in cut.where("text IS NOT NULL").collect())
    assert without_repeats(nothing).count() == cut_repeats(nothing).count() == 0
    clashing = docs.selectExpr("*", "1 AS _marks", "2 AS _mark_texts", "3 AS id", "4 AS found", "6 AS `row`", "7 AS `a.b`")
    again = cut_repeats(clashing)
    assert again.columns == clashing.columns
    assert sorted(map(str, again.select(*docs.columns).collect())) == sorted(map(str, cut.collect()))
    assert again.where("_marks = 1 AND _mark_texts = 2 AND id = 3 AND found = 4 AND `row` = 6 AND `a.b` = 7").count() == docs.count()


def test_suffix_ranks_sort_as_the_bytes_do():
    rng = np.random.default_rng(3)
    data = rng.integers(97, 100, 400).astype(np.uint8)
    ends = np.repeat([150, 260, 400], [150, 110, 140])
    ranks = suffix_ranks(data, ends, 50)
    have = np.flatnonzero(ranks >= 0)
    assert have.tolist() == [i for i in range(400) if ends[i] - i >= 50]
    strings = {i: data[i : i + 50].tobytes() for i in have}
    for i in have[::7]:
        for j in have:
            assert (ranks[i] < ranks[j]) == (strings[i] < strings[j])


def test_classes_know_their_smallest_document():
    data = np.frombuffer(b"x" * 60 + b"x" * 55, dtype=np.uint8)
    order, number, begin, smallest = string_classes(data, np.array([0, 60, 115]), np.array([9, 4]))
    assert len(order) == 11 + 6 and len(begin) == 1 and smallest.tolist() == [4] and set(number) == {0}


def test_blobs_round_trip():
    for values in (np.zeros(0, dtype=np.uint64), np.array([1, 1, 2**63], dtype=np.uint64), np.array([5, -3], dtype=np.int64), np.arange(9, dtype=np.int32)):
        assert (unpacked(packed(values), values.dtype) == values).all()

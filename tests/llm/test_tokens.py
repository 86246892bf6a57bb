"""Words, token counts and packing against the tokenizer itself."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tracelake.llm import packing, token_count, words
from tracelake.llm.packing import BestFit, document_ids, pack_documents
from tracelake.llm.token_count import text_counts, token_counts

PATH = words.vocabulary_path()
PLAIN = "abCDé'ñ's't're've'm'll'd  \n\t.,!?12²½<|>ÀÑßÿŌæµª\x85\xa0\x1c\x00-_%"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(9)
    out = ["".join(rng.choice(PLAIN) for _ in range(rng.randrange(60))) for _ in range(600)]
    out += ["".join(rng.choice(PLAIN + "İȺ日本語🙂́ķﬁK") for _ in range(rng.randrange(60))) for _ in range(300)]
    return [*out, None, "", "a<|endoftext|>b <|startoftext|>", "it's we'll 're 'x ''s don't's", "a" * 20_000, "aaa" * 7, "the" * 9_000 + " x", "é" * 5_000 + "<|endoftext|>" + "ab" * 3_000]


@pytest.fixture(scope="module")
def expected(texts):
    tokenizer = words.tokenizer(PATH)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_counts_are_the_librarys(texts, expected):
    assert text_counts(texts, PATH).tolist() == [len(x) for x in expected]


def test_chunks_of_any_size_compose(texts):
    for block in words.split_words(texts, PATH):
        if not isinstance(block, tuple) and len(block.starts):
            for chunk in (1, 3, 17):
                assert (token_count.word_states(block, chunk) == block.hashes).all()


def test_full_tables_start_anew(texts, expected, monkeypatch):
    monkeypatch.setattr(token_count, "TABLE_WORDS", 5)
    monkeypatch.setattr(packing, "TABLE_WORDS", 5)
    assert text_counts(texts, PATH).tolist() == [len(x) for x in expected]
    assert [x.tolist() for x in document_ids(texts, PATH)] == [[*x, 1] for x in expected]


def test_count_rows(docs, corpus, nothing):
    tokenizer = words.tokenizer(PATH)
    want = sorted((str(r[0]), len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False).ids)) for r in corpus)
    got = token_counts(docs).collect()
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got)
    assert token_counts(nothing).count() == 0


def test_packing_holds_every_id_once_without_gaps(docs, corpus, nothing):
    tokenizer = words.tokenizer(PATH)
    want = []
    for doc_id, text, *_ in corpus:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = np.array(ids[start : start + 4096], dtype="<u4")
            want.append((str(doc_id), piece, start, len(part), zlib.crc32(part.tobytes())))
    rows = pack_documents(docs).collect()
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(want)
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for parts in bins.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(bins) <= -(-sum(r.length for r in rows) // 4096) + 1
    assert pack_documents(nothing).count() == 0


def test_best_fit_takes_the_fullest_bin_that_fits_and_closes_the_fullest():
    fit = BestFit(10, open_bins=2)
    assert [fit.place(n) for n in (6, 7, 3, 4)] == [(0, 0), (1, 0), (1, 7), (0, 6)]
    fit = BestFit(10, open_bins=2)
    assert [fit.place(n) for n in (6, 7, 8)] == [(0, 0), (1, 0), (2, 0)]
    assert fit.place(3) == (0, 6)  # bin 1, the fullest, was closed for bin 2
    assert fit.place(2) == (2, 8)
    assert fit.place(2) == (3, 0)


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    fit, open_, made = BestFit(100, 8), {}, 0
    for _ in range(2_000):
        n = rng.randrange(1, 101)
        number, offset = fit.place(n)
        can = [f for f in open_.values() if f >= n]
        if can:
            assert open_[number] == min(can) == 100 - offset
        else:
            assert number == made and offset == 0
            made += 1
        left = open_.pop(number, 100) - n
        if left:
            if len(open_) == 8:
                fullest = min(open_.values())
                still = {b for stack in fit.bins for b in stack}
                (closed,) = [k for k, f in open_.items() if f == fullest and k not in still]
                del open_[closed]
            open_[number] = left
        assert len(open_) <= 8

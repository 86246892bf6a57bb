"""Byte-level BPE and the alignment of two tokenizers against the libraries and plain versions."""

import base64
import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tracelake.llm import byte_bpe, token_alignment

MARKS = "aeinrst hgno'lz0 \n\té日🙂\x85①ﬁ"


@pytest.fixture(scope="module")
def hard():
    rng = random.Random(3)
    out = ["".join(rng.choice(MARKS) for _ in range(rng.randrange(80))) for _ in range(1500)]
    out += ["a" * 30_000, "ab" * 3000, "abcabd" * 2000, "".join(rng.choice("etaoin") for _ in range(20_000)), " " * 300, "\n\n  x" * 400, "日本語" * 500]
    return [*out, None, "", "<s> </s> <|endoftext|> x", "▁x", "it's we'll 're 'x ''s don't's", "x  y " * 700]


@pytest.fixture(scope="module")
def library():
    with open(byte_bpe.byte_bpe_path(), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def new_encoder():
    return byte_bpe.Encoder(byte_bpe.byte_bpe_path(), public_tokenizers.PATTERN)


def test_ids_are_the_librarys(hard, library):
    want = [library.encode_ordinary(t or "") for t in hard]
    encoder = new_encoder()
    assert [x.tolist() for x in encoder.encode(hard)] == want
    assert [x.tolist() for x in encoder.encode(hard)] == want  # all words known
    assert [encoder.vocabulary.decode(x) for x in encoder.encode(hard)] == [(t or "").encode() for t in hard]


def test_neighbouring_tokens_in_any_order(library):
    """Two tokens side by side make pairs whose merges were learnt in another order than theirs."""
    rng = random.Random(5)
    tokens = list(byte_bpe.vocabulary(byte_bpe.byte_bpe_path()).ranks)
    texts = [b"".join(rng.choices(tokens, k=3)).decode("utf-8", "ignore") for _ in range(20_000)]
    assert [x.tolist() for x in new_encoder().encode(texts)] == [library.encode_ordinary(t) for t in texts]


def test_merges_of_a_lower_rank_come_first(tmp_path):
    """``abc`` (rank 256) is made of ``ab`` (257) and c: once ab stands in the word, abc comes before the next ab."""
    ranks = [bytes([i]) for i in range(256)] + [b"bab", b"ab", b"abab"]
    path = tmp_path / "small.tiktoken"
    path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(ranks)))
    small = tiktoken.Encoding("small", pat_str=r"\S+|\s+", mergeable_ranks={t: i for i, t in enumerate(ranks)}, special_tokens={})
    encoder = byte_bpe.Encoder(str(path), r"\S+|\s+")
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab") for _ in range(rng.randrange(1, 30))) for _ in range(2000)]
    assert [x.tolist() for x in encoder.encode(texts)] == [small.encode_ordinary(t) for t in texts]


def test_windows_and_full_tables(hard, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", 50)
    monkeypatch.setattr(byte_bpe, "TABLE_WORDS", 20)
    monkeypatch.setattr(byte_bpe, "BLOCK_IDS", 3)
    encoder = new_encoder()
    ids = encoder.encode(hard)
    assert [x.tolist() for x in ids] == [library.encode_ordinary(t or "") for t in hard]
    assert encoder.vocabulary.decode(ids[0]) == hard[0].encode()


def test_ids_outside_of_the_vocabulary(spark):
    with pytest.raises(ValueError):
        byte_bpe.vocabulary(byte_bpe.byte_bpe_path()).decode([1 << 20])


def test_byte_bpe_rows(docs, corpus, nothing, library):
    def digests(row):
        ids = library.encode_ordinary(row[1] or "")
        return str(row[0]), len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((row[1] or "").encode()).hexdigest()

    got = byte_bpe.byte_bpe(docs)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == sorted(map(digests, corpus))
    assert byte_bpe.byte_bpe(nothing).count() == 0
    back = byte_bpe.decode(byte_bpe.encode(docs)).select("doc_id", F.col("data").cast("string").alias("text"))
    assert sorted(map(str, back.collect())) == sorted(map(str, docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()))


def test_encoding_by_rank_is_the_librarys(hard):
    a, _ = token_alignment.tokenizers(*token_alignment._paths(None, None))
    assert a.by_rank
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rng = random.Random(8)
    tokens = [t for t in a.bytes if t]
    texts = ["".join(f"a{chr(c)}1{chr(c)} .{chr(c)}" for c in codes[at : at + 200]) for at in range(0, len(codes), 200)]
    texts += [b"".join(rng.choices(tokens, k=4)).decode("utf-8", "ignore") for _ in range(20_000)] + [t for t in hard if t] + [" " * 2_000_000, "\n " * 100_000]
    assert a.encode(texts) == [x.ids for x in a.library.encode_batch_fast(texts, add_special_tokens=False)]


def plain_alignment(text, a, b):
    """``(A ids, B ids, groups)`` by the definition, or None where there are no tokens."""
    if not text:
        return None
    ids_a, ids_b = a.library.encode(f" {text}", add_special_tokens=False).ids, b.library.encode(text)
    whole = f" {text}".encode()
    if b"".join(a.bytes[i] for i in ids_a) != whole or b"".join(b.bytes[i] for i in ids_b) != whole:
        return None

    def ends(tokens, ids):
        at, out = 0, []
        for i in ids:
            at += len(tokens.bytes[i])
            out.append(at)
        return out

    ends_a, ends_b = ends(a, ids_a), ends(b, ids_b)
    groups, i, j = [], 0, 0
    for cut in sorted(set(ends_a) & set(ends_b)):
        k, m = ends_a.index(cut, i) + 1, ends_b.index(cut, j) + 1
        groups.append((ids_a[i:k], ids_b[j:m]))
        i, j = k, m
    return ids_a, ids_b, groups


def as_text(groups):
    return ";".join(f"{','.join(map(str, p))}|{','.join(map(str, q))}" for p, q in groups)


@pytest.mark.parametrize(("lane", "window", "listed"), [(2048, 1 << 20, 256), (5, 40, 1)])
def test_alignment_by_its_definition(hard, monkeypatch, lane, window, listed):
    for name, value in (("LANE_BYTES", lane), ("WINDOW_CHARS", window), ("LISTED_LINKS", listed)):
        monkeypatch.setattr(token_alignment, name, value)
    a, b = token_alignment.tokenizers(*token_alignment._paths(None, None))
    got = token_alignment.align(hard, a, b)
    none = 0
    for k, text in enumerate(hard):
        want = plain_alignment(text, a, b)
        if want is None:
            none += 1
            assert got.n_a[k] == got.n_b[k] == got.n_groups[k] == got.n_links[k] == 0 and got.groups[k] == ""
            continue
        assert (got.n_a[k], got.n_b[k], got.n_groups[k]) == tuple(map(len, want)) and got.groups[k] == as_text(want[2])
        links = Counter()
        for p, q in want[2]:
            for (x, m), (y, n) in ((s, t) for s in Counter(p).items() for t in Counter(q).items()):
                links[x * len(b.bytes) + y] += m * n
        own = slice(got.pair_cuts[k], got.pair_cuts[k + 1])
        assert got.n_links[k] == links.total() and dict(zip(got.pairs[own].tolist(), got.times[own].tolist())) == links
    assert none == sum(not t for t in hard) + 1  # null and empty ones, and the text with the character that B puts for a blank


@pytest.mark.parametrize("block", [1 << 23, 2000])
def test_token_alignment_rows(docs, corpus, nothing, monkeypatch, block):
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", block)
    a, b = token_alignment.tokenizers(*token_alignment._paths(None, None))
    aligned = [plain_alignment(r[1], a, b) for r in corpus]
    counts, highest = Counter(), defaultdict(int)
    for found in aligned:
        counts.update({(x, y) for p, q in (found[2] if found else []) for x in p for y in q})
    for (x, _), n in counts.items():
        highest[x] = max(highest[x], n)
    want = []
    for row, found in zip(corpus, aligned):
        links = [(x, y) for p, q in (found[2] if found else []) for x in p for y in q]
        sizes = (len(found[0]), len(found[1]), len(found[2])) if found else (0, 0, 0)
        digest = hashlib.sha256(as_text(found[2]).encode()).hexdigest() if found else ""
        want.append((str(row[0]), *sizes, len(links), digest, sum(counts[x] == highest[x[0]] for x in links), sum(counts[x] for x in links)))
    got = token_alignment.token_alignment(docs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "n_best", "count_sum"]
    assert sorted((str(r.doc_id), *r[1:]) for r in got.collect()) == sorted(want)
    assert token_alignment.token_alignment(nothing).count() == 0

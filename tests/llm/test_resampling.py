"""Importance resampling against a plain version, and its search for the cutoff."""

import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracelake.llm import importance as op

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def features(text):
    words = WORD.findall((text or "").translate(LOWER))
    return words, [zlib.crc32(" ".join(words[i : i + k]).encode()) % 10000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def plain(corpus, target):
    """``(doc_id, n_features, weight, score)`` of each row, and the drawn ones in order."""
    s, t = np.zeros(10000, dtype=int), np.zeros(10000, dtype=int)
    for text in corpus:
        np.add.at(s, features(text[1])[1], 1)
    for text in target:
        np.add.at(t, features(text)[1], 1)
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.sum() + 10000) / ((s[b] + 1) * (t.sum() + 10000)))) for b in range(10000)]
    rows, pool = [], []
    for doc_id, text in corpus:
        words, found = features(text)
        weight = sum(gain[b] for b in found)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append((doc_id, len(found), weight, score))
        if len(words) >= 20:
            pool.append((-score, doc_id is None, doc_id or 0))
    return rows, sorted(pool)[: 5 * len(pool) // 100]


def test_rows_are_those_of_the_plain_version(spark, docs, corpus, nothing):
    rng = random.Random(1)
    target = [corpus[0][1], corpus[7][1], None, "", "one two three é"]
    more = [(5000 + i, " ".join(rng.choice(corpus[0][1].split()) for _ in range(rng.randrange(10, 60)))) for i in range(400)]
    everything = docs.select("doc_id", "text").union(spark.createDataFrame(more, "doc_id long, text string"))
    want, drawn = plain([(r[0], r[1]) for r in corpus] + more, target)
    got = op.importance(everything, spark.createDataFrame([(t,) for t in target], "text string")).collect()
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_features, r.weight, r.score)) for r in got)
    ranked = sorted((r.rank, -r.score, r.doc_id is None, r.doc_id or 0) for r in got if r["rank"] is not None)
    assert len(drawn) > 20 and [r[1:] for r in ranked] == drawn and [r[0] for r in ranked] == list(range(1, len(drawn) + 1))
    assert op.importance(nothing, spark.createDataFrame([("a",)], "text string")).count() == 0
    assert op.importance(nothing, nothing).count() == 0
    want, _ = plain([(r[0], r[1]) for r in corpus] + more, [])
    assert sorted(map(str, want)) == sorted(str((r.doc_id, r.n_features, r.weight, r.score)) for r in op.importance(everything, nothing).collect())


def test_crcs_of_long_and_cut_texts(monkeypatch):
    texts = [None, "", "a", "a b", "A-b é1 " * 3000, "x" * 100 + " y " + "z" * 50, "q " * 1000, "日本 語" * 9]
    monkeypatch.setattr(op, "PART_WORDS", 7)
    got = [[] for _ in texts]
    for found, texts_of, _ in op.text_features(texts):
        for bucket, i in zip(found.tolist(), texts_of.tolist()):
            got[i].append(bucket)
    assert [sorted(g) for g in got] == [sorted(features(t)[1]) for t in texts]


@pytest.mark.parametrize("k", [1, 7, 250, 499, 500])
def test_the_bracket_is_widened_until_it_holds_the_place(spark, k):
    rng = random.Random(k)
    # A third of all rows share one score and one id.
    values = [(7, 3) if i % 3 == 0 else (rng.randrange(-50, 50), i) for i in range(500)]
    rows = spark.createDataFrame(values, "score long, doc_id long").repartition(6).withColumn("_row", F.monotonically_increasing_id())
    order = sorted((-s, i) for s, i in values)
    for margin in (1e-9, 0.01, 2.0):
        low, high, above = op.bracket(rows, 500, k, accuracy=50, margin=margin)
        inside = [v for v in values if (low is None or v[0] >= low) and (high is None or v[0] <= high)]
        assert above == sum(high is not None and v[0] > high for v in values) and above < k <= above + len(inside)
        last = op.last_drawn(rows, 500, k, accuracy=50, margin=margin)
        assert (-last["score"], last["doc_id"]) == order[k - 1]

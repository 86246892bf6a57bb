"""Toxicity by the nearest labelled examples under TF-IDF cosine over selected terms, exact over those.

Terms are words (runs of letters, A-Z lower-cased; bytes from 80 on count as letters) and the first four bytes of each longer
word. A bounded sample of labelled rows, ``EXAMPLES_PER_LABEL`` of each label in the order of a hash of the id,
gives the vocabulary (terms whose share differs between the labels by more than ``MIN_Z`` standard
deviations, ``VOCABULARY`` at most), the inverse document frequencies and the examples. Other terms count neither in products nor in lengths. The examples
stand in a block-max inverted index: for each term and block of examples the largest weight is kept, so blocks
that cannot reach the k-th best cosine are never opened, and the neighbours found are exact.

The votes of the neighbours, weighted by their distance and by the share of their label among all labelled
rows, give a raw score; its calibration is an isotonic curve fitted on the examples, each scored without itself.

Defined cases: a null or empty text has no terms and gets the score of texts without evidence; without any
labelled row of one of the labels every score is the share of label 1 (0 without labels); labels repeated for an id count as the largest; null ids and labels
teach nothing; repeated rows get equal results, one each; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, lower_values, runs, span_hashes

EXAMPLES_PER_LABEL = 3000
VOCABULARY = 1024
MIN_Z = 5.0
NEIGHBOURS = 15
BLOCK = 64
PREFIX = 4
THRESHOLD = 0.3

_IS_LETTER = np.zeros(256, dtype=bool)
_IS_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def text_terms(texts) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of texts: how many texts, each term's row within the block, and each term."""
    for first, end, data, rows in byte_blocks(texts):
        starts, ends = runs(_IS_LETTER[data])
        values = lower_values(data)
        row = np.searchsorted(rows, starts, side="right") - 1
        longer = ends - starts > PREFIX
        words = span_hashes(values, starts, ends)
        heads = span_hashes(values, starts[longer], starts[longer] + PREFIX) ^ np.uint64(0xA5A5A5A5A5A5A5A5)
        yield end - first, np.concatenate((row, row[longer])), np.concatenate((words, heads))


@dataclass
class BlockMaxIndex:
    """Examples by term, with the largest weight of each term in each block of ``BLOCK`` examples."""

    n: int
    terms: np.ndarray  # of each posting, ascending
    slots: np.ndarray
    weights: np.ndarray
    most: np.ndarray = field(init=False)
    tiles: np.ndarray = field(init=False)  # the weights of a term in a block, side by side
    opened: int = field(default=0, init=False)

    def __post_init__(self) -> None:
        size = int(self.terms.max()) + 1 if len(self.terms) else 1
        blocks = -(-self.n // BLOCK)
        self.most = np.zeros((size, blocks))
        np.maximum.at(self.most, (self.terms, self.slots // BLOCK), self.weights)
        self.tiles = np.zeros((size, blocks, BLOCK))
        self.tiles[self.terms, self.slots // BLOCK, self.slots % BLOCK] = self.weights

    def search(self, terms: np.ndarray, weights: np.ndarray, k: int, without: int = -1) -> tuple[np.ndarray, np.ndarray]:
        """Slots and cosines of the k nearest, by cosine and then slot; only cosines above 0."""
        known = terms < len(self.most)
        terms, weights = terms[known], weights[known]
        bounds = weights @ self.most[terms] * (1 + 1e-9)
        slots, scores, worst = np.zeros(0, dtype=np.int64), np.zeros(0), 0.0
        order = np.argsort(-bounds, kind="stable")
        at, step = 0, 1
        while at < len(order):
            group = order[at : at + step]
            group = group[(bounds[group] > 0) & ((bounds[group] >= worst) | (len(slots) < k))]
            if not len(group):
                break
            at, step = at + step, 2 * step  # few calls when the bounds of many blocks are close
            self.opened += len(group)
            sums = np.zeros((len(group), BLOCK))
            for t, w in zip(terms.tolist(), weights.tolist(), strict=True):
                sums += w * self.tiles[t, group]
            there = (group[:, None] * BLOCK + np.arange(BLOCK))[sums > 0]
            sums = sums[sums > 0]
            slots, scores = np.concatenate((slots, there[there != without])), np.concatenate((scores, sums[there != without]))
            if len(slots) > k:
                near = scores >= np.partition(scores, -k)[-k]
                slots, scores = slots[near], scores[near]
            best = np.lexsort((slots, -scores))[:k]
            slots, scores = slots[best], scores[best]
            worst = scores[-1] if len(scores) else 0.0
        return slots, scores


@dataclass
class ToxicityModel:
    share: float  # of label 1 among the labelled rows
    vocabulary: np.ndarray  # hashes, ascending
    idf: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    index: BlockMaxIndex | None
    curve: tuple[np.ndarray, np.ndarray] = (np.zeros(1), np.zeros(1))

    def vectors(self, texts) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Each text's terms (places in the vocabulary) and unit weights."""
        for count, row, terms in text_terms(texts):
            if not len(self.vocabulary):
                yield from [(np.zeros(0, dtype=np.int64), np.zeros(0))] * count
                continue
            place = np.minimum(np.searchsorted(self.vocabulary, terms), len(self.vocabulary) - 1)
            known = self.vocabulary[place] == terms
            cell, times = np.unique(row[known] * len(self.vocabulary) + place[known], return_counts=True)
            row, place = cell // len(self.vocabulary), cell % len(self.vocabulary)
            weight = (1 + np.log(times)) * self.idf[place]
            cuts = np.searchsorted(row, np.arange(count + 1))
            for at, end in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                own = weight[at:end]
                yield place[at:end], own / math.sqrt(own @ own) if end > at else own

    def raw(self, terms: np.ndarray, weights: np.ndarray, without: int = -1) -> tuple[float, np.ndarray]:
        slots, cosines = self.index.search(terms, weights, NEIGHBOURS, without)
        if not len(slots):
            return 0.0, slots
        vote = 1 / (1.05 - np.minimum(cosines, 1.0))
        ones = self.labels == 1
        vote = vote * np.where(self.labels[slots] == 1, self.share / ones.sum(), (1 - self.share) / (~ones).sum())
        return float(vote[self.labels[slots] == 1].sum() / vote.sum()), slots

    def score(self, terms: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray]:
        if self.index is None:
            return self.share, np.zeros(0, dtype=np.int64)
        raw, slots = (self.raw(terms, weights)) if len(terms) else (-1.0, np.zeros(0, dtype=np.int64))
        return float(np.interp(raw, *self.curve)), self.ids[slots]



def training_rows(labels: DataFrame) -> DataFrame:
    """``doc_id, toxic`` of the rows to learn from: one for each id, without the held-out ids."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return known.where(~held_out("doc_id"))


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """A model from at most ``EXAMPLES_PER_LABEL`` labelled documents of each label."""
    known = training_rows(labels)
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ones, zeros = counts.get(1, 0), counts.get(0, 0)
    share = ones / (ones + zeros) if ones + zeros else 0.0
    sample = None
    for label in (0, 1):
        part = known.where(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(EXAMPLES_PER_LABEL)
        sample = part if sample is None else sample.unionByName(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most 2 * EXAMPLES_PER_LABEL rows
    rows = texts.mapInPandas(_example_terms, "doc_id long, toxic long, terms binary, times binary").dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r["doc_id"])
    return _model(rows, share)


def _example_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out, at = {"terms": [], "times": []}, 0
        for count, row, terms in text_terms(batch["text"]):
            order = np.lexsort((terms, row))
            cuts = np.searchsorted(row[order], np.arange(count + 1))
            for i in range(count):
                found, times = np.unique(terms[order[cuts[i] : cuts[i + 1]]], return_counts=True)
                out["terms"].append(found.tobytes())
                out["times"].append(times.astype(np.int32).tobytes())
            at += count
        yield pd.DataFrame({"doc_id": batch["doc_id"], "toxic": batch["toxic"].astype("int64"), **out})


def _model(rows: list, share: float) -> ToxicityModel:
    labels = np.array([r["toxic"] for r in rows], dtype=np.int64)
    ids = np.array([r["doc_id"] for r in rows], dtype=np.int64)
    nothing = ToxicityModel(share, np.zeros(0, dtype=np.uint64), np.zeros(0), ids, labels, None)
    ones, zeros = int((labels == 1).sum()), int((labels == 0).sum())
    if not ones or not zeros:
        return nothing
    terms = [np.frombuffer(r["terms"], dtype=np.uint64) for r in rows]
    times = [np.frombuffer(r["times"], dtype=np.int32) for r in rows]
    every, inverse = np.unique(np.concatenate(terms), return_inverse=True)
    owner = np.repeat(np.arange(len(rows)), [len(t) for t in terms])
    with_one = np.bincount(inverse[labels[owner] == 1], minlength=len(every)) / ones
    with_zero = np.bincount(inverse[labels[owner] == 0], minlength=len(every)) / zeros
    mean = (with_one * ones + with_zero * zeros) / (ones + zeros)
    z = np.abs(with_one - with_zero) / np.sqrt(mean * (1 - mean) * (1 / ones + 1 / zeros) + 1e-12)
    chosen = np.flatnonzero(z > MIN_Z)
    chosen = np.sort(chosen[np.argsort(-z[chosen], kind="stable")[:VOCABULARY]])
    if not len(chosen):
        return nothing
    frequency = share * with_one[chosen] + (1 - share) * with_zero[chosen]
    idf = 1 - np.log(np.maximum(frequency, 1 / len(rows)))
    place = np.full(len(every), -1)
    place[chosen] = np.arange(len(chosen))
    kept = place[inverse] >= 0
    owner, place, count = owner[kept], place[inverse][kept], np.concatenate(times)[kept]
    weight = (1 + np.log(count)) * idf[place]
    length = np.sqrt(np.bincount(owner, weight * weight, minlength=len(rows)))
    weight = weight / length[owner]
    # Examples with the same strongest term stand together, so that blocks differ in what they can reach.
    lead = np.full(len(rows), len(chosen))
    order = np.lexsort((weight, owner))
    lead[owner[order]] = place[order]
    slot_of = np.empty(len(rows), dtype=np.int64)
    by_lead = np.lexsort((ids, labels, lead))
    slot_of[by_lead] = np.arange(len(rows))
    slot = slot_of[owner]
    order = np.lexsort((slot, place))
    index = BlockMaxIndex(len(rows), place[order], slot[order], weight[order])
    model = ToxicityModel(share, every[chosen], idf, ids[by_lead], labels[by_lead], index)
    own = np.lexsort((place, slot))
    cuts = np.searchsorted(slot[own], np.arange(len(rows) + 1))
    raw = np.full(len(rows), -1.0)
    for s in range(len(rows)):
        mine = own[cuts[s] : cuts[s + 1]]
        if len(mine):
            raw[s] = model.raw(place[mine], weight[mine], without=s)[0]
    model.curve = isotonic(raw, model.labels, np.where(model.labels == 1, share / ones, (1 - share) / zeros), share)
    return model


def isotonic(raw: np.ndarray, labels: np.ndarray, weights: np.ndarray, share: float) -> tuple[np.ndarray, np.ndarray]:
    """The rising curve through (raw, share of label 1) that fits best; each step leans a little to ``share``."""
    steps: list[list[float]] = []  # lowest raw, highest raw, weight of ones, weight
    for r in np.unique(raw):
        at = raw == r
        steps.append([r, r, float(weights[at & (labels == 1)].sum()), float(weights[at].sum())])
        while len(steps) > 1 and steps[-2][2] * steps[-1][3] >= steps[-1][2] * steps[-2][3]:
            _, high, one, all_ = steps.pop()
            steps[-1] = [steps[-1][0], high, steps[-1][2] + one, steps[-1][3] + all_]
    lean = float(weights.sum()) / len(weights)
    level = [(s[2] + share * lean) / (s[3] + lean) for s in steps]
    level = np.maximum.accumulate(level)
    return np.array([x for s in steps for x in s[:2]]), np.repeat(level, 2)


def score_rows(docs: DataFrame, model: ToxicityModel, evidence: bool = True) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and the ids of the examples that voted; any other columns stay."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample
    cache: dict[bytes, tuple[float, list[int]]] = {}

    @F.pandas_udf("struct<score: double, evidence: array<long>>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        scores, near = [], []
        for terms, weights in shared.value.vectors(texts):
            key = terms.tobytes() + weights.tobytes()
            if key not in cache:
                if len(cache) > 50_000:
                    cache.clear()
                score, ids = shared.value.score(terms, weights)
                cache[key] = score, ids.tolist()
            score, ids = cache[key]
            scores.append(score)
            near.append(ids)
        return pd.DataFrame({"score": pd.Series(scores, dtype="float64"), "evidence": pd.Series(near, dtype="object")})

    judged = docs.withColumn("_toxicity", judge("text"))
    out = judged.withColumn("score", F.col("_toxicity.score")).withColumn("predicted", (F.col("_toxicity.score") >= THRESHOLD).cast("int"))
    return (out.withColumn("evidence", F.col("_toxicity.evidence")) if evidence else out).drop("_toxicity")


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted, evidence`` for each row of ``docs``."""
    scored = score_rows(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "evidence")


def without_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with their own columns."""
    own = docs.select(F.struct("*").alias("row"), "text")
    return score_rows(own, fit(docs, labels), evidence=False).where("predicted = 0").select("row.*")

"""Language identification by a byte convolutional network.

A text's UTF-8 bytes are cut into windows of ``WINDOW`` bytes that cover it from beginning to end. Filters of several widths run over the bytes of a
window (each filter has a weight for every byte value at each of its places), the largest response of each filter is
kept, and a softmax over the languages follows. A text's score for a language is the mean of its windows'. The network is trained in numpy by Adam on
windows of a bounded sample: about ``TRAIN_TEXTS`` labelled texts of each language, drawn by a hash of the id, and up to ``TRAIN_WINDOWS``
windows of each. Labels, sources and ids are never inputs of a prediction.

In use, the filters' responses come from tables by pairs of bytes: two look-ups for each byte give all filters of widths 2 to 4.

Defined cases: a null text and one without any letter get ``und`` with score 0, as does every text when nothing could be learned; of languages with
equal scores the first by name is taken; rows without id or label teach nothing; repeated rows get equal results, one each; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 16
TRAIN_TEXTS = 800
TRAIN_WINDOWS = 6
EPOCHS = 6
BATCH = 128
RATE = 0.01
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_PAD = max(WIDTHS) - 1
_SLICE = 512  # windows at once


@dataclass
class ByteNetwork:
    languages: list[str]
    filters: list[np.ndarray]  # for each width: place, byte, filter
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str]) -> ByteNetwork:
        rng = np.random.Generator(np.random.PCG64(5))
        n = len(WIDTHS) * FILTERS
        filters = [rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS]
        out = rng.normal(0, 1 / np.sqrt(n), (n, len(languages))).astype(np.float32)
        return cls(languages, filters, np.zeros(n, dtype=np.float32), out, np.zeros(len(languages), dtype=np.float32))

    def responses(self, windows: np.ndarray) -> np.ndarray:
        """windows x places x filters, before the largest is taken. windows: rows of ``WINDOW + _PAD`` bytes."""
        parts = []
        for width, weights in zip(WIDTHS, self.filters, strict=True):
            total = weights[0][windows[:, :WINDOW]]
            for place in range(1, width):
                total = total + weights[place][windows[:, place : place + WINDOW]]
            parts.append(total)
        return np.concatenate(parts, axis=2)

    def train(self, windows: np.ndarray, labels: np.ndarray) -> None:
        rng = np.random.Generator(np.random.PCG64(11))
        weights = [*self.filters, self.bias, self.out, self.out_bias]
        first, second, step = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights], 0
        counts = np.bincount(labels, minlength=len(self.languages))
        share = len(labels) / (len(self.languages) * np.maximum(counts, 1))  # each language weighs the same
        for _ in range(EPOCHS):
            order = rng.permutation(len(windows))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                grads = self._gradients(windows[pick], labels[pick], share[labels[pick]].astype(np.float32))
                step += 1
                for w, g, m, v in zip(weights, grads, first, second, strict=True):
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    w -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, windows: np.ndarray, labels: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
        response = self.responses(windows)
        where = response.argmax(axis=1)
        pooled = np.take_along_axis(response, where[:, None, :], axis=1)[:, 0] + self.bias
        hidden = np.maximum(pooled, 0)
        error = softmax(hidden @ self.out + self.out_bias)
        error[np.arange(len(labels)), labels] -= 1
        error *= share[:, None] / len(labels)
        back = (error @ self.out.T) * (pooled > 0)
        filters = []
        for k, weights in enumerate(self.filters):
            part = slice(k * FILTERS, (k + 1) * FILTERS)
            grad = np.zeros_like(weights)
            for place in range(len(weights)):
                byte = np.take_along_axis(windows, where[:, part] + place, axis=1)
                np.add.at(grad[place], (byte, np.arange(FILTERS)[None, :]), back[:, part])
            filters.append(grad)
        return [*filters, back.sum(axis=0), hidden.T @ error, error.sum(axis=0)]

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Responses by the pair of bytes at a place, and by the pair two places on."""
        two, three, four = self.filters
        high, low = np.repeat(np.arange(256), 256), np.tile(np.arange(256), 256)
        here = np.concatenate([f[0][high] + f[1][low] for f in (two, three, four)], axis=1)
        beyond = np.concatenate((three[2][high], four[2][high] + four[3][low]), axis=1)
        return here, beyond


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def laid_out(data: bytes) -> bytes:
    """Whole windows, and at least ``_PAD`` zero bytes at the end."""
    return data.ljust(((len(data) + _PAD) // WINDOW + 1) * WINDOW, b"\0")


class Predictor:
    def __init__(self, network: ByteNetwork):
        self.network, (self.here, self.beyond) = network, network.tables()

    def windows(self, data: np.ndarray) -> np.ndarray:
        """Each window's share for each language. data: whole windows."""
        shares = []
        padded = np.concatenate((data, np.zeros(4, dtype=np.uint8))).astype(np.uint16)
        pairs = padded[:-1] << 8 | padded[1:]
        for at in range(0, len(data), _SLICE * WINDOW):
            n = min(len(data), at + _SLICE * WINDOW) - at
            response = self.here[pairs[at : at + n]]
            response[:, FILTERS:] += self.beyond[pairs[at + 2 : at + 2 + n]]
            pooled = response.reshape(-1, WINDOW, response.shape[1]).max(axis=1) + self.network.bias
            shares.append(softmax(np.maximum(pooled, 0) @ self.network.out + self.network.out_bias))
        return np.concatenate(shares)

    def texts(self, texts) -> tuple[list[str], list[float]]:
        languages, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        held, size = [], 0

        def flush() -> None:
            shares = self.windows(np.frombuffer(b"".join(d for _, d in held), dtype=np.uint8))
            cuts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum([len(d) // WINDOW for _, d in held])))
            mean = np.add.reduceat(shares.astype(np.float64), cuts[:-1], axis=0) / np.diff(cuts)[:, None]
            for (i, _), best, row in zip(held, mean.argmax(axis=1).tolist(), mean, strict=True):
                languages[i], scores[i] = self.network.languages[best], float(min(1.0, max(0.0, row[best])))

        for i, text in enumerate(texts):
            if not isinstance(text, str) or not _LETTER.search(text):
                continue
            held.append((i, laid_out(text.encode("utf-8", "surrogatepass"))))
            size += len(held[-1][1])
            if size > 1 << 20:
                flush()
                held, size = [], 0
        if held:
            flush()
        return languages, scores


def held_out(doc_id: str) -> Column:
    return F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def fit(docs: DataFrame) -> ByteNetwork | None:
    """A network from a sample of the labelled rows that are not held out; None without any."""
    known = docs.where(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out("doc_id"))
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return None
    languages = sorted(counts)
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 40)) / F.lit(float(1 << 40))
    rate = F.element_at(F.create_map(*[F.lit(x) for lang in languages for x in (lang, TRAIN_TEXTS / counts[lang])]), F.col("lang"))
    rows = known.where(draw < rate).select("doc_id", "lang", "text").mapInPandas(_training_windows, "doc_id long, lang string, windows binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["lang"], r["windows"]))
    size = WINDOW + _PAD
    data = np.frombuffer(b"".join(r["windows"] for r in rows), dtype=np.uint8).reshape(-1, size)
    labels = np.repeat([languages.index(r["lang"]) for r in rows], [len(r["windows"]) // size for r in rows])
    if not len(data):
        return None
    network = ByteNetwork.fresh(languages)
    network.train(data, labels)
    return network


def _training_windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            if not _LETTER.search(text):
                found.append(b"")
                continue
            data = laid_out(text.encode("utf-8", "surrogatepass")) + b"\0" * _PAD
            rng = np.random.Generator(np.random.PCG64(int(doc_id) & 0xFFFFFFFF))
            whole = max(1, (len(data) - _PAD) // WINDOW - 1)
            places = rng.permutation(whole)[:TRAIN_WINDOWS]
            found.append(b"".join(data[p * WINDOW : (p + 1) * WINDOW + _PAD] for p in sorted(places.tolist())))
        yield pd.DataFrame({"doc_id": batch["doc_id"], "lang": batch["lang"], "windows": found})


def identify(docs: DataFrame, network: ByteNetwork | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for each row of ``docs``."""
    out = docs.select("doc_id", "text").withColumn("held_out", held_out("doc_id"))
    if network is None:
        return out.select("doc_id", "held_out", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = docs.sparkSession.sparkContext.broadcast(network)  # as large for any input
    made: list[Predictor] = []

    @F.pandas_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pd.Series) -> pd.DataFrame:
        if not made:
            made.append(Predictor(shared.value))
        languages, scores = made[0].texts(texts)
        return pd.DataFrame({"lang_pred": pd.Series(languages, dtype="object"), "score": pd.Series(scores, dtype="float64")})

    return out.select("doc_id", "held_out", predict("text").alias("p")).select("doc_id", "held_out", "p.lang_pred", "p.score")


def language_id(docs: DataFrame) -> DataFrame:
    return identify(docs, fit(docs.select("doc_id", "lang", "text")))

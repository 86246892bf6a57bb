"""Token counts by a compiled finite-state transducer.

The states of the transducer are the prefixes of words (one state, empty, between words); a character leads to the next prefix, and the transition that
ends a word emits the number of tokens of that word. The transitions are compiled from the vocabulary file's own
merges, for the words met so far: all new words of a block are merged together in numpy, rank by rank.

A state is held as a rolling hash with a length, so the map of a chunk of text is short: whether a word ends in it, the
count inside, what it adds to the word that was open before, and the prefix open at its end. Such maps
compose associatively, and a prefix scan over the chunks of a block gives every chunk its incoming state in a logarithmic number of steps, however
long a text or a word is.

Defined cases: a null text counts as empty and has no token; special tokens inside a text count one each, as the library
does it; repeated rows are counted each; other columns are ignored.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .common import _BASE, mix, powers
from .words import Words, library_words, rules, split_words, vocabulary_path

LIMIT = 2048
CHUNK = 4096
#: Words whose transitions a worker keeps; beyond that it compiles anew. Costs time only.
TABLE_WORDS = 2_000_000
_NONE = np.int64(1 << 40)


def byte_characters() -> list[str]:
    """The visible character that stands for each byte: printable ones for themselves, the others from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(hidden)) for b in range(256)]


class Merges:
    """The merge rules of a vocabulary with a mark at word ends."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        self.inner = np.array([vocab[c] for c in byte_characters()], dtype=np.int64)
        self.last = np.array([vocab[c + mark] for c in byte_characters()], dtype=np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        keys, first = np.unique(keys, return_index=True)
        self.keys, self.ranks, self.made = keys, first.astype(np.int64), made

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], _NONE)

    def counts(self, data: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """How many tokens each word has. data: the words' bytes one after the other; sizes: at least 1 each."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        symbols = self.inner[data]
        ends = np.cumsum(sizes) - 1
        symbols[ends] = self.last[data[ends]]
        counts = sizes.copy()
        rank = np.full(len(symbols), _NONE)
        rank[:-1] = self.rank(symbols[:-1], symbols[1:])
        rank[ends] = _NONE
        while len(symbols):
            starts = np.flatnonzero(np.concatenate((np.ones(1, dtype=bool), word[1:] != word[:-1])))
            least = np.minimum.reduceat(rank, starts)
            size = np.diff(np.append(starts, len(symbols)))
            open_ = np.repeat(least < _NONE, size)
            if not open_.all():
                symbols, word, rank = symbols[open_], word[open_], rank[open_]
                if not len(symbols):
                    break
                size, least = size[least < _NONE], least[least < _NONE]
            chosen = rank == np.repeat(least, size)
            # Of equal pairs that overlap, as in "aaa", every second one is merged, from the left.
            after = np.flatnonzero(chosen[1:] & chosen[:-1]) + 1
            if len(after):
                run = np.flatnonzero(chosen & ~np.concatenate((np.zeros(1, dtype=bool), chosen[:-1])))
                begin = run[np.searchsorted(run, after, side="right") - 1]
                chosen[after[(after - begin) % 2 == 1]] = False
            at = np.flatnonzero(chosen)
            symbols[at] = self.made[rank[at]]
            counts -= np.bincount(word[at], minlength=len(counts))
            keep = np.ones(len(symbols), dtype=bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, rank = symbols[keep], word[keep], rank[keep]
            changed = place[at]
            changed = np.unique(np.concatenate((changed, changed[changed > 0] - 1)))
            next_ = np.minimum(changed + 1, len(symbols) - 1)
            same = (word[next_] == word[changed]) & (next_ > changed)
            rank[changed] = np.where(same, self.rank(symbols[changed], symbols[next_]), _NONE)
        return counts


class Transducer:
    """Emitted counts of word-ending transitions, by the state they leave."""

    def __init__(self, path: str):
        self.merges, self.specials = Merges(path), rules(path)[2]
        self.states, self.emits = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def emitted(self, states: np.ndarray, words: Words, numbers: np.ndarray) -> np.ndarray:
        """What ending the words emits. numbers: which words of the block the states belong to."""
        different, one, place = np.unique(states, return_index=True, return_inverse=True)
        if len(self.states) > TABLE_WORDS:
            self.states, self.emits = self.states[:0], self.emits[:0]
        new = ~np.isin(different, self.states, assume_unique=True)
        if new.any():
            counts = self._compile(words, numbers[one[new]])
            order = np.argsort(np.concatenate((self.states, different[new])), kind="stable")
            self.states = np.concatenate((self.states, different[new]))[order]
            self.emits = np.concatenate((self.emits, counts))[order]
        return self.emits[np.searchsorted(self.states, different)][place]

    def _compile(self, words: Words, numbers: np.ndarray) -> np.ndarray:
        size = words.ends[numbers] - words.starts[numbers] + 1
        cuts = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(size)))
        at = np.arange(cuts[-1]) + np.repeat(words.starts[numbers] - cuts[:-1], size)
        codes = words.codes[np.minimum(at, len(words.codes) - 1)]
        codes[cuts[1:] - 1] = 0x0A  # no word holds a line feed
        text = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        feed = np.flatnonzero(data == 0x0A)
        sizes = np.diff(np.concatenate((np.array([-1]), feed))) - 1
        counts = self.merges.counts(data[data != 0x0A], sizes)
        for i, n in enumerate(numbers.tolist() if len(self.specials) and not words.plain else []):
            if words.word(n) in self.specials:
                counts[i] = 1
        return counts

    def counts(self, words: Words) -> np.ndarray:
        """The tokens of each text of the block."""
        if not len(words.starts):
            return np.zeros(len(words.cuts) - 1, dtype=np.int64)
        states = word_states(words)
        total = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum(self.emitted(states, words, np.arange(len(states))))))
        return total[words.cuts[1:]] - total[words.cuts[:-1]]


def word_states(words: Words, chunk: int = CHUNK) -> np.ndarray:
    """The state at the end of each word, from the maps of the block's chunks and their prefix scan."""
    values = mix(words.codes.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    up, down = powers(len(values) + 1)
    sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values * up[:-1])))

    def part(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (sums[end] - sums[start]) * down[start]

    starts, ends = words.starts, words.ends
    begin, finish = starts // chunk, (ends - 1) // chunk
    raw, size = part(starts, ends), ends - starts
    crossing = np.flatnonzero(begin != finish)
    if len(crossing):
        n = len(values) // chunk + 1
        value, length, reset = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.int64), np.ones(n, dtype=bool)
        tail = begin[crossing]  # the prefix that a chunk leaves open
        edge = (tail + 1) * chunk
        value[tail], length[tail] = part(starts[crossing], edge), edge - starts[crossing]
        for w in crossing[finish[crossing] - begin[crossing] > 1].tolist():  # chunks that lie inside one word
            inside = np.arange(begin[w] + 1, finish[w])
            value[inside], length[inside], reset[inside] = part(inside * chunk, (inside + 1) * chunk), chunk, False
        step = 1
        while step < n and not reset[step:].all():
            open_ = np.flatnonzero(~reset[step:]) + step
            left = open_ - step
            value[open_], length[open_], reset[open_] = value[left] + value[open_] * _power(length[left]), length[left] + length[open_], reset[left]
            step *= 2
        into = finish[crossing]
        incoming = into - 1
        raw[crossing] = value[incoming] + _power(length[incoming]) * part(into * chunk, ends[crossing])
        size[crossing] = length[incoming] + ends[crossing] - into * chunk
    return mix(raw + size.astype(np.uint64))


def _power(n: np.ndarray) -> np.ndarray:
    return powers(int(n.max()) + 1)[0][n] if len(n) else n.astype(np.uint64)


_compiled: dict[str, Transducer] = {}


def text_counts(texts, path: str) -> np.ndarray:
    """The number of tokens of each text."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    out = np.zeros(len(texts), dtype=np.int64)
    for block in split_words(texts, path):
        if isinstance(block, tuple):
            number, text = block
            out[number] = _compiled[path].counts(listed_words(library_words(text, path)))[0]
        else:
            out[block.first : block.first + len(block.cuts) - 1] = _compiled[path].counts(block)
    return out


def listed_words(words: list[str]) -> Words:
    codes = np.frombuffer("\n".join([*words, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    ends = np.cumsum([len(w) + 1 for w in words], dtype=np.int64) - 1
    return Words(0, codes, ends - [len(w) for w in words] if words else ends, ends, np.array([0, len(words)]), plain=False)


def token_counts(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for each row of ``docs``."""
    path = path or vocabulary_path()

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            tokens = text_counts(batch["text"], path)
            size = [len(t.encode("utf-8", "surrogatepass")) if isinstance(t, str) else 0 for t in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "n_bytes": pd.Series(size, dtype="int64"), "n_tokens": tokens, "over_limit": tokens > LIMIT})

    return docs.select("doc_id", "text").mapInPandas(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

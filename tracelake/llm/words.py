"""Texts cut into the words of a tokenizer that lower-cases and splits before it merges.

The rules are those that the vocabulary file states: normal form C, lower case, then runs of letters, single numbers, contractions, runs of
anything else but white space. Texts below U+0250, where each rule is a table look-up, are cut in numpy, many at once; any other text and texts with
the strings of special tokens are given to the library's own normalizer and splitter.
"""

from __future__ import annotations

import functools
import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

from .common import mix, span_hashes

#: A text's characters that are cut at once; a longer single text is a block of its own.
BLOCK_CHARS = 1 << 20
_TABLE = 0x250
_SPACE, _LETTER, _NUMBER, _OTHER = 0, 1, 2, 3
# White space below U+0250, and capitals whose lower-case form is outside of it.
_SPACES = [*range(0x09, 0x0E), 0x20, 0x85, 0xA0]
_OUTSIDE = [0x130, 0x23A, 0x23E]


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    """Where the public vocabulary file lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def rules(path: str):
    """The library's normalizer and splitter, and the special tokens."""
    from tokenizers import Regex, pre_tokenizers

    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
    splitter = pre_tokenizers.Split(Regex(split["pattern"]["Regex"]), split["behavior"].lower(), invert=split["invert"])
    return tokenizer(path).normalizer, splitter, tuple(t["content"] for t in spec["added_tokens"])


def _class_of(code: int) -> int:
    kind = unicodedata.category(chr(code))[0]
    return _SPACE if code in _SPACES else _LETTER if kind == "L" else _NUMBER if kind == "N" else _OTHER


_CLASSES = np.array([_class_of(c) for c in range(_TABLE)], dtype=np.int8)
_LOWER = np.array([ord(chr(c).lower()) if len(chr(c).lower()) == 1 else 0 for c in range(_TABLE)], dtype=np.uint32)


@dataclass
class Words:
    """The words of some texts, in order."""

    first: int  # number of the first text
    codes: np.ndarray  # lower-case characters
    starts: np.ndarray
    ends: np.ndarray
    cuts: np.ndarray  # where each text's words begin, and the end
    plain: bool = True  # cut by the tables

    @functools.cached_property
    def hashes(self) -> np.ndarray:
        return span_hashes(mix(self.codes.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)), self.starts, self.ends)

    def word(self, i: int) -> str:
        return self.codes[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le", "surrogatepass")


def is_plain(codes: np.ndarray, text: str, specials: tuple[str, ...]) -> bool:
    return (not len(codes) or int(codes.max()) < _TABLE) and not np.isin(codes, _OUTSIDE).any() and not any(s in text for s in specials)


def split_words(texts, path: str) -> Iterator[Words | tuple[int, str]]:
    """The texts' words block by block; ``(number, text)`` for each text that the tables can't cut."""
    specials = rules(path)[2]
    parts: list[np.ndarray] = []
    first = size = 0
    for at, text in enumerate(texts):
        text = text if isinstance(text, str) else ""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        plain = is_plain(codes, text, specials)
        if parts and (not plain or size + len(codes) > BLOCK_CHARS):
            yield _cut(first, parts)
            parts, size = [], 0
        if not plain:
            yield at, text
            continue
        if not parts:
            first = at
        parts.append(codes)
        size += len(codes) + 1
    if parts:
        yield _cut(first, parts)


def _cut(first: int, parts: list[np.ndarray]) -> Words:
    blank = np.array([0x20], dtype=np.uint32)
    raw = np.concatenate([x for p in parts for x in (p, blank)])
    rows = np.concatenate((np.zeros(1, dtype=np.int64), np.cumsum([len(p) + 1 for p in parts])))
    codes, kind = _LOWER[raw], _CLASSES[raw]
    before = np.concatenate((np.zeros(1, dtype=np.int8), kind[:-1]))
    start = (kind != _SPACE) & ((kind != before) | (kind == _NUMBER))
    quote = np.flatnonzero((codes == 0x27) & (before != _OTHER))
    if len(quote):
        after = np.concatenate((codes, np.zeros(2, dtype=np.uint32)))
        one, two = after[quote + 1], after[quote + 2]
        long_ = np.zeros(len(quote), dtype=bool)
        for a, b in ("re", "ve", "ll"):
            long_ |= (one == ord(a)) & (two == ord(b))
        short = np.isin(one, [ord(c) for c in "stmd"])
        found, size = quote[long_ | short], np.where(long_, 3, 2)[long_ | short]
        start[found + 1] = False
        follow = found + size
        start[follow] = kind[follow] != _SPACE
    starts = np.flatnonzero(start)
    stop = start | (kind == _SPACE)
    stops = np.flatnonzero(np.append(stop, True))
    ends = stops[np.searchsorted(stops, starts, side="right")]
    return Words(first, codes, starts, ends, np.searchsorted(starts, rows))


def library_words(text: str, path: str) -> list[str]:
    """The words of any text by the library's rules; special tokens are words of their own."""
    normalizer, splitter, specials = rules(path)
    words, at = [], 0
    while True:
        next_ = min(((i, -len(s), s) for s in specials if (i := text.find(s, at)) >= 0), default=None)
        part = text[at : next_[0]] if next_ else text[at:]
        words += [w for w, _ in splitter.pre_tokenize_str(normalizer.normalize_str(part))] if part else []
        if not next_:
            return words
        words.append(next_[2])
        at = next_[0] + len(next_[2])

"""Text of unknown charset: byte-order marks, the places of zero bytes, and pairs of neighbouring bytes.

UTF-8 is told in the JVM; this is for what is left.
"""

from __future__ import annotations

import codecs
import functools
import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# Byte-order marks, longer ones first.
MARKS = [
    (b"\xff\xfe\x00\x00", "UTF-32LE"), (b"\x00\x00\xfe\xff", "UTF-32BE"), (b"\xef\xbb\xbf", "UTF-8"), (b"\xff\xfe", "UTF-16LE"), (b"\xfe\xff", "UTF-16BE"),
]
# Code pages that are tried, the likelier first; of equal ones the first is taken.
CODE_PAGES = ["windows-1252", "windows-1251", "windows-1250", "windows-1253", "windows-1254", "KOI8-R", "IBM850", "IBM866", "macintosh"]
WIDE_PAGES = ["Shift_JIS", "EUC-JP", "GB18030", "Big5", "EUC-KR"]

# Of the 16-bit units of a text without a mark, as many have a zero in one half, and the other half has few; most of the other units share that half's byte, as
# letters of one script do. A text of ideographs is known by its mark only.
ZERO_SHARE = 0.05
SAME_SHARE = 0.8
# A text of a code page has fewer odd pairs among those with a byte above 7F, and a wide one more usual characters.
ODD_SHARE = 0.2
USUAL_SHARE = 0.7
TOGETHER_SHARE = 0.6
KANA_SHARE = 0.2
HANGUL_SHARE = 0.8

_SPACE, _LOWER, _UPPER, _DIGIT, _MARK, _SIGN, _CONTROL = range(7)
_LATIN, _OTHER = 0, 1
_KINDS = 7
_ALLOWED_CONTROLS = b"\t\n\r\x0b\x0c\x1a\x1b"


def _kind(char: str) -> int:
    """Class of a character, with the script of a letter as a second digit."""
    category = unicodedata.category(char)
    if char.isspace():
        return _SPACE
    if category[0] == "L":
        name = unicodedata.name(char, "")
        script = _LATIN if name.startswith("LATIN") or category in ("Lm", "Lo") else _OTHER
        return (_UPPER if category in ("Lu", "Lt") else _LOWER) + _KINDS * script
    if category[0] == "N":
        return _DIGIT
    if category[0] == "C":
        return _CONTROL
    # Signs that stand by themselves, and marks that touch words.
    return _SIGN if ord(char) > 127 and (category in ("So", "Sm", "Sk", "Sc") or char in "¶§†‡") else _MARK


@functools.cache
def _byte_kinds(page: str) -> np.ndarray:
    kinds = []
    for b in range(256):
        try:
            char = bytes([b]).decode(page)
            kinds.append(_SPACE if b in _ALLOWED_CONTROLS else _kind(char))
        except UnicodeDecodeError:
            kinds.append(_CONTROL)
    return np.array(kinds)


@functools.cache
def _odd_pairs() -> np.ndarray:
    """Pairs of kinds that text hardly has: a capital after a small letter, a sign beside a letter, letters of two scripts together, and any control character."""
    n = 2 * _KINDS
    odd = np.zeros((n, n), dtype=bool)
    letters = [(k, s) for k in (_LOWER, _UPPER) for s in (_LATIN, _OTHER)]
    for a, s in letters:
        for b, t in letters:
            odd[a + _KINDS * s, b + _KINDS * t] = s != t or (a, b) == (_LOWER, _UPPER)
        odd[a + _KINDS * s, _SIGN] = odd[_SIGN, a + _KINDS * s] = True
    odd[_CONTROL, :] = odd[:, _CONTROL] = True
    return odd


def odd_share(data: np.ndarray, page: str) -> float:
    """Share of odd pairs among the pairs of neighbouring bytes of which one is above 7F; a control character anywhere makes it 1."""
    kinds = _byte_kinds(page)[data]
    if (kinds == _CONTROL).any():
        return 1.0
    padded = np.concatenate(([_SPACE], kinds, [_SPACE]))
    high = np.concatenate(([False], data > 127, [False]))
    pairs = np.bincount((padded[:-1] * 2 * _KINDS + padded[1:])[high[:-1] | high[1:]], minlength=4 * _KINDS**2)
    return float((pairs * _odd_pairs().ravel()).sum() / max(1, pairs.sum()))


def _wide(content: bytes, data: np.ndarray) -> tuple[str, str] | None:
    """Charset and text of content whose bytes above 7F stand together and decode to East Asian writing; by what share of it is kana, hangul or neither."""
    high = data > 127
    beside = np.concatenate(([False], high[:-1])) | np.concatenate((high[1:], [False]))
    if not high.any() or beside[high].mean() < TOGETHER_SHARE:
        return None
    found = {}
    for name in WIDE_PAGES:
        if (text := _decoded(content, name)) is not None:
            codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
            codes = codes[codes > 127]
            kana, hangul = ((codes >= low) & (codes < end) for low, end in ((0x3040, 0x3100), (0xAC00, 0xD7A4)))
            written = kana | hangul | (codes >= 0x3000) & (codes < 0x3040) | (codes >= 0x4E00) & (codes < 0xA000) | (codes >= 0xFF00) & (codes < 0xFF61)
            if len(codes) and written.mean() >= USUAL_SHARE:
                found[name] = text, float(kana.mean()), float(hangul.mean())
    for name in ("Shift_JIS", "EUC-JP"):
        if name in found and found[name][1] >= KANA_SHARE:
            return name, found[name][0]
    if "EUC-KR" in found and found["EUC-KR"][2] >= HANGUL_SHARE:
        return "EUC-KR", found["EUC-KR"][0]
    # In one the second byte of a character is above A0 nearly always, in the other often below 7F.
    order = ("GB18030", "Big5") if high.mean() >= 0.95 or (data[1:][high[:-1]] > 127).mean() > 0.9 else ("Big5", "GB18030")
    return next(((n, found[n][0]) for n in order if n in found and not found[n][1] + found[n][2]), None)


def _readable(text: str) -> bool:
    return not any(unicodedata.category(c) in ("Cc", "Cn", "Co") and ord(c) not in _ALLOWED_CONTROLS for c in set(text))


def _decoded(content: bytes, charset: str) -> str | None:
    try:
        text = content.decode(charset)
    except UnicodeDecodeError:
        return None
    return text if _readable(text) else None


def detect(content: bytes) -> tuple[str | None, str | None]:
    """Name of the charset and the text; None for content that is not text."""
    for mark, name in MARKS:
        if content.startswith(mark) and (text := _decoded(content[len(mark) :], name)) is not None:
            return name, text
    data = np.frombuffer(content, dtype=np.uint8)
    if len(data) and len(data) % 2 == 0:
        first, second = (float((data[k::2] == 0).mean()) for k in (0, 1))
        for name, here, there in (("UTF-16LE", second, first), ("UTF-16BE", first, second)):
            other = data[name == "UTF-16LE" :: 2]
            other = other[other > 0]
            alike = not len(other) or np.bincount(other).max() >= SAME_SHARE * len(other)
            if alike and here >= ZERO_SHARE and here > 10 * there and (text := _decoded(content, name)) is not None:
                return name, text
    if (data == 0).any():
        return None, None
    share, page = min((odd_share(data, p), k) for k, p in enumerate(CODE_PAGES))
    # Where letters of one script explain all bytes, a code page goes first.
    if share > 0 and (wide := _wide(content, data)):
        return wide
    if share < ODD_SHARE:
        return CODE_PAGES[page], codecs.decode(content, CODE_PAGES[page])
    return None, None


@F.pandas_udf(StructType([StructField("charset", StringType()), StructField("body", StringType())]))
def decoded(contents: pd.Series) -> pd.DataFrame:
    """``charset, body`` of each content, both null where it is null or not text."""
    return pd.DataFrame([detect(c) if c is not None else (None, None) for c in contents], columns=["charset", "body"])

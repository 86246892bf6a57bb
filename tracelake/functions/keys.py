"""Binary identity keys of entries and of hash rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _col

# Fixed values of the key formats.
HASH_WIDTH = 20
KEY_HEAD = HASH_WIDTH + 1
HASH_TYPES = {"md5": 0, "sha1": 1}
HASH_LENGTHS = {0: 16, 1: 20}
MAX_DIR_INDEX = 2**31 - 1


def _slice(key: Column, pos: int, length: int | None = None) -> Column:
    return F.substring(key, pos, length if length is not None else 2**31 - 1)


def _big_endian(value: Column, n_bytes: int) -> Column:
    return F.unhex(F.lpad(F.hex(value), 2 * n_bytes, "0"))


def entry_key(
    image_id: Column | str, path: Column | str = "path", dir_index: Column | str = "dir_index"
) -> Column:
    """36 bytes: first byte of md5(path), image id, rest of md5(path), directory index (int32).

    NULL when the image id is not 16 bytes or the index does not fit, so that a caller can set
    such rows aside.
    """
    image_id, dir_index = _col(image_id), _col(dir_index).cast("bigint")
    digest = F.unhex(F.md5(_col(path)))
    valid = (F.octet_length(image_id) == 16) & dir_index.between(0, MAX_DIR_INDEX)
    key = F.concat(_slice(digest, 1, 1), image_id, _slice(digest, 2, 15), _big_endian(dir_index, 4))
    return F.when(valid, key)


def entry_key_image(key: Column | str) -> Column:
    """Image id inside an entry key."""
    return _slice(_col(key), 2, 16)


def hash_key(hash_: Column | str, hash_type: str, data: Column | str) -> Column:
    """Hash padded with zero bytes to 20, the type byte, then data (an entry id or a column name)."""
    padded = F.call_function("rpad", _col(hash_), F.lit(HASH_WIDTH), F.lit(bytearray(1)))
    return F.concat(padded, F.lit(bytearray([HASH_TYPES[hash_type]])), _col(data))


def is_long_hash_key(key: Column | str) -> Column:
    """True for keys that carry data after the hash."""
    return F.octet_length(_col(key)) > HASH_WIDTH


def hash_key_length(key: Column | str) -> Column:
    """Length of the hash in a long key, 0 for an unknown type byte."""
    kind = F.hex(_slice(_col(key), KEY_HEAD, 1))
    length = F.lit(0)
    for code, size in HASH_LENGTHS.items():
        length = F.when(kind == f"{code:02X}", size).otherwise(length)
    return length


def hash_key_hash(key: Column | str) -> Column:
    key = _col(key)
    return F.substring(key, F.lit(1), hash_key_length(key))


def hash_key_entry_id(key: Column | str) -> Column:
    return _slice(_col(key), KEY_HEAD + 1)


def hash_key_image(key: Column | str) -> Column:
    return entry_key_image(hash_key_entry_id(key))


def hash_fanout(hash_hex: Column | str) -> Column:
    """Two-level folder ``ab/cd`` from the head of a hex hash."""
    hash_hex = _col(hash_hex)
    return F.concat_ws("/", F.substring(hash_hex, 1, 2), F.substring(hash_hex, 3, 2))

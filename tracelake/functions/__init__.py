"""Column builders. Each returns a Column made of built-in functions; none is a UDF."""

from .attrs import byte_extents, resident_content, runs_overflow
from .keys import (
    entry_key,
    entry_key_image,
    hash_fanout,
    hash_key,
    hash_key_entry_id,
    hash_key_hash,
    hash_key_image,
    hash_key_length,
    is_long_hash_key,
)
from .names import entry_text_id, extension, full_path
from .once import once
from .times import ctime_text, positive_timestamp

__all__ = [
    "byte_extents",
    "ctime_text",
    "entry_key",
    "entry_key_image",
    "entry_text_id",
    "extension",
    "full_path",
    "hash_fanout",
    "hash_key",
    "hash_key_entry_id",
    "hash_key_hash",
    "hash_key_image",
    "hash_key_length",
    "is_long_hash_key",
    "once",
    "positive_timestamp",
    "resident_content",
    "runs_overflow",
]

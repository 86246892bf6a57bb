"""File attributes: resident bytes and the byte ranges of non-resident data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .names import _col

# Fixed bit values of attribute flags and types, and the name of the default data attribute.
RESIDENT_FLAG = 0x04
DATA_TYPE = 0x80
IN_USE_OR_NONRESIDENT = 0x03
DEFAULT_OR_DATA = 0x81
DATA_NAME = "$Data"


def _has_bits(value: Column, mask: int) -> Column:
    return value.bitwiseAND(F.lit(mask)) > 0


def resident_content(attrs: Column | str = "attrs", content: Column | str | None = None) -> Column:
    """Bytes of the first resident data attribute, unless ``content`` is already there.

    An absent or empty buffer gives NULL.
    """
    resident = F.filter(
        _col(attrs),
        lambda a: _has_bits(a["flags"], RESIDENT_FLAG)
        & _has_bits(a["type"], DATA_TYPE)
        & (a["name"] == DATA_NAME),
    )
    buffer = F.get(resident, F.lit(0))["rd_buf"]
    lifted = F.when(F.length(buffer) > 0, F.unhex(buffer))
    return lifted if content is None else F.coalesce(_col(content), lifted)


def byte_extents(
    attrs: Column | str = "attrs",
    fs_byte_offset: Column | str = "fs_byte_offset",
    block_size: Column | str = "fs_block_size",
) -> Column:
    """Runs of the first attribute that has some, in bytes from the start of the image.

    NULL when no attribute qualifies or the file system is unknown, and when a run of a corrupt record lies
    beyond what 64 bits can address (see ``runs_overflow``).
    """
    extents = _extents(attrs, fs_byte_offset, block_size)
    return F.when(~F.exists(extents, lambda x: x["addr"].isNull() | x["offset"].isNull() | x["len"].isNull()), extents)


def runs_overflow(
    attrs: Column | str = "attrs",
    fs_byte_offset: Column | str = "fs_byte_offset",
    block_size: Column | str = "fs_block_size",
) -> Column:
    """True for a record with runs that cannot be addressed; it has no usable extents."""
    bad = F.exists(_extents(attrs, fs_byte_offset, block_size), lambda x: x["addr"].isNull() | x["offset"].isNull() | x["len"].isNull())
    return F.coalesce(bad, F.lit(False))


def _extents(attrs: Column | str, fs_byte_offset: Column | str, block_size: Column | str) -> Column:
    """Runs in bytes; a number that overflows is NULL."""
    base, block = _col(fs_byte_offset), _col(block_size)
    with_runs = F.filter(
        _col(attrs),
        lambda a: _has_bits(a["flags"], IN_USE_OR_NONRESIDENT)
        & _has_bits(a["type"], DEFAULT_OR_DATA)
        & (F.size(a["nrd_runs"]) > 0),
    )
    runs = F.get(with_runs, F.lit(0))["nrd_runs"]
    extents = F.transform(
        runs,
        lambda r: F.struct(
            r["flags"].alias("flags"),
            F.try_add(F.try_multiply(r["addr"], block), base).alias("addr"),
            F.try_multiply(r["offset"], block).alias("offset"),
            F.try_multiply(r["len"], block).alias("len"),
        ),
    )
    return F.when(base.isNotNull() & block.isNotNull(), extents)

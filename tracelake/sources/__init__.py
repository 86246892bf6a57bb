"""Readers. Every reader returns DataFrames; rows that do not parse come back in a frame of their own."""

from .entries import ParsedEntries, parse_entry_lines, read_entries, scan_entries
from .images import image_files, image_ranges
from .patterns import Pattern, load_patterns, make_patterns, pattern_rows, read_pattern_rows
from .refset import (
    parse_mfg,
    parse_os,
    parse_products,
    parse_ref_files,
    read_mfg,
    read_os,
    read_products,
    read_ref_files,
)

__all__ = [
    "ParsedEntries",
    "Pattern",
    "image_files",
    "image_ranges",
    "load_patterns",
    "make_patterns",
    "parse_entry_lines",
    "parse_mfg",
    "parse_os",
    "parse_products",
    "parse_ref_files",
    "pattern_rows",
    "read_entries",
    "read_mfg",
    "read_os",
    "read_pattern_rows",
    "read_products",
    "read_ref_files",
    "scan_entries",
]

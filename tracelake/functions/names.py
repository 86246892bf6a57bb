"""Names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extension(name: Column | str = "name") -> Column:
    """Lower-cased text after the last dot, ``''`` when there is none."""
    return F.lower(F.regexp_extract(_col(name), r"\.([^.]+)\z", 1))


def full_path(path: Column | str = "path", name: Column | str = "name") -> Column:
    """Path and name with one ``/`` between them, unless the path is empty or ends in one."""
    path, name = _col(path), _col(name)
    needs_slash = (F.length(path) > 0) & ~path.endswith("/")
    return F.concat(path, F.when(needs_slash, F.lit("/")).otherwise(F.lit("")), name)


def entry_text_id(
    path: Column | str = "path", name: Column | str = "name", dir_index: Column | str = "dir_index"
) -> Column:
    """Readable id: path, name, a dash, directory index."""
    return F.concat(_col(path), _col(name), F.lit("-"), _col(dir_index).cast("string"))

"""The registered queries and, where SQL can say the same, their oracle statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import clustering, content, entries, inventory, known, reports, scripts, search, similarity, text, written

_AREAS = (entries, inventory, known, content, search, text, clustering, similarity, scripts, reports, written)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q for area in _AREAS for name, q in area.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for area in _AREAS for name, sql in area.ORACLES.items()}

"""Evaluate an expression once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, expression: Column) -> DataFrame:
    """Add a costly column that is used in several places.

    The optimizer copies the expression of a plain column into every filter and projection that
    uses it. A one-element ``explode`` is a row generator, which it does not see through.
    """
    return df.select("*", F.explode(F.array(expression)).alias(name))

"""Literal dictionaries as map columns: a lookup without a join."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(table: Mapping, key: Column) -> Column:
    """Value of ``key`` in a small fixed dictionary, NULL when absent."""
    pairs = [F.lit(part) for item in table.items() for part in item]
    return F.try_element_at(F.create_map(*pairs), key)

"""Code lookups as CASE expressions, which stay inside generated code."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def lookup(key: Column, table: Mapping) -> Column:
    """Value of ``key`` in ``table``; NULL for a missing or NULL key."""
    by_value: dict = {}
    for code, value in table.items():
        by_value.setdefault(value, []).append(code)
    return lookup_groups(key, by_value)


def lookup_groups(key: Column, groups: Mapping) -> Column:
    """The entry of ``groups`` (value -> codes) whose codes hold ``key``, else NULL."""
    out = None
    for value, codes in groups.items():
        hit = key == codes[0] if len(codes) == 1 else key.isin(*codes)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return out


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (NULL counts as 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))

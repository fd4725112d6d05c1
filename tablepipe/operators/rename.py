"""Rename every column by a rule (lower / upper / capitalize)."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..functions.naming import rename_map


def rename_columns(df: DataFrame, rule: str = "lower") -> DataFrame:
    """One projection with new names; refuses names that collide."""
    mapping = rename_map(df.columns, rule)
    if all(old == new for old, new in mapping.items()):
        return df
    return df.withColumnsRenamed(mapping)

"""Rows of a table that are, or are not, among given ids.

Plain joins: the planner broadcasts the ids where they are few by its byte limit, at run time too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def rows_of(table: DataFrame, wanted: DataFrame, key: str = "file_id") -> DataFrame:
    """Rows of a table whose key is wanted."""
    return table.join(wanted.select(key).distinct(), key, "left_semi")


def rows_without(table: DataFrame, unwanted: DataFrame, key: str = "file_id") -> DataFrame:
    """Rows of a table whose key is not among the unwanted."""
    return table.join(unwanted.select(key).distinct(), key, "left_anti")

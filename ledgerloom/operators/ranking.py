"""Sorting, top k, samples and group numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.operators.slices import number_rows


def sort_by(df: DataFrame, order: Sequence[tuple[str, str]]) -> DataFrame:
    """Sort by (column, direction); directions: asc, desc, with ``_nulls_first|last``."""
    return df.orderBy(*_keys(order))


def top_k(df: DataFrame, order: Sequence[tuple[str, str]], k: int) -> DataFrame:
    """The k first rows of the order; each task keeps k rows, nothing is sorted whole."""
    return df.orderBy(*_keys(order)).limit(k)


def sample_rows(df: DataFrame, predicate: Column, order: Sequence[str], n: int = 25) -> DataFrame:
    """The first n matching rows, in a stable order, for a report of examples."""
    return df.where(predicate).orderBy(*order).limit(n)


def number_groups(groups: DataFrame, order: Sequence[str], name: str = "group_id") -> DataFrame:
    """Sequential numbers in sorted order, worked out slice by slice."""
    return number_rows(groups, order, name)


def _keys(order: Sequence[tuple[str, str]]) -> list[Column]:
    return [getattr(F.col(column), direction)() for column, direction in order]

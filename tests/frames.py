"""Helpers of the tests."""

from __future__ import annotations


def values_of(df, keys, column="values"):
    """Vectors by key, for numpy comparison."""
    return {tuple(r[k] for k in keys): r[column] for r in df.collect()}

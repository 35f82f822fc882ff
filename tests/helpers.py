"""Comparison helpers."""

from __future__ import annotations


def rows(df, *columns):
    """All rows as a sorted list of tuples, for comparison without order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: tuple((v is None, str(v)) for v in t))


def by(df, key):
    """Rows as a dict keyed by one column."""
    return {r[key]: r for r in df.collect()}

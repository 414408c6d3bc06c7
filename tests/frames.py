"""Helpers of the tests over DataFrames."""

from __future__ import annotations

import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def rows(df, *order):
    """Plain tuples, sorted."""
    return sorted((tuple(r) for r in (df.select(*order) if order else df).collect()), key=repr)

"""Frames that state processors hand back to Spark."""

from __future__ import annotations

from collections.abc import Iterable

import pandas as pd


def frame(fields: list[str], columns: dict[str, Iterable]) -> pd.DataFrame:
    """All ``fields`` in order, absent ones null. Plain object columns: text columns backed by Arrow may come in several chunks, which the
    serializer of stateful operators doesn't take."""
    length = len(next(iter(columns.values())))
    return pd.DataFrame({f: pd.Series(list(columns[f]) if f in columns else [None] * length, dtype=object) for f in fields})

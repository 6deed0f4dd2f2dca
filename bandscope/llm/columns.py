"""Columns of a table that bear the names an operator adds."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def set_aside(rows: DataFrame, added: Iterable[str]) -> tuple[DataFrame, dict[str, str]]:
    """`rows` with columns of the added names renamed, and the other names by the old ones."""
    taken, other = set(rows.columns), {}
    for name in added:
        if name in taken:
            other[name] = f"_kept_{name}"
            while other[name] in taken:
                other[name] += "_"
            taken.add(other[name])
    return rows.withColumnsRenamed(other), other


def put_back(rows: DataFrame, columns: Iterable[str], other: dict[str, str]) -> DataFrame:
    """The given columns under their old names."""
    return rows.select(*(F.col(f"`{other.get(c, c)}`").alias(c) for c in columns))

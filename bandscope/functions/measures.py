"""Aggregate expressions behind the cohort reports.

All keep fixed-width buffers (counts, sums), so Spark stays on hash aggregation with a
partial step before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bandscope.spec import Factor


def factor_aggregates(factors: Sequence[Factor]) -> list[Column]:
    """Columns mean_<name>, or n_<name> and pct_<name>.

    A row whose predicate is NULL is not counted as matching and stays in the denominator.
    """
    out: list[Column] = []
    for factor in factors:
        if factor.kind == "mean":
            out.append(F.expr(f"round(avg({factor.expr}), 2) AS mean_{factor.name}"))
        else:
            matching = f"count_if({factor.expr})"
            out.append(F.expr(f"{matching} AS n_{factor.name}"))
            out.append(F.expr(f"round({matching} / count(*) * 100, 2) AS pct_{factor.name}"))
    return out

"""Band labels and display order, both from one BandSpec."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from bandscope.spec import BandSpec


def band(grade: Column | str, spec: BandSpec) -> Column:
    """Label of the band a grade falls in. NULL and unlisted grades take the default."""
    grade = F.col(grade) if isinstance(grade, str) else grade
    chain = F
    for label, grades in spec.members.items():
        if grades and label != spec.default:
            chain = chain.when(grade.isin(*grades), F.lit(label))
    return F.lit(spec.default) if chain is F else chain.otherwise(F.lit(spec.default))


def value_rank(value: Column | str, ordered: Sequence) -> Column:
    """1-based position of value in ordered; anything else, NULL included, ranks after all."""
    value = F.col(value) if isinstance(value, str) else value
    if not ordered:
        return F.lit(1)
    chain = F
    for position, item in enumerate(ordered, start=1):
        chain = chain.when(value == F.lit(item), F.lit(position))
    return chain.otherwise(F.lit(len(ordered) + 1))


def band_rank(label: Column | str, spec: BandSpec) -> Column:
    return value_rank(label, spec.labels)

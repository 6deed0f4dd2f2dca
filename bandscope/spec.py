"""Declarations the operators work from.

Predicates and measures are Spark SQL expression strings, so a spec can be written down
before any session exists and compared, printed or loaded from configuration.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class BandSpec:
    """Ordered bands over a categorical grade.

    ``members`` maps each band label to the grades it takes, in display order.
    Every other grade, NULL included, belongs to ``default``.
    """

    members: Mapping[str, Sequence]
    default: str

    def __post_init__(self):
        if self.default not in self.members:
            raise ValueError(f"default band {self.default!r} is not one of {list(self.members)}")
        grades = [g for taken in self.members.values() for g in taken]
        repeated = sorted({g for g in grades if grades.count(g) > 1})
        if repeated:
            raise ValueError(f"grades listed in more than one band: {repeated}")

    @property
    def labels(self) -> list[str]:
        return list(self.members)


@dataclass(frozen=True)
class Factor:
    """One quantity compared between bands.

    kind "mean": the average of ``expr`` over rows where it is not NULL.
    kind "rate": the percentage of all rows of the band for which ``expr`` is true.
    """

    name: str
    kind: str
    expr: str

    def __post_init__(self):
        if not self.name.isidentifier():
            raise ValueError(f"factor name {self.name!r} cannot be part of a column name")
        if self.kind not in ("mean", "rate"):
            raise ValueError(f"factor {self.name!r}: kind must be 'mean' or 'rate'")


def mean(name: str, expr: str) -> Factor:
    return Factor(name, "mean", expr)


def rate(name: str, predicate: str) -> Factor:
    return Factor(name, "rate", predicate)


@dataclass(frozen=True)
class Dimension:
    """A dimension as the mart builder joins it: ``fact_key`` = ``key``.

    Only ``attributes`` reach the mart. ``unique`` states that the key is unique by
    construction (for example the output of a groupBy), so it is not checked again.
    """

    name: str
    frame: DataFrame
    key: str
    fact_key: str
    attributes: Sequence[str]
    unique: bool = False


@dataclass(frozen=True)
class StarSpec:
    """How a flat bronze table splits into a star.

    The mappings go from bronze column to star column. ``category`` is the bronze column
    whose distinct values become the category dimension.
    """

    key: str
    key_alias: str
    entity: Mapping[str, str]
    behaviour: Mapping[str, str]
    category: str
    category_alias: str
    category_id: str
    fact: Mapping[str, str] = field(default_factory=dict)

    @property
    def bronze_columns(self) -> list[str]:
        wanted = [self.key, *self.entity, *self.behaviour, self.category, *self.fact]
        return list(dict.fromkeys(wanted))

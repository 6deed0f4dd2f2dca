"""The wide mart: fact rows with their dimension attributes and a band."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.functions.bands import band
from bandscope.functions.casts import to_type
from bandscope.sources.contract import require_columns
from bandscope.spec import BandSpec, Dimension


def refuse_duplicates(fact: DataFrame, dimension: Dimension) -> DataFrame:
    """Fail the query that reads the result if a key of the dimension repeats.

    The check is a scalar subquery on the key column alone: it runs once, before the joins,
    and counts partially before its shuffle, so one hot key does not gather in a task.
    """
    repeated = (
        dimension.frame.where(F.col(dimension.key).isNotNull())
        .groupBy(dimension.key)
        .agg(F.count("*").alias("rows_per_key"))
        .where(F.col("rows_per_key") > 1)
        .agg(F.count("*"))
        .scalar()
    )
    message = f"dimension {dimension.name}: key {dimension.key} is not unique"
    return fact.where(
        F.when(repeated > 0, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True))
    )


def build_mart(
    fact: DataFrame,
    dimensions: Sequence[Dimension],
    bands: BandSpec,
    grade: str,
    casts: Mapping[str, str] | None = None,
    allow_fan_out: bool = False,
    band_col: str = "band",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Left-join the dimensions to the fact, cast the named columns and add the band.

    Every fact row is kept; a key without a dimension row, or a NULL key, gets NULL
    attributes. The grade may come from the fact or from a dimension. Join strategy is left to
    Spark's size estimates. With ``columns`` the mart has these columns and the band, and a
    dimension that gives none of them is neither joined nor checked, unless it may fan out.
    """
    if columns is not None:
        wanted = {grade, *columns}
        dimensions = [
            d
            for d in dimensions
            if wanted & set(d.attributes) or (allow_fan_out and not d.unique)
        ]
        casts = {name: target for name, target in (casts or {}).items() if name in wanted}
    require_columns(fact, [d.fact_key for d in dimensions])
    mart = fact
    for dimension in dimensions:
        require_columns(dimension.frame, [dimension.key, *dimension.attributes])
        if not (dimension.unique or allow_fan_out):
            mart = refuse_duplicates(mart, dimension)
    for dimension in dimensions:
        side = dimension.frame.select(
            F.col(dimension.key).alias("_dimension_key"), *dimension.attributes
        )
        mart = mart.join(
            side, mart[dimension.fact_key] == side["_dimension_key"], "left"
        ).drop("_dimension_key")
    typed = {name: to_type(name, target) for name, target in (casts or {}).items()}
    require_columns(mart, [grade, *typed])
    banded = mart.withColumns({**typed, band_col: band(grade, bands)})
    if columns is None:
        return banded
    return require_columns(banded, columns).select(*dict.fromkeys([*columns, band_col]))


def entity_measure_pairs(
    entity: DataFrame, fact: DataFrame, key: str, attribute: str, measure: str
) -> DataFrame:
    """An entity attribute beside a fact measure, for matching rows where both are present."""
    require_columns(entity, [key, attribute])
    require_columns(fact, [key, measure])
    return (
        entity.select(key, attribute)
        .where(F.col(attribute).isNotNull())
        .join(fact.select(key, measure).where(F.col(measure).isNotNull()), key, "inner")
        .select(attribute, measure)
    )

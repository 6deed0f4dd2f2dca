"""Split a flat bronze table into entity, behaviour and category dimensions plus a fact."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandscope.operators.keys import category_dim, resolve_fk
from bandscope.sources.contract import require_columns
from bandscope.spec import StarSpec


def renamed(columns: Mapping[str, str]) -> list[Column]:
    return [F.col(source).alias(target) for source, target in columns.items()]


def entity_key(spec: StarSpec) -> Column:
    return F.col(spec.key).cast("string").alias(spec.key_alias)


def entity_dim(bronze: DataFrame, spec: StarSpec) -> DataFrame:
    return bronze.select(entity_key(spec), *renamed(spec.entity))


def behaviour_dim(bronze: DataFrame, spec: StarSpec) -> DataFrame:
    return bronze.select(entity_key(spec), *renamed(spec.behaviour))


def fact_rows(bronze: DataFrame, spec: StarSpec) -> DataFrame:
    """One fact row per bronze row, carrying the category by name."""
    return bronze.select(
        entity_key(spec), F.col(spec.category).alias(spec.category_alias), *renamed(spec.fact)
    )


def split_star(bronze: DataFrame, spec: StarSpec) -> dict[str, DataFrame]:
    """The four star tables. Keys are strings; the fact holds the category's id and name."""
    require_columns(bronze, spec.bronze_columns)
    category = category_dim(
        bronze, spec.category, spec.category_alias, spec.category_id
    ).withColumn(spec.category_id, F.col(spec.category_id).cast("string"))
    fact = resolve_fk(
        fact_rows(bronze, spec), category, spec.category_alias, spec.category_alias, spec.category_id
    )
    return {
        "entity": entity_dim(bronze, spec),
        "behaviour": behaviour_dim(bronze, spec),
        "category": category,
        "fact": fact,
    }

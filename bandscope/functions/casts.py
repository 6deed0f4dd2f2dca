"""Casts that turn malformed text into NULL instead of failing the job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_type(value: Column | str, target: T.DataType | str) -> Column:
    """try_cast; integral targets also accept a decimal spelling such as '22.0'.

    Integers with missing values are often exported as '22.0'. The exact integer cast is
    tried first so that large identifiers never pass through a double.
    """
    value = F.col(value) if isinstance(value, str) else value
    name = target if isinstance(target, str) else target.simpleString()
    exact = value.try_cast(name)
    if name in ("tinyint", "smallint", "int", "integer", "bigint", "long"):
        return F.coalesce(exact, value.try_cast("double").try_cast(name))
    return exact

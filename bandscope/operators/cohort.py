"""Cohort reports: how factors differ between bands."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandscope.functions.bands import band_rank
from bandscope.functions.measures import factor_aggregates
from bandscope.spec import BandSpec, Factor


def by_band(mart: DataFrame, factors: Sequence[Factor], band_col: str) -> DataFrame:
    return mart.groupBy(band_col).agg(F.count("*").alias("total"), *factor_aggregates(factors))


def cohort_report(
    mart: DataFrame, factors: Sequence[Factor], bands: BandSpec, band_col: str = "band"
) -> DataFrame:
    """One row per band with its row count and every factor, from a single scan of the mart."""
    return by_band(mart, factors, band_col).orderBy(band_rank(band_col, bands), band_col)


def cohort_mean(
    mart: DataFrame, name: str, measure: str, bands: BandSpec, band_col: str = "band"
) -> DataFrame:
    return cohort_report(mart, [Factor(name, "mean", measure)], bands, band_col)


def cohort_rate(
    mart: DataFrame, name: str, predicate: str, bands: BandSpec, band_col: str = "band"
) -> DataFrame:
    """Matching rows, all rows and their percentage per band.

    A row whose predicate is NULL stays in the denominator and is not counted as matching.
    """
    return cohort_report(mart, [Factor(name, "rate", predicate)], bands, band_col)


def factor_scorecard(
    mart: DataFrame, factors: Sequence[Factor], bands: BandSpec, band_col: str = "band"
) -> DataFrame:
    """Every factor of every band in long form: band, factor, kind, matching, total, value."""
    lines = ", ".join(
        f"{position}, '{f.name}', '{f.kind}', "
        + (f"n_{f.name}, pct_{f.name}" if f.kind == "rate" else f"NULL, mean_{f.name}")
        for position, f in enumerate(factors)
    )
    unpivoted = f"stack({len(factors)}, {lines}) AS (position, factor, kind, matching, value)"
    return (
        by_band(mart, factors, band_col)
        .selectExpr(band_col, "total", unpivoted)
        .orderBy("position", band_rank(band_col, bands), band_col)
        .selectExpr(
            band_col, "factor", "kind", "CAST(matching AS bigint) AS matching", "total", "value"
        )
    )


def factor_gap(scorecard: DataFrame, low: str, high: str, band_col: str = "band") -> DataFrame:
    """Per factor, the value in the low band minus the value in the high band."""
    value_in = lambda label: F.max(F.when(F.col(band_col) == label, F.col("value")))
    return (
        scorecard.groupBy("factor", "kind")
        .agg(value_in(low).alias("low_value"), value_in(high).alias("high_value"))
        .withColumn("gap", F.round(F.col("low_value") - F.col("high_value"), 2))
        .orderBy("factor")
    )


def measure_by_band(mart: DataFrame, measure: str, band_col: str = "band") -> DataFrame:
    """The band and one measure, for rows where the measure is present."""
    return mart.select(band_col, measure).where(F.col(measure).isNotNull())

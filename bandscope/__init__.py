"""bandscope: which factors differ between ordered bands of a population, on Spark."""

from bandscope.spec import BandSpec, Dimension, Factor, StarSpec, mean, rate

__all__ = ["BandSpec", "Dimension", "Factor", "StarSpec", "mean", "rate"]

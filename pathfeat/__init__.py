"""Dependency-path features of word pairs on Spark DataFrames."""

from .options import COMPATIBLE, Options
from .plans.pipeline import FeaturePlan, run

__all__ = ["COMPATIBLE", "FeaturePlan", "Options", "run"]

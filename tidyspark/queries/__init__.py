"""All registered queries and their checks."""

from tidyspark.queries import ask, clean, evaluation, features, models, planning, profile, quality, sources, text  # noqa: F401
from tidyspark.queries.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

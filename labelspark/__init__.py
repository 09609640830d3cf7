"""Labelled time-series analytics as plain Spark DataFrame work."""

from labelspark.operators.matchers import Matcher, Selector
from labelspark.plans.federation import Federation

__all__ = ["Federation", "Matcher", "Selector"]

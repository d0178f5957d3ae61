"""Queries of the core and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textloom.plans import oracle, reference

FLAGSHIP = "component_split"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = reference.QUERIES
ORACLE: dict[str, str] = oracle.SQL

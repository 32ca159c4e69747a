"""All registered queries of the record operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordscope.plans import grid_queries, procurement_queries, region_queries, source_queries, stream_queries, text_queries
from recordscope.plans.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "flagship", "grid_queries", "region_queries", "source_queries", "stream_queries", "text_queries"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Awards that match the ban register."""
    return procurement_queries.ban_flags(spark, sf_dir)

"""Every registered query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from contract import load_queries, report_queries, row_queries  # noqa: F401
from contract.adapters import AS_OF, normalized_like
from contract.registry import ORACLES, QUERIES, plain
from tidewatch.plans import analytics
from tidewatch.session import use_utc

__all__ = ["ORACLES", "QUERIES", "flagship"]


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = normalized_like(use_utc(spark), sf_dir, country="r_name")
    return plain(analytics.spikes(events, AS_OF, hours=168))

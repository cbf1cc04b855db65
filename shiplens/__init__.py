"""shiplens: parcel-shipment analytics as Spark DataFrame / SQL / ML / Structured Streaming jobs.

Sub-packages
------------
sources    table loading, fixture views over the driver tables, sinks and profile I/O
functions  column-level rules (calendar, package, ZIP zones, rate cards) and exact percentiles
operators  data quality, summaries, distributions, comparisons, BI reports, features, models, scoring
plans      query registry (name -> DataFrame builder) and the matching DuckDB oracle SQL
streaming  Structured Streaming jobs with batch twins
"""

from shiplens.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]

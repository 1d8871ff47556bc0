"""orrery: DataFrame operators for star-schema cleaning, quality checks,
analytics and batch trip-cost planning, written as plain Spark plans.

Sub-packages:
  functions  Column -> Column expressions (text, numbers, dates, geo)
  operators  DataFrame -> DataFrame operators (joins, keys, aggregates,
             windows, reshape, top-k, quality, geo)
  sources    readers and writers (delimited scans, header cleanup,
             multi-file scans, incremental caches, sinks)
  plans      named compositions (analytic recipes, trip planning)
  streaming  Structured Streaming entry points for the incremental loads
  bindings   the operators bound to the driver tables, each with a
             DuckDB oracle query
"""

__version__ = "0.1.0"

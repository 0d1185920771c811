"""tardy — departure-delay analytics expressed as Spark DataFrame plans.

Layers:
  sources/    readers, writers and the fixtures derived from the driver tables
  functions/  column expressions (scalar derivations, JSON helpers)
  operators/  DataFrame -> DataFrame steps: cleaning, star schema, reports, quality
  plans/      composed jobs, the query catalog and the DuckDB oracle text
  streaming/  Structured Streaming landing, routing and running aggregates
"""

__all__ = ["session"]

"""usagelens: usage-telemetry analytics for developer tools, built on Spark DataFrames.

Layers:
  sources/    read raw log batches, employee CSV, stored fact tables, stand-in views
  functions/  column expressions (guarded casts, labels)
  operators/  decode/route, filters, the fact-to-employee join, rollups, envelopes
  plans/      the page's queries by name, with their DuckDB oracle SQL
  streaming/  incremental load of new log files
"""

__version__ = "0.1.0"

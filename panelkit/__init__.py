"""panelkit: next-product analytics on client panels, built on Spark DataFrames.

Modules:
  session      SparkSession defaults and the shared scratch folder
  schema       client-month snapshot schema, product and code dimensions
  sources/     scans, sinks, JSON rows, stand-in tables over the test data
  functions/   column expressions (scalars, dates, numeric parsing)
  operators/   panel windows, profiling, lookups, ranking, features, model, metrics
  streaming/   Structured Streaming monitors
  plans/       composed jobs and the query catalog used by __spark_entry__
"""

__version__ = "0.1.0"

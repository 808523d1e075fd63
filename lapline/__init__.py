"""lapline: race-result analytics on Spark DataFrames.

Sub-packages:
  functions  column expressions (time conversion, text predicates)
  sources    readers, writers and the fixtures derived from the driver tables
  operators  sheet parsing, link extraction, ingest, cleaning, statistics, models
  plans      the relational query surface (DataFrame and SQL forms)
  streaming  Structured Streaming ingest of sheet files
"""

__version__ = "0.1.0"

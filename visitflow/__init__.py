"""visitflow: Spark-native session analytics over e-commerce visit logs.

Layout:
  sources/    table readers, adapters from the test tables, task parameters, ad-log parsing
  functions/  column expressions (text, time, rounding, k=v text)
  operators/  DataFrame -> DataFrame building blocks (sessions, filters, stats, merges, ...)
  plans/      end-to-end jobs that chain operators and write result tables
  streaming/  Structured Streaming jobs for the ad-click log
"""

__version__ = "0.1.0"

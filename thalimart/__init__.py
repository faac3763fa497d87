"""thalimart: a Spark-native food-delivery star-schema warehouse.

Raw staging tables (users, restaurants, orders, locations) are cleaned,
deduplicated and keyed into one order fact and four dimensions, then the
named analyses run as lazy DataFrames over the written warehouse.

Layout:
  functions/  Column -> Column helpers (lenient casts, rounding, buckets, keys)
  operators/  reusable DataFrame operators (first-row dedup, dense keys,
              substring location match, cuisine splitting, top-k)
  sources/    staging schemas, CSV readers, the test-table adapter,
              warehouse Parquet layout
  plans/      ETL and every named query, grouped by research question
  streaming/  incremental fact load driven by Structured Streaming
"""

__all__ = ["session"]

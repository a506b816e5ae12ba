"""strata: a layered retail load engine on Spark.

specs       table specifications shared by all layers
sources     CSV scans and versioned layer tables
functions   per-row column expressions (casts, dates, text)
operators   keyed row operators (keep-last, upsert, grouping, sort) and measured joins
sinks       layer versions, published tables, run log
plans       layer jobs, the full run, the registered queries and their oracles
streaming   incremental loads with Structured Streaming
"""

"""lapse: account-attrition analytics expressed as Spark DataFrame / SQL / ML jobs.

Layout
  sources/    table readers (explicit schemas), delimited and JSON scans, sinks
  functions/  column expressions (dates, numeric coercion, tiers, encoders)
  operators/  reusable relational operators (membership joins, flags,
              profiles, exact distributed quantile, ranked splits, curves)
  plans/      composite plans: labels, features, dataset, metrics, catalog
  models/     Spark ML fits, calibration, importances, runs table
  streaming/  Structured Streaming scoring
"""

__version__ = "0.1.0"

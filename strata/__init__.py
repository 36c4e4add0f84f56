"""strata: retail and ride-share medallion jobs on the PySpark DataFrame API.

Layers: ``sources`` (driver tables, raw CSV, versioned table store),
``functions`` (shared column rules), ``operators`` (dedupe, ranking, merges),
``plans`` (the bronze/silver/gold/dataset/audit jobs) and ``streaming``.
Every job is a function from DataFrames to a DataFrame; Catalyst plans it.
"""

__all__ = ["session"]

"""Transaction-risk analytics written as Spark DataFrame jobs.

Every public operator is a function from DataFrames to a DataFrame, so Catalyst sees one plan from the scan to the
result. Sub-packages: ``sources`` (contracts, CSV, dated Parquet tables, sinks), ``functions`` (column expressions),
``operators`` (marts, checks, profiles, features, models, thresholds) and ``plans`` (the end-to-end jobs).
"""

from riskloom.params import Params

__all__ = ["Params"]

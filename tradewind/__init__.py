"""Marketplace analytics on Spark DataFrames.

Raw delimited or Parquet tables go through profiling, cleaning, a star schema
and analytic plans; every public function takes DataFrames and returns a lazy
DataFrame built from native Spark expressions.
"""

__version__ = "0.1.0"

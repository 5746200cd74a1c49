"""saleslake: a Spark-native engine for loading, cleaning and serving sales data.

Sub-packages
------------
functions   column expressions and name rules (no row-level Python)
sources     all-string CSV, gzip CSV, Parquet, file listings, seeds
operators   cleaning, profiling, projection, loads, RLS, quality
plans       composite pipelines and the driver-table stand-ins
streaming   incremental file pick-up with Structured Streaming
"""

__version__ = "0.1.0"

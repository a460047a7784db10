"""strataflow: stratified trip analytics and modelling on Spark DataFrames.

Every operator takes and returns a ``pyspark.sql.DataFrame`` (or a small
Python value derived from a bounded summary table) so Catalyst plans the
work and executors do it; only per-stratum / per-bin / per-class / per-k
tables ever reach the driver.
"""

__version__ = "0.1.0"

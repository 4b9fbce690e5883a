"""hourcast: Spark-native analytics for hourly, keyed time series.

Hourly weather and energy-load series are ingested from landed JSON/CSV, upserted
into raw and staging tables, rolled up into conformed dimensions and daily marts,
analysed with window/join/top-k queries and checked by data-quality reports and
fail-fast gates.  Every operator is a DataFrame function that runs on the cluster.
"""

__version__ = "0.1.0"

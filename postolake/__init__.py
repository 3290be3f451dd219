"""postolake: a Spark-native lakehouse for retail fuel-price surveys.

Layers: bronze (raw delimited files) -> quality suite -> silver (clean,
deduplicated, partitioned by year) -> gold (star schema) -> analytics.
"""

__version__ = "0.1.0"

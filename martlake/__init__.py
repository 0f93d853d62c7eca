"""martlake — Spark-native retail demand, web-analytics ingestion and
price-classification operators.

Every operator is a plain function ``DataFrame -> DataFrame`` (usable with
``df.transform``) built from Spark SQL expressions, windows, joins and
aggregates; no Python UDF sits on a hot path.
"""

__version__ = "0.1.0"

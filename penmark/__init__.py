"""penmark: a Spark-native corpus analytics and authorship-attribution engine.

Every operator takes and returns DataFrames; text work runs as native column
expressions, aggregations shuffle on their keys with partial aggregation, and
models are Spark ML estimators or DataFrame aggregates.
"""

from penmark.session import get_spark, shared_path

__all__ = ["get_spark", "shared_path"]

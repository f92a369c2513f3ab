"""Report documents as JSON files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)

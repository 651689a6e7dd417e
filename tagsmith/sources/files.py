"""Delimited text with an explicit schema (no inference pass)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",",
             header: bool = False, encoding: str = "UTF-8") -> DataFrame:
    return (spark.read.schema(schema)
            .option("sep", sep).option("header", str(header).lower())
            .option("encoding", encoding).option("mode", "PERMISSIVE")
            .csv(path))

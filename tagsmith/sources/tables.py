"""Parquet tables of a data folder (one ``<name>.parquet`` per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, base_dir: str, name: str,
               columns: list[str] | tuple[str, ...] | None = None) -> DataFrame:
    """Read one table; selecting ``columns`` right away lets the Parquet scan
    prune everything else (``ReadSchema`` in the plan)."""
    df = spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df

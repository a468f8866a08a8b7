"""Readers for the driver's parquet tables (SRC3-SRC9, SRC15).

Reads are plain ``spark.read.parquet``: Catalyst prunes columns and pushes
filters into the scan, so no reader selects columns up front.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in DRIVER_TABLES:
        raise KeyError(f"unknown driver table {name!r}")
    return spark.read.parquet(table_path(sf_dir, name))


def read_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    return {n: read_table(spark, sf_dir, n) for n in names}

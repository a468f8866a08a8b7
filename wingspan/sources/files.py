"""File sources (SRC10, SRC11, SRC12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.operators.text import collapse_ws, html_to_text


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """SRC10: binary files with their file metadata columns."""
    df = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    return df.select(F.col("_metadata.file_path").alias("file_path"),
                     F.col("_metadata.file_name").alias("file_name"), "content", "length")


def parse_html_files(files: DataFrame) -> DataFrame:
    """TX1 over binary files: decode, extract text, parse flag and time."""
    html = F.decode(F.col("content"), "UTF-8")
    text = html_to_text(html)
    return files.select("file_path", "file_name",
                        collapse_ws(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)).alias("title"),
                        text.alias("full_text"), (F.length(text) > 0).alias("parse_ok"),
                        F.current_timestamp().alias("parsed_at"))


def inline_rows(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """SRC11 / SRC12: small inline relations with an explicit schema."""
    return spark.createDataFrame(rows, schema)

"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wingspan.session import materialize

WORD_SEPARATORS = "[\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables (a file or a folder of part files)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back (cuts the lineage)."""
    return materialize(df, name)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or a longer one that no column of ``df`` has (in either case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def utf8(text: str | Column) -> Column:
    """A text column as its UTF-8 bytes; null becomes empty."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")).cast("binary")


def n_words(text: str | Column) -> Column:
    """Number of words (runs without ASCII white space) of a whole text; 0 for null."""
    c = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    return F.regexp_count(c, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long")


def hashed_unit(*cols: str | Column) -> Column:
    """Uniform number in [0, 1) that depends on the given columns only."""
    return F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double") / F.lit(float(1 << 53))

"""Small Column builders shared by operators (SF1-SF25, FLT5, D13, D18)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col_or(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """num / den that yields NULL on a zero denominator (ANSI-safe, D18)."""
    return F.try_divide(col_or(num).cast("double"), col_or(den).cast("double"))


def clip(c: str | Column, lo: float, hi: float) -> Column:
    """SF6: clamp into [lo, hi]."""
    return F.least(F.greatest(col_or(c), F.lit(lo)), F.lit(hi))


def flag_count(cond: Column) -> Column:
    """sum(CASE WHEN cond THEN 1 ELSE 0 END) as bigint; NULL counts as 0."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def seconds_between(start: str | Column, end: str | Column) -> Column:
    """SF8: whole seconds from start to end (timestamp or timestamp_ntz)."""
    return F.timestamp_diff("SECOND", col_or(start), col_or(end))


def high_or_critical(c: str | Column) -> Column:
    return col_or(c).isin("HIGH", "CRITICAL")


def service_event(anomaly_flag: str = "anomaly_flag", severity: str = "anomaly_severity",
                  warranty: str = "warranty_claim_risk") -> Column:
    """FLT5: (flag AND severity IN (HIGH, CRITICAL)) OR warranty, three-valued."""
    return (col_or(anomaly_flag) & high_or_critical(severity)) | col_or(warranty)


def qcut_decile(rank: str | Column, n: str | Column, buckets: int = 10) -> Column:
    """D13: decile of a 1-based rank among n, equal to qcut(rank(first), 10) + 1.

    Bucket = greatest(1, ceil((rank - 1) * buckets / (n - 1))); a single row is decile 1.
    """
    r, cnt = col_or(rank), col_or(n)
    raw = F.ceil((r - 1) * F.lit(buckets) / (cnt - 1))
    return F.when(cnt <= 1, F.lit(1)).otherwise(F.greatest(F.lit(1), raw)).cast("int")


def measured(df: DataFrame, keys: list[str], table: dict[str, str]) -> DataFrame:
    """One row per key with the aggregates of a measure table (name -> SQL aggregate)."""
    return df.groupBy(*keys).agg(*[F.expr(e).alias(n) for n, e in table.items()])


def attach(df: DataFrame, dimension: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of the named columns (key included) of a dimension."""
    return df.join(dimension.select(*columns), key, "left")

"""Table writes and upkeep (SNK4-SNK10, SNK13-SNK16, SRC13).

Parquet only (no table-format jars offline): an overwrite replaces the
folder (schema replaced with it, SNK6); clustering is a range
repartition plus a sort inside each file, on the column itself or, for
several columns, on a space-filling-curve key, so min/max statistics of the
row groups skip files for a filter on any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, StringType, TimestampNTZType, TimestampType

from wingspan.operators.expectations import duplicate_keys
from wingspan.operators.security import export_guard
from wingspan.session import materialize


CURVE_BITS = 6


def _place(df: DataFrame, name: str) -> Column:
    """A column's values as doubles in the order of the column; a text counts by its first six bytes."""
    c, kind = F.col(f"`{name}`"), df.schema[name].dataType
    if isinstance(kind, (StringType, BinaryType)):
        digits = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0")
        return F.conv(digits, 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")).cast("double")
    return c.cast("double")


def _cut_places(df: DataFrame, cols: list[str], bits: int) -> list:
    """The ``2^bits - 1`` quantiles of each column's places (one aggregate, bounded result)."""
    if len(cols) * bits > 62:
        raise ValueError(f"{len(cols)} columns of {bits} bits exceed a 64-bit key")
    cuts = [i / (1 << bits) for i in range(1, 1 << bits)]
    return list(df.agg(*[F.percentile_approx(_place(df, c), cuts, 10_000).alias(f"q{i}")
                         for i, c in enumerate(cols)]).first())


def _bucket(place: Column, bounds: list | None) -> Column:
    """The number of bounds at or below the value."""
    return sum((F.when(place >= x, 1).otherwise(0) for x in bounds or []), F.lit(0))


def _interleaved(buckets: list[Column], bits: int) -> Column:
    key = F.lit(0).cast("bigint")
    for bit in range(bits):
        for i, b in enumerate(buckets):
            one = F.shiftright(b, bit).bitwiseAND(F.lit(1)).cast("bigint")
            key = key + F.shiftleft(one, bit * len(buckets) + i)
    return key


def curve_key(df: DataFrame, cols: list[str], bits: int = CURVE_BITS) -> Column:
    """SNK4: the Z-order key of several columns.

    A column is cut at its ``2^bits - 1`` quantiles, so skewed values and
    differing scales weigh alike; a row's bucket numbers are interleaved bit by
    bit.  Nulls are in bucket 0.
    """
    found = _cut_places(df, cols, bits)
    buckets = F.array(*[_bucket(_place(df, c), q) for c, q in zip(cols, found)])
    return F.element_at(F.transform(F.array(buckets), lambda b: _interleaved([b[i] for i in range(len(cols))], bits)), 1)


def _with_curve_key(df: DataFrame, cols: list[str], name: str, bits: int = CURVE_BITS) -> DataFrame:
    """The rows with :func:`curve_key` as ``name``: a projection a step, so that no step is worked out for every use."""
    found = _cut_places(df, cols, bits)
    places, buckets = ([f"{name}_{part}{i}" for i in range(len(cols))] for part in "pb")
    out = df.withColumns({p: _place(df, c) for p, c in zip(places, cols)})
    out = out.withColumns({b: _bucket(F.col(p), q) for b, p, q in zip(buckets, places, found)})
    return out.withColumn(name, _interleaved([F.col(b) for b in buckets], bits)).drop(*places, *buckets)


def cluster(df: DataFrame, cluster_by: list[str], files: int | None = None) -> DataFrame:
    """SNK4: range-partition on the cluster column, or the Z-order key of several, and sort within each file.

    Columns follow in the sort and the ranges, so rows of one key spread over files.
    Rows and keys are worked out once and written: the ranges are found on that copy.
    """
    n = files or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    if len(cluster_by) == 1:
        return materialize(df, "unclustered").repartitionByRange(n, *cluster_by).sortWithinPartitions(*cluster_by)
    name = "_curve"
    while any(c.lower().startswith(name) for c in df.columns):
        name += "_"
    keyed = materialize(_with_curve_key(df, cluster_by, name), "unclustered")
    return (keyed.repartitionByRange(n, name, *cluster_by).sortWithinPartitions(name, *cluster_by).drop(name))


def write_verified(df: DataFrame, path: str, mode: str = "overwrite",
                   partition_by: list[str] | None = None,
                   cluster_by: list[str] | None = None) -> int:
    """SNK5-SNK8 + SNK10: write, then check the rows on disk equal the rows written.

    The written count comes from an ``Observation`` on the write itself (no
    second pass over the source); the check reads the parquet footers back.
    """
    spark = df.sparkSession
    before = spark.read.parquet(path).count() if mode == "append" and _exists(spark, path) else 0
    if cluster_by:
        df = cluster(df, cluster_by)
    obs = Observation("written")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    written = obs.get["rows"]
    on_disk = spark.read.parquet(path).count()
    expect = written + (before if mode == "append" else 0)
    if on_disk != expect:
        raise RuntimeError(f"{path}: {on_disk} rows on disk, expected {expect}")
    return written


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def backup_if_absent(df: DataFrame, path: str) -> bool:
    """SNK9: idempotent backup (CREATE TABLE IF NOT EXISTS AS SELECT)."""
    if _exists(df.sparkSession, path):
        return False
    df.write.mode("ignore").parquet(path)
    return True


def export_snapshot(df: DataFrame, path: str, name: str, keys: list[str],
                    secured: set[str] = frozenset()) -> int:
    """SNK13 + SNK14: serving copy with a primary-key uniqueness check; refuses secured tables."""
    export_guard(name, set(secured))
    dups = duplicate_keys(df, keys).limit(1).count()
    if dups:
        raise ValueError(f"{name}: primary key {keys} is not unique")
    return write_verified(df, path)


def reconcile(sources: dict[str, DataFrame], copies: dict[str, DataFrame]) -> DataFrame:
    """SNK15: source rows vs copy rows per table, one row per table."""
    out = None
    for name, src in sources.items():
        row = src.agg(F.count(F.lit(1)).cast("bigint").alias("source_rows")).select(
            F.lit(name).alias("table_name"), "source_rows",
            copies[name].select(F.count(F.lit(1)).cast("bigint")).scalar().alias("copy_rows"))
        out = row if out is None else out.unionByName(row)
    return out.withColumn("counts_equal", F.col("source_rows") == F.col("copy_rows"))


def annotate(spark: SparkSession, table: str, comment: str | None = None,
             properties: dict[str, str] | None = None,
             column_comments: dict[str, str] | None = None) -> None:
    """SNK16: table comment, properties (tags stored as properties) and column comments."""
    if comment is not None:
        spark.sql(f"COMMENT ON TABLE {table} IS '{comment.replace(chr(39), chr(39) * 2)}'")
    if properties:
        props = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({props})")
    for col, text in (column_comments or {}).items():
        spark.sql(f"ALTER TABLE {table} ALTER COLUMN {col} COMMENT '{text.replace(chr(39), chr(39) * 2)}'")


def metadata_columns(spark: SparkSession, database: str | None = None) -> DataFrame:
    """SRC13: catalog metadata (tables and columns) as a small DataFrame."""
    rows = []
    for t in spark.catalog.listTables(database):
        for c in spark.catalog.listColumns(t.name, database):
            rows.append((t.name, c.name, c.dataType, c.description))
    return spark.createDataFrame(rows, "table_name string, column_name string, data_type string, "
                                       "comment string")

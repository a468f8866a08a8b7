"""Row numbers and running sums over a *global* order, without one task.

``Window.orderBy(...)`` with no partition moves every row into a single
task.  Here the rows are range-partitioned on the order key, numbered (or
summed) inside each range, and shifted by the totals of all earlier
ranges.  Only the per-range totals (one row per shuffle partition, a
size bounded by configuration) are broadcast back.

The range id (``spark_partition_id``) is only stable within one
execution of the range exchange, so the ranged rows are written once to
the shared checkpoint folder and both the numbering and the range totals
read that copy; numbered results are written too, so several consumers
(e.g. the two sides of a lag self-join) see the same numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wingspan.session import materialize


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where a null key matches a null key; the keys of ``left`` stay."""
    r = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(f"_r_{k}"))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def _parts(df: DataFrame, parts: int | None) -> int:
    if parts:
        return parts
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))


def _ranged(df: DataFrame, order: list[Column], parts: int | None) -> DataFrame:
    ranged = df.repartitionByRange(_parts(df, parts), *order).withColumn("_pid", F.spark_partition_id())
    return materialize(ranged, "ranged")


def _offsets(ranged: DataFrame, sums: dict[str, Column]) -> DataFrame:
    """Exclusive prefix totals per range id (P rows, P = partition count)."""
    tot = ranged.groupBy("_pid").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    return tot.select("_pid", *[F.coalesce(F.sum(f"_t_{n}").over(w), F.lit(0)).alias(f"_o_{n}")
                                for n in sums])


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_num",
                      parts: int | None = None, reuse: bool = False) -> DataFrame:
    """``row_number() OVER (ORDER BY order)`` computed range by range.

    ``order`` must be a total order (add an id as the last key) for the
    numbering to be deterministic.  ``reuse=True`` writes the numbered rows
    once, for callers that read the numbers in several places.
    """
    r = _ranged(df, order, parts)
    local = r.withColumn("_lrn", F.row_number().over(Window.partitionBy("_pid").orderBy(*order)))
    offs = _offsets(r, {"n": F.lit(1)})
    out = (local.join(F.broadcast(offs), "_pid")
           .withColumn(name, (F.col("_o_n") + F.col("_lrn")).cast("bigint"))
           .drop("_pid", "_lrn", "_o_n"))
    return materialize(out, "numbered") if reuse else out


def global_cumsum(df: DataFrame, order: list[Column], cols: dict[str, str | Column],
                  inclusive: bool = True, parts: int | None = None) -> DataFrame:
    """Running sums of ``cols`` over a global order; output columns ``cum_<name>``.

    Rows with equal order keys are summed in an arbitrary but consistent
    sequence, so callers pass distinct keys (e.g. one row per score).
    """
    cexpr = {n: (F.col(c) if isinstance(c, str) else c) for n, c in cols.items()}
    r = _ranged(df, order, parts)
    frame = (Window.partitionBy("_pid").orderBy(*order)
             .rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1))
    local = r.withColumns({f"_l_{n}": F.coalesce(F.sum(c).over(frame), F.lit(0))
                           for n, c in cexpr.items()})
    offs = _offsets(r, cexpr)
    out = local.join(F.broadcast(offs), "_pid")
    out = out.withColumns({f"cum_{n}": F.col(f"_o_{n}") + F.col(f"_l_{n}") for n in cexpr})
    return materialize(out.drop("_pid", *[f"_l_{n}" for n in cexpr], *[f"_o_{n}" for n in cexpr]),
                       "cumsum")


def group_row_number(df: DataFrame, group: list[str], order: list[Column], name: str = "row_num",
                     parts: int | None = None) -> DataFrame:
    """``row_number() OVER (PARTITION BY group ORDER BY order)`` without a per-group task.

    Rows are numbered globally by (group, order) and rebased on the first
    number of their group; a group holding a third of the data is spread
    over many ranges instead of one window partition.
    """
    g = [F.col(c) for c in group]
    n = global_row_number(df, g + order, "_grn", parts, reuse=True)
    first = n.groupBy(*group).agg(F.min("_grn").alias("_gfirst"))
    return (join_null_safe(n, first, group).withColumn(name, F.col("_grn") - F.col("_gfirst") + 1)
            .drop("_grn", "_gfirst"))


def group_lag(df: DataFrame, group: list[str], order: list[Column], cols: list[str],
              prefix: str = "prev_", parts: int | None = None) -> DataFrame:
    """``lag(col) OVER (PARTITION BY group ORDER BY order)`` for each of ``cols``.

    Every row gets a unique global number; the previous row is found by an
    equi-join on ``number - 1`` (unique keys, so the join is balanced) and
    kept only when it belongs to the same group.
    """
    g = [F.col(c) for c in group]
    n = global_row_number(df, g + order, "_grn", parts, reuse=True)
    prev = n.select((F.col("_grn") + 1).alias("_grn"),
                    *[F.col(c).alias(f"_pg_{c}") for c in group],
                    *[F.col(c).alias(f"_pv_{c}") for c in cols])
    j = n.join(prev, "_grn", "left")
    same = None
    for c in group:
        cond = F.col(c).eqNullSafe(F.col(f"_pg_{c}"))
        same = cond if same is None else same & cond
    out = j.withColumns({f"{prefix}{c}": F.when(same, F.col(f"_pv_{c}")) for c in cols})
    return out.drop("_grn", *[f"_pg_{c}" for c in group], *[f"_pv_{c}" for c in cols])

"""Data-quality expectations (DQ1-DQ8, DQ12).

An expectation is a named SQL predicate with an action:

* ``warn``  keep every row, count violations;
* ``drop``  keep only rows that satisfy the rule;
* ``fail``  stop the job on the first violating row (``assert_true`` in the plan).

A NULL predicate counts as a violation (the same as ``filter``).  Counts are
gathered with ``DataFrame.observe`` so they cost no second scan; for a
report, :func:`violation_counts` computes them in one aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Expectation:
    name: str
    sql: str
    action: str = "warn"  # warn | drop | fail

    def holds(self) -> Column:
        return F.coalesce(F.expr(self.sql), F.lit(False))


def rules(mapping: dict[str, str], action: str) -> list[Expectation]:
    """``expect_all_or_drop({name: sql})`` style constructor."""
    return [Expectation(n, s, action) for n, s in mapping.items()]


def apply_expectations(df: DataFrame, exps: list[Expectation],
                       observation: Observation | str | None = None) -> DataFrame:
    """Attach violation metrics, then drop / fail as the rules say.

    ``observation`` is an Observation for a batch or a name for a stream
    (its counts are then in the query's progress).
    """
    if not exps:
        return df
    if observation is not None:
        metrics = [F.count_if(~e.holds()).alias(e.name) for e in exps]
        metrics.append(F.count(F.lit(1)).alias("_rows_in"))
        df = df.observe(observation, *metrics)
    drops = [e.holds() for e in exps if e.action == "drop"]
    if drops:
        cond = drops[0]
        for c in drops[1:]:
            cond = cond & c
        df = df.filter(cond)
    for e in exps:
        if e.action == "fail":
            msg = f"expectation {e.name} failed: {e.sql}"
            df = df.filter(F.assert_true(e.holds(), F.lit(msg)).isNull())
    return df


def violation_counts(df: DataFrame, exps: list[Expectation]) -> DataFrame:
    """One row per rule: (rule, action, violations, total_rows), one scan."""
    aggs = [F.count_if(~e.holds()).cast("bigint").alias(f"v{i}") for i, e in enumerate(exps)]
    wide = df.agg(F.count(F.lit(1)).cast("bigint").alias("total_rows"), *aggs)
    stack = ", ".join(f"'{e.name}', '{e.action}', v{i}" for i, e in enumerate(exps))
    return wide.selectExpr(
        f"stack({len(exps)}, {stack}) AS (rule, action, violations)", "total_rows")


def quarantine(df: DataFrame, exps: list[Expectation], keep: list[str]) -> DataFrame:
    """Rows that break at least one rule, with the failed rule names (comma list)."""
    failed = F.concat_ws(",", *[F.when(~e.holds(), F.lit(e.name)) for e in exps])
    bad = exps[0].holds()
    for e in exps[1:]:
        bad = bad & e.holds()
    return df.filter(~bad).select(*keep, failed.alias("failed_rules"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """DQ8 real uniqueness: keys that occur more than once, with their counts."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).cast("bigint").alias("n_rows"))
            .filter(F.col("n_rows") > 1))


def assert_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """DQ8: the rows of ``df``; reading a key that occurs twice stops the job with the rule's name."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    checked = df.withColumn("_n", n).filter(F.assert_true(
        F.col("_n") == 1, F.lit(f"expectation {name} failed: duplicate {', '.join(keys)}")).isNull())
    return checked.drop("_n")


def unmatched_after_left_join(joined: DataFrame, right_key: str) -> Column:
    """DQ13: rows whose right side found no match (right key NULL after a left join)."""
    return F.col(right_key).isNull()


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """DQ12 / UN5: rows only in one side, multiset semantics, with the side named."""
    cols = left.columns
    right = right.select(*cols)
    only_l = left.exceptAll(right).withColumn("side", F.lit("left_only"))
    only_r = right.exceptAll(left).withColumn("side", F.lit("right_only"))
    return only_l.unionByName(only_r)


def same_schema(left: DataFrame, right: DataFrame) -> bool:
    return [(f.name, f.dataType) for f in left.schema] == [(f.name, f.dataType) for f in right.schema]


def assert_complete_mapping(values: DataFrame, mapping: DataFrame, key: str) -> None:
    """DQ10 / JN19: every value has a mapping (left anti join must be empty)."""
    missing = values.select(key).distinct().join(mapping.select(key), key, "left_anti")
    sample = [r[key] for r in missing.limit(20).collect()]
    if sample:
        raise ValueError(f"no mapping for {key} values: {sample}")


def require_columns(df: DataFrame, cols: list[str]) -> None:
    """DQ11: fail when required columns are missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")

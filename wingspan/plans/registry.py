"""Query registry.

Each plan module decorates ``fn(spark, sf_dir) -> DataFrame`` with
:func:`query`, optionally giving the DuckDB oracle SQL.  Outputs round
doubles to 6 places (both sides) so the order of floating-point sums
does not decide a hash comparison.
"""

from __future__ import annotations

import importlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}
_GROUPS: dict[str, str] = {}

PLAN_MODULES = (
    "wingspan.plans.telemetry_plans",
    "wingspan.plans.installed_base_plans",
    "wingspan.plans.quality_plans",
    "wingspan.plans.report_plans",
    "wingspan.plans.feature_plans",
    "wingspan.plans.metric_plans",
    "wingspan.plans.text_plans",
    "wingspan.plans.security_plans",
    "wingspan.plans.replay_plans",
    "wingspan.plans.stream_plans",
    "wingspan.plans.model_plans",
    "wingspan.plans.upkeep_plans",
    "wingspan.plans.completion_plans",
)


SCALE = 1e6


def round6(c):
    """Half-up rounding to 6 places as floor(x * 1e6 + 0.5) / 1e6.

    Written with IEEE multiply / add / divide only, so Spark and DuckDB
    give identical bits (their built-in ``round`` disagree on exact binary
    ties such as 2.4859375).  NaN and infinities pass through unchanged.
    """
    x = c.cast("double")
    y = x * SCALE + 0.5
    # the built-in floor is a bigint; from 9e12 on every y is a whole number (or no number) already
    return F.when(F.abs(x) < 9e12, F.floor(y).cast("double")).otherwise(y) / SCALE


def rewrite_round6(sql: str) -> str:
    """Rewrite every ``round(<expr>, 6)`` of an oracle into the same formula."""
    out, i = [], 0
    pat = re.compile(r"\bround\(", re.IGNORECASE)
    while True:
        m = pat.search(sql, i)
        if not m:
            out.append(sql[i:])
            return "".join(out)
        start = m.end()
        depth, j, last_comma = 1, start, None
        while depth:
            ch = sql[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                last_comma = j
            j += 1
        inner = sql[start:j - 1]
        if last_comma is not None and sql[last_comma + 1:j - 1].strip() == "6":
            expr = rewrite_round6(sql[start:last_comma])
            out.append(sql[i:m.start()] + f"(floor(({expr}) * 1e6 + 0.5) / 1e6)")
        else:
            out.append(sql[i:m.start()] + "round(" + rewrite_round6(inner) + ")")
        i = j


def rounded(df: DataFrame) -> DataFrame:
    """Round every floating column to 6 places (see :func:`round6`)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (DoubleType, FloatType)):
            cols.append(round6(F.col(f"`{f.name}`")).alias(f.name, metadata=f.metadata))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def query(name: str, oracle: str | None = None, group: str = "misc", round_output: bool = True):
    def deco(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return rounded(out) if round_output else out
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        run.raw = fn
        if name in _QUERIES:
            raise ValueError(f"duplicate query {name}")
        _QUERIES[name] = run
        if oracle is not None:
            _ORACLES[name] = rewrite_round6(oracle.strip())
        _GROUPS[name] = group
        return run
    return deco


_LOADING = False


def _load() -> None:
    """Import the plan modules in order; a module may use the entries of those before it."""
    global _LOADING
    if _LOADING:
        return
    _LOADING = True
    try:
        for m in PLAN_MODULES:
            importlib.import_module(m)
    finally:
        _LOADING = False


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def all_oracles() -> dict[str, str]:
    _load()
    return dict(_ORACLES)


def groups() -> dict[str, str]:
    _load()
    return dict(_GROUPS)

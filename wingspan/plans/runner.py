"""Dependency-ordered dataset runner with lineage edges (ST4, ST5, SRC14, SE5).

A dataset is a name, a function of its input DataFrames and the names of
those inputs.  ``run`` resolves the order from the declared inputs,
materialises each dataset as parquet under one root folder (full
refresh) and appends one lineage edge per (input, dataset) to a lineage
table.  Spark plans each dataset; the runner only orders them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from wingspan.operators.upkeep import write_verified


@dataclass
class Dataset:
    name: str
    fn: Callable[..., DataFrame]
    inputs: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()


@dataclass
class PipelineRun:
    root: str
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def add(self, name: str, inputs: tuple[str, ...] = (), cluster_by=(), partition_by=()):
        def deco(fn):
            self.datasets[name] = Dataset(name, fn, tuple(inputs), tuple(cluster_by), tuple(partition_by))
            return fn
        return deco

    def order(self) -> list[str]:
        seen, out = set(), []

        def visit(n, stack=()):
            if n in stack:
                raise ValueError(f"cycle through {n}")
            if n in seen or n not in self.datasets:
                return
            for i in self.datasets[n].inputs:
                visit(i, stack + (n,))
            seen.add(n)
            out.append(n)
        for n in self.datasets:
            visit(n)
        return out

    def run(self, spark: SparkSession, sources: dict[str, DataFrame]) -> dict[str, int]:
        counts, edges = {}, []
        tables = dict(sources)
        for n in self.order():
            ds = self.datasets[n]
            df = ds.fn(*[tables[i] for i in ds.inputs])
            path = f"{self.root.rstrip('/')}/{n}"
            counts[n] = write_verified(df, path, cluster_by=list(ds.cluster_by) or None,
                                       partition_by=list(ds.partition_by) or None)
            tables[n] = spark.read.parquet(path)
            now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
            edges += [(i, n, "TABLE", now) for i in ds.inputs]
        lineage = spark.createDataFrame(edges, "source_table string, target_table string, "
                                               "entity_type string, event_time timestamp")
        lineage.write.mode("append").parquet(f"{self.root.rstrip('/')}/_lineage")
        return counts

    def lineage(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root.rstrip('/')}/_lineage")

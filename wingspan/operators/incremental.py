"""Gold tables refreshed from a change feed (SNK3, ST4, ST5).

The stored state is one row of mergeable aggregates per group, in ``buckets``
by a hash of the group; a manifest names the files of every bucket
(:class:`~wingspan.operators.manifests.ManifestLog`)::

    parts/<name>/_bucket=<b>/   groups of a bucket with their partial aggregates
    work/<name>/                changes and merged groups of a refresh
    manifests/<version>.json    the part of each bucket, the epoch of each feed

A refresh turns the feed's rows before and after into signed partial
aggregates, merges them into the groups they touch and rewrites only the
buckets of those groups:

* counts and sums are added and taken away; sums are decimals of ``PLACES``
  places, so nothing drifts and a refresh equals a full computation;
* a minimum (maximum) stands unless a row that held it left and no row as low
  (high) came; only such groups are computed again (also where another row
  holds it as well), from ``base``, with the range of their first key pushed
  into its scan.

:meth:`GoldTable.full` is the same table computed from all rows.  An epoch that
a feed has applied before changes nothing.  Null group keys are a group; nulls
and numbers that are not finite take no part in sums and averages, nulls not in
the other measures.  A group without rows is gone.  A feed that takes away more
rows than a group has is an error.  An empty feed writes nothing but its epoch.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wingspan.operators.manifests import ManifestLog

PLACES = 6
_DECIMAL = f"decimal(28,{PLACES})"
_EMPTY = {"buckets": {}, "epochs": {}}


class Measure(NamedTuple):
    """``kind`` (count, sum, avg, min or max) of the SQL expression ``value``; a count counts non-null values."""

    name: str
    kind: str
    value: str


def _nothing(step: str) -> None:
    """Called after every step of a refresh; tests stop a refresh here."""


class GoldTable(ManifestLog):
    def __init__(self, spark: SparkSession, path: str, by: list[str], measures: list[Measure], buckets: int = 64):
        super().__init__(spark, path, _EMPTY)
        unknown = {m.kind for m in measures} - {"count", "sum", "avg", "min", "max"}
        if unknown:
            raise ValueError(f"unknown kinds of measures: {sorted(unknown)}")
        self.by, self.measures, self.buckets = by, measures, buckets

    # -- aggregates --------------------------------------------------------
    def _value(self, m: Measure) -> Column:
        v = F.expr(m.value)
        if m.kind in ("sum", "avg"):
            return F.when(F.abs(v.cast("double")) < float("inf"), v).cast(_DECIMAL)
        return v

    def _partial(self, rows: DataFrame) -> DataFrame:
        """Signed partial aggregates per group of rows with a ``_sign`` of 1 or -1."""
        plus = F.col("_sign") > 0
        aggs = [F.sum("_sign").alias("_n")]
        for i, m in enumerate(self.measures):
            v = F.col(f"_v{i}")
            aggs.append(F.coalesce(F.sum(F.when(v.isNotNull(), F.col("_sign"))), F.lit(0)).alias(f"_c{i}"))
            if m.kind in ("sum", "avg"):
                aggs.append(F.coalesce(F.sum(F.when(plus, v).otherwise(-v)), F.lit(0)).cast(f"decimal(38,{PLACES})")
                            .alias(f"_s{i}"))
            elif m.kind != "count":
                pick = F.min if m.kind == "min" else F.max
                aggs += [pick(F.when(plus, v)).alias(f"_in{i}"), pick(F.when(~plus, v)).alias(f"_out{i}")]
        valued = rows.select(*self.by, "_sign", *[self._value(m).alias(f"_v{i}") for i, m in enumerate(self.measures)])
        return valued.groupBy(*self.by).agg(*aggs).withColumn(
            "_bucket", F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int"))

    def _state(self, partial: DataFrame) -> DataFrame:
        """The stored form of the partial aggregates of rows that were only added."""
        cols = [*self.by, "_bucket", "_n"]
        for i, m in enumerate(self.measures):
            cols.append(f"_c{i}")
            if m.kind in ("sum", "avg"):
                cols.append(f"_s{i}")
            elif m.kind != "count":
                cols.append(F.col(f"_in{i}").alias(f"_e{i}"))
        return partial.select(*cols)

    def _shown(self, state: DataFrame) -> DataFrame:
        out = []
        for i, m in enumerate(self.measures):
            c, s = F.col(f"_c{i}"), F.col(f"_s{i}").cast("double") if m.kind in ("sum", "avg") else None
            one = {"count": lambda: c, "sum": lambda: F.when(c > 0, s), "avg": lambda: F.when(c > 0, s / c),
                   "min": lambda: F.col(f"_e{i}"), "max": lambda: F.col(f"_e{i}")}[m.kind]()
            out.append(one.alias(m.name))
        return state.select(*self.by, *out)

    def full(self, base: DataFrame) -> DataFrame:
        """The table computed from all rows of ``base``."""
        return self._shown(self._state(self._partial(base.withColumn("_sign", F.lit(1)))))

    # -- state -------------------------------------------------------------
    def _read(self, state: dict, buckets: list[int] | None = None) -> DataFrame | None:
        names = {}
        for b, name in state["buckets"].items():
            if buckets is None or int(b) in buckets:
                names.setdefault(name, []).append(b)
        out = None
        for name, bs in sorted(names.items()):
            root = f"{self.path}/parts/{name}"
            one = self.spark.read.option("basePath", root).parquet(*[f"{root}/_bucket={b}" for b in sorted(bs)])
            out = one if out is None else out.unionByName(one)
        return out

    def table(self, version: int | None = None) -> DataFrame | None:
        """The gold table of a version; None before the first row."""
        state = self._read(self.manifest(version))
        return None if state is None else self._shown(state)

    def _merged(self, held: DataFrame | None, delta: DataFrame) -> DataFrame:
        """Groups of ``delta`` after the change, and of the rest of their buckets; ``_stale`` marks lost extremes."""
        extremes = [i for i, m in enumerate(self.measures) if m.kind in ("min", "max")]
        both = delta if held is None else delta.unionByName(held, allowMissingColumns=True)
        if held is None:
            both = both.withColumns({f"_e{i}": F.lit(None).cast(delta.schema[f"_in{i}"].dataType) for i in extremes})
        aggs = [F.sum("_n").alias("_n")]
        for i, m in enumerate(self.measures):
            aggs.append(F.sum(f"_c{i}").alias(f"_c{i}"))
            if m.kind in ("sum", "avg"):
                aggs.append(F.sum(f"_s{i}").cast(f"decimal(38,{PLACES})").alias(f"_s{i}"))
            elif m.kind != "count":  # one row at most has each of them
                aggs += [F.max(f"_{x}{i}").alias(f"_{x}{i}") for x in ("e", "in", "out")]
        out = both.groupBy(*self.by, "_bucket").agg(*aggs)
        least = F.least(*[F.col(f"_c{i}") for i in range(len(self.measures))], F.col("_n"), F.col("_n"))
        out = out.filter(F.assert_true(least >= 0, "the feed takes away rows that the table does not have").isNull())
        stale = F.lit(False)
        for i in extremes:
            low = self.measures[i].kind == "min"
            e, new, old = F.col(f"_e{i}"), F.col(f"_in{i}"), F.col(f"_out{i}")
            lost = old.isNotNull() & (e.isNull() | ((old <= e) if low else (old >= e)))
            kept = F.coalesce((new <= e) if low else (new >= e), F.lit(False))
            stale = stale | (lost & ~kept & (F.col(f"_c{i}") > 0))
        out = out.withColumn("_stale", stale).filter("_n > 0")
        return out.select(*[c for c in out.columns if not c.startswith(("_e", "_in", "_out"))], *[
            F.when(F.col(f"_c{i}") > 0, (F.least if self.measures[i].kind == "min" else F.greatest)(
                f"_e{i}", f"_in{i}")).alias(f"_e{i}") for i in extremes])

    def _again(self, base: DataFrame, groups: DataFrame) -> tuple[DataFrame, Observation]:
        """The stored form of ``groups`` computed from the base, and the count of its rows that were taken."""
        key = F.col(self.by[0])
        span = groups.agg(F.min(key).alias("lo"), F.max(key).alias("hi"), F.count_if(key.isNull()).alias("nulls")).first()
        between = key.between(F.lit(span.lo), F.lit(span.hi)) if span.lo is not None else F.lit(False)
        rows = base.filter(between | key.isNull() if span.nulls else between)
        seen = Observation()
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"))
        g = groups.select(*[F.col(c).alias(f"_g{j}") for j, c in enumerate(self.by)])
        same = [rows[c].eqNullSafe(g[f"_g{j}"]) for j, c in enumerate(self.by)]
        return self._state(self._partial(rows.join(g, same, "left_semi").withColumn("_sign", F.lit(1)))), seen

    def refresh(self, feed: DataFrame, base: DataFrame | None = None, epoch: int | None = None, name: str = "feed",
                step: Callable[[str], None] = _nothing) -> dict:
        """Apply (before, after) rows, either of them null; returns what the refresh read and wrote.

        ``base`` is the table after the change; a table with a minimum or
        maximum needs it once an extreme row leaves.
        """
        state = self.manifest()
        done = {"groups": 0, "buckets": 0, "recomputed": 0, "base_rows": 0}
        if epoch is not None and epoch <= state["epochs"].get(name, -1):
            return done
        part = uuid.uuid4().hex
        work = f"{self.path}/work/{part}"
        sides = F.array(F.struct(F.col("after").alias("r"), F.lit(1).alias("_sign")),
                        F.struct(F.col("before").alias("r"), F.lit(-1).alias("_sign")))
        signed = feed.select(F.explode(sides).alias("x")).filter("x.r IS NOT NULL").select("x.r.*", "x._sign")
        self._partial(signed).write.parquet(f"{work}/delta")
        step("changes written")
        delta = self.spark.read.parquet(f"{work}/delta")
        touched = {r[0]: r[1] for r in delta.groupBy("_bucket").count().collect()}  # a row a bucket
        if touched:
            self._merged(self._read(state, list(touched)), delta).write.parquet(f"{work}/merged")
            step("merged groups written")
            merged = self.spark.read.parquet(f"{work}/merged")
            stale = merged.filter("_stale")
            n_stale = stale.count()
            out = merged.filter("NOT _stale").drop("_stale")
            seen = None
            if n_stale:
                if base is None:
                    raise ValueError("a minimum or maximum left its group: the base table is needed")
                again, seen = self._again(base, stale)
                out = out.unionByName(again)
            out.repartition("_bucket").write.partitionBy("_bucket").parquet(f"{self.path}/parts/{part}")
            step("buckets written")
            filled = {r[0] for r in merged.select("_bucket").distinct().collect()}
            for b in touched:
                state["buckets"].pop(str(b), None)
                if b in filled:
                    state["buckets"][str(b)] = part
            done = {"groups": sum(touched.values()), "buckets": len(touched), "recomputed": n_stale,
                    "base_rows": int(seen.get["rows"]) if seen else 0}
        if epoch is not None:
            state["epochs"][name] = epoch
        state["version"] += 1
        self._commit(state, step)
        return done

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove parts that the last ``keep`` versions do not name, and all work files (no refresh may be active)."""
        kept = self.versions()[-keep:]
        used = {name for v in kept for name in self.manifest(v)["buckets"].values()}
        gone = []
        for folder, held in (("parts", used), ("work", set()), ("manifests", {f"{v:012d}.json" for v in kept})):
            fs, p = self._fs(f"{self.path}/{folder}")
            for f in fs.listStatus(p) if fs.exists(p) else []:
                if f.getPath().getName() not in held:
                    gone.append(f"{folder}/{f.getPath().getName()}")
                    fs.delete(f.getPath(), True)
        return sorted(gone)

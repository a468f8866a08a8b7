"""Point-in-time features, encodings, folds and weights (ML1-ML7, WN9-WN11).

The history and the label window come from one pass over the service
records: each measure is an aggregate restricted by a FILTER-style
condition (``when(before_cut, x)``), so the records are shuffled once
instead of once per CTE.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.functions.columns import high_or_critical, ratio, service_event

HISTORY_FEATURES = ["n_services", "overdue_rate", "max_gap", "avg_gap", "n_anom", "n_anom_hc",
                    "n_warr", "compliance_rate", "cycles_last", "days_since_last", "delay_rate",
                    "n_shops"]
NUMERIC_FEATURES = ["unit_cost_usd", "maintenance_interval_days", "max_cycles", "install_age_days",
                    "ac_age", "ac_cycles"] + HISTORY_FEATURES + ["cycle_life_used",
                                                             "days_since_last_over_interval"]
CATEGORICAL_FEATURES = ["component_type", "criticality", "airline"]


def point_in_time_features(components: DataFrame, aircraft: DataFrame, records: DataFrame,
                           cutoff: str) -> DataFrame:
    """ML1 (AG12 + AG13 + JN10): features strictly before ``cutoff``, label on/after."""
    cut = F.to_date(F.lit(cutoff))
    before = F.col("maintenance_date") < cut
    after = F.col("maintenance_date") >= cut
    ev = service_event()

    def h(c):
        return F.when(before, c)

    agg = records.groupBy("component_id").agg(
        F.max(F.when(after, F.when(ev, 1).otherwise(0))).alias("_y"),
        F.count(F.when(after & ev, 1)).cast("bigint").alias("_nf"),
        F.count(h(F.lit(1))).cast("bigint").alias("n_services"),
        F.avg(h(F.col("is_overdue").cast("int"))).alias("overdue_rate"),
        F.max(h(F.col("days_since_last_service"))).alias("max_gap"),
        F.avg(h(F.col("days_since_last_service"))).alias("avg_gap"),
        F.sum(h(F.col("anomaly_flag").cast("int"))).cast("bigint").alias("n_anom"),
        F.sum(h(F.when(high_or_critical("anomaly_severity"), 1).otherwise(0))).cast("bigint")
        .alias("n_anom_hc"),
        F.sum(h(F.col("warranty_claim_risk").cast("int"))).cast("bigint").alias("n_warr"),
        F.avg(h(F.when(F.col("compliance_status") == "COMPLIANT", 1).otherwise(0)))
        .alias("compliance_rate"),
        F.max(h(F.col("cycles_at_service"))).alias("cycles_last"),
        F.max(h(F.col("maintenance_date"))).alias("_last"),
        F.avg(h(F.when(high_or_critical("flight_delay_risk"), 1).otherwise(0))).alias("delay_rate"),
        F.count_distinct(h(F.col("mro_shop"))).cast("bigint").alias("n_shops"),
    )
    # A component with records only in the label window has no history row
    # in the reference (its h CTE is empty): null the history measures.
    has_hist = F.col("n_services") > 0
    hist_cols = {c: F.when(has_hist, F.col(c)) for c in
                 ["n_services", "overdue_rate", "max_gap", "avg_gap", "n_anom", "n_anom_hc",
                  "n_warr", "compliance_rate", "cycles_last", "delay_rate", "n_shops"]}
    agg = agg.withColumns(hist_cols).withColumn(
        "days_since_last", F.datediff(cut, F.col("_last")).cast("bigint"))
    a = aircraft.select("tail_number", F.col("age_years").alias("ac_age"),
                        F.col("total_cycles").alias("ac_cycles"))
    base = components.join(a, "tail_number", "inner")
    out = base.join(agg, "component_id", "left").select(
        "component_id", "component_type", "criticality", "unit_cost_usd",
        "maintenance_interval_days", "max_cycles", "airline", "tail_number",
        F.datediff(cut, F.col("install_date")).cast("bigint").alias("install_age_days"),
        "ac_age", "ac_cycles", *HISTORY_FEATURES,
        F.coalesce(F.col("_y"), F.lit(0)).cast("int").alias("y"),
        F.coalesce(F.col("_nf"), F.lit(0)).cast("bigint").alias("n_future_events"),
    )
    return out.withColumns({
        "cycle_life_used": ratio("cycles_last", "max_cycles"),
        "days_since_last_over_interval": ratio("days_since_last", "maintenance_interval_days"),
    })


def rule_baseline_score(df: DataFrame) -> DataFrame:
    """ML20: prior HIGH/CRITICAL count + 0.001 x overdue rate (nulls count as 0)."""
    return df.withColumn("score", F.coalesce(F.col("n_anom_hc").cast("double"), F.lit(0.0))
                         + F.lit(0.001) * F.coalesce(F.col("overdue_rate"), F.lit(0.0)))


def one_hot_long(df: DataFrame, key: str, cats: list[str]) -> DataFrame:
    """ML2 in sparse (long) form: one row per (key, indicator) equal to 1.

    Equivalent to ``get_dummies(...).fillna(0)`` without listing categories
    on the driver: absent indicators are the zeros.  A null category gives
    no indicator (all zeros), as ``get_dummies`` does.
    """
    names = F.array(*[F.concat(F.lit(f"{c}="), F.col(c)) for c in cats])
    out = df.select(F.col(key), F.explode(names).alias("feature"))
    return out.filter(F.col("feature").isNotNull()).withColumn("value", F.lit(1.0))


def class_weights(df: DataFrame, label: str = "y") -> DataFrame:
    """WN11 / ML7: balanced weight n / (k x n_class) per class, as a small table."""
    from pyspark.sql import Window
    per = df.groupBy(label).agg(F.count(F.lit(1)).cast("bigint").alias("n_class"))
    # the per-class table has one row per class, so an unpartitioned window is tiny
    everything = Window.partitionBy()
    return (per.withColumn("n", F.sum("n_class").over(everything))
            .withColumn("k", F.count(F.lit(1)).over(everything))
            .withColumn("weight", F.col("n") / (F.col("k") * F.col("n_class")))
            .select(label, "n_class", "weight"))


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5) -> DataFrame:
    """ML6: fold = (row_number within class ordered by (md5(key), key) - 1) mod k.

    Classes are few and one may hold most rows, so no window is
    partitioned by class: see :func:`global_row_number`.
    """
    from wingspan.operators.ordering import global_row_number, join_null_safe
    h = F.md5(F.col(key).cast("string"))
    # number all rows by (class, hash, key) with the distributed numbering,
    # then rebase each class on its first number (one row per class)
    numbered = global_row_number(df.withColumn("_h", h), [F.col(label), F.col("_h"), F.col(key)],
                                 name="_grn", reuse=True)
    first = numbered.groupBy(label).agg(F.min("_grn").alias("_first"))
    return (join_null_safe(numbered, first, [label])
            .withColumn("fold", ((F.col("_grn") - F.col("_first")) % k).cast("int"))
            .select(key, label, "fold"))


def impute_scale_long(df: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """ML3 + ML4: mean imputation then standardisation with the *population* std (D20).

    Long output (key, feature, z); a zero std gives z = 0.
    """
    stats = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in cols])
    stat = stats.select(F.struct(*cols)).scalar()
    scaled = []
    for c in cols:
        m, s = stat.getField(c).getField("m"), stat.getField(c).getField("s")
        z = F.coalesce(F.try_divide(F.coalesce(F.col(c).cast("double"), m) - m, s), F.lit(0.0))
        scaled.append(F.struct(F.lit(c).alias("feature"), z.alias("z")))
    return df.select(key, F.explode(F.array(*scaled)).alias("v")).select(key, "v.feature", "v.z")

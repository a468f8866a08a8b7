"""Forecast table and back-test (ML20, ML23, ML24, SC13, SC14, SC16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wingspan.functions import scoring
from wingspan.functions.columns import service_event
from wingspan.operators.evaluation import risk_deciles

FORECAST_COLS = ["component_id", "tail_number", "airline", "component_type", "criticality",
                 "unit_cost_usd", "overdue_rate", "n_anom_hc", "cycle_life_used",
                 "actual_next_quarter_event", "n_future_events", "forecast_probability",
                 "risk_decile", "expected_warranty_exposure_usd", "recommended_action",
                 "forecast_cutoff_date"]


def forecast_table(scored: DataFrame, cutoff: str, prob: str = "forecast_probability") -> DataFrame:
    """ML23: deciles, expected exposure (half-even, SC14), action (SC13)."""
    d = risk_deciles(scored, "component_id", score=prob)
    return d.select(
        "component_id", "tail_number", "airline", "component_type", "criticality", "unit_cost_usd",
        "overdue_rate", "n_anom_hc", "cycle_life_used",
        F.col("y").alias("actual_next_quarter_event"), "n_future_events", prob, "risk_decile",
        F.bround(F.col(prob) * F.col("unit_cost_usd"), 0).alias("expected_warranty_exposure_usd"),
        scoring.recommended_action(F.col("risk_decile")).alias("recommended_action"),
        F.to_date(F.lit(cutoff)).alias("forecast_cutoff_date"),
    )


def rule_probability(pit: DataFrame) -> DataFrame:
    """Rule baseline as a probability-like score: s / (1 + s), s = ML20 score."""
    s = (F.coalesce(F.col("n_anom_hc").cast("double"), F.lit(0.0))
         + F.lit(0.001) * F.coalesce(F.col("overdue_rate"), F.lit(0.0)))
    return pit.withColumn("forecast_probability", s / (F.lit(1.0) + s))


def backtest(forecast: DataFrame, records: DataFrame, components: DataFrame, cutoff: str,
             success: float = scoring.INTERVENTION_SUCCESS,
             run_cost: float = scoring.ANNUAL_RUN_COST_USD) -> DataFrame:
    """ML24 + SC16: realised events after the cut-off, caught if top-decile (JN13, JN14)."""
    cut = F.to_date(F.lit(cutoff))
    ev = (records.filter((F.col("maintenance_date") >= cut) & service_event())
          .join(components.select("component_id", "unit_cost_usd"), "component_id", "inner"))
    flagged = forecast.filter(F.col("risk_decile") == 10).select("component_id").distinct() \
        .withColumn("caught", F.lit(True))
    ev = ev.join(flagged, "component_id", "left").withColumn(
        "caught", F.coalesce(F.col("caught"), F.lit(False)))
    delay = F.col("flight_delay_risk").isin("HIGH", "CRITICAL")
    k = ev.agg(
        F.count(F.lit(1)).cast("bigint").alias("events_total"),
        F.sum("unit_cost_usd").cast("bigint").alias("exposure_total"),
        F.count_if(F.col("caught")).cast("bigint").alias("caught_events"),
        F.sum(F.when(F.col("caught"), F.col("unit_cost_usd")).otherwise(0)).cast("bigint")
        .alias("caught_exposure"),
        F.count_if(delay).cast("bigint").alias("delay_events"),
        F.count_if(delay & F.col("caught")).cast("bigint").alias("delay_caught"),
        F.avg("days_undetected").alias("mean_days_undetected"),
    )
    avoided = F.col("caught_exposure") * F.lit(success)
    annual = avoided * F.lit(4.0)
    return k.select(
        "*", avoided.alias("avoided_exposure"),
        (F.col("exposure_total") - avoided).alias("exposure_after"),
        (F.col("delay_events") - F.col("delay_caught") * F.lit(success)).alias("delay_events_after"),
        annual.alias("annual_avoided_exposure"),
        F.try_divide(F.lit(run_cost), annual).alias("_pb")).withColumn(
        "payback_months", F.col("_pb") * 12).drop("_pb")

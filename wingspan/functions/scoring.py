"""Domain scoring formulas (SC1-SC16) as Column expressions.

Fixed values (thresholds and weights) are the reference's published rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wingspan.functions.columns import clip, col_or

# Weights and cut-offs of the scoring rules.
HEALTH_RISK_WEIGHTS = {"anomaly_rate": 40.0, "vibration": 30.0, "hydraulic": 30.0}
VIBRATION_LIMIT = 4.0
HYDRAULIC_NOMINAL = 3200.0
HYDRAULIC_FLOOR = 2600.0
HYDRAULIC_SPAN = 600.0
SLA_HIGH_BELOW = 0.80
SLA_MEDIUM_BELOW = 0.90
OVERDUE_GRACE_DAYS = 14
INTERVENTION_SUCCESS = 0.60
ANNUAL_RUN_COST_USD = 250000.0


def engine_avg_egt() -> Column:
    return (F.col("egt_eng1") + F.col("egt_eng2")) / 2


def engine_avg_vibration() -> Column:
    return (F.col("vibration_n1_eng1") + F.col("vibration_n1_eng2")
            + F.col("vibration_n2_eng1") + F.col("vibration_n2_eng2")) / 4


def fuel_burn_rate() -> Column:
    return F.col("fuel_flow_eng1") + F.col("fuel_flow_eng2")


def hydraulic_health_index() -> Column:
    """SF3: (min of three system pressures - 2600) / 600."""
    return (F.least("hyd_press_sys1", "hyd_press_sys2", "hyd_press_sys3")
            - F.lit(HYDRAULIC_FLOOR)) / F.lit(HYDRAULIC_SPAN)


def aircraft_health_risk(rate: Column, vibration: Column, hydraulic: Column) -> Column:
    """SC1: 40 x anomaly rate + 30 x vibration severity + 30 x hydraulic loss (0-100)."""
    w = HEALTH_RISK_WEIGHTS
    return (rate * w["anomaly_rate"]
            + F.least(vibration / F.lit(VIBRATION_LIMIT), F.lit(1.0)) * w["vibration"]
            + (F.lit(1.0) - F.least(hydraulic / F.lit(HYDRAULIC_NOMINAL), F.lit(1.0))) * w["hydraulic"])


def overdue_days(days: str = "days_since_last_service",
                 interval: str = "maintenance_interval_days") -> Column:
    """SC3: days past the interval, no grace (D8)."""
    return F.greatest(F.col(days) - F.col(interval), F.lit(0)).cast("bigint")


def overdue_with_grace(days: str = "days_since_last_service",
                       interval: str = "maintenance_interval_days") -> Column:
    """SC4: overdue flag with the 14-day grace (D8: differs from overdue_days > 0)."""
    return F.col(days) > F.col(interval) + F.lit(OVERDUE_GRACE_DAYS)


def compliance_score(status: str = "compliance_status", days: str = "days_since_last_service",
                     interval: str = "maintenance_interval_days") -> Column:
    """SC2: COMPLIANT -> 1 - min(days / (1.5 x interval), 1) x 0.2, else 0 (as double)."""
    frac = F.least(F.try_divide(F.col(days).cast("double"), F.col(interval) * F.lit(1.5)),
                   F.lit(1.0))
    return F.when(F.col(status) == "COMPLIANT", F.lit(1.0) - frac * F.lit(0.2)).otherwise(F.lit(0.0))


def sla_breach_risk(avg_score: str | Column) -> Column:
    """SC6."""
    s = col_or(avg_score)
    return (F.when(s < SLA_HIGH_BELOW, F.lit("HIGH"))
            .when(s < SLA_MEDIUM_BELOW, F.lit("MEDIUM")).otherwise(F.lit("LOW")))


def component_health_index(cycles: Column, max_cycles: Column, days: Column,
                           interval: Column) -> Column:
    """SC7: clip(100 - cycle_pct x 45 - overdue_pct x 35, 0, 100)."""
    cycle_pct = F.least(F.try_divide(cycles.cast("double"), max_cycles.cast("double")), F.lit(1.0))
    overdue_pct = F.least(F.try_divide(days.cast("double"), interval.cast("double")), F.lit(1.5))
    return clip(F.lit(100.0) - F.coalesce(cycle_pct, F.lit(1.0)) * 45.0
                - F.coalesce(overdue_pct, F.lit(1.5)) * 35.0, 0.0, 100.0)


def failure_risk_tier(health: Column, days: Column, interval: Column) -> Column:
    """SC8: CRITICAL if health < 30 or > 1.5x late; HIGH < 50 or > 1.2x; MEDIUM < 70 or > 1x."""
    late = F.try_divide(days.cast("double"), interval.cast("double"))
    return (F.when((health < 30) | (late > 1.5), F.lit("CRITICAL"))
            .when((health < 50) | (late > 1.2), F.lit("HIGH"))
            .when((health < 70) | (late > 1.0), F.lit("MEDIUM"))
            .otherwise(F.lit("LOW")))


def maintenance_priority(prob: Column, health_risk: Column, days_until: Column) -> Column:
    """SC10: p x 35 + health x 0.35 + due boost (30 if < 30 d, 15 if < 90 d), clipped 0-100."""
    due = F.coalesce(days_until, F.lit(365))
    boost = F.when(due < 30, F.lit(30.0)).when(due < 90, F.lit(15.0)).otherwise(F.lit(0.0))
    return clip(prob * 35.0 + health_risk * 0.35 + boost, 0.0, 100.0)


def priority_tier(score: Column) -> Column:
    """SC11: right-closed bins (..20] LOW, (20,40] MEDIUM, (40,60] HIGH, (60,100] CRITICAL (D15)."""
    return (F.when(score <= 20, F.lit("LOW")).when(score <= 40, F.lit("MEDIUM"))
            .when(score <= 60, F.lit("HIGH")).otherwise(F.lit("CRITICAL")))


def recommended_action(decile: Column) -> Column:
    """SC13."""
    return (F.when(decile == 10, F.lit("PROACTIVE_FIELD_SERVICE_VISIT"))
            .when(decile >= 8, F.lit("FLAG_AT_NEXT_SCHEDULED_CHECK"))
            .otherwise(F.lit("ROUTINE_MONITORING")))


# Probability offsets by operator of the rule-only priority (SC12).
CARRIER_RISK_BOOST = {
    "SkyWest Global": 0.25,
    "Atlas Pacific": 0.20,
    "Continental Wings": 0.10,
    "Horizon Express": 0.05,
    "Falcon Jet Airways": 0.03,
    "TransOcean Air": 0.0,
    "Meridian Airlines": 0.0,
    "Northern Star Airways": -0.05,
    "Aurora Airlines": -0.10,
    "Summit Aviation": -0.15,
}


def rule_anomaly_probability(rate: Column, airline: Column, boosts: dict[str, float] | None = None) -> Column:
    """SC12: three times the anomaly rate plus the operator's offset, clipped to 0-1 (no noise term)."""
    table = F.create_map(*[F.lit(x) for kv in (boosts or CARRIER_RISK_BOOST).items() for x in kv])
    boost = F.coalesce(F.try_element_at(table, airline), F.lit(0.0))
    return clip(F.coalesce(rate, F.lit(0.0)) * 3.0 + boost, 0.0, 1.0)


def rule_priority(prob: Column, health_risk: Column, days_until: Column) -> Column:
    """SC12: 40 p + 0.5 health + up to 20 for a service due within 180 days; 0 and null count as 8 and 180."""
    health = F.when(health_risk != 0, health_risk).otherwise(F.lit(8.0))
    days = F.when(days_until != 0, days_until).otherwise(F.lit(180))
    urgency = F.greatest(F.lit(0.0), (F.lit(180) - days) / 180.0) * 20
    return F.least(F.lit(100.0), prob * 40 + health * 0.5 + urgency)


def rule_priority_tier(score: Column) -> Column:
    """SC12: above 75 CRITICAL, above 50 HIGH, above 25 MEDIUM."""
    return (F.when(score > 75, F.lit("CRITICAL")).when(score > 50, F.lit("HIGH"))
            .when(score > 25, F.lit("MEDIUM")).otherwise(F.lit("LOW")))

"""Exact model evaluation as Spark jobs (ML12-ML18, ML24, SC16).

All metrics start from one aggregate per distinct score, (score, n, pos),
then use distributed running sums over the score order.  Ties share the
average rank (ROC-AUC), AP is the step-wise sum over distinct thresholds
(not MLlib's trapezoid, D20).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wingspan.functions.columns import qcut_decile
from wingspan.operators.ordering import global_cumsum, global_row_number


def score_groups(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    return df.groupBy(score).agg(F.count(F.lit(1)).cast("bigint").alias("n"),
                                 F.sum(F.col(label).cast("bigint")).cast("bigint").alias("pos"))


def roc_auc(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """ROC-AUC by the rank-sum formula with average ranks for ties; one row."""
    g = score_groups(df, score, label)
    c = global_cumsum(g, [F.col(score).asc()], {"n": "n"}, inclusive=False)
    c = c.withColumn("avg_rank", F.col("cum_n") + (F.col("n") + 1) / 2.0)
    t = c.agg(F.sum("n").alias("n_tot"), F.sum("pos").alias("p"),
              F.sum(F.col("pos") * F.col("avg_rank")).alias("rank_sum"))
    neg = F.col("n_tot") - F.col("p")
    return t.select(
        F.col("p").cast("bigint").alias("positives"), neg.cast("bigint").alias("negatives"),
        F.try_divide(F.col("rank_sum") - F.col("p") * (F.col("p") + 1) / 2.0,
                     F.col("p") * neg).alias("roc_auc"))


def average_precision(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """AP = sum over distinct thresholds (descending) of recall step x precision."""
    g = score_groups(df, score, label)
    c = global_cumsum(g, [F.col(score).desc()], {"n": "n", "tp": "pos"}, inclusive=True)
    p_tot = g.select(F.sum("pos")).scalar()
    return c.agg(F.try_divide(F.sum(F.col("pos") * (F.col("cum_tp") / F.col("cum_n"))),
                              p_tot).alias("average_precision"))


def roc_points(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """ML17: (threshold, fpr, tpr) at each distinct score, descending thresholds."""
    g = score_groups(df, score, label)
    c = global_cumsum(g, [F.col(score).desc()], {"n": "n", "tp": "pos"}, inclusive=True)
    p_tot = g.select(F.sum("pos")).scalar()
    n_tot = g.select(F.sum(F.col("n") - F.col("pos"))).scalar()
    return c.select(F.col(score).alias("threshold"),
                    F.try_divide(F.col("cum_n") - F.col("cum_tp"), n_tot).alias("fpr"),
                    F.try_divide(F.col("cum_tp"), p_tot).alias("tpr"))


def ranked(df: DataFrame, key: str, score: str = "score", descending: bool = True,
           name: str = "rank_desc") -> DataFrame:
    """Distributed row_number over (score, key): D14 tie-break by id."""
    s = F.col(score).desc() if descending else F.col(score).asc()
    return global_row_number(df, [s, F.col(key).asc()], name=name)


def top_decile_capture(df: DataFrame, key: str, score: str = "score", label: str = "y",
                       share: float = 0.10) -> DataFrame:
    """ML14: share of positives among the top ceil(share x n) rows, and the lift."""
    r = ranked(df, key, score)
    # one number to the driver (a scalar subquery over a non-deterministic
    # model output cannot feed an aggregate); k = ceil(share x n) exactly
    n = df.count()
    from decimal import ROUND_CEILING, Decimal
    k = F.lit(int((Decimal(n) * Decimal(str(share))).to_integral_value(ROUND_CEILING)))
    out = r.agg(F.sum(F.when(F.col("rank_desc") <= k, F.col(label)).otherwise(0)).alias("caught"),
                F.sum(F.col(label)).alias("positives"))
    cap = F.col("caught") / F.greatest(F.col("positives"), F.lit(1))
    return out.select(F.col("caught").cast("bigint").alias("caught"),
                      F.col("positives").cast("bigint").alias("positives"),
                      k.cast("bigint").alias("k"), cap.alias("top_decile_capture"),
                      (cap / F.lit(share)).alias("lift_vs_random"))


def risk_deciles(df: DataFrame, key: str, score: str = "score") -> DataFrame:
    """WN9 / D13: decile 1..10 (10 = highest) from the ascending rank by (score, key)."""
    r = ranked(df, key, score, descending=False, name="rank_asc")
    n = df.select(F.count(F.lit(1))).scalar()
    return r.withColumn("risk_decile", qcut_decile(F.col("rank_asc"), n)).drop("rank_asc")


def confusion(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """ML16 in long form: (actual, predicted, n)."""
    return df.groupBy(actual, predicted).agg(F.count(F.lit(1)).cast("bigint").alias("n"))


def class_report(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """ML15: per-class precision / recall / F1 / support plus accuracy and macro rows."""
    cm = confusion(df, actual, predicted)
    tp = cm.filter(F.col(actual) == F.col(predicted)).select(F.col(actual).alias("cls"),
                                                             F.col("n").alias("tp"))
    sup = cm.groupBy(F.col(actual).alias("cls")).agg(F.sum("n").alias("support"))
    prd = cm.groupBy(F.col(predicted).alias("cls")).agg(F.sum("n").alias("predicted"))
    per = (sup.join(prd, "cls", "full").join(tp, "cls", "left")
           .select(F.col("cls").cast("string").alias("cls"),
                   F.coalesce("support", F.lit(0)).cast("bigint").alias("support"),
                   F.coalesce("predicted", F.lit(0)).cast("bigint").alias("predicted"),
                   F.coalesce("tp", F.lit(0)).cast("bigint").alias("tp")))
    per = per.withColumns({
        "precision": F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0)),
        "recall": F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0)),
    }).withColumn("f1", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"),
                                                F.col("precision") + F.col("recall")), F.lit(0.0)))
    everything = Window.partitionBy()  # one row per class: tiny
    per = per.withColumns({
        "accuracy": F.sum("tp").over(everything) / F.sum("support").over(everything),
        "macro_f1": F.avg("f1").over(everything),
    })
    return per.select("cls", "support", "tp", "precision", "recall", "f1", "accuracy", "macro_f1")


def score_histogram(df: DataFrame, score: str, label: str, bins: int = 50) -> DataFrame:
    """ML18: equal-width bins between the global min and max score, per class."""
    lo = df.select(F.min(score)).scalar()
    hi = df.select(F.max(score)).scalar()
    width = (hi - lo) / F.lit(float(bins))
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col(score) - lo) / width), F.lit(bins - 1))).cast("int")
    return (df.withColumn("bin", b).groupBy(label, "bin")
            .agg(F.count(F.lit(1)).cast("bigint").alias("n")))

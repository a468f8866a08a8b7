"""The fits: folds side by side, narrow rows in the split of the flights."""

import threading

from pyspark.sql import functions as F

from wingspan.operators import models as M
from wingspan.operators.features import CATEGORICAL_FEATURES, NUMERIC_FEATURES


def _parts(spark):
    cols = [F.col("id").cast("int").alias("component_id"), (F.col("id") % 3 == 0).cast("int").alias("y")]
    cols += [F.rand(i).alias(c) for i, c in enumerate(NUMERIC_FEATURES)]
    return spark.range(60).select(*cols, *[F.lit("a").alias(c) for c in CATEGORICAL_FEATURES])


def test_folds_are_fitted_side_by_side(spark, monkeypatch):
    together = threading.Barrier(5, timeout=60)

    def fit(stages, train, real=M._fit):
        together.wait()  # passes only if all five fits are under way
        return real(stages, train)
    monkeypatch.setattr(M, "_fit", fit)
    rows = M.oof_scores(_parts(spark), "logreg").collect()
    assert sorted(r.component_id for r in rows) == list(range(60)) and {r.fold for r in rows} == set(range(5))


def test_larger_tables_are_fitted_fold_by_fold(spark, monkeypatch):
    at_once, most, lock = [0], [0], threading.Lock()

    def fit(stages, train, real=M._fit):
        with lock:
            at_once[0] += 1
            most[0] = max(most[0], at_once[0])
        try:
            return real(stages, train)
        finally:
            with lock:
                at_once[0] -= 1
    monkeypatch.setattr(M, "_fit", fit)
    monkeypatch.setattr(M, "PARALLEL_ROWS", 10)
    assert M.oof_scores(_parts(spark), "logreg").count() == 60 and most[0] == 1


def test_the_flight_split_numbers_no_copies_of_the_rows(spark, monkeypatch):
    import wingspan.operators.ordering as O
    numbered = []
    monkeypatch.setattr(O, "materialize", lambda df, name, real=O.materialize: numbered.append(df) or real(df, name))
    flights = spark.range(80).select(
        (F.col("id") % 70).cast("string").alias("flight"), F.repeat(F.lit("long text "), 50).alias("note"),
        *[(F.col("id") % 70 + i).cast("double").alias(c) for i, c in enumerate(M.FLIGHT_FEATURES)],
        (F.col("id") % 70 % 2 == 0).alias("has_anomaly"))
    _, held = M.flight_anomaly_model(flights, maxIter=2)
    kinds = {f.dataType.simpleString() for df in numbered for f in df.schema.fields}
    assert numbered and "string" not in kinds and kinds >= {"binary"}
    per = dict(held.groupBy("actual").count().collect())
    assert set(per) == {0, 1} and sum(per.values()) >= 14


def test_the_flights_are_fitted_on_many_tasks_whatever_their_classes(spark, monkeypatch):
    flights = spark.range(900).select(
        F.col("id").cast("string").alias("flight"), (F.col("id") % 3 == 0).alias("has_anomaly"),
        *[(F.col("id") % (70 + i)).cast("double").alias(c) for i, c in enumerate(M.FLIGHT_FEATURES)])
    monkeypatch.setattr(M, "FLIGHT_TASK_ROWS", 60)
    seen, fit = [], M.GBTClassifier.fit
    monkeypatch.setattr(M.GBTClassifier, "fit", lambda self, rows: (
        seen.append(sorted(len(p) for p in rows.select("label").rdd.glom().collect())), fit(self, rows))[1])
    _, held = M.flight_anomaly_model(flights, maxIter=1)
    assert sum(seen[0]) == 720 and len(seen[0]) >= 12 and seen[0][-1] <= 120
    assert held.count() == 180


def test_a_task_of_a_boosted_fit_holds_a_bounded_number_of_rows(spark, monkeypatch):
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    rows = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("a"), F.lit(1.0).alias("weight"),
                                   (F.col("id") % 2).cast("double").alias("label")).coalesce(1)
    seen, fit = [], GBTClassifier.fit
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df: seen.append(
        [len(p) for p in df.select("id").rdd.glom().collect()]) or fit(self, df))
    stages = [VectorAssembler(inputCols=["a"], outputCol="features_raw"),
              GBTClassifier(featuresCol="features_raw", labelCol="label", weightCol="weight", maxIter=1, maxDepth=1)]
    assert M._fit_dealt(stages, rows, "id", 50).transform(rows).count() == 400
    M._fit_dealt(stages, rows, "id")  # few rows stay where they are
    assert sum(seen[0]) == 400 and len(seen[0]) == 8 and max(seen[0]) < 100
    assert seen[1] == [400]


def test_large_forest_is_grown_in_parts_on_many_tasks(spark, monkeypatch):
    """Every tree of a forest with too many counts for one fit is grown on every row, in tasks of bounded rows."""
    monkeypatch.setattr(M, "FOREST_PARAMS", dict(numTrees=7, maxDepth=3, seed=42))
    monkeypatch.setattr(M, "FOREST_COUNTS", 7 * 100)
    monkeypatch.setattr(M, "TASK_ROWS", 40)
    seen, fit = [], M.RandomForestClassifier.fit
    monkeypatch.setattr(M.RandomForestClassifier, "fit", lambda self, rows: (
        seen.append((self.getNumTrees(), rows.rdd.getNumPartitions(), rows.count())), fit(self, rows))[1])
    rows = spark.range(400).selectExpr(
        "id AS flight_id", "1 AS record_sequence", "if(id % 4 = 0, 'A', 'B') AS anomaly_type",
        "CAST(if(id % 4 = 0, 10 + id % 7, id % 7) AS double) AS x", "CAST(id % 3 AS double) AS z")
    pred, ranked = M.anomaly_type_forest(rows, ["x", "z"])
    held = pred.collect()
    assert len(held) == 100 and all(r.actual == r.predicted for r in held)
    assert [s for s, _, _ in seen] == [3, 2, 2] and {n for _, _, n in seen} == {300}
    assert min(p for _, p, _ in seen) >= 8
    assert [f for f, _ in ranked] == ["x", "z"] and abs(sum(v for _, v in ranked) - 1) < 1e-9

"""Models on Spark (ML5-ML11, ML19, ML21-ML22, ML25).

The reference fits scikit-learn models on the driver.  Here every fit and
every score is an MLlib (or pandas-in-task) job over DataFrames; the only
driver loop walks the five folds, side by side on few rows.  Metrics come from
:mod:`wingspan.operators.evaluation` (exact AUC / AP / capture).
"""

from __future__ import annotations

import math
import uuid
from functools import partial, reduce
from multiprocessing.pool import ThreadPool

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.feature import Imputer, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from wingspan.operators.features import (CATEGORICAL_FEATURES, NUMERIC_FEATURES, class_weights,
                                         stratified_folds)
from wingspan.operators.ordering import join_null_safe

# Hyper-parameters of the reference's models.
LOGREG_C = 0.3
GBT_PARAMS = dict(maxIter=150, maxDepth=2, stepSize=0.05, subsamplingRate=0.8, seed=42)
# Not a property of the model: a checkpoint writes an error per training row.
CHECKPOINT_EVERY = 50
TASK_ROWS = 100_000  # rows of a task of a boosted fit, which holds 4 bytes per row and indicator
FLIGHT_TASK_ROWS = 400_000  # the same of the flights, which have ten features
FOREST_COUNTS = 1_500_000_000  # bootstrap counts (4 bytes) that one fit of a forest keeps, over all executors
PARALLEL_ROWS = 5_000_000  # up to this many rows the folds are fitted side by side; a larger fit fills the cluster alone
FLIGHT_FEATURES = ["flight_duration_hours", "max_altitude", "avg_cruise_speed", "total_fuel_burned", "max_egt_eng1",
                   "max_egt_eng2", "max_vibration", "avg_oil_pressure_eng1", "avg_oil_pressure_eng2",
                   "min_hydraulic_pressure"]
FLIGHT_GBT_PARAMS = dict(maxIter=200, maxDepth=4, stepSize=0.1, seed=42)
FOREST_PARAMS = dict(numTrees=300, maxDepth=8, seed=42)
ISO_TREES = 200
ISO_SAMPLE = 256
ISO_CONTAMINATION = 0.10


def design_matrix(pit: DataFrame, label: str = "y") -> DataFrame:
    """ML2 + fillna(0): numeric features and one-hot categories in one vector."""
    num = pit.fillna(0, subset=NUMERIC_FEATURES)
    num = num.withColumns({c: F.col(c).cast("double") for c in NUMERIC_FEATURES})
    cats = num.fillna("__null__", subset=CATEGORICAL_FEATURES)
    return cats


def _feature_stages():
    idx = [StringIndexer(inputCol=c, outputCol=f"{c}_ix", handleInvalid="keep",
                         stringOrderType="alphabetAsc") for c in CATEGORICAL_FEATURES]
    ohe = OneHotEncoder(inputCols=[f"{c}_ix" for c in CATEGORICAL_FEATURES],
                        outputCols=[f"{c}_oh" for c in CATEGORICAL_FEATURES], dropLast=False,
                        handleInvalid="keep")
    asm = VectorAssembler(inputCols=NUMERIC_FEATURES + [f"{c}_oh" for c in CATEGORICAL_FEATURES],
                          outputCol="features_raw")
    return idx + [ohe, asm]


def _classifier(kind: str, n_train_weight: float):
    if kind == "logreg":
        # sklearn C on a weighted sum of losses == MLlib regParam on the weighted mean
        return [StandardScaler(inputCol="features_raw", outputCol="features", withMean=True,
                               withStd=True),
                LogisticRegression(featuresCol="features", labelCol="label", weightCol="weight",
                                   regParam=1.0 / (LOGREG_C * n_train_weight), elasticNetParam=0.0,
                                   maxIter=2000, standardization=False)]
    if kind == "gbt":
        return [GBTClassifier(featuresCol="features_raw", labelCol="label", weightCol="weight",
                              checkpointInterval=CHECKPOINT_EVERY, **GBT_PARAMS)]
    raise ValueError(kind)


def _without_summaries(model: PipelineModel, spark: SparkSession, name: str = "model") -> PipelineModel:
    """The fitted pipeline saved to the shared folder and loaded back.

    A training summary references the SparkSession; once an
    ``Observation`` has been used in the session it no longer serialises,
    so scoring closures must not carry it.  A loaded model has no summary
    (and the saved copy is the persisted model, ML25).
    """
    from wingspan.session import scratch_path
    path = scratch_path(spark, name)
    model.write().overwrite().save(path)
    return PipelineModel.load(path)


def _fit(stages: list, train: DataFrame) -> PipelineModel:
    return _without_summaries(Pipeline(stages=stages).fit(train), train.sparkSession)


def _fit_dealt(stages: list, train: DataFrame, key: str, task_rows: int | None = None) -> PipelineModel:
    """The stages fitted in turn; the last one, a classifier, reads at most about ``task_rows`` rows a task.

    Files of a written table are read together by their compressed size, which
    says little about the size of the binned rows that a tree fit keeps.
    """
    features = Pipeline(stages=stages[:-1]).fit(train)
    rows = features.transform(train).select(key, *{stages[-1].getFeaturesCol(), "label", "weight"})
    parts = math.ceil(train.count() / (task_rows or TASK_ROWS))
    if parts > rows.rdd.getNumPartitions():
        rows = rows.repartition(parts, key)
    return _without_summaries(PipelineModel([*features.stages, stages[-1].fit(rows)]), train.sparkSession)


def side_by_side(spark: SparkSession, calls: list, at_once: int | None = None) -> list:
    """Results of the calls, each in a driver thread of its own: their jobs share the executors."""
    pool = ThreadPool(max(1, min(len(calls), at_once or len(calls))))
    try:
        return pool.map(lambda call: call(), [inheritable_thread_target(spark)(c) for c in calls], chunksize=1)
    finally:
        pool.close()


def with_balanced_weights(df: DataFrame, label: str = "y") -> DataFrame:
    w = class_weights(df, label).select(label, "weight")
    return join_null_safe(df, w, [label])


def _fit_kind(kind: str, n_train_weight: float, train: DataFrame, key: str) -> PipelineModel:
    stages = _feature_stages() + _classifier(kind, n_train_weight)
    return _fit(stages, train) if kind == "logreg" else _fit_dealt(stages, train, key)


def oof_scores(pit: DataFrame, kind: str = "logreg", key: str = "component_id",
               label: str = "y", k: int = 5) -> DataFrame:
    """ML6 + ML8/ML9: out-of-fold probabilities for every row (stratified k-fold)."""
    folds = stratified_folds(pit, key, label, k).select(key, "fold")
    base = design_matrix(pit.join(folds, key)).withColumn("label", F.col(label).cast("double"))
    if kind != "logreg":
        base = with_balanced_weights(base, label)  # the trees are weighted over all rows
    # every fit scans its input many times: read the design matrix from a
    # written table, not by re-deriving the features from the raw records
    from wingspan.session import materialize
    base = materialize(base, f"design-{kind}")

    def held_out(f: int) -> DataFrame:
        train = base.filter(F.col("fold") != f)
        if kind == "logreg":  # weights of the training folds only: no test label enters the fit
            train = with_balanced_weights(train, label)
        test = base.filter(F.col("fold") == f)
        n_w = train.select(F.sum("weight")).first()[0]
        model = _fit_kind(kind, n_w, train, key)
        return model.transform(test).select(
            key, label, "fold", vector_to_array("probability")[1].alias("forecast_probability"))

    # most of a boosted fit on few rows is the driver's time for thousands of small jobs
    at_once = k if base.count() <= PARALLEL_ROWS else 1
    out = reduce(DataFrame.unionByName, side_by_side(base.sparkSession, [partial(held_out, f) for f in range(k)], at_once))
    return out.withColumn("model", F.lit(kind))


def refit_scores(pit: DataFrame, kind: str, key: str = "component_id", label: str = "y") -> DataFrame:
    """ML21 + ML22: the chosen model fitted on all rows, and its probability for each of them."""
    from wingspan.session import materialize
    base = materialize(with_balanced_weights(design_matrix(pit).withColumn("label", F.col(label).cast("double")), label),
                       f"refit-{kind}")
    n_w = base.select(F.sum("weight")).first()[0]
    model = _fit_kind(kind, n_w, base, key)
    return model.transform(base).select(key, vector_to_array("probability")[1].alias("forecast_probability"))


def flight_anomaly_model(flights: DataFrame, label: str = "has_anomaly", **params) -> tuple[PipelineModel, DataFrame]:
    """ML5 + ML7 + ML8: boosted trees on flight summaries; the model and its hold-out predictions.

    A fifth of each class is held out; the other rows give the means that
    replace missing features and carry balanced weights.  A missing label is
    no anomaly.
    """
    from wingspan.operators.ordering import group_row_number
    from wingspan.session import materialize
    # equal rows share a fold; a row is known by 16 bytes, so that no copy of it is numbered and joined
    rows = materialize(flights.select(
        *[F.col(c).cast("double").alias(c) for c in FLIGHT_FEATURES],
        F.coalesce(F.col(label), F.lit(False)).cast("double").alias("label"),
        F.unhex(F.md5(F.to_json(F.struct(*flights.columns)))).alias("_key")), "flight-rows")
    numbered = group_row_number(rows.select("_key", "label").distinct(), ["label"], [F.col("_key")])
    folds = numbered.select("_key", ((F.col("row_num") - 1) % 5).cast("int").alias("fold"))
    base = materialize(rows.join(folds, "_key"), "design-flights")
    train = base.filter("fold <> 0")
    # one row per class, which is broadcast: a join dealt by the class leaves two tasks
    train = materialize(join_null_safe(train, F.broadcast(class_weights(train, "label").select("label", "weight")), ["label"]),
                        "train-flights")
    filled = [f"_i_{c}" for c in FLIGHT_FEATURES]
    stages = [Imputer(strategy="mean", inputCols=FLIGHT_FEATURES, outputCols=filled),
              VectorAssembler(inputCols=filled, outputCol="features"),
              GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                            checkpointInterval=CHECKPOINT_EVERY, **{**FLIGHT_GBT_PARAMS, **params})]
    model = _fit_dealt(stages, train, "_key", FLIGHT_TASK_ROWS)
    pred = model.transform(base.filter("fold = 0")).select(
        F.col("label").cast("int").alias("actual"), F.col("prediction").cast("int").alias("predicted"),
        vector_to_array("probability")[1].alias("score"))
    return model, pred


def latest_scores(flights: DataFrame, model: PipelineModel, order: list[str],
                  entity: str = "tail_number") -> DataFrame:
    """ML22 + WN7 (D12): (entity, features, ml_anomaly_probability) of each entity's latest non-null features."""
    key = F.struct(*order)
    latest = flights.groupBy(entity).agg(*[
        F.max_by(F.col(c).cast("double"), F.when(F.col(c).isNotNull(), key)).alias(c) for c in FLIGHT_FEATURES])
    return model.transform(latest).select(
        entity, *FLIGHT_FEATURES, vector_to_array("probability")[1].alias("ml_anomaly_probability"))


def anomaly_type_forest(rows: DataFrame, features: list[str], label: str = "anomaly_type",
                        key_cols: tuple[str, ...] = ("flight_id", "record_sequence"),
                        test_share: float = 0.25) -> tuple[DataFrame, list]:
    """ML10 + ML5 + ML19: multi-class forest on anomalous rows, stratified hold-out.

    Split: rows of each class ordered by md5 of the key; the first
    ``test_share`` of each class is held out (exact per-class quota).
    Training rows carry balanced class weights.  Returns hold-out
    predictions and the ranked feature importances.
    """
    from wingspan.operators.ordering import global_row_number
    rows = rows.select(*dict.fromkeys([*key_cols, label, *features]))
    h = rows.withColumn("_h", F.md5(F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])))
    # classes are few and one may hold most rows: number globally, rebase per class
    n = global_row_number(h, [F.col(label), F.col("_h"), *[F.col(c) for c in key_cols]], "_grn",
                          reuse=True)
    g = n.groupBy(label).agg(F.min("_grn").alias("_first"), F.count(F.lit(1)).alias("_n"))
    d = join_null_safe(n, g, [label]).withColumn(
        "is_test", F.col("_grn") - F.col("_first") + 1 <= F.ceil(F.col("_n") * test_share))
    stages = [StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc"),
              VectorAssembler(inputCols=features, outputCol="features")]
    train = with_balanced_weights(d.filter(~F.col("is_test")), label)
    prepared, forests = _fit_forests(stages, train, list(key_cols))
    pred = prepared.transform(d.filter(F.col("is_test")))
    for forest in forests:
        pred = forest.transform(pred)
    # the trees of all parts vote together; equal votes go to the first class, as in one forest
    votes = reduce(lambda a, b: F.zip_with(a, b, lambda x, y: x + y),
                   [vector_to_array(f.getRawPredictionCol()) for f in forests])
    place = F.array_position("_votes", F.array_max("_votes")).cast("int")
    names = F.array(*[F.lit(x) for x in prepared.stages[0].labels])
    pred = pred.withColumn("_votes", votes).select(
        *key_cols, F.col(label).alias("actual"), F.element_at(names, place).alias("predicted"))
    trees = [f.getNumTrees for f in forests]
    imp = np.average([f.featureImportances.toArray() for f in forests], axis=0, weights=trees)
    ranked = sorted(zip(features, imp.tolist()), key=lambda t: -t[1])
    return pred, ranked


def _fit_forests(stages: list, train: DataFrame, keys: list[str]) -> tuple[PipelineModel, list]:
    """The fitted feature stages and the forest, in parts of equally many trees.

    A fit keeps a count per training row and tree.  Up to ``FOREST_COUNTS`` of
    them the forest is one fit; of more rows it is grown some trees at a time,
    each tree on every row.  A task reads about ``TASK_ROWS`` rows at most: the
    joins that give a row its class's weight leave few tasks, one for each class.
    """
    from wingspan.session import materialize
    prepared = Pipeline(stages=stages).fit(train)
    n, trees = train.count(), FOREST_PARAMS["numTrees"]
    parts = min(trees, max(1, math.ceil(n * trees / FOREST_COUNTS)))
    rows = prepared.transform(train).select(*keys, "features", "label", "weight")
    if parts > 1:  # read once per part
        rows = materialize(rows, "forest-rows")
    tasks = math.ceil(n / TASK_ROWS)
    if tasks > rows.rdd.getNumPartitions():
        rows = rows.repartition(tasks, *keys)
    forests = []
    for i, size in enumerate(len(x) for x in np.array_split(np.arange(trees), parts)):
        forest = RandomForestClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", rawPredictionCol=f"_raw_{i}",
            probabilityCol=f"_probability_{i}", predictionCol=f"_prediction_{i}",
            **{**FOREST_PARAMS, "numTrees": size, "seed": FOREST_PARAMS["seed"] + i})
        forests.append(_without_summaries(PipelineModel([forest.fit(rows)]), train.sparkSession).stages[0])
    return prepared, forests


# ----------------------------------------------------------- isolation forest (ML11)
def _c(n: float) -> float:
    """Average path length of an unsuccessful BST search among n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1) + 0.5772156649) - 2.0 * (n - 1) / n


def _build_tree(x: np.ndarray, rng: np.random.Generator, max_depth: int):
    feat, thr, left, right, size = [], [], [], [], []

    def grow(idx, depth):
        node = len(feat)
        feat.append(-1), thr.append(0.0), left.append(-1), right.append(-1), size.append(len(idx))
        if depth >= max_depth or len(idx) <= 1:
            return node
        sub = x[idx]
        lo, hi = sub.min(axis=0), sub.max(axis=0)
        cand = np.where(hi > lo)[0]
        if len(cand) == 0:
            return node
        f = int(rng.choice(cand))
        t = float(rng.uniform(lo[f], hi[f]))
        feat[node], thr[node] = f, t
        li = idx[sub[:, f] < t]
        ri = idx[sub[:, f] >= t]
        left[node] = grow(li, depth + 1)
        right[node] = grow(ri, depth + 1)
        return node

    grow(np.arange(len(x)), 0)
    return feat, thr, left, right, size


def _walkable(tree) -> tuple:
    """A grown tree for :func:`_path_length`: a leaf is its own child, every node has the path length that ends there."""
    feat, thr, left, right, size = (np.asarray(a) for a in tree)
    own, leaf = np.arange(len(feat)), feat < 0
    child = np.column_stack([np.where(leaf, own, left), np.where(leaf, own, right)]).astype(np.int64).ravel()
    depth = np.zeros(len(feat))
    for i in np.flatnonzero(~leaf):  # parents come before their children
        depth[left[i]] = depth[right[i]] = depth[i] + 1
    length = depth + np.array([_c(n) for n in size])
    return np.where(leaf, 0, feat).astype(np.int64), np.asarray(thr, dtype=float), child, length, int(depth.max())


def _path_length(walk, x: np.ndarray) -> np.ndarray:
    feat, thr, child, length, levels = walk
    flat, start = x.ravel(), np.arange(len(x)) * x.shape[1]
    node = np.zeros(len(x), dtype=np.int64)
    for _ in range(levels):
        left = flat[start + feat[node]] < thr[node]
        node = child[2 * node + ~left]
    return length[node]


def draw_threshold(n_rows: int, per_tree: int) -> int:
    """Largest 63-bit hash at which a row joins a tree: 3 x per_tree rows in expectation.

    Integer arithmetic over the whole hash range, so it stays above 0 for
    any table that fits 63 bits of rows.
    """
    return min((1 << 63) - 1, ((1 << 63) * 3 * per_tree) // max(n_rows, 1))


def isolation_forest(sample: DataFrame, features: list[str], key_cols: list[str],
                     trees: int = ISO_TREES, per_tree: int = ISO_SAMPLE, seed: int = 42) -> DataFrame:
    """ML11: isolation forest built and scored as Spark jobs.

    * each tree's 256 rows are drawn by hashing (row, tree): a row is a
      candidate for a tree under a hash threshold (~768 candidates per
      tree), and the 256 smallest second hashes are kept per tree - tree
      groups are bounded and nothing is collected to the driver;
    * trees are grown with ``applyInPandas`` (one group = one tree of
      256 rows, bounded);
    * the grown trees (trees x at most 2 x 256 nodes, a fixed bound) are
      broadcast and every row is scored with ``mapInPandas``;
    * the outlier cut is the (1 - contamination) quantile of the scores.
    """
    from wingspan.session import materialize
    spark = sample.sparkSession
    row_key = F.concat_ws("|", *[F.col(c).cast("string") for c in key_cols])
    n_rows = sample.count()
    # Each row joins tree t when its hash for t falls under a threshold that
    # yields ~3x the tree size in expectation; the 256 smallest hashes of a
    # tree then form its sample.  Rows emit only the trees they are drawn
    # for (no rows x trees product).
    thr = draw_threshold(n_rows, per_tree)

    def h(t):
        return F.shiftrightunsigned(F.xxhash64(F.col("_rk"), t, F.lit(seed)), 1)

    drawn = F.filter(F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: h(t) <= F.lit(thr))
    pick = (sample.select(*key_cols, *features).withColumn("_rk", row_key)
            .withColumn("tree", F.explode(drawn))
            .withColumn("_h", F.xxhash64(F.col("_rk"), F.col("tree"), F.lit(seed + 1))))
    pick = pick.withColumn("_r", F.row_number().over(Window.partitionBy("tree").orderBy("_h", "_rk"))) \
        .filter(F.col("_r") <= per_tree)
    max_depth = int(math.ceil(math.log2(per_tree)))
    fcount = len(features)

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        t = int(pdf["tree"].iloc[0])
        x = pdf[features].to_numpy(dtype=float)
        rng = np.random.default_rng(seed * 100003 + t)
        feat, thr, left, right, size = _build_tree(x, rng, max_depth)
        return pd.DataFrame({"tree": [t], "feat": [feat], "thr": [thr], "left": [left],
                             "right": [right], "size": [size]})

    forest = pick.groupBy("tree").applyInPandas(
        grow, "tree long, feat array<int>, thr array<double>, left array<int>, right array<int>, "
              "size array<int>").orderBy("tree").collect()
    if n_rows and not forest:
        raise RuntimeError("no tree has drawn a row")
    model = [(r["feat"], r["thr"], r["left"], r["right"], r["size"]) for r in forest]
    bc = spark.sparkContext.broadcast(model)
    cn = _c(per_tree)

    def score(it):
        trees_ = [_walkable(tr) for tr in bc.value]
        for pdf in it:
            x = pdf[features].to_numpy(dtype=float).reshape(-1, fcount)
            depth = np.zeros(len(x))
            for tr in trees_:
                depth += _path_length(tr, x)
            s = np.power(2.0, -(depth / len(trees_)) / cn)
            out = pdf[key_cols].copy()
            out["anomaly_score"] = s
            yield out

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in sample.schema
                       if f.name in key_cols) + ", anomaly_score double"
    # scored once: the cut and the marked rows read the written scores
    scored = materialize(sample.select(*key_cols, *features).mapInPandas(score, schema), "isolation")
    cut = scored.select(F.percentile_approx("anomaly_score", 1 - ISO_CONTAMINATION, 10000)).scalar()
    return scored.withColumn("is_outlier", F.col("anomaly_score") > cut)


def run_record(params: dict, metrics: dict) -> dict:
    """ML25: one row for a ``model_runs`` table (append)."""
    return {"run_id": uuid.uuid4().hex, "params": {k: str(v) for k, v in params.items()},
            "metrics": {k: float(v) for k, v in metrics.items()}}


def log_run(spark: SparkSession, path: str, params: dict, metrics: dict) -> None:
    rec = run_record(params, metrics)
    df = spark.createDataFrame([rec], "run_id string, params map<string,string>, metrics map<string,double>")
    df.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(path)


def compare_models(scored: dict[str, DataFrame], key: str = "component_id", label: str = "y",
                   score: str = "forecast_probability") -> DataFrame:
    """ML12-ML14 + ML21: exact metrics per candidate; ``best`` marks the highest capture."""
    from wingspan.operators import evaluation as ev
    rows = None
    for name, df in scored.items():
        s = df.select(key, label, F.col(score).alias("score"))
        auc = ev.roc_auc(s).select("roc_auc")
        ap = ev.average_precision(s)
        cap = ev.top_decile_capture(s, key).select("top_decile_capture", "lift_vs_random")
        row = auc.select(F.lit(name).alias("model"), "roc_auc",
                         ap.select("average_precision").scalar().alias("pr_auc"),
                         cap.select("top_decile_capture").scalar().alias("top_decile_capture"),
                         cap.select("lift_vs_random").scalar().alias("lift_vs_random"))
        rows = row if rows is None else rows.unionByName(row)
    best = Window.partitionBy()  # one row per candidate model
    return rows.withColumn("best", F.col("top_decile_capture") ==
                           F.max("top_decile_capture").over(best))

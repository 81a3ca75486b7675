"""Training, selection, tuning, explanation and scoring of the delay classifier."""

from __future__ import annotations

import itertools
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Model, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import class_label
from skyframe.functions.ordering import numbered
from skyframe.functions.permutation import ROUNDS, permuted, round_keys
from skyframe.operators import histogram_trees as trees
from skyframe.operators import metrics
from skyframe.operators.encoding import CrossFitPipeline, linear_preprocessing, tree_preprocessing
from skyframe.operators.split import (
    row_key,
    sample_n,
    stratified_folds,
    stratified_sample,
    stratified_split,
    train_plus_val,
)
from skyframe.session import materialise, ship_package
from skyframe.sources.models import append_run, load_model, save_model

# Defaults of the three candidates, by their reported names.
LOGISTIC, FOREST, BOOSTING = (
    "LogisticRegression",
    "RandomForestClassifier",
    "HistGradientBoostingClassifier",
)
DEFAULTS = {
    LOGISTIC: {"C": 1.0, "max_iter": 1000},
    FOREST: {"n_estimators": 200, "max_depth": None, "min_samples_leaf": 1, "max_features": "sqrt"},
    BOOSTING: {"learning_rate": 0.1, "max_iter": 100, "max_leaf_nodes": 31, "min_samples_leaf": 20, "l2_regularization": 0},
}

# Search grids.
GRIDS = {
    LOGISTIC: {"C": [0.01, 0.1, 1, 10, 100]},
    FOREST: {
        "n_estimators": [100, 200, 300, 400],
        "max_depth": [None, 10, 20, 30],
        "min_samples_leaf": [1, 2, 5, 10],
        "max_features": ["sqrt", "log2", 0.5],
    },
    BOOSTING: {
        "learning_rate": [0.01, 0.03, 0.05, 0.1, 0.2],
        "max_iter": [100, 150, 200, 300],
        "max_leaf_nodes": [15, 31, 63, 127],
        "min_samples_leaf": [10, 20, 50, 100],
        "l2_regularization": [0, 0.1, 1, 10],
    },
}

#: Places of the category codes in the vector of the boosted trees.
NATIVE = list(range(len(K.LOW_CARD_FEATURES)))
PREDICTION_COLUMNS = ["predicted_class", "predicted_label", "probability_delayed"]
MEASURES = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


def classifier(name: str, rows: int, seed: int = K.SEED, **params):
    """The estimator of a candidate; ``rows`` is the size of the training set."""
    p = {**DEFAULTS[name], **params}
    common = {"featuresCol": "features", "labelCol": K.TARGET}
    if name == LOGISTIC:
        return LogisticRegression(
            maxIter=p["max_iter"],
            regParam=1.0 / (p["C"] * rows),
            elasticNetParam=0.0,
            standardization=False,
            tol=1e-4,
            **common,
        )
    if name == FOREST:
        return trees.TwoPhaseForest(
            numTrees=p["n_estimators"],
            maxDepth=p["max_depth"] or 0,
            minSamplesLeaf=p["min_samples_leaf"],
            maxFeatures=str(p["max_features"]),
            seed=seed,
            **common,
        )
    return trees.HistogramBoosting(
        categorical=NATIVE,
        learningRate=p["learning_rate"],
        maxIter=p["max_iter"],
        maxLeafNodes=p["max_leaf_nodes"],
        minSamplesLeaf=p["min_samples_leaf"],
        l2=p["l2_regularization"],
        **common,
    )


class FixedLogistic(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A logistic model of stated weights over plain columns, for models that were fitted elsewhere."""

    columns = Param(Params._dummy(), "columns", "columns of the weights", TypeConverters.toListString)
    weights = Param(Params._dummy(), "weights", "weights", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, columns: Sequence[str] = (), weights: Sequence[float] = (), intercept: float = 0.0):
        super().__init__()
        self._set(columns=list(columns), weights=list(weights), intercept=intercept)

    def _transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability``; a null counts as 0."""
        margin = F.lit(self.getOrDefault("intercept"))
        for c, w in zip(self.getOrDefault("columns"), self.getOrDefault("weights"), strict=True):
            margin = margin + F.lit(w) * F.coalesce(F.col(c).cast("double"), F.lit(0.0))
        p = 1 / (1 + F.exp(-margin))
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def preprocessing(name: str, fold_key: Sequence[str] = ()) -> list:
    if name == LOGISTIC:
        return linear_preprocessing(fold_key)
    return tree_preprocessing(K.LOW_CARD_FEATURES if name == BOOSTING else ())


def delay_pipeline(
    name: str, rows: int, seed: int = K.SEED, fold_key: Sequence[str] = (), **params
) -> CrossFitPipeline:
    """Feature engineering, preprocessing and classifier as one pipeline."""
    return CrossFitPipeline(stages=[*preprocessing(name, fold_key), classifier(name, rows, seed, **params)])


def fit(name: str, train: DataFrame, seed: int = K.SEED, fold_key: Sequence[str] = (), **params) -> PipelineModel:
    return delay_pipeline(name, train.count(), seed, fold_key, **params).fit(train)


def predict_batch(model: Model, records: DataFrame) -> DataFrame:
    """The records with class (probability at least 0.5), label and probability appended.

    Feature columns the records lack are added as nulls.
    """
    present = set(records.columns)
    filled = records.withColumns({c: F.lit(None) for c in K.FEATURE_COLUMNS if c not in present})
    p = vector_to_array("probability")[1]
    scored = model.transform(filled).withColumn("probability_delayed", p)
    scored = scored.withColumn(
        "predicted_class", F.when(F.col("probability_delayed") >= metrics.THRESHOLD, 1).otherwise(0)
    ).withColumn("predicted_label", class_label("predicted_class"))
    return scored.select(*records.columns, *PREDICTION_COLUMNS)


def fit_candidates(
    train: DataFrame, overrides: dict[str, dict] | None = None, seed: int = K.SEED, fold_key: Sequence[str] = ()
) -> dict[str, PipelineModel]:
    """All candidates, fitted side by side: a logistic fit and trees grown by one task leave most cores to the forest."""
    with ThreadPoolExecutor(len(DEFAULTS)) as pool:
        fits = {n: pool.submit(fit, n, train, seed, fold_key, **(overrides or {}).get(n, {})) for n in DEFAULTS}
    return {n: f.result() for n, f in fits.items()}


def select_model(candidates: dict[str, PipelineModel], val: DataFrame) -> tuple[str, dict[str, dict[str, float]]]:
    """Score every fitted candidate on the validation set and pick the highest ROC-AUC (first on a tie).

    All candidates are scored as one frame, so the ranks are computed in one pass.
    """
    scored = [predict_batch(m, val).withColumn("_model", F.lit(n)) for n, m in candidates.items()]
    rows = metrics.classification_metrics(reduce(DataFrame.unionByName, scored), within=["_model"]).collect()
    measured = {r["_model"]: {"roc_auc": r["roc_auc"], "f1": r["f1"]} for r in rows}
    results = {n: measured[n] for n in candidates}
    return max(results, key=lambda n: results[n]["roc_auc"]), results


def draw_params(name: str, draws: int = K.SEARCH_DRAWS, seed: int = K.SEED) -> list[dict]:
    """Distinct random points of the candidate's grid, all of them when it has fewer."""
    grid = GRIDS[name]
    points = [dict(zip(grid, values)) for values in itertools.product(*grid.values())]
    return random.Random(seed).sample(points, min(draws, len(points)))


def random_search(
    name: str,
    train: DataFrame,
    draws: int = K.SEARCH_DRAWS,
    folds: int = K.SEARCH_FOLDS,
    sample: int = K.SEARCH_SAMPLE,
    seed: int = K.SEED,
    parallelism: int = 4,
    key: Sequence[str] = (),
) -> list[tuple[dict, float]]:
    """(params, mean ROC-AUC over the folds) of each draw, best first.

    Preprocessing does not depend on the draw, so it is fitted once per fold and the
    draws are fitted side by side on the prepared fold. Boosted trees of all draws and folds
    grow together, over one set of bins: neither codes nor bins see the target.
    """
    subset = materialise(stratified_folds(stratified_sample(train, sample, seed=seed, key=key), folds, seed=seed, key=key), "search")
    points = draw_params(name, draws, seed)
    if name == BOOSTING:
        return _ranked(points, _boosting_aucs(points, subset, folds, key))
    judge = BinaryClassificationEvaluator(labelCol=K.TARGET, metricName="areaUnderROC", numBins=0)
    totals = [0.0] * len(points)
    for fold in range(folds):
        fit_rows = subset.where(F.col("fold") != fold).drop("fold")
        judged = subset.where(F.col("fold") == fold).drop("fold")
        prepared, features = CrossFitPipeline(stages=preprocessing(name, key)).fitTransform(fit_rows)
        features = features.select("features", K.TARGET).persist()
        judged = prepared.transform(judged).select("features", K.TARGET).persist()
        rows = fit_rows.count()

        def score(point: dict) -> float:
            return judge.evaluate(classifier(name, rows, seed, **point).fit(features).transform(judged))

        with ThreadPoolExecutor(parallelism) as pool:
            for i, auc in enumerate(pool.map(score, points)):
                totals[i] += auc
        features.unpersist()
        judged.unpersist()
    return _ranked(points, [t / folds for t in totals])


def _ranked(points: list[dict], aucs: list[float]) -> list[tuple[dict, float]]:
    return [(points[i], aucs[i]) for i in sorted(range(len(points)), key=lambda i: -aucs[i])]


def _boosting_aucs(points: list[dict], subset: DataFrame, folds: int, key: Sequence[str]) -> list[float]:
    """The mean ROC-AUC of each point over the folds, all fits in the same waves."""
    ship_package(subset.sparkSession)
    _, features = CrossFitPipeline(stages=preprocessing(BOOSTING, key)).fitTransform(subset)
    rows = features.select(vector_to_array("features").alias("x"), F.col(K.TARGET).cast("double").alias("y"), F.col("fold").cast("int").alias("part"))
    rows = materialise(rows, "search-rows")
    bins = trees.find_bins(rows, len(rows.first()["x"]), NATIVE, trees.BOOSTING_BINS)
    fits = [
        trees.Fit(p["learning_rate"], p["max_iter"], p["max_leaf_nodes"], p["min_samples_leaf"], p["l2_regularization"], fold)
        for p in ({**DEFAULTS[BOOSTING], **point} for point in points)
        for fold in range(folds)
    ]
    blocks = trees.boost(trees.pack_blocks(rows, bins), bins, NATIVE, fits)
    scored = trees.scores_of(blocks, len(fits)).where(F.col("part") == F.col("fit") % folds)
    scored = scored.withColumnRenamed("y", K.TARGET).withColumn("predicted_class", (F.col("p") >= metrics.THRESHOLD).cast("int"))
    found = metrics.classification_metrics(scored, score="p", within=["fit"]).collect()
    auc = {r["fit"]: r["roc_auc"] for r in found}
    return [sum(auc[i * folds + fold] for fold in range(folds)) / folds for i in range(len(points))]


def refit(
    name: str, params: dict, train: DataFrame, val: DataFrame, seed: int = K.SEED, fold_key: Sequence[str] = ()
) -> PipelineModel:
    return fit(name, train_plus_val(train, val), seed, fold_key, **params)


def scored_by(candidates: dict[str, Model], rows: DataFrame) -> DataFrame:
    """The rows once per model, with ``model`` and ``probability_delayed``; each row is scored by all in one pass."""
    scored = rows
    for i, model in enumerate(candidates.values()):
        scored = predict_batch(model, scored).drop(*PREDICTION_COLUMNS[:2]).withColumnRenamed(PREDICTION_COLUMNS[2], f"_p{i}")
    each = F.array(*[F.struct(F.lit(n).alias("model"), F.col(f"_p{i}").alias(PREDICTION_COLUMNS[2])) for i, n in enumerate(candidates)])
    return scored.select(*rows.columns, F.inline(each))


def measured_by(candidates: dict[str, Model], rows: DataFrame) -> dict[str, dict]:
    """The metrics of each model, all in one pass over the rows and with one ranking."""
    found = metrics.classification_metrics(scored_by(candidates, rows), within=["model"]).collect()
    measured = {r["model"]: r.asDict() for r in found}
    if not measured:
        empty = metrics.classification_metrics(scored_by(candidates, rows)).first().asDict()
        measured = {n: {**empty, "model": n} for n in candidates}
    return measured


def permutation_importance(
    model: Model,
    rows: DataFrame,
    columns: Sequence[str] | None = None,
    sample: int | None = None,
    repeats: int = K.IMPORTANCE_REPEATS,
    seed: int = K.SEED,
    key: Sequence[str] = (),
) -> DataFrame:
    """(column, importance): mean drop of ROC-AUC when a raw column is shuffled, largest first."""
    found = permutation_importances({"": model}, rows, columns, sample, repeats, seed, key)
    return found.drop("model").orderBy(F.desc("importance"), "column")


def permutation_importances(
    candidates: dict[str, Model],
    rows: DataFrame,
    columns: Sequence[str] | None = None,
    sample: int | None = None,
    repeats: int = K.IMPORTANCE_REPEATS,
    seed: int = K.SEED,
    key: Sequence[str] = (),
) -> DataFrame:
    """(model, column, importance) of several models, which score the same shuffled rows.

    All (column, repeat) shuffles are scored as one frame. All rows take part unless ``sample``
    asks for fewer. Rows are numbered once, in the order of keys; where a shuffle sends a value
    follows from the number by arithmetic, so that nothing is sorted again and only numbers and
    single values move to the rows that take them.
    """
    columns = list(columns or [c for c in rows.columns if c != K.TARGET])
    rows = rows.select(*dict.fromkeys([*columns, *[c for c in K.FEATURE_COLUMNS if c in rows.columns], K.TARGET]))
    chosen = rows if sample is None else sample_n(rows, sample, seed, key)
    keyed = chosen.withColumn("_key", row_key(rows.columns, seed, key))
    base = materialise(numbered(keyed, ["_key"], "_row").drop("_key"), "importance")
    n = base.count()
    # A value travels in the column of its type, and a shuffle by its number.
    kinds = list(dict.fromkeys(rows.schema[c].dataType.simpleString() for c in columns))
    place = {c: f"_v{kinds.index(rows.schema[c].dataType.simpleString())}" for c in columns}
    shuffles = [(c, r, *round_keys(c, r, seed)) for c in columns for r in range(repeats)]
    names = [f"k{i}" for i in range(ROUNDS)]
    asked = F.array(*[F.struct(*[F.lit(v).alias(a) for v, a in zip((i, *s[2:]), ("shuffle", *names), strict=True)]) for i, s in enumerate(shuffles)])
    of = {c: F.col("shuffle").between(i * repeats, (i + 1) * repeats - 1) for i, c in enumerate(columns)}
    sent = base.select("_row", *columns, F.inline(asked)).select(
        (permuted(F.col("_row") - 1, n, [F.col(k).cast("long") for k in names]) + 1).alias("_row"),
        "shuffle",
        *[F.coalesce(*[F.when(of[c], F.col(c)) for c in columns if place[c] == v]).alias(v) for v in dict.fromkeys(place.values())],
    )
    # Each row is sent one value of each shuffle: as many as there are shuffles, whatever the data.
    replaced = sent.join(base, "_row").select(
        *[F.when(of[c], F.col(place[c])).otherwise(F.col(c)).alias(c) for c in columns],
        *[c for c in rows.columns if c not in columns],
        "shuffle",
    )
    whole = {n: r["roc_auc"] for n, r in measured_by(candidates, base).items()}
    scored = scored_by(candidates, replaced)
    shuffled_column = F.element_at(F.array(*[F.lit(c) for c in columns]), (F.floor(F.col("shuffle") / repeats) + 1).cast("int"))
    before = F.coalesce(*[F.when(F.col("model") == n, F.lit(auc).cast("double")) for n, auc in whole.items()])
    return (
        metrics.classification_metrics(scored, within=["model", "shuffle"])
        .groupBy("model", shuffled_column.alias("column"))
        .agg((F.first(before) - F.avg("roc_auc")).alias("importance"))
    )


def evaluate_saved(
    path: str, flights: DataFrame, seed: int = K.SEED, key: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Metrics and importances of a saved model on the test split it was held out from."""
    found, importance = evaluate_all_saved({"": path}, flights, seed, key)
    return found.drop("model"), importance.drop("model").orderBy(F.desc("importance"), "column")


def evaluate_all_saved(
    paths: dict[str, str], flights: DataFrame, seed: int = K.SEED, key: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """The same of several saved models, by ``model``, on one split."""
    saved = {n: load_model(path) for n, path in paths.items()}
    # Written once: whatever reads it would go over all flights again.
    test = materialise(stratified_split(flights, seed=seed, key=key).where("split = 'test'").drop("split"), "test")
    found = [tuple(r[c] for c in (*MEASURES, "model")) for r in measured_by(saved, test).values()]
    return (
        flights.sparkSession.createDataFrame(found, ", ".join(f"{c} double" for c in MEASURES) + ", model string"),
        permutation_importances(saved, test, seed=seed, key=key),
    )


def prediction_vs_actual(
    model: Model, rows: DataFrame, n: int = 5, seed: int = K.SEED, key: Sequence[str] = ()
) -> DataFrame:
    """Sampled records with actual and predicted class and label, probability to three places."""
    chosen = sample_n(rows, n, seed, key).select(*K.FEATURE_COLUMNS, F.col(K.TARGET).alias("actual_class"))
    scored = predict_batch(model, chosen)
    return scored.select(
        *K.FEATURE_COLUMNS,
        "actual_class",
        class_label("actual_class").alias("actual_label"),
        "predicted_class",
        "predicted_label",
        F.round("probability_delayed", 3).alias("probability_delayed"),
    )


def train_delay_model(
    flights: DataFrame,
    model_path: str,
    runs_path: str,
    seed: int = K.SEED,
    key: Sequence[str] = (),
    overrides: dict[str, dict] | None = None,
    draws: int = K.SEARCH_DRAWS,
) -> DataFrame:
    """The whole training run: split, select, tune, refit, judge on test, save, record."""
    split = materialise(stratified_split(flights, seed=seed, key=key), "split")
    train, val, test = [split.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")]
    best, selection = select_model(fit_candidates(train, overrides, seed, key), val)
    params, _ = random_search(best, train, draws=draws, seed=seed, key=key)[0]
    model = refit(best, params, train, val, seed, key)
    scored = predict_batch(model, test)
    save_model(model, model_path)
    return append_run(
        runs_path,
        model_name=best,
        params=params,
        selection=selection,
        test_metrics=metrics.classification_metrics(scored).first().asDict(),
        importance={r["column"]: r["importance"] for r in permutation_importance(model, test, seed=seed, key=key).collect()},
        rows={"dataset": split.count(), "train": train.count(), "val": val.count(), "test": test.count()},
        spark=flights.sparkSession,
    )

"""Features, metrics, models and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.permutation import FACTOR, PRIME, ROUNDS, round_keys
from skyframe.operators import delay_models as models
from skyframe.operators import encoding, metrics
from skyframe.operators.histogram_trees import HistogramBoosting
from skyframe.operators.split import stratified_split
from skyframe.plans.profile_queries import KEY, SPLIT, flights
from skyframe.plans.registry import query
from skyframe.plans.standins import view
from skyframe.session import materialise, new_folder
from skyframe.sources import models as store

BUCKET = """CASE WHEN Time <= -0.1 THEN NULL WHEN Time <= 359 THEN 'night' WHEN Time <= 719 THEN 'morning'
      WHEN Time <= 1079 THEN 'afternoon' WHEN Time <= 1439 THEN 'evening' END"""
ENGINEERED = f"""
    eng AS (SELECT *, CASE WHEN DayOfWeek IN (6, 7) THEN 1 ELSE 0 END AS IsWeekend, {BUCKET} AS TimeOfDayBucket FROM flights)
"""


@query(f"WITH {ENGINEERED} SELECT * FROM eng")
def engineer_features(spark, sf_dir):
    return encoding.engineer_features(flights(spark, sf_dir))


def slots(column: str) -> str:
    """SQL for the 0/1 slots of a column, in category order."""
    return f"""(SELECT string_agg(CASE WHEN c.v = CAST(eng.{column} AS varchar) THEN '1' ELSE '0' END, ',' ORDER BY c.v)
      FROM (SELECT DISTINCT CAST({column} AS varchar) AS v FROM eng) c)"""


@query(
    f"WITH {ENGINEERED} SELECT Flight, "
    + ", ".join(f"{slots(c)} AS {c}_onehot" for c in K.LOW_CARD_FEATURES)
    + " FROM eng"
)
def one_hot(spark, sf_dir):
    rows = encoding.engineer_features(flights(spark, sf_dir))
    _, encoded = encoding.CrossFitPipeline(stages=encoding.one_hot_stages()).fitTransform(rows)
    shown = {
        f"{c}_onehot": F.concat_ws(",", F.transform(vector_to_array(f"{c}_onehot"), lambda x: x.cast("int").cast("string")))
        for c in K.LOW_CARD_FEATURES
    }
    return encoded.withColumns(shown).select("Flight", *shown)


def smoothed(n: str, s: str, all_n: str, all_s: str) -> str:
    overall, mean = f"(CAST({all_s} AS double) / {all_n})", f"(CAST({s} AS double) / nullif({n}, 0))"
    signal = f"({n} * {overall} * (1 - {overall}))"
    weight = f"coalesce({signal} / nullif({signal} + {mean} * (1 - {mean}), 0), 0)"
    return f"coalesce({weight} * {mean} + (1 - {weight}) * {overall}, {overall})"


FOLD = "CAST(concat('0x', substr(md5(concat(CAST(Flight AS varchar), '|42')), 1, 8)) AS bigint) % 5"


@query(
    f"""
    WITH t AS (SELECT count(*) AS n_all, sum(Class) AS s_all FROM flights),
    a AS (SELECT AirportFrom, {smoothed('count(*)', 'sum(Class)', 'any_value(n_all)', 'any_value(s_all)')} AS e
      FROM flights, t GROUP BY AirportFrom),
    b AS (SELECT AirportTo, {smoothed('count(*)', 'sum(Class)', 'any_value(n_all)', 'any_value(s_all)')} AS e
      FROM flights, t GROUP BY AirportTo)
    SELECT Flight, round(a.e, 9) AS AirportFrom_mean, round(b.e, 9) AS AirportTo_mean FROM flights f
    JOIN a ON a.AirportFrom = f.AirportFrom JOIN b ON b.AirportTo = f.AirportTo
    """
)
def target_encode(spark, sf_dir):
    rows = flights(spark, sf_dir)
    return _shown(target_encoder().fit(rows).transform(rows))


def target_encoder() -> encoding.TargetMeanEncoder:
    return encoding.TargetMeanEncoder(
        inputCols=K.HIGH_CARD_FEATURES, outputCols=[f"{c}_mean" for c in K.HIGH_CARD_FEATURES], foldKey=list(KEY)
    )


def _shown(encoded: DataFrame) -> DataFrame:
    return encoded.select("Flight", *[F.round(f"{c}_mean", 9).alias(f"{c}_mean") for c in K.HIGH_CARD_FEATURES])


def out_of_fold(column: str) -> str:
    return smoothed(f"({column}.n - {column}f.n)", f"({column}.s - {column}f.s)", "(t.n - tf.n)", "(t.s - tf.s)")


@query(
    f"""
    WITH d AS (SELECT *, {FOLD} AS fold FROM flights), t AS (SELECT count(*) AS n, sum(Class) AS s FROM d),
    tf AS (SELECT fold, count(*) AS n, sum(Class) AS s FROM d GROUP BY fold),
    a AS (SELECT AirportFrom, count(*) AS n, sum(Class) AS s FROM d GROUP BY AirportFrom),
    af AS (SELECT AirportFrom, fold, count(*) AS n, sum(Class) AS s FROM d GROUP BY AirportFrom, fold),
    b AS (SELECT AirportTo, count(*) AS n, sum(Class) AS s FROM d GROUP BY AirportTo),
    bf AS (SELECT AirportTo, fold, count(*) AS n, sum(Class) AS s FROM d GROUP BY AirportTo, fold)
    SELECT Flight, round({out_of_fold('a')}, 9) AS AirportFrom_mean, round({out_of_fold('b')}, 9) AS AirportTo_mean
    FROM d JOIN a ON a.AirportFrom = d.AirportFrom JOIN af ON af.AirportFrom = d.AirportFrom AND af.fold = d.fold
    JOIN b ON b.AirportTo = d.AirportTo JOIN bf ON bf.AirportTo = d.AirportTo AND bf.fold = d.fold
    JOIN tf ON tf.fold = d.fold, t
    """
)
def target_encode_cross_fit(spark, sf_dir):
    _, encoded = target_encoder().fitTransform(flights(spark, sf_dir))
    return _shown(encoded)


@query(
    f"WITH {ENGINEERED}, m AS (SELECT "
    + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in encoding.SCALED)
    + " FROM eng) SELECT Flight, "
    + ", ".join(f"round(({c} - {c}_m) / {c}_s, 9) AS {c}_scaled" for c in encoding.SCALED)
    + " FROM eng, m"
)
def scale(spark, sf_dir):
    rows = encoding.engineer_features(flights(spark, sf_dir))
    outputs = [f"{c}_scaled" for c in encoding.SCALED]
    scaled = encoding.PopulationScaler(inputCols=encoding.SCALED, outputCols=outputs).fit(rows).transform(rows)
    return scaled.select("Flight", *[F.round(c, 9).alias(c) for c in outputs])


CATEGORIES = [*K.LOW_CARD_FEATURES, *K.HIGH_CARD_FEATURES]


def code(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY CAST({column} AS varchar)) - 1 AS double)"


@query(f"WITH {ENGINEERED} SELECT Flight, " + ", ".join(f"{code(c)} AS {c}_code" for c in CATEGORIES) + " FROM eng")
def ordinal_encode(spark, sf_dir):
    rows = encoding.engineer_features(flights(spark, sf_dir))
    outputs = [f"{c}_code" for c in CATEGORIES]
    coded = encoding.OrdinalEncoder(inputCols=CATEGORIES, outputCols=outputs).fit(rows).transform(rows)
    return coded.select("Flight", *outputs)


@query(
    f"WITH {ENGINEERED} SELECT Flight, "
    + ", ".join(f"{code(c)} AS f{i}" for i, c in enumerate(CATEGORIES))
    + ", Time AS f5, Length AS f6, CAST(IsWeekend AS double) AS f7 FROM eng"
)
def assemble(spark, sf_dir):
    stages = encoding.tree_preprocessing()
    _, prepared = encoding.CrossFitPipeline(stages=stages).fitTransform(flights(spark, sf_dir))
    vector = vector_to_array("features")
    return prepared.select("Flight", *[vector[i].alias(f"f{i}") for i in range(len(CATEGORIES) + len(encoding.SCALED))])


@query(
    """
    WITH g AS (SELECT p, count(*) FILTER (Class = 1) AS pos, count(*) FILTER (Class = 0) AS neg FROM scored GROUP BY p),
    r AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM g
      WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    s AS (SELECT CAST(sum(pos) AS double) AS P, CAST(sum(neg) AS double) AS N,
      sum(pos) FILTER (p >= 0.5) AS tp, sum(neg) FILTER (p >= 0.5) AS fp,
      sum(neg * (cp - pos + pos / 2e0)) AS wins, sum(pos * (cp / (cp + cn))) AS steps FROM r)
    SELECT round((tp + N - fp) / (P + N), 9) AS accuracy, round(tp / (tp + fp), 9) AS precision, round(tp / P, 9) AS recall,
      round(2 * tp / (P + tp + fp), 9) AS f1, round(wins / (P * N), 9) AS roc_auc, round(steps / P, 9) AS pr_auc
    FROM s
    """
)
def classification_metrics(spark, sf_dir):
    found = metrics.classification_metrics(view(spark, sf_dir, "scored"), score="p")
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


@query(
    """
    SELECT a.actual_class, b.predicted_class,
      (SELECT count(*) FROM scored s WHERE s.Class = a.actual_class AND s.predicted_class = b.predicted_class) AS flights,
      CASE a.actual_class WHEN 0 THEN 'On-time' ELSE 'Delayed' END AS actual_label,
      CASE b.predicted_class WHEN 0 THEN 'On-time' ELSE 'Delayed' END AS predicted_label
    FROM (VALUES (0), (1)) a(actual_class), (VALUES (0), (1)) b(predicted_class)
    """
)
def confusion_matrix(spark, sf_dir):
    return metrics.confusion_matrix(view(spark, sf_dir, "scored"))


@query(
    """
    WITH g AS (SELECT p, count(*) FILTER (Class = 1) AS pos, count(*) FILTER (Class = 0) AS neg FROM scored GROUP BY p)
    SELECT p AS threshold,
      round(sum(neg) OVER w / (SELECT CAST(sum(neg) AS double) FROM g), 9) AS fpr,
      round(sum(pos) OVER w / (SELECT CAST(sum(pos) AS double) FROM g), 9) AS tpr
    FROM g WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    UNION ALL SELECT NULL, 0, 0
    """
)
def roc_points(spark, sf_dir):
    points = metrics.roc_points(view(spark, sf_dir, "scored"), score="p")
    return points.select("threshold", F.round("fpr", 9).alias("fpr"), F.round("tpr", 9).alias("tpr"))


# What a model fitted here answers has no SQL twin, but what must hold of the answers has. Scoring, evaluation,
# importance and the table of scores are therefore done for a fitted model, of which the facts below are
# returned, and, in the same pass, for a model of stated weights, which is checked value by value.

# Weights that binary fractions hold exactly, so that equal scores are equal in any engine.
STATED = {"Time": 1 / 512, "Length": -1 / 256, "DayOfWeek": 1 / 8, "IsWeekend": -1 / 2}
INTERCEPT = -3 / 4


def stated_model() -> PipelineModel:
    fixed = models.FixedLogistic(columns=list(STATED), weights=list(STATED.values()), intercept=INTERCEPT)
    return PipelineModel([encoding.FeatureEngineer(), fixed])


def stated_p(**renamed: str) -> str:
    """SQL for the probability by that model."""
    of = {c: renamed.get(c, c) for c in STATED}
    of["IsWeekend"] = f"(CASE WHEN {of['DayOfWeek']} IN (6, 7) THEN 1 ELSE 0 END)"
    margin = " + ".join(f"{w}e0 * {of[c]}" for c, w in STATED.items())
    return f"(1e0 / (1e0 + exp(-({INTERCEPT}e0 + {margin}))))"


LABEL_SQL = "CASE WHEN p >= 0.5 THEN 'Delayed' ELSE 'On-time' END"
SCORED_SQL = f"""CAST(p >= 0.5 AS integer) AS predicted_class, {LABEL_SQL} AS predicted_label, round(p, 9) AS probability_delayed"""


def rounded(scored: DataFrame) -> DataFrame:
    return scored.withColumn("probability_delayed", F.round("probability_delayed", 9))


def facts(prefix: str = "fitted_") -> list:
    """What must hold of every scored record."""
    p, cls, label = (F.col(f"{prefix}{c}") for c in ("probability_delayed", "predicted_class", "predicted_label"))
    return [
        p.between(0, 1).alias("p_ok"),
        (cls == (p >= 0.5).cast("int")).alias("class_ok"),
        (label == F.when(cls == 1, "Delayed").otherwise("On-time")).alias("label_ok"),
    ]


FACTS_SQL = "true AS p_ok, true AS class_ok, true AS label_ok"


def scored_twice(fitted: PipelineModel, rows: DataFrame) -> DataFrame:
    """The rows scored by a fitted model, in columns named ``fitted_``, and by the one of stated weights."""
    renamed = {c: f"fitted_{c}" for c in models.PREDICTION_COLUMNS}
    return models.predict_batch(stated_model(), models.predict_batch(fitted, rows).withColumnsRenamed(renamed))


def parts(spark, sf_dir) -> dict[str, DataFrame]:
    return parts_of(written_flights(spark, sf_dir))


def written_flights(spark, sf_dir) -> DataFrame:
    """The flights, written: finding the cuts of a split reads them some ten times, and each time would join them anew."""
    return materialise(flights(spark, sf_dir), "flights")


def parts_of(rows: DataFrame) -> dict[str, DataFrame]:
    split = materialise(stratified_split(rows, key=KEY), "split")
    return {n: split.where(F.col("split") == n).drop("split") for n in ("train", "val", "test")}


def logistic(train: DataFrame) -> PipelineModel:
    return models.fit(models.LOGISTIC, train, fold_key=KEY)


def _validated(spark, sf_dir, name: str, **params) -> DataFrame:
    of = parts(spark, sf_dir)
    model = models.fit(name, of["train"], fold_key=KEY, **params)
    return metrics.classification_metrics(models.predict_batch(model, of["val"])).withColumn("model", F.lit(name))


@query()
def fit_logistic(spark, sf_dir):
    return _validated(spark, sf_dir, models.LOGISTIC)


@query()
def fit_forest(spark, sf_dir):
    return _validated(spark, sf_dir, models.FOREST)


@query()
def fit_boosting(spark, sf_dir):
    return _validated(spark, sf_dir, models.BOOSTING)


NAMES = ", ".join(f"('{n}')" for n in models.DEFAULTS)
MEASURES = ("accuracy", "precision", "recall", "f1", "roc_auc", "pr_auc")


@query(f"SELECT model, true AS in_range, 1 AS selected FROM (VALUES {NAMES}) m(model)")
def select_model(spark, sf_dir):
    of = parts(spark, sf_dir)
    candidates = models.fit_candidates(of["train"], fold_key=KEY)
    best, results = models.select_model(candidates, of["val"])
    top = max(r["roc_auc"] for r in results.values())
    chosen = sum(n == best and r["roc_auc"] == top for n, r in results.items())
    rows = [(n, 0 <= r["roc_auc"] <= 1 and 0 <= r["f1"] <= 1, chosen) for n, r in results.items()]
    return spark.createDataFrame(rows, "model string, in_range boolean, selected int")


def _points(name: str) -> str:
    return ", ".join(f"('{str(p).replace(chr(39), chr(39) * 2)}')" for p in models.draw_params(name))


def _searched(spark, sf_dir, name: str) -> DataFrame:
    found = models.random_search(name, parts(spark, sf_dir)["train"], key=KEY)
    aucs = [auc for _, auc in found]
    rows = [(str(params), 0 <= auc <= 1, aucs == sorted(aucs, reverse=True)) for params, auc in found]
    return spark.createDataFrame(rows, "params string, in_range boolean, best_first boolean")


@query(f"SELECT params, true AS in_range, true AS best_first FROM (VALUES {_points(models.LOGISTIC)}) p(params)")
def random_search(spark, sf_dir):
    return _searched(spark, sf_dir, models.LOGISTIC)


@query()
def boosting_search(spark, sf_dir):
    """Twenty points of the grid of the boosted trees, three folds each, all grown together."""
    return _searched(spark, sf_dir, models.BOOSTING)


# The point of the grid that the published run found best.
BEST_POINT = {"min_samples_leaf": 10, "max_leaf_nodes": 63, "max_iter": 150, "learning_rate": 0.2, "l2_regularization": 10}


@query()
def refit(spark, sf_dir):
    """The boosted trees at their best point, fitted to all but the test part."""
    of = parts(spark, sf_dir)
    model = models.refit(models.BOOSTING, BEST_POINT, of["train"], of["val"], fold_key=KEY)
    return metrics.classification_metrics(models.predict_batch(model, of["test"]))


SHUFFLED = ("Flight", *K.FEATURE_COLUMNS)


def _keys_sql() -> str:
    rows = [(c, r, *round_keys(c, r, K.SEED)) for c in SHUFFLED for r in range(K.IMPORTANCE_REPEATS)]
    return ", ".join(f"('{c}', {r}, {', '.join(f'{k}::bigint' for k in keys)})" for c, r, *keys in rows)


def _feistel_sql(start: str) -> str:
    """SQL for one pass over the rounds: the CTE ``start`` has ``column, repeat, source, x`` and the round keys."""
    step = f"SELECT *, x // (SELECT side FROM size) AS a0, x % (SELECT side FROM size) AS b0 FROM {start}"
    for i in range(ROUNDS):
        mixed = f"((b{i} * {FACTOR} + k{i}) % {PRIME})"
        step = f"SELECT *, b{i} AS a{i + 1}, (a{i} + ({mixed} * {mixed}) % {PRIME}) % (SELECT side FROM size) AS b{i + 1} FROM ({step})"
    return f'SELECT "column", repeat, source, k0, k1, k2, k3, a{ROUNDS} * (SELECT side FROM size) + b{ROUNDS} AS x FROM ({step})'


AUC = """(sum(neg * (cp - pos + pos / 2e0)) / (CAST(sum(pos) AS double) * sum(neg)))"""
#: Area under the curve by column and repeat, where a shuffle replaces one column, and of the rows as they are.
IMPORTANCE_SQL = f"""
    base AS (SELECT *, row_number() OVER (ORDER BY md5(concat(CAST(Flight AS varchar), '|{K.SEED}'))) - 1 AS place
      FROM split WHERE split = 'test'),
    size AS (SELECT count(*) AS n, CAST(ceil(sqrt(count(*))) AS bigint) AS side FROM base),
    keys("column", repeat, k0, k1, k2, k3) AS (VALUES {_keys_sql()}),
    begun AS (SELECT "column", repeat, place AS source, k0, k1, k2, k3, place AS x FROM base, keys),
    walk AS ({_feistel_sql("begun")} UNION ALL ({_feistel_sql("(SELECT * FROM walk WHERE x >= (SELECT n FROM size))")})),
    moved AS (SELECT "column", repeat, b.*, d.Time AS t2, d.Length AS l2, d.DayOfWeek AS d2 FROM walk w
      JOIN base b ON b.place = w.x JOIN base d ON d.place = w.source WHERE x < (SELECT n FROM size)),
    chosen AS (SELECT "column", repeat, Class, CASE WHEN "column" = 'Time' THEN t2 ELSE Time END AS Time,
      CASE WHEN "column" = 'Length' THEN l2 ELSE Length END AS Length,
      CASE WHEN "column" = 'DayOfWeek' THEN d2 ELSE DayOfWeek END AS DayOfWeek FROM moved
      UNION ALL SELECT 'none', 0, Class, Time, Length, DayOfWeek FROM base),
    points AS (SELECT "column", repeat, {stated_p()} AS p, Class FROM chosen),
    grouped AS (SELECT "column", repeat, p, count(*) FILTER (Class = 1) AS pos, count(*) FILTER (Class = 0) AS neg
      FROM points GROUP BY ALL),
    summed AS (SELECT *, sum(pos) OVER (PARTITION BY "column", repeat ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cp
      FROM grouped),
    areas AS (SELECT "column", repeat, {AUC} AS auc FROM summed GROUP BY "column", repeat),
    drops AS (SELECT "column", (SELECT auc FROM areas WHERE "column" = 'none') - avg(auc) AS importance FROM areas
      WHERE "column" <> 'none' GROUP BY "column")
"""


def _joined_importances(found: DataFrame) -> DataFrame:
    """One row per column: the importance for the model of stated weights, and that for the fitted one as ``fitted``."""
    of = lambda model: F.max(F.when(F.col("model") == model, F.col("importance")))
    return found.groupBy("column").agg(F.round(of("stated"), 9).alias("importance"), of("fitted").alias("fitted"))


@query(
    f"""
    WITH RECURSIVE {SPLIT}, {IMPORTANCE_SQL}
    SELECT "column", round(importance, 9) AS importance, "column" = 'Flight' AS never_used, true AS in_range FROM drops
    """
)
def permutation_importance(spark, sf_dir):
    of = parts(spark, sf_dir)
    both = {"stated": stated_model(), "fitted": logistic(of["train"])}
    found = _joined_importances(models.permutation_importances(both, of["test"], key=KEY))
    # The model never sees the flight number, so shuffling it changes nothing; other columns may also come out at 0.
    unused = (F.col("column") == "Flight") & (F.abs("fitted") < 1e-12)
    return found.select("column", "importance", unused.alias("never_used"), F.col("fitted").between(-1, 1).alias("in_range"))


@query(f"SELECT Flight, {SCORED_SQL}, {FACTS_SQL} FROM (SELECT Flight, {stated_p()} AS p FROM flights)")
def predict_batch(spark, sf_dir):
    scored = scored_twice(logistic(parts(spark, sf_dir)["train"]), flights(spark, sf_dir))
    return rounded(scored.select("Flight", *models.PREDICTION_COLUMNS, *facts()))


@query("SELECT Flight, true AS same FROM flights")
def load_model(spark, sf_dir):
    """A fitted model read back gives every flight the same probability."""
    model, path = logistic(parts(spark, sf_dir)["train"]), new_folder(spark, "model")
    store.save_model(model, path)
    rows = flights(spark, sf_dir)
    two = [
        models.predict_batch(m, rows).select("Flight", F.col("probability_delayed").alias(f"p{i}"))
        for i, m in enumerate((model, store.load_model(path)))
    ]
    return two[0].join(two[1], "Flight").select("Flight", (F.abs(F.col("p0") - F.col("p1")) < 1e-12).alias("same"))


MEASURED_SQL = """
    r AS (SELECT *, sum(pos) OVER w AS cp, sum(neg) OVER w AS cn FROM grouped WHERE "column" = 'none'
      WINDOW w AS (ORDER BY p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
    s AS (SELECT CAST(sum(pos) AS double) AS P, CAST(sum(neg) AS double) AS N,
      sum(pos) FILTER (p >= 0.5) AS tp, sum(neg) FILTER (p >= 0.5) AS fp,
      sum(neg * (cp - pos + pos / 2e0)) AS wins, sum(pos * (cp / (cp + cn))) AS steps FROM r),
    measured AS (SELECT (tp + N - fp) / (P + N) AS accuracy, tp / (tp + fp) AS precision, tp / P AS recall,
      2 * tp / (P + tp + fp) AS f1, wins / (P * N) AS roc_auc, steps / P AS pr_auc FROM s)
"""


@query(
    f"""
    WITH RECURSIVE {SPLIT}, {IMPORTANCE_SQL}, {MEASURED_SQL}
    {" UNION ALL ".join(f"SELECT '{m}' AS part, round({m}, 9) AS value, true AS in_range FROM measured" for m in MEASURES)}
    UNION ALL SELECT "column", round(importance, 9), true FROM drops
    """
)
def evaluate_saved(spark, sf_dir):
    """A fitted model and one of stated weights, both saved, read back and evaluated."""
    paths = {n: new_folder(spark, "model") for n in ("stated", "fitted")}
    store.save_model(stated_model(), paths["stated"])
    rows = written_flights(spark, sf_dir)
    store.save_model(logistic(parts_of(rows)["train"]), paths["fitted"])
    found, importance = models.evaluate_all_saved(paths, rows, key=KEY)
    measured = found.unpivot(["model"], list(MEASURES), "part", "value").withColumn("least", F.lit(0))
    dropped = importance.select("model", F.col("column").alias("part"), F.col("importance").alias("value"), F.lit(-1).alias("least"))
    of = lambda model, c: F.max(F.when(F.col("model") == model, c))
    value = F.col("value")
    return (
        measured.unionByName(dropped)
        .groupBy("part")
        .agg(F.round(of("stated", value), 9).alias("value"), of("fitted", value.between(F.col("least"), 1)).alias("in_range"))
    )


@query(
    f"""
    WITH {SPLIT}, five AS (SELECT *, {stated_p()} AS p FROM split WHERE split = 'test'
      ORDER BY md5(concat(CAST(Flight AS varchar), '|{K.SEED}')) LIMIT 5)
    SELECT {", ".join(K.FEATURE_COLUMNS)}, Class AS actual_class, CASE Class WHEN 1 THEN 'Delayed' ELSE 'On-time' END AS actual_label,
      CAST(p >= 0.5 AS integer) AS predicted_class, {LABEL_SQL} AS predicted_label, round(p, 3) AS probability_delayed,
      (SELECT count(*) FROM five) AS records, {FACTS_SQL}, true AS actual_ok FROM five
    """
)
def prediction_vs_actual(spark, sf_dir):
    of = parts(spark, sf_dir)
    shown = models.prediction_vs_actual(logistic(of["train"]), of["test"], key=KEY)
    actual = F.when(F.col("actual_class") == 1, "Delayed").otherwise("On-time") == F.col("actual_label")
    p_ok, class_ok, label_ok = facts("")
    # Rounded to three places, a probability just under a half may read 0.5.
    half = F.col("probability_delayed") == 0.5
    held = shown.agg(
        F.count("*").alias("records"),
        F.every(p_ok).alias("p_ok"),
        F.every(F.when(half, F.lit(True)).otherwise(class_ok)).alias("class_ok"),
        F.every(label_ok).alias("label_ok"),
        F.every(actual).alias("actual_ok"),
    ).first()
    beside = models.prediction_vs_actual(stated_model(), of["test"], key=KEY)
    return beside.withColumns({c: F.lit(v).cast("long" if c == "records" else "boolean") for c, v in held.asDict().items()})


@query(f"SELECT Flight, run, {SCORED_SQL}, {FACTS_SQL} FROM (SELECT Flight, {stated_p()} AS p FROM flights), (VALUES ('first'), ('second')) r(run)")
def gold_scores(spark, sf_dir):
    """All flights scored by two runs, appended to one table."""
    model, path = logistic(parts(spark, sf_dir)["train"]), new_folder(spark, "gold-scores")
    for run in ("first", "second"):
        scored = store.write_scores(scored_twice(model, flights(spark, sf_dir)), path, run)
    return rounded(scored.select("Flight", F.col("run_id").alias("run"), *models.PREDICTION_COLUMNS, *facts()))


#: A boosted tree that SQL can follow: one round, three leaves, two columns of numbers and one of categories.
SMALL_TREE = {"learningRate": 0.3, "maxIter": 1, "maxLeafNodes": 3, "minSamplesLeaf": 20, "l2": 1.5}


def _tree_step(source: str, by: str, best: str) -> str:
    """SQL for the best split of each group of ``source`` (``{by}, Flight, col, v, g, h``) as ``best``, and its rows that go left."""
    l2, least = SMALL_TREE["l2"], SMALL_TREE["minSamplesLeaf"]
    w = f"(PARTITION BY {by}, col ORDER BY k, v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    square = lambda g, h: f"({g}) * ({g}) / ({h} + {l2}e0)"
    gain = f"{square('gl', 'hl')} + {square('ga - gl', 'ha - hl')} - {square('ga', 'ha')}"
    return f"""
    {best}_cells AS (SELECT {by}, col, v, sum(g) AS g, sum(h) AS h, count(*) AS n FROM {source} GROUP BY ALL),
    {best}_keys AS (SELECT *, CASE WHEN col = 0 THEN g / (h + {l2}e0) ELSE v END AS k FROM {best}_cells),
    {best}_sums AS (SELECT *, sum(g) OVER {w} AS gl, sum(h) OVER {w} AS hl, sum(n) OVER {w} AS nl,
      sum(g) OVER (PARTITION BY {by}, col) AS ga, sum(h) OVER (PARTITION BY {by}, col) AS ha, sum(n) OVER (PARTITION BY {by}, col) AS na
      FROM {best}_keys),
    {best} AS (SELECT *, {gain} AS gain FROM {best}_sums WHERE nl >= {least} AND na - nl >= {least}
      ORDER BY round({gain}, 9) DESC, {by}, col, k LIMIT 1),
    {best}_left AS (SELECT Flight FROM {source} s JOIN {best}_keys c USING ({by}, col, v) JOIN {best} b
      ON b.col = s.col AND b.{by} = s.{by} WHERE (c.k, c.v) <= (b.k, b.v))"""


TREE_SQL = f"""
    WITH d AS (SELECT Flight, Class, floor(Time / 60) AS hour, CAST(DayOfWeek AS double) AS dow,
      CAST(dense_rank() OVER (ORDER BY Airline) - 1 AS double) AS airline FROM flights),
    start AS (SELECT avg(Class) AS p0 FROM d),
    long AS (SELECT 0 AS node, Flight, p0 - Class AS g, p0 * (1 - p0) AS h, UNNEST([0, 1, 2]) AS col, UNNEST([airline, hour, dow]) AS v FROM d, start),
    {_tree_step("long", "node", "one")},
    sides AS (SELECT * REPLACE (CASE WHEN Flight IN (SELECT Flight FROM one_left) THEN 1 ELSE 2 END AS node) FROM long),
    {_tree_step("sides", "node", "two")},
    leaves AS (SELECT s.Flight, s.g, s.h, CASE WHEN s.node <> (SELECT node FROM two) THEN 0
      WHEN s.Flight IN (SELECT Flight FROM two_left) THEN 1 ELSE 2 END AS leaf FROM sides s WHERE col = 0),
    leaf_values AS (SELECT leaf, -{SMALL_TREE["learningRate"]}e0 * sum(g) / (sum(h) + {SMALL_TREE["l2"]}e0) AS value FROM leaves GROUP BY leaf)
    SELECT Flight, round(1e0 / (1e0 + exp(-(ln(p0 / (1 - p0)) + value))), 9) AS probability_delayed
    FROM leaves JOIN leaf_values USING (leaf), start
"""


@query(TREE_SQL)
def boosted_tree(spark, sf_dir):
    """Every flight's probability by one leaf-wise tree of three leaves."""
    rows = flights(spark, sf_dir)
    coder = encoding.OrdinalEncoder(inputCols=["Airline"], outputCols=["airline_code"]).fit(rows)
    x = F.array("airline_code", F.floor(F.col("Time") / 60).cast("double"), F.col("DayOfWeek").cast("double"))
    ready = coder.transform(rows).select("Flight", K.TARGET, array_to_vector(x).alias("features"))
    model = HistogramBoosting(categorical=[0], **SMALL_TREE).fit(ready)
    scored = model.transform(ready)
    return scored.select("Flight", F.round(vector_to_array("probability")[1], 9).alias("probability_delayed"))


SIZES_SQL = """
    WITH n AS (SELECT count(*) AS dataset FROM flights),
    t AS (SELECT dataset, CAST(ceil(0.15 * dataset) AS bigint) AS test FROM n),
    v AS (SELECT *, CAST(ceil(0.15 / 0.85 * (dataset - test)) AS bigint) AS val FROM t)
    SELECT dataset, dataset - test - val AS train, val, test
"""


#: Candidates of the recorded run, smaller than their defaults: ``select_model`` fits those.
RECORDED = {models.FOREST: {"n_estimators": 50}, models.BOOSTING: {"max_iter": 20}}


@query(f"{SIZES_SQL}, {len(models.DEFAULTS)} AS candidates, {len(SHUFFLED)} AS features, true AS best_first, {len(MEASURES)} AS measures FROM v")
def append_run(spark, sf_dir):
    """A run of three candidates: the selected one with its parameters, test metrics and importances."""
    of = parts(spark, sf_dir)
    candidates = models.fit_candidates(of["train"], RECORDED, fold_key=KEY)
    best, selection = models.select_model(candidates, of["val"])
    measured = metrics.classification_metrics(models.predict_batch(candidates[best], of["test"])).first().asDict()
    importance = models.permutation_importance(candidates[best], of["test"], key=KEY).collect()
    sizes = {n: rows.count() for n, rows in of.items()}
    runs = store.append_run(
        new_folder(spark, "model-runs"),
        spark,
        best,
        {**models.DEFAULTS[best], **RECORDED.get(best, {})},
        selection,
        measured,
        {r["column"]: r["importance"] for r in importance},
        {"dataset": sum(sizes.values()), **sizes},
    )
    return runs.select(
        F.col("dataset_rows").alias("dataset"),
        F.col("train_rows").alias("train"),
        F.col("val_rows").alias("val"),
        F.col("test_rows").alias("test"),
        F.size("selection").alias("candidates"),
        F.size("feature_importance").alias("features"),
        (F.col("selection")[0]["name"] == F.col("model_name")).alias("best_first"),
        F.size("test_metrics").alias("measures"),
    )

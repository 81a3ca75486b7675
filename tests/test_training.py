"""Loading, validation, encoders and models."""

import threading
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.operators import delay_models as models
from skyframe.operators import encoding, metrics, profile, requests
from skyframe.operators.split import stratified_split
from skyframe.plans import training_queries as queries
from skyframe.plans.standins import view
from skyframe.session import new_folder
from skyframe.sources import flights as source
from skyframe.sources import models as store

SAMPLE = {"Time": 1296.0, "Length": 141.0, "Airline": "DL", "AirportFrom": "ATL", "AirportTo": "HOU", "DayOfWeek": 1}
RECORD = "Time double, Length double, Airline string, AirportFrom string, AirportTo string, DayOfWeek int"


def records(spark, *changes):
    rows = [{**SAMPLE, **c} for c in changes]
    return spark.createDataFrame([tuple(r[c] for c in K.FEATURE_COLUMNS) for r in rows], RECORD)


@pytest.fixture(scope="module")
def flights(spark):
    """Flights whose delay depends on carrier, hour and origin, so that there is something to learn."""
    n = F.col("id")
    chance = 0.15 + 0.35 * (n % 5 == 0).cast("int") + 0.3 * (n * 37 % 1440 > 900).cast("int")
    noise = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    return spark.range(3000).select(
        n.alias("Flight"),
        (n * 37 % 1440).cast("double").alias("Time"),
        (30 + n * 13 % 600).cast("double").alias("Length"),
        F.concat(F.lit("A"), (n % 5).cast("string")).alias("Airline"),
        F.concat(F.lit("F"), (n % 41).cast("string")).alias("AirportFrom"),
        F.concat(F.lit("T"), (n % 43).cast("string")).alias("AirportTo"),
        (n % 7 + 1).cast("int").alias("DayOfWeek"),
        (noise < chance).cast("int").alias("Class"),
    ).cache()


def write_csv(spark, text):
    import pathlib

    folder = new_folder(spark, "csv").removeprefix("file:")
    pathlib.Path(folder).mkdir(parents=True)
    (pathlib.Path(folder) / "f.csv").write_text(text)
    return folder


HEADER = ",".join(K.DELAY_COLUMNS)


def test_load(spark):
    df = source.load_flights(spark, write_csv(spark, f"{HEADER},Extra\n1,10,20.5,AA,JFK,LAX,3,0,x\n"))
    assert df.columns == [*K.DELAY_COLUMNS, "Extra"]
    assert tuple(df.first()) == (1, 10.0, 20.5, "AA", "JFK", "LAX", 3, 0, "x")


def test_integers_are_kept_whole(spark):
    row = "9007199254740993,10,20.5,AA,JFK,LAX,3.0,0"
    df = source.load_flights(spark, write_csv(spark, f"{HEADER}\n{row}\n"))
    assert (df.first()["Flight"], df.first()["DayOfWeek"]) == (9007199254740993, 3)
    with pytest.raises(source.InvalidDataset):
        source.load_flights(spark, write_csv(spark, f"{HEADER}\n1,10,20.5,AA,JFK,LAX,1.9,0\n"))


def test_fractional_days_are_refused(spark):
    rows = records(spark, {}).withColumn("DayOfWeek", F.lit(1.5))
    assert requests.check_requests(rows).first()["reasons"] == ["DayOfWeek"]


def test_trees_take_more_categories_than_bins(spark):
    rows = spark.range(1200).select(
        F.col("id").alias("Flight"), (F.col("id") % 1440).cast("double").alias("Time"), F.lit(60.0).alias("Length"),
        F.concat(F.lit("C"), (F.col("id") % 300).cast("string")).alias("Airline"),
        F.lit("AAA").alias("AirportFrom"), F.lit("BBB").alias("AirportTo"), F.lit(1).alias("DayOfWeek"), (F.col("id") % 2).cast("int").alias("Class"),
    )
    model = models.fit(models.BOOSTING, rows, max_iter=1)
    assert models.predict_batch(model, rows).count() == 1200


@pytest.mark.parametrize("cell", ["", "NA", "NaN", "null"])
def test_load_refuses_missing_values(spark, cell):
    for row in (f"1,10,20,{cell},JFK,LAX,3,0", f"1,{cell},20,AA,JFK,LAX,3,0"):
        with pytest.raises(source.InvalidDataset):
            source.load_flights(spark, write_csv(spark, f"{HEADER}\n{row}\n"))


def test_load_refuses_missing_columns(spark):
    with pytest.raises(source.InvalidDataset, match="Class"):
        source.load_flights(spark, write_csv(spark, f"{HEADER.removesuffix(',Class')}\n1,1,1,A,B,C,1\n"))


@pytest.mark.parametrize(
    "change, reasons",
    [
        ({}, []),
        ({"Time": 0.0}, []),
        ({"Time": 1439.5}, ["Time"]),
        ({"Time": None}, ["Time"]),
        ({"Length": 0.0}, ["Length"]),
        ({"DayOfWeek": 9}, ["DayOfWeek"]),
        ({"Length": float("nan")}, ["Length"]),
        ({"Time": float("nan")}, ["Time"]),
        ({"Airline": ""}, ["Airline"]),
        ({"Airline": "12345678901"}, ["Airline"]),
        ({"AirportFrom": " JFK "}, ["AirportFrom"]),
        ({"AirportFrom": "   "}, []),
        ({"AirportTo": "EDDF"}, []),
        ({"AirportTo": "X", "DayOfWeek": 0}, ["AirportTo", "DayOfWeek"]),
    ],
)
def test_request_rules(spark, change, reasons):
    assert requests.check_requests(records(spark, change)).first()["reasons"] == reasons


def test_codes_are_cleaned_after_the_check(spark):
    row = requests.require_valid(records(spark, {"Airline": " dl\t", "AirportFrom": "   "})).first()
    assert (row["Airline"], row["AirportFrom"]) == ("DL", "")


def test_one_bad_record_rejects_the_batch(spark):
    with pytest.raises(requests.InvalidRequest):
        requests.require_valid(records(spark, {}, {"DayOfWeek": 9}))


@pytest.mark.parametrize(
    "minutes, bucket",
    [(0.0, "night"), (359.0, "night"), (359.5, "morning"), (719.0, "morning"), (720.0, "afternoon"), (1079.5, "evening"), (1439.0, "evening"), (1440.0, None), (-1.0, None)],
)
def test_day_buckets_close_on_the_right(spark, minutes, bucket):
    assert encoding.engineer_features(records(spark, {"Time": minutes})).first()["TimeOfDayBucket"] == bucket


def test_weekend(spark):
    days = records(spark, *[{"DayOfWeek": d} for d in range(1, 8)])
    assert [r["IsWeekend"] for r in encoding.engineer_features(days).collect()] == [0, 0, 0, 0, 0, 1, 1]


def test_unseen_categories(spark, flights):
    fitted, _ = encoding.CrossFitPipeline(stages=encoding.one_hot_stages(["Airline"])).fitTransform(flights)
    row = fitted.transform(records(spark, {"Airline": "??"})).first()
    assert row["Airline_onehot"].size == 5 and row["Airline_onehot"].numNonzeros() == 0
    coder = encoding.OrdinalEncoder(inputCols=["Airline", "AirportFrom"], outputCols=["a", "f"]).fit(flights)
    row = coder.transform(records(spark, {"Airline": "A3", "AirportFrom": None})).first()
    assert (row["a"], row["f"]) == (3.0, -1.0)


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (6.0, 5.0)], "x double, c double")
    out = encoding.PopulationScaler(inputCols=["x", "c"], outputCols=["xs", "cs"]).fit(df).transform(df).collect()
    x = np.array([1.0, 2.0, 6.0])
    assert [r["xs"] for r in out] == pytest.approx(list((x - x.mean()) / x.std()))
    assert [r["cs"] for r in out] == [0.0, 0.0, 0.0]


def smooth(y, overall_y):
    overall = np.mean(overall_y)
    if not len(y):
        return overall
    signal = len(y) * overall * (1 - overall)
    weight = signal / (signal + np.var(y)) if signal + np.var(y) else 0.0
    return weight * np.mean(y) + (1 - weight) * overall


def test_target_means_out_of_fold(spark):
    rows = [(i, "hot" if i % 3 else f"c{i % 7}", int(i * 7919 % 10 < 4)) for i in range(400)]
    rows.append((400, "single", 1))
    df = spark.createDataFrame(rows, "n long, cat string, Class int")
    encoder = encoding.TargetMeanEncoder(inputCols=["cat"], outputCols=["m"], foldKey=["n"])
    model, encoded = encoder.fitTransform(df.withColumn("f", encoding.fold_of(df.columns, key=["n"])))
    got = encoded.collect()
    assert len(got) == len(rows)
    for r in got:
        others = [o for o in got if o["f"] != r["f"]]
        want = smooth([o["Class"] for o in others if o["cat"] == r["cat"]], [o["Class"] for o in others])
        assert r["m"] == pytest.approx(want)
    every = [y for _, _, y in rows]
    new = spark.createDataFrame([("hot",), ("never",), (None,)], "cat string")
    out = {r["cat"]: r["m"] for r in model.transform(new).collect()}
    assert out["hot"] == pytest.approx(smooth([y for _, c, y in rows if c == "hot"], every))
    assert out["never"] == out[None] == pytest.approx(np.mean(every))


def test_missing_categories_are_a_category_of_their_own(spark):
    df = spark.createDataFrame([(i, None if i % 2 else "x", int(i % 2)) for i in range(40)], "n long, cat string, Class int")
    model, encoded = encoding.TargetMeanEncoder(inputCols=["cat"], outputCols=["m"], foldKey=["n"]).fitTransform(df)
    assert encoded.where("cat IS NULL").agg(F.min("m")).first()[0] == 1.0
    assert model.transform(df).where("cat = 'x'").agg(F.max("m")).first()[0] == 0.0


def test_training_features_do_not_leak(spark):
    df = spark.range(500).select(F.col("id").alias("n"), F.col("id").cast("string").alias("cat"), (F.col("id") % 2).cast("int").alias("Class"))
    _, encoded = encoding.TargetMeanEncoder(inputCols=["cat"], outputCols=["m"], foldKey=["n"]).fitTransform(df)
    assert abs(encoded.select(F.corr("m", "Class")).first()[0]) < 0.2


@pytest.mark.parametrize("stages", [encoding.linear_preprocessing, encoding.tree_preprocessing])
def test_preprocessing_gives_no_nan(spark, flights, stages):
    prepared, features = encoding.CrossFitPipeline(stages=stages()).fitTransform(flights)
    assert features.count() == flights.count()
    for frame in (features, prepared.transform(records(spark, {}))):
        assert not any(np.isnan(r["features"].toArray()).any() for r in frame.select("features").collect())


def test_flight_number_never_reaches_the_vector(spark, flights):
    _, a = encoding.CrossFitPipeline(stages=encoding.tree_preprocessing()).fitTransform(flights)
    assert a.first()["features"].size == len(K.LOW_CARD_FEATURES) + len(K.HIGH_CARD_FEATURES) + len(encoding.SCALED)


@pytest.fixture(scope="module")
def split(flights):
    parts = stratified_split(flights, key=("Flight",)).cache()
    return {s: parts.where(F.col("split") == s).drop("split") for s in ("train", "val", "test")}


SMALL = {
    models.FOREST: {"n_estimators": 10, "max_depth": 5},
    models.BOOSTING: {"max_iter": 5, "max_leaf_nodes": 15},
}


@pytest.fixture(scope="module")
def candidates(split):
    return models.fit_candidates(split["train"], SMALL, fold_key=("Flight",))


def test_selection(candidates, split):
    best, results = models.select_model(candidates, split["val"])
    assert list(results) == [models.LOGISTIC, models.FOREST, models.BOOSTING]
    assert results[best]["roc_auc"] == max(r["roc_auc"] for r in results.values())
    assert all(r["roc_auc"] > 0.6 for r in results.values())
    for name, model in candidates.items():
        row = metrics.classification_metrics(models.predict_batch(model, split["val"])).first()
        assert results[name] == pytest.approx({"roc_auc": row["roc_auc"], "f1": row["f1"]})


def test_logistic_matches_its_objective(split):
    """The fit is a minimum of mean log loss plus |w|^2 / (2 C n)."""
    prepared, features = encoding.CrossFitPipeline(stages=encoding.linear_preprocessing(("Flight",))).fitTransform(split["train"])
    rows = features.select("features", "Class").collect()
    x, y = np.array([r["features"].toArray() for r in rows]), np.array([r["Class"] for r in rows])
    fitted = models.classifier(models.LOGISTIC, len(rows), C=0.01).fit(features)
    w, b = fitted.coefficients.toArray(), fitted.intercept
    loss = lambda w, b: np.mean(np.logaddexp(0, x @ w + b) - y * (x @ w + b)) + w @ w / (2 * 0.01 * len(y))
    p = 1 / (1 + np.exp(-(x @ w + b)))
    gradient = x.T @ (p - y) / len(y) + w / (0.01 * len(y))
    assert np.abs(gradient).max() < 0.01 and loss(w, b) < loss(np.zeros_like(w), b)


@pytest.mark.parametrize("name", list(models.DEFAULTS))
def test_scores_survive_saving(spark, candidates, split, name):
    path = new_folder(spark, "model")
    store.save_model(candidates[name], path)
    before = models.predict_batch(candidates[name], split["test"]).orderBy("Flight").collect()
    after = models.predict_batch(store.load_model(path), split["test"]).orderBy("Flight").collect()
    assert before == after
    for r in before:
        assert 0 <= r["probability_delayed"] <= 1
        assert r["predicted_class"] == int(r["probability_delayed"] >= 0.5)
        assert r["predicted_label"] == K.CLASS_LABELS[r["predicted_class"]]


@pytest.mark.parametrize("name", list(models.DEFAULTS))
def test_unseen_codes_score(spark, candidates, name):
    odd = records(spark, {"Airline": "??", "AirportFrom": "NEW", "AirportTo": "NEW"}, {})
    assert models.predict_batch(candidates[name], odd).where("probability_delayed BETWEEN 0 AND 1").count() == 2


def test_search_covers_the_small_grid(split):
    found = models.random_search(models.LOGISTIC, split["train"], key=("Flight",))
    assert sorted(p["C"] for p, _ in found) == sorted(models.GRIDS[models.LOGISTIC]["C"])
    assert [a for _, a in found] == sorted((a for _, a in found), reverse=True)


def test_draws_are_distinct_and_seeded():
    for name, most in ((models.LOGISTIC, 5), (models.FOREST, 20), (models.BOOSTING, 20)):
        points = models.draw_params(name)
        assert len(points) == len({str(p) for p in points}) == most
        assert points == models.draw_params(name) and set(points[0]) == set(models.GRIDS[name])


def test_importance(candidates, split):
    got = models.permutation_importance(candidates[models.BOOSTING], split["test"], key=("Flight",), repeats=2).collect()
    drops = {r["column"]: r["importance"] for r in got}
    assert set(drops) == set(K.DELAY_COLUMNS) - {"Class"}
    assert drops["Flight"] == pytest.approx(0.0, abs=1e-12)
    assert list(drops)[0] in ("Airline", "Time") and drops["Airline"] > 0.02
    assert list(drops.values()) == sorted(drops.values(), reverse=True)


def test_prediction_vs_actual(candidates, split):
    rows = models.prediction_vs_actual(candidates[models.LOGISTIC], split["test"], key=("Flight",)).collect()
    assert len(rows) == 5
    assert all(r["actual_label"] == K.CLASS_LABELS[r["actual_class"]] for r in rows)
    assert all(round(r["probability_delayed"], 3) == r["probability_delayed"] for r in rows)


def test_whole_training_run(spark, flights, monkeypatch):
    for name, small in {**SMALL, models.LOGISTIC: {"C": 1}}.items():
        monkeypatch.setitem(models.GRIDS, name, {k: [v] for k, v in small.items()})
    path, runs = new_folder(spark, "model"), new_folder(spark, "runs")
    models.train_delay_model(flights, path, runs, key=("Flight",), overrides=SMALL)
    first = store.read_runs(spark, runs).collect()
    again = {"dataset": 1, "train": 1, "val": 0, "test": 0}
    store.append_run(runs, spark, "x", {}, {}, {}, {}, again)
    assert len(first) == 1 and store.read_runs(spark, runs).count() == 2
    run = first[0]
    assert (run["dataset_rows"], run["train_rows"] + run["val_rows"], run["test_rows"]) == (3000, 2550, 450)
    assert [s["roc_auc"] for s in run["selection"]] == sorted((s["roc_auc"] for s in run["selection"]), reverse=True)
    assert run["selection"][0]["name"] == run["model_name"]
    assert set(run["raw_feature_schema"]) == set(K.FEATURE_COLUMNS) and run["class_labels"] == K.CLASS_LABELS
    assert datetime.strptime(run["model_version"], "%Y%m%d%H%M%S")
    found, importance = models.evaluate_saved(path, flights, key=("Flight",))
    assert found.first().asDict() == pytest.approx(run["test_metrics"])
    assert importance.count() == 7


def test_features_and_target(flights):
    assert "Class" not in profile.features_only(flights).columns
    assert profile.target_only(flights.limit(100)).count() == 100


def test_split_rates(spark, sf_dir):
    rows = profile.split_summary(stratified_split(view(spark, sf_dir, "flights"))).collect()
    assert all(r["size_ok"] and r["rate_ok"] for r in rows) and len(rows) == 3


def test_busiest_carriers_break_ties_by_name(spark):
    df = spark.createDataFrame([(f"A{i:02d}", i % 2) for i in range(20) for _ in range(3)], "Airline string, Class int")
    rows = profile.delay_rate_top_airlines(df).collect()
    assert sorted(r["airline"] for r in rows) == [f"A{i:02d}" for i in range(12)]
    assert [r["delay_rate"] for r in rows] == sorted((r["delay_rate"] for r in rows), reverse=True)


@pytest.mark.parametrize("name", ["permutation_importance", "predict_batch", "evaluate_saved", "prediction_vs_actual", "gold_scores"])
def test_queries_score_by_a_model_fitted_to_the_training_part(spark, sf_dir, monkeypatch, name):
    fitted = []

    def fit(train):
        fitted.append(train.count())
        return queries.stated_model()

    monkeypatch.setattr(queries, "logistic", fit)
    rows = getattr(queries, name)(spark, sf_dir)
    assert {"p_ok", "in_range"} & set(rows.columns)
    n = view(spark, sf_dir, "flights").count()
    assert len(fitted) == 1 and 0.69 * n < fitted[0] < 0.71 * n


def test_models_share_the_shuffled_rows(candidates, split):
    """Importances of two models at once are those of each alone."""
    some = {n: candidates[n] for n in (models.LOGISTIC, models.BOOSTING)}
    found = models.permutation_importances(some, split["test"], key=("Flight",), repeats=2).collect()
    for n, model in some.items():
        alone = models.permutation_importance(model, split["test"], key=("Flight",), repeats=2).collect()
        assert {r["column"]: r["importance"] for r in found if r["model"] == n} == pytest.approx({r["column"]: r["importance"] for r in alone})


def test_models_are_measured_in_one_pass(spark, monkeypatch):
    """Several models share one ranking, and get the metrics that each gets alone."""
    rows = spark.range(60).selectExpr("id AS Flight", "id % 7 AS DayOfWeek", "CAST(id * 11 % 31 AS double) AS Time", "CAST(id % 5 AS double) AS Length", "'a' AS Airline", "'b' AS AirportFrom", "'c' AS AirportTo", "CAST(id % 3 = 0 AS int) AS Class")
    saved = {"one": models.FixedLogistic(columns=["Time"], weights=[0.2], intercept=-3.0), "two": models.FixedLogistic(columns=["Length"], weights=[-0.5], intercept=1.0)}
    alone = {n: metrics.classification_metrics(models.predict_batch(m, rows)).first().asDict() for n, m in saved.items()}
    calls, measure = [], metrics.classification_metrics
    monkeypatch.setattr(metrics, "classification_metrics", lambda *a, **k: calls.append(k) or measure(*a, **k))
    found = models.measured_by(saved, rows)
    assert len(calls) == 1
    for n, values in alone.items():
        assert {c: round(found[n][c], 12) for c in values} == {c: round(v, 12) for c, v in values.items()}
    nothing = models.measured_by(saved, rows.where("Flight < 0"))
    assert nothing["two"]["roc_auc"] is None and nothing["two"]["precision"] == 0


def test_candidates_are_fitted_side_by_side(monkeypatch):
    """Each fit waits until all have begun, and the candidates keep their order."""
    begun = threading.Barrier(len(models.DEFAULTS), timeout=20)
    monkeypatch.setattr(models, "fit", lambda name, *_, **params: (begun.wait() >= 0, name, params))
    found = models.fit_candidates(None, {models.FOREST: {"n_estimators": 3}})
    assert list(found) == list(models.DEFAULTS)
    assert [f[1] for f in found.values()] == list(found) and found[models.FOREST][2] == {"n_estimators": 3}

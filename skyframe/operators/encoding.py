"""Feature engineering and encoders, as ``pyspark.ml`` stages that are relational inside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasLabelCol, HasOutputCols
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyframe import constants as K
from skyframe.functions.columns import day_bucket, is_weekend
from skyframe.functions.ordering import numbered
from skyframe.operators.split import content_md5
from skyframe.session import materialise

FOLDS = 5


def engineer_features(df: DataFrame, time: str = "Time", day: str = "DayOfWeek") -> DataFrame:
    return df.withColumn("IsWeekend", is_weekend(day)).withColumn("TimeOfDayBucket", day_bucket(time))


class FeatureEngineer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """``engineer_features`` as the first stage of a pipeline."""

    def _transform(self, df: DataFrame) -> DataFrame:
        return engineer_features(df)


class _Columns(HasInputCols, HasOutputCols):
    def _pairs(self) -> list[tuple[str, str]]:
        return list(zip(self.getInputCols(), self.getOutputCols()))


class PopulationScaler(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Centre each column and divide by its population standard deviation (1 where it is 0)."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> PopulationScalerModel:
        cols = self.getInputCols()
        row = df.agg(*[F.avg(c) for c in cols], *[F.stddev_pop(c) for c in cols]).first()
        means, stds = list(row[: len(cols)]), [s or 1.0 for s in row[len(cols) :]]
        model = PopulationScalerModel()
        return model._set(inputCols=cols, outputCols=self.getOutputCols(), means=means, stds=stds)


class PopulationScalerModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    means = Param(Params._dummy(), "means", "column means", TypeConverters.toListFloat)
    stds = Param(Params._dummy(), "stds", "population standard deviations", TypeConverters.toListFloat)

    def _transform(self, df: DataFrame) -> DataFrame:
        fitted = zip(self._pairs(), self.getOrDefault("means"), self.getOrDefault("stds"))
        return df.withColumns({o: (F.col(i) - m) / s for (i, o), m, s in fitted})


class OrdinalEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Position of each value among the sorted categories seen in fitting; -1 for any other."""

    @keyword_only
    def __init__(self, *, inputCols: Sequence[str] | None = None, outputCols: Sequence[str] | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> OrdinalEncoderModel:
        cols = self.getInputCols()
        seen = (
            df.select(*[F.col(c).cast("string").alias(c) for c in cols])
            .unpivot([], cols, "column", "category")
            .where(F.col("category").isNotNull())
            .distinct()
        )
        codes = numbered(seen, ["category"], "_code", ["column"])
        model = OrdinalEncoderModel()._set(inputCols=cols, outputCols=self.getOutputCols(), overall=-1.0)
        model.table = materialise(codes.select("column", "category", (F.col("_code") - 1.0).alias("encoding")), "category-codes")
        return model


def fold_of(columns: Sequence[str], seed: int = K.SEED, folds: int = FOLDS, key: Sequence[str] = ()) -> Column:
    """Fold number from the row's content: the same on every run and every retry."""
    return (F.conv(F.substring(content_md5(columns, seed, key), 1, 8), 16, 10).cast("long") % folds).cast("int")


def smoothed_mean(n: Column, s: Column, all_n: Column, all_s: Column) -> Column:
    """Category mean of a 0/1 target pulled toward the overall mean, more so the fewer and noisier its rows."""
    overall = F.try_divide(all_s, all_n)
    mean = F.try_divide(s, n)
    signal = n * overall * (1 - overall)
    weight = F.coalesce(F.try_divide(signal, signal + mean * (1 - mean)), F.lit(0.0))
    return F.coalesce(weight * mean + (1 - weight) * overall, overall)


class TargetMeanEncoder(Estimator, _Columns, HasLabelCol, DefaultParamsReadable, DefaultParamsWritable):
    """Smoothed target mean per category.

    ``fitTransform`` encodes the fitted rows out of fold, each with the other folds'
    rows only, so a row's own target never reaches its feature. The fitted model uses
    all rows, and the overall mean for a category it has not seen.
    """

    seed = Param(Params._dummy(), "seed", "fold seed", TypeConverters.toInt)
    foldKey = Param(Params._dummy(), "foldKey", "columns that decide a row's fold (default: all)", TypeConverters.toListString)

    @keyword_only
    def __init__(
        self,
        *,
        inputCols: Sequence[str] | None = None,
        outputCols: Sequence[str] | None = None,
        labelCol: str = K.TARGET,
        seed: int = K.SEED,
        foldKey: Sequence[str] = (),
    ):
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(seed=K.SEED, foldKey=[], labelCol=K.TARGET)

    def _counts(self, df: DataFrame) -> DataFrame:
        """(column, category, fold) with rows and delayed rows; merged per task before the shuffle."""
        cols = self.getInputCols()
        narrow = df.select(
            self._fold(df).alias("fold"),
            F.col(self.getLabelCol()).cast("long").alias("y"),
            *[F.col(c).cast("string").alias(c) for c in cols],
        )
        counts = (
            narrow.unpivot(["fold", "y"], cols, "column", "category")
            .groupBy("column", "category", "fold")
            .agg(F.count("*").alias("n"), F.sum("y").alias("s"))
        )
        return materialise(counts, "target-counts")

    def _fold(self, df: DataFrame) -> Column:
        return fold_of(df.columns, self.getOrDefault("seed"), FOLDS, self.getOrDefault("foldKey"))

    def _model(self, counts: DataFrame) -> TargetMeanEncoderModel:
        totals = counts.groupBy("column").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
        table = (
            counts.groupBy("column", "category")
            .agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
            .join(totals, "column")
            .select("column", "category", smoothed_mean(F.col("n"), F.col("s"), F.col("all_n"), F.col("all_s")).alias("encoding"))
        )
        n, s = totals.select("all_n", "all_s").first()
        model = TargetMeanEncoderModel()._set(
            inputCols=self.getInputCols(), outputCols=self.getOutputCols(), overall=s / n
        )
        model.table = materialise(table, "target-means")
        return model

    def _fit(self, df: DataFrame) -> TargetMeanEncoderModel:
        return self._model(self._counts(df))

    def fitTransform(self, df: DataFrame) -> tuple[TargetMeanEncoderModel, DataFrame]:
        counts = self._counts(df)
        per_category = counts.groupBy("column", "category").agg(F.sum("n").alias("cn"), F.sum("s").alias("cs"))
        per_fold = counts.groupBy("column", "fold").agg(F.sum("n").alias("fn"), F.sum("s").alias("fs"))
        totals = counts.groupBy("column").agg(F.sum("n").alias("all_n"), F.sum("s").alias("all_s"))
        others = smoothed_mean(
            F.col("cn") - F.col("n"),
            F.col("cs") - F.col("s"),
            F.col("all_n") - F.col("fn"),
            F.col("all_s") - F.col("fs"),
       
        )
        c = counts.withColumn("category", F.coalesce("category", F.lit("\0")))
        pc = per_category.withColumn("category", F.coalesce("category", F.lit("\0")))
        table = (
            c.join(pc, ["column", "category"])
            .join(per_fold, ["column", "fold"])
            .join(totals, "column")
            .select("column", F.nullif("category", F.lit("\0")).alias("category"), "fold", others.alias("encoding"))
        )
        table = materialise(table, "target-means-oof")
        out = _encode(df.withColumn("_fold", self._fold(df)), self._pairs(), table, None, ["_fold"])
        return self._model(counts), out.drop("_fold")


def _encode(
    df: DataFrame, pairs: Sequence[tuple[str, str]], table: DataFrame, overall: float | None, extra: Sequence[str] = ()
) -> DataFrame:
    """Look each category up; Spark broadcasts the table when its files are small enough."""
    for source, out in pairs:
        mine = table.where(F.col("column") == source).select(
            F.coalesce("category", F.lit("\0")).alias("_category"),
            *[F.col(e.lstrip("_")).alias(e) for e in extra],
            F.col("encoding").alias(out),
        )
        df = df.withColumn("_category", F.coalesce(F.col(source).cast("string"), F.lit("\0")))
        df = df.join(mine, ["_category", *extra], "left").drop("_category")
        if overall is not None:
            df = df.withColumn(out, F.coalesce(out, F.lit(overall)))
    return df


class _TableModel(Model, _Columns, MLWritable, MLReadable):
    """A model that is a table of (column, category, encoding); the driver never holds the categories."""

    overall = Param(Params._dummy(), "overall", "encoding of an unseen category", TypeConverters.toFloat)
    table: DataFrame

    def _transform(self, df: DataFrame) -> DataFrame:
        columns = df.columns
        encoded = _encode(df, self._pairs(), self.table, self.getOrDefault("overall"))
        return encoded.select(*columns, *self.getOutputCols())

    def copy(self, extra=None):
        that = super().copy(extra)
        that.table = self.table
        return that

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class TargetMeanEncoderModel(_TableModel):
    """Smoothed means per category; the overall mean for an unseen one."""


class OrdinalEncoderModel(_TableModel):
    """Positions among the sorted categories; -1 for an unseen or missing one."""


class _TableWriter(MLWriter):
    def __init__(self, instance: _TableModel):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> _TableModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        model.table = self.sparkSession.read.parquet(f"{path}/table")
        return model


class CrossFitPipeline(Pipeline):
    """A Pipeline whose cross-fitting stages encode the training rows out of fold.

    ``fit`` expects a classifier as the last stage; ``fitTransform`` takes any stages.
    """

    def fitTransform(self, df: DataFrame) -> tuple[PipelineModel, DataFrame]:
        fitted = []
        for stage in self.getStages():
            if hasattr(stage, "fitTransform"):
                stage, df = stage.fitTransform(df)
            else:
                if isinstance(stage, Estimator):
                    stage = stage.fit(df)
                df = stage.transform(df)
            fitted.append(stage)
        return PipelineModel(fitted), df

    def _fit(self, df: DataFrame) -> PipelineModel:
        *head, last = self.getStages()
        prepared, df = CrossFitPipeline(stages=head).fitTransform(df)
        # The classifier reads its two columns many times; they are prepared once.
        used = df.select(last.getFeaturesCol(), last.getLabelCol()).persist()
        try:
            last = last.fit(used)
        finally:
            used.unpersist()
        return PipelineModel([*prepared.stages, last])


def one_hot_stages(columns: Sequence[str] = tuple(K.LOW_CARD_FEATURES)) -> list:
    """Sorted one-hot slots; a value not seen in fitting has none set."""
    index = [f"{c}_index" for c in columns]
    return [
        StringIndexer(
            inputCols=list(columns), outputCols=index, stringOrderType="alphabetAsc", handleInvalid="keep"
        ),
        OneHotEncoder(inputCols=index, outputCols=[f"{c}_onehot" for c in columns], dropLast=True),
    ]


SCALED = [*K.NUMERIC_FEATURES, "IsWeekend"]


def linear_preprocessing(fold_key: Sequence[str] = ()) -> list:
    """One-hot, cross-fitted target means and scaled numbers for the linear model.

    The target means come last: their look-ups are then not repeated while the other
    stages are fitted. Without a key, a row's folds follow from its features and target.
    """
    onehot = [f"{c}_onehot" for c in K.LOW_CARD_FEATURES]
    means = [f"{c}_mean" for c in K.HIGH_CARD_FEATURES]
    scaled = [f"{c}_scaled" for c in SCALED]
    folds = list(fold_key) or [*K.FEATURE_COLUMNS, K.TARGET]
    return [
        FeatureEngineer(),
        *one_hot_stages(),
        PopulationScaler(inputCols=SCALED, outputCols=scaled),
        TargetMeanEncoder(inputCols=K.HIGH_CARD_FEATURES, outputCols=means, foldKey=folds),
        VectorAssembler(inputCols=[*onehot, *means, *scaled], outputCol="features"),
    ]


def tree_preprocessing(native: Sequence[str] = tuple(K.LOW_CARD_FEATURES)) -> list:
    """Category codes for trees.

    ``native`` columns keep their category metadata, with a category of their own for
    unseen values; the others become plain numbers with -1 for unseen. Columns that
    are not listed (Flight) never reach the vector.
    """
    categories = [*K.LOW_CARD_FEATURES, *K.HIGH_CARD_FEATURES]
    plain = [c for c in categories if c not in native]
    stages: list = [FeatureEngineer()]
    if native:
        stages.append(one_hot_stages(native)[0])
    if plain:
        stages.append(OrdinalEncoder(inputCols=plain, outputCols=[f"{c}_code" for c in plain]))
    inputs = [f"{c}_index" if c in native else f"{c}_code" for c in categories]
    return [*stages, VectorAssembler(inputCols=[*inputs, *SCALED], outputCol="features")]

"""Training job operators on Spark ML.

``ResampledClassifier`` is an ``Estimator`` whose ``fit`` standardises the
features (population std, fitted on the rows it is given), balances the
classes with SMOTE and fits gradient-boosted trees; its model applies only
the scaler and the trees.  Given to ``CrossValidator`` it reproduces the
reference's resample-inside-each-fold search: every fold resamples its own
training part only.  The grid parameters are the estimator's own params,
so ``CrossValidator`` / ``ParamGridBuilder`` set them through the standard
``copy(extra)`` path.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.base import _FitMultipleIterator
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators.metrics import roc_auc
from ledgerflow.operators.sampling import fold_column, scaler_stats
from ledgerflow.operators.smote import smote_balance
from ledgerflow.sources.scratch import reliable_checkpoint
from ledgerflow.specs import CV_FOLDS, PARAM_GRID, SEED, SMOTE_NEIGHBOURS, TOP_FEATURES


TREE_PARAMS = ("maxIter", "maxDepth", "stepSize", "subsamplingRate")


class _GbtParams(Params):
    featureCols = Param(Params._dummy(), "featureCols", "input feature columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    idCol = Param(Params._dummy(), "idCol", "row key column (SMOTE seeds)", TypeConverters.toString)
    maxIter = Param(Params._dummy(), "maxIter", "number of trees", TypeConverters.toInt)
    maxDepth = Param(Params._dummy(), "maxDepth", "tree depth", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "learning rate", TypeConverters.toFloat)
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "row fraction per tree", TypeConverters.toFloat)
    neighbours = Param(Params._dummy(), "neighbours", "SMOTE neighbours", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "random seed", TypeConverters.toInt)
    resample = Param(Params._dummy(), "resample", "apply SMOTE when fitting", TypeConverters.toBoolean)


class ResampledClassifier(Estimator, _GbtParams, DefaultParamsReadable, DefaultParamsWritable):
    """scale -> SMOTE -> gradient-boosted trees, as one estimator."""

    @keyword_only
    def __init__(self, *, featureCols=None, labelCol="label", idCol="id", maxIter=100, maxDepth=3,
                 stepSize=0.05, subsamplingRate=0.8, neighbours=SMOTE_NEIGHBOURS, seed=SEED, resample=True):
        super().__init__()
        self._setDefault(labelCol="label", idCol="id", maxIter=100, maxDepth=3, stepSize=0.05,
                         subsamplingRate=0.8, neighbours=SMOTE_NEIGHBOURS, seed=SEED, resample=True)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "ResampledModel":
        return self._fit_trees(*self._prepare(dataset))

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        """Points that differ in the trees only (as a fold's grid does) share one
        scaled and resampled copy of their rows."""
        if any(p.name not in TREE_PARAMS for point in paramMaps for p in point):
            return super().fitMultiple(dataset, paramMaps)
        estimator = self.copy()
        prepared = estimator._prepare(dataset)
        return _FitMultipleIterator(lambda i: estimator.copy(paramMaps[i])._fit_trees(*prepared), len(paramMaps))

    def _prepare(self, dataset: DataFrame, keep=reliable_checkpoint) -> tuple[DataFrame, list, list]:
        cols = self.getOrDefault(self.featureCols)
        label, idc, seed = self.getOrDefault(self.labelCol), self.getOrDefault(self.idCol), self.getOrDefault(self.seed)
        st = scaler_stats(dataset, cols).first()  # one row: 2 numbers per feature
        means = [st[f"{c}_mean"] for c in cols]
        stds = [st[f"{c}_std"] for c in cols]
        scaled = _scale(dataset, cols, means, stds)
        if self.getOrDefault(self.resample):
            scaled = smote_balance(scaled, cols, label=label, id_col=idc, k=self.getOrDefault(self.neighbours),
                                   seed=seed)
        assembled = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(scaled)
        # the trees pass over their rows many times: resample once
        return keep(assembled.select(label, "features")), means, stds

    def _fit_trees(self, assembled: DataFrame, means: list, stds: list) -> "ResampledModel":
        label, seed = self.getOrDefault(self.labelCol), self.getOrDefault(self.seed)
        gbt = GBTClassifier(labelCol=label, featuresCol="features", lossType="logistic", seed=seed, cacheNodeIds=True,
                            maxIter=self.getOrDefault(self.maxIter), maxDepth=self.getOrDefault(self.maxDepth),
                            stepSize=self.getOrDefault(self.stepSize),
                            subsamplingRate=self.getOrDefault(self.subsamplingRate))
        trees = gbt.fit(assembled)
        return self._copyValues(ResampledModel(trees=trees, means=means, stds=stds))


class ResampledModel(Model, _GbtParams):
    """Applies the training scaler and the trees; adds ``probability``,
    ``prediction`` and ``p_positive``."""

    def __init__(self, trees: GBTClassificationModel | None = None, means=None, stds=None):
        super().__init__()
        self.trees, self.means, self.stds = trees, list(means or []), list(stds or [])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        cols = self.getOrDefault(self.featureCols)
        scaled = _scale(dataset, cols, self.means, self.stds)
        assembled = VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(scaled)
        out = self.trees.transform(assembled)
        return out.withColumn("p_positive", vector_to_array("probability")[1])

    def copy(self, extra=None):
        that = super().copy(extra)
        that.trees, that.means, that.stds = self.trees, list(self.means), list(self.stds)
        return that


def save_resampled(model: ResampledModel, path: str) -> None:
    """Write everything that scoring raw rows needs: trees, and the scaler as one
    row a feature."""
    model.trees.write().overwrite().save(f"{path}/trees")
    cols = model.getOrDefault(model.featureCols)
    scaler = _scaler_rows(SparkSession.active(), cols, model.means, model.stds)
    scaler.coalesce(1).write.mode("overwrite").parquet(f"{path}/scaler")


def _scaler_rows(spark: SparkSession, cols: Sequence[str], means: Sequence, stds: Sequence) -> DataFrame:
    rows = [(i, c, m, s) for i, (c, m, s) in enumerate(zip(cols, means, stds))]
    return spark.createDataFrame(rows, "position int, feature string, mean double, std double")


def load_resampled(spark: SparkSession, path: str) -> ResampledModel:
    rows = spark.read.parquet(f"{path}/scaler").orderBy("position").collect()  # one row a feature
    model = ResampledModel(GBTClassificationModel.load(f"{path}/trees"), [r["mean"] for r in rows], [r["std"] for r in rows])
    return model._set(featureCols=[r["feature"] for r in rows])


def _scale(df: DataFrame, cols: Sequence[str], means, stds) -> DataFrame:
    out = {}
    for c, m, s in zip(cols, means, stds):
        scale = 1.0 if s in (None, 0) else s
        out[c] = (F.col(c).cast("double") - F.lit(m if m is not None else 0.0)) / F.lit(scale)
    return df.withColumns(out)


def param_grid(est: ResampledClassifier, grid: dict | None = None):
    grid = grid or PARAM_GRID
    b = ParamGridBuilder()
    for name, values in grid.items():
        b = b.addGrid(est.getParam(name), values)
    return b.build()


def grid_search(train: DataFrame, features: Sequence[str], grid: dict | None = None, folds: int = CV_FOLDS,
                parallelism: int = 4, seed: int = SEED, label: str = "label", id_col: str = "id"):
    """K-fold cross-validated grid search by ROC-AUC; the best point is
    refit on all training rows.  Folds are stratified by class."""
    est = ResampledClassifier(featureCols=list(features), labelCol=label, idCol=id_col, seed=seed)
    evaluator = BinaryClassificationEvaluator(labelCol=label, rawPredictionCol="rawPrediction",
                                              metricName="areaUnderROC")
    cv = CrossValidator(estimator=est, estimatorParamMaps=param_grid(est, grid), evaluator=evaluator,
                        numFolds=folds, foldCol="fold", parallelism=parallelism, seed=seed)
    return cv.fit(reliable_checkpoint(fold_column(train, id_col, folds, seed, label=label)))


def _held(spark: SparkSession, path: str) -> bool:
    """Whether a staged table was written to its end."""
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    return mark.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(mark)


def _once(spark: SparkSession, path: str, make) -> DataFrame:
    """The table at ``path``, written by ``make()`` unless an earlier run has done so."""
    if not _held(spark, path):
        make().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def grid_search_folds(train: DataFrame, features: Sequence[str], base: str, grid: dict | None = None, folds: int = CV_FOLDS,
                      parallelism: int = 4, seed: int = SEED, label: str = "label", id_col: str = "id",
                      resample: bool = True) -> DataFrame:
    """The grid search step by step: ``point, <tree parameters>, fold, n_pos, n_neg,
    n_fitted, roc_auc``, one row a point and fold.

    Under ``base``: the rows with their fold, each fold's scaled and resampled
    rows with its scaler, and the scores of each point on the fold left out.  A step
    whose table is complete is not done again, so a search that was interrupted
    (or gets more points) goes on where it stood; all AUCs come from the staged
    scores in one job.
    """
    spark = train.sparkSession
    est = ResampledClassifier(featureCols=list(features), labelCol=label, idCol=id_col, seed=seed, resample=resample)
    points = param_grid(est, grid)
    rows = _once(spark, f"{base}/rows", lambda: fold_column(train, id_col, folds, seed, label=label))
    fitted = []
    for i in range(folds):
        scaler = f"{base}/scaler/fold={i}"

        def prepare(i=i, scaler=scaler) -> DataFrame:
            assembled, means, stds = est._prepare(rows.filter(F.col("fold") != i), keep=lambda df: df)
            _scaler_rows(spark, features, means, stds).coalesce(1).write.mode("overwrite").parquet(scaler)
            return assembled

        assembled = _once(spark, f"{base}/resampled/fold={i}", prepare)
        stats = spark.read.parquet(scaler).orderBy("position").collect()  # one row a feature
        left_out = rows.filter(F.col("fold") == i)

        def score(j: int, assembled=assembled, stats=stats, left_out=left_out, i=i) -> None:
            path = f"{base}/scores/point={j}/fold={i}"
            if not _held(spark, path):
                model = est.copy(points[j])._fit_trees(assembled, [r["mean"] for r in stats], [r["std"] for r in stats])
                predict(model, left_out, keep=(id_col, label)).write.mode("overwrite").parquet(path)

        with ThreadPoolExecutor(max_workers=parallelism) as pool:
            list(pool.map(score, range(len(points))))
        fitted.append((i, assembled.count()))
    paths = [f"{base}/scores/point={j}/fold={i}" for j in range(len(points)) for i in range(folds)]
    scores = spark.read.option("basePath", f"{base}/scores").parquet(*paths)
    auc = roc_auc(scores, label, "score", by=["point", "fold"])
    told = spark.createDataFrame([(j, *[est.copy(p).getOrDefault(n) for n in TREE_PARAMS]) for j, p in enumerate(points)],
                                 "point int, maxIter int, maxDepth int, stepSize double, subsamplingRate double")
    sizes = spark.createDataFrame(fitted, "fold int, n_fitted bigint")
    return auc.join(F.broadcast(told), "point").join(F.broadcast(sizes), "fold").select(
        "point", *TREE_PARAMS, "fold", "n_pos", "n_neg", "n_fitted", "roc_auc")


def best_params(cv_model) -> dict:
    best = cv_model.bestModel
    return {p: best.getOrDefault(best.getParam(p)) for p in TREE_PARAMS}


def predict(model, df: DataFrame, keep: Sequence[str] = ("id", "label")) -> DataFrame:
    """Class (threshold 0.5) and positive-class probability."""
    out = model.transform(df)
    return out.select(*keep, F.col("prediction").cast("int").alias("prediction"),
                      F.col("p_positive").alias("score"))


def top_importances(model, features: Sequence[str], spark: SparkSession, k: int = TOP_FEATURES) -> DataFrame:
    """Top-k features by the trees' normalised impurity gain."""
    trees = model.trees if isinstance(model, ResampledModel) else model
    imp = trees.featureImportances.toArray().tolist()  # one value per feature
    df = spark.createDataFrame(list(zip(features, [float(x) for x in imp])), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(k)


def new_run_id() -> str:
    return uuid.uuid4().hex

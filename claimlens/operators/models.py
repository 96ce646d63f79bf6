"""Regression models on Spark.

* decision tree and linear regression are Spark ML estimators (distributed
  histogram / normal-equation fits);
* the incremental linear update (M4) is a gradient step written as one
  Catalyst aggregate over all coefficients;
* exact k-nearest neighbours (M5): ``operators.neighbours``.
"""

from __future__ import annotations

import datetime as _dt
import warnings
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.errors import AnalysisException
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators.neighbours import knn_predict
from claimlens.session import freed_shuffles, packed, together
from claimlens.settings import DEFAULTS, Settings

LEAKY = ("claim_ratio", "is_claim")


# ---- M1 --------------------------------------------------------------------------
def feature_columns(prepared_cols: list[str], exclude_leaky: bool = True) -> list[str]:
    """All prepared features; ``claim_ratio``/``is_claim`` are derived from the
    target and left out unless ``exclude_leaky=False`` (reference parity)."""
    return [c for c in prepared_cols if not (exclude_leaky and c in LEAKY)]


def assemble(df: DataFrame, cols: list[str], out: str = "features") -> DataFrame:
    """M1: feature vector; NULLs are an error (imputation ran before)."""
    return VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="error").transform(df)


# ---- M2, M3 ----------------------------------------------------------------------
def fit_tree(train: DataFrame, cols: list[str], settings: Settings = DEFAULTS, label: str | None = None):
    """M2: regression tree, depth <= 10, seed 42 (binned splits). The fit reads the rows three
    times (splits, metadata, bins) and itself keeps their bins, a byte or few a feature: keeping
    the assembled doubles as well would only take memory and disk."""
    label = label or settings.target
    est = DecisionTreeRegressor(featuresCol="features", labelCol=label, maxDepth=settings.tree_max_depth,
                                seed=settings.seed)
    return est.fit(assemble(train, cols).select("features", label))


@dataclass
class LinearModel:
    """Coefficients by column and the bias: d + 1 numbers, scored as one expression.
    Exact fits (M3) and gradient steps (M4) give the same kind of model."""

    weights: dict[str, float]
    bias: float

    def prediction(self):
        p = F.lit(float(self.bias))
        for c, w in self.weights.items():
            p = p + F.lit(float(w)) * F.col(c)
        return p

    def save(self, spark, path: str) -> None:
        rows = [(k, float(v)) for k, v in {**self.weights, BIAS: self.bias}.items()]
        spark.createDataFrame(rows, "term string, weight double").coalesce(1).write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark, path: str) -> LinearModel:
        w = {r["term"]: r["weight"] for r in spark.read.parquet(path).collect()}
        return cls({k: v for k, v in w.items() if k != BIAS}, w[BIAS])


BIAS = "__bias__"
L2 = 1e-4


def fit_linear(train: DataFrame, cols: list[str], settings: Settings = DEFAULTS, label: str | None = None) -> LinearModel:
    """M3: squared loss with a small L2 penalty (the SGD objective), solved
    exactly: normal equations for few features (one distributed pass, so nothing is kept for it)."""
    label = label or settings.target
    est = LinearRegression(featuresCol="features", labelCol=label, maxIter=settings.sgd_max_iter,
                           regParam=L2, elasticNetParam=0.0, standardization=False)
    m = est.fit(assemble(train, cols).select("features", label))
    return LinearModel(dict(zip(cols, map(float, m.coefficients), strict=True)), float(m.intercept))


# ---- M4 --------------------------------------------------------------------------
def gradient_step(train: DataFrame, cols: list[str], weights: dict, bias: float, lr: float = 0.01,
                  alpha: float = 1e-4, label: str = "CLAIM_PAID") -> DataFrame:
    """M4: one full-batch gradient step of the L2-penalised squared loss from
    ``weights``/``bias``; every partial derivative is one aggregate of the
    same pass. Returns ``term, weight`` (bias as term ``__bias__``)."""
    pred = F.lit(float(bias))
    for c in cols:
        pred = pred + F.lit(float(weights[c])) * F.col(c)
    resid = pred - F.col(label)
    g = train.agg(F.avg(resid).alias("_gb"), *[F.avg(resid * F.col(c)).alias(f"_g{i}") for i, c in enumerate(cols)])
    items = [F.struct(F.lit("__bias__").alias("term"), (F.lit(float(bias)) - lr * F.col("_gb")).alias("weight"))]
    items += [F.struct(F.lit(c).alias("term"),
                       (F.lit(float(weights[c])) - lr * (F.col(f"_g{i}") + alpha * F.lit(float(weights[c])))).alias("weight"))
              for i, c in enumerate(cols)]
    return g.select(F.inline(F.array(*items)))


def partial_fit(model: LinearModel, train: DataFrame, cols: list[str], lr: float = 0.01,
                alpha: float = L2, label: str = "CLAIM_PAID") -> LinearModel:
    """Continue a saved linear model with one pass over new rows (retrain)."""
    rows = gradient_step(train, cols, model.weights, model.bias, lr, alpha, label).collect()
    d = {r["term"]: r["weight"] for r in rows}
    b = d.pop(BIAS)
    return LinearModel(d, b)


# ---- A19, O5, O6 -----------------------------------------------------------------
def regression_metrics(pred: DataFrame, label: str = "y", prediction: str = "prediction",
                       keys=("model",)) -> DataFrame:
    """MAE, RMSE, R^2 per ``keys`` in one pass, rounded half-even to 4."""
    e = F.col(prediction) - F.col(label)
    g = pred.groupBy(*keys).agg(F.avg(F.abs(e)).alias("_mae"), F.avg(e * e).alias("_mse"),
                                F.sum(e * e).alias("_sse"), F.var_pop(label).alias("_var"),
                                F.count(F.lit(1)).alias("_n"))
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse"), F.col("_var") * F.col("_n"))
    return g.select(*keys, F.bround("_mae", 4).alias("MAE"), F.bround(F.sqrt("_mse"), 4).alias("RMSE"),
                    F.bround(r2, 4).alias("R2"))


def select_best(metrics: DataFrame, name: str = "model") -> DataFrame:
    """Smallest MAE; ties -> first name in sort order (one row)."""
    return metrics.agg(F.min_by(F.struct(name, "MAE"), F.struct("MAE", name)).alias("_b")).select("_b.*")


def latest_versions(registry: DataFrame) -> DataFrame:
    """Newest version per (name, variant)."""
    return (registry.groupBy("name", "variant")
                    .agg(F.max_by("path", "version").alias("path"), F.max("version").alias("version")))


# ---- M6-M9 -----------------------------------------------------------------------
KINDS = ("decision_tree", "sgd", "knn")
#: ``prepared``: the folder of the tables and fitted parameters that a model was trained with.
REGISTRY = "name string, variant string, version string, path string, split_idx long, prepared string"


@dataclass
class Trained:
    name: str
    variant: str
    version: str
    path: str
    split_idx: int
    model: object = None
    prepared: str | None = None


def version_stamp() -> str:
    return _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")


def predictions(kind: str, model, data: DataFrame, cols: list[str], settings: Settings = DEFAULTS) -> DataFrame:
    """``data`` with a ``prediction`` column. Tree and linear models are projections
    of the row; the neighbour model is its stored training table, joined on ``row_index``."""
    if kind == "sgd":
        return data.withColumn("prediction", model.prediction())
    if kind == "decision_tree":
        keep = data.columns
        return model.transform(assemble(data, cols)).select(*keep, "prediction")
    vec = F.array(*[F.col(c) for c in cols])
    near = knn_predict(model.select(F.col("row_index").alias("id"), vec.alias("vec"), F.col(settings.target).alias("label")),
                       data.select(F.col("row_index").alias("qid"), vec.alias("vec")), settings.knn_neighbours)
    return data.join(near.select(F.col("qid").alias("row_index"), "prediction"), "row_index", "left")


def fit_model(kind: str, train: DataFrame, cols: list[str], path: str, settings: Settings = DEFAULTS,
              previous: LinearModel | None = None):
    """Fit one of the three kinds and save it below ``path``; a linear model goes on
    from ``previous`` where one is given."""
    spark = train.sparkSession
    if kind == "decision_tree":
        m = fit_tree(train, cols, settings)
        m.write().overwrite().save(path)
    elif kind == "sgd":
        m = fit_linear(train, cols, settings) if previous is None else partial_fit(previous, train, cols, label=settings.target)
        m.save(spark, path)
    else:       # the neighbour model is the training table itself, all rows
        with freed_shuffles(spark), packed(spark):
            train.select("row_index", *cols, settings.target).write.mode("overwrite").parquet(path)
        m = spark.read.parquet(path)
    return m


def load_model(kind: str, path: str, spark):
    if kind == "decision_tree":
        return DecisionTreeRegressionModel.load(path)
    return LinearModel.load(spark, path) if kind == "sgd" else spark.read.parquet(path)


def train_all(prepared_a: DataFrame, prepared_b: DataFrame, feature_cols: list[str], models_dir: str,
              settings: Settings = DEFAULTS, kinds=KINDS, version: str | None = None, prepared: str | None = None) -> list[Trained]:
    """M6: three models x two scalings on the time-ordered first 80 %; every saved
    model is registered below ``models_dir``, with the folder ``prepared`` that holds what it was trained with.
    The scalings are trained side by side."""
    from claimlens.operators.positions import temporal_split
    version, spark = version or version_stamp(), prepared_a.sparkSession

    def trained(variant, table):
        split = temporal_split(table, settings.train_split)
        first = split.select("split_idx").first()
        train, out = split.where("is_train"), []
        for kind in kinds:
            path = model_path(models_dir, kind, variant, version)
            m = fit_model(kind, train, feature_cols, path, settings)
            out.append(Trained(kind, variant, version, path, first[0] if first else 0, m, prepared))
        return out
    out = sum(together(spark, [partial(trained, "A", prepared_a), partial(trained, "B", prepared_b)]), [])
    register(spark, out, models_dir)
    return out


def model_path(models_dir: str, kind: str, variant: str, version: str) -> str:
    """All that belongs to a version lies in a folder of its own."""
    return f"{models_dir}/{version}/{kind}_{variant}"


def register(spark, trained: list[Trained], models_dir: str) -> None:
    """The manifest of each version, one file, written when everything that it names
    is there: a version without one does not exist."""
    for version in sorted({t.version for t in trained}):
        rows = [(t.name, t.variant, t.version, t.path, t.split_idx, t.prepared) for t in trained if t.version == version]
        spark.createDataFrame(rows, REGISTRY).coalesce(1).write.parquet(f"{models_dir}/{version}/manifest")


def registry(spark, models_dir: str) -> DataFrame:
    """The manifests of all versions; none where nothing is registered yet."""
    try:
        return spark.read.schema(REGISTRY).parquet(f"{models_dir}/*/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], REGISTRY)


def stored_versions(spark, models_dir: str) -> list[Trained]:
    """Every registered version, oldest first (as many as models were trained)."""
    return [Trained(**r.asDict()) for r in registry(spark, models_dir).orderBy("version", "variant", "name").collect()]


def opened(t: Trained, spark):
    """The model, or None, with a warning, where its files are gone."""
    try:
        return t.model if t.model is not None else load_model(t.name, t.path, spark)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        warnings.warn(f"no files of model {t.path}", stacklevel=2)
        return None


def validate(trained: list[Trained], tables: dict, feature_cols: list[str], settings: Settings = DEFAULTS,
             spark=None) -> DataFrame:
    """M8 for models that were trained with the parameters of ``tables``: each scored on the
    newest 20 % of its own variant (Q5 fix); one grouped A19 over the union of all predictions. A
    version whose files are gone is skipped with a warning; it is an error if none is left.
    Versions of several trainings: ``plans.versions.validate_versions``."""
    from claimlens.operators.positions import temporal_split
    there = [(t, m) for t in trained if (m := opened(t, spark)) is not None]
    if not there:
        raise RuntimeError("no stored model to validate")

    def scored(t, model):
        test = temporal_split(tables[t.variant], settings.train_split).where("NOT is_train")
        return predictions(t.name, model, test, feature_cols, settings).select(
            F.col(settings.target).alias("y"), "prediction", F.lit(f"{t.name}_{t.variant}_{t.version}").alias("model"))
    preds = together(tables[there[0][0].variant].sparkSession, [partial(scored, *x) for x in there])
    return regression_metrics(reduce(DataFrame.unionByName, preds), "y", "prediction", ("model",))


def feature_importances(tree_model, cols: list[str], spark) -> DataFrame:
    """Impurity importances of a tree, keyed by feature name, descending."""
    imp = tree_model.featureImportances.toArray().tolist()
    return (spark.createDataFrame(list(zip(cols, [float(x) for x in imp])), "feature string, importance double")
                 .orderBy(F.desc("importance"), "feature"))

"""Models: feature matrix, OLS baseline (MLlib), forest challenger
(``operators.forest``), scoring and error metrics as DataFrame aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlake import config
from demandlake.operators import forest
from demandlake.operators.forest import Forest

LINEAR = "LinearRegression"
FOREST = "RandomForestRegressor"


def feature_matrix(
    df: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str | None = config.TARGET,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rows complete in every feature and the label, plus a ``features``
    vector column.  ``keep`` carries extra columns (keys) through;
    ``label=None`` builds a scoring matrix without a label."""
    needed = [*features, *([label] if label else [])]
    complete = df.select(*keep, *needed).dropna(how="any", subset=[*keep, *needed])
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(complete)


def fit_baseline(matrix: DataFrame, label: str = config.TARGET) -> LinearRegressionModel:
    """Ordinary least squares with intercept and no penalty.

    The normal-equation solver needs one distributed pass (a tree
    aggregate of X'X and X'y); the solve is a 10x10 system on the driver."""
    lr = LinearRegression(
        featuresCol="features", labelCol=label, predictionCol="prediction",
        solver="normal", regParam=0.0, elasticNetParam=0.0, fitIntercept=True,
    )
    return lr.fit(matrix)


def gram_rows(matrix: DataFrame, features: Sequence[str] = config.FEATURES, label: str = config.TARGET) -> DataFrame:
    """The Gram matrix and the moment vector as rows (term_i, term_j, n_rows,
    total): sums of products over all rows, one aggregate pass.  Terms are the
    intercept, the features and the label; each pair comes once."""
    terms = {"intercept": F.lit(1.0), **{f: F.col(f).cast("double") for f in [*features, label]}}
    names = list(terms)
    pairs = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    one = matrix.agg(F.count(F.lit(1)).alias("n_rows"), *[F.sum(terms[a] * terms[b]).alias(f"p{k}") for k, (a, b) in enumerate(pairs)])
    cells = F.array(*[F.struct(F.lit(a).alias("term_i"), F.lit(b).alias("term_j"), F.col(f"p{k}").alias("total")) for k, (a, b) in enumerate(pairs)])
    return one.select("n_rows", F.explode(cells).alias("c")).select("c.term_i", "c.term_j", "n_rows", "c.total")


def coefficients(spark: SparkSession, model: LinearRegressionModel, features: Sequence[str] = config.FEATURES) -> DataFrame:
    """A fitted linear model as rows (term, coefficient), intercept included."""
    rows = [("intercept", float(model.intercept)), *zip(features, map(float, model.coefficients), strict=True)]
    return spark.createDataFrame(rows, "term string, coefficient double")


def fit_challenger(
    matrix: DataFrame,
    label: str = config.TARGET,
    num_trees: int = 100,
    max_depth: int = 10,
    seed: int = 42,
    max_bins: int = 32,
    features: Sequence[str] | None = None,
    row_key: Sequence[str] | None = None,
    partitions: int | None = None,
) -> Forest:
    """Bagged regression forest; every feature is a split candidate at every
    node, bootstrap samples of full size (the usual forest defaults).

    A row's share in each tree comes from a hash of ``row_key`` (by default
    all scalar columns), so rows, seed and settings alone make the model;
    ``partitions`` only bounds the tasks of a pass.  ``features`` defaults to
    the matrix's scalar columns in the order they were assembled."""
    scalars = [c for c in matrix.columns if c != "features"]
    if features is None:
        meta = matrix.schema["features"].metadata["ml_attr"]["attrs"]
        features = [a["name"] for a in sorted((a for kind in meta.values() for a in kind), key=lambda a: a["idx"])]
    settings = forest.Settings(num_trees, max_depth, seed, max_bins)
    return forest.grow(matrix, features, label, row_key or scalars, settings, partitions)


def save_model(spark: SparkSession, model: Model | Forest, path: str) -> None:
    if isinstance(model, Forest):
        model.save(spark, path)
    else:
        model.write().overwrite().save(path)


def model_type(model: Model | Forest) -> str:
    return LINEAR if isinstance(model, LinearRegressionModel) else FOREST


def load_model(kind: str, path: str) -> Model | Forest:
    if kind == LINEAR:
        return LinearRegressionModel.load(path)
    if kind == FOREST:
        return Forest.load(SparkSession.active(), path)
    raise ValueError(f"unknown model type {kind!r}")


def score(model: Model | Forest, matrix: DataFrame, name: str = "predicted_sales") -> DataFrame:
    """Append a prediction column; the vector column is dropped."""
    return model.transform(matrix).withColumnRenamed("prediction", name).drop("features")


def error_metrics(df: DataFrame, label: str = config.TARGET, pred: str = "predicted_sales") -> DataFrame:
    """MAE and RMSE in one aggregate pass (partial sums per task)."""
    err = F.col(label).cast("double") - F.col(pred)
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
    )


def mae_by(df: DataFrame, preds: Mapping[str, str], label: str = config.TARGET, count: str | None = None) -> DataFrame:
    """One MAE column per prediction column, one pass; ``count`` names a
    column with the number of rows (see ``slices.required``)."""
    y = F.col(label).cast("double")
    rows = [F.count(F.lit(1)).alias(count)] if count else []
    return df.agg(*rows, *[F.avg(F.abs(y - F.col(p))).alias(name) for name, p in preds.items()])


def score_side_by_side(df: DataFrame, scorers: Mapping[str, Model | Forest | Column], features=config.FEATURES) -> DataFrame:
    """Score several models on the same rows, one pass: fitted models through
    ``transform`` one after the other (no join), constant-coefficient
    scorers as column expressions."""
    out = df
    needs_vec = any(isinstance(s, Model) for s in scorers.values())
    if needs_vec:
        out = VectorAssembler(inputCols=list(features), outputCol="features").transform(out)
    for name, s in scorers.items():
        if isinstance(s, Model | Forest):
            out = s.transform(out).withColumnRenamed("prediction", name)
        else:
            out = out.withColumn(name, s)
    return out.drop("features") if needs_vec else out


def normal_equation_check(
    model: LinearRegressionModel,
    matrix: DataFrame,
    features: Sequence[str] = config.FEATURES,
    label: str = config.TARGET,
    tol: float = 1e-6,
) -> DataFrame:
    """OLS optimality: the residual is orthogonal to every regressor and to
    the intercept.  For each term, |sum(r*x)| / (||r|| * ||x||) < tol.
    One aggregate pass; output (term, n_rows, orthogonal)."""
    scored = model.transform(matrix)
    r = F.col(label).cast("double") - F.col("prediction")
    terms = {"intercept": F.lit(1.0), **{f: F.col(f).cast("double") for f in features}}
    aggs = [F.count(F.lit(1)).alias("n_rows"), F.sum(r * r).alias("rr")]
    for i, (name, x) in enumerate(terms.items()):
        aggs += [F.sum(r * x).alias(f"rx{i}"), F.sum(x * x).alias(f"xx{i}")]
    one = scored.agg(*aggs)
    rel = [
        F.struct(
            F.lit(name).alias("term"),
            (F.abs(F.col(f"rx{i}")) <= F.lit(tol) * F.sqrt(F.col("rr")) * F.sqrt(F.col(f"xx{i}"))).alias("orthogonal"),
        )
        for i, name in enumerate(terms)
    ]
    return one.select("n_rows", F.explode(F.array(*rel)).alias("t")).select(
        "t.term", "n_rows", "t.orthogonal"
    )


def forest_check(model: Forest, matrix: DataFrame, label: str = config.TARGET) -> DataFrame:
    """Forest sanity on its training rows, one pass: predictions stay in
    the label range (averages of leaf means cannot leave it) and the forest
    beats the constant mean predictor in squared error."""
    s = model.transform(matrix)
    y = F.col(label).cast("double")
    p = F.col("prediction")
    one = s.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(y).alias("y_min"), F.max(y).alias("y_max"),
        F.min(p).alias("p_min"), F.max(p).alias("p_max"),
        F.sum((y - p) * (y - p)).alias("sse"),
        F.sum(y * y).alias("syy"), F.sum(y).alias("sy"),
    )
    sst = F.col("syy") - F.col("sy") * F.col("sy") / F.col("n_rows")
    return one.select(
        "n_rows",
        ((F.col("p_min") >= F.col("y_min") - 1e-9) & (F.col("p_max") <= F.col("y_max") + 1e-9)).alias("within_label_range"),
        (F.col("sse") < sst).alias("beats_mean_predictor"),
    )

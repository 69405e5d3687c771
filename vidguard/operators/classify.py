"""Layer 1: standardise, fit, score, explain."""

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, StandardScaler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rounding import round_exact
from ..functions.vectors import logistic

TOP_FEATURES = 10


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, mean, scale) with the population deviation; a constant feature has scale 1."""
    row = df.agg(*[
        F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("sd")).alias(f"m{i}")
        for i, c in enumerate(columns)
    ])
    long = row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"), F.col(f"m{i}").alias("s"))
        for i, c in enumerate(columns)
    ])).alias("r")).select("r.feature", "r.s.mean", "r.s.sd")
    return long.select("feature", "mean", F.when(F.col("sd") == 0, 1.0).otherwise(F.col("sd"))
                       .alias("scale"))


def collected_stats(stats: DataFrame) -> dict[str, tuple[float, float]]:
    """Scaler as plain numbers; one row per feature."""
    return {r["feature"]: (r["mean"], r["scale"]) for r in stats.collect()}


def scaled(c: str, stats: Mapping[str, tuple[float, float]]) -> Column:
    mean, scale = stats[c]
    return (F.col(c).cast("double") - F.lit(mean)) / F.lit(scale)


def standardise(df: DataFrame, stats: Mapping[str, tuple[float, float]]) -> DataFrame:
    return df.select(*[scaled(c, stats).alias(c) if c in stats else F.col(c) for c in df.columns])


def _balanced(df: DataFrame) -> tuple[Column, int]:
    """Weight of a row by its class, summing to the number of rows, and that number."""
    counts = {r["label"]: r["n"] for r in df.groupBy("label").agg(
        F.count(F.lit(1)).alias("n")).collect()}
    n = sum(counts.values())
    weight = None
    for label, rows in counts.items():
        share = n / (len(counts) * rows)
        hit = F.col("label") == label
        weight = F.when(hit, share) if weight is None else weight.when(hit, share)
    return weight, n


def train(df: DataFrame, x: str = "x", scaler: PipelineModel | None = None) -> PipelineModel:
    """Balanced L2 logistic regression on the standardised matrix column ``x``.

    The summed loss with C = 1 equals the mean loss with penalty 1/n, and balanced class weights
    sum to n. Spark's scaler divides by the sample deviation; the constant factor after it turns
    that into the population deviation, so the penalty acts on the same scale.
    """
    weight, n = _balanced(df)
    data = df.select(
        array_to_vector(F.col(x).cast("array<double>")).alias("features_raw"),
        F.col("label").cast("double").alias("label"), weight.alias("weight"),
    )
    if scaler is None:
        width = df.select(F.size(x).alias("n")).first()["n"]
        factor = (n / (n - 1)) ** 0.5 if n > 1 else 1.0
        scaler = Pipeline(stages=[
            StandardScaler(withMean=True, withStd=True, inputCol="features_raw",
                           outputCol="features_sample"),
            ElementwiseProduct(scalingVec=Vectors.dense([factor] * width),
                               inputCol="features_sample", outputCol="features"),
        ]).fit(data)
    regression = LogisticRegression(
        featuresCol="features", labelCol="label", weightCol="weight",
        regParam=1.0 / (K.INVERSE_REGULARISATION * n), elasticNetParam=0.0,
        standardization=False, maxIter=K.MAX_ITERATIONS,
    )
    model = regression.fit(scaler.transform(data))
    return PipelineModel(stages=[*scaler.stages, model])


def objective_gradient(model: PipelineModel, df: DataFrame, x: str = "x") -> DataFrame:
    """(place, gradient) of the penalised mean loss at a model's weights, over its training rows.

    Place -1 is the intercept, which carries no penalty. The objective is strictly convex in the
    weights, so a gradient near 0 everywhere proves that they are the optimum, whoever fitted them.
    Products are summed as whole vectors inside the map tasks; one vector per task is shuffled.
    """
    weight, n = _balanced(df)
    raw = df.withColumn("features_raw", array_to_vector(F.col(x).cast("array<double>")))
    slope = weight * (vector_to_array("probability")[1] - F.col("label"))
    z = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    rows = model.transform(raw).select(slope.alias("slope"), z.alias("z")).select(
        array_to_vector(F.transform("z", lambda v: F.col("slope") * v)).alias("part"))
    sums = rows.agg(Summarizer.metrics("sum").summary(F.col("part")).alias("s")).select(
        F.posexplode(vector_to_array("s.sum")).alias("place", "sum"))
    fitted = [float(w) for w in model.stages[-1].coefficients]
    penalty = F.get(F.lit([*fitted, 0.0]), F.col("place")) / K.INVERSE_REGULARISATION
    place = F.when(F.col("place") == len(fitted), -1).otherwise(F.col("place"))
    return sums.select(place.alias("place"), ((F.col("sum") + penalty) / n).alias("gradient"))


def predict(model: PipelineModel, df: DataFrame, x: str = "x") -> DataFrame:
    """Add ``score`` (probability of harmful) and ``pred``."""
    raw = df.withColumn("features_raw", array_to_vector(F.col(x).cast("array<double>")))
    out = model.transform(raw)
    return out.withColumns({
        "score": vector_to_array("probability")[1], "pred": F.col("prediction").cast("int"),
    }).drop("features_raw", "features_sample", "features", "rawPrediction", "probability",
            "prediction")


def linear_predict(
    df: DataFrame, intercept: float, weights: Mapping[str, float],
    stats: Mapping[str, tuple[float, float]],
) -> DataFrame:
    """The same for given coefficients over scalar columns, as one expression."""
    p = logistic(intercept, [(w, scaled(c, stats)) for c, w in weights.items()])
    return df.withColumn("score", p).withColumn("pred", (F.col("score") > 0.5).cast("int"))


def layer1(scored: DataFrame) -> DataFrame:
    label = F.when(F.col("pred") == 1, "harmful").otherwise("clean")
    return scored.withColumns({
        "layer1_label": label, "harmful_prob": round_exact(F.col("score"), 4),
    })


def attributions(
    df: DataFrame, weights: Mapping[str, float], stats: Mapping[str, tuple[float, float]],
    key: str = "video_id", top: int = TOP_FEATURES,
) -> DataFrame:
    """Largest contributions per row against the training mean: (key, rank, feature, contribution).

    A scaled feature is already its distance from the training mean, so its contribution is the
    coefficient times that. The fixed-width list is ordered inside the row; nothing is shuffled.
    """
    cells = F.array(*[
        F.struct(F.abs(F.lit(w) * scaled(c, stats)).alias("size"), F.lit(c).alias("feature"),
                 (F.lit(w) * scaled(c, stats)).alias("contribution"))
        for c, w in weights.items()
    ])
    best = F.slice(F.array_sort(
        cells,
        lambda a, b: F.when(a["size"] > b["size"], -1).when(a["size"] < b["size"], 1)
        .when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0),
    ), 1, top)
    return df.select(key, F.posexplode(best).alias("pos", "c")).select(
        key, (F.col("pos") + 1).alias("rank"), "c.feature", "c.contribution"
    )


def model_attributions(
    df: DataFrame, weights: Sequence[float], means: Sequence[float], scales: Sequence[float],
    names: Sequence[str], x: str = "x", key: str = "video_id", top: int = TOP_FEATURES,
) -> DataFrame:
    """``attributions`` over the model matrix ``x``: all inputs of a fitted model, by place.

    The lists have one entry per place of ``x``, ``names`` in order. The list of contributions is
    ordered inside the row, so nothing is shuffled.
    """
    w, mean, scale, name = (F.lit(list(v)) for v in (
        map(float, weights), map(float, means), map(float, scales), names))
    cells = F.transform(x, lambda v, i: F.struct(
        -F.abs(F.get(w, i) * ((v - F.get(mean, i)) / F.get(scale, i))).alias("neg"),
        F.get(name, i).alias("feature"),
        (F.get(w, i) * ((v - F.get(mean, i)) / F.get(scale, i))).alias("contribution")))
    best = F.slice(F.array_sort(cells), 1, top)
    return df.select(key, F.posexplode(best).alias("pos", "c")).select(
        key, (F.col("pos") + 1).alias("rank"), "c.feature", "c.contribution")


def explain(model: PipelineModel, df: DataFrame, names: Sequence[str], x: str = "x",
            key: str = "video_id", top: int = TOP_FEATURES) -> DataFrame:
    """Largest contributions of a fitted model per row, over all of its inputs."""
    scaler, factor, regression = model.stages[0], model.stages[1], model.stages[-1]
    scales = [float(s) / float(f) if s else 1.0
              for s, f in zip(scaler.std, factor.getScalingVec())]
    return model_attributions(df, list(map(float, regression.coefficients)),
                              list(map(float, scaler.mean)), scales, names, x, key, top)


def coefficients(model: PipelineModel, features: Sequence[str]) -> dict[str, float]:
    """Coefficients of a fitted model by feature name, on the population-scaled inputs."""
    return dict(zip(features, (float(w) for w in model.stages[-1].coefficients)))

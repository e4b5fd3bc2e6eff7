"""Components, clusters and an outcome model, with Spark's own learners."""

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA, Imputer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from towerlens.sources.workspace import written


def known_columns(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that hold any value; a column without one has no mean to fill in."""
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    return [c for c in columns if counts[c]]


def _prepared(columns: Sequence[str]) -> list:
    filled = [f"{c}_filled" for c in columns]
    return [
        Imputer(inputCols=list(columns), outputCols=filled, strategy="mean"),
        VectorAssembler(inputCols=filled, outputCol="assembled"),
        StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
    ]


def principal_components(
    df: DataFrame, id_columns: Sequence[str], columns: Sequence[str], k: int
) -> DataFrame:
    """Every row's coordinates on the first ``k`` principal components of the standardised columns.

    Columns without any value are left out. Each component points to where its weights add up to more than 0
    (where they add up to nothing, to where the first is positive), so the sign isn't left to chance.
    """
    columns = known_columns(df, columns)
    pca = PCA(k=k, inputCol="scaled", outputCol="components")
    fitted = Pipeline(stages=[*_prepared(columns), pca]).fit(df)
    weights = fitted.stages[-1].pc.toArray()
    signs = []
    for weight in weights.T:
        total = weight.sum()
        signs.append(1.0 if (total if abs(total) > 1e-9 else weight[abs(weight) > 1e-9][0]) > 0 else -1.0)
    coordinates = vector_to_array("components")
    return fitted.transform(df).select(
        *id_columns, *[(coordinates[place] * signs[place]).alias(f"PC{place + 1}") for place in range(k)]
    )


def similar_keys(df: DataFrame, key: str, columns: Sequence[str], k: int, seed: int = 1) -> DataFrame:
    """Clusters of keys that are alike in the means of their columns, numbered by their smallest key.

    Columns without any value are left out.
    """
    means = written(
        df.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.avg(c).alias(c) for c in columns]),
        "key-means",
    )
    columns = known_columns(means, columns)
    kmeans = KMeans(k=k, seed=seed, featuresCol="scaled", predictionCol="found")
    fitted = Pipeline(stages=[*_prepared(columns), kmeans]).fit(means)
    clusters = fitted.transform(means).select(key, "found")
    # One row per cluster.
    firsts = clusters.groupBy("found").agg(F.min(key).alias("first"))
    place = (F.row_number().over(Window.orderBy("first")) - 1).alias("CLUSTER")
    return clusters.join(F.broadcast(firsts.select("found", place)), "found").select(key, "CLUSTER")


def outcome_scores(
    mart: DataFrame,
    key: str,
    outcome: str,
    columns: Sequence[str],
    to_score: DataFrame | None = None,
    regularisation: float = 0.01,
) -> DataFrame:
    """Probability of outcome 1 from a logistic regression on the mart, for its rows or for others.

    Columns without any value are left out.
    """
    rows = written(mart.select(key, F.col(outcome).cast("double").alias("label"), *columns), "mart")
    columns = known_columns(rows, columns)
    model = LogisticRegression(featuresCol="scaled", labelCol="label", regParam=regularisation, tol=1e-9)
    fitted = Pipeline(stages=[*_prepared(columns), model]).fit(rows)
    scored = fitted.transform(rows if to_score is None else to_score)
    kept = [F.col("label").cast("int").alias(outcome)] if to_score is None else []
    return scored.select(key, *kept, vector_to_array("probability")[1].alias("SCORE"))

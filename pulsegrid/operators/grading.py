"""Diet grades: train on labelled diets, predict for any table."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import MultilayerPerceptronClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsegrid.sources import tables

# Feature order, hidden layers, iteration limit.
FEATURES = ["CAL_DIFF", "CARBS", "FAT", "PROTEIN", "CHOL", "SALT", "SUGAR"]
HIDDEN_LAYERS = [10, 5]
MAX_ITERATIONS = 2000


def train_grader(graded: DataFrame, diet_name: str | None = None, seed: int = 7,
                 max_iterations: int = MAX_ITERATIONS) -> PipelineModel:
    """Fit a two-hidden-layer network on features and GRADE taken from the same rows.

    Features are put on one scale first, without which the network's sigmoid units saturate. Only
    the grades present (a handful) come to the driver, to size the output layer.
    """
    rows = graded if diet_name is None else graded.filter(F.col("DIET_NAME") == diet_name)
    rows = rows.select(
        *[F.col(c).cast("double").alias(c) for c in FEATURES],
        F.col("GRADE").cast("int").cast("string").alias("GRADE_TEXT"),
    ).dropna()
    indexer = StringIndexer(
        inputCol="GRADE_TEXT", outputCol="label", stringOrderType="alphabetAsc"
    ).fit(rows)
    layers = [len(FEATURES), *HIDDEN_LAYERS, max(2, len(indexer.labels))]
    return Pipeline(
        stages=[
            indexer,
            VectorAssembler(inputCols=FEATURES, outputCol="raw", handleInvalid="keep"),
            StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True),
            MultilayerPerceptronClassifier(layers=layers, maxIter=max_iterations, seed=seed),
            IndexToString(inputCol="prediction", outputCol="GRADE_NAME", labels=indexer.labels),
        ]
    ).fit(rows)


def predict_grade(model: PipelineModel, df: DataFrame) -> DataFrame:
    """The input rows with the predicted grade as column GRADE; NULL where a feature is missing."""
    kept = [c for c in df.columns if c != "GRADE"]
    typed = df.select(
        F.struct(*kept).alias("ROW"), *[F.col(c).cast("double").alias(c) for c in FEATURES]
    )
    scored = PipelineModel(model.stages[1:]).transform(typed)
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in FEATURES])
    return scored.select(
        "ROW.*", F.when(complete, F.col("GRADE_NAME").cast("int")).alias("GRADE")
    )


def with_calorie_difference(df: DataFrame, eaten: Column, burned: Column) -> DataFrame:
    """The form that takes calories eaten and burned in place of their difference."""
    return df.withColumn("CAL_DIFF", eaten - burned)


def with_fold(graded: DataFrame, folds: int, seed: int = 7) -> DataFrame:
    """Adds FOLD, from a hash of the row's features: the same rows fall into the same fold on every run and
    whatever order they come in, and equal rows never stand on both sides of a split."""
    return graded.withColumn("FOLD", F.pmod(F.xxhash64(F.lit(seed), *FEATURES), F.lit(folds)).cast("int"))


def accuracy(graded: DataFrame, model: PipelineModel) -> DataFrame:
    """N and CORRECT (rows graded as given) of labelled rows; one row."""
    marked = predict_grade(model, graded.withColumn("GIVEN", F.col("GRADE")))
    right = F.coalesce(F.col("GRADE") == F.col("GIVEN"), F.lit(False))
    return marked.agg(F.count("*").alias("N"), F.count_if(right).alias("CORRECT"))


def cross_validated(graded: DataFrame, folds: int = 4, seed: int = 7, **training) -> DataFrame:
    """FOLD, TRAINED, N and CORRECT: each fold graded by a model of the others. Folds are few, and a model each."""
    dealt = with_fold(graded, folds, seed)
    parts = []
    for fold in range(folds):
        rest = dealt.filter(F.col("FOLD") != fold)
        model = train_grader(rest, seed=seed, **training)
        parts.append(accuracy(dealt.filter(F.col("FOLD") == fold), model).crossJoin(
            rest.agg(F.count("*").alias("TRAINED"))).withColumn("FOLD", F.lit(fold)))
    return reduce(DataFrame.unionByName, parts).select("FOLD", "TRAINED", "N", "CORRECT")


def register_model(spark: SparkSession, model: PipelineModel, root: str, name: str,
                   metrics: DataFrame | None = None) -> str:
    """Save a model and add its name to the model list, and its metrics (N, CORRECT) to the table of metrics."""
    path = f"{root}/{name}"
    model.write().overwrite().save(path)
    tables.append_row(spark, f"{root}/model_list", MODEL_NAME=F.lit(name))
    if metrics is not None:
        metrics.agg(F.sum("N").alias("N"), F.sum("CORRECT").alias("CORRECT")).withColumn("MODEL_NAME", F.lit(name)) \
            .write.mode("append").parquet(f"{root}/model_metrics")
    return path


def load_model(root: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{root}/{name}")

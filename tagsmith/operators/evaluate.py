"""Evaluation and feature stages: deterministic split, label indexing,
scaling, and multiclass metrics from a confusion matrix."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import MinMaxScaler, Normalizer, StringIndexer, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.operators.joins import join_small
from tagsmith.operators.lineage import cut_lineage


def hash_split(df: DataFrame, keys: list[str], train_pct: int = 80, out: str = "is_train",
               method: str = "xxhash64") -> DataFrame:
    """Deterministic train/test split: a row is in training when a hash of
    its key mod 100 is below ``train_pct``.  Unlike ``randomSplit`` it does
    not depend on partitioning, so a retried task puts every row on the same
    side.  ``xxhash64`` is Spark's fast native hash; ``md5`` (first 32 bits of
    md5 over the ``|``-joined key text) is slower but reproducible in any SQL
    engine."""
    if method == "xxhash64":
        bucket = F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(100))
    elif method == "md5":
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
        bucket = F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(100))
    else:
        raise ValueError("method must be 'xxhash64' or 'md5'")
    return df.withColumn(out, bucket < F.lit(int(train_pct)))


def label_index(df: DataFrame, col: str, out: str = "label_idx", nulls: str = "drop") -> DataFrame:
    """Label indices as StringIndexer gives them: most frequent value -> 0.0,
    equal counts alphabetical.  Rows with a null label are dropped, or kept
    with a null index (``nulls="keep"``).

    The values are counted by one partially aggregated group-by, numbered in
    range partitions of (count, value) and joined back, so any number of
    values works and none passes through the driver."""
    from tagsmith.operators.ranks import number_rows
    if nulls not in ("drop", "keep"):
        raise ValueError("nulls must be 'drop' or 'keep'")
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("_label")).agg(F.count(F.lit(1)).alias("_freq"))
    index = number_rows(counts, [F.col("_freq").desc(), F.col("_label").asc()], "_at").select("_label", (F.col("_at") - 1).cast("double").alias(out))
    index = cut_lineage(index)
    return join_small(df, index, df[col] == index["_label"], "left" if nulls == "keep" else "inner").drop("_label")


def l2_normalize(df: DataFrame, array_col: str, out: str = "normalized") -> DataFrame:
    """Normalizer(p=2) over an array column (converted to a vector and back)."""
    vec = df.withColumn("_v", array_to_vector(F.col(array_col)))
    res = Normalizer(inputCol="_v", outputCol="_n", p=2.0).transform(vec)
    return res.withColumn(out, vector_to_array("_n")).drop("_v", "_n")


def minmax_scale(df: DataFrame, cols: list[str], out: str = "scaled") -> DataFrame:
    """MinMaxScaler to [0, 1] over the assembled columns (a constant column
    maps to 0.5, as Spark ML defines it)."""
    from tagsmith.operators.segment import assemble
    vec = assemble(df, cols, "_v")
    model = MinMaxScaler(inputCol="_v", outputCol="_s", min=0.0, max=1.0).fit(vec)
    return model.transform(vec).withColumn(out, vector_to_array("_s")).drop("_v", "_s")


def confusion_metrics(cm: DataFrame, label: str = "l", prediction: str = "p", count: str = "n") -> DataFrame:
    """accuracy, weighted precision / recall / F1 from a confusion matrix
    ``(label, prediction, n)`` (a few rows).  Each cell is credited to its
    true class (actual, tp) and to its predicted class (predicted), summed per
    class, then weighted by the true-class share.  Matches
    ``MulticlassClassificationEvaluator`` for those metric names."""
    n = F.col(count)
    hit = F.col(label) == F.col(prediction)
    credits = F.explode(F.array(
        F.struct(F.col(label).alias("c"), n.alias("actual"), F.when(hit, n).otherwise(0).alias("tp"),
                 F.lit(0).cast("long").alias("predicted")),
        F.struct(F.col(prediction).alias("c"), F.lit(0).cast("long").alias("actual"),
                 F.lit(0).cast("long").alias("tp"), n.alias("predicted"))))
    per = (cm.select(credits.alias("x")).select("x.*").groupBy("c")
           .agg(F.sum("actual").alias("actual"), F.sum("tp").alias("tp"), F.sum("predicted").alias("predicted"))
           .where(F.col("actual") > 0))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.col("tp") / F.col("actual")
    per = per.select("actual", "tp", prec.alias("prec"), rec.alias("rec"))
    f1 = F.when(F.col("prec") + F.col("rec") > 0,
                2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(0.0)
    total = F.sum("actual")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("actual") * F.col("prec")) / total).alias("weighted_precision"),
        (F.sum(F.col("actual") * F.col("rec")) / total).alias("weighted_recall"),
        (F.sum(F.col("actual") * f1) / total).alias("f1"),
    )


def classification_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Metrics of row-level predictions: the confusion matrix is one
    partially aggregated group-by, everything after it is a few rows."""
    cm = df.groupBy(F.col(label).alias("l"), F.col(prediction).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    return confusion_metrics(cm)


# fixed values: the reference's logistic-regression settings
LOGREG_PARAMS = {"maxIter": 10, "regParam": 0.3, "elasticNetParam": 0.8}


def prepare_features(df: DataFrame, features) -> tuple[DataFrame, list[str]]:
    """``features`` is a list of numeric columns or one array column; an
    array column is turned into a vector column for the assembler."""
    if isinstance(features, str):
        return df.withColumn("_vec", array_to_vector(F.col(features))), ["_vec"]
    return df, list(features)


def demo_pipeline(cols: list[str], label_col: str, lr: LogisticRegression) -> Pipeline:
    """StringIndexer(label) -> VectorAssembler -> Normalizer(p=2) -> ``lr``."""
    return Pipeline(stages=[
        StringIndexer(inputCol=label_col, outputCol="label_idx", stringOrderType="frequencyDesc"),
        VectorAssembler(inputCols=cols, outputCol="raw_features"),
        Normalizer(inputCol="raw_features", outputCol="features", p=2.0),
        lr])


def train_classifier(df: DataFrame, features, label_col: str, params: dict | None = None):
    """The classifier demo's pipeline: StringIndexer(label) -> VectorAssembler
    -> Normalizer(p=2) -> LogisticRegression (maxIter 10, regParam 0.3,
    elasticNet 0.8).  Returns ``(pipeline_model, prepared_df)``; transform
    ``prepare_features(df, features)[0]`` with the model to predict.  A label
    that occurs only outside the training rows gets the index after the last
    one (no prediction can equal it)."""
    params = {**LOGREG_PARAMS, **(params or {})}
    data, cols = prepare_features(df, features)
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", **params)
    model = demo_pipeline(cols, label_col, lr).fit(data)
    model.stages[0].setHandleInvalid("keep")  # for scoring only: the training classes are fixed
    return model, data


def evaluate_predictions(pred: DataFrame, label_col: str = "label_idx",
                         prediction_col: str = "prediction") -> dict[str, float]:
    """accuracy, f1, weightedPrecision and weightedRecall from one confusion
    matrix, in one pass over the predictions."""
    m = classification_metrics(pred, label_col, prediction_col).first()
    return {"accuracy": m["accuracy"], "f1": m["f1"], "weightedPrecision": m["weighted_precision"],
            "weightedRecall": m["weighted_recall"]}


def classify(df: DataFrame, feature_array, label_col: str, split_keys: list[str],
             model_path: str | None = None, train_pct: int = 80):
    """The classifier demo end to end: deterministic split, StringIndexer +
    logistic regression on the training side (or the saved model at
    ``model_path``), predictions for every row, metrics on the held-out side.
    Returns ``(predictions, metrics)``."""
    from pyspark.ml import PipelineModel

    from tagsmith.sources.store import load_or_train

    data = hash_split(df, split_keys, train_pct)

    def train():
        return train_classifier(data.where("is_train"), feature_array, label_col)[0]

    model = load_or_train(model_path, PipelineModel, train) if model_path else train()
    pred = model.transform(prepare_features(data, feature_array)[0])
    return pred, evaluate_predictions(pred.where(~F.col("is_train")))


def tune_classifier(df: DataFrame, features, label_col: str, reg_params=(0.01, 0.1, 0.3),
                    elastic_net_params=(0.0, 0.5, 0.8), train_ratio: float = 0.8, parallelism: int = 4,
                    seed: int = 123):
    """Hyper-parameter search for the demo pipeline with Spark ML's
    ``TrainValidationSplit`` (accuracy on the validation part); candidate
    models are fitted concurrently.  Returns the best pipeline model."""
    from pyspark.ml.tuning import ParamGridBuilder, TrainValidationSplit
    data, cols = prepare_features(df, features)
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", maxIter=LOGREG_PARAMS["maxIter"])
    pipeline = demo_pipeline(cols, label_col, lr)
    grid = (ParamGridBuilder().addGrid(lr.regParam, list(reg_params))
            .addGrid(lr.elasticNetParam, list(elastic_net_params)).build())
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    tvs = TrainValidationSplit(estimator=pipeline, estimatorParamMaps=grid, trainRatio=train_ratio,
                               evaluator=MulticlassClassificationEvaluator(labelCol="label_idx",
                                                                           metricName="accuracy"),
                               parallelism=parallelism, seed=seed)
    return tvs.fit(data).bestModel

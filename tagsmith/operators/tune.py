"""Supervised tuning over hash folds with one-pass confusion matrices."""

from __future__ import annotations

import itertools

from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import Normalizer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.operators.evaluate import LOGREG_PARAMS, confusion_metrics, label_index, prepare_features
from tagsmith.operators.lineage import cut_lineage


def hash_folds(df: DataFrame, keys: list[str], folds: int, out: str = "fold") -> DataFrame:
    """``df`` with the fold (0 .. folds - 1) of each row: the first 32 bits of
    the md5 of its key text, modulo ``folds``.  A row's fold depends on its
    key alone, so a retried task and any other engine agree."""
    if folds < 2:
        raise ValueError("at least two folds")
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    return df.withColumn(out, F.pmod(F.conv(F.substring(F.md5(key), 1, 8), 16, 10).cast("long"), F.lit(folds)).cast("int"))


def grid(reg_params=(0.01, 0.1, 0.3), elastic_net_params=(0.0, 0.5, 0.8)) -> list[dict]:
    return [{"regParam": r, "elasticNetParam": a} for r, a in itertools.product(reg_params, elastic_net_params)]


def fold_confusions(df: DataFrame, features, label_col: str, keys: list[str], candidates: list[dict], folds: int = 3,
                    max_iter: int | None = None) -> DataFrame:
    """``(candidate, fold, l, p, n)``: held-out confusion matrices of every
    candidate's logistic regression, ``candidate`` the position in the list.

    The label index is fitted once over all rows, so a class met only in
    validation has an index that no prediction equals and counts as missed.
    Each fold's rows are scored once with all the fold's models in one pass,
    and all matrices come from one partially aggregated group-by per fold.
    Rows with a null label take no part; a fold whose training part has fewer
    than two classes predicts that part's class (or class 0)."""
    data, cols = prepare_features(df, features)
    indexed = label_index(hash_folds(data, keys, folds), label_col, "_y")
    ready = Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="_raw"), Normalizer(inputCol="_raw", outputCol="_x", p=2.0)]).fit(indexed).transform(indexed)
    ready = cut_lineage(ready.select("fold", "_y", "_x"))
    out = None
    for fold in range(folds):
        train = ready.where(F.col("fold") != fold)
        held = ready.where(F.col("fold") == fold)
        classes = [r[0] for r in train.select("_y").distinct().limit(2).collect()]
        predicted = []
        for i, params in enumerate(candidates):
            name = f"_p{i}"
            if len(classes) < 2:
                held = held.withColumn(name, F.lit(classes[0] if classes else 0.0))
            else:
                lr = LogisticRegression(featuresCol="_x", labelCol="_y", predictionCol=name, probabilityCol="", rawPredictionCol="",
                                        **{"maxIter": max_iter or LOGREG_PARAMS["maxIter"], **params})
                held = lr.fit(train).transform(held)
            predicted.append(F.struct(F.lit(i).alias("candidate"), F.col(name).alias("p")))
        rows = held.select("fold", F.col("_y").alias("l"), F.explode(F.array(*predicted)).alias("c"))
        part = rows.groupBy("c.candidate", "fold", "l", "c.p").agg(F.count(F.lit(1)).alias("n"))
        out = part if out is None else out.unionByName(part)
    return cut_lineage(out)


def fold_metrics(confusions: DataFrame) -> DataFrame:
    """``(candidate, fold, rows, accuracy)`` from the confusion matrices."""
    return confusions.groupBy("candidate", "fold").agg(
        F.sum("n").alias("rows"), (F.sum(F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(0)) / F.sum("n")).alias("accuracy"))


def best_candidate(confusions: DataFrame, candidates: list[dict], metric: str = "accuracy") -> tuple[dict, list[dict]]:
    """(the candidate with the best metric over all folds together, one entry
    per candidate); ties keep the earlier."""
    found = []
    for i in range(len(candidates)):
        m = confusion_metrics(confusions.where(F.col("candidate") == i).groupBy("l", "p").agg(F.sum("n").alias("n"))).first()
        found.append({**candidates[i], **m.asDict()})
    best = max(range(len(found)), key=lambda i: (found[i][metric] if found[i][metric] is not None else -1.0, -i))
    return candidates[best], found


def tune_by_folds(df: DataFrame, features, label_col: str, keys: list[str], candidates: list[dict] | None = None, folds: int = 3):
    """(pipeline model trained on all rows with the best candidate, the
    candidates' metrics)."""
    from tagsmith.operators.evaluate import train_classifier
    candidates = candidates or grid()
    best, found = best_candidate(fold_confusions(df, features, label_col, keys, candidates, folds), candidates)
    return train_classifier(df, features, label_col, best)[0], found


__all__ = ["hash_folds", "grid", "fold_confusions", "fold_metrics", "best_candidate", "tune_by_folds"]

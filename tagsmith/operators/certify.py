"""Certificates of trained models: what an optimum must satisfy, computed by
plain aggregates from the exported parameters, apart from the trainer.

* logistic regression: the elastic-net subgradient of every coefficient and
  intercept, which is 0 at the optimum of the (strictly convex) objective and
  nowhere else;
* decision tree: the best gini gain any split of a node has, against the gain
  of the split the tree chose.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagsmith.sources.literal import local_frame


def _probabilities(x: Column, matrix, intercepts) -> Column:
    """Class probabilities (array) of the feature array ``x``."""
    margins = []
    for row, b in zip(matrix, intercepts):
        products = F.zip_with(x, F.array(*[F.lit(float(v)) for v in row]), lambda a, c: a * c)
        margins.append(F.aggregate(products, F.lit(float(b)), lambda s, v: s + v))
    return F.transform(F.array(*margins), F.exp)


def class_probabilities(df: DataFrame, model, features: str = "features", out: str = "_p") -> DataFrame:
    """``df`` with the class probabilities by the exported parameters of the
    (binomial or multinomial) logistic ``model``."""
    matrix, intercepts = model.coefficientMatrix.toArray().tolist(), list(model.interceptVector)
    if len(matrix) == 1:  # binomial: the margin of class 1 against class 0
        matrix, intercepts = [[0.0] * len(matrix[0]), matrix[0]], [0.0, intercepts[0]]
    raised = df.withColumn("_e", _probabilities(vector_to_array(F.col(features)), matrix, intercepts))
    total = F.aggregate("_e", F.lit(0.0), lambda s, v: s + v)
    return raised.withColumn(out, F.transform("_e", lambda v: v / total)).drop("_e")


def logistic_residuals(df: DataFrame, model, label: str = "label_idx", features: str = "features") -> DataFrame:
    """``(class, feature, coefficient, residual)`` of a Spark ML logistic model
    on its training rows; feature -1 is the intercept.

    The objective is the mean log loss plus regParam (alpha |b|_1 +
    (1 - alpha) / 2 |b|^2) over the coefficients b of standardised features.
    For b <> 0 the residual is the size of the gradient, for b = 0 what the
    gradient exceeds the L1 term by.  One aggregate per feature over the
    rows, one partial row per feature and task; a constant feature has
    residual 0."""
    reg, alpha = model.getRegParam(), model.getElasticNetParam()
    matrix = model.coefficientMatrix.toArray().tolist()
    binomial = len(matrix) == 1
    classes = 2 if binomial else len(matrix)
    shown = [1] if binomial else list(range(classes))
    scored = class_probabilities(df.select(label, features), model, features)
    errors = F.array(*[F.col("_p")[k] - F.when(F.col(label) == k, 1.0).otherwise(0.0) for k in shown])
    rows = scored.select(errors.alias("_err"), F.posexplode(F.concat(F.array(F.lit(1.0)), vector_to_array(F.col(features)))).alias("_j", "_x"))
    sums = rows.groupBy("_j").agg(F.stddev_samp("_x").alias("_sd"),
                                  F.array(*[F.avg(F.col("_err")[i] * F.col("_x")) for i in range(len(shown))]).alias("_g"))
    per = sums.select((F.col("_j") - 1).alias("feature"), "_sd", F.posexplode("_g").alias("_i", "_grad"))
    values = [(shown[i], j, float(v)) for i, row in enumerate(matrix) for j, v in enumerate(row)]
    values += [(k, -1, float(model.interceptVector[i])) for i, k in enumerate(shown)]
    coefficients = local_frame(df.sparkSession, [(shown.index(k), k, j, v) for k, j, v in values], "_i int, class int, feature int, coefficient double")
    joined = per.join(F.broadcast(coefficients), ["_i", "feature"])  # classes x features rows
    b = F.col("coefficient") * F.col("_sd")
    g = F.col("_grad") / F.col("_sd") + reg * (1 - alpha) * b
    residual = (F.when(F.col("feature") < 0, F.abs("_grad")).when(F.coalesce(F.col("_sd"), F.lit(0.0)) == 0, 0.0)
                .when(b == 0, F.greatest(F.abs(g) - reg * alpha, F.lit(0.0)))
                .otherwise(F.abs(g + reg * alpha * F.signum(b))))
    return joined.select("class", "feature", "coefficient", residual.alias("residual"))


def log_loss(df: DataFrame, model, label: str = "label_idx", features: str = "features") -> DataFrame:
    """One row: rows, classes, the model's mean log loss and that of the best
    constant prediction (the entropy of the labels)."""
    scored = class_probabilities(df.select(label, features), model, features)
    p = F.get("_p", F.col(label).cast("int"))
    per = scored.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum(-F.log(p)).alias("loss"))
    total = per.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"), F.sum("loss").alias("loss"), F.sum(F.col("n") * F.log("n")).alias("own"))
    return total.select("rows", "classes", (F.col("loss") / F.col("rows")).alias("log_loss"), (F.log("rows") - F.col("own") / F.col("rows")).alias("constant_loss"))


# ---- decision trees ------------------------------------------------------

def tree_splits(model) -> list[dict]:
    """The inner nodes of a fitted tree: heap id (root 1, children 2i and
    2i + 1), feature, left categories or threshold, gain, and the path from
    the root as (node id, goes left).  At most 2^maxDepth nodes."""
    out: list[dict] = []

    def walk(node, at: int, path: tuple) -> None:
        if node.getClass().getSimpleName() != "InternalNode":
            return
        split = node.split()
        continuous = split.getClass().getSimpleName() == "ContinuousSplit"
        out.append({"node": at, "feature": split.featureIndex(), "gain": node.gain(), "path": path,
                    "threshold": split.threshold() if continuous else None,
                    "left": None if continuous else sorted(split.leftCategories())})
        walk(node.leftChild(), 2 * at, (*path, (at, True)))
        walk(node.rightChild(), 2 * at + 1, (*path, (at, False)))
    walk(model._java_obj.rootNode(), 1, ())
    return out


def _gini(n: Column, ones: Column) -> Column:
    return 2 * ones / n * (1 - ones / n)


def split_certificate(hist: DataFrame, splits: list[dict], features: int, weight_col: str = "n", label_col: str = "label",
                      vector_col: str = "features", order: str = "share") -> DataFrame:
    """``(node, rows, gain, best_gain)`` per inner node of a tree of 0/1
    labels trained on the weighted histogram ``hist``: the weight that reaches
    the node, the gain the tree states, and the best gini gain of any split.

    For two classes the best split of a feature's categories is a prefix of
    them in the order of their share of ones, and of a continuous one a prefix
    of its values, so one window per (node, feature) tries all."""
    x = vector_to_array(F.col(vector_col))
    by_id = {s["node"]: s for s in splits}

    def goes_left(s: dict) -> Column:
        v = x[s["feature"]]
        return v <= s["threshold"] if s["left"] is None else v.isin([float(c) for c in s["left"]])

    def reached(s: dict) -> Column:
        cond = F.lit(True)
        for at, left in s["path"]:
            side = goes_left(by_id[at])
            cond = cond & (side if left else ~side)
        return F.when(cond, F.lit(s["node"]))
    if not splits:
        return local_frame(hist.sparkSession, [], "node int, rows bigint, gain double, best_gain double")
    ordered = {s["feature"]: s["left"] is None for s in splits}
    nodes = F.filter(F.array(*[reached(s) for s in splits]), lambda v: v.isNotNull())
    cells = hist.select(F.col(weight_col).cast("double").alias("n"), (F.col(weight_col) * F.col(label_col)).cast("double").alias("ones"),
                        F.explode(nodes).alias("node"), x.alias("x"))
    per = cells.select("n", "ones", "node", F.posexplode(F.slice("x", 1, features)).alias("feature", "value")) \
        .groupBy("node", "feature", "value").agg(F.sum("n").alias("n"), F.sum("ones").alias("ones"))
    continuous = F.col("feature").isin([f for f, c in ordered.items() if c] or [-1])
    by = F.col("ones") / F.col("n") if order == "share" else F.col("ones")
    place = Window.partitionBy("node", "feature").orderBy(F.when(continuous, F.col("value")).otherwise(by), "value")
    whole = Window.partitionBy("node", "feature")
    ln, lo = F.sum("n").over(place.rowsBetween(Window.unboundedPreceding, 0)), F.sum("ones").over(place.rowsBetween(Window.unboundedPreceding, 0))
    tried = per.select("node", ln.alias("ln"), lo.alias("lo"), F.sum("n").over(whole).alias("all_n"), F.sum("ones").over(whole).alias("all_ones"))
    rn, ro = F.col("all_n") - F.col("ln"), F.col("all_ones") - F.col("lo")
    gain = F.when(rn > 0, _gini(F.col("all_n"), F.col("all_ones")) - F.col("ln") / F.col("all_n") * _gini(F.col("ln"), F.col("lo"))
                  - rn / F.col("all_n") * _gini(F.nullif(rn, F.lit(0.0)), ro)).otherwise(0.0)
    best = tried.select("node", "all_n", gain.alias("g")).groupBy("node").agg(F.first("all_n").cast("long").alias("rows"), F.max("g").alias("best_gain"))
    stated = local_frame(hist.sparkSession, [(s["node"], float(s["gain"])) for s in splits], "node int, gain double")
    return best.join(F.broadcast(stated), "node").select("node", "rows", "gain", "best_gain")


__all__ = ["class_probabilities", "logistic_residuals", "log_loss", "tree_splits", "split_certificate"]

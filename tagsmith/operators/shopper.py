"""Shopping gender (USG): which gender a user's purchases lean to.

Order lines carry a colour and a product type.  Both are encoded with
dimension tables, a seed rule labels lines female (1) or male (0), a decision
tree learns the label from the two codes, and each user's lines vote: a
male share >= 0.6 -> male, a female share >= 0.6 -> female, else neutral.

Scale: colour and product codes take few values, so the tree is trained on the
weighted histogram (color, product, label, n) and predictions are made for the
distinct (color, product) pairs only.  Votes are pre-aggregated per order
before the order -> user join, so neither a hot order nor a hot user reaches
one task as raw lines.
"""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagsmith.operators.evaluate import hash_split
from tagsmith.operators.joins import join_small
from tagsmith.operators.lineage import cut_lineage
from tagsmith.operators.match import distinct_rules
from tagsmith.operators.segment import SMALL_HISTOGRAM, assemble

# fixed values: the reference's decision-tree settings and vote threshold
TREE_PARAMS = {"maxDepth": 5, "maxBins": 32, "impurity": "gini"}
MAX_CATEGORIES = 30
VOTE_SHARE = 0.6


def _dim_ids(dim: DataFrame) -> DataFrame:
    """(name -> id) with duplicate names resolved to the lowest id."""
    return dim.groupBy("name").agg(F.min("id").alias("id"))


def encode_dims(goods: DataFrame, colors: DataFrame, products: DataFrame,
                color_col: str = "ogcolor", product_col: str = "producttype") -> DataFrame:
    """Adds ``color`` and ``product`` ids (0 when the name is not in the
    dimension table).  Dimensions are joined with a checked broadcast."""
    c = _dim_ids(colors).select(F.col("name").alias("_cname"), F.col("id").alias("_cid"))
    p = _dim_ids(products).select(F.col("name").alias("_pname"), F.col("id").alias("_pid"))
    out = join_small(goods, c, goods[color_col] == c["_cname"], "left", bound_from=colors)
    out = join_small(out, p, out[product_col] == p["_pname"], "left", bound_from=products)
    return (out.withColumn("color", F.coalesce(F.col("_cid"), F.lit(0)).cast("int"))
            .withColumn("product", F.coalesce(F.col("_pid"), F.lit(0)).cast("int"))
            .drop("_cname", "_cid", "_pname", "_pid"))


def seed_labels(goods: DataFrame, female_colors, female_products,
                color_col: str = "ogcolor", product_col: str = "producttype") -> DataFrame:
    """``label`` = 1 (female) when the colour or the product type is in the
    given lists, else 0 (male)."""
    cond = F.col(color_col).isin(list(female_colors)) | F.col(product_col).isin(list(female_products))
    return goods.withColumn("label", F.when(cond, 1).otherwise(0))


def recent_orders(orders: DataFrame, date_col: str, as_of, lookback_days: int) -> DataFrame:
    """Orders of the last ``lookback_days`` days before the clock."""
    from tagsmith.functions.dates import as_date, before_as_of
    lo = as_date(as_of).toordinal() - int(lookback_days)
    recent = before_as_of(orders, date_col, as_of)
    return recent.where(F.to_date(date_col) >= F.lit(as_date(as_of).fromordinal(lo)))


def gender_votes(lines: DataFrame, orders: DataFrame, line_order_col: str, order_col: str,
                 user_of_order: str, class_col: str, user_col: str = "userId",
                 weight_col: str | None = None) -> DataFrame:
    """``(userId, total, male, female)``: lines per user and how many are of
    class 0 (male) / 1 (female).  Lines are summed per order first (partial
    aggregation, shuffle on the order key), then joined to orders (pass
    ``recent_orders(...)`` to vote over a look-back window only).  With
    ``weight_col`` each input row stands for that many lines."""
    w = F.col(weight_col).cast("long") if weight_col else F.lit(1)
    per_order = lines.groupBy(F.col(line_order_col).alias("_ok")).agg(
        F.sum(w).cast("long").alias("_t"),
        F.sum(F.when(F.col(class_col) == 0, w).otherwise(0)).cast("long").alias("_m"),
        F.sum(F.when(F.col(class_col) == 1, w).otherwise(0)).cast("long").alias("_f"))
    o = orders.select(F.col(order_col).alias("_ok"), F.col(user_of_order).alias(user_col))
    joined = per_order.join(o, "_ok")
    return joined.groupBy(user_col).agg(
        F.sum("_t").alias("total"), F.sum("_m").alias("male"), F.sum("_f").alias("female"))


def vote_class(share: float = VOTE_SHARE):
    """0 (male) when male/total >= share, 1 (female) when female/total >=
    share, else -1 (neutral)."""
    return (F.when(F.col("male") / F.col("total") >= share, 0)
            .when(F.col("female") / F.col("total") >= share, 1).otherwise(-1))


def vote_tag(votes: DataFrame, rules: DataFrame, tag_col: str = "usg", user_col: str = "userId",
             share: float = VOTE_SHARE, keep_counts: bool = False) -> DataFrame:
    """The vote class matched to the level-5 rule of that value (``0``,
    ``1``, ``-1``).  ``keep_counts`` keeps total / male / female."""
    r = distinct_rules(rules).select(F.col("rule").alias("_rule"), F.col("name").alias(tag_col))
    keep = [user_col, "total", "male", "female"] if keep_counts else [user_col]
    v = votes.select(*keep, vote_class(share).cast("string").alias("_cls"))
    return join_small(v, r, v["_cls"] == r["_rule"], "left", bound_from=rules).select(*keep, tag_col)


class EmptyTrainingData(ValueError):
    """No order line reached the training histogram."""


def fit_gender_tree(hist: DataFrame, params: dict | None = None, evaluate: bool = True):
    """Decision tree on (color, product) -> label from a weighted histogram
    ``(color, product, label, is_train, n)``.

    Returns ``(model, indexer_model, test_accuracy, histogram)``.  The
    accuracy is agreement with the seed rule on the held-out split (NaN if
    that is empty).
    """
    params = {**TREE_PARAMS, **(params or {})}
    hist = cut_lineage(assemble(hist.withColumn("n", F.col("n").cast("double")),
                                ["color", "product"], "raw_features"))
    # |colours| x |products| x 4 rows at most; if that is few, read the
    # materialised copy as one partition
    rows, train_rows = hist.agg(F.count(F.lit(1)), F.count_if("is_train")).first()
    if rows <= SMALL_HISTOGRAM:
        hist = hist.coalesce(1)
    if not train_rows:
        raise EmptyTrainingData("no order lines in the training split")
    indexer = VectorIndexer(inputCol="raw_features", outputCol="features",
                            maxCategories=MAX_CATEGORIES).fit(hist)
    feats = indexer.transform(hist)
    tree = DecisionTreeClassifier(featuresCol="features", labelCol="label", weightCol="n",
                                  predictionCol="prediction", **params)
    model = tree.fit(feats.where("is_train"))
    test = model.transform(feats.where("not is_train"))
    acc = float("nan")
    if evaluate and test.limit(1).count():
        acc = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                                weightCol="n", metricName="accuracy").evaluate(test)
    return model, indexer, acc, hist


def training_histogram(lines: DataFrame, split_keys: list[str], train_pct: int = 80,
                       method: str = "xxhash64") -> DataFrame:
    """(color, product, label, is_train, n) from order lines with a
    deterministic per-line split; partially aggregated, so the lines are read
    and never written."""
    split = hash_split(lines, split_keys, train_pct, method=method)
    return split.groupBy("color", "product", "label", "is_train").agg(F.count(F.lit(1)).alias("n"))


def train_gender_tree(lines: DataFrame, split_keys: list[str], train_pct: int = 80,
                      params: dict | None = None, evaluate: bool = True, method: str = "xxhash64"):
    """The tree from order lines (see ``training_histogram`` and
    ``fit_gender_tree``)."""
    return fit_gender_tree(training_histogram(lines, split_keys, train_pct, method), params, evaluate)


def tree_holdout_metrics(lines: DataFrame, split_keys: list[str], method: str = "xxhash64") -> DataFrame:
    """Held-out accuracy / weighted precision, recall and F1 of the tree
    against the seed labels, from the weighted confusion matrix of the test
    side of the histogram (one row)."""
    from tagsmith.operators.evaluate import confusion_metrics
    model, indexer, _acc, hist = train_gender_tree(lines, split_keys, evaluate=False, method=method)
    test = model.transform(indexer.transform(hist.where("not is_train")))
    cm = test.groupBy(F.col("label").cast("double").alias("l"), F.col("prediction").alias("p")) \
        .agg(F.sum("n").cast("long").alias("n"))
    return confusion_metrics(cm)


def usg_tag(lines: DataFrame, orders: DataFrame, rules: DataFrame, line_order_col: str,
            order_col: str, user_of_order: str, split_keys: list[str], tag_col: str = "usg",
            user_col: str = "userId", train_pct: int = 80, method: str = "xxhash64",
            keep_counts: bool = False) -> DataFrame:
    """End to end: lines with ``color``, ``product``, ``label`` -> tree ->
    per-pair prediction -> per-user vote -> tag.  No lines, no tags.

    Two passes over the lines, neither written: one counts them into the
    training histogram (a few hundred rows), the other joins each line with
    the class predicted for its (colour, product) pair and votes.  Pass
    ``recent_orders(...)`` to vote over a look-back window."""
    try:
        model, indexer, _acc, hist = train_gender_tree(lines, split_keys, train_pct, evaluate=False, method=method)
    except EmptyTrainingData:
        empty = orders.select(F.col(user_of_order).alias(user_col)).limit(0)
        for c in ("total", "male", "female") if keep_counts else ():
            empty = empty.withColumn(c, F.lit(None).cast("long"))
        return empty.withColumn(tag_col, F.lit(None).cast("string"))
    pairs = hist.select("color", "product", "raw_features").dropDuplicates(["color", "product"])
    pred = model.transform(indexer.transform(pairs)).select(
        "color", "product", F.col("prediction").cast("int").alias("_cls"))
    # one prediction per distinct (color, product) pair of the histogram
    scored = join_small(lines.select(line_order_col, "color", "product"), pred, ["color", "product"], "inner", bound_from=hist.select("color", "product"))
    votes = gender_votes(scored, orders, line_order_col, order_col, user_of_order, "_cls", user_col)
    return vote_tag(votes, rules, tag_col, user_col, keep_counts=keep_counts)

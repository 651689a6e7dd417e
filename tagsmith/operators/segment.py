"""KMeans segmentation of score vectors, and the cluster -> tag mapping.

Scores take a handful of values each (1..5), so R/F/M score triples have at
most 5**3 = 125 distinct values whatever the number of users.  The model is
therefore trained on the weighted histogram ``(r, f, m, n)`` — the same
objective as one row per user, since a point's weight multiplies its squared
distance — and each user gets its tag through a broadcast join of its score
triple against the <=125-row triple -> tag table.  The user table is read
once for the histogram and once for the final join; no per-user vector is
materialised and no iteration touches it.

A saved model is the whole pipeline (assembler, scaler if any, KMeans), so a
score vector has the same tag under it on every day.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import MinMaxScaler, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagsmith.operators.joins import join_small
from tagsmith.operators.lineage import cut_lineage
from tagsmith.sources.literal import local_frame
from tagsmith.sources.store import load_or_train

# fixed values: the reference's KMeans trials (maxIter 5, 10, 20) and seed 31
MAX_ITERS = (5, 10, 20)
SEED = 31
# a histogram of at most this many rows is trained on as one partition
SMALL_HISTOGRAM = 10_000


def assemble(df: DataFrame, cols: list[str], out: str = "features",
             handle_invalid: str = "error") -> DataFrame:
    """VectorAssembler; a null input raises unless ``handle_invalid`` is
    ``skip`` or ``keep``."""
    return VectorAssembler(inputCols=list(cols), outputCol=out,
                           handleInvalid=handle_invalid).transform(df)


def score_histogram(scores: DataFrame, cols: list[str], weight_col: str = "n") -> DataFrame:
    """Distinct score vectors with their user counts (rows with a null score
    are left out: they cannot be placed in feature space)."""
    return (scores.dropna(subset=list(cols)).groupBy(*cols)
            .agg(F.count(F.lit(1)).alias(weight_col)))


def fit_kmeans(data: DataFrame, k: int, max_iters=MAX_ITERS, seed: int = SEED, weight_col: str | None = "n",
               parallelism: int | None = None) -> tuple[KMeansModel, list[tuple[float, int]]]:
    """Fit one model per ``maxIter`` on ``features`` and keep the lowest
    training cost (WSSSE; ties keep the earlier trial).  The trials are
    independent, so they are submitted as concurrent Spark jobs (like
    ``CrossValidator``'s ``parallelism``); pass materialised data.
    Returns ``(best_model, [(cost, maxIter), ...])``."""
    from concurrent.futures import ThreadPoolExecutor

    def fit(it: int) -> KMeansModel:
        km = KMeans(k=k, maxIter=it, seed=seed, featuresCol="features", predictionCol="prediction",
                    solver="row")  # the row solver also takes fewer distinct points than k
        if weight_col:
            km = km.setWeightCol(weight_col)
        return km.fit(data)

    iters = list(max_iters)
    with ThreadPoolExecutor(max_workers=max(1, parallelism or len(iters))) as pool:
        models = list(pool.map(fit, iters))
    trials = [(m.summary.trainingCost, it) for m, it in zip(models, iters)]
    best = min(range(len(models)), key=lambda i: (trials[i][0], i))
    return models[best], trials


def feature_stages(cols: list[str], scale: bool) -> Pipeline:
    """Score columns -> ``features``, optionally min-max scaled to [0, 1]."""
    if not scale:
        return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="features")])
    return Pipeline(stages=[VectorAssembler(inputCols=list(cols), outputCol="raw_features"),
                            MinMaxScaler(inputCol="raw_features", outputCol="features", min=0.0, max=1.0)])


def center_ranks(centers) -> list[tuple[int, int]]:
    """``(cluster index, rank)``: rank 0 = largest component sum (highest
    value); equal sums keep the lower index first.  ``centers`` has k entries,
    k = number of tags, so this is a driver-side list of a few vectors."""
    sums = [(i, float(sum(c))) for i, c in enumerate(centers)]
    order = sorted(sums, key=lambda t: (-t[1], t[0]))
    return [(i, rank) for rank, (i, _) in enumerate(order)]


def center_tag_table(spark: SparkSession, centers, rules: DataFrame) -> DataFrame:
    """``(prediction, tag)``: the rank of each centre matched to the level-5
    rule with that index (rule ``"0"`` = rank 0)."""
    ranks = local_frame(spark, center_ranks(centers), "prediction int, rank int")
    r = rules.select(F.col("rule").alias("_rule"), F.col("name").alias("tag"))
    return join_small(ranks, r, F.col("rank").cast("string") == F.col("_rule"), "left") \
        .select("prediction", "tag")


def segment_model(scores: DataFrame, hist: DataFrame, score_cols: list[str], k: int, max_iters=MAX_ITERS,
                  seed: int = SEED, model_path: str | None = None, weighted: bool = True,
                  scale: bool = False) -> PipelineModel:
    """The saved pipeline at ``model_path``, or one trained (and saved
    there) on the histogram (``weighted``) or on one row per user.  The
    histogram must be materialised; a bounded one is trained on as a single
    partition, a larger one in parallel."""
    def train() -> PipelineModel:
        prepare = feature_stages(score_cols, scale).fit(hist)
        if weighted:
            data = hist.coalesce(1) if hist.count() <= SMALL_HISTOGRAM else hist
            best = fit_kmeans(prepare.transform(data), k, max_iters, seed)[0]
        else:
            data = prepare.transform(scores.select(*score_cols).dropna())
            best = fit_kmeans(data, k, max_iters, seed, weight_col=None)[0]
        return PipelineModel([*prepare.stages, best])
    if not model_path:
        return train()

    def record() -> dict:
        rows, mark = hist.agg(F.count(F.lit(1)), F.sum(F.xxhash64(*score_cols, "n").cast("decimal(38,0)"))).first()
        return {"vectors": rows, "fingerprint": str(mark)}
    return load_or_train(model_path, PipelineModel, train, {"columns": list(score_cols), "clusters": k, "scale": scale}, record)


def vector_tags(model: PipelineModel, hist: DataFrame, score_cols: list[str], rules: DataFrame, k: int,
                tag_col: str) -> DataFrame:
    """``(score_cols, prediction, tag_col)``: the tag of each distinct score
    vector.  A model may have fewer centres than there are rules (KMeans
    merges coinciding points): the ranks that exist are named."""
    centers = model.stages[-1].clusterCenters()
    if len(centers) > k:
        raise ValueError(f"the model has {len(centers)} clusters, the rules name {k}")
    tags = center_tag_table(hist.sparkSession, centers, rules).withColumnRenamed("tag", tag_col)
    placed = model.transform(hist.select(*score_cols)).select(*score_cols, "prediction")
    return placed.join(F.broadcast(tags), "prediction", "left").select(*score_cols, "prediction", tag_col)  # at most k rows


def segment_by_kmeans(scores: DataFrame, score_cols: list[str], rules: DataFrame, tag_col: str,
                      id_col: str = "userId", max_iters=MAX_ITERS, seed: int = SEED,
                      model_path: str | None = None, weighted: bool = True, scale: bool = False) -> DataFrame:
    """``(userId, tag_col)`` by KMeans over score vectors, with
    k = number of level-5 rules and clusters named by centre rank.  A user
    with a null score has no place among the clusters and a null tag.

    ``weighted=True`` trains on the weighted histogram of distinct score
    vectors (same objective, work independent of the number of users);
    ``weighted=False`` trains on one row per user, as the reference does, and
    every iteration then reads every user.  ``scale=True`` min-max scales the
    features to [0, 1] first (the reference's documented tuning option).  With
    ``model_path`` a saved model, scaler included, is always used as it is."""
    k = rules.count()
    if k < 2:
        raise ValueError("segmentation needs at least two level-5 rules")
    # the per-user scores are read twice (histogram, final join): materialise
    # them once in the checkpoint folder instead of recomputing the metrics
    scores = cut_lineage(scores.select(id_col, *score_cols))
    hist = cut_lineage(score_histogram(scores, score_cols))
    if hist.isEmpty():  # no vector to cluster
        return scores.select(id_col, F.lit(None).cast("string").alias(tag_col))
    model = segment_model(scores, hist, score_cols, k, max_iters, seed, model_path, weighted, scale)
    mapping = vector_tags(model, hist, score_cols, rules, k, tag_col).drop("prediction")
    # one row per distinct score vector
    return join_small(scores, mapping, list(score_cols), "left", bound_from=hist).select(id_col, tag_col)


def segment_report(scores: DataFrame, score_cols: list[str], rules: DataFrame, id_col: str = "userId") -> DataFrame:
    """One row of facts about a fresh segmentation: users, users with a tag,
    distinct vectors, vectors that hold two tags, vectors whose tag is not
    that of the nearest centre, and neighbouring ranks whose centre sums are
    in the wrong order (the last three are 0)."""
    k = rules.count()
    scores = cut_lineage(scores.select(id_col, *score_cols))
    hist = cut_lineage(score_histogram(scores, score_cols))
    model = segment_model(scores, hist, score_cols, k)
    mapping = cut_lineage(vector_tags(model, hist, score_cols, rules, k, "tag"))
    tagged = join_small(scores, mapping.drop("prediction"), list(score_cols), "left", bound_from=hist)
    users = tagged.groupBy(*score_cols, "tag").agg(F.count(F.lit(1)).alias("n"))
    per_vector = users.groupBy(*score_cols).agg(F.count_distinct("tag").alias("tags"), F.sum("n").alias("n"),
                                                F.sum(F.when(F.col("tag").isNotNull(), F.col("n")).otherwise(0)).alias("tagged"))
    centers = [tuple(float(x) for x in c) for c in model.stages[-1].clusterCenters()]
    nearest = nearest_center(mapping, score_cols, centers, "near")
    ranks = {i: r for i, r in center_ranks(centers)}
    by_rank = sorted(range(len(centers)), key=ranks.get)
    inversions = sum(sum(centers[a]) < sum(centers[b]) for a, b in zip(by_rank, by_rank[1:]))
    names = join_small(nearest, center_tag_table(scores.sparkSession, centers, rules)
                       .select(F.col("prediction").alias("near"), F.col("tag").alias("near_tag")), "near", "left")
    wrong = names.where(~F.col("tag").eqNullSafe(F.col("near_tag"))).count()
    return per_vector.agg(F.sum("n").alias("users"), F.sum("tagged").alias("tagged"), F.count(F.lit(1)).alias("vectors"),
                          F.count_if(F.col("tags") > 1).alias("two_tags"), F.lit(wrong).cast("long").alias("not_nearest"),
                          F.lit(inversions).cast("long").alias("inversions"))


# --- deterministic sub-steps with given centres (SQL-checkable) ---

def _sq_dists(cols: list[str], centers) -> list:
    out = []
    for c in centers:
        d = None
        for col, v in zip(cols, c):
            term = (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
            d = term if d is None else d + term
        out.append(d)
    return out


def nearest_center(df: DataFrame, cols: list[str], centers, out: str = "prediction",
                   dist_col: str | None = None) -> DataFrame:
    """Index of the nearest centre (squared Euclidean; ties -> lower index)."""
    ds = F.array(*_sq_dists(cols, centers))
    res = df.withColumn("_d", ds).withColumn(out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int"))
    if dist_col:
        res = res.withColumn(dist_col, F.array_min("_d"))
    return res.drop("_d")


def _weight(weight_col: str | None):
    return F.lit(1) if weight_col is None else F.col(weight_col)


def wssse(df: DataFrame, cols: list[str], centers, weight_col: str | None = None) -> DataFrame:
    """Within-set sum of squared errors for given centres (one row).  With
    ``weight_col`` a row stands for that many points (a score histogram)."""
    d, w = nearest_center(df, cols, centers, dist_col="_dist"), _weight(weight_col)
    return d.agg(F.sum(F.col("_dist") * w).alias("wssse"), F.sum(w.cast("long")).alias("points"))


def update_centers(assigned: DataFrame, cols: list[str], pred_col: str = "prediction",
                   weight_col: str | None = None) -> DataFrame:
    """One Lloyd step: each centre moves to the (weighted) mean of its points."""
    w = _weight(weight_col)
    return assigned.groupBy(pred_col).agg(*[(F.sum(F.col(c) * w) / F.sum(w)).alias(c) for c in cols],
                                          F.sum(w.cast("long")).alias("points"))


def rank_centers(centers_df: DataFrame, cols: list[str], rules: DataFrame, pred_col: str = "prediction",
                 tag_col: str = "tag") -> DataFrame:
    """Centres (one row each) ranked by descending component sum, ties by
    index, each matched to the rule with its rank.  k rows."""
    from pyspark.sql import Window
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    ranked = centers_df.withColumn("center_sum", total).withColumn(
        "rank", F.row_number().over(Window.orderBy(F.col("center_sum").desc(), F.col(pred_col))) - 1)
    r = rules.select(F.col("rule").alias("_rule"), F.col("name").alias(tag_col))
    return join_small(ranked, r, F.col("rank").cast("string") == F.col("_rule"), "left").drop("_rule")


def cluster_profile(assigned: DataFrame, cols: list[str], pred_col: str = "prediction",
                    weight_col: str | None = None) -> DataFrame:
    """Per cluster: users and the max / min total score."""
    total = sum((F.col(c) for c in cols[1:]), F.col(cols[0]))
    return assigned.groupBy(pred_col).agg(
        F.sum(_weight(weight_col).cast("long")).alias("users"), F.max(total).alias("max_score"), F.min(total).alias("min_score"))


__all__ = [
    "assemble", "score_histogram", "feature_stages", "fit_kmeans", "segment_model", "segment_report", "vector_tags", "center_ranks", "center_tag_table",
    "segment_by_kmeans", "nearest_center", "wssse", "update_centers", "rank_centers",
    "cluster_profile", "MAX_ITERS", "SEED",
]

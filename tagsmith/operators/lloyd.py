"""KMeans without randomness: seeds and steps that depend on the data alone.

The input is a weighted histogram of score vectors.  The first seed is the
heaviest vector, each further one the vector with the largest weight times
squared distance to its nearest seed (ties: the smallest vector), so neither
partitions nor retries change a centre.  Lloyd steps are one aggregation each;
sums are taken over decimals, whose order does not matter.  At the end the
residual of one more step proves the fixed point.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagsmith.operators.segment import nearest_center

EXACT = "decimal(38,12)"


def _nearest_sq(cols: list[str], centers) -> Column:
    """Squared distance to the nearest centre."""
    sq = []
    for c in centers:
        d = None
        for col, v in zip(cols, c):
            term = (F.col(col) - F.lit(float(v))) * (F.col(col) - F.lit(float(v)))
            d = term if d is None else d + term
        sq.append(d)
    return F.array_min(F.array(*sq))


def seed_centers(hist: DataFrame, cols: list[str], k: int, weight_col: str = "n") -> list[tuple[float, ...]]:
    """Up to ``k`` distinct vectors of the histogram; each is one partially
    aggregated maximum."""
    seeds: list[tuple[float, ...]] = []
    smallest = [F.negate(F.col(c).cast("double")) for c in cols]
    for _ in range(k):
        far = F.col(weight_col).cast("double") * _nearest_sq(cols, seeds) if seeds else F.col(weight_col).cast("double")
        best = hist.agg(F.max(F.struct(far.alias("far"), *[c.alias(f"x{i}") for i, c in enumerate(smallest)])).alias("best")).first().best
        if best is None or best.far <= 0:
            break
        seeds.append(tuple(-v + 0.0 for v in best[1:]))
    return seeds


def lloyd_step(hist: DataFrame, cols: list[str], centers, weight_col: str = "n") -> list[tuple[float, ...]]:
    """Each centre moved to the weighted mean of its vectors (one without
    vectors stays)."""
    w = F.col(weight_col).cast("decimal(20,0)")
    placed = nearest_center(hist, cols, centers)
    sums = placed.groupBy("prediction").agg(*[F.sum((F.col(c).cast(EXACT) * w).cast(EXACT)).cast("double").alias(c) for c in cols],
                                            F.sum(w).cast("double").alias("_w"))
    moved = {r.prediction: tuple(r[c] / r["_w"] for c in cols) for r in sums.collect()}  # at most k rows
    return [moved.get(i, tuple(map(float, c))) for i, c in enumerate(centers)]


def fit_lloyd(hist: DataFrame, cols: list[str], k: int, max_iter: int = 20, weight_col: str = "n") -> tuple[list[tuple[float, ...]], int]:
    """(centres, steps taken) from ``seed_centers`` until no centre moves or
    ``max_iter`` steps.  ``hist`` must be materialised; rows with a null score
    must be gone."""
    centers = seed_centers(hist, cols, k, weight_col)
    for i in range(max_iter):
        moved = lloyd_step(hist, cols, centers, weight_col) if centers else centers
        if moved == centers:
            return centers, i
        centers = moved
    return centers, max_iter


def lloyd_residual(hist: DataFrame, cols: list[str], centers, weight_col: str = "n") -> float:
    """How far one more step would move any coordinate of any centre: 0 for a
    fixed point, and for no other centres."""
    moved = lloyd_step(hist, cols, centers, weight_col)
    return max((abs(a - b) for x, y in zip(centers, moved) for a, b in zip(x, y)), default=0.0)

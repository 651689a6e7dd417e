"""Total order over any number of rows: ranks, positions and exact quantiles.

Values are counted first (partial aggregation, so a value that a third of the
rows share is one row), the histogram is range-partitioned by value, and each
partition's rows are numbered on their own from an offset, the sum of the
partitions before it.  Only those sums, one number per partition, pass through
the driver; no window or sort ever sees all rows in one task.
"""

from __future__ import annotations

import math
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagsmith.functions.scores import Bands
from tagsmith.operators.lineage import cut_lineage
from tagsmith.sources.literal import local_frame


def value_counts_of(df: DataFrame, cols: list[str], out: str = "_n") -> DataFrame:
    """Distinct non-null values of ``cols`` with their row counts."""
    return df.dropna(subset=cols).groupBy(*cols).agg(F.count(F.lit(1)).alias(out))


def running_total(counts: DataFrame, order: list[Column], count_col: str = "_n", out: str = "_before") -> tuple[DataFrame, int]:
    """``counts`` with ``out``, the sum of ``count_col`` over all rows that
    sort before the row, and the sum over all rows.  The sort keys must be
    distinct per row (as those of a histogram are).

    The partition a row was dealt to is stored with it before it is read
    again, so a recomputed task cannot move it."""
    spark = counts.sparkSession
    dealt = cut_lineage(counts.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    sums = sorted(tuple(r) for r in dealt.groupBy("_part").agg(F.sum(count_col)).collect())  # one row per partition
    offsets, total = [], 0
    for part, n in sums:
        offsets.append((part, total))
        total += n
    if not offsets:
        return dealt.drop("_part").withColumn(out, F.lit(0).cast("long")), 0
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    starts = F.broadcast(local_frame(spark, offsets, "_part int, _start bigint"))  # a row per partition
    placed = dealt.join(starts, "_part").withColumn(out, F.col("_start") + F.coalesce(F.sum(count_col).over(inside), F.lit(0)))
    return placed.drop("_part", "_start"), total


def rank_by(df: DataFrame, col: str, descending: bool = True, out: str = "rank", total_out: str | None = None) -> DataFrame:
    """``df`` with the rank of ``col`` (1 + rows with a better value; equal
    values share a rank, a null has none) and, on request, the number of
    ranked rows."""
    counts = value_counts_of(df, [col])
    placed, total = running_total(counts, [F.col(col).desc() if descending else F.col(col).asc()])
    ranks = cut_lineage(placed.select(F.col(col).alias("_value"), (F.col("_before") + 1).cast("long").alias(out)))
    ranked = df.join(ranks, F.col(col) == F.col("_value"), "left").drop("_value")  # one side has each value once: AQE splits hot values
    return ranked.withColumn(total_out, F.lit(total).cast("long")) if total_out else ranked


def number_rows(df: DataFrame, order: list[Column], out: str = "position") -> DataFrame:
    """``df`` with the position (from 1) of each row in the total order
    ``order``, whose keys must tell all rows apart."""
    placed, _ = running_total(df.withColumn("_n", F.lit(1).cast("long")), order)
    return placed.withColumn(out, F.col("_before") + 1).drop("_n", "_before")


def quantiles(df: DataFrame, col: str, shares: list[float]) -> list:
    """Exact discrete quantiles: for each share q of the n non-null values
    the smallest value with at least ceil(q n) values up to it (SQL's
    ``percentile_disc``); ``None`` for each if there is no value."""
    placed, total = running_total(value_counts_of(df, [col]), [F.col(col).asc()])
    if not total:
        return [None] * len(shares)
    wanted = [max(1, math.ceil(Fraction(str(q)) * total)) for q in shares]
    hit = None
    for k in set(wanted):
        one = (F.col("_before") < k) & (F.col("_before") + F.col("_n") >= k)
        hit = one if hit is None else hit | one
    rows = placed.where(hit).select(col, "_before", "_n").collect()  # at most one per share
    return [next(r[0] for r in rows if r[1] < k <= r[1] + r[2]) for k in wanted]


def fit_bands(df: DataFrame, higher_is_better: dict[str, bool], levels: int = 5) -> dict[str, Bands]:
    """Score bands cut at the data's own quantiles: the values up to the
    1 / ``levels`` quantile are the lowest band, and so on.  A metric whose
    small values are good (recency) scores ``levels`` there.  Equal cuts (a
    value that fills several bands) are merged, keeping the outer score."""
    out = {}
    for col, up in higher_is_better.items():
        cuts = quantiles(df, col, [i / levels if levels not in (5, 10) else round(i / levels, 1) for i in range(1, levels)])
        scores = list(range(1, levels + 1)) if up else list(range(levels, 0, -1))
        uppers, kept = [], []
        for cut, s in zip(cuts, scores):
            if cut is not None and (not uppers or cut > uppers[-1]):
                uppers.append(cut)
                kept.append(s)
        out[col] = Bands(tuple(uppers), tuple(kept + [scores[-1]]))
    return out


def top_values(df: DataFrame, col: str, k: int, slots: int = 65_536) -> DataFrame:
    """``(col, n)``: the ``k`` most frequent non-null values with their exact
    counts, equal counts by value.

    First a bounded summary: row counts of ``slots`` hash slots.  A slot's
    count bounds the count of every value in it.  The values of the fullest
    slots are counted, which gives a k-th best count; then only slots that
    reach it can hold better values, and those are counted too.  The result is
    exact for any data; a column without frequent values makes more slots
    candidates, never drops one."""
    rows = df.select(F.col(col)).where(F.col(col).isNotNull())
    slotted = rows.withColumn("_slot", F.pmod(F.xxhash64(col), F.lit(slots)).cast("int"))
    summary = cut_lineage(slotted.groupBy("_slot").agg(F.count(F.lit(1)).alias("_size")))  # at most ``slots`` rows
    fullest = summary.orderBy(F.desc("_size"), "_slot").limit(4 * k)
    count = lambda some: slotted.join(F.broadcast(some.select("_slot")), "_slot", "left_semi").groupBy(col).agg(F.count(F.lit(1)).alias("n"))
    least = [r.n for r in count(fullest).orderBy(F.desc("n")).limit(k).select("n").collect()]
    bound = least[-1] if len(least) == k else 0
    return count(summary.where(F.col("_size") >= bound)).orderBy(F.desc("n"), F.col(col)).limit(k)

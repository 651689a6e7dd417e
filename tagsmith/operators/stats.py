"""Statistics tags: counts, favourite value, top-n per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagsmith.operators.match import match_tag


# Spark limits each group to n rows before the shuffle (WindowGroupLimit) up to
# this n (spark.sql.optimizer.windowGroupLimitThreshold's default); above it
# the rows of a group are spread over salt buckets first.
WINDOW_GROUP_LIMIT = 1000
SALT_BUCKETS = 64


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int,
                    rank_col: str | None = None, salt_buckets: int | None = None) -> DataFrame:
    """Rows ranked ``1..n`` in each group by ``order`` (make it total to get
    a deterministic answer).

    ``row_number() <= n`` lets Spark insert a WindowGroupLimit that keeps
    only ``n`` rows per group before the shuffle, so a hot group does not
    travel whole to one task.  For ``n`` above Spark's limit threshold (or
    when ``salt_buckets`` is given) the group is first split into salt
    buckets: the top ``n`` of each (group, bucket) is kept, and the final
    ranking sees at most ``buckets * n`` rows per group — exact, because the
    group's top ``n`` is always among the buckets' top ``n``.  Buckets come
    from a hash of the whole row, so a retried task salts the same way."""
    if n < 1:
        raise ValueError("n must be >= 1")
    if salt_buckets is None and n > WINDOW_GROUP_LIMIT:
        salt_buckets = SALT_BUCKETS
    src = df
    if salt_buckets:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(int(salt_buckets)))
        src = (df.withColumn("_salt", salt)
               .withColumn("_rs", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
               .where(F.col("_rs") <= n).drop("_rs", "_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = src.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def favourite_value(df: DataFrame, id_col: str, value_col: str, user_col: str = "userId",
                    value_out: str | None = None, count_col: str = "cnt") -> DataFrame:
    """Most frequent value per user; ties go to the smallest value.

    ``count`` per (user, value) is partially aggregated before its shuffle,
    so a user holding a large share of the rows reaches the window as one row
    per distinct value.
    """
    value_out = value_out or value_col
    counts = (df.groupBy(F.col(id_col).alias(user_col), F.col(value_col).alias(value_out))
              .agg(F.count(F.lit(1)).alias(count_col)))
    return top_n_per_group(counts, [user_col], [F.col(count_col).desc(), F.col(value_out).asc()], 1)


def pay_type_tag(orders: DataFrame, id_col: str, pay_col: str, rules: DataFrame,
                 tag_col: str = "payment", user_col: str = "userId", on_miss: str = "drop") -> DataFrame:
    """Favourite payment code per user, matched to its tag."""
    fav = favourite_value(orders, id_col, pay_col, user_col, "_pay")
    return match_tag(fav, user_col, "_pay", rules, tag_col, on_miss=on_miss, user_col=user_col)


def value_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``(column, value, count)`` for several columns in one scan and one
    shuffle: the columns are stacked into (column, value) pairs first."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]))
    stacked = df.select(pairs.alias("_p")).select("_p.column", "_p.value")
    return stacked.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))

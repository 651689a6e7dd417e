"""Business frames over the supplied test tables.

users -> customer; orders -> orders (payment code := o_orderpriority);
goods -> lineitem joined to part (colour := first word of p_name, product
:= p_type); logs -> events (page := event_type || props).  Each frame selects
only the columns it needs, so the Parquet scans are pruned.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagsmith.sources.literal import local_frame
from tagsmith.operators.shopper import encode_dims, seed_labels
from tagsmith.sources.tables import load_table

# The data ends 2001-08-01 (orders) and 2024-01-30 (events); the clock is the
# day after, so every row is in the past.
ORDERS_AS_OF = dt.date(2001, 8, 2)
EVENTS_AS_OF = dt.date(2024, 1, 31)

# Stand-in dimension tables and seed lists for the shopping-gender model.
COLORS = [(1, "red"), (2, "blue"), (3, "small"), (4, "large"), (5, "new"), (6, "old"), (7, "hot")]
PRODUCTS = [(1, "ECONOMY"), (2, "MEDIUM"), (3, "STANDARD"), (4, "PROMO"), (5, "SMALL"), (6, "LARGE")]
FEMALE_COLORS = ("red", "small")
FEMALE_PRODUCTS = ("PROMO",)


def users(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "customer", ["c_custkey", "c_mktsegment", "c_nationkey"])


def orders(spark: SparkSession, d: str) -> DataFrame:
    return load_table(spark, d, "orders",
                      ["o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority"])


def parts(spark: SparkSession, d: str) -> DataFrame:
    p = load_table(spark, d, "part", ["p_partkey", "p_name", "p_type"])
    return p.select("p_partkey", F.split("p_name", " ").getItem(0).alias("ogcolor"),
                    F.col("p_type").alias("producttype"))


def dims(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return (local_frame(spark, COLORS, "id int, name string"),
            local_frame(spark, PRODUCTS, "id int, name string"))


def encoded_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts with colour / product ids and the seed label.  Encoding is done
    per part (a dimension), not per order line."""
    colors, products = dims(spark)
    p = encode_dims(parts(spark, d), colors, products)
    return seed_labels(p, FEMALE_COLORS, FEMALE_PRODUCTS)


def goods(spark: SparkSession, d: str) -> DataFrame:
    """Order lines with ``color``, ``product``, ``label``: lineitem joined
    to the encoded parts.  The part table grows with the data, so no hint:
    Spark broadcasts it only while its file statistics are under the
    broadcast threshold (or AQE measures it small), else a shuffle join with
    AQE skew splitting."""
    li = load_table(spark, d, "lineitem", ["l_orderkey", "l_linenumber", "l_partkey"])
    p = encoded_parts(spark, d).select("p_partkey", "color", "product", "label")
    return li.join(p, li["l_partkey"] == p["p_partkey"], "inner").drop("p_partkey", "l_partkey")


# share of order lines (percent, by a hash of the line's key) whose seed label is flipped
NOISE_PCT = 15


def noisy_goods(spark: SparkSession, d: str) -> DataFrame:
    """``goods`` with some seed labels flipped, so the label is no function
    of the codes and a tree has to find the majority."""
    key = F.md5(F.concat_ws("|", "l_orderkey", "l_linenumber"))
    flip = F.pmod(F.conv(F.substring(key, 9, 8), 16, 10).cast("long"), F.lit(100)) < NOISE_PCT
    return goods(spark, d).withColumn("label", F.when(flip, 1 - F.col("label")).otherwise(F.col("label")))


def text_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as the reference's stores hold them: every column text, times as
    epoch seconds; some amounts and times malformed."""
    o, k = orders(spark, d), F.col("o_orderkey")
    amount = F.when(k % 97 == 0, "n/a").when(k % 89 == 0, "").otherwise(F.col("o_totalprice").cast("string"))
    time = F.when(k % 83 == 0, "soon").otherwise(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string"))
    return o.select(F.col("o_custkey").cast("string").alias("memberid"), k.cast("string").alias("ordersn"),
                    amount.alias("orderamount"), time.alias("finishtime"))


def logs(spark: SparkSession, d: str) -> DataFrame:
    e = load_table(spark, d, "events", ["user_id", "ts", "event_type", "props"])
    return e.select("user_id", "ts", F.concat("event_type", "props").alias("loc_url"))

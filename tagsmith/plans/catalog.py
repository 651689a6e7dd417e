"""The tag catalogue: level-4 business tags carry a data-source rule, their
level-5 children carry the value, range or class index that earns the tag.

The catalogue is a few dozen rows; it is always handled as a DataFrame and
joined (with a checked broadcast) — never collected into a driver map —
except for the single level-4 rule text of the tag being run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagsmith.sources.literal import local_frame

CATALOG_SCHEMA = "id long, name string, rule string, level int, pid long"


def _src(table: str, fields: str, **extra) -> str:
    lines = ["inType=parquet", f"table={table}", f"selectFieldNames={fields}"]
    lines += [f"{k}={v}" for k, v in extra.items()]
    return "\n".join(lines)


# --- fixed values: tag ids, names and level-5 rules of the reference's tags
# (names given in English).  Level-4 rule texts point at the test tables
# that stand in for its users / orders / goods / logs stores. ---
REFERENCE_TAGS = [
    (318, "gender", None, 4, 314),
    (319, "male", "1", 5, 318), (320, "female", "2", 5, 318),
    (321, "job", None, 4, 314),
    (322, "student", "1", 5, 321), (323, "civil servant", "2", 5, 321), (324, "soldier", "3", 5, 321),
    (325, "police", "4", 5, 321), (326, "teacher", "5", 5, 321), (327, "white-collar", "6", 5, 321),
    (328, "political", None, 4, 314),
    (329, "masses", "1", 5, 328), (330, "party member", "2", 5, 328), (331, "non-partisan", "3", 5, 328),
    (332, "nationality", _src("customer", "c_custkey,c_nationkey"), 4, 314),
    (333, "mainland", "1", 5, 332), (334, "hong kong", "2", 5, 332), (335, "macao", "3", 5, 332),
    (336, "taiwan", "4", 5, 332), (337, "other", "5", 5, 332),
    (338, "age band", _src("orders", "o_custkey,o_orderdate"), 4, 314),
    (339, "50s", "19500101-19591231", 5, 338), (340, "60s", "19600101-19691231", 5, 338),
    (341, "70s", "19700101-19791231", 5, 338), (342, "80s", "19800101-19891231", 5, 338),
    (343, "90s", "19900101-19991231", 5, 338), (344, "00s", "20000101-20091231", 5, 338),
    (345, "10s", "20100101-20191231", 5, 338), (346, "20s", "20200101-20291231", 5, 338),
    (347, "consumption cycle", _src("orders", "o_custkey,o_orderdate"), 4, 315),
    (348, "last 7 days", "0-7", 5, 347), (349, "last 2 weeks", "8-14", 5, 347),
    (350, "last month", "15-30", 5, 347), (351, "last 2 months", "31-60", 5, 347),
    (352, "last 3 months", "61-90", 5, 347), (353, "last 4 months", "91-120", 5, 347),
    (354, "last 5 months", "121-150", 5, 347), (355, "last half year", "151-180", 5, 347),
    (356, "payment", _src("orders", "o_custkey,o_orderpriority"), 4, 315),
    (357, "alipay", "1-URGENT", 5, 356), (358, "wxpay", "2-HIGH", 5, 356),
    (359, "chinapay", "3-MEDIUM", 5, 356), (360, "cod", "4-NOT SPECIFIED", 5, 356),
    (361, "customer value", _src("orders", "o_custkey,o_orderkey,o_totalprice,o_orderdate"), 4, 316),
    (362, "high value", "0", 5, 361), (363, "upper-middle value", "1", 5, 361),
    (364, "middle value", "2", 5, 361), (365, "lower-middle value", "3", 5, 361),
    (366, "low value", "4", 5, 361),
    (367, "activity", _src("events", "user_id,event_type,props,ts"), 4, 316),
    (368, "very active", "0", 5, 367), (369, "active", "1", 5, 367),
    (370, "inactive", "2", 5, 367), (371, "very inactive", "3", 5, 367),
    (380, "shopping gender", _src("lineitem", "l_orderkey,l_linenumber,l_partkey"), 4, 316),
    (381, "male", "0", 5, 380), (382, "female", "1", 5, 380), (383, "neutral", "-1", 5, 380),
]

# Stand-in match tag for the test tables (users have a market segment, not
# a gender): AUTOMOBILE deliberately has no rule, to exercise the miss path.
STANDIN_TAGS = [
    (390, "market segment", _src("customer", "c_custkey,c_mktsegment"), 4, 314),
    (391, "furniture", "FURNITURE", 5, 390), (392, "household", "HOUSEHOLD", 5, 390),
    (393, "machinery", "MACHINERY", 5, 390), (394, "building", "BUILDING", 5, 390),
]

ALL_TAGS = REFERENCE_TAGS + STANDIN_TAGS


def catalog(spark: SparkSession, rows=None) -> DataFrame:
    return local_frame(spark, rows or ALL_TAGS, CATALOG_SCHEMA)


def tag_lookup(tags: DataFrame, tag_id: int) -> DataFrame:
    """The tag and its children, distinct, ordered by level then id."""
    return (tags.where((F.col("id") == tag_id) | (F.col("pid") == tag_id))
            .select("id", "name", "rule", "level").distinct().orderBy("level", "id"))


def attribute_rules(tags: DataFrame, tag_id: int) -> DataFrame:
    """Level-5 children of ``tag_id``: ``(id, name, rule)``."""
    return tags.where((F.col("pid") == tag_id) & (F.col("level") == 5)).select("id", "name", "rule")


def business_rule(tags: DataFrame, tag_id: int) -> str:
    """The level-4 rule text of ``tag_id`` (a single metadata row)."""
    row = tags.where((F.col("id") == tag_id) & (F.col("level") == 4)).select("rule").first()
    if row is None or not row["rule"]:
        raise ValueError(f"tag {tag_id} has no level-4 rule")
    return row["rule"]


def values_sql(rows, cols: list[str]) -> str:
    """A literal ``(VALUES ...) AS t(cols)`` for the SQL oracles."""
    def lit(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(VALUES {body}) AS t({', '.join(cols)})"


def rules_of(tag_id: int, rows=None) -> list[tuple]:
    """(id, name, rule) of the level-5 children, from the fixture rows."""
    return [(i, n, r) for (i, n, r, lvl, p) in (rows or ALL_TAGS) if p == tag_id and lvl == 5]

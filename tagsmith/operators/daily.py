"""Daily state that merges forward: RFM metrics and distinct pages over a
look-back window without reading the history again.

Every day's rows are reduced once to one partial per (user, day) and stored.
The state of a day holds one row per user for the look-back window that ends
there.  The next day's state is yesterday's plus the new day's partials minus
the partials that leave the window: counts and decimal sums are exact under
subtraction, and the last event of a user with events left in the window is
the later of the two known ones.  So a refresh reads one new day of rows, two
days of partials and the state.

Distinct pages cannot be subtracted; their partials are mergeable sketches per
(user, day), united over the days of the window.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagsmith.functions.dates import as_date, before_as_of, days_since
from tagsmith.operators.rfx import amount
from tagsmith.sources.commits import publish, read_commit
from tagsmith.sources.store import is_committed

# sketches of 2^12 registers: standard error 1.04 / sqrt(2^12) = 1.6 %
SKETCH_BITS = 12
MONEY = "decimal(30,2)"


def rows_of_days(df: DataFrame, ts_col: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows with ``first <= day(ts_col) <= last``, as a range of the time
    column so that typed columns push it down to the scan."""
    out = before_as_of(df, ts_col, last + dt.timedelta(days=1))
    low = F.lit(dt.datetime.combine(first, dt.time()).isoformat(sep=" ")).cast(out.schema[ts_col].dataType)
    return out.where(F.col(ts_col) >= low)


def order_partials(orders: DataFrame, id_col: str, order_col: str, amount_col: str, ts_col: str, first, last,
                   user_col: str = "userId") -> DataFrame:
    """``(userId, day, last, frequency, monetary)``: one row per user and day
    of the days ``first`` to ``last``.  A null user is a user; null or
    malformed amounts add nothing, null or malformed times are no event."""
    src = rows_of_days(orders, ts_col, as_date(first), as_date(last))
    return src.groupBy(F.col(id_col).alias(user_col), F.to_date(ts_col).alias("day")).agg(
        F.max(ts_col).alias("last"), F.count(order_col).alias("frequency"), F.count(F.lit(1)).alias("events"),
        F.coalesce(F.sum(amount(src, amount_col)), F.lit(0)).cast(MONEY).alias("monetary"),
        F.count(amount(src, amount_col)).alias("paid"))


def page_partials(logs: DataFrame, id_col: str, url_col: str, ts_col: str, first, last, user_col: str = "userId") -> DataFrame:
    """``(userId, day, last, visits, pages)``: one row per user and day,
    ``pages`` a mergeable sketch of the distinct pages.  Visits of one page are
    counted before they reach the sketch, so a user's hot page is one row."""
    src = rows_of_days(logs, ts_col, as_date(first), as_date(last))
    per_page = src.groupBy(F.col(id_col).alias(user_col), F.to_date(ts_col).alias("day"), F.col(url_col).cast("string").alias("_page")).agg(
        F.max(ts_col).alias("_last"), F.count(url_col).alias("_n"))
    return per_page.groupBy(user_col, "day").agg(
        F.max("_last").alias("last"), F.sum("_n").alias("visits"),
        F.hll_sketch_agg("_page", F.lit(SKETCH_BITS)).alias("pages"))


class DailyStore:
    """Folders of a daily state: ``start`` (the partials of the first window,
    partitioned by day), ``partials/day=D`` and ``state/day=D``.  Each is
    written whole; one without its commit marker is written again."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, kind: str, day: dt.date) -> str:
        return f"{self.base}/{kind}/day={day.isoformat()}"

    def has(self, kind: str, day: dt.date) -> bool:
        return is_committed(self.spark, self.path(kind, day))

    def write(self, kind: str, day: dt.date, df: DataFrame) -> None:
        df.write.mode("overwrite").parquet(self.path(kind, day))

    def read(self, kind: str, day: dt.date) -> DataFrame:
        return self.spark.read.parquet(self.path(kind, day))

    def started(self) -> tuple[dt.date, dt.date] | None:
        """First and last day of the start, if there is one."""
        found = read_commit(self.spark, self.base, 0)
        return found and (as_date(found["first"]), as_date(found["last"]))

    def start(self, partials: DataFrame, first: dt.date, last: dt.date) -> None:
        """Store the partials of many days in one job."""
        if self.started() is None:
            partials.repartition("day").write.mode("overwrite").partitionBy("day").parquet(f"{self.base}/start")
            publish(self.spark, self.base, {"first": first.isoformat(), "last": last.isoformat()}, 0)
        elif self.started() != (first, last):
            raise ValueError(f"the store starts with {self.started()}")

    def partials(self, *days: dt.date) -> DataFrame:
        """The partials of some days; raises for a day that was never added."""
        start = self.started()
        early = [d for d in days if start and start[0] <= d <= start[1]]
        late = [d for d in days if d not in early]
        missing = [d for d in late if not self.has("partials", d)]
        if missing:
            raise FileNotFoundError(f"no partials of {min(missing)}")
        parts = [self.spark.read.parquet(*[self.path("partials", d) for d in late])] if late else []
        if early:
            whole = self.spark.read.parquet(f"{self.base}/start")
            parts.append(whole.where(F.col("day").between(F.lit(min(early)), F.lit(max(early))) & F.col("day").isin(early)).drop("day"))
        return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _merged(parts: list[DataFrame], user_col: str) -> DataFrame:
    """Signed partials added up; users without an event left go."""
    stacked = parts[0]
    for p in parts[1:]:
        stacked = stacked.unionByName(p)
    total = stacked.groupBy(user_col).agg(
        F.max("last").alias("last"), F.sum("frequency").alias("frequency"), F.sum("events").alias("events"),
        F.sum("monetary").cast(MONEY).alias("monetary"), F.sum("paid").alias("paid"))
    return total.where("events > 0")


def start_state(store: DailyStore, orders: DataFrame, day, lookback_days: int, id_col: str, order_col: str, amount_col: str,
                ts_col: str, user_col: str = "userId") -> None:
    """The first state, of the window of ``lookback_days`` days that ends
    with ``day``; the only step that reads the window's rows."""
    day = as_date(day)
    if store.has("state", day):
        return
    first = day - dt.timedelta(days=int(lookback_days) - 1)
    store.start(order_partials(orders, id_col, order_col, amount_col, ts_col, first, day, user_col), first, day)
    days = [first + dt.timedelta(days=i) for i in range(int(lookback_days))]
    store.write("state", day, _merged([store.partials(*days)], user_col))


def advance_state(store: DailyStore, orders: DataFrame, day, lookback_days: int, id_col: str, order_col: str, amount_col: str,
                  ts_col: str, user_col: str = "userId") -> None:
    """The state of ``day`` from that of the day before, reading only the
    rows of ``day``.  Repeating a day changes nothing."""
    day = as_date(day)
    before, leaves = day - dt.timedelta(days=1), day - dt.timedelta(days=int(lookback_days))
    if store.has("state", day):
        return
    if not store.has("state", before):
        raise FileNotFoundError(f"no state of {before}; advance day by day")
    gone = store.partials(leaves)
    if not store.has("partials", day):
        store.write("partials", day, order_partials(orders, id_col, order_col, amount_col, ts_col, day, day, user_col).drop("day"))
    gone = gone.select(user_col, F.lit(None).cast(gone.schema["last"].dataType).alias("last"),
                       *[F.negate(c).cast(gone.schema[c].dataType).alias(c) for c in ("frequency", "events", "monetary", "paid")])
    store.write("state", day, _merged([store.read("state", before), store.partials(day), gone], user_col))


def state_metrics(store: DailyStore, day, user_col: str = "userId") -> DataFrame:
    """``(userId, recency, frequency, monetary)`` of the state of ``day``,
    as ``rfm_metrics`` gives them on the morning after it."""
    day = as_date(day)
    s = store.read("state", day)
    return s.select(user_col, days_since("last", day + dt.timedelta(days=1)).alias("recency"), "frequency",
                    F.when(F.col("paid") > 0, F.col("monetary")).alias("monetary"))


def start_pages(store: DailyStore, logs: DataFrame, first, last, id_col: str, url_col: str, ts_col: str, user_col: str = "userId") -> None:
    """Store the page partials of the days ``first`` to ``last`` in one job."""
    first, last = as_date(first), as_date(last)
    store.start(page_partials(logs, id_col, url_col, ts_col, first, last, user_col), first, last)


def add_page_day(store: DailyStore, logs: DataFrame, day, id_col: str, url_col: str, ts_col: str, user_col: str = "userId") -> None:
    """Store the page partials of ``day``, once; reads only its rows."""
    day = as_date(day)
    if not store.has("partials", day):
        store.write("partials", day, page_partials(logs, id_col, url_col, ts_col, day, day, user_col).drop("day"))


def page_metrics(store: DailyStore, day, lookback_days: int, user_col: str = "userId") -> DataFrame:
    """``(userId, recency, frequency, engagements)`` over the window that
    ends with ``day``, from the stored partials alone.  ``engagements`` is the
    estimate of the united sketches (relative standard error
    1.04 / sqrt(2^SKETCH_BITS))."""
    day = as_date(day)
    days = [day - dt.timedelta(days=i) for i in range(int(lookback_days))]
    return store.partials(*days).groupBy(user_col).agg(F.max("last").alias("_last"), F.sum("visits").alias("frequency"), F.hll_union_agg("pages").alias("_pages")).select(
        user_col, days_since("_last", day + dt.timedelta(days=1)).alias("recency"), "frequency",
        F.hll_sketch_estimate("_pages").alias("engagements"))


__all__ = ["DailyStore", "order_partials", "page_partials", "start_state", "advance_state", "state_metrics", "start_pages", "add_page_day",
           "page_metrics", "rows_of_days", "SKETCH_BITS"]

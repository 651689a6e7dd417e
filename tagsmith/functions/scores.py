"""Score bands: a metric is mapped to a score by an ordered list of upper
bounds.  The CASE chain is built from the band table, so the scoring is a
parameter rather than code, and the default is the reference's rule."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Bands:
    """``value <= uppers[i]`` (``<`` when ``strict``) scores ``scores[i]``;
    anything above the last bound scores ``scores[-1]``.  Bands are total
    (open ends), so a non-null metric always gets a score; null stays null.
    """

    uppers: tuple[float, ...]
    scores: tuple[float, ...]
    strict: bool = False

    def __post_init__(self):
        if len(self.scores) != len(self.uppers) + 1:
            raise ValueError("need exactly one more score than upper bounds")
        if list(self.uppers) != sorted(self.uppers):
            raise ValueError("upper bounds must be ascending")

    def expr(self, value: Column | str) -> Column:
        v = F.col(value) if isinstance(value, str) else value
        out = None
        for ub, score in zip(self.uppers, self.scores):
            cond = (v < F.lit(ub)) if self.strict else (v <= F.lit(ub))
            out = F.when(cond, F.lit(float(score))) if out is None else out.when(cond, F.lit(float(score)))
        return out.when(v.isNotNull(), F.lit(float(self.scores[-1])))

    def sql(self, value_sql: str) -> str:
        """The same CASE chain as SQL text (used by the DuckDB oracles)."""
        op = "<" if self.strict else "<="
        arms = " ".join(f"WHEN {value_sql} {op} {ub} THEN CAST({float(s)} AS DOUBLE)"
                        for ub, s in zip(self.uppers, self.scores))
        return (f"CASE {arms} WHEN {value_sql} IS NOT NULL "
                f"THEN CAST({float(self.scores[-1])} AS DOUBLE) END")


# --- fixed values: the reference's scoring rules, with its range gaps closed ---
# RFM  R (days since last order): <=3 -> 5, <=6 -> 4, <=9 -> 3, <=15 -> 2, else 1
#      F (orders):   <50 -> 1, <100 -> 2, <150 -> 3, <200 -> 4, else 5
#      M (amount):   <10000 -> 1, <50000 -> 2, <100000 -> 3, <200000 -> 4, else 5
# RFE  R (days since last visit): <=15 -> 5, <=30 -> 4, <=45 -> 3, <=60 -> 2, else 1
#      F (visits):   <100 -> 1, <200 -> 2, <300 -> 3, <400 -> 4, else 5
#      E (distinct pages): <50 -> 1, <150 -> 2, <200 -> 3, <250 -> 4, else 5
RFM_BANDS = {
    "recency": Bands((3, 6, 9, 15), (5, 4, 3, 2, 1)),
    "frequency": Bands((50, 100, 150, 200), (1, 2, 3, 4, 5), strict=True),
    "monetary": Bands((10000, 50000, 100000, 200000), (1, 2, 3, 4, 5), strict=True),
}
RFE_BANDS = {
    "recency": Bands((15, 30, 45, 60), (5, 4, 3, 2, 1)),
    "frequency": Bands((100, 200, 300, 400), (1, 2, 3, 4, 5), strict=True),
    "engagements": Bands((50, 150, 200, 250), (1, 2, 3, 4, 5), strict=True),
}

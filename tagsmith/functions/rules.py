"""Tag-rule text as native Column expressions.

* level-4 rule: newline separated ``key=value`` lines naming a data source;
* level-5 rule: a literal to equal (``1``, ``alipay``), an inclusive integer
  range ``lo-hi``, or a class index (``0``..``4``, ``-1``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGE = r"^\s*(\d+)\s*-\s*(\d+)\s*$"


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def rule_options(rule: Column | str) -> Column:
    """``key=value`` lines -> ``map<string,string>``; blank lines are ignored
    and keys and values trimmed, as ``scan_options`` does for one rule."""
    lines = F.filter(F.split(F.regexp_replace(_c(rule), r"\r", ""), "\n"), lambda x: F.trim(x) != "")
    return F.map_from_entries(F.transform(lines, lambda x: F.struct(
        F.trim(F.substring_index(x, "=", 1)).alias("key"),
        F.when(F.contains(x, F.lit("=")), F.trim(F.substr(x, F.position(F.lit("="), x) + 1))).alias("value"))))


def is_range_rule(rule: Column | str) -> Column:
    """True only for ``lo-hi``; ``-1`` (a class rule) and junk are not ranges."""
    return _c(rule).rlike(_RANGE)


def range_start(rule: Column | str) -> Column:
    r = _c(rule)
    return F.when(r.rlike(_RANGE), F.regexp_extract(r, _RANGE, 1).cast("long"))


def range_end(rule: Column | str) -> Column:
    r = _c(rule)
    return F.when(r.rlike(_RANGE), F.regexp_extract(r, _RANGE, 2).cast("long"))

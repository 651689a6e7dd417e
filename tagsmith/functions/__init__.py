"""Column-level helpers: every function returns a native Spark ``Column``
(no Python UDF), so it stays inside whole-stage codegen."""

from tagsmith.functions.scores import Bands, RFE_BANDS, RFM_BANDS
from tagsmith.functions.rules import (
    range_end, range_start, rule_options, is_range_rule,
)
from tagsmith.functions.dates import (
    before_as_of, clock, compact_date, compact_text_date, days_since, epoch_to_ts, event_time,
    is_before_clock, window_bounds, with_event_time,
)

__all__ = [
    "Bands", "RFM_BANDS", "RFE_BANDS",
    "rule_options", "range_start", "range_end", "is_range_rule",
    "compact_date", "compact_text_date", "days_since", "epoch_to_ts", "window_bounds",
    "before_as_of", "clock", "event_time", "is_before_clock", "with_event_time",
]

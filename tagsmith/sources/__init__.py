"""Sources and sinks: stock Spark readers/writers driven by tag rules."""

from tagsmith.sources.tables import load_table
from tagsmith.sources.business import (
    business_scan, condition_filter, parse_condition, rolling_window, rolling_windows, scan_options,
)
from tagsmith.sources.files import read_csv
from tagsmith.sources.literal import local_frame
from tagsmith.sources.catalog_source import read_catalog, read_dimension
from tagsmith.sources.store import (
    load_or_train, read_profile, write_profile,
)

__all__ = [
    "load_table", "business_scan", "condition_filter", "parse_condition",
    "rolling_window", "rolling_windows", "scan_options", "read_csv", "read_catalog", "read_dimension", "load_or_train",
    "read_profile", "write_profile", "local_frame",
]

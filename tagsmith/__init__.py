"""tagsmith — customer-profile tagging on Spark.

Every tag is a DataFrame -> DataFrame function built from Spark SQL and
Spark ML primitives:

* ``operators``  — the tagging operators (match, bands, statistics, RFM/RFE,
  KMeans segmentation, shopping gender, evaluation, profile merge);
* ``functions``  — Column-level helpers (score bands, rule parsing, dates);
* ``sources``    — rule-driven business scans, CSV, profile / model sinks;
* ``plans``      — tag catalogue fixtures, test-table stand-ins, the
  run-a-tag template and the registered query set;
"""

__version__ = "0.1.0"

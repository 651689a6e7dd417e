"""Tag catalogue and dimension tables from any stock source (JDBC, a catalog
table, Parquet ...).  Only the columns a job uses are selected, and for JDBC
the catalogue lookup is pushed into the database as a sub-query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CATALOG_COLUMNS = ("id", "name", "rule", "level", "pid")


def jdbc_catalog_options(options: dict[str, str], tag_id: int | None) -> dict[str, str]:
    """JDBC options that make the database return only ``tag_id`` and its
    children (the ``dbtable`` becomes a ``query``)."""
    options = dict(options)
    if tag_id is not None and "dbtable" in options:
        table = options.pop("dbtable")
        options["query"] = (f"SELECT id, name, rule, level, pid FROM {table} "
                            f"WHERE id = {int(tag_id)} OR pid = {int(tag_id)}")
    return options


def read_catalog(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                 path: str | None = None, tag_id: int | None = None) -> DataFrame:
    """The catalogue as ``(id long, name, rule, level int, pid long)``.

    With ``fmt="jdbc"`` and ``tag_id`` the database returns only that tag and
    its children (``query`` option), so the whole catalogue never crosses the
    wire."""
    options = dict(options or {})
    if fmt == "jdbc":
        options = jdbc_catalog_options(options, tag_id)
    reader = spark.read.format(fmt).options(**options)
    df = reader.load(path) if path else reader.load()
    return df.selectExpr("CAST(id AS BIGINT) AS id", "CAST(name AS STRING) AS name",
                         "CAST(rule AS STRING) AS rule", "CAST(level AS INT) AS level",
                         "CAST(pid AS BIGINT) AS pid")


def read_dimension(spark: SparkSession, fmt: str, options: dict[str, str] | None = None,
                   path: str | None = None, id_col: str = "id", name_col: str = "name") -> DataFrame:
    """A ``(id int, name string)`` dimension (colours, product types)."""
    reader = spark.read.format(fmt).options(**(options or {}))
    df = reader.load(path) if path else reader.load()
    return df.selectExpr(f"CAST({id_col} AS INT) AS id", f"CAST({name_col} AS STRING) AS name")

"""Source tables from CSV files with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.schemas import CSV_TABLES


def read_csv_tables(spark: SparkSession, folder: str, pattern: str = "{table}.csv") -> dict[str, DataFrame]:
    """All source tables by name; `pattern` maps a table name to its file name.

    Columns are found by header name, so files may hold more columns in any order: the header
    line is read for the names and the columns in use are cast; values that do not fit are null.
    """
    out = {}
    for name, schema in CSV_TABLES.items():
        path = f"{folder}/{pattern.format(table=name)}"
        raw = spark.read.option("header", True).option("inferSchema", False).option("escape", '"').csv(path)
        out[name] = raw.select(*[raw[f.name].try_cast(f.dataType).alias(f.name) for f in schema.fields])
    return out

"""Writing and reading the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from surveylake.contract import BRONZE_PERIOD, SILVER_PERIOD, strings
from surveylake.session import open_files

# Periods that a task writes without sorting its rows; each open Parquet file holds up to a row group in memory.
OPEN_PERIODS = 4


def write_bronze(df: DataFrame, path: str, delimiter: str = ",", mode: str = "overwrite") -> None:
    """Delimited text with headers under `year=/month=`; all files have the same columns."""
    df.write.mode(mode).option("header", "true").option("sep", delimiter).partitionBy(*BRONZE_PERIOD).csv(path)


def write_silver(df: DataFrame, path: str, existing: str = "replace", rebalance: bool = True) -> None:
    """Parquet under `ano=/v1013=`.

    `existing` says what becomes of rows already there: `replace` them all, `replace_periods` that `df`
    holds, or `keep` them.

    The rebalance groups rows by period and lets adaptive execution split large periods, so a month that
    holds most rows is written by many tasks and small months do not leave many small files.
    """
    rows = df.hint("rebalance", *SILVER_PERIOD) if rebalance else df
    writer = rows.write.mode("append" if existing == "keep" else "overwrite")
    writer = writer.option("partitionOverwriteMode", "dynamic" if existing == "replace_periods" else "static")
    with open_files(df.sparkSession, OPEN_PERIODS):
        writer.partitionBy(*SILVER_PERIOD).parquet(path)


def read_silver(spark: SparkSession, path: str, schema) -> DataFrame:
    """The silver layer with its period columns as text, not as inferred integers."""
    return spark.read.schema(schema).parquet(path)


def period_directory(spark: SparkSession, path: str, period: tuple, keys=SILVER_PERIOD) -> str:
    """The directory in which Spark writes a period; NULL has one of its own."""
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return "/".join([path, *[names.getPartitionPathString(key, value) for key, value in zip(keys, period)]])


def read_periods(spark: SparkSession, path: str, schema, periods) -> DataFrame:
    """The given periods of a silver layer, all of which it has: only their directories are listed."""
    found = [period_directory(spark, path, period) for period in periods]
    return spark.read.schema(schema).option("basePath", path).parquet(*found)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Unpartitioned Parquet. Adaptive execution already merges the few rows of an aggregate into one file."""
    df.write.mode(mode).parquet(path)


def read_strings(spark: SparkSession, path: str, columns, delimiter: str = ",") -> DataFrame:
    """Delimited text whose files all have the given columns, as strings, with the period columns added."""
    schema = strings([*columns, *BRONZE_PERIOD])
    return spark.read.schema(schema).option("header", "true").option("sep", delimiter).csv(path)


def load_if_present(reader: DataFrameReader, path: str) -> DataFrame | None:
    """What the reader finds at the path, or None where nothing was written yet."""
    try:
        return reader.load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None

"""Databases, external tables, partitions, and SQL over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from surveylake.contract import BRONZE_PERIOD
from surveylake.operators.periods import discover_periods, key_value, missing_periods, period_status
from surveylake.sources.layers import period_directory
from surveylake.sources.manifest import noted_layers, noted_periods
from surveylake.sources.published import published


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> bool:
    """Creates the database if absent; returns whether it did."""
    if spark.catalog.databaseExists(database):
        return False
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`{at}")
    return True


def list_tables(spark: SparkSession, database: str) -> list[str]:
    return sorted(t.name for t in spark.catalog.listTables(database) if not t.isTemporary)


def register_text_table(
    spark: SparkSession,
    database: str,
    table: str,
    schema: T.StructType,
    path: str,
    keys: Sequence[str] = BRONZE_PERIOD,
    delimiter: str = ",",
) -> bool:
    """External table over delimited text with headers; returns whether it was created.

    The table starts without partitions; see `register_partitions`.
    """
    name = f"{database}.{table}"
    if spark.catalog.tableExists(name):
        return False
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    columns += "".join(f", `{key}` string" for key in keys)
    by = f"PARTITIONED BY ({', '.join(keys)})" if keys else ""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING csv "
        f"OPTIONS (header 'true', sep '{delimiter}') {by} LOCATION '{path}'"
    )
    return True


def registered_periods(spark: SparkSession, name: str, keys: Sequence[str] = BRONZE_PERIOD) -> DataFrame:
    """Partitions the catalog knows."""
    shown = spark.sql(f"SHOW PARTITIONS {name}")
    return shown.select(*[F.regexp_extract("partition", f"(?:^|/){key}=([^/]*)", 1).alias(key) for key in keys])


def register_partitions(
    spark: SparkSession, name: str, path: str, keys: Sequence[str] = BRONZE_PERIOD, periods: DataFrame | None = None
) -> list[tuple]:
    """Adds the partitions found below `path` that the catalog lacks; returns (keys..., status) for each found.

    `periods` are those that the layer is known to hold (`noted_periods`); without them its files are listed. One
    statement adds them all; running it again adds nothing.
    """
    found = discover_periods(spark, path, keys) if periods is None else periods.select(*keys)
    status = period_status(found, registered_periods(spark, name, keys), keys)
    found = sorted((tuple(row) for row in status.collect()), key=str)
    added = [row for row in found if row[-1] == "added"]
    parts = []
    for row in added:
        spec = ", ".join(f"{key}='{value}'" for key, value in zip(keys, row))
        where = "/".join(f"{key}={value}" for key, value in zip(keys, row))
        parts.append(f"PARTITION ({spec}) LOCATION '{path}/{where}'")
    if parts:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
    return found


def register_layer(spark: SparkSession, database: str, root: str, prefix: str = "") -> list[str]:
    """One external Parquet table per sub-directory of `root`, with the schema of its files; returns the new names.

    Tables that exist are left alone. Partitioned sub-directories get their partitions registered.
    """
    created = []
    for folder in _sub_directories(spark, root):
        name = f"{database}.{prefix}{folder}"
        if spark.catalog.tableExists(name):
            continue
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{root}/{folder}'")
        if any(column.isPartition for column in spark.catalog.listColumns(name)):
            spark.sql(f"MSCK REPAIR TABLE {name}")
        created.append(f"{prefix}{folder}")
    return created


def register_noted(spark: SparkSession, database: str, root: str, schemas: Mapping[str, T.StructType], prefix: str = "") -> dict[str, list[tuple]]:
    """External Parquet tables over noted layers of a lake, with the partitions that they hold and no other.

    `schemas` has the layers to register, with their columns. Nothing is listed: partitions come from the notes, those
    that the layer no longer holds are dropped from the table, and running it again changes nothing. Returns the
    partitions added to each table.
    """
    changed = {}
    for layer, keys in noted_layers(spark, root):
        if layer not in schemas:
            continue
        table, path = f"{prefix}{layer}".replace("-", "_"), f"{root}/{layer}"
        name = f"{database}.{table}"
        if not spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schemas[layer].fields if f.name not in keys)
            columns += "".join(f", `{key}` string" for key in keys)
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
        held = noted_periods(spark, root, layer, keys).select(*keys)
        known = registered_periods(spark, name, keys).select(*[key_value(F.col(key)).alias(key) for key in keys])
        added, gone = [sorted(map(tuple, df.collect()), key=str) for df in (missing_periods(held, known, keys), missing_periods(known, held, keys))]
        if added:
            parts = [f"PARTITION ({_spec(keys, p)}) LOCATION '{period_directory(spark, path, p, keys)}'" for p in added]
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(parts)}")
        if gone:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(f'PARTITION ({_spec(keys, p)})' for p in gone)}")
        spark.catalog.refreshTable(name)
        changed[table] = added
    return changed


def _spec(keys: Sequence[str], period: tuple) -> str:
    return ", ".join(f"`{key}`=" + ("null" if value is None else f"'{value}'") for key, value in zip(keys, period))


def register_published(spark: SparkSession, database: str, root: str, prefix: str = "") -> list[str]:
    """External Parquet tables over the published version below `root`; returns the names that are new or were moved.

    A table that shows an earlier version is pointed to this one; only its location changes. The folder of the version
    before stays until the next but one is published, so register after each.
    """
    changed = []
    for table, path in sorted(published(spark, root).items()):
        name = f"{database}.{prefix}{table}"
        if not spark.catalog.tableExists(name):
            spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{path}'")
        elif not _location(spark, name).endswith(path.rsplit("/", 2)[1] + f"/{table}"):
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
            spark.catalog.refreshTable(name)
        else:
            continue
        changed.append(f"{prefix}{table}")
    return changed


def _location(spark: SparkSession, name: str) -> str:
    return spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"]


def run_sql(spark: SparkSession, query: str, database: str | None = None, limit: int | None = None) -> DataFrame:
    """An ad-hoc query as a frame, with typed columns; errors are raised, rows are capped only if asked."""
    before = spark.catalog.currentDatabase()
    try:
        # Names are resolved here, so the session's database can be put back before the query runs.
        spark.catalog.setCurrentDatabase(database or before)
        result = spark.sql(query)
    finally:
        spark.catalog.setCurrentDatabase(before)
    return result if limit is None else result.limit(limit)


def _sub_directories(spark: SparkSession, root: str) -> list[str]:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    base = root.rstrip("/").rsplit("/", 1)[-1]
    folder = F.regexp_extract("path", rf"/\Q{base}\E/([^/]+)/", 1)
    found = files.load(root).select(folder.alias("folder")).where("folder != ''").distinct()
    return sorted(row.folder for row in found.collect())

"""Period allow-lists, discovery, and refreshing only the periods a target lacks."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import BRONZE_PERIOD, SILVER_PERIOD, strings
from surveylake.sources.layers import load_if_present, write_silver

# The months read unless others are asked for.
ALLOWED_MONTHS = ("09", "10", "11")

# Every month of a year, for callers that want no month left out.
ALL_MONTHS = tuple(f"{month:02}" for month in range(1, 13))

# The directory Spark writes for a NULL key.
NULL_DIRECTORY = "__HIVE_DEFAULT_PARTITION__"


def period_allowlist(
    df: DataFrame,
    months: Iterable[str] | None = ALLOWED_MONTHS,
    years: Iterable[str] | None = None,
    keys: Sequence[str] = BRONZE_PERIOD,
) -> DataFrame:
    """Rows of the allowed periods. `months=None` means the default months, `ALL_MONTHS` all; `years=None` means any year."""
    year, month = keys
    kept = df.where(F.col(month).isin(*(ALLOWED_MONTHS if months is None else months)))
    return kept if years is None else kept.where(F.col(year).isin(*years))


def periods_of(df: DataFrame, keys: Sequence[str] = SILVER_PERIOD) -> DataFrame:
    return df.select(*keys).distinct()


def discover_periods(
    spark: SparkSession, root: str, keys: Sequence[str] = BRONZE_PERIOD, glob: str = "*"
) -> DataFrame:
    """Distinct key values found in the directory names below `root`. Opens no file; a missing root has none."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    files = load_if_present(reader, root)
    if files is None:
        return spark.createDataFrame([], strings(keys))
    found = files.select(*[F.regexp_extract("path", f"/{key}=([^/]*)/", 1).alias(key) for key in keys])
    named = found.where(reduce(and_, [F.col(key) != "" for key in keys])).distinct()
    return named.select(*[key_value(F.col(key)).alias(key) for key in keys])


def missing_periods(discovered: DataFrame, registered: DataFrame, keys: Sequence[str] = BRONZE_PERIOD) -> DataFrame:
    """Discovered periods that are not registered."""
    known, same = _known_periods(registered, keys)
    return discovered.join(known, same, "left_anti")


def period_status(discovered: DataFrame, registered: DataFrame, keys: Sequence[str] = BRONZE_PERIOD) -> DataFrame:
    """Every discovered period with `status` `added` or `existing`."""
    known, same = _known_periods(registered, keys)
    joined = discovered.join(known.withColumn("_known", F.lit(True)), same, "left")
    return joined.select(*keys, F.when(F.col("_known"), "existing").otherwise("added").alias("status"))


def refresh_periods(
    spark: SparkSession,
    source: DataFrame,
    target: str,
    transform: Callable[[DataFrame], DataFrame],
    keys: Sequence[str] = SILVER_PERIOD,
) -> list[tuple]:
    """Transforms and writes the source periods that `target` lacks; returns them.

    The periods are calendar months, so their list is short; as literals they prune the source's
    directories. Periods already in the target are not read, rewritten or removed.
    """
    wanted = missing_periods(periods_of(source, keys), discover_periods(spark, target, keys), keys)
    periods = sorted((tuple(row) for row in wanted.collect()), key=str)
    if periods:
        write_silver(transform(source.where(any_period(periods, keys))), target, existing="replace_periods")
    return periods


def _known_periods(registered: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, Column]:
    """Distinct registered periods under other names, and the condition that joins them; NULL equals NULL."""
    known = registered.select(*[F.col(key).alias(f"_known_{key}") for key in keys]).distinct()
    return known, reduce(and_, [F.col(key).eqNullSafe(F.col(f"_known_{key}")) for key in keys])


def any_period(periods: Sequence[tuple], keys: Sequence[str]) -> Column:
    """Whether a row is of one of the listed periods."""
    return reduce(or_, [reduce(and_, [_is(F.col(k), v) for k, v in zip(keys, p)]) for p in periods])


def key_value(name: Column) -> Column:
    """The value behind a directory name, which Spark percent-encodes."""
    return F.url_decode(F.replace(F.nullif(name, F.lit(NULL_DIRECTORY)), F.lit("+"), F.lit("%2B")))


def _is(column: Column, value) -> Column:
    return column.isNull() if value is None else column == value

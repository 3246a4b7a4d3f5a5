"""Matching frames to a contract by column name."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from surveylake.contract import CORE_COLUMNS


def fold_names(names: Iterable[str]) -> list[str]:
    """Lower case without surrounding space; fails when two names become one."""
    folded = [name.strip().lower() for name in names]
    clashes = sorted({name for name in folded if folded.count(name) > 1})
    if clashes:
        raise ValueError(f"columns collide after folding case and space: {', '.join(clashes)}")
    return folded


def header_names(header: str, delimiter: str = ",") -> list[str]:
    """Folded column names of a header line."""
    return fold_names(next(csv.reader([header], delimiter=delimiter)))


def normalize_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*fold_names(df.columns))


def missing_columns(columns: Iterable[str], required: Iterable[str] = CORE_COLUMNS) -> list[str]:
    """Required columns that are absent, in the order required."""
    present = set(columns)
    return [c for c in required if c not in present]


def missing_by_period(
    groups: Iterable[tuple[Sequence[str], DataFrame]], keys: Sequence[str], required: Iterable[str] = CORE_COLUMNS
) -> DataFrame:
    """Required columns that files lack, per period: keys, column_name, n_rows (rows without the column).

    Takes (column names, frame) per distinct header and looks before the frames are stacked, so a column
    that only some months lack is seen.
    """
    required = list(required)
    reports = []
    for names, frame in groups:
        absent = F.array(*[F.lit(c) for c in missing_columns(names, required)]).cast("array<string>")
        rows = frame.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
        reports.append(rows.select(*keys, F.explode(absent).alias("column_name"), "n_rows"))
    merged = reduce(DataFrame.unionByName, reports).groupBy(*keys, "column_name")
    return merged.agg(F.sum("n_rows").alias("n_rows"))


def fill_missing_columns(df: DataFrame, required: Iterable[str] = CORE_COLUMNS) -> DataFrame:
    """Adds each absent required column as a NULL string."""
    absent = missing_columns(df.columns, required)
    return df.withColumns({c: F.lit(None).cast("string") for c in absent}) if absent else df


def conform_union(frames: Iterable[DataFrame], required: Iterable[str] = ()) -> DataFrame:
    """Stacks frames by normalised column name; a column a frame lacks is NULL for its rows."""
    folded = [fill_missing_columns(normalize_columns(df), required) for df in frames]
    if not folded:
        raise ValueError("nothing to read: no file matches")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), folded)

"""Which periods a layer holds, noted as they are written, so that nobody lists files to learn it.

A note is a row of a small table beside the layers; the highest number of a period tells what became of it. Numbers
grow from note to note, so a layer that is derived from another can tell which of its periods are out of date.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import SILVER_PERIOD
from surveylake.operators.periods import any_period, discover_periods, missing_periods
from surveylake.sources.layers import load_if_present

NOTES = "number bigint, layer string, keys array<string>, period array<string>, event string"


def note_periods(
    spark: SparkSession,
    root: str,
    written: Mapping[str, Sequence[tuple]],
    removed: Mapping[str, Sequence[tuple]] | None = None,
    keys: Sequence[str] = SILVER_PERIOD,
) -> None:
    """Notes the periods that were written to layers below `root` and removed from them, all at once.

    To be called after the work: a run that stopped before it does the work again. One writer at a time.
    """
    number = (_notes(spark, root).agg(F.max("number")).first()[0] or 0) + 1
    events = [("written", written), ("removed", removed or {})]
    rows = [
        (number, layer, list(keys), list(period), event)
        for event, layers in events
        for layer, periods in layers.items()
        for period in periods
    ]
    if rows:
        spark.createDataFrame(rows, NOTES).coalesce(1).write.mode("append").parquet(_path(root))


def noted_periods(spark: SparkSession, root: str, layer: str, keys: Sequence[str] = SILVER_PERIOD) -> DataFrame:
    """The periods that the layer holds, with the `number` of the note; without rows where none was noted."""
    of_layer = _notes(spark, root).where((F.col("layer") == layer) & (F.col("keys") == F.array(*[F.lit(k) for k in keys])))
    last = of_layer.groupBy("period").agg(F.max_by("event", "number").alias("event"), F.max("number").alias("number"))
    parts = [F.col("period")[place].alias(key) for place, key in enumerate(keys)]
    return last.where("event = 'written'").select(*parts, "number")


def noted_layers(spark: SparkSession, root: str) -> list[tuple[str, list[str]]]:
    """The layers that were noted, with the keys of their periods."""
    return sorted((row.layer, list(row["keys"])) for row in _notes(spark, root).select("layer", "keys").distinct().collect())


def stale_periods(spark: SparkSession, root: str, source: str, derived: str, keys: Sequence[str] = SILVER_PERIOD) -> tuple[list[tuple], list[tuple]]:
    """What brings a derived layer up to date: periods to write, as the source was written since, and to remove."""
    names = [F.col(key).alias(f"_{key}") for key in keys]
    of, have = noted_periods(spark, root, source, keys), noted_periods(spark, root, derived, keys)
    same = F.lit(True)
    for key in keys:
        same &= F.col(key).eqNullSafe(F.col(f"_{key}"))
    both = of.join(have.select(*names, F.col("number").alias("_number")), same, "full")
    rows = both.where("number is null or _number is null or _number < number").collect()
    changed = [tuple(row[key] for key in keys) for row in rows if row["number"] is not None]
    gone = [tuple(row[f"_{key}"] for key in keys) for row in rows if row["number"] is None]
    return sorted(changed, key=str), sorted(gone, key=str)


def repair_notes(spark: SparkSession, root: str, layer: str, keys: Sequence[str] = SILVER_PERIOD) -> tuple[list[tuple], list[tuple]]:
    """Notes what a listing of the layer's files finds otherwise; returns the periods added and taken out.

    For layers that something else wrote to. It is the only function here that lists files.
    """
    found = discover_periods(spark, f"{root}/{layer}", keys, "*.parquet")
    noted = noted_periods(spark, root, layer, keys).select(*keys)
    added, gone = [sorted(map(tuple, df.collect()), key=str) for df in (missing_periods(found, noted, keys), missing_periods(noted, found, keys))]
    note_periods(spark, root, {layer: added}, {layer: gone}, keys)
    return added, gone


def read_noted(spark: SparkSession, root: str, layer: str, schema, keys: Sequence[str] = SILVER_PERIOD) -> DataFrame:
    """The rows of the periods that were noted; those of a period that only lies there are not shown."""
    periods = [tuple(row[key] for key in keys) for row in noted_periods(spark, root, layer, keys).collect()]
    held = load_if_present(spark.read.schema(schema), f"{root}/{layer}") if periods else None
    return spark.createDataFrame([], schema) if held is None else held.where(any_period(periods, keys))


def _path(root: str) -> str:
    return f"{root}/period-notes"


def _notes(spark: SparkSession, root: str) -> DataFrame:
    held = load_if_present(spark.read.schema(NOTES), _path(root))
    return spark.createDataFrame([], NOTES) if held is None else held

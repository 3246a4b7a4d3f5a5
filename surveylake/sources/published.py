"""Tables that change together: written to a folder of their own and shown by one entry of a ledger.

A reader asks the ledger and gets all tables of one version. A version that is being written, or whose writer stopped,
has no such entry, so nobody is led to it. An entry is one small file that appears as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Row, SparkSession

from surveylake.session import remove_paths
from surveylake.sources.layers import load_if_present

# What became of a version: its writing was `begun`, it was `shown`, its folder was `removed`.
EVENTS = "number bigint, version string, event string, tables array<string>"


def published(spark: SparkSession, root: str) -> dict[str, str]:
    """The tables of the version shown, by name; none where nothing was published yet."""
    shown = _shown(_events(spark, root))
    return {} if shown is None else {name: f"{root}/{shown.version}/{name}" for name in shown.tables}


def publish(spark: SparkSession, root: str, write: Callable[[str], dict[str, str]]) -> dict[str, str]:
    """Shows the tables that `write` puts below the folder it is given, all at once; returns their paths by name.

    `write` names a folder of its own for each table. If it fails, the version before stays. That version's folder
    is kept for those who still read it until something is published again; older ones, and those of writers that
    stopped, are removed first. One writer at a time: a second one would take the first for stopped.
    """
    events = _events(spark, root)
    shown, gone = _shown(events), {e.version for e in events if e.event == "removed"}
    stale = [e for e in events if e.event == "begun" and e.version not in gone and (shown is None or e.version != shown.version)]
    remove_paths(spark, [f"{root}/{e.version}" for e in stale])
    number, version = max((e.number for e in events), default=0) + 1, f"v-{uuid.uuid4().hex}"
    begun = Row(number, version, "begun", [])
    _enter(spark, root, [*[Row(e.number, e.version, "removed", []) for e in stale], begun])
    paths = write(f"{root}/{version}")
    _enter(spark, root, [Row(number, version, "shown", sorted(paths))])
    return paths


def _events(spark: SparkSession, root: str) -> list[Row]:
    held = load_if_present(spark.read.schema(EVENTS), f"{root}-versions")
    return [] if held is None else held.collect()


def _enter(spark: SparkSession, root: str, events: list[Row]) -> None:
    spark.createDataFrame(events, EVENTS).coalesce(1).write.mode("append").parquet(f"{root}-versions")


def _shown(events: list[Row]) -> Row | None:
    return max((e for e in events if e.event == "shown"), key=lambda e: (e.number, e.version), default=None)

"""From zipped drops to gold tables, doing only the work that new, corrected and withdrawn archives need."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import BRONZE_PERIOD, CORE_COLUMNS, SILVER_PERIOD, SILVER_SCHEMA
from surveylake.operators import quality
from surveylake.operators.dedup import dedup_rows
from surveylake.operators.periods import ALLOWED_MONTHS, any_period
from surveylake.plans.gold import shared_aggregate, write_gold_from_shared
from surveylake.plans.silver import build_silver
from surveylake.session import MAX_PARTITIONS, TASK_BYTES, remove_paths, sized_for_bytes
from surveylake.sources.archives import (
    LANDING, PIECES, absent_columns, land_versions, list_archives, scan_pieces, with_period, with_version,
)
from surveylake.sources.files import can_open_in_place
from surveylake.sources.layers import OPEN_PERIODS, load_if_present, period_directory, read_periods, write_silver
from surveylake.sources.manifest import note_periods, noted_periods, read_noted, stale_periods
from surveylake.sources.published import publish

# What a ledger says of an archive: that a version of it was landed, or that one was retracted.
LEDGER = "version string, event string, drops string, path string, length bigint, modificationTime timestamp, year string, month string"

# How many rows of which silver period a version carries.
CARRIED = "version string, ano string, v1013 string, n_rows bigint"

# Landed bytes that are brought into silver at a time, so that shuffle partitions keep their size.
BATCH_BYTES = MAX_PARTITIONS * TASK_BYTES

#: The tables kept by period, from which gold and the checks are added up.
SUMMARIES = {"shared-aggregate": shared_aggregate, "suite-counts": quality.suite_counts}


@dataclass
class LakeRefresh:
    """What a refresh did: (year, month) pairs landed and brought into silver, and gold paths rebuilt.

    `archives` are the archives that were landed, `retracted` those whose earlier version was taken out again, as it
    was replaced or withdrawn, and `skipped` those of other periods than were asked for.
    """

    archives: list[str] = field(default_factory=list)
    retracted: list[str] = field(default_factory=list)
    skipped: list[str] = field(default_factory=list)
    landed: list[tuple] = field(default_factory=list)
    silver: list[tuple] = field(default_factory=list)
    gold: dict[str, str] = field(default_factory=dict)


def refresh_lake(
    spark: SparkSession,
    drops: str,
    root: str,
    months: Iterable[str] | None = ALLOWED_MONTHS,
    years: Iterable[str] | None = None,
    delimiter: str = ",",
    withdraw: bool = True,
    unique: Sequence[str] = (),
) -> LakeRefresh:
    """Brings the lake below `root` up to date with the archives in `drops`; `ALL_MONTHS` takes every month.

    An archive is known by its path, a version of it by length and time too. Versions that the ledger does not name
    are landed in directories of their own. A version whose archive was replaced is retracted, and with `withdraw`
    one that this same `drops` once offered and has no longer. Silver periods that a landed or retracted version
    carries are built anew from the landed lines of all live versions that carry them, so silver is what a full
    rebuild of the live archives would give; the other periods keep their files. Gold tables and check results are
    added up from summaries of which only the changed periods are computed; the six gold tables are published together,
    and `published` names those shown. With `unique`, silver columns that no two rows should share, the checks say how
    many rows do, in the whole lake; rows per distinct keys are kept by period for that, and counted for all periods
    the first time. The periods of silver and of the summaries are noted as they change (`noted_periods`).

    Landing, silver and gold have a ledger each, written after their work, so the next run makes good whatever one
    that stopped early has left. Drops without data lines, or without archives, are brought in like others.
    """
    done = LakeRefresh()
    run, landed = uuid.uuid4().hex, f"{root}/landed"
    columns = [F.col(name) for name in ("path", "length", "modificationTime", *BRONZE_PERIOD)]
    listed = with_period(spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(drops)).select(columns)
    listed = with_version(listed, run).collect()
    months, years = set(ALLOWED_MONTHS if months is None else months), None if years is None else set(years)
    wanted = [row for row in listed if row.month in months and (years is None or row.year in years)]
    done.skipped = sorted({row.path for row in listed} - {row.path for row in wanted})

    live = _live(_ledger(spark, f"{root}/landed-archives", LEDGER))
    known = {(v.path, v.length, v.modificationTime) for v in live}
    new = [row for row in wanted if (row.path, row.length, row.modificationTime) not in known]
    present, replaced = {row.path for row in listed}, {row.path for row in new}
    old = [v for v in live if v.path in replaced or (withdraw and v.drops == drops and v.path not in present)]
    if new:
        done.archives, done.landed = sorted(row.path for row in new), sorted({(row.year, row.month) for row in new})
        _land(spark, drops, root, run, new, delimiter)
    if new or old:
        done.retracted = sorted(v.path for v in old)
        events = [Row(v.version, "retracted", *v[2:]) for v in old]
        events += [Row(r.version, "landed", drops, r.path, r.length, r.modificationTime, r.year, r.month) for r in new]
        _append(spark, events, LEDGER, f"{root}/landed-archives")

    history = _ledger(spark, f"{root}/landed-archives", LEDGER)
    pending = _not_in(history, _ledger(spark, f"{root}/silver-archives", LEDGER))
    if pending:
        _bring_into_silver(spark, root, _live(history), pending, delimiter)
        done.silver = sorted({(e.year, e.month) for e in pending})

    unreported = _not_in(_ledger(spark, f"{root}/silver-archives", LEDGER), _ledger(spark, f"{root}/gold-archives", LEDGER))
    if unreported:
        shared = _summary(spark, root, "shared-aggregate")
        done.gold = publish(spark, f"{root}/gold", lambda folder: write_gold_from_shared(shared, folder))
        pieces = _pieces(spark, root, {v.version for v in _live(history)})
        layouts = spark.createDataFrame([(p.year, p.month, p.layout, p.header) for p in pieces], "year string, month string, layout string, header string")
        checks = quality.suite_of_counts(_summary(spark, root, "suite-counts"))
        if pieces:
            checks = quality.union_checks(quality.check_columns(absent_columns(layouts, delimiter=delimiter)), checks)
        if unique:
            counts = _up_to_date_key_counts(spark, root, unique)
            checks = quality.union_checks(checks, quality.duplicates_of_counts(counts, unique, SILVER_PERIOD))
        quality.save_results(checks, f"{root}/quality", run)
        _append(spark, unreported, LEDGER, f"{root}/gold-archives")
    return done


def _land(spark: SparkSession, drops: str, root: str, run: str, new: Sequence[Row], delimiter: str) -> None:
    """Lands the new versions, and notes their pieces and the rows that they carry of each silver period."""
    periods = sorted({(row.year, row.month) for row in new})
    versions = spark.createDataFrame([(row.path, row.version) for row in new], "path string, version string")
    archives = list_archives(spark, drops, periods=periods).join(F.broadcast(versions), "path")
    pieces = land_versions(archives, f"{root}/landed", run, can_open_in_place(drops)).collect()
    _append(spark, pieces, PIECES, f"{root}/landed-pieces")
    if pieces:
        found = _with_period_keys(scan_pieces(spark, f"{root}/landed", pieces, CORE_COLUMNS, delimiter))
        carried = found.groupBy(F.col(LANDING[1]).alias("version"), *SILVER_PERIOD).agg(F.count(F.lit(1)).alias("n_rows"))
        with sized_for_bytes(spark, sum(piece.bytes for piece in pieces)):
            carried.coalesce(1).write.mode("append").parquet(f"{root}/carried")


def _with_period_keys(rows: DataFrame) -> DataFrame:
    """Rows whose period columns are as their directories have them, where empty text is NULL."""
    return rows.withColumns({key: F.nullif(F.col(key), F.lit("")) for key in SILVER_PERIOD})


def _bring_into_silver(spark: SparkSession, root: str, live: Sequence[Row], pending: Sequence[Row], delimiter: str) -> None:
    """Builds the silver periods that pending events touch from the live versions, batch by batch.

    An event is entered into the ledger once all periods that its version carries are done.
    """
    versions = {v.version for v in live}
    carries: dict[str, set[tuple]] = {}
    holds: dict[tuple, set[str]] = {}
    for row in _ledger(spark, f"{root}/carried", CARRIED):
        carries.setdefault(row.version, set()).add((row.ano, row.v1013))
        if row.version in versions:
            holds.setdefault((row.ano, row.v1013), set()).add(row.version)
    touched = {period for event in pending for period in carries.get(event.version, ())}
    sources = {version for period in touched for version in holds.get(period, ())}
    pieces = _pieces(spark, root, sources)
    size = dict.fromkeys(sources, 0) | version_bytes(pieces)
    # A version of several periods weighs as much as all of them: rows per period are known, bytes are not.
    sizes = {period: sum(size[v] for v in holds.get(period, ())) for period in touched}
    finished: set[tuple] = set()
    entered: set[tuple] = set()
    for periods in [*batches(sizes), []]:
        held = [period for period in periods if period in holds]
        own = {version for period in held for version in holds[period]}
        if held:
            with sized_for_bytes(spark, sum(size[v] for v in own)):
                refresh_silver(spark, f"{root}/landed", f"{root}/silver", held, [p for p in pieces if p[LANDING[1]] in own], delimiter)
        gone = [period for period in periods if period not in holds]
        remove_paths(spark, [period_directory(spark, f"{root}/{layer}", p) for p in gone for layer in ("silver", *SUMMARIES)])
        refresh_summaries(spark, f"{root}/silver", root, held)
        layers = ("silver", *SUMMARIES)
        note_periods(spark, root, {layer: held for layer in layers}, {layer: gone for layer in layers})
        finished.update(periods)
        ready = [e for e in pending if (e.version, e.event) not in entered and carries.get(e.version, set()) <= finished]
        _append(spark, ready, LEDGER, f"{root}/silver-archives")
        entered.update((e.version, e.event) for e in ready)


def version_bytes(pieces: Iterable[Row]) -> dict[str, int]:
    """The bytes of each version, from one pass over the pieces."""
    size: dict[str, int] = {}
    for piece in pieces:
        size[piece[LANDING[1]]] = size.get(piece[LANDING[1]], 0) + piece.bytes
    return size


def batches(sizes: dict[tuple, int], most: int = BATCH_BYTES) -> list[list[tuple]]:
    """All the periods, in order, in runs of at most so many bytes; a larger period is a run of its own."""
    runs, held = [], 0
    for period, size in sorted(sizes.items(), key=str):
        if not runs or held + size > most:
            runs.append([])
            held = 0
        runs[-1].append(period)
        held += size
    return runs


def refresh_silver(
    spark: SparkSession, landed: str, silver: str, periods: Sequence[tuple], pieces: Sequence[Row], delimiter: str = ","
) -> None:
    """Builds the given silver periods from the landed pieces that hold their rows; other periods keep their files.

    Neither the old rows of these periods nor any other are read, so a repeated or interrupted run changes nothing.
    Rows are rebalanced by period before the derived columns are added, so both shuffles carry packed rows. Where a task
    can keep a file open for each of the periods, it writes the rows as they were de-duplicated, shuffled once.
    """
    found = _with_period_keys(scan_pieces(spark, landed, pieces, CORE_COLUMNS, delimiter)).drop(LANDING[1])
    by = SILVER_PERIOD if len(periods) > OPEN_PERIODS else ()
    rows = build_silver(found.where(any_period(periods, SILVER_PERIOD)), partial(dedup_rows, by=by))
    write_silver(rows, silver, existing="replace_periods", rebalance=False)


def refresh_summaries(spark: SparkSession, silver: str, root: str, changed: Sequence[tuple]) -> None:
    """Recomputes the summaries of the changed silver periods, which hold rows. Only their files are listed and read."""
    if not changed:
        return
    rows = read_periods(spark, silver, SILVER_SCHEMA, changed)
    for name, summary in SUMMARIES.items():
        write_silver(summary(rows, SILVER_PERIOD), f"{root}/{name}", existing="replace_periods")


def _up_to_date_key_counts(spark: SparkSession, root: str, keys: Sequence[str]) -> DataFrame:
    """Rows per distinct keys of all silver periods, of which only those written since they were last counted are read.

    Counts by other keys have a layer of their own. A lake whose silver was never noted is noted from its ledger first.
    """
    layer = f"key-counts-{'-'.join(keys)}"
    if noted_periods(spark, root, "silver").isEmpty():
        versions = {v.version for v in _live(_ledger(spark, f"{root}/silver-archives", LEDGER))}
        carried = _ledger(spark, f"{root}/carried", CARRIED)
        note_periods(spark, root, {"silver": sorted({(c.ano, c.v1013) for c in carried if c.version in versions}, key=str)})
    changed, gone = stale_periods(spark, root, "silver", layer)
    if changed:
        rows = read_periods(spark, f"{root}/silver", SILVER_SCHEMA, changed)
        counts = quality.key_counts(rows, keys, SILVER_PERIOD, rebalance=True)
        write_silver(counts, f"{root}/{layer}", existing="replace_periods", rebalance=False)
    remove_paths(spark, [period_directory(spark, f"{root}/{layer}", period) for period in gone])
    note_periods(spark, root, {layer: changed}, {layer: gone})
    schema = quality.key_counts(spark.createDataFrame([], SILVER_SCHEMA), keys, SILVER_PERIOD).schema
    return read_noted(spark, root, layer, schema)


def _summary(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A summary of all periods; without rows where silver has none."""
    schema = SUMMARIES[name](spark.createDataFrame([], SILVER_SCHEMA), SILVER_PERIOD).schema
    held = load_if_present(spark.read.schema(schema), f"{root}/{name}")
    return spark.createDataFrame([], schema) if held is None else held


def _ledger(spark: SparkSession, path: str, schema: str) -> list[Row]:
    """The entries of a ledger, which grows with the archives and not with their rows."""
    held = load_if_present(spark.read.schema(schema), path)
    return [] if held is None else held.collect()


def _append(spark: SparkSession, entries: Sequence[Row], schema: str, path: str) -> None:
    if entries:
        spark.createDataFrame(entries, schema).coalesce(1).write.mode("append").parquet(path)


def _live(history: Sequence[Row]) -> list[Row]:
    """The landings of the versions that were not retracted."""
    gone = {e.version for e in history if e.event == "retracted"}
    return [e for e in history if e.event == "landed" and e.version not in gone]


def _not_in(history: Sequence[Row], ledger: Sequence[Row]) -> list[Row]:
    entered = {(e.version, e.event) for e in ledger}
    return [e for e in history if (e.version, e.event) not in entered]


def _pieces(spark: SparkSession, root: str, versions: set[str]) -> list[Row]:
    return [p for p in _ledger(spark, f"{root}/landed-pieces", PIECES) if p[LANDING[1]] in versions]

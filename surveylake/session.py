"""Session defaults, task sizes, and the shared folder for intermediate tables."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Shuffled bytes that one task should handle, and the numbers of tasks beyond which tasks grow instead.
TASK_BYTES = 256 << 20
MAX_PARTITIONS = 20_000
MAX_SCAN_TASKS = 100_000
MAX_SCAN_BYTES = 1 << 30
# Shuffled bytes, which are compressed, that adaptive execution gives to a task: packed rows of codes take many times
# that in a hash table. A small input is still dealt to so many tasks, of some size.
MERGED_BYTES = 64 << 20
MIN_MERGED_BYTES = 8 << 20
MERGED_TASKS = 64
# Tasks among which a scan of text is dealt at least, if they get as much as that each: with few more tasks than cores,
# the last ones would run alone.
SCAN_TASKS = 128


def build_session(app_name: str = "surveylake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the transforms were written for; `conf` keys use `__` for `.`."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # A task that writes a few periods keeps a file open for each instead of sorting its rows first.
        .config("spark.sql.maxConcurrentOutputFileWriters", "4")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def task_settings(input_bytes: int, shuffle_partitions: int, scan_bytes: int) -> dict[str, str]:
    """Settings that suit a job which shuffles about its whole input, given the session's present numbers.

    Adaptive execution merges partitions that turn out small but cannot split those of an aggregate, so the
    starting number has to fit the largest shuffle. It stops growing at `MAX_PARTITIONS`: the driver tracks
    every pair of scan and shuffle tasks. Past that the partitions grow instead, and spill. Scans are split finer than
    the session's number where the input would give few tasks.
    """
    partitions = min(-(-input_bytes // TASK_BYTES), MAX_PARTITIONS)
    merged = max(MIN_MERGED_BYTES, min(input_bytes // MERGED_TASKS, MERGED_BYTES))
    scanned = min(scan_bytes, max(MIN_MERGED_BYTES, input_bytes // SCAN_TASKS)) if input_bytes > MIN_MERGED_BYTES else scan_bytes
    return {
        "spark.sql.shuffle.partitions": str(max(shuffle_partitions, partitions)),
        "spark.sql.files.maxPartitionBytes": str(max(scanned, min(input_bytes // MAX_SCAN_TASKS, MAX_SCAN_BYTES))),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(merged),
    }


@contextmanager
def sized_for(spark: SparkSession, files: DataFrame) -> Iterator[dict[str, str]]:
    """Runs its block with task sizes that suit the given files (column `length`), then restores the session's."""
    with sized_for_bytes(spark, files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]) as settings:
        yield settings


@contextmanager
def sized_for_bytes(spark: SparkSession, total: int) -> Iterator[dict[str, str]]:
    """Runs its block with task sizes that suit an input of so many bytes, then restores the session's."""
    scan_bytes = spark.conf.get("spark.sql.files.maxPartitionBytes").lower().removesuffix("b")
    present = int(spark.conf.get("spark.sql.shuffle.partitions"))
    settings = task_settings(total, present, int(scan_bytes) if scan_bytes.isdigit() else 0)
    if not scan_bytes.isdigit():
        del settings["spark.sql.files.maxPartitionBytes"]
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield settings
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


@contextmanager
def open_files(spark: SparkSession, most: int) -> Iterator[None]:
    """Lets tasks of its block keep so many files open, one a directory, instead of sorting their rows by directory.

    Rows of further directories are sorted as before. The session's number stays where it is larger.
    """
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, str(max(int(before), most)))
        yield
    finally:
        spark.conf.set(key, before)


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach: `spark.checkpoint.dir`.

    Only a local session may go without it; it then gets a folder that is removed at exit.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root(spark.sparkContext.applicationId)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that nothing else writes to."""
    return f"{shared_root(spark)}/surveylake/{name}-{uuid.uuid4().hex}"


def remove_paths(spark: SparkSession, paths: list[str]) -> None:
    """Removes files and folders, on whatever storage they are."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for path in paths:
        found = hadoop.Path(path)
        found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(found, True)


@cache
def _local_root(application: str) -> str:
    folder = tempfile.mkdtemp(prefix=f"surveylake-{application}-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder

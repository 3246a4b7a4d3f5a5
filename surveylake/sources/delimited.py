"""Delimited text with a header in every file, where files may differ in their columns."""

from __future__ import annotations

import io
from collections import defaultdict
from collections.abc import Iterable, Iterator
from pathlib import PurePosixPath

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import strings
from surveylake.operators.conform import conform_union, header_names
from surveylake.sources.files import can_open_in_place, decode_lines, open_in_place


def file_headers(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """First line of every file below `root`: path, directory, header.

    The executors read just the head of each file; where they cannot open the storage themselves, the
    headers come from a text scan instead.
    """
    headers = _headers_in_place if can_open_in_place(root) else _headers_by_scan
    return headers(spark, root, glob).withColumn("directory", F.regexp_replace("path", "/[^/]*$", ""))


def header_locations(headers: DataFrame) -> DataFrame:
    """Where each header applies: header, directory, location.

    A directory whose files agree is one location; only in a mixed directory is each file its own.
    """
    low, high = F.col("_low"), F.col("_high")
    per_directory = headers.groupBy("directory").agg(F.min("header").alias("_low"), F.max("header").alias("_high"))
    uniform = per_directory.where(low == high).select(
        low.alias("header"), "directory", F.col("directory").alias("location")
    )
    mixed = headers.join(per_directory.where(low != high), "directory", "left_semi")
    return uniform.unionByName(mixed.select("header", "directory", F.col("path").alias("location")))


def scan_groups(
    spark: SparkSession, root: str, delimiter: str = ",", glob: str = "*.csv"
) -> list[tuple[list[str], DataFrame]]:
    """(column names, frame of strings) per distinct header and set of columns that the directories name, which are added.

    Each file is read by one frame only. The driver sees headers and locations, never rows.
    """
    found = header_locations(file_headers(spark, root, glob)).collect()
    # Reading a directory also reads what lies below it, so one that holds others is named by its files.
    outer = {str(parent) for row in found for parent in PurePosixPath(row.directory).parents}
    locations = defaultdict(list)
    for row in found:
        whole_directory = row.location == row.directory
        named = f"{row.location}/{glob}" if whole_directory and row.directory in outer else row.location
        locations[row.header, tuple(_directory_keys(row.directory, root))].append(named)
    groups = []
    for header, keys in sorted(locations):
        names = header_names(header, delimiter)
        reader = spark.read.schema(strings([*names, *keys])).option("header", "true").option("sep", delimiter)
        reader = reader.option("basePath", root).option("pathGlobFilter", glob)
        groups.append((names, reader.csv(sorted(locations[header, keys]))))
    return groups


def scan_csv(
    spark: SparkSession, root: str, required: Iterable[str] = (), delimiter: str = ",", glob: str = "*.csv"
) -> DataFrame:
    """All files below `root` as one frame of strings, matched by column name rather than by position.

    Required columns that a file lacks are NULL for its rows.
    """
    return conform_union([frame for _, frame in scan_groups(spark, root, delimiter, glob)], required)


def _headers_in_place(spark: SparkSession, root: str, glob: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    paths = files.load(root).where(F.col("length") > 0).select("path")
    return paths.mapInArrow(_first_lines, "path string, header string")


def _headers_by_scan(spark: SparkSession, root: str, glob: str) -> DataFrame:
    # The first block of a file is read in order by one task, so its lowest row id is the first line.
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root)
    first_blocks = lines.where("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("_row")
    )
    return first_blocks.groupBy("path").agg(F.min_by("value", "_row").alias("header"))


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        paths, headers = batch.column(0), []
        for path in paths.to_pylist():
            with open_in_place(path) as stream, io.BufferedReader(stream) as lines:
                headers.append(decode_lines(lines.readline()).strip("\ufeff\n"))
        yield pa.RecordBatch.from_arrays([paths.cast(pa.string()), pa.array(headers, pa.string())], ["path", "header"])


def _directory_keys(directory: str, root: str) -> list[str]:
    parts = [part.split("=", 1)[0] for part in directory.split("/") if "=" in part]
    return parts[root.count("=") :]

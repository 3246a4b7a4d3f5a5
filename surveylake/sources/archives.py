"""Zipped monthly drops: listing, unpacking on the executors, and landing as partitioned text."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import BRONZE_PERIOD, CORE_COLUMNS, strings
from surveylake.operators.conform import conform_union, header_names, missing_columns
from surveylake.operators.periods import ALLOWED_MONTHS, any_period
from surveylake.session import open_files
from surveylake.sources.files import decode_lines, open_in_place
from surveylake.sources.layers import load_if_present

BLOCK_BYTES = 1 << 20
# Compressed bytes that one task should unpack, and archives that it should not exceed: it keeps their files open.
TASK_BYTES = 32 << 20
TASK_ARCHIVES = 32

# Directories a landing task writes to without sorting its blocks: of headers and of data, with some to spare.
OPEN_PLACES = 4 * TASK_ARCHIVES

MEMBER_SCHEMA = "year string, month string, path string, version string, member string"
BLOCK_SCHEMA = "year string, month string, version string, member string, header string, block string"

# The directory levels above the lines of an archive that is landed by version.
LANDING = ("landing_run", "archive_version")
PIECES = f"{', '.join(f'{c} string' for c in (*LANDING, *BRONZE_PERIOD, 'layout', 'header'))}, bytes bigint"


def with_version(archives: DataFrame, run: str) -> DataFrame:
    """Adds `version`, which names an archive as it is now, as landed by one run: by path, length and time."""
    parts = [F.col("path"), F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string"), F.lit(run)]
    return archives.withColumn("version", F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 20))


def with_period(df: DataFrame, path: str = "path") -> DataFrame:
    """Adds `year` and `month` taken from names ending in `_MMYYYY.zip`; empty text for other names."""
    pattern = r"_(\d{2})(\d{4})\.zip$"
    return df.withColumns({"year": F.regexp_extract(path, pattern, 2), "month": F.regexp_extract(path, pattern, 1)})


def list_archives(
    spark: SparkSession,
    root: str,
    months: Iterable[str] | None = ALLOWED_MONTHS,
    years: Iterable[str] | None = None,
    name: str = "*",
    periods: Iterable[tuple[str, str]] | None = None,
) -> DataFrame:
    """Archives `<name>_MMYYYY.zip` of the wanted periods: path, length, content, year, month.

    `periods`, as (year, month) pairs, takes the place of months and years. The periods go into the file
    pattern, so archives of other periods are dropped when files are listed and their content is not read.
    """
    if periods is not None:
        stamps = _one_of(month + year for year, month in periods)
    else:
        stamps = _one_of(ALLOWED_MONTHS if months is None else months)
        stamps += "[0-9]" * 4 if years is None else _one_of(years)
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"{name}_{stamps}.zip").load(root)
    return with_period(files)


def read_blocks(archives: DataFrame, in_place: bool = True) -> DataFrame:
    """Unpacks the CSV members: year, month, member, header, block (whole data lines joined by newlines).

    `in_place` opens archives of any size where they lie, one member per task, and holds one block in memory; it needs
    storage that tasks can open. Otherwise Spark reads each archive whole, which its readers allow up to 2 GiB.
    Either way members are decompressed as a stream.
    """
    if not in_place:
        return archives.select("year", "month", _version(archives), "content").mapInArrow(_unpack_contents, BLOCK_SCHEMA)
    total, n = archives.agg(F.coalesce(F.sum("length"), F.lit(0)), F.count(F.lit(1))).first()
    # A row stands for a whole member: adaptive execution would merge such short rows into one task.
    tasks = max(archives.sparkSession.sparkContext.defaultParallelism, total // TASK_BYTES, n // TASK_ARCHIVES)
    return members_of(archives).repartition(tasks).mapInArrow(_unpack_members, BLOCK_SCHEMA)


def block_lines(blocks: DataFrame, *more: str) -> DataFrame:
    """One row per line: kind (`header` or `data`), year, month, layout, value, and `more` columns. Blank lines are left out.

    `layout` fingerprints the header, so lines with the same columns share a layout.
    """
    keyed = blocks.withColumn("layout", F.md5("header"))
    lines = keyed.select(
        *more,
        F.when(F.col("block").isNull(), "header").otherwise("data").alias("kind"),
        "year",
        "month",
        "layout",
        F.explode(F.split(F.coalesce("block", "header"), "\n")).alias("value"),
    )
    return lines.where(F.trim("value") != "")


def block_texts(blocks: DataFrame, *more: str) -> DataFrame:
    """The lines of `block_lines`, those of a block as one text with newlines between: written as text, they are the same.

    Blocks are taken apart only where a line may be blank.
    """
    text = F.coalesce("block", "header")
    suspect = text.contains("\n\n") | text.contains("\n ") | text.endswith("\n") | text.startswith("\n") | text.startswith(" ")
    filled = F.array_join(F.filter(F.split(text, "\n"), lambda line: F.trim(line) != ""), "\n")
    kind = F.when(F.col("block").isNull(), "header").otherwise("data")
    texts = blocks.select(*more, kind.alias("kind"), "year", "month", F.md5("header").alias("layout"), F.when(suspect, filled).otherwise(text).alias("value"))
    return texts.where("value != ''")


def land_archives(archives: DataFrame, target: str, mode: str = "overwrite", in_place: bool = True) -> None:
    """Lands the lines of the listed archives in one pass as `kind=/year=/month=/layout=` text.

    Headers land apart from the data, so later reads learn every layout from a few small files. Landing an archive
    again with `append` repeats its lines, which the silver layer drops.
    """
    texts = block_texts(read_blocks(archives, in_place))
    with open_files(archives.sparkSession, OPEN_PLACES):
        texts.write.mode(mode).partitionBy("kind", "year", "month", "layout").text(target)


def land_versions(archives: DataFrame, target: str, run: str, in_place: bool = True) -> DataFrame:
    """Lands archives that have a `version` below `target`, each in directories of its own; returns its pieces.

    A piece is what an archive holds of one layout: run, version, period, layout, header, and the bytes of its data
    lines (0 where it has a header only). An archive without CSV members lands nothing. Lists the files of this run
    only; what a run that stopped has left is in no piece and never read.
    """
    texts = block_texts(read_blocks(archives, in_place), "version").withColumnRenamed("version", LANDING[1])
    place = f"{target}/{LANDING[0]}={run}"
    with open_files(archives.sparkSession, OPEN_PLACES):
        texts.write.mode("overwrite").partitionBy(LANDING[1], "kind", *BRONZE_PERIOD, "layout").text(place)
    spark, keys = archives.sparkSession, [LANDING[1], *BRONZE_PERIOD, "layout"]
    schema = ", ".join(f"{name} string" for name in ("value", LANDING[1], "kind", *BRONZE_PERIOD, "layout"))
    reader = spark.read.format("text").schema(schema).option("basePath", place)
    headers = load_if_present(reader, f"{place}/{LANDING[1]}=*/kind=header")
    if headers is None:
        return spark.createDataFrame([], PIECES)
    headers = headers.select(*keys, F.col("value").alias("header")).distinct()
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(place).where(F.col("path").contains("/kind=data/"))
    held = files.select(*[F.regexp_extract("path", f"/{key}=([^/]*)/", 1).alias(key) for key in keys], "length")
    held = held.groupBy(*keys).agg(F.sum("length").alias("bytes"))
    pieces = headers.join(held, keys, "left").withColumn("bytes", F.coalesce("bytes", F.lit(0).cast("long")))
    return pieces.select(F.lit(run).alias(LANDING[0]), *keys, "header", "bytes")


def scan_pieces(spark: SparkSession, target: str, pieces: Sequence, required: Iterable[str] = (), delimiter: str = ",") -> DataFrame:
    """The data lines of the given pieces (rows of `land_versions`) as strings, matched by name, with `archive_version`.

    Each layout is read once, from the directories of its pieces and no others.
    """
    frames, layouts = [], {}
    for piece in pieces:
        layouts.setdefault((piece.layout, piece.header), []).append(piece)
    for (layout, header), own in sorted(layouts.items(), key=lambda item: item[0]):
        levels = ["kind", *BRONZE_PERIOD, "layout"]
        schema = strings([*header_names(header, delimiter), *LANDING, *levels])
        found = sorted(
            f"{target}/{LANDING[0]}={p[LANDING[0]]}/{LANDING[1]}={p[LANDING[1]]}/kind=data/year={p.year}/month={p.month}/layout={layout}"
            for p in own
            if p.bytes
        )
        reader = spark.read.schema(schema).option("sep", delimiter).option("basePath", target)
        part = reader.csv(found) if found else spark.createDataFrame([], schema)
        frames.append(part.drop(LANDING[0], *levels))
    return conform_union(frames, required)


def landed_layouts(spark: SparkSession, target: str) -> DataFrame:
    """The layouts of each landed period: year, month, layout, header."""
    schema = "value string, kind string, year string, month string, layout string"
    headers = load_if_present(spark.read.format("text").schema(schema).option("basePath", target), f"{target}/kind=header")
    if headers is None:  # archives without CSV members land nothing
        return spark.createDataFrame([], strings([*BRONZE_PERIOD, "layout", "header"]))
    return headers.select("year", "month", "layout", F.col("value").alias("header")).distinct()


def _rows_of_layout(reader: DataFrameReader, target: str, layout: str) -> DataFrame | None:
    """The data lines of a layout; None where its files hold a header only, which land no data."""
    try:
        return reader.csv(f"{target}/kind=data/*/*/layout={layout}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def landed_absent_columns(
    spark: SparkSession, target: str, required: Iterable[str] = CORE_COLUMNS, delimiter: str = ","
) -> DataFrame:
    """Required columns that some file of a period lacks: year, month, absent (sorted array). Reads headers only."""
    return absent_columns(landed_layouts(spark, target), required, delimiter)


def absent_columns(layouts: DataFrame, required: Iterable[str] = CORE_COLUMNS, delimiter: str = ",") -> DataFrame:
    """The same from a table of the layouts (`year`, `month`, `layout`, `header`) of each period."""
    spark, required = layouts.sparkSession, list(required)
    headers = layouts.select("layout", "header").distinct().collect()
    rows = [(row.layout, missing_columns(header_names(row.header, delimiter), required)) for row in headers]
    per_layout = spark.createDataFrame(rows, "layout string, absent array<string>")
    per_period = layouts.join(per_layout, "layout").groupBy(*BRONZE_PERIOD)
    return per_period.agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("absent")))).alias("absent"))


def scan_landed(
    spark: SparkSession,
    target: str,
    required: Iterable[str] = (),
    delimiter: str = ",",
    periods: Sequence[tuple[str, str]] | None = None,
) -> DataFrame:
    """Landed lines as one frame of strings, matched by column name whatever their layout.

    Each layout is read once, from its own directories, with its own schema. Only the distinct headers
    reach the driver. `periods` keeps the listed (year, month) pairs, by directory.
    """
    layouts = landed_layouts(spark, target)
    chosen = None if periods is None else any_period(periods, BRONZE_PERIOD)
    known = (layouts if chosen is None else layouts.where(chosen)).select("layout", "header").distinct().collect()
    frames = []
    for row in sorted(known, key=lambda r: r.layout):
        schema = strings([*header_names(row.header, delimiter), "kind", *BRONZE_PERIOD, "layout"])
        reader = spark.read.schema(schema).option("sep", delimiter).option("basePath", target)
        part = _rows_of_layout(reader, target, row.layout)
        if part is None:
            part = spark.createDataFrame([], schema)
        part = part.drop("kind", "layout")
        frames.append(part if chosen is None else part.where(chosen))
    return conform_union(frames, required)


def members_of(archives: DataFrame) -> DataFrame:
    """The CSV members: year, month, path, version, member. Reads the archives' own directories, not their data."""
    return archives.select("year", "month", "path", _version(archives)).mapInArrow(_list_members, MEMBER_SCHEMA)


def _version(archives: DataFrame) -> Column:
    return F.col("version") if "version" in archives.columns else F.lit(None).cast("string").alias("version")


def _one_of(choices: Iterable[str]) -> str:
    return "{" + ",".join(choices) + "}"


def _list_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with open_in_place(row["path"]) as stream, zipfile.ZipFile(stream) as archive:
                found = [{**row, "member": name} for name in _csv_members(archive)]
            if found:
                yield pa.RecordBatch.from_pylist(found, pa.schema([(name, pa.string()) for name in found[0]]))


def _unpack_contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for year, month, version, content in zip(*batch.columns):
            origin = year.as_py(), month.as_py(), version.as_py()
            with zipfile.ZipFile(io.BytesIO(content.as_buffer())) as archive:
                for name in _csv_members(archive):
                    yield from _blocks(archive, name, *origin)


def _unpack_members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            with open_in_place(row["path"]) as stream, zipfile.ZipFile(stream) as archive:
                yield from _blocks(archive, row["member"], row["year"], row["month"], row["version"])


def _csv_members(archive: zipfile.ZipFile) -> list[str]:
    return [entry.filename for entry in archive.infolist() if entry.filename.endswith(".csv")]


def _blocks(archive: zipfile.ZipFile, name: str, year: str, month: str, version: str | None) -> Iterator[pa.RecordBatch]:
    """One row with the header alone (NULL block), then one row per block of whole lines."""
    base = name.rsplit("/", 1)[-1]
    with archive.open(name) as member:
        header = decode_lines(member.readline()).strip("\ufeff\n")
        yield _block_row(year, month, version, base, header, None)
        rest = b""
        while chunk := member.read(BLOCK_BYTES):
            lines, newline, tail = chunk.rpartition(b"\n")
            if newline:
                yield _block_row(year, month, version, base, header, decode_lines(rest + lines))
                rest = tail
            else:
                rest += chunk
        if rest:
            yield _block_row(year, month, version, base, header, decode_lines(rest))


def _block_row(year: str, month: str, version: str | None, member: str, header: str, block: str | None) -> pa.RecordBatch:
    row = {"year": year, "month": month, "version": version, "member": member, "header": header, "block": block}
    return pa.RecordBatch.from_arrays([pa.array([v], pa.string()) for v in row.values()], names=list(row))

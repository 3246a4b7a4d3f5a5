"""Survey microdata derived from the `lineitem` table, for queries and tests that need the survey's shape."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.contract import CORE_COLUMNS
from surveylake.sources.files import open_for_writing

# Bytes of lines that a task gathers before it writes them as archives.
ARCHIVE_BYTES = 128 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def microdata(lineitem: DataFrame) -> DataFrame:
    """The core columns as text, one row per line item."""
    order, part = F.col("l_orderkey"), F.col("l_partkey")
    tested = order % 5
    result = F.when(F.col("l_linenumber") % 3 == 0, 1).otherwise(2)
    columns = {
        "ano": F.lit(2020),
        "uf": _state(part % 29),
        "v1013": 9 + order % 3,
        "v1022": 1 + part % 3,
        "v1023": F.lit(1),
        "v1032": F.when(part % 17 != 0, F.col("l_extendedprice").cast("decimal(12,2)")),
        "a002": (2 * F.col("l_quantity")).cast("int"),
        "a003": 1 + F.col("l_linenumber") % 2,
        "a004": F.when(part % 11 != 10, 1 + part % 6),
        "a005": F.lit(1),
        "b0011": F.when(order % 29 == 0, 1).when(order % 29 == 1, 9).otherwise(2),
        "b0012": _yes(order % 31 == 0),
        "b0014": _yes(order % 37 == 0),
        "b00111": _yes(order % 41 == 0),
        "b002": _yes(part % 7 == 0),
        "b006": _yes(part % 53 == 0),
        "b007": 1 + F.col("l_suppkey") % 3,
        "b009b": F.when(tested == 1, 1).when(tested != 0, 2),
        "b011": F.when(tested == 1, result),
        "c001": F.when(part % 13 == 0, 1).when(part % 13 != 1, 2),
    }
    return lineitem.select(*[columns[c].cast("string").alias(c) for c in CORE_COLUMNS])


def with_bronze_period(bronze: DataFrame) -> DataFrame:
    """Adds the directory keys `year` and `month` (two digits)."""
    return bronze.withColumns({"year": F.col("ano"), "month": F.lpad("v1013", 2, "0")})


class Packing:
    """An archive of one period that grows in memory by lines, compressed."""

    def __init__(self, period: str, header: str):
        self.n_rows, self._packed = 0, io.BytesIO()
        self._archive = zipfile.ZipFile(self._packed, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        self._member = self._archive.open(f"dados/{period}.csv", "w")
        self._member.write(f"{header}\r\n".encode())

    def add(self, lines: pa.Array) -> int:
        """Returns how many bytes the lines have."""
        raw = pc.binary_join(pa.ListArray.from_arrays([0, len(lines)], lines), "\r\n")[0].as_buffer()
        self._member.write(raw)
        self._member.write(b"\r\n")
        self.n_rows += len(lines)
        return raw.size + 2

    def close(self) -> bytes:
        self._member.close()
        self._archive.writestr("dados/leia-me.txt", "not data\n")
        self._archive.close()
        return self._packed.getvalue()


def write_archives(bronze: DataFrame, root: str) -> None:
    """Zips the rows of each task as monthly archives below `root`, each with one CSV member and one other file.

    A row's columns are upper-case in the file. Archive names hold the task's number, so a retried task
    writes the same files again. A task holds at most `ARCHIVE_BYTES` of lines, compressed, before it writes them.
    """
    lines = with_bronze_period(bronze).select(
        F.concat("month", "year").alias("period"),
        F.to_csv(F.struct(*bronze.columns)).alias("line"),
        F.spark_partition_id().alias("task"),
    )
    header = ",".join(bronze.columns).upper()

    def zip_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, number = {}, 0, 0
        for batch in batches:
            task = batch.column("task")[0].as_py() if batch.num_rows else 0
            for period in batch.column("period").unique().drop_null().to_pylist():
                rows = batch.filter(pc.equal(batch.column("period"), period)).column("line")
                packed = held.setdefault(period, Packing(period, header))
                size += packed.add(rows)
            if size >= ARCHIVE_BYTES:
                yield written(held, task, number)
                held, size, number = {}, 0, number + 1
        if held:
            yield written(held, task, number)

    def written(held: dict[str, Packing], task: int, number: int) -> pa.RecordBatch:
        names = [f"{root}/MICRODADOS_{task}_{number}_{period}.zip" for period in held]
        for name, packed in zip(names, held.values()):
            with open_for_writing(name) as stream:
                stream.write(packed.close())
        return pa.RecordBatch.from_pydict({"path": names, "n_rows": [packed.n_rows for packed in held.values()]})

    lines.mapInArrow(zip_rows, "path string, n_rows long").write.format("noop").mode("overwrite").save()


def _state(slot: Column) -> Column:
    return (
        F.when(slot < 7, 11 + slot)
        .when(slot < 16, 14 + slot)
        .when(slot < 19, 15 + slot)
        .when(slot == 19, 35)
        .when(slot < 23, 21 + slot)
        .when(slot < 27, 27 + slot)
        .when(slot == 27, 34)
        .otherwise(99)
    )


def _yes(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(2)

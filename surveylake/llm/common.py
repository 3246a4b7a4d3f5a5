"""Small helpers of the operators: tables on the shared folder, worker state, slices of texts."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.session import remove_paths, scratch_path

#: Rows of a batch that are made into Python objects at a time.
VALUES = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the folder that all executors share: its lineage is cut and survives lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    for made in _recorded:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: The tables written while each enclosing `settled` builds its frame.
_recorded: list[list[str]] = []


def settled(spark: SparkSession, name: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame that `build` gives as a written table; the tables written on the way are removed.

    For frames of few or narrow rows, whose steps leave much more behind than they hold.
    """
    _recorded.append([])
    try:
        found = build()
        steps = list(_recorded[-1])
        found = written(found, name)
    finally:
        _recorded.pop()
    remove_paths(spark, steps)
    return found


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores in front as it takes to be no column of the frame."""
    taken, found = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        found.append(name)
        taken.add(name.lower())
    return found


def worker_state(work: str) -> dict:
    """What a Python worker keeps from task to task of one kind of work; what it kept for another kind is dropped.

    Workers go from stage to stage of a pipeline, and a compiled vocabulary would lie beside the arrays of the next.
    Functions travel by value, so their own module cannot hold it.
    """
    name = "_surveylake_llm_worker"
    kept = vars(sys.modules.setdefault(name, types.ModuleType(name)))
    if kept.get("work") != work:
        kept.update(work=work, state={})
    return kept["state"]


def each_value(column: pa.Array, rows: int = VALUES) -> Iterator:
    """The values of a column as Python objects, of which a run of rows exists at a time."""
    for first in range(0, len(column), rows):
        yield from column.slice(first, rows).to_pylist()


def slices(texts: Iterable[str | None], size: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of consecutive texts of about `size` characters, each with the number of its first; null is empty."""
    first, held, chars = 0, [], 0
    for number, text in enumerate(texts):
        held.append(text or "")
        chars += len(held[-1])
        if chars >= size:
            yield first, held
            first, held, chars = number + 1, [], 0
    if held:
        yield first, held


def kept_once(docs: DataFrame, judged: DataFrame, key: str, digest: Column) -> DataFrame:
    """The rows of `docs` that are kept, with all their columns.

    `judged` has a row per row: its key, its digest (that `digest` gives), and whether it is kept. Rows whose key and
    digest are only ever dropped go. Where a kept row is repeated, one of its rows stays; which, where they differ in
    other columns, is not fixed.

    The texts move once, to meet the verdicts in the order of their keys, whatever the size of either: a plan that
    broadcasts few verdicts and sorts for many would cost more than its share as tables grow. Only if some kept row is
    repeated are the rows left written, so that these can be told apart without a second join.
    """
    keys, digests, kept, rows = free_names(docs, "_key", "_digest", "_kept", "_rows")
    judged = written(judged.toDF(keys, digests, kept), "judged")
    found = judged.groupBy(keys, digests).agg(F.bool_or(kept).alias(kept), F.count("*").alias(rows))
    found = written(found.where(f"not `{kept}` or `{rows}` > 1").drop(rows), "judged-keys")
    same = F.col(key).eqNullSafe(F.col(keys)) & (digest == F.col(digests))
    left = docs.join(found.hint("merge"), same, "left").where(F.coalesce(F.col(kept), F.lit(True)))
    if found.where(kept).isEmpty():
        return left.select(docs.columns)
    left = written(left.drop(keys).select(*docs.columns, digests), "left")
    repeated = left.where(F.col(digests).isNotNull()).dropDuplicates([key, digests])
    return left.where(F.col(digests).isNull()).unionByName(repeated).select(docs.columns)

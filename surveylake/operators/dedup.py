"""Exact removal of repeated rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Marks of packed rows: between texts, and in the place of NULL. Rows whose texts hold one are kept as they are.
SEPARATOR, NULL = "\x1f", "\x00"
PACKED, MARKED = "_packed_texts", "_marked_texts"

# Text columns from which on packing pays.
FEWEST_PACKED = 4


def dedup_rows(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct rows over every column.

    Copies within a task collapse before the shuffle, so a row that is repeated very often is not a hot key. Tasks hold
    their distinct rows for that: text columns are packed into one, as of many short codes each would take 16 bytes.
    With `by`, names of columns, the distinct rows are rebalanced by these while they are packed.
    """
    texts = [name for name, kind in df.dtypes if kind == "string" and name not in by]
    if len(texts) < FEWEST_PACKED or len(set(df.columns)) < len(df.columns) or {PACKED, MARKED} & set(df.columns):
        return _rebalanced(df.dropDuplicates(), by)
    others = [F.col(_quoted(name)) for name in df.columns if name not in texts]
    packed = df.select(*others, *_packed([F.col(_quoted(name)) for name in texts])).dropDuplicates()
    parts = _rebalanced(packed, by).withColumn(PACKED, F.coalesce(MARKED, F.transform(F.split(PACKED, SEPARATOR), lambda text: F.when(text != NULL, text))))
    return parts.select(*[_unpacked(texts.index(c)).alias(c) if c in texts else F.col(_quoted(c)) for c in df.columns])


def _rebalanced(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df.hint("rebalance", *by) if by else df


def _packed(texts: list[Column]) -> list[Column]:
    """The texts as one, or as an array where one of them holds a mark or no valid text."""
    whole = F.concat_ws("", *texts)
    plain = F.concat_ws(SEPARATOR, *[F.coalesce(text, F.lit(NULL)) for text in texts])
    marked = ~F.is_valid_utf8(plain) | whole.contains(SEPARATOR) | whole.contains(NULL)
    return [F.when(~marked, plain).alias(PACKED), F.when(marked, F.array(*texts)).alias(MARKED)]


def _unpacked(place: int) -> Column:
    return F.get(F.col(PACKED), F.lit(place))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def dedup_rows_by_hash(df: DataFrame) -> DataFrame:
    """The same rows as `dedup_rows`, by way of 8-byte hashes.

    Only rows that share a hash, copies and the odd collision alike, go through the full comparison. Reads its input
    three times. It pays off for wide rows on columnar storage where copies are so rare that Spark broadcasts the
    repeated hashes; otherwise both joins shuffle whole rows by their hash, and `dedup_rows` is the better form.
    """
    hashed = df.withColumn("_row_hash", F.xxhash64(*df.columns))
    repeated = hashed.groupBy("_row_hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_row_hash")
    unique = hashed.join(repeated, "_row_hash", "left_anti").drop("_row_hash")
    copies = hashed.join(repeated, "_row_hash", "left_semi").drop("_row_hash")
    return unique.unionByName(copies.dropDuplicates())

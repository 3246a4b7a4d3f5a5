"""Exact de-duplication that splits frequent digests from the others."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveylake.llm.common import kept_once, table, written

#: Frequent digests that are broadcast, counters of a sketch, and sketches.
HEAVY = 256
COUNTERS = 4096
SKETCHES = 64


def normalised(text: Column) -> Column:
    """The text with each run of blanks as one space; a null text is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def frequent_values(df: DataFrame, column: str, most: int = HEAVY, counters: int = COUNTERS) -> DataFrame:
    """At most `SKETCHES` times `most` values of a string column, among them all that make up 1 / `most` of all rows.

    The sketch is that of Misra and Gries: a bounded set of counters from which all are lowered when a value finds no
    free one; any value with more than about 1.4 / `counters` of the rows stays in. The rows' partitions are dealt to
    a fixed number of sketches, and a value that is frequent in all is so in one of them; so no task merges more than
    its share, and the bound does not depend on the rows.
    """
    part = F.pmod(F.spark_partition_id(), F.lit(SKETCHES))
    tops = df.groupBy(part.alias("part")).agg(F.expr(f"approx_top_k(`{column}`, {most}, {counters})").alias("top"))
    return tops.select(F.explode("top").alias("t")).where("t.count > 1").select(F.col("t.item").alias(column)).distinct()


def grouped(rows: DataFrame, digest: str, order: list[str], most: int = HEAVY) -> DataFrame:
    """Every row with `first` (its digest's smallest `order` values as a struct) and `group_size`.

    `rows` is read several times and has to be a written table. Frequent digests are found by sketches and verified:
    counted exactly, with their first row, by tasks that each give a row per candidate. The `most` largest win; they
    are broadcast, and their rows are settled where they are read. Only the other rows are shuffled by digest.
    """
    first = F.min(F.struct(*order))
    candidates = frequent_values(rows, digest, most)
    winners = rows.join(F.broadcast(candidates), digest).groupBy(digest).agg(
        first.alias("first"), F.count(F.lit(1)).alias("group_size")
    )
    winners = written(winners.orderBy(F.desc("group_size"), digest).limit(most), "frequent-digests")
    heavy = rows.join(F.broadcast(winners), digest)
    rest = rows.join(F.broadcast(winners.select(digest)), digest, "left_anti")
    group = Window.partitionBy(digest)
    rest = rest.withColumns({"first": first.over(group), "group_size": F.count(F.lit(1)).over(group)})
    return heavy.unionByName(rest)


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id`, `keep_id`, `group_size`, `kept`, `text_sha256` of every row.

    Texts are equal if they are after `normalised`; a null text is empty. Of equal texts the row with the smallest
    key stays, a null key only where there is no other, and of repeated rows with that key one. The texts are read
    once, to a table of digests.
    """
    digests = docs.select(
        F.col(key).alias("doc_id"),
        F.sha2(normalised(F.col(text)), 256).alias("text_sha256"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("no_key", F.col("doc_id").isNull())
    found = grouped(written(digests, "digests"), "text_sha256", ["no_key", "doc_id", "row"])
    return found.select(
        "doc_id",
        F.col("first.doc_id").alias("keep_id"),
        F.col("group_size").cast("long").alias("group_size"),
        (F.col("row") == F.col("first.row")).alias("kept"),
        "text_sha256",
    )


def without_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of equal texts, with all its columns: that which `exact_groups` keeps."""
    judged = exact_groups(docs, key, text).select("doc_id", "text_sha256", "kept")
    return kept_once(docs, judged, key, F.sha2(normalised(F.col(text)), 256))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents"))


def sql(source: str = "documents") -> str:
    return f"""
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, row_number() OVER (g ORDER BY doc_id) = 1 AS kept,
       text_sha256
FROM (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM {source})
WINDOW g AS (PARTITION BY text_sha256)"""


OP2_SQL = sql()

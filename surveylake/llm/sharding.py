"""Shards of shuffled records by a two-pass external shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveylake.llm.common import free_names, table, written

SHARDS = 16
SEED = 20
#: Bytes of text that a bucket holds on average: what a task shuffles in memory.
BUCKET_BYTES = 16 << 20
#: Buckets whose counts are summed up together.
BLOCK = 1024
#: Most tasks of the second pass; where there are more buckets, a task takes several.
MAX_TASKS = 50_000
#: The new columns.
NEW = ("size", "shard", "slot")


def sharded(
    docs: DataFrame, shards: int = SHARDS, seed: int = SEED, text: str = "text", bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Every row with its columns, and `size`, `shard`, `slot`: all rows in random order, cut into even shards.

    Shards differ by one row at most; slots count from 0 without gaps. The first pass numbers the rows, scatters them
    over buckets by a seeded hash of their number, so equal keys or texts do not meet and all buckets are about as
    large, and writes them: counts and records come from that one table, even if the input would differ when read
    again. The second puts the rows of a bucket in order and shuffles them by Fisher and Yates. A bucket's place among
    all is the number of rows in the buckets before it, so that no task sees more than the buckets dealt to it.

    The columns travel as a struct; a new column whose name the input has gets underscores in front
    (`free_names(docs, *NEW)`). A null text has size 1, nulls in other columns stay, repeated rows each have a slot of
    their own, and an empty table gives no rows. A very long text makes its bucket larger by its size.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    buckets = max(1, -(-total // bucket_bytes))
    numbered = docs.select(
        F.struct(F.monotonically_increasing_id().alias("row"), size.alias("size"), F.struct("*").alias("doc")).alias("record")
    )
    bucket = F.pmod(F.xxhash64("record.row", F.lit(seed)), F.lit(buckets))
    scattered = written(numbered.withColumn("bucket", bucket), "buckets")
    counts = scattered.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    rows = max(scattered.count(), 1)
    # Structs compare by the row number first, which does not repeat.
    dealt = scattered.repartition(min(2 * buckets, MAX_TASKS), "bucket")
    mixed = dealt.groupBy("bucket").agg(F.shuffle(F.array_sort(F.collect_list("record")), seed).alias("records"))
    each = mixed.join(_starts(counts), "bucket").select("start", F.posexplode("records").alias("place", "record"))
    at = F.col("start") + F.col("place")
    shard = F.expr(f"cast((start + place) * {shards} div {rows} as int)")
    found = each.select("record.doc", "record.size", at.alias("at"), shard.alias("shard"))
    first = F.expr(f"(shard * {rows}L + {shards - 1}) div {shards}")
    new = [F.col("size"), F.col("shard"), F.col("at") - first]
    return found.select("doc.*", *[c.alias(n) for c, n in zip(new, free_names(docs, *NEW))])


def _starts(counts: DataFrame) -> DataFrame:
    """Rows in all buckets before each: sums within blocks of buckets, and over the blocks."""
    counts = counts.withColumn("block", F.expr(f"bucket div {BLOCK}"))
    before = lambda w: F.coalesce(F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = counts.withColumn("inner", before(Window.partitionBy("block").orderBy("bucket")))
    blocks = counts.groupBy("block").agg(F.sum("n").alias("n"))
    blocks = blocks.select("block", before(Window.partitionBy(F.lit(0)).orderBy("block")).alias("outer"))
    return within.join(blocks, "block").select("bucket", (F.col("inner") + F.col("outer")).alias("start"))


def write_shards(docs: DataFrame, path: str, **how) -> None:
    """Writes a folder per shard (`shard=N`, or the free name of `sharded`), its rows by slot within each file."""
    _, shard, slot = free_names(docs, *NEW)
    sharded(docs, **how).sortWithinPartitions(shard, slot).write.partitionBy(shard).parquet(path)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    size, shard, slot = free_names(docs, *NEW)
    return sharded(docs).select(
        "doc_id",
        F.col(size).alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col(shard).alias("shard"),
        F.col(slot).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )

"""Token counts of texts by a vocabulary compiled into a finite-state transducer."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import each_value, slices, table
from surveylake.llm.transducer import compiled

#: Characters that a task works on at once.
SLICE = 1 << 20


def token_counts(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_bytes`, `n_tokens` of every row: what the tokenizers library gives for whole texts.

    No tokens are added or cut; a special string inside a text is one token, as by that library's default. A null
    text is empty and has no tokens. Keys may be null or repeated: each row has its own result. Other columns are
    ignored, whatever their names. `vocabulary` is the path of a byte-level BPE `.json`, read on the driver; its
    bytes (a file of fixed size) are broadcast. A text is worked on as a whole, in memory of about 30 times its size.
    """
    file = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def count(batches):
        machine = compiled(file.value)
        for batch in batches:
            for first, texts in slices(each_value(batch.column(1)), SLICE):
                part = batch.slice(first, len(texts)).column(0)
                yield pa.RecordBatch.from_arrays([part, pa.array(machine.counts(texts))], ["key", "n_tokens"])

    rows = docs.select(F.struct(F.col(key).alias("k"), F.octet_length(F.coalesce(text, F.lit(""))).alias("n")).alias("key"), text)
    kind = rows.schema["key"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key {kind}, n_tokens bigint")
    return counted.select(F.col("key.k").alias(key), F.col("key.n").cast("long").alias("n_bytes"), "n_tokens")


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)

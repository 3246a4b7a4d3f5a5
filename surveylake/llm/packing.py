"""Best-fit packing of tokenised documents into sequences of bounded length."""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from surveylake.llm.common import each_value, slices, table, written
from surveylake.llm.transducer import compiled

CAPACITY = 2048
END_ID = 0
SLICE = 1 << 20
#: Parts into which the pieces of one length are dealt to be numbered: so many, and more where a part would get more
#: pieces of a length than that, so that no task numbers many.
PARTS, PART_PIECES = 256, 1 << 17


def tokenised_pieces(
    docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END_ID, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """`key`, `piece`, `start`, `length`, `ids` (little-endian 32-bit), `ids_crc32`, `row` of every piece.

    A document is its ids and the end id; a null text is empty and so has the end id alone. Only documents longer
    than the capacity are cut, from their end, so that only the first piece may be shorter. `row` numbers pieces
    without repeats, also where keys are null or repeated.
    """
    file = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def cut(batches):
        machine, row = compiled(file.value), TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in slices(each_value(batch.column(1)), SLICE):
                ids, at = machine.ids(texts)
                ids = np.insert(ids.astype("<u4"), at[1:], end)
                at = at + np.arange(len(at))
                size = np.diff(at)
                pieces = -(-size // capacity)
                owner = np.repeat(np.arange(len(texts)), pieces)
                number = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                first_size = (size - 1) % capacity + 1
                start = np.where(number > 0, first_size[owner] + (number - 1) * capacity, 0)
                length = np.where(number > 0, capacity, first_size[owner])
                raw, begin = ids.tobytes(), 4 * (at[owner] + start)
                parts = [raw[b : b + 4 * n] for b, n in zip(begin.tolist(), length.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(first, len(texts)).column(0).take(pa.array(owner)),
                        pa.array(number.astype(np.int32)),
                        pa.array(start.astype(np.int64)),
                        pa.array(length.astype(np.int64)),
                        pa.array(parts, pa.binary()),
                        pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                        pa.array(row + np.arange(len(owner))),
                    ],
                    [key, "piece", "start", "length", "ids", "ids_crc32", "row"],
                )
                row += len(owner)

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, piece int, start bigint, length bigint, ids binary, ids_crc32 bigint, row bigint"
    return docs.select(key, text).mapInArrow(cut, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """How pieces of each length go into bins: (length, first rank, bins, per bin, first bin, offset) per run.

    The pieces of a length are told apart by rank only, so equal bins are handled as one run with a number of bins,
    and the work depends on the number of lengths, not of pieces. Lengths above a third of the capacity come at most
    twice in a bin: the longest is matched with the longest that still fits beside it. The others, longest first, go
    into the smallest gap that takes them; a gap takes as many equal ones as it can.
    """
    left = {n: c for n, c in counts.items() if c}
    taken: dict[int, int] = defaultdict(int)
    gaps: list[int] = []
    runs: dict[int, list[tuple[int, list]]] = defaultdict(list)  # by gap: bins, and their (length, rank, per bin, offset)

    def put(bins: int, gap: int, items: list) -> None:
        if bins:
            if not runs[gap]:
                insort(gaps, gap)
            runs[gap].append((bins, items))

    def take(length: int, bins: int, each: int, offset: int) -> tuple[int, int, int, int]:
        rank, taken[length], left[length] = taken[length], taken[length] + bins * each, left[length] - bins * each
        return length, rank, each, offset

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        long = large[-1]
        fits = bisect_left(large, capacity - long + 1) - 1
        short = large[fits] if fits >= 0 else None
        if short == long and left[long] < 2:
            short = large[fits - 1] if fits > 0 else None
        if short is None:
            bins = left[long]
            put(bins, capacity - long, [take(long, bins, 1, 0)])
        elif short == long:
            bins = left[long] // 2
            put(bins, capacity - 2 * long, [take(long, bins, 2, 0)])
        else:
            bins = min(left[long], left[short])
            put(bins, capacity - long - short, [take(long, bins, 1, 0), take(short, bins, 1, long)])
        large = [n for n in large if left[n]]

    def split(items: list, bins: int) -> list:
        return [(n, rank + bins * each, each, offset) for n, rank, each, offset in items]

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            place = bisect_left(gaps, length)
            if place == len(gaps):
                put(-(-left[length] // (capacity // length)), capacity, [])
                continue
            gap = gaps[place]
            bins, items = runs[gap].pop()
            if not runs[gap]:
                gaps.pop(place)
            each = gap // length
            full = min(bins, left[length] // each)
            rest = left[length] - full * each if full < bins else 0
            if full:
                put(full, gap - each * length, [*items, take(length, full, each, capacity - gap)])
                items, bins = split(items, full), bins - full
            if rest:
                put(1, gap - rest * length, [*items, take(length, 1, rest, capacity - gap)])
                items, bins = split(items, 1), bins - 1
            put(bins, gap, items)

    found, bin_number = [], 0
    for gap in gaps:
        for bins, items in runs[gap]:
            found += [(n, rank, bins, each, bin_number, offset) for n, rank, each, offset in items]
            bin_number += bins
    return found


def pack(pieces: DataFrame, capacity: int = CAPACITY, parts: int = PARTS, part_pieces: int = PART_PIECES) -> DataFrame:
    """Every piece with `sequence_id` and `offset`; no sequence holds more than the capacity.

    `pieces` is read three times and has to be a written table. The driver sees the number of pieces of each length
    (at most `capacity` rows) and sends back the plan, a few rows per length: both are broadcast whole. Pieces of a
    length are numbered in `parts` dealt parts, or as many more as keep the parts of the commonest length near
    `part_pieces`, so that one frequent length is no single task. Only numbers are shuffled with the columns that the
    caller goes on to use.
    """
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    parts = max(parts, -(-max(counts.values(), default=0) // part_pieces))
    schema = "_length bigint, _rank bigint, _bins bigint, _each bigint, _bin bigint, _offset bigint"
    runs = spark.createDataFrame(plan(counts, capacity), schema)

    dealt = pieces.withColumn("_part", F.pmod(F.xxhash64("row"), F.lit(parts)))
    sizes = dealt.groupBy("length", "_part").agg(F.count(F.lit(1)).alias("_size"))
    before = Window.partitionBy("length").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    numbered = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("length", "_part").orderBy("row")))
    ranked = numbered.join(sizes, ["length", "_part"]).withColumn("_at", F.col("_before") + F.col("_n") - 1)
    inside = (F.col("_at") >= F.col("_rank")) & (F.col("_at") < F.col("_rank") + F.col("_bins") * F.col("_each"))
    placed = ranked.join(F.broadcast(runs), (F.col("length") == F.col("_length")) & inside)
    within = F.col("_at") - F.col("_rank")
    return placed.select(
        *pieces.columns,
        (F.col("_bin") + F.floor(within / F.col("_each"))).alias("sequence_id"),
        (F.col("_offset") + within % F.col("_each") * F.col("length")).alias("offset"),
    )


def sequences(packed: DataFrame) -> DataFrame:
    """`sequence_id`, `length` and `ids` of every packed sequence; each group is at most one sequence long."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate(parts, F.lit(b""), lambda done, part: F.concat(done, part["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), joined.alias("ids"))


def pack_documents(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end: int = END_ID) -> DataFrame:
    """Packed pieces of documents: see `tokenised_pieces` and `pack`. An empty table gives no rows."""
    return pack(written(tokenised_pieces(docs, vocabulary, capacity, end), "pieces"), capacity)


DIGEST = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")).select(DIGEST)

"""Spelling variants: words one edit apart, found by dense comparison of blocks of padded code points."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import table, written

#: Letters of a run: these two ranges and the capitals that are lower-cased.
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = "a-zÀ-ÿ"
#: Least length and occurrences of a word, and how much commoner a form is than its variant.
LENGTH, OCCURRENCES, COMMONER = 7, 2, 10
#: A run loses a letter where this divides its hash.
LOSES = 31
#: Pieces a word is cut into, of which a single edit touches one; at most as many as the shortest word has letters.
PIECES = 3
#: Words of a tile's side, and of a block of a larger group.
TILE, BLOCK = 128, 4096


def runs_with_losses(key: Column, run: Column) -> Column:
    """The run, without the letter that its hash names where `LOSES` divides the hash; a null key counts as empty."""
    h = F.crc32(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = (h % F.char_length(run)).cast("int")
    shorter = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(h % LOSES == 0, shorter).otherwise(run)


def counted_words(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`word`, `n`: the runs of letters of all whole texts, with losses, that are long and frequent enough.

    A run shorter than the least length cannot give a word and is not taken out of the text. Tasks count in part, so
    a word that makes up a third of all runs is no hot key.
    """
    lower = F.translate(F.coalesce(F.col(text), F.lit("")), CAPITALS, CAPITALS.lower())
    found = F.regexp_extract_all(lower, F.lit(f"[{LETTERS}]{{{LENGTH},}}"), F.lit(0))
    each = docs.select(F.col(key).alias("key"), F.explode(found).alias("run"))
    words = each.select(runs_with_losses(F.col("key"), F.col("run")).alias("word")).where(F.char_length("word") >= LENGTH)
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OCCURRENCES)


def keyed(words: DataFrame, pieces: int = PIECES) -> DataFrame:
    """Each word once for every key that a near word may share: `longer`, `piece`, `rest`, `word`, `n`.

    Of two near words let `longer` be the length of the longer one, cut into pieces. One edit lies in one piece, and
    what comes before and after this piece is equal. So a word meets words of its own length and one less, and those
    of one more, by a hash of all but one piece. However many words begin or end alike, a key joins only words that
    differ in a short piece.
    """
    at = F.explode(F.expr(f"sequence(0, {2 * pieces - 1})")).alias("at")
    each = words.select("word", "n", at)
    each = each.withColumns({"longer": F.expr(f"char_length(word) + at div {pieces}").cast("int"), "piece": F.expr(f"at % {pieces}")})
    begin, end = f"cast(longer * piece div {pieces} as int)", f"cast(longer * (piece + 1) div {pieces} as int)"
    rest = F.expr(f"xxhash64(substring(word, 1, {begin}), right(word, longer - {end}))")
    return each.select("longer", "piece", rest.alias("rest"), "word", "n")


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words as rows of code points, padded at the end and padded at the front, and their lengths."""
    size = np.array([len(w) for w in words], np.int32)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    wide = flat.astype(np.min_scalar_type(int(flat.max(initial=0))))
    width = int(size.max(initial=0))
    left, right = np.zeros((2, len(words), width), wide.dtype)
    place = np.arange(width)
    left[place < size[:, None]] = wide
    right[place >= width - size[:, None]] = wide
    return left, right, size


def common(a: np.ndarray, b: np.ndarray, places: Iterator[int]) -> np.ndarray:
    """How many places, in the given order, each row of `a` and each of `b` have alike before the first that differs."""
    alike = np.ones((len(a), len(b)), bool)
    total = np.zeros((len(a), len(b)), np.int16)
    for place in places:
        alike &= a[:, place, None] == b[None, :, place]
        if not alike.any():
            break
        total += alike
    return total


def near(one: tuple, other: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Which rows of two blocks are one edit apart, and the place of the edit in the longer one.

    Words differ by one edit if their common prefix and suffix together reach the longer length less one. Equal words
    are never met: words are distinct, and a pair is compared once.
    """
    (left, right, size), (left2, right2, size2) = one, other
    width = left.shape[1]
    short, long = np.minimum(size[:, None], size2), np.maximum(size[:, None], size2)
    prefix = np.minimum(common(left, left2, range(width)), short)
    suffix = np.minimum(common(right, right2, range(width - 1, -1, -1)), short)
    return (prefix + suffix >= long - 1) & (long - short <= 1), np.minimum(prefix, long - 1)


def tiles(group: np.ndarray, size: int = TILE) -> Iterator[tuple[slice, slice]]:
    """Block pairs of rows in order that hold all pairs of rows of equal groups: each block, and those its last group reaches."""
    ends = np.append(np.flatnonzero(np.diff(group)) + 1, len(group))
    for a in range(0, len(group), size):
        last = min(a + size, len(group)) - 1
        reach = ends[np.searchsorted(ends, last, "right")]
        for b in range(a, reach, size):
            yield slice(a, last + 1), slice(b, min(b + size, reach))


def compared(
    group: np.ndarray, longer: np.ndarray, piece: np.ndarray, side: np.ndarray, words: list[str], n: np.ndarray, pieces: int
) -> tuple[np.ndarray, np.ndarray]:
    """For each row its number of near words in its group, and the row of the commonest of them (-1: none).

    A pair counts where its edit lies in the group's piece, so it counts under one key only, even where the edit may
    be seen at several places. Where a group is split (`side` 0 or 1; else -1) only pairs between its two blocks count.
    """
    left, right, size = code_points(words)
    order = np.argsort(np.array(words, object), kind="stable") if len(words) else np.zeros(0, np.int64)
    alphabetic = np.empty(len(words), np.int64)
    alphabetic[order] = np.arange(len(words))
    # Larger is better: more occurrences, then earlier in code-point order.
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((-alphabetic, n))] = np.arange(len(words))
    by_rank = np.argsort(rank)
    count, best = np.zeros(len(words), np.int64), np.full(len(words), -1)
    for a, b in tiles(group):
        same = group[a, None] == group[None, b]
        same &= (side[a, None] < 0) | (side[a, None] != side[None, b])
        if a.start == b.start:
            same &= np.tri(a.stop - a.start, b.stop - b.start, -1, bool).T
        if not same.any():
            continue
        found, place = near((left[a], right[a], size[a]), (left[b], right[b], size[b]))
        long = longer[a, None]
        begin, end = long * piece[a, None] // pieces, long * (piece[a, None] + 1) // pieces
        found &= same & (np.maximum(size[a, None], size[None, b]) == long) & (place >= begin) & (place < end)
        if not found.any():
            continue
        count[a] += found.sum(1)
        count[b] += found.sum(0)
        best[a] = np.maximum(best[a], np.where(found, rank[None, b], -1).max(1))
        best[b] = np.maximum(best[b], np.where(found, rank[a, None], -1).max(0))
    return count, np.where(best >= 0, by_rank[best], -1)


def near_words(words: DataFrame, pieces: int = PIECES, block: int = BLOCK) -> DataFrame:
    """`word`, `n_near`, and `best` (its commonest near word with its count; ties: the smallest) of words with near words.

    `words` (`word`, `n`) is read twice and has to be a written table of distinct words. Words meet by `keyed`. A key
    of more words than a block is compared block by block, each pair of blocks in a task of its own, so no task holds
    a large group. Tasks give a row a word and key, never the pairs.
    """
    rows = written(keyed(words, pieces), "word-keys")
    names = ["longer", "piece", "rest"]
    sizes = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = rows.join(sizes, names).withColumn("blocks", F.expr(f"cast(ceil(members / {block}) as int)"))
    met = met.withColumn("own", F.expr("cast(pmod(xxhash64(word), blocks) as int)")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    met = met.withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    met = met.withColumn("side", F.when(F.col("i") == F.col("j"), -1).when(F.col("own") == F.col("i"), 0).otherwise(1))
    keys = [*names, "i", "j"]
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = met.select(*keys, "side", "word", "n").repartition(parts, *keys).sortWithinPartitions(*keys)

    def compare(batches):
        for rows in whole_groups(batches, len(keys)):
            columns = [rows.column(k).to_numpy() for k in range(len(keys))]
            group = np.cumsum(np.append(0, np.any([c[1:] != c[:-1] for c in columns], axis=0))) if rows.num_rows else np.zeros(0, int)
            texts, n = rows.column("word").to_pylist(), rows.column("n").to_numpy()
            count, best = compared(group, columns[0], columns[1], rows.column("side").to_numpy(), texts, n, pieces)
            hit = np.flatnonzero(count)
            of = best[hit]
            yield pa.RecordBatch.from_arrays(
                [pa.array([texts[r] for r in hit], pa.string()), pa.array(count[hit]), pa.array(n[of]), pa.array([texts[r] for r in of], pa.string())],
                ["word", "n_near", "best_n", "best"],
            )

    found = dealt.mapInArrow(compare, "word string, n_near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))


def whole_groups(batches, keys: int) -> Iterator[pa.Table]:
    """The rows of sorted batches, cut only where the first columns change."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        key = tuple(c[0] for c in columns)
        if held and key != tuple(held[-1].column(k)[held[-1].num_rows - 1].as_py() for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        if len(cuts):
            yield pa.Table.from_batches([*held, batch.slice(0, int(cuts[-1]))])
            held = [batch.slice(int(cuts[-1]))]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def spelling_variants(words: DataFrame, pieces: int = PIECES, commoner: int = COMMONER) -> DataFrame:
    """`word`, `form`, `root`, `n`, `n_near`, `form_n` of every word of `words` (`word`, `n`; distinct words).

    Near words differ by one inserted, deleted or replaced code point. A word's form is its commonest near word
    (ties: the smallest in code-point order), if that is `commoner` times as common at least. Its root is the last of
    the forms that follow; as counts grow tenfold from form to form, a few joins reach it. An empty table gives none.
    """
    words = written(words.select("word", "n"), "words")
    found = near_words(words, pieces)
    known = words.join(found, "word", "left")
    is_form = -F.col("best.less") >= commoner * F.col("n")
    known = known.select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best.word")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n"),
    )
    known = written(known, "word-forms")
    ways = written(known.where("form is not null").select("word", F.col("form").alias("root")), "word-roots")
    while True:
        nexts = ways.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = ways.join(nexts, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        further = written(further, "word-roots")
        ways = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    return known.join(ways, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(counted_words(table(spark, sf_dir, "documents")))

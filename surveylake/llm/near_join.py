"""Similarity join on the Jaccard similarity of word shingles, with Bayesian pruning of candidates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import each_value, kept_once, settled, slices, table, worker_state, written
from surveylake.llm.components import connected
from surveylake.llm.exact_dedup import grouped

WORDS = 5
THRESHOLD = 0.8
#: Bands of hashes that make candidates: a pair at the threshold shares none with a chance of (1 - 0.8 ** 6) ** 40,
#: five in a million.
BANDS, ROWS = 40, 6
#: Hashes that candidates are compared by, so many at a time, and the chance of a link at which a pair is dropped.
COMPARED, AT_ONCE = 96, 16
TOLERANCE = 1e-7
#: Bands that the first round of candidates looks at.
FIRST = 2
#: Documents, and shingles, of a block; a larger group is compared block by block.
BLOCK = 2048
BLOCK_SHINGLES = 1 << 20
SLICE = 1 << 20
_U = np.uint64


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _numbers(count: int, seed: int) -> np.ndarray:
    """A fixed row of 64-bit numbers that look random."""
    return _mixed(np.arange(1, count + 1, dtype=_U) * _U(0x9E3779B97F4A7C15) + _U(seed))


def shingles(texts: list[str], words: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the word shingles of all texts together, and where each text's begin, with the end last.

    Words are runs without blanks, lower-cased. A text of fewer words has one shingle of them all, one without words
    has none. Repeated shingles are given as often as they occur.
    """
    raw = [text.lower().encode() for text in texts]
    data = np.frombuffer(b" ".join([*raw, b""]) if raw else b"", np.uint8)
    ends_at = np.cumsum([len(r) + 1 for r in raw])
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    word = np.flatnonzero(~blank & np.append(True, blank[:-1])) if len(data) else np.zeros(0, np.int64)
    if not len(word):
        return np.zeros(0, _U), np.zeros(len(texts) + 1, np.int64)
    length = np.flatnonzero(blank & np.append(False, ~blank[:-1])) - word
    since = np.repeat(np.append(0, word), np.diff(np.concatenate([[0], word, [len(data)]])))
    place = np.arange(len(data)) - since
    weight = _numbers(int(length.max()) + 1, 1)
    terms = np.where(blank, _U(0), (data.astype(_U) + _U(1)) * weight[np.minimum(place, length.max())])
    hashes = _mixed(np.add.reduceat(terms, word) + length.astype(_U))
    first_word = np.searchsorted(word, np.append(0, ends_at))
    count = np.diff(first_word)
    made = np.where(count >= words, count - words + 1, np.minimum(count, 1))
    firsts = np.append(0, np.cumsum(made))
    owner = np.repeat(np.arange(len(texts)), made)
    start = first_word[owner] + np.arange(len(owner)) - firsts[owner]
    total = np.zeros(len(owner), _U)
    for k, factor in enumerate(_numbers(words, 2) | _U(1)):
        inside = k < count[owner]
        total += np.where(inside, hashes[np.minimum(start + k, len(hashes) - 1)], _U(0)) * factor
    return _mixed(total), firsts


def smallest(hashes: np.ndarray, firsts: np.ndarray, count: int, seed: int) -> np.ndarray:
    """A row per text with shingles: `count` MinHash values of 32 bits."""
    some = firsts[:-1][np.diff(firsts) > 0]
    found = np.empty((count, len(some)), np.uint32)
    for n, (factor, shift) in enumerate(zip(_numbers(count, seed) | _U(1), _numbers(count, seed + 1))):
        found[n] = np.minimum.reduceat(((hashes * factor + shift) >> _U(32)).astype(np.uint32), some) if len(some) else 0
    return found.T


def compared(hashes: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The MinHash values by which candidates are compared, none of which a band uses; 16 bits of each."""
    return smallest(hashes, firsts, COMPARED, 30).astype(np.uint16)


def least_matches(compared_: int, threshold: float, tolerance: float) -> int:
    """Fewest matches of so many values at which a link is still likely enough.

    With all similarities alike likely beforehand, the similarity after m matches of n has a Beta(1 + m, 1 + n - m)
    distribution; its chance to reach the threshold is that of at most m successes in n + 1 trials at the threshold.
    """
    n, chance = compared_ + 1, 0.0
    for m in range(compared_ + 1):
        chance += comb(n, m) * threshold**m * (1 - threshold) ** (n - m)
        if chance >= tolerance:
            return m
    return compared_


def cutoffs(threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> list[int]:
    """The fewest matches at each stop of the comparison."""
    return [least_matches(n, threshold, tolerance) for n in range(AT_ONCE, COMPARED + 1, AT_ONCE)]


def likely(left: np.ndarray, right: np.ndarray, fewest: list[int]) -> np.ndarray:
    """Which pairs of rows may be links: values are compared some at a time, and a pair is dropped once it is unlikely."""
    alive, matches = np.arange(len(right)), np.zeros(len(right), np.int16)
    for stop, least in enumerate(fewest):
        part = slice(stop * AT_ONCE, (stop + 1) * AT_ONCE)
        own = left[part] if left.ndim == 1 else left[alive, part]
        matches[alive] += (own == right[alive, part]).sum(1, dtype=np.int16)
        alive = alive[matches[alive] >= least]
        if not len(alive):
            break
    kept = np.zeros(len(right), bool)
    kept[alive] = True
    return kept


def forest(values: np.ndarray, fewest: list[int], label: np.ndarray, block: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Edges between labels that connect whatever likely links connect, without trying rows that are connected already.

    Each row is compared with the later rows of other groups, in other blocks if blocks are given; where a link is
    found the groups become one. So there are fewer edges than labels, however many rows have them.
    """
    edges, _, group = [], *np.unique(label, return_inverse=True)
    for one in range(len(values) - 1):
        others = one + 1 + np.flatnonzero(group[one + 1 :] != group[one])
        if block is not None:
            others = others[block[others] != block[one]]
        for other in others[likely(values[one], values[others], fewest)].tolist():
            if group[other] != group[one]:
                edges.append((int(label[one]), int(label[other])))
                group[group == group[other]] = group[one]
        if (group == group[0]).all():
            break
    return edges


def runs(batches, keys: int) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows of consecutive equal first columns, put together over the ends of batches."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
            key = tuple(c[a].item() for c in columns)
            if held and key != current:
                yield current, pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield current, pa.Table.from_batches(held)


def sketches(texts: DataFrame) -> DataFrame:
    """`row`, `set_id`, `n_shingles`, `bands`, `sketch` of every row with a word. Equal sets have the same `set_id`."""

    def sketch(batches):
        worker_state("near join")
        for batch in batches:
            for first, part in slices(each_value(batch.column(1)), SLICE):
                hashes, firsts = shingles(part)
                some = np.flatnonzero(np.diff(firsts))
                sets = [np.unique(hashes[firsts[i] : firsts[i + 1]]) for i in some]
                values = smallest(hashes, firsts, BANDS * ROWS, 10).astype(_U).reshape(len(some), BANDS, ROWS)
                bands = _mixed((values * (_numbers(ROWS, 20) | _U(1))).sum(2, dtype=_U) + np.arange(BANDS, dtype=_U) * _U(0x9E3779B97F4A7C15))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.slice(first, len(part)).column(0).take(pa.array(some)),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() for s in sets], pa.string()),
                        pa.array([len(s) for s in sets], pa.int32()),
                        pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                        pa.array([v.tobytes() for v in compared(hashes, firsts)], pa.binary()),
                    ],
                    ["row", "set_id", "n_shingles", "bands", "sketch"],
                )

    return texts.select("row", "text").mapInArrow(sketch, "row bigint, set_id string, n_shingles int, bands array<bigint>, sketch binary")


def _blocks(members: DataFrame, key: str, blocks, across: bool) -> DataFrame:
    """Members of a group with the block they are in (`i` = `j`), or across blocks once for each pair that holds theirs."""
    dealt = members.withColumn("_blocks", blocks.cast("int")).withColumn("block", F.expr("pmod(xxhash64(row), _blocks)").cast("int"))
    if across:
        other = dealt.withColumn("_other", F.explode(F.expr("sequence(0, _blocks - 1)"))).where("block != _other")
    else:
        other = dealt.withColumn("_other", F.col("block"))
    pairs = other.withColumns({"i": F.least("block", "_other"), "j": F.greatest("block", "_other")}).drop("_blocks", "_other")
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return pairs.repartition(parts, key, "i", "j").sortWithinPartitions(key, "i", "j")


def likely_groups(sketched: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """`node`, `label` of the rows that likely links connect with others: no link runs between two labels.

    Rows that share a band are candidates. Bands with one row are left out by a count that tasks sum up in part. The
    others meet by band, in blocks where they are many, and give edges between what is not connected yet, never their
    pairs: a first round looks at few bands, so that most copies get one label; the next at all bands, but only those
    that still hold several labels; the last at the pairs of blocks of such bands of more than a block. Each round
    contracts what it found, so edges stay a few a row, however large a group of near copies is.
    """
    each = sketched.select(F.posexplode("bands").alias("place", "band"), "row")
    shared = written(each.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "shared-bands")
    members = written(each.join(shared, "band"), "band-members")
    labels = contracted(None, _likely_edges(members.where(F.col("place") < FIRST), sketched, None, False, threshold))
    labels = contracted(labels, _likely_edges(members, sketched, labels, False, threshold))
    if not shared.where(F.col("n") > BLOCK).isEmpty():
        labels = contracted(labels, _likely_edges(members.where(F.col("n") > BLOCK), sketched, labels, True, threshold))
    return labels


def contracted(labels: DataFrame | None, edges: DataFrame) -> DataFrame:
    """The labels (`node`, `label`) after edges `a`, `b` between labels, or nodes without one, have joined them."""
    found = connected(edges)
    if labels is None:
        return found
    to = found.select(F.col("node").alias("label"), F.col("label").alias("_to"))
    moved = labels.join(to, "label", "left").select("node", F.coalesce("_to", "label").alias("label"))
    return written(moved.unionByName(found.join(labels, "node", "left_anti")), "labels")


def _likely_edges(members: DataFrame, sketched: DataFrame, labels: DataFrame | None, across: bool, threshold: float) -> DataFrame:
    """Edges `a`, `b` between the labels (a row without one is its own) of likely links within bands."""
    if labels is None:
        members = members.withColumn("label", F.col("row"))
    else:
        known = members.join(labels.withColumnRenamed("node", "row"), "row", "left")
        members = written(known.withColumn("label", F.coalesce("label", "row")), "labelled-members")
        several = members.groupBy("band").agg(F.min("label").alias("_least"), F.max("label").alias("_most")).where("_least != _most")
        members = members.join(several.select("band"), "band")
    met = members.join(sketched.select("row", "sketch"), "row").select("band", "n", "row", "label", "sketch")
    dealt = _blocks(met, "band", F.ceil(F.col("n") / BLOCK), across).select("band", "i", "j", "block", "label", "sketch")

    def connect(batches):
        worker_state("near join")
        fewest = cutoffs(threshold)
        for _, group in runs(batches, 3):
            label, block = group.column("label").to_numpy(), group.column("block").to_numpy()
            values = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(len(label), COMPARED)
            if edges := forest(values, fewest, label, block if across else None):
                a, b = np.array(edges).T
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return dealt.mapInArrow(connect, "a bigint, b bigint").distinct()


def group_sets(texts: DataFrame, groups: DataFrame) -> DataFrame:
    """`row`, `label`, `blocks`, `set`, `sketch` of the rows of `groups` (`node`, `label`, `n_shingles`): their sorted shingles.

    `blocks` is the number of blocks of the label, by its rows and by its shingles.
    """
    sizes = groups.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    blocks = F.greatest(F.ceil(F.col("n") / BLOCK), F.ceil(F.col("total") / BLOCK_SHINGLES)).cast("int")
    sizes = written(sizes.select("label", blocks.alias("blocks")), "group-sizes")
    members = groups.select(F.col("node").alias("row"), "label").join(sizes, "label").join(texts, "row")

    def convert(batches):
        worker_state("near join")
        for batch in batches:
            for first, part in slices(each_value(batch.column("text")), SLICE):
                hashes, firsts = shingles(part)
                sets = [np.unique(hashes[a:b]).tobytes() for a, b in zip(firsts, firsts[1:])]
                kept = [batch.column(n).slice(first, len(part)) for n in ("row", "label", "blocks")]
                # Every text of a group has shingles, so the sketches are as many as the texts.
                sketch = [v.tobytes() for v in compared(hashes, firsts)]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sets, pa.binary()), pa.array(sketch, pa.binary())], SETS)

    return members.select("row", "label", "blocks", "text").mapInArrow(convert, "row bigint, label bigint, blocks int, set binary, sketch binary")


SETS = ["row", "label", "blocks", "set", "sketch"]


def verified(sets: DataFrame, known: DataFrame | None, threshold: float = THRESHOLD) -> DataFrame:
    """What tasks found in `group_sets`: `row` and `links`, its exact number of links, and edges `row`, `to` (else -1).

    Rows of a label meet within their blocks; with `known`, the `node`, `label` of what was linked there, across
    blocks, and edges are between these labels. Pairs are compared by their MinHash values first, and those still
    likely by their shingles.
    """
    rows = sets.withColumn("known", F.col("row"))
    if known is not None:
        names = known.select(F.col("node").alias("row"), F.col("label").alias("_known"))
        rows = sets.where("blocks > 1").join(names, "row", "left").withColumn("known", F.coalesce("_known", "row"))
    dealt = _blocks(rows, "label", F.col("blocks"), known is not None).select("label", "i", "j", "block", "row", "known", "set", "sketch")

    def verify(batches):
        worker_state("near join")
        for (_, i, j), group in runs(batches, 3):
            row, block = group.column("row").to_numpy(), group.column("block").to_numpy()
            found = [np.frombuffer(s, _U) for s in group.column("set").to_pylist()]
            values = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint16).reshape(len(row), COMPARED)
            links, edges = exact_links(found, values, block if i != j else None, threshold, group.column("known").to_numpy())
            some = np.flatnonzero(links)
            to = np.concatenate([np.full(len(some), -1), edges[:, 1]])
            count = np.concatenate([links[some], np.zeros(len(edges), np.int64)])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([row[some], edges[:, 0]])), pa.array(to), pa.array(count)], ["row", "to", "links"])

    return dealt.mapInArrow(verify, "row bigint, to bigint, links bigint")


def exact_links(
    sets: list[np.ndarray], values: np.ndarray, block: np.ndarray | None, threshold: float, known: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Links of each set, and edges that connect the known labels of linked sets. With blocks, only pairs between two count."""
    fewest = cutoffs(threshold)
    links, size = np.zeros(len(sets), np.int64), np.array([len(s) for s in sets])
    label, edges = np.unique(known, return_inverse=True)[1], []
    every, at = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.append(0, np.cumsum(size))
    for one in range(len(sets)):
        others = np.arange(one + 1, len(sets))
        if block is not None:
            others = others[block[others] != block[one]]
        # Sets whose sizes differ too much cannot reach the threshold.
        low, high = np.minimum(size[others], size[one]), np.maximum(size[others], size[one])
        others = others[low >= threshold * high]
        others = others[likely(values[one], values[others], fewest)]
        if not len(others):
            continue
        held = np.zeros(len(every), bool)
        held[at[bounds[one] : bounds[one + 1]]] = True
        done = np.concatenate([at[bounds[o] : bounds[o + 1]] for o in others])
        common = np.add.reduceat(held[done].astype(np.int64), np.append(0, np.cumsum(size[others])[:-1]))
        linked = others[common >= threshold * (size[others] + size[one] - common)]
        links[one] += len(linked)
        links[linked] += 1
        for other in linked[label[linked] != label[one]].tolist():
            if label[other] != label[one]:
                edges.append((known[one], known[other]))
                label[label == label[other]] = label[one]
    return links, np.array(edges, np.int64).reshape(-1, 2)


def _edges(found: DataFrame) -> DataFrame:
    return found.where("to >= 0").select(F.col("row").alias("a"), F.col("to").alias("b"))


def linked_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """`doc_id`, `class_id`, `n_links`, `set_id`, `set_size`, `text_hash`, `kept` of every row.

    Two texts are linked if the Jaccard similarity of their sets of word shingles reaches the threshold. Texts with
    equal sets are represented by the one with the smallest key (`set_id`); `n_links` counts the linked other sets.
    A class holds what links connect, and `class_id` is its smallest key. One row of each class is `kept`: that with
    this key. A text without words is a class of its own, and null keys come last; repeated rows belong to one set.
    A text of any length is shingled whole, in slices of texts; one text is the least that a task holds.

    The bands are made for similarities of `THRESHOLD` or more: a lower threshold finds fewer of the links below it.
    The tables of the steps, the texts among them, are removed once the result is written.
    """
    return settled(docs.sparkSession, "linked", lambda: _linked(docs, key, text, threshold))


def _linked(docs: DataFrame, key: str, text: str, threshold: float) -> DataFrame:
    raw = F.coalesce(F.col(text), F.lit(""))
    texts = docs.select(F.col(key).alias("doc_id"), raw.alias("text"), F.monotonically_increasing_id().alias("row"))
    texts = written(texts, "texts")
    sketched = written(sketches(texts), "sketches")
    rows = texts.select("row", "doc_id", F.xxhash64("text").alias("text_hash"), F.col("doc_id").isNull().alias("no_key"))
    rows = rows.join(sketched.select("row", "set_id"), "row", "left")
    rows = rows.withColumn("set_id", F.coalesce("set_id", F.concat(F.lit("row"), F.col("row").cast("string"))))
    sets = written(grouped(written(rows, "rows"), "set_id", ["no_key", "doc_id", "row"]), "sets")
    heads = sets.where("row = first.row").select("row", "no_key", "doc_id")
    alone = written(sketched.join(heads, "row", "left_semi"), "heads")
    groups = likely_groups(alone, threshold)
    groups = written(groups.join(alone.select(F.col("row").alias("node"), "n_shingles"), "node"), "groups")
    held = written(group_sets(texts.select("row", "text"), groups), "group-sets")
    found = written(verified(held, None, threshold), "links")
    labels = connected(_edges(found))
    if not held.where("blocks > 1").isEmpty():
        across = written(verified(held, labels, threshold), "links")
        labels, found = contracted(labels, _edges(across)), found.unionByName(across)
    links = found.groupBy("row").agg(F.sum("links").alias("n_links"))
    named = labels.join(heads, labels["node"] == heads["row"])
    least = named.groupBy("label").agg(F.min(F.struct("no_key", "doc_id", "row")).alias("least"))
    classes = labels.join(written(least, "classes"), "label").select(F.col("node").alias("head"), "least")
    known = written(classes.join(links, F.col("head") == F.col("row")).select("head", "least", "n_links"), "class-of")
    out = sets.withColumn("head", F.col("first.row")).join(known, "head", "left").withColumn("least", F.coalesce("least", "first"))
    return out.select(
        "doc_id",
        F.col("least.doc_id").alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("first.doc_id").alias("set_id"),
        F.col("group_size").cast("long").alias("set_size"),
        "text_hash",
        (F.col("row") == F.col("least.row")).alias("kept"),
    )


def without_near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows that `linked_documents` keeps, with all their columns; of repeated rows one."""
    judged = linked_documents(docs, key, text, threshold).select("doc_id", "text_hash", "kept")
    return kept_once(docs, judged, key, F.xxhash64(F.coalesce(F.col(text), F.lit(""))))


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linked_documents(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "set_id", "set_size", "kept")

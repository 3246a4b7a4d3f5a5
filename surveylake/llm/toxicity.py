"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surveylake.llm.common import each_value, slices, table, worker_state

SLICE = 1 << 22
KNOWN_WORDS = 400_000
#: Directions in which pairs are looked for, and products to find them.
DIRECTIONS, PRODUCTS = 6, 8
_words = r"[^\W_]+"


@dataclass(frozen=True)
class Settings:
    """How the model is fitted. `sample`: labelled rows of each class at most; the model is fitted on these alone.

    `bits`: of the hashed terms. `stems`: letters of the word beginnings that count as terms besides whole words.
    `evidence`: the likelihood ratio (G) by which a term has to tell the classes apart in the sample, as most terms
    of a text are noise to the model. Terms that do so only in pairs are admitted by `interactions`: `rare` is the
    least number of documents that one needs for it, `clear` how far a direction of such terms has to stand out from
    what shuffled labels give, and `wide` the most terms that it may be spread over. `factors`: of the pairwise interactions; every second one counts negatively, so that
    pairs may speak for a class or against it. `epochs` and `steps`: passes over the sample and gradient steps at least.
    """

    sample: int = 3000
    bits: int = 18
    stems: tuple[int, ...] = (4, 5, 6)
    evidence: float = 11.0
    rare: int = 8
    clear: float = 1.25
    wide: int = 200
    factors: int = 4
    epochs: int = 6
    steps: int = 1000
    batch: int = 32
    rate: float = 0.1
    decay: float = 1e-3
    threshold: float = 0.3
    seed: int = 9


def held_out(key: Column) -> Column:
    return F.crc32(key.cast("string")) % 4 == 2


def term_ids(word: str, settings: Settings) -> list[int]:
    """The hashed terms of a word: itself, and its beginnings."""
    mask = (1 << settings.bits) - 1
    return [zlib.crc32(b"w" + word.encode()) & mask] + [
        zlib.crc32(b"%d" % n + word[:n].encode()) & mask for n in settings.stems if len(word) > n
    ]


def terms(text: str | None, settings: Settings) -> np.ndarray:
    """The distinct hashed terms of a whole text."""
    words = set(re.findall(_words, (text or "").lower()))
    return np.unique(np.array([i for word in words for i in term_ids(word, settings)], np.int32))


@dataclass
class Model:
    """score = logistic(bias + sum of weights + sum over pairs of terms of the products of their factors).

    The pairs of a factor are half of (square of its sum - sum of its squares); every second factor counts negatively,
    as products of equal signs alone could not say that two terms of a kind speak against a class.
    """

    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def raw(self, ids: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Scores of documents whose terms lie together in `ids`; `firsts` says where each begins, with the end last."""
        return self.bias + _sums(self.weights[ids], firsts) + self._pairs(ids, firsts)[0]

    def _pairs(self, ids: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = self.factors[ids]
        total = _sums(own, firsts)
        return 0.5 * (total**2 - _sums(own**2, firsts)) @ signs(own.shape[1]), total


def signs(factors: int) -> np.ndarray:
    return np.where(np.arange(factors) % 2, -1.0, 1.0)


def _sums(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    done = np.concatenate([np.zeros((1, *values.shape[1:])), np.cumsum(values, 0, dtype=np.float64)])
    return done[firsts[1:]] - done[firsts[:-1]]


def logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling(documents: list[np.ndarray], labels: np.ndarray, size: int) -> np.ndarray:
    """The likelihood ratio of each term: how far its share of documents differs between the classes."""
    total = np.zeros(size)
    has = [np.bincount(np.concatenate([np.zeros(0, np.int32), *(d for d, y in zip(documents, labels) if y == c)]), minlength=size) for c in (0, 1)]
    rows = [int((labels == c).sum()) for c in (0, 1)]
    if not min(rows):
        return total
    for with_term in (True, False):
        cells = [h if with_term else n - h for h, n in zip(has, rows)]
        share = (cells[0] + cells[1]) / sum(rows)
        for cell, n in zip(cells, rows):
            total += 2 * cell * np.log(np.maximum(cell, 1e-9) / np.maximum(n * share, 1e-9))
    return total


def interactions(documents: list[np.ndarray], labels: np.ndarray, settings: Settings) -> np.ndarray:
    """Factors to begin with (a row a hashed term), not 0 for terms that matter in pairs.

    The terms' second moments, with terms scaled to equal variance, are taken in each class; their difference without
    its diagonal is what pairs say of the class beyond single terms. Its leading directions come from products with
    the sparse documents alone. A direction counts if it is `clear` times as strong as the strongest with shuffled
    labels and its weight lies on few terms, as one of many tells what documents are about and not what pairs say. So
    do the terms that weigh in it more than chance would have it; the sign of its eigenvalue picks a
    factor that counts positively or negatively.
    """
    size = 1 << settings.bits
    start = np.zeros((size, settings.factors))
    ids = np.concatenate([np.zeros(0, np.int32), *documents])
    count = np.bincount(ids, minlength=size)
    usable = np.flatnonzero((count >= settings.rare) & (count <= len(documents) - settings.rare))
    if not len(usable) or not 0 < labels.sum() < len(labels):
        return start
    place = np.full(size, -1)
    place[usable] = np.arange(len(usable))
    column, row = place[ids], np.repeat(np.arange(len(documents)), [len(d) for d in documents])
    row, column = row[column >= 0], column[column >= 0]
    mean = count[usable] / len(documents)
    scale = 1 / np.sqrt(mean * (1 - mean) * len(usable))
    random = np.random.default_rng(settings.seed)

    def leading(y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        side = np.where(y > 0, 1 / max(1, (y > 0).sum()), -1 / max(1, (y <= 0).sum()))
        # The diagonal: the difference of each term's own variance.
        with_term = np.bincount(column, side[row], minlength=len(usable))
        diagonal = scale**2 * with_term * (1 - 2 * mean)

        def times(v: np.ndarray) -> np.ndarray:
            scaled, out = v * scale[:, None], np.empty_like(v)
            for k in range(v.shape[1]):
                seen = (np.bincount(row, scaled[:, k][column], minlength=len(y)) - mean @ scaled[:, k]) * side
                out[:, k] = np.bincount(column, seen[row], minlength=len(usable)) - mean * seen.sum()
            return out * scale[:, None] - diagonal[:, None] * v

        v = np.linalg.qr(random.normal(size=(len(usable), min(DIRECTIONS, len(usable)))))[0]
        for _ in range(PRODUCTS):
            v = np.linalg.qr(times(v))[0]
        values, turn = np.linalg.eigh(v.T @ times(v))
        return values, v @ turn

    values, vectors = leading(labels)
    chance = np.abs(leading(random.permutation(labels))[0]).max()
    free = {1.0: list(range(0, settings.factors, 2)), -1.0: list(range(1, settings.factors, 2))}
    for k in np.argsort(-np.abs(values)):
        factor = free[1.0 if values[k] > 0 else -1.0]
        weight = vectors[:, k]
        if abs(values[k]) >= settings.clear * chance and factor and 1 / (weight**4).sum() <= settings.wide:
            heavy = np.abs(weight) > 2 / np.sqrt(len(usable)) if len(usable) > 100 else np.abs(weight) > 0.5 / np.sqrt(len(usable))
            start[usable[heavy], factor.pop(0)] = weight[heavy] / np.abs(weight).max()
    return start


def fit(documents: list[np.ndarray], labels: np.ndarray, weight: np.ndarray, settings: Settings) -> Model:
    """Fits weights and factors by gradient steps on small batches, each parameter with a rate of its own."""
    size, random = 1 << settings.bits, np.random.default_rng(settings.seed)
    start = interactions(documents, labels, settings)
    active = (telling(documents, labels, size) >= settings.evidence) | (start != 0).any(1)
    documents = [d[active[d]] for d in documents]
    share = np.clip(np.average(labels, weights=weight) if len(labels) else 0.0, 1e-3, 1 - 1e-3)
    model = Model(float(np.log(share / (1 - share))), np.zeros(size), np.zeros((size, settings.factors)))
    model.factors[active] = random.normal(0, 0.01, (int(active.sum()), settings.factors))
    model.factors += 0.3 * start
    seen_w, seen_v, seen_b = np.full(size, 1e-6), np.full((size, settings.factors), 1e-6), 1e-6
    batches, sign = -(-len(documents) // settings.batch), signs(settings.factors)
    for _ in range(max(settings.epochs, -(-settings.steps // max(1, batches)))):
        order = random.permutation(len(documents))
        for part in np.array_split(order, batches) if batches else []:
            ids = np.concatenate([documents[i] for i in part])
            firsts = np.append(0, np.cumsum([len(documents[i]) for i in part]))
            pairs, total = model._pairs(ids, firsts)
            error = logistic(model.bias + _sums(model.weights[ids], firsts) + pairs) - labels[part]
            error = error * weight[part] / weight[part].sum()
            seen_b += error.sum() ** 2
            model.bias -= settings.rate * error.sum() / np.sqrt(seen_b)
            if not len(ids):
                continue
            own = np.repeat(np.arange(len(part)), np.diff(firsts))
            used, at = np.unique(ids, return_inverse=True)
            step = np.bincount(at, error[own]) + settings.decay * model.weights[used] / len(part)
            seen_w[used] += step**2
            model.weights[used] -= settings.rate * step / np.sqrt(seen_w[used])
            for f in range(settings.factors):
                step = sign[f] * np.bincount(at, error[own] * (total[own, f] - model.factors[ids, f]))
                step += settings.decay * model.factors[used, f] / len(part)
                seen_v[used, f] += step**2
                model.factors[used, f] -= 0.1 * settings.rate * step / np.sqrt(seen_v[used, f])
    return model


def learn(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), key: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    """Fits the model on labelled documents, except the held-out ones.

    Of each class at most `sample` rows are used: those whose keys have the smallest hashes. Their terms come to the
    driver, whose memory is bounded by the sample; classes keep the weight of all their rows. Rows without a label or
    a key are left out, and a key that is labelled twice has the higher label. Without labels every score is small.
    """
    known = labels.where(F.col(key).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(key)))
    known = known.groupBy(F.col(key).alias("doc_id")).agg(F.max(label).cast("int").alias("y"))
    sizes = {row["y"]: row["count"] for row in known.groupBy("y").count().collect()}
    spread = known.withColumn("_hash", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)))
    picked = None
    for y, count in sizes.items():
        # The cut leaves a few times the sample, so that few rows meet in the task that takes the smallest.
        cut = min(1 << 30, (4 * settings.sample << 30) // count + 1)
        rows = spread.where((F.col("y") == y) & (F.col("_hash") < cut)).orderBy("_hash", "doc_id").limit(settings.sample)
        picked = rows if picked is None else picked.unionByName(rows)
    found = [] if picked is None else _sampled(docs, picked.select("doc_id", "y"), settings, key, text)
    labels_, documents = np.array([y for y, _ in found], float), [np.frombuffer(t, np.int32) for _, t in found]
    taken = {y: max(1, int((labels_ == y).sum())) for y in sizes}
    weight = np.array([sizes[int(y)] / taken[int(y)] for y in labels_])
    return fit(documents, labels_, weight, settings)


def _sampled(docs: DataFrame, picked: DataFrame, settings: Settings, key: str, text: str) -> list[tuple[int, bytes]]:
    def reduce_texts(batches):
        for batch in batches:
            ids = [terms(t, settings).tobytes() for t in each_value(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["y", "terms"])

    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    joined = rows.join(F.broadcast(picked), "doc_id").select("y", "text")
    found = [(row["y"], bytes(row["terms"])) for row in joined.mapInArrow(reduce_texts, "y int, terms binary").collect()]
    return sorted(found)


def scorer(shared, settings: Settings):
    """Gives the scores of texts by a broadcast model, in a task; a worker remembers which terms of a word count."""
    bias, used, weights, factors = shared.value
    small, place = Model(bias, weights, factors), np.full(1 << settings.bits, -1, np.int32)
    place[used] = np.arange(len(used))
    known = worker_state("toxicity").setdefault(("terms", hash(used.tobytes()), settings), {})
    find = re.compile(_words).findall

    def scores(texts: list[str]) -> np.ndarray:
        documents = []
        for whole in texts:
            found: set[int] = set()
            for word in set(find(whole.lower())):
                ids = known.get(word)
                if ids is None:
                    ids = known[word] = [i for i in place[term_ids(word, settings)].tolist() if i >= 0]
                found.update(ids)
            documents.append(np.fromiter(found, np.int32, len(found)))
        if len(known) > KNOWN_WORDS:
            known.clear()
        return logistic(small.raw(np.concatenate(documents), np.append(0, np.cumsum([len(d) for d in documents]))))

    return scores


def _shared(docs: DataFrame, model: Model):
    """The terms that count, a few MB at most whatever the input, to all tasks."""
    used = np.flatnonzero((model.weights != 0) | (model.factors != 0).any(1)).astype(np.int32)
    packed = (model.bias, used, model.weights[used].astype(np.float32), model.factors[used].astype(np.float32))
    return docs.sparkSession.sparkContext.broadcast(packed)


def scored(docs: DataFrame, model: Model, settings: Settings = Settings(), key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key` and `score` of every row, from its whole text alone; a null or empty text scores the bias.

    Keys may be null or repeated; other columns are ignored.
    """
    shared = _shared(docs, model)

    def score(batches):
        scores = scorer(shared, settings)
        for batch in batches:
            for first, texts in slices(each_value(batch.column(1)), SLICE):
                yield pa.RecordBatch.from_arrays([batch.slice(first, len(texts)).column(0), pa.array(scores(texts))], [key, "score"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(score, f"`{key}` {kind}, score double")


def below_threshold(docs: DataFrame, model: Model, settings: Settings = Settings(), text: str = "text") -> DataFrame:
    """The rows, with all their columns, whose texts score below the threshold."""
    shared, at = _shared(docs, model), docs.columns.index(text)

    def select(batches):
        scores = scorer(shared, settings)
        for batch in batches:
            for first, texts in slices(each_value(batch.column(at)), SLICE):
                yield batch.slice(first, len(texts)).filter(pa.array(scores(texts) < settings.threshold))

    return docs.mapInArrow(select, docs.schema)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, settings = table(spark, sf_dir, "documents"), Settings()
    found = scored(docs, learn(docs, table(spark, sf_dir, "labels"), settings), settings)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= settings.threshold).cast("int").alias("predicted")
    )

"""Byte-level BPE by a vocabulary of ranks: encoding with a queue of ranks, and decoding."""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession

from surveylake.llm.common import each_value, slices, table, worker_state
from surveylake.llm.inthash import IntHash

SLICE = 1 << 23
#: Pieces whose ids a worker remembers, and the longest piece that is remembered.
KNOWN_PIECES = 600_000
KNOWN_LENGTH = 64
_NEVER = np.int32(2**31 - 1)
_SPREAD = 64  # bits of a word of the bitmap


class RankQueue:
    """Positions in buckets by merge rank; a hierarchy of bitmaps finds the lowest rank that has any.

    A bit of a level says whether the word below it has a bit set, so the next rank is found by one find-first-set
    per level, whatever the number of ranks. Positions are never taken out early: who takes a bucket skips those
    whose pair has changed since.
    """

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels: list[list[int]] = []
        while ranks > 1 or not self.levels:
            ranks = -(-ranks // _SPREAD)
            self.levels.append([0] * ranks)

    def push(self, ranks: np.ndarray, positions: np.ndarray) -> None:
        """Adds positions under their ranks."""
        order = np.argsort(ranks, kind="stable")
        ranks, positions = ranks[order], positions[order]
        at = np.flatnonzero(np.diff(ranks, prepend=-1))
        for rank, part in zip(ranks[at].tolist(), np.split(positions, at[1:])):
            bucket = self.buckets.get(rank)
            if bucket is not None:
                bucket.append(part)
                continue
            self.buckets[rank] = [part]
            for level in self.levels:
                rank, bit = divmod(rank, _SPREAD)
                level[rank] |= 1 << bit

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions, in order."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank * _SPREAD + (word & -word).bit_length() - 1
        parts, place = self.buckets.pop(rank), rank
        for level in self.levels:
            place, bit = divmod(place, _SPREAD)
            level[place] &= ~(1 << bit)
            if level[place]:
                break
        return rank, np.sort(np.concatenate(parts) if len(parts) > 1 else parts[0])


class RankVocabulary:
    """A vocabulary of byte strings and ranks, as `.tiktoken` files hold it; the rank is the id."""

    def __init__(self, file: bytes):
        lines = (line.split() for line in file.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        self.words = [b""] * (max(self.ranks.values()) + 1)
        for word, rank in self.ranks.items():
            self.words[rank] = word
        self.names = [str(rank) for rank in range(len(self.words))]
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        keys, values, self.early = [], [], set()
        for word, rank in self.ranks.items():
            for cut in range(1, len(word)):
                left, right = self.ranks.get(word[:cut]), self.ranks.get(word[cut:])
                if left is not None and right is not None:
                    self.early |= {part for part in (left, right) if part >= rank and len(self.words[part]) > 1}
                    keys.append(left << 32 | right)
                    values.append(rank)
        self.pairs = IntHash(20)
        self.pairs.insert(np.array(keys), np.array(values))

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces together, and where each piece's begin (with the end as the last entry).

        All bytes form one linked list that is broken between pieces, so pairs of a rank are merged in all pieces at
        once. Of overlapping pairs of one rank the leftmost is merged. Where a merge can make a pair of lower rank,
        which is then due first, only the leftmost of each piece is merged at a time.
        """
        if not pieces:
            return np.zeros(0, np.int64), np.zeros(1, np.int64)
        data = np.frombuffer(b"".join(pieces), np.uint8)
        size = len(data)
        ends = np.cumsum([len(p) for p in pieces])
        token = self.byte_ids[data]
        after, before = np.arange(1, size + 1), np.arange(-1, size - 1)
        after[ends[ends > 0] - 1] = -1
        starts = np.append(0, ends[:-1])
        piece = np.repeat(np.arange(len(pieces)), [len(p) for p in pieces])
        before[starts[starts < size]] = -1
        due = np.full(size + 1, _NEVER)  # the rank of the pair that begins at a position; the last entry stands for none
        alive, merged = np.ones(size, bool), np.zeros(size, bool)
        first = np.flatnonzero(after >= 0)
        found = self.pairs.get(token[first] << 32 | token[after[first]])
        first, found = first[found >= 0], found[found >= 0]
        due[first] = found
        queue = RankQueue(len(self.words))
        queue.push(found, first)
        while (popped := queue.pop()) is not None:
            rank, at = popped
            at = at[due[at] == rank]  # the others are stale
            if len(at) > 1 and rank in self.early:
                slow = np.isin(piece[at], piece[at[self._makes_lower(rank, at, token, before, after)]])
                wait = slow & (np.diff(piece[at], prepend=-1) == 0)
                if wait.any():
                    queue.push(np.full(wait.sum(), rank), at[wait])
                    at = at[~wait]
            if len(at) > 1:
                chained = np.append(False, after[at[:-1]] == at[1:])
                if chained.any():
                    index = np.arange(len(at))
                    run = np.maximum.accumulate(np.where(chained, 0, index))
                    at = at[(index - run) % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            following = after[gone]
            token[at], after[at] = rank, following
            alive[gone], due[gone] = False, _NEVER
            inner = following >= 0
            before[following[inner]] = at[inner]
            left = before[at]
            left = left[left >= 0]
            due[at] = _NEVER
            merged[at] = True
            touched = np.concatenate([at[inner], left[~merged[left]]])
            merged[at] = False
            if len(touched):
                ranks = self.pairs.get(token[touched] << 32 | token[after[touched]])
                due[touched] = np.where(ranks < 0, _NEVER, ranks)
                some = ranks >= 0
                if some.any():
                    queue.push(ranks[some], touched[some])
        held = np.append(0, np.cumsum(alive))
        return token[alive], held[np.append(starts, size)]

    def _makes_lower(self, rank: int, at: np.ndarray, token: np.ndarray, before: np.ndarray, after: np.ndarray) -> np.ndarray:
        """Whether a merge of this rank makes a pair of lower rank, with a neighbour as it is or merged alike."""
        twice = self.pairs.get(np.array([rank << 32 | rank]))[0]
        lower = np.full(len(at), 0 <= twice < rank)
        for beside, key in ((before[at], lambda t: t << 32 | rank), (after[after[at]], lambda t: rank << 32 | t)):
            some = np.flatnonzero(beside >= 0)
            made = self.pairs.get(key(token[beside[some]]))
            lower[some[(made >= 0) & (made < rank)]] = True
        return lower

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.words.__getitem__, ids))


class TextEncoder:
    """Cuts texts by a pattern and encodes the pieces; short pieces met before are remembered."""

    def __init__(self, file: bytes, pattern: str):
        self.vocabulary, self.cut = RankVocabulary(file), regex.compile(pattern).findall
        self.known: dict[str, list[int]] = {}

    def encode(self, texts: list[str]) -> list[list[int]]:
        cuts = [self.cut(text) for text in texts]
        known = self.known
        new = list(set().union(*cuts).difference(known))
        ids, at = self.vocabulary.encode([piece.encode() for piece in new])
        ids, at = ids.tolist(), at.tolist()
        fresh = {piece: ids[a:b] for piece, a, b in zip(new, at, at[1:])}
        known.update(fresh)
        found = [list(chain.from_iterable(map(known.__getitem__, pieces))) for pieces in cuts]
        if len(known) > KNOWN_PIECES:
            known.clear()
        else:
            for piece in fresh:
                if len(piece) > KNOWN_LENGTH:
                    del known[piece]
        return found


def text_encoder(file: bytes, pattern: str) -> TextEncoder:
    state, key = worker_state("tokens"), ("ranks", hash(file), pattern)
    if key not in state:
        state[key] = TextEncoder(file, pattern)
    return state[key]


def encoded(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `ids` (array) and `decoded` (binary, from the ids) of every whole text.

    Every match of the pattern is encoded by itself, without special tokens. A null text is empty: no ids. Keys may
    be null or repeated; other columns are ignored. The vocabulary file, of fixed size, is broadcast.
    """
    file = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def encode(batches):
        encoder = text_encoder(file.value, pattern)
        for keys, texts in _slices(batches):
            ids = encoder.encode(texts)
            decoded = [encoder.vocabulary.decode(i) for i in ids]
            columns = [keys, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, [key, "ids", "decoded"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, text).mapInArrow(encode, f"`{key}` {kind}, ids array<int>, decoded binary")


def encoded_digests(docs: DataFrame, vocabulary: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`key`, `n_tokens`, `ids_sha256`, `decoded_sha256`: digests of what `encoded` gives, taken in the same tasks."""
    file = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())

    def digest(batches):
        encoder = text_encoder(file.value, pattern)
        names, decode = encoder.vocabulary.names, encoder.vocabulary.decode
        for keys, texts in _slices(batches):
            ids = encoder.encode(texts)
            written = [hashlib.sha256(",".join(map(names.__getitem__, i)).encode()).hexdigest() for i in ids]
            decoded = [hashlib.sha256(decode(i)).hexdigest() for i in ids]
            columns = [keys, pa.array(map(len, ids), pa.int64()), pa.array(written), pa.array(decoded)]
            yield pa.RecordBatch.from_arrays(columns, [key, "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return docs.select(key, text).mapInArrow(digest, schema)


def _slices(batches):
    for batch in batches:
        for first, texts in slices(each_value(batch.column(1)), SLICE):
            yield batch.slice(first, len(texts)).column(0), texts


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encoded_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)

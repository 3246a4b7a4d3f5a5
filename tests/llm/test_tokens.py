"""Token counts, byte-level BPE and packing against the tokenizer libraries."""

import base64
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.cases import frame, odd_rows, prose
from tokenizers import Tokenizer

from surveylake.llm import byte_bpe, packing, token_counts
from surveylake.llm.inthash import IntHash
from surveylake.llm.transducer import compiled

JSON, RANKS = P.path("byte_bpe_50k.json"), P.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = Tokenizer.from_file(JSON)
LETTERS = "ab'sdrevlmt  \n\t1½é日-_\"🎉  <|endoftext|>"


def read(path):
    with open(path, "rb") as file:
        return file.read()


def library_ids(texts):
    return [e.ids for e in LIBRARY.encode_batch([t or "" for t in texts], add_special_tokens=False)]


@pytest.fixture(scope="module")
def ranks():
    found = {base64.b64decode(a): int(b) for a, b in map(bytes.split, read(RANKS).splitlines())}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=found, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return byte_bpe.TextEncoder(read(RANKS), P.PATTERN)


@given(st.lists(st.text(st.one_of(st.sampled_from(LETTERS), st.characters(codec="utf-8")), max_size=60), min_size=1, max_size=8))
@settings(max_examples=300, deadline=None)
def test_transducer_equals_the_library(texts):
    machine = compiled(read(JSON))
    want = library_ids(texts)
    assert machine.counts(texts).tolist() == list(map(len, want))
    ids, at = machine.ids(texts)
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == want


def test_transducer_on_every_character_and_long_pieces():
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    rnd = random.Random(3)
    texts = ["".join(points[i : i + 4096]) for i in range(0, len(points), 4096)] + [f"a{c}b" for c in points[:3000]]
    texts += ["".join(rnd.choice(letters) for _ in range(4000)) for letters in ("ab", "thering", "- ", "\n ")]
    assert compiled(read(JSON)).counts(texts).tolist() == list(map(len, library_ids(texts)))


@pytest.mark.parametrize("rounds, chunk", [(1, 8), (32, 8), (32, 256)])
def test_maps_of_chunks_within_a_long_piece_are_composed(monkeypatch, rounds, chunk):
    """Pieces of a megabyte take a number of array steps that does not grow with them; too few rounds are made good."""
    from surveylake.llm import transducer

    machine = transducer.Transducer(read(JSON))
    monkeypatch.setattr(transducer, "ROUNDS", rounds)
    monkeypatch.setattr(transducer, "CHUNK", chunk)
    steps, in_order = [], []
    advance, one = machine._advance, machine._one
    machine._advance = lambda *a: steps.append(1) or advance(*a)
    machine._one = lambda *a: in_order.append(1) or one(*a)
    rnd = random.Random(4)
    size = 1_000_000 if chunk == 256 else 20_000
    texts = ["z" * size, "abcabd" * (size // 6), "".join(rnd.choice("abcdefghij") for _ in range(size)), " " * (size // 4)]
    texts.append(("z" * 3000 + " " + "the" * 1000 + "\n") * 3)
    for text, want in zip(texts, library_ids(texts)):
        steps.clear()
        assert machine.counts([text])[0] == len(want)
        assert chunk == 8 or (len(steps) < 20 * chunk and not in_order)
        ids, _ = machine.ids([text])
        assert ids.tolist() == want
    assert rounds > 1 or in_order


def test_transducer_refuses_vocabularies_that_its_states_cannot_hold(monkeypatch):
    from surveylake.llm import transducer

    longest = max(map(len, compiled(read(JSON)).bytes.values()))
    monkeypatch.setattr(transducer, "_REL", longest)
    with pytest.raises(ValueError):
        transducer.Transducer(read(JSON))


def test_what_is_known_of_token_pairs_is_bounded(monkeypatch):
    from surveylake.llm import transducer

    letters = "abcdefghijklmnopqrstuvwxyz"
    texts = [" ".join("".join(random.Random(50 * n + k).choices(letters, k=7)) for k in range(20)) for n in range(20)]

    def held(machine):
        sizes = []
        for text, want in zip(texts, library_ids(texts)):
            assert machine.counts([text])[0] == len(want)
            sizes.append(len(machine.fits))
        return max(sizes)

    free = held(transducer.Transducer(read(JSON)))
    monkeypatch.setattr(transducer, "MAX_FITS", 50)
    assert held(transducer.Transducer(read(JSON))) < free / 4


def test_transducer_begins_anew_at_its_bound(monkeypatch):
    from surveylake.llm import transducer

    machine = transducer.Transducer(read(JSON))
    monkeypatch.setattr(transducer, "MAX_STATES", 50)
    texts = [prose(n, 100) for n in range(5)]
    for text in texts:
        assert machine.counts([text]).tolist() == [len(library_ids([text])[0])]


def test_token_counts(spark):
    found = token_counts.token_counts(frame(spark), JSON).collect()
    texts = [r[1] for r in odd_rows()]
    want = Counter((r[0], len((r[1] or "").encode()), len(ids)) for r, ids in zip(odd_rows(), library_ids(texts)))
    assert Counter(map(tuple, found)) == want
    assert token_counts.token_counts(frame(spark, []), JSON).count() == 0


@given(st.lists(st.text(st.one_of(st.sampled_from(LETTERS), st.characters(codec="utf-8")), max_size=60), min_size=1, max_size=8))
@settings(max_examples=200, deadline=None)
def test_rank_queue_equals_the_library(ranks, encoder, texts):
    assert encoder.encode(texts) == [ranks.encode_ordinary(t) for t in texts]


def test_rank_queue_on_long_pieces(ranks, encoder):
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(letters) for _ in range(5000)) for letters in ("a", "ab", "thering", "é日", "=-")]
    assert encoder.encode(texts) == [ranks.encode_ordinary(t) for t in texts]


def test_ranks_that_make_lower_pairs():
    """`bc` ranks after `abc`, which it is part of by another way of cutting."""
    words = [bytes([b]) for b in range(256)] + [b"ab", b"abc", b"bc", b"bcbc", b"abcb"]
    file = b"\n".join(base64.b64encode(w) + b" %d" % n for n, w in enumerate(words))
    own = byte_bpe.RankVocabulary(file)
    library = tiktoken.Encoding("own", pat_str=r"\S+", mergeable_ranks={w: n for n, w in enumerate(words)}, special_tokens={})
    rnd = random.Random(6)
    pieces = ["".join(rnd.choice("abc") for _ in range(rnd.randrange(1, 30))) for _ in range(500)]
    ids, at = own.encode([p.encode() for p in pieces])
    assert [ids[a:b].tolist() for a, b in zip(at, at[1:])] == [library.encode_ordinary(p) for p in pieces]


def test_queue_gives_the_lowest_rank():
    queue, rnd = byte_bpe.RankQueue(300_000), random.Random(7)
    want = defaultdict(list)
    for position in range(2000):
        rank = rnd.randrange(300_000) if position % 3 else 77
        want[rank].append(position)
        queue.push(np.array([rank]), np.array([position]))
    found = []
    while (popped := queue.pop()) is not None:
        found.append((popped[0], popped[1].tolist()))
    assert found == sorted(want.items())


def test_encoded_and_decoded(spark, ranks):
    found = byte_bpe.encoded(frame(spark), RANKS, P.PATTERN).collect()
    want = Counter((r[0], tuple(ranks.encode_ordinary(r[1] or "")), (r[1] or "").encode()) for r in odd_rows())
    assert Counter((r["doc_id"], tuple(r["ids"]), bytes(r["decoded"])) for r in found) == want
    digests = byte_bpe.encoded_digests(frame(spark), RANKS, P.PATTERN).collect()
    assert Counter(r["n_tokens"] for r in digests) == Counter(len(r["ids"]) for r in found)
    assert byte_bpe.encoded(frame(spark, []), RANKS, P.PATTERN).count() == 0


def test_inthash():
    rnd = np.random.default_rng(8)
    keys = rnd.choice(10**9, 50_000, replace=False).astype(np.int64)
    held = IntHash(4)
    for part in np.array_split(keys, 7):
        held.insert(part, part + 1)
    assert (held.get(keys) == keys + 1).all()
    assert (held.get(np.arange(10**9, 10**9 + 1000)) == -1).all()


def test_inthash_takes_few_cells_a_key():
    held = IntHash(4)
    for part in np.array_split(np.arange(300_000), 30):
        held.insert(part, part)
        assert len(held.cells) <= max(16, 6 * held.size)
    assert (held.get(np.arange(300_001)) == np.append(np.arange(300_000), -1)).all()


def test_workers_keep_the_state_of_one_kind_of_work(spark):
    from surveylake.llm import common

    def work(batches):
        for batch in batches:
            machine = compiled(file)
            assert compiled(file) is machine
            kept = len(common.worker_state("tokens"))
            assert not common.worker_state("near join")
            assert compiled(file) is not machine
            yield pa.RecordBatch.from_arrays([pa.array([kept])], ["kept"])

    file = read(JSON)
    assert spark.range(1, numPartitions=1).mapInArrow(work, "kept bigint").first()["kept"] >= 1


def test_values_are_made_a_run_at_a_time():
    from surveylake.llm.common import each_value, slices

    class Column:
        def __init__(self, held):
            self.held, self.most = held, []

        def __len__(self):
            return len(self.held)

        def slice(self, first, rows):
            part = pa.array(self.held[first : first + rows])
            self.most.append(len(part))
            return part

    column = Column([None, "", *(f"text {n}" for n in range(2000))])
    found = [t for _, part in slices(each_value(column), 100) for t in part]
    assert found == [t or "" for t in column.held] and max(column.most) <= 512
    assert list(each_value(pa.array([], pa.string()))) == []


def check_packed(rows, capacity):
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in places.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


def test_packed_documents(spark):
    rows = odd_rows()
    pieces = packing.written(packing.tokenised_pieces(frame(spark), JSON), "pieces")
    packed = packing.pack(pieces)
    found = packed.collect()
    count = check_packed(found, 2048)
    want = Counter()
    for (key, *_), ids in zip(rows, library_ids([r[1] for r in rows])):
        ids = [*ids, 0]
        first = (len(ids) - 1) % 2048 + 1
        for n, (a, b) in enumerate([(0, first)] + [(s, s + 2048) for s in range(first, len(ids), 2048)]):
            want[(key, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in found) == want
    total = sum(r["length"] for r in found)
    assert count <= -(-total // 2048) + 1
    dealt = packing.pack(pieces, parts=1, part_pieces=3).collect()
    assert check_packed(dealt, 2048) == count and len(dealt) == len(found)
    whole = packing.sequences(packed).collect()
    assert len(whole) == count and all(len(r["ids"]) == 4 * r["length"] for r in whole)
    assert packing.pack_documents(frame(spark, []), JSON).count() == 0


@given(st.dictionaries(st.integers(1, 40), st.integers(0, 30), max_size=25))
@settings(max_examples=300, deadline=None)
def test_plan_places_each_piece_once(counts):
    bins, ranks = defaultdict(list), defaultdict(set)
    for length, rank, n, each, first, offset in packing.plan(counts, 40):
        for k in range(n * each):
            assert rank + k not in ranks[length]
            ranks[length].add(rank + k)
            bins[first + k // each].append((offset + k % each * length, length))
    assert {n: len(r) for n, r in ranks.items()} == {n: c for n, c in counts.items() if c}
    for parts in bins.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= 40
    total = sum(n * c for n, c in counts.items())
    large = sum(c for n, c in counts.items() if 2 * n > 40)
    assert len(bins) <= max(large, 1.3 * total / 40 + 2) + sum(c for n, c in counts.items() if 40 < 3 * n <= 60) / 2

"""Spelling variants against plain Python over all pairs."""

import random
import re
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from llm.cases import SCHEMA, frame, odd_rows, prose

from surveylake.llm import spelling
from surveylake.llm.common import table
from surveylake.llm.queries import QUERIES


def counted(rows):
    found = Counter()
    for key, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if n >= 2 and len(w) >= 7}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(a == b[:k] + b[k + 1 :] for k in range(len(b)))


def expected(words):
    """Pairs through deletions: near words share a deletion of a letter, or one is a deletion of the other."""
    cut = {}
    for w in words:
        for v in {w} | {w[:k] + w[k + 1 :] for k in range(len(w))}:
            cut.setdefault(v, []).append(w)
    near = {w: set() for w in words}
    for group in cut.values():
        for a in group:
            near[a] |= {b for b in group if b != a and one_edit(a, b)}
    form = {}
    for w in words:
        if near[w]:
            best = min(near[w], key=lambda v: (-words[v], v))
            if words[best] >= 10 * words[w]:
                form[w] = best
    out = set()
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.add((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return out


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def vocabulary(seed, count):
    """Words near to each other by every kind of edit, with runs of equal letters, and letters beyond one byte."""
    rnd, words = random.Random(seed), {}
    for _ in range(count):
        word = "".join(rnd.choice("aabcé漢🎉") for _ in range(rnd.randrange(7, 12)))
        for _ in range(rnd.randrange(6)):
            k = rnd.randrange(len(word))
            word = rnd.choice([word[:k] + word[k + 1 :], word[:k] + "a" + word[k:], word[:k] + rnd.choice("abé") + word[k + 1 :], word])
            if len(word) >= 7:
                words[word] = rnd.choice([2, 3, 5, 20, 30, 300, 5000])
    return words


@pytest.mark.parametrize("pieces,block,tile", [(3, 4096, 128), (1, 50, 8), (2, 5, 3), (4, 1, 1), (7, 4096, 16)])
def test_near_words_are_those_of_all_pairs(spark, pieces, block, tile, monkeypatch):
    monkeypatch.setattr(spelling.near_words, "__defaults__", (pieces, block))
    monkeypatch.setattr(spelling.tiles, "__defaults__", (tile,))
    words = vocabulary(pieces, 150 if pieces > 1 else 60)
    given = spark.createDataFrame(list(words.items()), "word string, n bigint")
    found = spelling.spelling_variants(given, pieces)
    assert found.columns == COLUMNS
    assert {tuple(r) for r in found.collect()} == expected(words)


def test_every_pair_counts_under_one_key_only():
    """Where equal letters let an edit be seen in several pieces, the pair is found once."""
    words = ["aaaaaaaa", "aaaaaaa", "aaaabaaa"]
    left, right, size = spelling.code_points(words)
    found, place = spelling.near((left, right, size), (left, right, size))
    assert found[0, 1] and found[1, 0] and found[0, 2] and found[1, 2] and place[0, 1] == 7 and place[0, 2] == 4


def test_counted_words_of_odd_rows(spark):
    long = " ".join(prose(n, 30) for n in range(4)) + " Übergröße×Straße ÷ naïveté É" * 40 + " " + "q" * 5000
    rows = odd_rows() + [(200 + n, long, None, None, None) for n in range(3)] + [(None, long.upper(), "en", "s", 1)]
    rows += [(300 + n, "Abcdefg abcdefgh ABCDEFGHI", "en", "s", 1) for n in range(100)]
    found = spelling.counted_words(frame(spark, rows)).collect()
    assert {r["word"]: r["n"] for r in found} == counted(rows) and len(found) == len(counted(rows))
    assert any(len(w) == 7 for w in counted(rows))


def test_no_words(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert spelling.spelling_variants(spelling.counted_words(empty)).collect() == []
    assert spelling.spelling_variants(spark.createDataFrame([("lonely word", 3)], "word string, n bigint")).collect() == [
        ("lonely word", None, "lonely word", 3, 0, None)
    ]


def test_whole_groups_are_cut_at_new_keys_only():
    keys = [1, 1, 1, 2, 3, 3, 3, 3, 4]
    batches = [pa.RecordBatch.from_pydict({"k": keys[a:b]}) for a, b in [(0, 2), (2, 2), (2, 3), (3, 5), (5, 7), (7, 9)]]
    parts = [t.column(0).to_pylist() for t in spelling.whole_groups(batches, 1)]
    assert sum(parts, []) == keys and all(a[-1] != b[0] for a, b in zip(parts, parts[1:]))


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_on_all_documents(spark, sf_dir):
    rows = [tuple(r) for r in table(spark, sf_dir, "documents").collect()]
    found = QUERIES["op11_spelling_variants"](spark, sf_dir).select(COLUMNS).collect()
    want = expected(counted(rows))
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert sum(w[1] is not None for w in want) >= 10

"""Mixing against plain Python: round by round shares, and a walk through each source in order."""

import hashlib
import re
from collections import Counter, defaultdict
from math import isclose

import duckdb
import pytest
from llm.cases import SCHEMA, frame, odd_rows, prose
from oracle import difference

from surveylake.llm import mixing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def digest(row):
    return hashlib.md5(f"mix:{'' if row[0] is None else row[0]}:{row[1] or ''}".encode()).hexdigest()


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, epochs=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[n % len(weights)] for n, s in enumerate(names)}
    given, open_ = {}, set(names)
    while True:
        left = share * sum(sizes.values()) - sum(given.values())
        total = sum(weight[s] for s in open_)
        got = {s: left * weight[s] / total for s in open_}
        over = [s for s in open_ if got[s] > epochs * sizes[s]]
        if not over or not open_:
            return given | got
        given |= {s: epochs * sizes[s] for s in over}
        open_ -= set(over)
        if not open_:
            return given


def plain(rows, **how):
    sources = defaultdict(list)
    for row in rows:
        sources[row[3]].append((digest(row), row[0] is not None, row[0] or 0, len(WORD.findall(row[1] or "")), row))
    sizes = {s: sum(d[3] for d in docs) for s, docs in sources.items()}
    targets, out = plain_targets(sizes, **how), []
    for s, docs in sources.items():
        budget = round(targets[s])
        full, left = divmod(budget, sizes[s]) if sizes[s] else (0, 0)
        for *_, size, row in sorted(docs, key=lambda d: d[:4]):
            last = max(0, min(size, left))
            left -= size
            out.append((row, size, sizes[s], targets[s], full * size + last))
    return out


def odd():
    rows = odd_rows() + [(500 + n, prose(n, 20 + n), "en", ["ä", "z", "a", "", None, "𝒳"][n % 6], 1) for n in range(80)]
    return rows + [(700, " \n", "en", "no words", 1), (None, None, None, "no words", None)] + [(701, prose(3, 9), "en", "tiny", 1)] * 40


@pytest.mark.parametrize("range_rows", [100_000, 5, 1])
def test_taken_words(spark, range_rows):
    rows = odd()
    found = mixing.taken_words(frame(spark, rows), range_rows=range_rows).collect()
    ours = Counter((r["doc_id"], r["source"], r["size"], r["source_size"], r["taken"], round(r["target"], 6)) for r in found)
    assert ours == Counter((row[0], row[3], size, total, taken, round(target, 6)) for row, size, total, target, taken in plain(rows))
    taken = defaultdict(int)
    for r in found:
        taken[r["source"]] += r["taken"]
        assert r["taken"] <= 2 * r["size"]
    assert all(abs(taken[r["source"]] - r["target"]) <= 0.5 for r in found)


def test_copies_in_several_steps(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)
    rows = [(1, "a b c", "en", "s", 1)] * 50 + [(2, "d e f g", "en", "t", 1)] * 3
    found = mixing.taken_words(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["taken"]) for r in found) == Counter((row[0], taken) for row, *_, taken in plain(rows))


def test_the_mix_holds_the_words_taken(spark):
    rows = odd()
    found = mixing.mixed(frame(spark, rows)).collect()
    assert found[0].__fields__[:5] == SCHEMA.replace(",", "").split()[::2] and found[0].__fields__[-2:] == ["mix_epoch", "mix_words"]
    ours, times = Counter(), Counter()
    texts = {(row[0], row[3], digest(row)): row[1] for row in rows}
    for r in found:
        words = WORD.findall(r["text"])
        assert len(words) == r["mix_words"] > 0
        key = next(k for k in texts if k[:2] == (r["doc_id"], r["source"]) and (texts[k] or "").startswith(r["text"]))
        whole = WORD.findall(texts[key])
        assert words == whole[: len(words)] and (r["text"] == texts[key] or len(words) < len(whole))
        ours[r["source"]] += len(words)
        times[key, r["mix_epoch"]] += 1
    want = Counter()
    for row, _, _, _, taken in plain(rows):
        want[row[3]] += taken
    assert ours == +want
    assert max(e for _, e in times) <= 1 and all(n <= Counter((x[0], x[3], digest(x)) for x in rows)[k] for (k, _), n in times.items())


def test_reruns_agree_whatever_the_partitions(spark):
    rows = odd()
    runs = [mixing.taken_words(frame(spark, rows[::step]).repartition(n)).collect() for step, n in ((1, 1), (-1, 9))]
    assert Counter(runs[0]) == Counter(runs[1])


@pytest.mark.parametrize("share,epochs", [(1.5, 2), (0.3, 1), (4.0, 2), (2.5, 4)])
@pytest.mark.parametrize("sizes", [{}, {"a": 0}, {"a": 10, "b": 1000, "c": 5, "d": 0, None: 70}, {f"h{n:03}": n * n % 977 for n in range(500)}])
def test_targets(spark, sizes, share, epochs):
    given = spark.createDataFrame([(s, v, 1) for s, v in sizes.items()], "source string, source_size bigint, source_rows bigint")
    found = {r["source"]: r["target"] for r in mixing.targets(given, (5, 2, 1), share, epochs).collect()}
    want = plain_targets(sizes, share=share, epochs=epochs) if sizes else {}
    assert found.keys() == want.keys() and all(isclose(found[s], want[s], rel_tol=1e-9, abs_tol=1e-6) for s in want)


def test_sums_over_blocks_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 3)
    rows = spark.range(200).selectExpr("id % 20 AS range", "id AS v").groupBy("range").agg({"v": "sum"}).toDF("range", "v")
    found = mixing.running_sums(rows, ["v"], []).collect()
    total = 0
    for r in sorted(found):
        assert r["before_v"] == total
        total += r["v"]


def test_sql_on_odd_rows(spark):
    rows, con = odd(), duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    found = mixing.taken_words(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "size", "source_size", "target", "taken", "source")
    assert difference(found, con, mixing.sql()) is None


def test_an_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.taken_words(empty).collect() == [] and mixing.mixed(empty).collect() == []

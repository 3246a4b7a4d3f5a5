"""Archives and URL verdicts."""

import gzip
import hashlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from surveylake.llm import url_filters, warc

SCHEMA = "page_id bigint, url string, html string"


def page_rows():
    text = "<p>é</p>" * 40
    rows = [(5, "http://A.com/x", text), (3, "http://b.com/", text), (9, None, text), (3, "http://b.com/", text), (None, "u\r\nx", text)]
    rows += [(20, "http://c/", None), (21, "http://c/ü", ""), (22, "c", "short"), (23, "c", "short"), (24, "c", "x" * 300_000)]
    return rows + [(100 + n, f"http://h{n % 7}.org/p{n}", f"<html>{n}" * (n % 50)) for n in range(200)]


def pages(spark, rows=None):
    df = spark.createDataFrame(page_rows() if rows is None else rows, SCHEMA)
    return df.selectExpr("*", "1 AS path", "2 AS digest", "3 AS host", "4 AS row")


def want_records(rows):
    found, first = [], {}
    for key, _, html in rows:
        if len((html or "").encode()) >= 100 and key is not None:
            first[html] = min(key, first.get(html, key))
    for key, _, html in rows:
        payload = (html or "").encode()
        other = first.get(html) if len(payload) >= 100 and first.get(html) != key else None
        found.append((key, len(payload), hashlib.sha256(payload).hexdigest(), "response" if other is None else "revisit", other))
    return Counter(found)


@pytest.mark.parametrize("range_bytes", [100, 5000, 1 << 23])
def test_archives_round_trip(spark, tmp_path, range_bytes):
    files = warc.write_warc(pages(spark), str(tmp_path / "warc"), file_bytes=2000)
    assert files.agg({"records": "sum"}).first()[0] == len(page_rows()) and files.count() > 3
    found = warc.read_warc(files, range_bytes).collect()
    number = lambda urn: int(urn[10:-1]) if urn and urn[10:-1] else None
    got = Counter((number(r["record"]), r["payload_bytes"], r["digest"], r["type"], number(r["refers"])) for r in found)
    assert got == want_records(page_rows())
    assert all(hashlib.sha256(r["payload"]).hexdigest() == r["digest"] for r in found if r["type"] == "response")


def test_archives_of_an_empty_table(spark, tmp_path):
    assert warc.read_warc(warc.write_warc(pages(spark, []), str(tmp_path / "warc"))).count() == 0


def test_records_inside_payloads_are_not_read(spark, tmp_path):
    """A payload that is itself an archive: its members lie open where it is stored as it is."""
    inner = b"".join(warc.record(n, "http://in/", b"%d" % n * 500, None) for n in range(20))
    stored = gzip.compress(gzip.decompress(warc.record(1, "http://out/", inner, None)), compresslevel=0)
    outer = stored + warc.record(2, None, b"junk \x1f\x8b\x08 more", None)
    path = Path(tmp_path, "a.warc.gz")
    path.write_bytes(outer)
    files = spark.createDataFrame([(str(path), len(outer), 2)], "path string, bytes bigint, records bigint")
    assert warc.scan_warc(files, 500).count() > 2
    # Payloads do not travel to be compared: only the places of records are grouped and ranked.
    plan = warc.read_warc(files, 500)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Aggregate" not in plan
    assert sorted(r["record"] for r in warc.read_warc(files, 500).collect()) == ["<urn:page:1>", "<urn:page:2>"]


def test_a_long_record_is_decoded_in_linear_time():
    import time

    def seconds(size):
        data = bytearray(warc.record(1, "u", b"\0" * size, None))
        begun = time.perf_counter()
        content, length = warc.member(data, 0, lambda: False)
        assert length == len(data) and len(content) > size
        return time.perf_counter() - begun

    seconds(1 << 20)
    assert seconds(64 << 20) < 40 * seconds(8 << 20)


def test_failed_members_and_headers_are_passed_over():
    assert warc.member(bytearray(b"\x1f\x8b\x08 not a member"), 0, lambda: False) is None
    whole = bytearray(warc.record(1, "u", b"payload", None))
    assert warc.member(whole[:-4], 0, lambda: False) is None
    assert warc.parsed(b"WARC/1.1\r\nContent-Length: 9\r\n\r\nshort") is None


def test_rules_and_parts_of_urls(spark):
    urls = {
        "HTTP://WWW.Example.com/en/x?y=/": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"),
        "http://com?x": ("com", "", None, None), "http://x.net/es/": ("x.net", "/es/", "net/es/", "block"),
        "x://y.NET/fr/#t": ("y.net", "/fr/", "net/fr/", "block"), "http://x.net#/es/": ("x.net", "", None, None),
        "no scheme": ("", "", None, None), None: ("", "", None, None), "": ("", "", None, None), "://": ("", "", None, None),
        "http://x.com/\ny?": ("x.com", "/\ny", "com/", "allow"),
    }
    rows = [(n, url, None) for n, url in enumerate(urls)]
    found = url_filters.with_rules(pages(spark, rows)).orderBy("page_id").collect()
    assert [(r["host"], r["path"], r["rule"], r["ruled"]) for r in found] == list(urls.values())


def linked_pages():
    link = lambda *hosts: "".join(f'<a HREF="https://{h}/p">x</a>' for h in hosts)
    return [
        (1, "http://good.com/", link("friend.org", "GOOD.com")), (2, "http://bad.net/es/", link("victim.org")),
        (3, "http://spam.org/", link("bad.net", "bad.net")), (4, "http://farm.org/", link("spam.org")), (5, "http://friend.org/", link("fan.org")),
        (6, "http://victim.org/", None), (7, "http://fan.org/", ""), (7, "http://fan.org/", ""), (None, None, "x"), (8, "http://lone.org/", "<a href='/x'>"),
        (9, "http://bad.net/en/", ""), (10, "http://friend.org/2", "<a href=//bad.net/>"),
    ]


def test_trust_and_distrust_spread(spark):
    found = url_filters.verdicts(pages(spark, linked_pages())).collect()
    assert len(found) == len(linked_pages())
    verdict = {r["host"]: r["verdict"] for r in found}
    assert {h for h, v in verdict.items() if v == "block"} == {"bad.net", "spam.org", "farm.org"}
    assert {r["verdict"] for r in found if r["host"] == "bad.net"} == {"block"}
    assert url_filters.verdicts(pages(spark, [])).count() == 0


def test_distrust_spreads_over_any_number_of_links_and_small_shares(spark):
    link = lambda host: f'<a href="http://{host}/">x</a>'
    rows = [(0, "http://h0.net/es/", None)] + [(n, f"http://h{n}.org/", link("h0.net" if n == 1 else f"h{n - 1}.org")) for n in range(1, 13)]
    verdict = {r["host"]: r["verdict"] for r in url_filters.verdicts(pages(spark, rows)).collect()}
    assert set(verdict.values()) == {"block"} and len(verdict) == 13
    ranks = [("a", "distrust", 0), ("b", "distrust", 0), ("b", "trust", 5), ("c", "trust", 0)]
    blocked = url_filters.blocked_hosts(spark.createDataFrame(ranks, "host string, kind string, units bigint"))
    assert [r["host"] for r in blocked.collect()] == ["a"]


def test_verdicts_equal_their_sql(spark):
    rows = [r for r in linked_pages() if r[0] is not None]
    connection = duckdb.connect()
    connection.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    connection.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = Counter(connection.sql(f"SELECT page_id, host, path, rule, verdict FROM ({url_filters.OP7_SQL})").fetchall())
    assert Counter(map(tuple, url_filters.verdicts(pages(spark, rows)).collect())) == want

"""WARC records, archives and the merged index."""

import base64
import gzip
import hashlib
import random
import urllib.parse
from pathlib import Path

import pytest

from llm import queries, warc

SCHEMA = "page_id long, url string, html string, file string, seconds string, run long, payload int, key string, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "f", "s", 1, 2, "k", "o") for r in rows], SCHEMA)


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def brute(rows, least=0):
    first = {}
    for i, _, h in rows:
        if i is not None and len((h or "").encode()) >= least:
            first[h or ""] = min(i, first.get(h or "", i))
    out = []
    for i, _, h in rows:
        original = first.get(h or "", i) if len((h or "").encode()) >= least else i
        copy = original != i
        out.append((i, len((h or "").encode()), digest(h), "revisit" if copy else "response", original if copy else None))
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
ODD = [
    (1, "http://a.example/x", "same"), (2, "http://a.example/x", "same"), (3, None, None), (4, "", ""), (5, "http://ü.example/a b\r\nX: y", "\r\n\r\n"),
    (6, "HTTPS://www.B.example:443/p?q#f", "before\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nafter"), (7, "u", "WARC/1.1\r\n"),
    (8, "u", "\r\nWARC/1.1\r\nWARC/1.1\r\n\r\n\r\nWARC/1.1"), (9, "u", "x\r\n\r\n\r\n"), (10, "u", "é日本\x00"), (11, "u", "long " * 400_000),
    (None, "u", "only null"), (None, "n", "same"), (12, "u", "equal"), (12, "u", "equal"), (13, "v", "x\r\n\r\n\r\nWARC/1.1\r\n"),
]


def test_odd_pages_come_back_whole(spark):
    data = pages(spark, ODD).repartition(3)
    want = brute(ODD)
    assert sorted(map(tuple, warc.archive(data).select(*COLUMNS).collect()), key=repr) == want
    assert warc.archive(data.where("false")).count() == 0
    urls = {r["page_id"]: r["url"] for r in warc.archive(data).collect()}
    assert urls[3] is None and urls[4] == "" and urls[5] == "http://ü.example/a%20b%0D%0AX:%20y"


def test_small_payloads_are_no_copies(spark):
    data = pages(spark, ODD)
    assert sorted(map(tuple, warc.archive(data, least=5).select(*COLUMNS).collect()), key=repr) == brute(ODD, 5)


def test_very_common_payloads_are_looked_up(spark, monkeypatch):
    rows = [(i, f"http://h{i % 3}.example/{i % 7}", "hot" if i % 3 else f"t{i % 800}") for i in range(6000)]
    monkeypatch.setattr(warc, "HOT_SHARE", 3)
    assert sorted(map(tuple, warc.archive(pages(spark, rows).repartition(5)).select(*COLUMNS).collect()), key=repr) == brute(rows)


def test_offsets_lead_to_the_records(spark):
    folder = warc.write_archives(pages(spark, ODD).coalesce(2))
    for r in warc.read_archives(spark, folder).collect():
        data = gzip.decompress(Path(folder.removeprefix("file://"), r["file"]).read_bytes())
        record = data[r["offset"] :]
        assert record.startswith(warc.VERSION)
        name = "" if r["page_id"] is None else r["page_id"]
        assert f"WARC-Record-ID: <urn:page:{name}>".encode() in record.split(b"\r\n\r\n")[0]


def test_damage_is_noticed(spark):
    good = warc.encode(1, "u", 5, b"payload", None).removeprefix(warc.VERSION)
    assert warc.decode(good)[5] == 7
    for bad in (good[:-1], good.replace(b"payload", b"payl0ad"), good + b"x"):
        with pytest.raises(ValueError):
            warc.decode(bad)


@pytest.mark.parametrize("runs", [0, 1, 2, 3, 5, 8, 13])
def test_loser_tree_merges(runs):
    rng = random.Random(runs)
    lists = [sorted((rng.randrange(20),) for _ in range(rng.randrange(9))) for _ in range(runs)]
    got = [(r, p) for r, p in warc.LoserTree(lists)]
    assert [lists[r][p] for r, p in got] == sorted(x for row in lists for x in row)
    assert len(set(got)) == len(got)


@pytest.mark.parametrize("range_rows", [100, 1_000_000])
def test_index_is_in_order(spark, range_rows, monkeypatch):
    monkeypatch.setattr(warc, "RANGE_ROWS", range_rows)
    monkeypatch.setattr(warc, "RUN_ROWS", 70)
    rows = [(i, f"http://www.h{i % 5}.example/{i * 7 % 40}" if i % 3 else "http://hot.example/", f"t{i}") for i in range(1500)]
    index = warc.archive(pages(spark, rows).repartition(6)).orderBy("range", "position").collect()
    keys = [(r["url_key"], r["seconds"], r["page_id"]) for r in index]
    assert keys == sorted(keys) and len(keys) == 1500
    if range_rows == 100:
        per_range = [sum(r["range"] == n for r in index) for n in {r["range"] for r in index}]
        assert len(per_range) > 8 and max(per_range) < 400
    for before, r in zip([None, *index], index):
        same = before is not None and before["url_key"] == r["url_key"]
        assert r["previous_id"] == (before["page_id"] if same else None)


def test_url_keys():
    assert warc.url_key("https://www.A.example.com:443/B?c#d") == "com,example,a)/B?c"
    assert warc.url_key("http://user@a.example") == "example,a)" and warc.url_key(None) == "" == warc.url_key("")


def test_all_given_pages(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    assert sorted(map(tuple, queries.op12_warc(spark, sf).collect()), key=repr) == brute(rows)
    assert all(urllib.parse.urlsplit(u).hostname for _, u, _ in rows)

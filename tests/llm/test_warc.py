"""WARC archives: loser tree, round trip, revisits and global order."""

import base64
import gzip
import hashlib
import random
import time

from geoweave.llm import warc


def test_loser_tree_merges():
    rng = random.Random(6)
    for k in range(9):
        runs = [sorted((rng.randint(0, 9), i, j) for j in range(rng.randint(0, 12))) for i in range(k)]
        got = list(warc.LoserTree([iter(r) for r in runs], lambda x: x[0]))
        assert [x[0] for x in got] == sorted(x[0] for r in runs for x in r)
        assert sorted(got) == sorted(x for r in runs for x in r)


def histories(spark, rows, **options):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, at string").selectExpr("*", "1 AS id", "2 AS payload")
    return warc.capture_histories(warc.archive_pages(pages.repartition(3), **options)).collect()


def test_round_trip_and_order(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice([None, "http://www.b.com/x?y#z", "https://a.b.com:8/%0D\r\nq", "nohost", f"http://c.org/{i % 7}"]), rng.choice([None, "", "é\r\n\r\nx", "same"]), rng.choice([None, "2024-01-01T00:00:00Z", "2020-05-05T00:00:00Z"])) for i in range(200)]
    got = histories(spark, rows, time_col="at")
    by_payload = {}
    for i, _, html, _ in rows:
        by_payload.setdefault(html or "", []).append(i)
    assert len(got) == 200
    for r in got:
        i, url, html, at = rows[r.id]
        payload, last = (html or "").encode(), max(by_payload[html or ""])
        assert (r.url, r.time, r.payload_bytes, r.payload_digest) == (url, at or warc.EPOCH, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode())
        assert (r.record_type, r.refers_to) == (("response", None) if i == last else ("revisit", last))
    assert [(r.urlkey, r.time, r.id) for r in got] == sorted((r.urlkey, r.time, r.id) for r in got)
    assert warc.url_key("http://www.b.com/x?y#z") == "com,b)/x?y"


def test_many_ranges_and_passes(spark, monkeypatch):
    rows = [(i, f"http://h{i % 5}.org/{'hot' if i % 3 else i}", f"p{i}", None) for i in range(400)]
    whole = histories(spark, rows)
    monkeypatch.setattr(warc, "RANGE_ENTRIES", 60)
    assert histories(spark, rows) == whole
    rng = random.Random(8)
    monkeypatch.setattr(warc, "FAN_IN", 2)
    slices = [sorted(((rng.randint(0, 50), i), i) for i in range(rng.randint(0, 20))) for _ in range(11)]
    assert list(warc.merged(slices)) == sorted(x for s in slices for x in s) and list(warc.merged([])) == []


def test_archives_are_read_once():
    record = warc.capture_record({"id": 1, "url": "http://a.org/", "time": warc.EPOCH, "sha1": "00" * 20, "size": 1, "response": True, "payload": b"x" * 3000, "refers_to": None})
    member = gzip.compress(record, 1, mtime=0)
    began = time.perf_counter()
    found = list(warc.read_records(member * 20_000))
    assert [x[0] for x in found] == [i * len(member) for i in range(20_000)] and time.perf_counter() - began < 20
    big = gzip.compress(warc.warc_record("x", [], random.Random(1).randbytes(300_000)), 1, mtime=0)
    assert [x[1] for x in warc.read_records(big + member + big)] == [len(big), len(member), len(big)]


def test_small_payloads_stay_responses(spark):
    got = histories(spark, [(1, "u", "ab", None), (2, "u", "ab", None), (3, "u", "abcd", None), (4, "u", "abcd", None)], min_revisit_bytes=3)
    assert sorted((r.id, r.record_type) for r in got) == [(1, "response"), (2, "response"), (3, "revisit"), (4, "response")]


def test_edges(spark):
    got = histories(spark, [(None, "u", "x", None), (5, "u", "x", None), (5, "u", "x", None), (None, None, None, None), (None, None, None, None)])
    assert sorted((str(r.id), r.record_type, str(r.refers_to)) for r in got) == [("5", "response", "None"), ("5", "revisit", "5"), ("None", "response", "None"), ("None", "revisit", "5"), ("None", "revisit", "None")]
    assert histories(spark, []) == []

import gzip
import hashlib
import io

import pytest
from pyspark.sql import functions as F

from panelcast.llm import web_archives as w


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumn("path", F.lit(1)).withColumn("offset", F.lit("x"))


def test_versions_of_arc():
    bodies = [b"HTTP/1.1 200 OK\r\nA: b\r\n\r\n<p>x</p>", b"", b"plain\n\nbody\n", b"HTTP/1.0 404 Not Found\n\ngone"]
    for version in (1, 2):
        data = w.arc_head("f.arc", version)
        for i, b in enumerate(bodies):
            data += w.arc_record(f"http://e.org/{i}", "1.2.3.4", "20200102030405", "text/html", b, version)
        got = list(w.read_arc(io.BytesIO(data)))
        assert [r["body"] for r in got] == bodies
        assert [r["url"] for r in got] == [f"http://e.org/{i}" for i in range(4)]
        assert all(data[r["offset"] :].startswith(r["url"].encode()) for r in got)
        assert [w.split_http(r["body"])[1] for r in got] == [b"<p>x</p>", b"", b"plain\n\nbody\n", b"gone"]


def test_declared_fields_blank_addresses_and_cuts():
    head = b"filedesc://x 0.0.0.0 20200101000000 text/plain 76\n1 0 Old\nURL IP-address Archive-date Content-type Archive-length\n\nmore header text\n"
    body = head.split(b"\n", 1)[1]
    head = head.replace(b" 76\n", b" %d\n" % len(body))
    data = head + b"\n\nhttp://e.org/a b 1.1.1.1 20200101 text/html 5\nabcde\nhttp://e.org/ 1.1.1.1 202001 text/html 50\nshort"
    got = list(w.read_arc(io.BytesIO(data)))
    assert [(r["url"], r["body"], r["truncated"]) for r in got] == [("http://e.org/a b", b"abcde", False), ("http://e.org/", b"short", True)]
    assert w.warc_date(got[0]["date"]) == "2020-01-01T00:00:00Z" and w.warc_date(got[1]["date"]) == w.warc_date(w.CRAWLED)
    with pytest.raises(ValueError, match="header line"):
        list(w.read_arc(io.BytesIO(b"no header here at all\n")))


def test_warc_record_round_trip():
    record = {"url": "http://e.org/", "ip": "1.2.3.4", "date": "20200102030405", "mime": "text/html", "offset": 9, "truncated": True,
              "body": b"HTTP/1.1 200 OK\r\nContent-Length: 3\r\n\r\nabc"}
    data = w.warc_head("f") + w.as_warc(record, "f", None) + w.as_warc(record, "f", ("<urn:uuid:1>", "http://o/", "2020-01-01T00:00:00Z"))
    info, response, revisit = w.read_warc(io.BytesIO(data))
    assert info[0]["WARC-Type"] == "warcinfo"
    assert response[0]["WARC-Type"] == "response" and response[1] == record["body"] and response[0]["WARC-Truncated"] == "length"
    assert response[0]["WARC-Date"] == "2020-01-02T03:04:05Z" and response[0]["WARC-IP-Address"] == "1.2.3.4"
    assert revisit[0]["WARC-Type"] == "revisit" and revisit[1].endswith(b"\r\n\r\n") and revisit[0]["WARC-Refers-To"] == "<urn:uuid:1>"
    assert revisit[0]["WARC-Payload-Digest"] == response[0]["WARC-Payload-Digest"]
    plain = w.as_warc({**record, "body": b"dns data", "mime": "text/dns"}, "f", None)
    assert next(iter(w.read_warc(io.BytesIO(plain))))[0]["WARC-Type"] == "resource"


def brute(rows):
    best = {}
    for page, _, html in rows:
        p = (html or "").encode()
        if len(p) >= w.MIN_REVISIT_BYTES:
            best[p] = max(best.get(p, -1), page)
    out = []
    for page, _, html in rows:
        p = (html or "").encode()
        again = p in best and best[p] != page
        out.append((page, len(p), hashlib.sha1(p).hexdigest(), "revisit" if again else "response", best[p] if again else None))
    return sorted(out)


def test_pages(spark, monkeypatch):
    monkeypatch.setattr(w, "MAX_FILE_BYTES", 20_000)
    long, exact = "ü" * 700, "x" * 1000
    html = [None, "", "short", "short", long, exact, "x" * 999, "HTTP/1.1 not a header\r\n\r\n" + exact, long + "\r\n\r\n", "\n" + exact]
    rows = [(i, f"http://e.org/{i % 3} ü\n", html[i * 7 % len(html)]) for i in range(200)] + [(1000, None, long), (1001, "", exact)]
    got = w.archive_pages(pages(spark, rows).repartition(5)).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted(tuple(r) for r in got.collect()) == brute(rows)


def test_repeated_and_missing_ids(spark):
    long = "y" * 2000
    got = w.archive_pages(pages(spark, [(None, "u", long), (3, "u", long), (3, "u", long)])).collect()
    assert sorted(r["record_type"] for r in got) == ["response", "revisit", "revisit"]
    assert {r["refers_to"] for r in got if r["record_type"] == "revisit"} == {3}
    assert w.archive_pages(pages(spark, [])).count() == 0


def test_files_are_readable_archives(spark, tmp_path):
    files = w.write_arc(pages(spark, [(1, "http://e.org", "x" * 50)]), str(tmp_path)).collect()
    assert sum(r["records"] for r in files) == 1
    assert gzip.open(files[0]["path"]).read().startswith(b"filedesc://")

"""Archives: what is written, what is read back, and archives of other writers."""

import base64
import gzip
import hashlib
import shutil

import pytest
from pyspark.sql import functions as F

from spendgrid.llm import store, warc
from spendgrid.llm.queries import QUERIES

PAGES = [(1, "http://a", "<p>x</p>"), (2, "http://b", "<p>x</p>"), (3, None, ""), (4, "http://c", None), (5, "http://d\r\nX: 1", "é" * 5000), (None, "http://e", "<p>x</p>"), (None, "u", "alone"), (2, "http://b", "<p>x</p>"), (6, "http://f", "y\r\n\r\nz")]


def digest(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


def pages(spark, rows=PAGES):
    return spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, payload string")


def brute(rows):
    newest = {}
    for i, _, html in rows:
        newest[digest(html)] = max(newest.get(digest(html)) or i or 0, i or 0) or None
    out = []
    for i, _, html in rows:
        to = newest[digest(html)]
        again = to is not None and i != to
        out.append((i, len((html or "").encode()), digest(html), "revisit" if again else "response", to if again else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    with store.scratch(spark, "test") as place:
        written = warc.write_warc(pages(spark).repartition(3), place, file_bytes=300)
        assert written.agg(F.sum("records")).first()[0] == len(PAGES)
        rows = warc.read_warc(spark, place).collect()
        assert sum(r["record_type"] == "warcinfo" for r in rows) == written.count()
        pages_back = [r for r in rows if r["record_type"] != "warcinfo"]
        found = [(r["page_id"], r["payload_length"], r["payload_digest"][5:], r["record_type"], int(r["refers_to"][10:-1]) if r["refers_to"] else None) for r in pages_back]
        assert sorted(found, key=str) == brute(PAGES)
        texts = {(i, h or "") for i, _, h in PAGES}
        assert all((r["page_id"], r["payload"].decode()) in texts for r in pages_back if r["record_type"] == "response")
        assert all(r["payload"] == b"" for r in pages_back if r["record_type"] == "revisit")
        some = warc.read_warc(spark, place, ["target_uri", "record_type", "page_id"]).where("record_type = 'response' and target_uri like 'http://d%'")
        assert "EqualTo" not in some._jdf.queryExecution().executedPlan().toString()
        assert [r["page_id"] for r in some.collect()] == [5]
        assert warc.read_warc(spark, place, ["page_id"]).where("page_id in (1, 6)").count() == 2
        assert warc.read_warc(spark, place, ["page_id"]).where("page_id > 4").count() == 2


def test_files_of_failed_attempts_are_not_read(spark, folder, monkeypatch):
    write = warc.write_warc

    def twice(pages, place, **more):
        written = write(pages, place, **more)
        path = written.where("bytes > 500").first()["path"]
        shutil.copy(path, path.replace(".warc.gz", "-again.warc.gz"))
        with open(path, "rb") as whole, open(path.replace(".warc.gz", "-cut.warc.gz"), "wb") as short:
            short.write(whole.read()[:-40])
        return written

    monkeypatch.setattr(warc, "write_warc", twice)
    out = QUERIES["op8_warc"](spark, folder).collect()
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    found = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in out]
    assert sorted(found, key=str) == brute(rows)
    with store.scratch(spark, "test") as place:
        none = write(pages(spark, []), place)
        assert warc.read_warc(spark, place, manifest=warc.write_manifest(none, place)).count() == 0


def test_small_payloads_are_not_revisited(spark):
    with store.scratch(spark, "test") as place:
        warc.write_warc(pages(spark), place, least_bytes=100)
        assert warc.read_warc(spark, place, ["record_type"]).where("record_type = 'revisit'").count() == 0


def test_empty_table(spark):
    with store.scratch(spark, "test") as place:
        assert warc.write_warc(pages(spark, []), place).count() == 0
        assert warc.read_warc(spark, place).count() == 0


@pytest.mark.parametrize("name", ["a.warc", "a.warc.gz"])
def test_other_writers(spark, tmp_path, name):
    def one(i):
        body = f"HTTP/1.1 200 OK\r\nA: b\r\n\r\nbody {i} ".encode() + b"z" * 9000 * i
        head = f"WARC/1.0\r\nWARC-Type: {'response' if i % 2 else 'request'}\r\nWARC-Target-URI: http://x/{i}\r\n  more\r\nContent-Type: application/http\r\nContent-Length: {len(body)}\r\n\r\n"
        return head.encode() + body + b"\r\n\r\n"

    raw = [one(i) for i in range(6)]
    (tmp_path / name).write_bytes(b"".join(gzip.compress(r) if name.endswith("gz") else r for r in raw))
    rows = warc.read_warc(spark, str(tmp_path), ["record_type", "target_uri", "payload", "position"]).where("record_type = 'response'").collect()
    assert [(r["target_uri"], len(r["payload"])) for r in sorted(rows, key=lambda r: r["position"])] == [(f"http://x/{i} more", 7 + 9000 * i) for i in (1, 3, 5)]
    assert warc.read_warc(spark, str(tmp_path), ["target_uri"]).count() == 6


def test_query(spark, folder):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{folder}/pages.parquet").collect()]
    assert sorted((tuple(r) for r in QUERIES["op8_warc"](spark, folder).collect()), key=str) == brute(rows)

"""Fill-in-middle against plain Python."""

import hashlib
import re

import pytest
from tests.llm.helpers import no_documents, odd_documents

from spendgrid.llm import fim


def brute(doc_id, text, seed=7, rate=100, spm=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < spm:
        return doc_id, n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


SPECIAL = [
    (20, "\n", None, None),
    (21, "\n\n\n", None, None),
    (22, "a\r\nb\r\n\r\nc", None, None),
    (23, "one\ntwo\nthree <M> marker\n", None, None),
    (24, "<P", None, None),
    (25, "<S\n>\n<P\n>\n<M\n<<\n" * 9, None, None),
    (26, "\0x\n y\x85z\x0bq\n", None, None),
    (27, "\U0001f600\né\n" * 50, None, None),
    (28, "long line " * 300_000, None, None),
    (29, "many lines\n" * 200_000, None, None),
    (9_223_372_036_854_775_807, "a\nb\nc\nd\n", None, None),
    (-5, "a\nb\nc\nd\n", None, None),
]


@pytest.mark.parametrize("rate,spm", [(100, 50), (60, 30), (0, 50), (100, 0), (100, 100)])
def test_equals_plain_python_and_restores(spark, rate, spm):
    docs = odd_documents(spark).union(odd_documents(spark, SPECIAL + [(i, "x\ny\nz\n" * (i % 7), None, None) for i in range(100, 160)]))
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    out = fim.fill_in_middle(docs, rate=rate, spm=spm)
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in out.collect()), key=key) == sorted((brute(i, t, 7, rate, spm) for i, t in rows), key=key)
    back = fim.restored(out, keep=("doc_id", "n"))
    assert sorted(((r["doc_id"], r["text"]) for r in back.collect()), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def test_forms_occur(spark):
    docs = odd_documents(spark, [(i, "a\nb\nc\n", None, None) for i in range(400)])
    found = {r["form"]: r["count"] for r in fim.fill_in_middle(docs, rate=80).groupBy("form").count().collect()}
    assert 40 < found["plain"] < 130 and 100 < found["psm"] < 220 and 100 < found["spm"] < 220


def test_small_chunks_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(fim, "CHUNK_BYTES", 16)
    docs = odd_documents(spark)
    key = lambda r: repr(r)
    assert sorted((tuple(r) for r in fim.fill_in_middle(docs).collect()), key=key) == sorted((brute(r["doc_id"], r["text"]) for r in docs.collect()), key=key)
    assert fim.restored(fim.fill_in_middle(no_documents(spark))).count() == 0


def test_names_may_clash_and_hold_backticks(spark):
    docs = spark.createDataFrame([(1, "a\nb\n", "q", 3)], "`id``s` long, output string, text string, form long")
    row = fim.fill_in_middle(docs, id_col="id`s", text_col="output").first()
    assert tuple(row) == brute(1, "a\nb\n")

"""BPE through distinct words against the tokenizers library on whole texts."""

import json
import random
import uuid

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F
from tests.llm.helpers import no_documents, odd_documents
from tokenizers import Tokenizer

from spendgrid.llm import bpe

FILE = path("word_bpe_49k.json")
TEXTS = [
    "don't you'll WE'VE they're I'd 'tis 's's 'sam it''s '' 'll've rock'n'roll o'clock's!'s 're've'",
    "l' 'l 'r e 'v",
    "'",
    "a'",
    "abc 123 4５６ x²y ½ ⅷⅧ 12,5%% ... !?!",
    "Ünï École ÀÉÎÕÜ straße ŒUVRE İstanbul ıI ǅ ﬁ Σίσυφος ΣΑΣ ὈΔΥΣΣΕΎΣ Привет МИР",
    "é É ạ̈ Å Ω ; 각 한국어 中文。、 日本 ガ क़",
    "x<|endoftext|>y<|startoftext|><|endoftext|>'s <|ENDOFTEXT|> <|endoftext|",
    " nbsp em​zero\u0085nel\x1c\x1f\x0b tab\t\tx\r\n﻿",
    "\0 \x01\x7f � \U0001f600\U0001f468‍\U0001f469 \U00010400 a‍б ‘quote’ “q” – — … € ™ é's É'S",
    "w" * 3000 + "'" * 50 + "é" * 999,
    "# code_line(x) -> {y: 1}; // «été» ¿qué? ¡no!",
    "đ Đ ơ ư Ǆ ʼn 'ʼs ŉ ß ẞ K",
]


CODER = Tokenizer.from_file(FILE)


def library(text):
    ids = CODER.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), CODER.decode(ids, skip_special_tokens=False)


def check(spark, docs, tmp_path, **names):
    out = bpe.decoded(bpe.encode(docs, FILE, f"file://{tmp_path}/blocks", **names), FILE, ("doc_id", "n_tokens", "ids"))
    rows = [(r[0], r[1]) for r in docs.select(names.get("id_col", "doc_id"), F.col("`" + names.get("text_col", "text") + "`")).collect()]
    key = lambda r: repr(r)
    want = sorted(((i, len(ids) // 4, ids, text) for i, t in rows for ids, text in [library(t)]), key=key)
    got = sorted(((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["text"]) for r in out.collect()), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g == w
    return out


@pytest.mark.parametrize("block,chunk", [(8 << 20, None), (200, None), (1, 40)])
def test_equals_library(spark, tmp_path, monkeypatch, block, chunk):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", block)
    if chunk:
        whole = bpe.byte_chunks
        monkeypatch.setattr(bpe, "byte_chunks", lambda column, limit=chunk: whole(column, limit))
    docs = odd_documents(spark).union(odd_documents(spark, [(100 + i, t, None, None) for i, t in enumerate(TEXTS)]))
    check(spark, docs.repartition(3), tmp_path)


def test_random_strings(spark, tmp_path):
    rng = random.Random(1)
    alphabet = "aA'srtvemld lé É!?12 \n\t<|>́̈ñİΣ中 <|endoftext|>"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 120))), None, None) for i in range(1500)]
    check(spark, odd_documents(spark, rows), tmp_path)


def test_sample_of_the_table(spark, folder, tmp_path):
    check(spark, spark.read.parquet(f"{folder}/documents.parquet"), tmp_path)


def test_long_text_many_words_and_clashing_names(spark, tmp_path):
    long = " ".join(f"w{i}q" for i in range(90_000))  # over 65,536 distinct words and 4 MB
    long = (long + " ") * 6
    docs = spark.createDataFrame([("a", long, 1, "z"), ("b", "x y", 2, "z")], "block string, `the``text` string, codes int, words string")
    out = bpe.encode(docs, FILE, f"file://{tmp_path}/blocks", "block", "the`text")
    rows = bpe.decoded(out, FILE, ("doc_id", "ids")).orderBy("doc_id").collect()
    assert (bytes(rows[0]["ids"]), rows[0]["text"]) == library(long) and rows[1]["text"] == library("x y")[1]


def test_every_distinct_word_is_encoded_once(spark, tmp_path, monkeypatch):
    docs = odd_documents(spark, [(i, "same words here " * 20 + f"own{i % 9}", None, None) for i in range(200)]).repartition(4)
    blocks = bpe.write_blocks(docs, FILE, f"file://{tmp_path}/b")
    seen = tmp_path / "seen"
    seen.mkdir()

    class Counted(bpe.Words):
        def encode(self, words):
            (seen / uuid.uuid4().hex).write_text("\n".join(words))
            return super().encode(words)

    monkeypatch.setattr(bpe, "Words", Counted)
    monkeypatch.setattr(bpe, "words_of", lambda path: Counted(path))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        rows = bpe.encoded_words(blocks, FILE).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    words = [w for f in seen.iterdir() for w in f.read_text().split()]
    assert sorted(words) == sorted(["same", "words", "here", "own", *"012345678"])
    assert sum(r["n_words"] for r in rows) == sum(len(r["words"]) for r in blocks.where("words IS NOT NULL").collect())


def test_decoding_any_ids(spark):
    ids = [[], [49406, 320, 49407], [5, 60_000, 7], list(range(2000))]
    df = spark.createDataFrame([(i, np.array(x, "<u4").tobytes(), "t") for i, x in enumerate(ids)] + [(9, None, "t")], "key long, ids binary, own string")
    found = {r["key"]: r["text"] for r in bpe.decoded(df, FILE, ("key", "own")).collect()}
    assert found == {**{i: CODER.decode(x, skip_special_tokens=False) for i, x in enumerate(ids)}, 9: ""}


def test_empty_table_and_other_files(spark, tmp_path):
    assert bpe.decoded(bpe.encode(no_documents(spark), FILE, f"file://{tmp_path}/blocks"), FILE).count() == 0
    with pytest.raises(ValueError):
        bpe.Words(path("byte_bpe_50k.json"))
    spec = json.load(open(FILE))
    spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] = r"[\p{L}\p{N}']+|[^\s\p{L}\p{N}']+"
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    words = bpe.Words(str(other))
    data = np.frombuffer("It's 12a, é".encode(), np.uint8)
    assert words.split(data, np.array([0, len(data)]))[0].to_pylist() == ["it's", "12a", ",", "é"]

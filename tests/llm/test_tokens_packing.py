"""Token files and packing: round trips, and best fit one document at a time."""

import random
import zlib

import numpy as np
import pytest
from tests.llm.helpers import no_documents, odd_documents, sample

from spendgrid.llm import packing, store, token_files
from spendgrid.llm.queries import tokenizer


def encoded(docs, end_id):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer())
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    return [(i, t.encode(x, add_special_tokens=False).ids + [end_id]) for i, x in rows]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("rows", ["odd", "sample"])
def test_files_give_back_every_document(spark, folder, rows):
    docs = sample(spark, folder) if rows == "sample" else odd_documents(spark)
    with store.scratch(spark, "test") as place:
        files = token_files.write_token_files(docs, place, tokenizer(), file_bytes=1 << 12, frame_bytes=1 << 10)
        out = sorted(token_files.read_token_files(files, place).collect(), key=lambda r: r["start"])
        some = {r["doc_id"] for r in token_files.read_token_files(files, place, wanted=[3, 8]).collect()}
    expected = encoded(docs, 2)
    key = lambda i: (i is not None, i or 0)
    assert [r["doc_id"] for r in out] == sorted((i for i, _ in expected), key=key)
    assert sorted((str(r["doc_id"]), r["ids"]) for r in out) == sorted((str(i), ids) for i, ids in expected)
    start = 0
    for r in out:
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(r["ids"]), crc(r["ids"]))
        start += r["n_tokens"]
    assert some == {3, 8}


def test_damage_is_found(tmp_path):
    path = tmp_path / "x"
    writer = token_files.FileWriter(path.open("wb"), frame_bytes=64)
    for i in range(20):
        writer.add(i, np.arange(i + 1, dtype=np.uint32))
    writer.close()
    reader = token_files.FileReader(path.open("rb"), path.stat().st_size)
    assert [len(ids) for _, _, ids in reader.read([3, 4])] == [4, 5]
    reader.frames = reader.frames.copy()
    reader.frames["checksum"][1] ^= 1
    with pytest.raises(ValueError):
        list(reader.read())


def one_by_one(lengths, capacity):
    bins = []
    for n in sorted(lengths, reverse=True):
        fit = [b for b in bins if b >= n]
        room = min(fit) if fit else capacity
        if fit:
            bins.remove(room)
        bins.append(room - n)
    return sorted(bins)


def test_plan_is_best_fit_decreasing():
    rng = random.Random(3)
    for capacity, n in ((10, 60), (64, 300), (100, 500)):
        for _ in range(6):
            lengths = [rng.randint(1, rng.choice([3, capacity // 3, capacity])) for _ in range(n)]
            counts = {x: lengths.count(x) for x in set(lengths)}
            rooms = {}
            for length, _, pieces, first, per, offset in packing.plan(counts, capacity):
                for j in range(pieces):
                    b = first + j // per
                    assert offset + j % per * length == rooms.get(b, 0)
                    rooms[b] = offset + j % per * length + length
            assert sorted(capacity - x for x in rooms.values()) == one_by_one(lengths, capacity)


@pytest.mark.parametrize("rows", ["odd", "sample"])
def test_pack_covers_every_token_without_gaps(spark, folder, rows, monkeypatch):
    monkeypatch.setattr(packing, "SLICE_ROWS", 3)
    docs = sample(spark, folder) if rows == "sample" else odd_documents(spark)
    out = packing.pack(docs, tokenizer()).collect()
    pieces = []
    for _, ids in encoded(docs, 0):
        head = len(ids) % 2048 or 2048
        cuts = [0, *range(head, len(ids) + 1, 2048)]
        pieces += [(a, b - a, crc(ids[a:b])) for a, b in zip(cuts, cuts[1:])]
    assert sorted((r["start"], r["length"], r["ids_crc32"]) for r in out) == sorted(pieces)
    ends = {}
    for r in sorted(out, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == ends.get(r["sequence_id"], 0)
        ends[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(ends.values()) <= 2048
    assert sorted(2048 - e for e in ends.values()) == one_by_one([n for _, n, _ in pieces], 2048)


def test_empty_table(spark):
    assert packing.pack(no_documents(spark), tokenizer()).count() == 0
    with store.scratch(spark, "test") as place:
        files = token_files.write_token_files(no_documents(spark), place, tokenizer())
        assert token_files.read_token_files(files, place).count() == 0


def test_pieces_that_collide_modulo_a_power_of_two(spark, tmp_path):
    from tests.llm.test_ngram_join import thue_morse

    docs = spark.createDataFrame(list(enumerate(thue_morse())), "doc_id long, text string")
    files = token_files.write_token_files(docs, f"file://{tmp_path}", tokenizer())
    found = {r["doc_id"]: list(r["ids"]) for r in token_files.read_token_files(files, f"file://{tmp_path}").collect()}
    assert found == {i: ids for i, ids in encoded(docs, 2)}

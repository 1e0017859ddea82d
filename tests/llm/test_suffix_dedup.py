"""Repeated byte strings against all windows of all texts."""

import hashlib
import random
from collections import Counter

import pytest
from tests.llm.helpers import no_documents, odd_documents, sample

from spendgrid.llm import suffix_dedup


def brute(rows, length):
    raws = [(t or "").encode() for _, t in rows]
    often = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for (doc_id, _), r in zip(rows, raws):
        gone, end, runs = bytearray(len(r)), 0, 0
        for i in range(len(r) - length + 1):
            if often[r[i : i + length]] > 1:
                runs += i > end or not end
                gone[i : i + length] = b"\x01" * length
                end = i + length
        rest = bytes(b for b, g in zip(r, gone) if not g)
        out.append((doc_id, len(r), sum(gone), runs, hashlib.sha256(rest).hexdigest()))
    return sorted(out, key=str)


def pieces(seed, n, length):
    """Texts that share passages of lengths around the limit, repeat within themselves, or loop."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randint(2, 9)))
    text = lambda size: "".join(word() for _ in range(size))
    shared = [text(rng.randint(length // 8, length // 2)) for _ in range(12)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared)[rng.randint(0, 9) :] if rng.random() < 0.4 else text(rng.randint(1, 30)) for _ in range(rng.randint(1, 9))]
        rows.append((i, "".join(parts)))
    rows += [(n, "ab" * length), (n + 1, "x" * length), (n + 2, "x" * (length - 1)), (n + 3, rows[0][1]), (n + 3, rows[0][1]), (None, None), (n + 5, "")]
    return rows


@pytest.mark.parametrize("length,gram,hot", [(200, 64, 20_000), (40, 16, 20_000), (40, 16, 1), (40, 16, 0)])
def test_every_window_is_judged(spark, monkeypatch, length, gram, hot):
    monkeypatch.setattr(suffix_dedup, "GRAM", gram)
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", hot)
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (200, gram, 4))
    rows = pieces(length + hot, 60, length)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    for batches in (1, 5):
        out = sorted((tuple(r) for r in suffix_dedup.removed(docs, length, batches).collect()), key=str)
        assert out == brute(rows, length)


def test_no_task_holds_a_hot_passage(spark, monkeypatch):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(300))
    around = lambda: "".join(rng.choice("abcdefgh ") for _ in range(50))
    rows = [(i, around() + passage + around()) for i in range(80)]
    monkeypatch.setattr(suffix_dedup, "HOT_ROWS", 20)
    compare = suffix_dedup._equal_windows

    def bounded(length):
        run = compare(length)

        def count(batches):
            held = list(batches)
            keys = Counter(k for b in held for k in b.column(0).to_pylist())
            if keys and max(keys.values()) > 20:
                raise ValueError(f"{max(keys.values())} rows of one key in a task")
            yield from run(iter(held))

        return count

    monkeypatch.setattr(suffix_dedup, "_equal_windows", bounded)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert sorted((tuple(r) for r in suffix_dedup.removed(docs).collect()), key=str) == brute(rows, 200)


def test_sample(spark, folder):
    rows = [(r["doc_id"], r["text"]) for r in sample(spark, folder).collect()]
    assert sorted((tuple(r) for r in suffix_dedup.removed(sample(spark, folder)).collect()), key=str) == brute(rows, 200)


def test_odd_rows_and_cut_texts(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in suffix_dedup.removed(docs, 60, 2).collect()), key=str) == brute(rows, 60)
    out = suffix_dedup.without_repeats(docs, 60, 2)
    assert out.columns == docs.columns
    gone = {d for d, n, k, _, sha in brute(rows, 60) if k and (n == k or sha == hashlib.sha256(b"\n\n").hexdigest())}
    left = {r["doc_id"]: r for r in out.collect()}
    assert gone >= {3, 4} and set(left) == {d for d, _ in rows} - gone
    assert all(r["n_chars"] == len(r["text"] or "") for r in left.values())
    assert suffix_dedup.removed(no_documents(spark)).count() == 0
    assert suffix_dedup.without_repeats(no_documents(spark)).count() == 0


def test_levels_merge_like_binary_digits(spark, tmp_path):
    index = suffix_dedup.SuffixIndex(spark, str(tmp_path), 40, 16)
    rows = spark.createDataFrame([(i, f"text {i} " * 3 + "the same passage in all of the documents, long enough to match") for i in range(7)], "at long, text string")
    for i in range(7):
        matches = index.add(rows.where(f"at = {i}"))
        assert matches.where(f"at <> {i}").count() > 0 or i == 0
        held = sorted(rank for rank, paths in index.levels.items() for _ in paths)
        assert len(held) <= len(bin(i + 1)) - 1
    assert sum(index._read(p).select("at").distinct().count() for paths in index.levels.values() for p in paths) == 7

"""Quality rules and source mixing against plain Python."""

from collections import Counter, defaultdict

import pytest
from tests.llm.helpers import no_documents, odd_documents, sample, words

from spendgrid.llm import mixing, quality_rules


def measures(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    often = Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 8)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text or ""),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_echo_words": sum(a == b for a, b in zip(w, w[1:])),
        "n_marks": (text or "").count("!"),
    }


@pytest.mark.parametrize("rows", [odd_documents, "sample"])
def test_measures_equal_brute_force(spark, folder, rows):
    docs = sample(spark, folder) if rows == "sample" else rows(spark)
    texts = defaultdict(list)
    for r in docs.collect():
        texts[r["doc_id"]].append(r["text"])
    found = quality_rules.ledger(docs).collect()
    assert len(found) == docs.count()
    for row in found:
        expected = measures(texts[row["doc_id"]][0])
        assert {k: row[k] for k in expected} == expected


def test_policies_read_bits_and_ablations_count_them(spark):
    rows = quality_rules.ledger(odd_documents(spark))
    bits = [r["bits"] for r in rows.collect()]
    policy = quality_rules.POLICIES["v2"]
    assert rows.where(quality_rules.kept(policy)).count() == sum(b & policy.mask == 0 for b in bits)
    for row in quality_rules.ablations(rows).collect():
        mask = quality_rules.POLICIES[row["policy"]].mask
        bit = 1 << [n for n, _ in quality_rules.RULES].index(row["rule"])
        assert row["failed"] == sum(b & bit > 0 for b in bits)
        assert row["failed_alone"] == sum(b & mask == bit for b in bits)
        assert row["documents"] == len(bits)


def test_empty_tables(spark):
    assert quality_rules.ledger(no_documents(spark)).count() == 0
    assert mixing.mix(no_documents(spark)).count() == 0
    assert mixing.mixed(no_documents(spark)).columns == no_documents(spark).columns


def targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, free, out = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in free}
        out |= {s: 2.0 * sizes[s] for s in over}
        left -= sum(2.0 * sizes[s] for s in over)
        free -= over
    return out


@pytest.mark.parametrize("rows", ["odd", "sample"])
def test_mix_meets_targets(spark, folder, rows):
    docs = sample(spark, folder) if rows == "sample" else odd_documents(spark)
    out = mixing.mix(docs).collect()
    assert len(out) == docs.count()
    sizes = defaultdict(int)
    for r in out:
        assert r["size"] == len(words(r["text"]))
        sizes[r["source"]] += r["size"]
    expected = targets(dict(sizes))
    taken, longest = Counter(), Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(expected[r["source"]])
        assert 0 <= r["copies"] <= 2
        taken[r["source"]] += r["copies"] * r["size"]
        longest[r["source"]] = max(longest[r["source"]], r["size"])
    for source, n in taken.items():
        assert abs(n - expected[source]) <= 1.2 * longest[source]


def test_slices_of_one_source_and_reruns(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE_ROWS", 7)
    docs = spark.range(600).selectExpr("id doc_id", "repeat('w ', int(id % 90 + 1)) text", "if(id % 3 = 0, 'hot', concat('s', id % 4)) source")
    first = {r["doc_id"]: (r["copies"], r["size"], r["target"], r["source"]) for r in mixing.mix(docs).collect()}
    again = {r["doc_id"]: (r["copies"], r["size"], r["target"], r["source"]) for r in mixing.mix(docs.repartition(5)).collect()}
    assert first == again
    for source in {v[3] for v in first.values()}:
        rows = [v for v in first.values() if v[3] == source]
        assert abs(sum(c * n for c, n, _, _ in rows) - rows[0][2]) <= 0.03 * rows[0][2] + 90
    assert mixing.mixed(docs).count() == sum(v[0] for v in first.values())

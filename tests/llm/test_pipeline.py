"""The pipeline, each stage against plain Python on what the stage before returned."""

from collections import Counter

import corpus_pipeline
import pytest
from tests.llm.helpers import no_documents, odd_documents, sample
from tests.llm.test_ngram_join import brute as components
from tests.llm.test_rules_mixing import measures
from tests.llm.test_suffix_dedup import brute as repeats
from tests.llm.test_tokens_packing import encoded, one_by_one

from spendgrid.llm import mixing, store


@pytest.mark.parametrize("rows", ["odd", "sample"])
def test_every_stage(spark, folder, rows):
    docs = sample(spark, folder) if rows == "sample" else odd_documents(spark)
    results = []
    with store.scratch(spark, "test") as place:
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, folder)
            assert out.columns == docs.columns or name == "best_fit_packing"
            out.write.parquet(f"{place}/{name}")
            docs = spark.read.parquet(f"{place}/{name}")
            results.append([r.asDict() for r in docs.collect()])
        copies = mixing.mix(spark.read.parquet(f"{place}/suffix_dedup")).select("doc_id", "copies").collect()
        lengths = [len(ids) for _, ids in encoded(spark.read.parquet(f"{place}/source_mixing"), 0)]
    start = [(r["doc_id"], r["text"]) for r in (sample(spark, folder) if rows == "sample" else odd_documents(spark)).collect()]
    ruled, single, cut, mixed, packed = results

    def fine(text):
        m = measures(text)
        upper = sum(c.isupper() for c in text or "")
        return not (
            m["n_words"] < 20
            or 100 * m["n_repeat_words"] > 30 * m["n_words"]
            or 100 * m["n_symbols"] > 40 * m["n_words"]
            or (m["n_lines"] >= 4 and 100 * m["n_dup_lines"] > 30 * m["n_lines"])
            or 100 * upper > 35 * m["word_chars"]
            or 100 * m["n_marks"] > 50 * m["n_words"]
            or 100 * m["n_echo_words"] > 30 * m["n_words"]
            or m["word_chars"] > 30 * m["n_words"]
        )

    assert Counter(r["doc_id"] for r in ruled) == Counter(i for i, t in start if fine(t))
    groups = {i: c for i, _, c in components([(r["doc_id"], r["text"]) for r in ruled], 5, 80, 100)}
    assert sorted(r["doc_id"] for r in single) == sorted(set(groups.values()))
    expected = {d: n - k for d, n, k, _, _ in repeats([(r["doc_id"], r["text"]) for r in single], 200)}
    assert {r["doc_id"] for r in cut} >= {d for d, n in expected.items() if n > 3}
    for r in cut:
        assert expected[r["doc_id"]] <= len(r["text"].encode()) <= expected[r["doc_id"]] + 60
        assert r["n_chars"] == len(r["text"])
    assert Counter(r["doc_id"] for r in mixed) == Counter({r["doc_id"]: r["copies"] for r in copies if r["copies"]})
    pieces = [x for n in lengths for x in [n % 2048 or 2048, *[2048] * ((n - 1) // 2048)]]
    ends = Counter()
    for r in packed:
        ends[r["sequence_id"]] += r["length"]
    assert sorted(r["length"] for r in packed) == sorted(pieces)
    assert sorted(2048 - n for n in ends.values()) == one_by_one(pieces, 2048)


def test_run_is_the_stages_and_empty_tables_pass(spark, folder):
    first = sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect())
    assert first and first == sorted(tuple(r) for r in corpus_pipeline.run(spark, folder).drop("sequence_id", "offset").collect())
    docs = no_documents(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, folder)
        assert docs.count() == 0

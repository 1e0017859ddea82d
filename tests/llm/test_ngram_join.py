"""The Jaccard join against all pairs in plain Python."""

import random
from collections import defaultdict

import pytest
from tests.llm.helpers import no_documents, odd_documents, sample, words

from spendgrid.llm import ngram_join


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k):
    w = words(lower(text))
    if len(w) < k:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}


def brute(rows, k, num, den):
    sets = [shingles(text, k) for _, text in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and den * len(sets[i] & sets[j]) >= num * len(sets[i] | sets[j]):
                up[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(rows[i][0])
    least = {r: min((x for x in m if x is not None), default=None) for r, m in members.items()}
    return sorted(((d, len(sets[i]), least[root(i)] if sets[i] else d) for i, (d, _) in enumerate(rows)), key=str)


def edited(rng, text, changes):
    w = text.split(" ")
    for _ in range(changes):
        w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def near_copies(n, sizes, most, seed):
    rng, rows = random.Random(seed), []
    for i in range(n):
        size = rng.choice(sizes)
        base = " ".join(f"w{rng.randrange(3000)}" for _ in range(size))
        rows += [(len(rows) + j, edited(rng, base, rng.randint(0, most))) for j in range(rng.randint(1, 6))]
    return rows


@pytest.mark.parametrize("k,num", [(4, 85), (5, 80)])
@pytest.mark.parametrize("tile", [256, 8])
def test_components_equal_brute_force(spark, folder, monkeypatch, k, num, tile):
    monkeypatch.setattr(ngram_join, "TILE_ROWS", tile)
    rows = near_copies(25, [4, 6, 9, 13, 20, 40, 90, 200, 600], 6, k)
    rng = random.Random(1)
    chain = " ".join(f"c{i}" for i in range(150))
    for i in range(60):  # neighbours in the chain are linked, its ends are not
        rows.append((1000 + i, chain))
        chain = edited(rng, chain, 1)
    if tile == 256:
        rows += [(r["doc_id"] + 5000, r["text"]) for r in sample(spark, folder).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    out = sorted((tuple(r) for r in ngram_join.joined(docs, k, f"0.{num}").collect()), key=str)
    assert out == brute(rows, k, num, 100)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert sorted((tuple(r) for r in ngram_join.joined(docs).collect()), key=str) == brute(rows, 5, 80, 100)
    assert ngram_join.joined(no_documents(spark)).count() == 0


def test_one_document_of_each_component_stays(spark):
    docs = odd_documents(spark)
    kept = ngram_join.one_of_each(docs).collect()
    assert sorted((r["doc_id"] for r in kept), key=str) == sorted([0, 1, 2, 3, 6, 7, 8, 9, None], key=str)  # 3, 4 and 5 are one component
    assert kept[0].__fields__ == docs.columns


@pytest.mark.parametrize("share", [None, 0.02, 0.3, 0.9, 1.0])
def test_bands_share_a_part(share):
    """Sets within the threshold always have an equal key, whichever shingles count as common."""
    import numpy as np

    rng, bands = np.random.default_rng(5), ngram_join.Bands("0.85")
    common = None if share is None else rng.random(1 << 10) < share
    for _ in range(2000):
        n = int(rng.integers(1, rng.choice([8, 30, 300])))
        base = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        cut, more = rng.integers(0, n // 5 + 1, 2)
        other = np.unique(np.concatenate([base[cut:], rng.integers(0, 1 << 63, more, dtype=np.uint64)]))
        both = len(np.intersect1d(base, other))
        if len(other) and 100 * both >= 85 * len(np.union1d(base, other)) and not np.array_equal(base, other):
            assert np.intersect1d(ngram_join.part_keys(base, bands, common), ngram_join.part_keys(other, bands, common)).size


def thue_morse(n=1024):
    """A word and its complement, which collide in every polynomial hash modulo 2^64."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_words_that_collide_modulo_a_power_of_two(spark):
    docs = spark.createDataFrame(list(enumerate(thue_morse())), "doc_id long, text string")
    assert sorted(r["component_id"] for r in ngram_join.joined(docs, 4, "0.85").collect()) == [0, 1]


@pytest.mark.parametrize("own", [0.25, 0.4])
def test_documents_of_one_template_are_not_seated_together(spark, monkeypatch, own):
    """Unlinked documents of one template: seats grow with their number, not with its square."""
    seats = []
    plain = ngram_join.seated
    monkeypatch.setattr(ngram_join, "seated", lambda s, sets: seats.append(s.count()) or plain(s, sets))
    monkeypatch.setattr(ngram_join, "TILE_ROWS", 16)
    template = [f"t{i}" for i in range(100)]
    numbers = []
    for n in (100, 400):
        rows = []
        for i in range(n):
            mine = [f"o{i}x{j}" for j in range(int(100 * own / (1 - own)))]
            rows.append((i, " ".join(template[: 100 - len(mine) % 7] + mine)))
        rows += [(n + i, " ".join([*template, f"z{i}"])) for i in range(40)]  # linked with each other
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
        seats.clear()
        found = {r["doc_id"]: r["component_id"] for r in ngram_join.joined(docs, 2, "0.8").collect()}
        assert found == {d: c for d, _, c in brute(rows, 2, 80, 100)}
        numbers.append(sum(seats))
    assert numbers[1] <= 5 * numbers[0] + 100


def test_column_names_with_backticks(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 1), (2, "a b c d e f", 2)], "`doc``id` long, `te``xt` string, `o``ther` int")
    kept = ngram_join.one_of_each(docs, id_col="doc`id", text_col="te`xt").collect()
    assert [tuple(r) for r in kept] == [(1, "a b c d e f", 1)]


def test_sets_are_dealt_once(spark, monkeypatch):
    """A class has one set although its rows repeat, without a shuffle of the sets; its shuffle files do not stay."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text)] * 5 + [(2, text + " end")] * 3 + [(3, text + " end of it")] + [(4, " ".join(f"v{i}" for i in range(40)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found, plain = [], ngram_join.stored_sets
    monkeypatch.setattr(ngram_join, "stored_sets", lambda r, k: found.append(plain(r, k)) or found[-1])
    out = sorted((r["doc_id"], r["component_id"]) for r in ngram_join.joined(docs, 5, "0.8").collect())
    assert out == [(1, 1)] * 5 + [(2, 1)] * 3 + [(3, 1), (4, 4)]
    classes = [r["class"] for r in found[0].select("class").collect()]
    assert len(classes) == len(set(classes)) == 3

"""Near copies by shingle similarity against brute force."""

import random
from itertools import combinations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidemark.llm import shingles, simhash


def grams(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def stay(rows):
    """Ids left: the smallest of every component of pairs of similarity 0.8 or more."""
    root, sets = {i: i for i, _ in rows}, {i: grams(t) for i, t in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in combinations(sorted(root), 2):
        union = len(sets[a] | sets[b])
        if not union or 5 * len(sets[a] & sets[b]) >= 4 * union:
            u, v = find(a), find(b)
            root[max(u, v)] = min(u, v)
    return sorted(i for i in root if root[i] == i)


def edited(rng, text, share):
    w = text.split()
    for at in rng.sample(range(len(w)), max(1, round(share * len(w)))):
        w[at] = f"new{rng.randrange(10**6)}"
    return " ".join(w)


def texts(prose, copies=6):
    """Copies at similarities from about 0.95 to 0.6, short texts and one family of very many."""
    rng, rows = random.Random(11), []
    for share in (0.004, 0.01, 0.015, 0.02, 0.022, 0.025, 0.03, 0.05):
        for words in (40, 120, 500):
            base = prose(words)
            rows += [base] + [edited(rng, base, share) for _ in range(copies)]
    hot = prose(150)
    rows += [edited(rng, hot, rng.choice([0.007, 0.02, 0.03])) for _ in range(60)]
    rows += ["one two", "ONE  two", "one two three", prose(4), "", " \n"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_stage_matches_brute_force(spark, make, prose):
    rows = texts(prose)
    got = corpus_pipeline.near_duplicates(spark, make(rows), "")
    assert got.columns == make(rows).columns
    assert sorted(r.doc_id for r in got.collect()) == stay(rows)


@pytest.mark.parametrize("length", [100, 300])
def test_one_replaced_word_is_a_near_copy(spark, make, prose, length):
    rng, rows = random.Random(length), []
    for i in range(40):
        base = prose(length)
        rows += [(2 * i, base), (2 * i + 1, edited(rng, base, 0))]
    got = corpus_pipeline.near_duplicates(spark, make(rows), "")
    assert sorted(r.doc_id for r in got.collect()) == stay(rows) == list(range(0, 80, 2))


def test_rows_without_ids_and_repeated_ids(make, prose):
    a, b, c = prose(60), prose(60), prose(60)
    got = shingles.keep_one(make([(0, a), (1, a), (1, b), (1, b), (1, c), (None, a), (None, None), (7, None), (8, "")])).collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted([(0, a), (1, b), (1, c), (None, a), (None, None), (7, None)], key=str)
    assert shingles.keep_one(make([])).count() == 0


def family(prose, copies, shares, words=150, seed=5):
    """Edited copies of one text; the brute force below it compares sets of numbers."""
    rng, base = random.Random(seed), prose(words)
    rows = [edited(rng, base, rng.choice(shares)) for _ in range(copies)]
    rows += [edited(rng, rows[k], 0.05) for k in range(0, copies, 9)]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("copies,shares", [(1000, [0.022, 0.026, 0.03, 0.035]), (1200, [0.02, 0.03, 0.04])])
def test_large_families_equal_brute_force(make, prose, copies, shares):
    rows = family(prose, copies, shares)
    got = shingles.keep_one(make(rows, parts=6))
    assert sorted(r.doc_id for r in got.collect()) == stay(rows)


def test_clusters_in_blocks_equal_brute_force(make, prose):
    rows = family(prose, 300, [0.02, 0.03, 0.035])
    docs = make(rows)
    texts = shingles.hashed(docs, "doc_id", "text")
    hashed = shingles.shingled(texts, 5)
    nodes = {r.doc_id: r.node for r in hashed.collect()}
    for block in (1 << 24, 50_000):
        links = [(r.u, r.v) for r in shingles.near_links(texts, hashed, 5, 0.8, block).collect()]
        root = {n: n for n in nodes.values()}

        def find(n):
            while root[n] != n:
                n = root[n]
            return n

        for u, v in links:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
        assert len({find(n) for n in nodes.values()}) == len(stay(rows))


def test_links_of_a_cluster():
    """Against all pairs that agree in a band, for sets with and without sides."""
    import numpy as np

    rng = np.random.default_rng(3)
    for trial in range(20):
        base = rng.integers(0, 1 << 40, 60, np.uint64)
        sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(40, 61)], rng.integers(0, 1 << 40, rng.integers(0, 6), np.uint64)])) for _ in range(60)]
        keys = rng.integers(0, 4, (60, shingles.BANDS)) + np.where(rng.random((60, 1)) < 0.3, 100, 0)
        side = rng.integers(0, 2, 60) if trial % 2 else None
        pairs = []
        for a, b in combinations(range(60), 2):
            common = len(np.intersect1d(sets[a], sets[b]))
            near = common >= 0.8 * (len(sets[a]) + len(sets[b]) - common) - 1e-9
            if near and (keys[a] == keys[b]).any() and (side is None or side[a] != side[b]):
                pairs.append((a, b))
        found = shingles.linked(keys, sets, 0.8, side)
        assert {tuple(sorted(e)) for e in found} <= set(pairs) and len(found) < 60

        def parts(edges):
            label = list(range(60))
            for a, b in edges:
                label = [label[a] if x == label[b] else x for x in label]
            return [label.index(x) for x in label]

        assert parts(found) == parts(pairs)


def test_classes_of_fingerprints_are_candidates(make, prose):
    """Texts that SimHash connects are compared though they meet in no band; below 0.8 they stay apart."""
    long, other, alone = prose(3000), prose(40), prose(200)
    docs = make([(0, long), (1, long + " end"), (2, other), (3, other + " " + prose(40)), (4, alone)])
    found = shingles.hashed(docs, "doc_id", "text")
    rows = shingles.shingled(found, 5).withColumn("bands", F.transform("bands", lambda b: F.xxhash64("node", b)))
    node = {r.doc_id: r.node for r in rows.collect()}
    classes = simhash.text_classes(docs)
    named = {r.doc_id: r["class"] for r in found.join(classes, "x").collect()}
    prints = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs).collect()}
    assert named[0] == named[1] and len(set(named.values())) == len(set(prints.values())) == 4
    links = lambda **how: {frozenset(r) for r in shingles.near_links(found, rows, 5, 0.8, **how).collect()}
    assert links() == set()
    assert links(classes=classes) == {frozenset((node[0], node[1]))}
    same = found.select("x", F.lit(7).cast("long").alias("class"))
    assert links(classes=same) == {frozenset((node[0], node[1]))}


def test_stage_asks_simhash(spark, make, prose, monkeypatch):
    asked, plain = [], simhash.text_classes
    monkeypatch.setattr(simhash, "text_classes", lambda docs: asked.append(1) or plain(docs))
    text = prose(80)
    got = corpus_pipeline.near_duplicates(spark, make([(0, text), (1, text), (2, prose(80)), (3, None), (4, "")]), "")
    assert sorted(r.doc_id for r in got.collect()) == [0, 2, 3] and asked

"""SimHash and suffix-array operators against brute force, with edge cases."""

import random
import re
from collections import defaultdict

import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import simhash, suffixes
from tidemark.llm.components import components


def union(pairs, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def plain_simhash(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@given(st.text(alphabet="aB é\t\n\x1c", max_size=60))
@settings(max_examples=60, deadline=None)
def test_fingerprint_is_the_plain_one(text):
    assert simhash.simhash_of(text) == plain_simhash(text)


def test_fingerprint_of_nothing():
    assert simhash.simhash_of(None) == simhash.simhash_of("") == simhash.simhash_of(" \t") == 0


@pytest.mark.parametrize("radius", [1, 2])
def test_masks_cover_every_difference(radius):
    rng, masks = random.Random(1), simhash.covering_masks(radius)
    for _ in range(3000):
        bits = sum(1 << b for b in rng.sample(range(64), radius))
        assert any(not bits & m for m in masks)


@pytest.mark.parametrize("radius", [1, 2])
@pytest.mark.parametrize("small", [2, 64])
def test_links_connect_just_what_is_near(spark, radius, small):
    rng = random.Random(radius)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 3))) for b in base for _ in range(25)}
    prints = {simhash.signed(p & (1 << 64) - 1) for p in prints}
    near = [(a, b) for a in prints for b in prints if a < b and ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
    got = simhash.near_links(spark.createDataFrame([(p,) for p in prints], "fp long"), radius, small).collect()
    assert union([(r.u, r.v) for r in got], prints) == union(near, prints)


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(1, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    nodes = {n for e in edges for n in e}
    assert got == union(edges, nodes)


def test_components_of_nothing(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_near_duplicates_edges(make, prose):
    text = prose(400)
    rows = [(3, text), (1, text), (5, text.upper()), (5, text.upper()), (9, None), (8, ""), (4, " \n"), (None, text), (None, prose(50)), (20, "one"), (21, prose(60_000))]
    got = simhash.near_duplicates(make(rows)).collect()
    assert len(got) == len(rows)
    where = defaultdict(set)
    for r in got:
        where[r.doc_id].add(r.component_id)
    assert where[3] == where[1] == where[5] == {1} and where[9] == where[8] == where[4] == {4} and where[20] == {20}
    assert where[None] == {1, None}
    kept = simhash.keep_one(make(rows))
    assert kept.columns == make(rows).columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 20, 21] and ids.count(None) == 2


def test_repeated_kept_id_stays_once(make, prose):
    text = prose(80)
    assert [r.doc_id for r in simhash.keep_one(make([(1, text), (1, text), (2, text)])).collect()] == [1]


def test_texts_that_share_an_id_are_told_apart(make, prose):
    a, b, c = prose(80), prose(80), prose(80)
    stay = lambda rows: sorted((r.doc_id, r.text) for r in simhash.keep_one(make(rows)).collect())
    assert stay([(1, b), (1, c)]) == sorted([(1, b), (1, c)])
    assert stay([(0, a), (1, a), (1, b)]) == [(0, a), (1, b)]


def test_no_documents(make):
    assert simhash.near_duplicates(make([])).count() == 0 and simhash.keep_one(make([])).count() == 0


def brute_repeats(rows, n):
    """Removed word places by id: those of passages of n words that stand at an earlier place."""
    seen, out = {}, defaultdict(set)
    for i, text in sorted(rows):
        w = (text or "").encode().lower().split()
        for p in range(len(w) - n + 1):
            key = tuple(w[p : p + n])
            if key in seen:
                out[i].update(range(p, p + n))
            seen.setdefault(key, (i, p))
    return dict(out)


def removed(found):
    out = defaultdict(set)
    for r in found.where("removed").collect():
        out[r.doc_id].update(range(r.first_word, r.first_word + r.n_words))
    return dict(out)


def brute_rows(rows, n):
    """All rows of the result: windows of n words by their first place, merged where they touch."""
    rows = sorted(set(rows))
    places = defaultdict(list)
    for i, text in rows:
        w = (text or "").encode().lower().split()
        for p in range(len(w) - n + 1):
            places[tuple(w[p : p + n])].append((i, p))
    spans = defaultdict(list)
    for at in places.values():
        for place in at if len(at) > 1 else []:
            spans[place[0], place != at[0]].append((place[1], at[0][0]))
    out = set()
    for (i, gone), hits in spans.items():
        run = []
        for start, source in [*sorted(hits), (None, None)]:
            if run and (start is None or start - run[-1][0] > n):
                out.add((i, run[0][0], run[-1][0] + n - run[0][0], gone, min(s for _, s in run)))
                run = []
            run.append((start, source))
    return out


def all_rows(found):
    rows = [(r.doc_id, r.first_word, r.n_words, r.removed, r.source_doc_id) for r in found.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_copies_agree_with_what_earlier_documents_hold(make, prose):
    """Every column, where texts with copies stand inside of earlier ones, in part or as a whole."""
    a, b, w, v, u = prose(40), prose(30), prose(70), prose(60), prose(130)
    rows = [(1, f"{a} {w} {b}"), (5, w), (6, w), (7, v), (7, v), (8, f"{v[:5]} {u}"), (9, f"{u} {w}"), (10, f"{u} {w}"), (11, f"{w} {w}"), (12, f"{w} {w}"), (13, "same " * 120), (14, "same " * 120)]
    assert all_rows(suffixes.repeated_passages(make(rows))) == brute_rows(rows, 50)
    left = {r.doc_id: r.text for r in suffixes.remove_repeats(make(rows)).collect()}
    assert set(left) == {1, 7, 8, 13} and left[13].split() == ["same"]


@pytest.mark.parametrize("seed", [1, 2])
def test_every_column_matches_brute_force(make, prose, seed):
    rng, pool = random.Random(seed), [prose(n) for n in (30, 50, 53, 70, 120)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.5 else prose(rng.randint(1, 60)) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    rows += [(rng.randrange(200), rng.choice(pool)) for _ in range(15)] + [(300 + i, rng.choice(rows)[1]) for i in range(20)]
    rows = list({i: t for i, t in rows}.items())
    rows += rng.sample(rows, 15)  # rows that occur twice
    assert all_rows(suffixes.repeated_passages(make(rows))) == brute_rows(rows, 50)


@pytest.mark.parametrize("parts", [1, 7])
def test_passages_match_brute_force(spark, make, prose, parts):
    rng, pool = random.Random(parts), [prose(n) for n in (30, 50, 53, 70, 120)]
    rows = [(i, " ".join(rng.choice(pool) if rng.random() < 0.5 else prose(rng.randint(1, 60)) for _ in range(rng.randint(1, 6)))) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(5)] + [(200, " ".join(["same"] * 200))]
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        assert removed(suffixes.repeated_passages(make(rows))) == brute_repeats(rows, 50)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_one_passage_in_very_many_places(spark, make, prose):
    """A passage with far more places than a task has rows spreads over tasks and stays exact."""
    hot = prose(60)
    rows = [(i, f"a{i} {hot} b{i}") for i in range(150)]
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffixes.repeated_passages(make(rows))
        assert removed(found) == brute_repeats(rows, 50)
        assert [r.doc_id for r in found.where("not removed").collect()] == [0]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_passages_edges(make, prose):
    a, b = prose(90), prose(70)
    rows = [(2, a), (2, a), (1, b + " " + a), (None, b), (5, None), (6, ""), (7, "short"), (8, b)]
    docs = make(rows)
    found = {(r.doc_id, r.removed, r.first_word, r.n_words, r.source_doc_id) for r in suffixes.repeated_passages(docs).collect()}
    assert (2, True, 0, 90, 1) in found and (1, False, 0, 160, 1) in found and not any(r[0] in (5, 6, 7) for r in found)
    left = suffixes.remove_repeats(docs)
    assert left.columns == docs.columns
    got = sorted(((r.doc_id is None, r.doc_id, r.text) for r in left.collect()), key=str)
    assert got == sorted([(False, 1, b + " " + a), (False, 5, None), (False, 6, ""), (False, 7, "short")], key=str)
    assert suffixes.repeated_passages(make([])).count() == 0 and suffixes.remove_repeats(make([])).count() == 0


def test_rows_equal_in_id_and_text_have_one_suffix_each(make, prose, monkeypatch):
    """A hot text without ids gathers its anchors once, not once a copy."""
    hot, seen = prose(90), []
    rows = [(None, hot)] * 40 + [(3, hot), (3, hot), (4, "x " + hot + " y")]
    plain = suffixes.suffixes
    monkeypatch.setattr(suffixes, "suffixes", lambda docs, *how: seen.append(docs) or plain(docs, *how))
    found = suffixes.repeated_passages(make(rows))
    assert removed(found) == brute_repeats([(3, hot), (4, "x " + hot + " y")], 50) | {None: set(range(90))}
    assert seen[0].count() == 3


def test_lists_of_places_are_as_long_as_there_are_runs(make, prose, monkeypatch):
    """Thousands of places side by side reach Python as one run, not one entry a place."""
    a, b, seen = prose(1500), prose(1200), []
    rows = [(1, f"{a} x {b}"), (2, f"{b} y {a}"), (3, a), (4, a), (5, f"{a} z {a}")]
    plain = suffixes.staged
    monkeypatch.setattr(suffixes, "staged", lambda df: seen.append(plain(df)) or seen[-1])
    assert all_rows(suffixes.repeated_passages(make(rows))) == brute_rows(rows, 50)
    lists = [(df, c) for df in seen for c, kind in df.dtypes if kind.startswith("array<struct")]
    assert lists and all(df.selectExpr(f"max(size(`{c}`))").first()[0] <= 2 for df, c in lists)


def test_cut_keeps_the_rest():
    text = "one  two\nthree four\tfive "
    assert suffixes.cut_words(text, [{"first_word": 1, "n_words": 2}]) == "one  four\tfive "
    assert suffixes.cut_words(text, [{"first_word": 0, "n_words": 5}]) == ""
    assert suffixes.cut_words(text, [{"first_word": 3, "n_words": 2}, {"first_word": 0, "n_words": 1}]) == "two\nthree "

"""Operators on whole tables: mixing, chat formatting, embeddings, and the pipeline."""

import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from tidemark.checks.compare import canonical, connect
from tidemark.llm import chat, mixing, vectors
from tidemark.llm.queries import ORACLES

SF = "/root/testdata/sf0.001"


def plain_targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest, open_w = total - sum(most * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        over = {s for s in names if s not in full and rest * w[s] / open_w > most * sizes[s] + 1e-9}
        if not over:
            return {s: most * sizes[s] if s in full else rest * w[s] / open_w for s in names}
        full |= over


def mixed(make, rows):
    return mixing.mix(make(rows)).collect()


def test_mix_meets_targets(make, prose):
    rng = random.Random(1)
    rows = [(i, prose(rng.randint(1, 120)), "en", rng.choice(["a", "b", "b", "b", "B", "é", None])) for i in range(900)] + [(5000, "tiny", "en", "z")]
    got = mixed(make, rows)
    size, want = defaultdict(int), defaultdict(int)
    for r in rows:
        size[r[3]] += len(r[1].split())
    target = plain_targets(size)
    assert sorted(r.doc_id for r in got) == sorted(r[0] for r in rows)
    for r in got:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        assert r.copies in (int(target[r.source] // size[r.source]), int(target[r.source] // size[r.source]) + 1)
        want[r.source] += r.taken
    for s in size:
        assert abs(want[s] - target[s]) <= max(8, 0.02 * target[s])
    again = {(r.doc_id, r.copies) for r in mixing.mix(make(rows, parts=7)).collect()}
    assert again == {(r.doc_id, r.copies) for r in got}


def test_equal_rows_are_documents_each(make):
    """A hot row without an id, equal to very many others, is dealt row by row."""
    rows = [(None, "w " * 10, "en", "a")] * 4000 + [(k, "v " * 25, "en", "b") for k in range(40)] + [(7, "u", "en", None)] * 3
    got = mixed(make, rows)
    size = {"a": 40_000, "b": 1000, None: 3}
    target = plain_targets(size)
    assert len(got) == len(rows)
    for s in size:
        mine = [r for r in got if r.source == s]
        assert len(mine) == sum(r[3] == s for r in rows) and all(r.target == pytest.approx(target[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - target[s]) <= max(r.size for r in mine)
        assert len({r.copies for r in mine}) <= 2 and all(r.taken == r.size * r.copies <= 3 * r.size for r in mine)
    kept = mixing.mixed_documents(make(rows))
    by = {(r.source, r.copies): r.n for r in kept.groupBy("source", "copies").agg(F.count("*").alias("n")).collect()}
    want = defaultdict(int)
    for r in got:
        if r.copies:
            want[r.source, r.copies] += 1
    assert by == dict(want) and set(make(rows).columns) <= set(kept.columns)


def test_the_example_of_repeated_rows(make):
    rows = [(None, "w " * 10, "en", "a")] * 400 + [(k, "x " * 10, "en", "b") for k in range(400)]
    got = mixed(make, rows)
    for s, want in plain_targets({"a": 4000, "b": 4000}).items():
        assert abs(sum(r.taken for r in got if r.source == s) - want) <= 10


def test_each_document_is_drawn_by_its_share(make):
    rows = [(i, "w " * 10, "en", s) for i, s in enumerate(["a"] * 60 + ["b"] * 20)]
    f = 20 / 60  # weights 1 and 2: source a gets 800 / 3 of its 600 words
    counts = [sum(r.copies for r in mixing.mix(make(rows), seed=k).where("source = 'a'").collect()) for k in range(3)]
    assert all(abs(c - 60 * (800 / 3 / 600)) <= 1 for c in counts) and f < 1


def test_mix_edges(make):
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (None, "x y", "en", "a"), (3, "same row", "en", None), (3, "same row", "en", None), (4, "z " * 50_000, "en", "b"), (5, " ", "en", "empty")]
    got = mixed(make, rows)
    assert len(got) == len(rows) and all(r.taken <= 3 * r.size for r in got) and {r.size for r in got if r.doc_id in (1, 2, 5)} == {0}
    assert len({r.copies for r in got if r.doc_id == 3}) == 1 and mixed(make, []) == []
    docs = make(rows)
    out = mixing.mixed_documents(docs)
    assert set(docs.columns) <= set(out.columns) and out.where("copies = 0").count() == 0
    assert mixing.mixed_documents(make([])).count() == 0


def test_mix_runs_no_python(make, prose):
    plan = mixing.mix(make([(i, prose(9)) for i in range(20)]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


# -- chat ----------------------------------------------------------------------------------------


def test_escape_is_reversible(spark):
    from pyspark.sql import functions as F

    rng = random.Random(6)
    texts = ["".join(rng.choice("<|\\im_end>\n %é") for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").withColumn("e", chat.escape(F.col("t"))).select("t", "e", chat.unescape(F.col("e")).alias("u"))
    assert all("<|" not in r.e and r.u == r.t for r in rows.collect())


def test_conversations_round_trip(spark):
    nasty = "<|im_end|>\n<|im_start|>assistant\nok <\\| <\\\\| <|"
    rows = [
        (1, 2, "user", nasty), (1, 1, "system", "s"), (1, 3, "assistant", nasty), (2, 1, "assistant", "first"), (3, 1, "us%er<|\nx", None),
        (4, 1, "user", "a"), (4, 1, "user", "a"), (4, None, None, "early"), (None, 1, "user", "q"), (None, 2, "assistant", "r" * 100_000), (5, 1, "user", "u"), (5, 2, "assistant", ""),
    ]
    data = spark.createDataFrame([(*r, "extra", 1) for r in rows], "conv_id long, turn long, role string, text string, segments string, valid int")
    done = chat.format_conversations(data)
    got = {r.conv_id: r for r in done.select("*", chat.read_turns(done.formatted).alias("turns"), chat.loss_text(done.segments).alias("loss")).collect()}
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    for c, turns in by.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        assert [(t.role, t.text) for t in got[c].turns] == [(t[2] or "", t[3] or "") for t in turns]
        assert got[c].loss == "".join(t[3] or "" for t in turns if t[2] == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
    assert {c for c in got if got[c].valid} == {1, None, 5}
    assert chat.format_conversations(data.limit(0)).count() == 0


def test_chat_matches_sql(spark):
    mine = canonical(driver.queries()["op4_chat"](spark, SF).toPandas())
    theirs = canonical(connect(SF).execute(ORACLES["op4_chat"]).df())
    assert list(mine.columns) == list(theirs.columns) and mine.equals(theirs)


# -- embeddings ----------------------------------------------------------------------------------


def plain_links(units, least=0.9):
    near = units @ units.T >= least
    np.fill_diagonal(near, False)
    label = np.arange(len(units))
    while True:
        new = np.array([min([label[i], *label[near[i]]]) for i in range(len(units))])
        if (new == label).all():
            return near.sum(1), label
        label = new


def test_links_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(vectors, "LEAF", 32)
    monkeypatch.setattr(vectors, "BLOCK", 40)
    rng = np.random.default_rng(0)
    base = rng.normal(size=(250, 24))
    rows = np.concatenate((base, base[:60] + 0.2 * rng.normal(size=(60, 24)), base[7] + 0.1 * rng.normal(size=(120, 24)), base[:30], 2.5 * base[30:40]))
    data = spark.createDataFrame([(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<float>")
    units = rows.astype(np.float32).astype(float)
    units /= np.linalg.norm(units, axis=1, keepdims=True)
    n, label = plain_links(units)
    got = {r.vec_id: r for r in vectors.near_duplicates(data).collect()}
    found = sum(r.n_links for r in got.values())
    assert found <= n.sum() and found >= 0.99 * n.sum()
    assert sum(got[i].component_id == label[i] for i in got) >= 0.99 * len(rows) and len(got) == len(rows)
    assert all(got[i].kept == (got[i].component_id == i) for i in got)


def test_leaves_stay_small_beyond_the_sample(spark, monkeypatch):
    """Eleven levels of splits, of which the sample of all vectors can fit five."""
    monkeypatch.setattr(vectors, "LEAF", 4)
    monkeypatch.setattr(vectors, "FITTED", 4)
    rng = np.random.default_rng(1)
    base = rng.normal(size=(4_000, 16))
    # Close pairs, and one tight cluster that no split can part.
    rows = np.concatenate((base, base[:3_000] + 0.1 * rng.normal(size=(3_000, 16)), base[9] + 0.001 * rng.normal(size=(300, 16))))
    data = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    sizes, grown = [], vectors.deepened

    def watched(placed, *rest):
        out = grown(placed, *rest)
        for df in (placed, out):
            each = df.select("node", F.explode("leaves").alias("leaf"))
            sizes.append([r[0] for r in each.groupBy("leaf").agg(F.count("*")).select("count(1)").collect()])
        return out

    monkeypatch.setattr(vectors, "deepened", watched)
    n, label = plain_links(rows / np.linalg.norm(rows, axis=1, keepdims=True))
    got = {r.vec_id: r for r in vectors.near_duplicates(data, sample=150).collect()}
    assert len(got) == len(rows)
    assert 0.95 * n.sum() <= sum(r.n_links for r in got.values()) <= n.sum() and all(got[i].n_links <= n[i] for i in got)
    assert np.mean([got[i].component_id == label[i] for i in got]) > 0.95
    before, after = sizes
    assert np.median(before) > 100 and np.median(after) <= 16
    assert sum(after) < 4 * sum(before)  # spilling does not multiply the cluster
    assert sum(x * x for x in after) < sum(x * x for x in before) / 2


def test_pairs_count_once_in_the_first_shared_leaf():
    import pandas as pd

    frame = pd.DataFrame({"node": [1, 2, 3], "times": [1, 2, 1], "leaves": [[0, 5], [0, 5], [5]], "unit": [np.array([1.0, 0])] * 3})
    assert vectors.compare_block(frame, None, 0, 0.9)[0][0].sum() >= 0
    total = sum(vectors.compare_block(frame, None, 5, 0.9)[0])
    assert total.tolist() == [1, 1, 3]  # the pair (1, 2) belongs to leaf 0


def test_leaves_dealt_in_rounds_give_the_same_links(spark, monkeypatch):
    """The last levels and the comparisons in many rounds; no vector moves without its round."""
    monkeypatch.setattr(vectors, "LEAF", 16)
    monkeypatch.setattr(vectors, "BLOCK", 30)
    rng = np.random.default_rng(4)
    base = rng.normal(size=(600, 16))
    rows = np.concatenate((base, base[:200] + 0.05 * rng.normal(size=(200, 16)), base[3] + 0.05 * rng.normal(size=(90, 16))))
    data = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(rows)], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, vectors.near_duplicates(data, trees=3, sample=100).collect()))
    monkeypatch.setattr(vectors, "ROUND", 2_000)
    dealt, plain = [], vectors.rounds
    monkeypatch.setattr(vectors, "rounds", lambda leaves: (dealt.append(part.agg(F.sum("n")).first()[0] or 0) or part for part in plain(leaves)))
    got = vectors.near_duplicates(data, trees=3, sample=100)
    assert sorted(map(tuple, got.collect())) == want
    assert len(dealt) > 3 and max(dealt) < 2 * 2_000


def test_pairs_share_only_leaves_of_a_smaller_number():
    leaves = [[1, 4, 9], [2, 4, 9], [3, 9]]
    assert vectors.sharing(leaves, leaves, 9).tolist() == [[True, True, False], [True, True, False], [False, False, True]]
    assert not vectors.sharing(leaves[:2], leaves[1:], 4).any(1)[0]
    assert not vectors.sharing([[]], [[1]], 9).any()


def test_vector_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [1.0, 0.0]), (3, None), (4, []), (5, [0.0, 0.0]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [None, 1.0]), (9, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (10, [-1.0, 0.0])]
    data = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<float>, v string")
    got = sorted((str(r.vec_id), r.n_links, r.component_id) for r in vectors.near_duplicates(data).collect())
    want = [("1", 3, 1), ("10", 0, 10), ("2", 3, 1), ("2", 3, 1), ("None", 3, 1)] + [(str(i), 0, i) for i in (3, 4, 5, 6, 7, 8, 9)]
    assert got == sorted(want) and vectors.near_duplicates(data.limit(0)).count() == 0


# -- queries and pipeline ------------------------------------------------------------------------


def test_every_operator_is_registered():
    names = driver.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names


def test_documents_stay_if_no_language_is_learnt(spark, make):
    docs = make([(1, "some words", None), (2, None, None), (3, "12 ...", None), (None, "more", None)])
    got = corpus_pipeline.language(spark, docs, SF)
    assert got.columns == docs.columns and {(r.doc_id, r.text, r.lang) for r in got.collect()} == {(1, "some words", None), (None, "more", None)}


def test_pipeline_takes_effect(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sizes = [docs.count()]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "mix":
            assert out.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs = corpus_pipeline.suffixes.staged(out)
        sizes.append(docs.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[-1] > 0
    result = corpus_pipeline.run(spark, SF)
    assert {(r.doc_id, r.copies) for r in result.collect()} == {(r.doc_id, r.copies) for r in docs.collect()}

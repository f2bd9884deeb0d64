"""Operators that read one text at a time: licences, benchmark passages, languages, quality, scores."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, licenses, ngrams, quality
from tidemark.llm.common import held_out

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ODD = [(1, None), (2, ""), (3, " \n\t"), (None, "words of a row without id"), (4, "!!! ... 12 34"), (5, "tie"), (5, "tie"), (6, "é" * 3), (7, "long " * 60_000)]


def low(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


# -- licences ------------------------------------------------------------------------------------


def plain_scan(text):
    w, starts, labels = WORD.findall(low(text or "")), [], set()
    for phrase, label in licenses.BASE_PHRASES.items():
        k = phrase.split()
        at = [i for i in range(len(w)) if w[i : i + len(k)] == k]
        starts += at
        labels |= {label} if at else set()
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


@given(st.lists(st.sampled_from(["cc", "by", "CC-BY", "general", "Public License", "all rights", "reserved.", "é", "x", "\n", "_"]), max_size=30))
@settings(max_examples=80, deadline=None)
def test_base_phrases_match_brute_force(parts):
    machine = licenses.automaton({p: (l, True) for p, l in licenses.BASE_PHRASES.items()})
    got = licenses.scan_text(" ".join(parts), machine)
    assert (got["n_words"], got["n_base"], got["first_word"], got["last_word"], got["base_labels"]) == plain_scan(" ".join(parts))


@pytest.mark.parametrize("text, postfix", [
    ("mit or apache-2.0", "mit apache-2.0 or"), ("(mit or gpl-2.0) and bsd", "mit gpl-2.0 or bsd and"),
    ("gpl-2.0+ with classpath-exception and mit", "gpl-2.0+ classpath-exception with mit and"), ("mit and", "mit"),
    ("(mit", ""), ("and mit", ""), ("", ""), ("mit or apache-2.0 and bsd", "mit apache-2.0 bsd and or"), ("mit is fine", "mit"),
])
def test_expressions(text, postfix):
    assert " ".join(licenses.parse_expression(text)[0]) == postfix


def test_evaluation_takes_the_freest_choice_of_the_strictest_parts():
    value = lambda s: licenses.evaluate(licenses.parse_expression(s)[0])[0]
    assert value("mit or gpl-3.0") == 0.9 and value("mit and gpl-3.0") == 0.3
    assert value("gpl-3.0 with x") == pytest.approx(0.4) and value("nobody-knows") == licenses.UNLISTED


def test_scan_of_a_table(make):
    rows = [*ODD, (8, "A\n// SPDX-License-Identifier: MIT OR Apache-2.0\nAll rights reserved. cc-by cc by")]
    got = {r.doc_id: r for r in licenses.scan_documents(make(rows)).collect()}
    assert len(licenses.scan_documents(make(rows)).collect()) == len(rows)
    one = got[8]
    assert one.base_labels == "cc-by,reserved" and one.labels == "apache-2.0,cc-by,mit,reserved" and one.n_base == 3
    assert one.expressions == ["mit apache-2.0 or"] and one.score == 0.0
    assert got[1].n_words == 0 and got[1].first_word is None and got[1].score == 1.0 and got[7].n_words == 60_000
    assert licenses.scan_documents(make([])).count() == 0


# -- benchmark passages --------------------------------------------------------------------------


def plain_align(a, w):
    above, best = [0] * (len(w) + 1), 0
    for x in a:
        now = [0] * (len(w) + 1)
        for j, y in enumerate(w, 1):
            now[j] = max(0, above[j - 1] + (1 if x == y else -1), above[j] - 2, now[j - 1] - 2)
        above, best = now, max(best, *now)
    return best


def edited(rng, words, share):
    out = []
    for w in words:
        r = rng.random()
        out += [] if r < share / 3 else [f"new{rng.randrange(99)}"] if r < 2 * share / 3 else [w, "more"] if r < share else [w]
    return out


def test_edited_passages_match_full_alignment(spark, make, prose):
    rng = random.Random(4)
    items = [(i, prose(rng.choice([5, 9, 16, 30, 55]))) for i in range(15)]
    texts = [prose(40) + " " + " ".join(edited(rng, rng.choice(items)[1].split(), rng.choice([0, 0.1, 0.25, 0.4]))) + " " + prose(30) for _ in range(80)]
    docs, bench = make(list(enumerate(texts))), spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(docs, bench).collect()}
    want = {}
    for d, text in enumerate(texts):
        w = WORD.findall(low(text))
        for i, item in items:
            a = WORD.findall(low(item))
            s = plain_align(a, w) / len(a)
            if s >= decontaminate.needed(len(a), 0.6):
                want[d, i] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
    whole = {tuple(r) for r in decontaminate.contaminated(docs, bench).collect()}
    for block_words in (60, 150):  # several blocks, the last one with what is left
        assert len(list(decontaminate.blocks(bench, "item_id", "text", block_words))) >= 2
        assert {tuple(r) for r in decontaminate.contaminated(docs, bench, block_words=block_words).collect()} == whole
        left = decontaminate.drop_contaminated(docs, bench, block_words=block_words)
        assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {i for i, _ in rows_of(texts)} - {d for d, _ in want}
        lists = decontaminate.with_matches(docs, bench, block_words=block_words)
        assert {(r.doc_id, m.item_id) for r in lists.collect() for m in r.matches} == want.keys()


def rows_of(texts):
    return list(enumerate(texts))


def test_items_without_an_id_are_found_under_none(spark, make, prose):
    a, b, c = prose(30), prose(40), prose(50)
    for kind in ("long", "string"):
        key = (lambda k: k) if kind == "long" else (lambda k: k and str(k))
        bench = spark.createDataFrame([(None, a), (key(2), b), (None, c)], f"item_id {kind}, text string")
        docs = make([(1, "x " + a), (2, b), (3, c + " " + a), (4, prose(60)), (None, a)])
        for block_words in (35, 4_000_000):
            got = {(r.doc_id, r.item_id): (r.score, r.places) for r in decontaminate.contaminated(docs, bench, block_words=block_words).collect()}
            assert got == {(1, None): (1.0, 1), (2, key(2)): (1.0, 1), (3, None): (1.0, 2), (None, None): (1.0, 1)}
            assert [r.doc_id for r in decontaminate.drop_contaminated(docs, bench, block_words=block_words).collect()] == [4]


def test_seeds_dropped_are_never_needed():
    for words in range(8, 200):
        edits = int(0.2 * words)
        assert decontaminate.spare_seeds(words, 0.6) < max(1, words - 2 - 3 * edits)


def test_decontamination_edges(spark, make, prose):
    item = prose(30)
    bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "tie"), (1, item)], "item_id long, text string")
    rows = [*ODD, (20, prose(9) + " " + item.upper().replace(" ", ", ") + "."), (None, item)]
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.contaminated(make(rows), bench).collect()}
    assert got == {(20, 1): 1.0, (None, 1): 1.0, (5, 4): 1.0}
    kept = decontaminate.drop_contaminated(make(rows), bench)
    assert kept.columns == make(rows).columns and kept.count() == len(rows) - 4
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.drop_contaminated(make(rows), none).count() == len(rows) and decontaminate.contaminated(make([]), bench).count() == 0


# -- languages -----------------------------------------------------------------------------------

PIECES = ["▁", "a", "b", "c", "ab", "bc", "▁a", "▁ab", "abc", "é"]


def all_segmentations(word, p, k):
    if not word:
        return 1.0
    own = {x: p[i, k] for i, x in enumerate(PIECES)}
    total = 0.0
    for n in range(1, len(word) + 1):
        if word[:n] in own:
            total += own[word[:n]] * all_segmentations(word[n:], p, k)
        elif n == 1:
            total += langid.UNKNOWN * all_segmentations(word[1:], p, k)
    return total


@given(st.lists(st.text(alphabet="abcéx", min_size=1, max_size=9), min_size=1, max_size=12))
@settings(max_examples=60, deadline=None)
def test_forward_sums_all_segmentations(words):
    p = np.random.default_rng(0).dirichlet(np.ones(len(PIECES)), 2).T
    got = langid.log_probabilities(langid.PieceIndex(PIECES), p, words)
    want = [[math.log(all_segmentations("▁" + w, p, k)) for k in (0, 1)] for w in words]
    assert np.allclose(got, want)


def test_long_words_do_not_underflow():
    p = np.full((len(PIECES), 1), 1e-3)
    got = langid.log_probabilities(langid.PieceIndex(PIECES), p, ["x" * 3000, "a"])
    assert got[0, 0] == pytest.approx(math.log(1e-3) + 3000 * math.log(langid.UNKNOWN))


def test_expectation_raises_likelihood_and_counts_every_character():
    index, words = langid.PieceIndex(PIECES), ["abc", "ab", "bca", "a"]
    p = np.full((len(PIECES), 1), 0.1)
    n = np.array([3.0, 1, 2, 5])
    tag = np.zeros(4, int)
    before = n @ langid.log_probabilities(index, p, words)[:, 0]
    c = langid.expected_counts(index, p, words, tag, n)
    assert sum(c[i, 0] * len(x) for i, x in enumerate(PIECES)) == pytest.approx(sum(w * (len(x) + 1) for w, x in zip(n, words)))
    assert n @ langid.log_probabilities(index, c / c.sum(), words)[:, 0] > before


def test_long_words_are_counted_like_short_ones(monkeypatch):
    index, rng = langid.PieceIndex(PIECES), random.Random(2)
    words = ["".join(rng.choice("abcx") for _ in range(rng.randint(1, 38))) for _ in range(40)]
    p = np.random.default_rng(0).dirichlet(np.ones(len(PIECES)), 2).T
    tag, n = np.arange(40) % 2, np.arange(1.0, 41)
    want = langid.expected_counts(index, p, words, tag, n)
    monkeypatch.setattr(langid, "LONG_WORD_CHARS", 0)
    assert np.allclose(langid.expected_counts(index, p, words, tag, n), want)
    c = langid.expected_counts(index, p, ["abc" * 2000], np.zeros(1, int), np.ones(1))
    assert sum(c[i, 0] * len(x) for i, x in enumerate(PIECES)) == pytest.approx(6001)


@pytest.mark.parametrize("length", [60, 40_000])
def test_languages_without_spaces_are_told(make, length):
    rng, rows = random.Random(4), []
    for i in range(40):
        tag, parts = ("u", ["ab", "ab", "ca", "bc"]) if i % 2 else ("v", ["bc", "bc", "ca", "ab"])
        rows.append((i, "".join(rng.choice(parts) for _ in range(length // 2)), tag))
    model = langid.fit(make(rows), pieces=["▁", "a", "b", "c", "ab", "bc", "ca"])
    told = langid.identify(make(rows), model)
    assert told.where("lang_pred <> lang").count() <= 2


def test_held_out_languages_are_told(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").withColumn("h", held_out("doc_id", 5))
    model = langid.fit(docs.where("not h"))
    told = langid.identify(docs.where("h"), model)
    assert told.where("lang_pred <> lang").count() <= 0.02 * told.count()


def test_language_edges(make, spark):
    docs = make([*ODD, (8, "words", None)])
    model = langid.fit(docs, pieces=["▁", "o", "n", "g", "▁l", "e"])
    got = langid.identify(docs.select("doc_id", "text"), model).collect()
    und = {r.doc_id for r in got if r.lang_pred == "und"}
    assert len(got) == len(ODD) + 1 and und == {1, 2, 3, 4} and all(0 <= r.score <= 1 for r in got)
    empty = langid.fit(make([]), pieces=["a"])
    assert {r.lang_pred for r in langid.identify(docs, empty).collect()} == {"und"} and langid.identify(make([]), empty).count() == 0


# -- quality -------------------------------------------------------------------------------------


def plain_forward(model, bags):
    """Gated attention written out, passage by passage."""
    w, out = model.weights, []
    for bag in bags:
        hidden, energy = [], []
        for passage in bag:
            x = [min(8.0, max(-8.0, (v - m) / s)) for v, m, s in zip(passage, model.mean, model.scale)]
            h = [math.tanh(sum(x[i] * w["enc"][i, j] for i in range(len(x))) + w["enc0"][j]) for j in range(quality.HIDDEN)]
            gate = 0.0
            for k in range(quality.GATES):
                v = math.tanh(sum(h[j] * w["v"][j, k] for j in range(quality.HIDDEN)))
                u = 1 / (1 + math.exp(-sum(h[j] * w["u"][j, k] for j in range(quality.HIDDEN))))
                gate += w["a"][k] * v * u
            hidden.append(h)
            energy.append(gate)
        total = sum(math.exp(e) for e in energy)
        z = [sum(math.exp(e) / total * h[j] for e, h in zip(energy, hidden)) for j in range(quality.HIDDEN)]
        out.append(1 / (1 + math.exp(-sum(z[j] * w["out"][j] for j in range(quality.HIDDEN)) - w["out0"])))
    return out


def some_bags(seed=1, docs=6, width=5):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 6, docs)
    return rng.normal(size=(sizes.sum(), width)) * 3, np.repeat(np.arange(docs), sizes), rng.integers(0, 2, docs).astype(float)


def test_forward_matches_plain_loops():
    x, row, y = some_bags()
    model = quality.train(x, row, y, epochs=5)
    want = plain_forward(model, [x[row == d] for d in range(len(y))])
    assert np.allclose(model.forward(x, row, len(y)), want, atol=1e-12)
    bare = model.forward(x[:0], row[:0], 1)  # no passage: the bias alone
    assert np.isclose(bare[0], 1 / (1 + math.exp(-model.weights["out0"])))


def test_steps_match_those_by_differences():
    """Three steps of Adam, each gradient taken by differences of the loss, weight by weight."""
    x, row, y = some_bags()
    model, trained = quality.train(x, row, y, epochs=0), quality.train(x, row, y, epochs=3)
    model.weights["out"] = np.array(model.weights["out"], float)

    def loss():
        p = model.forward(x, row, len(y))
        cost = -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
        return cost + 1e-3 / 2 * sum((v * v).sum() for k, v in model.weights.items() if not k.endswith("0"))

    m = {k: np.zeros_like(v) for k, v in model.weights.items()}
    s = {k: np.zeros_like(v) for k, v in model.weights.items()}
    for step in (1, 2, 3):
        grad = {}
        for k, v in model.weights.items():
            grad[k] = np.zeros_like(v)
            for at in np.ndindex(v.shape):
                ends = []
                for move in (1e-5, -1e-5):
                    kept = v[at]
                    v[at] = kept + move
                    ends.append(loss())
                    v[at] = kept
                grad[k][at] = (ends[0] - ends[1]) / 2e-5
        for k, d in grad.items():
            m[k], s[k] = 0.9 * m[k] + 0.1 * d, 0.999 * s[k] + 0.001 * d * d
            model.weights[k] = np.asarray(model.weights[k] - 0.01 * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8))
    for k, v in trained.weights.items():
        # Where a gradient is next to nothing, so is what differences can tell of its sign.
        clear = np.abs(grad[k]) > 1e-6
        assert np.allclose(np.asarray(v)[clear], model.weights[k][clear], atol=2e-4), k
    assert all((np.abs(g) > 1e-6).mean() > 0.9 for k, g in grad.items())


def test_training_lowers_the_loss():
    x, row, y = some_bags()
    before, after = (quality.train(x, row, y, epochs=n).forward(x, row, len(y)) for n in (0, 80))
    cost = lambda p: -(y * np.log(p) + (1 - y) * np.log(1 - p)).mean()
    assert cost(after) < 0.5 * cost(before)


def plain_passages(text):
    """Shape features of a text's passages, word by word."""
    words, out = re.findall(r"[^\x20\x09-\x0D]+", text), []
    for at in range(0, len(words), quality.PASSAGE):
        part = [w.encode() for w in words[at : at + quality.PASSAGE]]
        chars, n = sum(map(len, part)), len(part)
        count = lambda members: [sum(c in members for c in w) for w in part]
        lower, upper, digit, symbol = (count(m) for m in (quality.LOWER, quality.LOWER.upper(), b"0123456789", quality.SYMBOLS))
        point, cry = count(b"?.,;:!"), count(b"!")
        other = [len(w) - a - b - c - d - e for w, a, b, c, d, e in zip(part, lower, upper, digit, symbol, point)]
        shares = [sum(v) / chars for v in (lower, upper, digit, symbol, point, other, cry)]
        flags = [[u > lo for u, lo in zip(upper, lower)], [len(w) == 1 for w in part], [len(w) > 16 for w in part],
                 [k == len(w) for k, w in zip(symbol, part)], [2 * d > len(w) for d, w in zip(digit, part)]]
        extra = [len(set(part)) / n, sum(a == b for a, b in zip(part, part[1:])) / n, math.log(n)]
        out.append([sum(math.log1p(len(w)) for w in part) / n, *shares, *[sum(f) / n for f in flags], chars / n, *extra])
    return out


def test_passages_match_plain_loops():
    texts = ["", "One TWO 3 #$% a!b, é x x x supercalifragilistic 12a 1a", " ".join(f"w{i % 7} Q!" for i in range(100)), "   ", "?"]
    x, row = quality.encode(pa.array(texts))
    shape = np.delete(x, np.s_[quality.SHAPES : quality.SHAPES + quality.HASHED], axis=1)
    want = [plain_passages(t) for t in texts]
    assert row.tolist() == [i for i, rows in enumerate(want) for _ in rows]
    assert np.allclose(shape, np.array([p for rows in want for p in rows]), atol=1e-5)
    signs = x[:, quality.SHAPES : quality.SHAPES + quality.HASHED]
    assert np.allclose(np.abs(signs[-1]), 1) and np.abs(signs).max() <= math.sqrt(quality.PASSAGE)


def test_held_out_quality_is_told(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").withColumn("h", held_out("doc_id", 5))
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.fit(docs, labels.where(~held_out("doc_id", 5)))
    rows = docs.where("h").join(labels, "doc_id").select("quality", quality.score(F.col("text"), model).alias("s")).collect()
    assert np.mean([(r.s >= 0.3) == r.quality for r in rows]) > 0.95


def test_quality_edges(spark, make):
    labels = spark.createDataFrame([(5, 1), (5, 0), (6, 0), (7, 1), (99, 1), (4, None), (None, 1)], "doc_id long, quality int")
    model = quality.fit(make(ODD), labels)
    scores = [r.s for r in make(ODD).select(quality.score(F.col("text"), model).alias("s")).collect()]
    assert len(scores) == len(ODD) and all(0 < s < 1 for s in scores)
    none = quality.fit(make([]), labels.limit(0))
    assert make([]).select(quality.score(F.col("text"), none)).count() == 0
    assert len({r.s for r in make(ODD).select(quality.score(F.col("text"), none).alias("s")).collect()}) == 1


# -- language-model scores -----------------------------------------------------------------------


def plain_counts(rows, held):
    one, two, three, docs = Counter(), Counter(), Counter(), 0
    tokens = [((t or "").encode().lower().split() + [b"\n"], h) for (_, t), h in zip(rows, held)]
    for w, h in tokens:
        docs += not h
        for k, x in enumerate(w if not h else []):
            b, a = w[k - 1] if k else 0, w[k - 2] if k > 1 else 0
            one[x] += 1
            two[b, x] += 1
            three[a, b, x] += 1
    return tokens, one, two, three, docs


def plain_scores(counts, prior_2, prior_3):
    """Per document the contract's figures and the score; and what training tokens score without themselves."""
    tokens, one, two, three, docs = counts
    n, v, out, fit = sum(one.values()), len(one), [], 0.0
    for w, held in tokens:
        base = full = 0.0
        for k, x in enumerate(w):
            b, a = w[k - 1] if k else 0, w[k - 2] if k > 1 else 0
            for own in (0, 1) if not held else (0,):
                p1 = (one[x] - own + 0.1) / (n - own + 0.1 * (v + 1))
                p2 = (two[b, x] - own + prior_2 * p1) / ((one[b] if k else docs) - own + prior_2)
                p3 = (three[a, b, x] - own + prior_3 * p2) / ((two[a, b] if k else docs) - own + prior_3)
                if own:
                    fit += math.log10(p3)
                else:
                    base, full = base + math.log10(p1), full + math.log10(p3)
        out.append((len(w), sum(one[x] > 0 for x in w), n, base, full))
    return out, fit


def scored_rows(prose, twice):
    rng = random.Random(2)
    pool = [prose(12) for _ in range(20 if twice else 400)]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))) for i in range(120)]
    return rows + [(500, None), (501, "The the THE")]


@pytest.mark.parametrize("twice", [True, False])
def test_scores_and_priors_match_brute_force(make, prose, twice):
    """Among all pairs the weights are those with the likeliest training tokens, each without itself."""
    rows = scored_rows(prose, twice)
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows]
    counts = plain_counts(rows, held)
    best = max(ngrams.PRIORS, key=lambda pair: plain_scores(counts, *pair)[1])
    want = {i: w for (i, _), w in zip(rows, plain_scores(counts, *best)[0])}
    got = ngrams.score_documents(make(rows), held_out("doc_id", 10), block_bytes=4000, shard_bytes=3000).collect()
    assert len(got) == len(rows) and {(r.prior_2, r.prior_3) for r in got} == {best}
    for r in got:
        n, known, total, base, full = want[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(full, rel=0.03)


def test_score_columns_stand_in_their_order(make):
    names = ngrams.score_documents(make([(1, "a b")]), held_out("doc_id", 10)).columns
    assert names[:7] == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


def test_shards_are_dealt_evenly(make, prose):
    """Every task answers at most ``TASK_SHARDS`` shards, and no exchange comes after the deal."""
    blocks = ngrams.make_blocks(make([(i, prose(40)) for i in range(50)]).withColumn("held_out", F.lit(False)), 2000)
    asked = ngrams.key_rows(blocks, 30).withColumn("task", F.expr(f"shard div {ngrams.TASK_SHARDS}").cast("int")).repartitionById(8, "task")
    plan = asked.groupBy("task", "kind", "shard").applyInArrow(ngrams.answer, ngrams.LAYOUT)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2  # the deal, and the fixture's own
    seen = asked.select(F.spark_partition_id().alias("at"), "shard").distinct().groupBy("at").count().collect()
    assert len(seen) == 8 and max(r["count"] for r in seen) <= ngrams.TASK_SHARDS


def test_score_edges(make):
    got = ngrams.score_documents(make(ODD), held_out("doc_id", 10)).collect()
    assert len(got) == len(ODD) and {r.n_tokens for r in got if r.doc_id in (1, 2, 3)} == {1} and all(r.score < 0 for r in got)
    assert ngrams.score_documents(make([]), held_out("doc_id", 10)).count() == 0
    alone = ngrams.score_documents(make([(1, "a b")]), F.lit(True)).first()
    assert alone.train_tokens == 0 and alone.n_known == 0 and alone.base_score == pytest.approx(0)


@given(st.lists(st.integers(0, 2**48 - 1), max_size=300, unique=True), st.lists(st.integers(0, 2**48 - 1), max_size=20))
@settings(max_examples=40, deadline=None)
def test_elias_fano_finds_just_its_members(tmp_path_factory, members, others):
    folder = str(tmp_path_factory.mktemp("ef"))
    values = np.array(sorted(members), np.uint64)
    ef = ngrams.EliasFano(values, 48, 40, folder, "x")
    ask = np.array([*members, *others], np.uint64)
    got = ef.find((ask >> np.uint64(40)).astype(np.int64), ask & np.uint64((1 << 40) - 1))
    place = {int(v): i for i, v in enumerate(values)}
    assert got.tolist() == [place.get(int(a), -1) for a in ask]


def test_codes_are_exact_for_small_counts_and_close_for_large():
    n = np.array([0, 1, 2, 127, 128, 1000, 10**6, 2**39])
    back = ngrams.restored()[ngrams.quantised(n)]
    assert (back[:4] == n[:4]).all() and (abs(back[4:] / n[4:] - 1) < 0.1).all()

"""Source divergence against plain whole-number arithmetic."""

import random
import re
from collections import Counter, defaultdict

import numpy as np

from tidemark.llm import divergence


def plain_audit(rows, least_docs=10, top=10):
    counts, seen, groups = defaultdict(Counter), Counter(), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", low)
        counts[lang, source].update(terms)
        seen.update((lang, t) for t in set(terms))
        groups[lang].add(source)
    share = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    out = set()
    for lang, sources in groups.items():
        kept = [t for (g, t), n in seen.items() if g == lang and n >= least_docs]
        total = {s: sum(counts[lang, s][t] for t in kept) for s in sources}
        p = {s: {t: share(counts[lang, s][t], total[s], len(kept)) for t in kept} for s in sources}
        q = {t: share(sum(counts[lang, s][t] for s in sources), sum(total.values()), len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(f(p[s][t], q[t]), t) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ordered = sorted(found, key=lambda x: (-x[0], x[1].encode()))[:most]
                out |= {(lang, s, part, item, value, k) for k, (value, item) in enumerate(ordered, 1)}
    return out


def got(df, **how):
    rows = [tuple(r) for r in divergence.audit(df, **how).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_equals_plain_arithmetic(make, words):
    rng = random.Random(7)
    few = words[:150] + ["Été", "naïve", "Ünit", "É", "x y", "日本"]
    text = lambda: rng.choice(["", "A1 ", "<x>"]) + " ".join(rng.choice(few[: rng.choice([5, 40, 156])]).title() for _ in range(rng.randint(0, 60)))
    rows = [(text(), rng.choice(["en", "en", "de", "", None]), rng.choice(["a", "b", "B", "é", "zz", None, ""])) for _ in range(500)]
    rows += [(None, "en", "only null"), ("", "fr", "a"), ("rare words", "fr", "b"), ("1 2 3", "xx", "a")]
    rows += [("same same again", "en", "hot")] * 300  # repeated rows
    docs = make([(i if i % 9 else None, *r) for i, r in enumerate(rows)], parts=5)
    assert got(docs) == plain_audit(rows)
    assert got(docs, least_docs=2, top=3) == plain_audit(rows, 2, 3)


def test_a_text_of_great_length_and_a_frequent_term(make):
    rows = [("the " * 300_000 + "cat", "en", "a")] + [(f"the cat w{i % 7}", "en", "abc"[i % 3]) for i in range(60)]
    assert got(make([(i, *r) for i, r in enumerate(rows)])) == plain_audit(rows)


def test_empty_tables(make, spark):
    empty = make([(1, "a b", "en", "a")]).where("false")
    assert got(empty) == set()
    assert got(make([(1, None, None, None)])) == set()
    assert got(make([(1, None, None, None), (2, "x", None, "b")])) == {("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)}


def test_tree_equals_all_rows_compared(monkeypatch):
    rng = np.random.default_rng(4)
    z = rng.integers(1, 50, 6)
    rows = sorted(tuple((s, int(rng.integers(1, 3))) for s in range(6) if rng.random() < 0.6) for _ in range(300))
    paths = Counter(rows)
    rows = sorted(paths)
    p_of = {(s, n): int(z[s] + 17 * n + s) for s in range(6) for n in (1, 2)}
    want = Counter()
    f = lambda u, v: (u - v) ** 2 // (u + v)
    for row, m in paths.items():
        for i, (b, nb) in enumerate(row):
            for a, na in row[:i]:
                p, q, y, x = p_of[a, na], p_of[b, nb], int(z[a]), int(z[b])
                want[a, b] += m * (f(p, q) - f(p, x) - f(y, q) + f(y, x))
    flat = [item for row in rows for item in row]
    at, n = (np.array(c, np.int64) for c in zip(*flat))
    p = np.array([p_of[i] for i in flat], np.int64)
    lens, m = np.array([len(r) for r in rows]), np.array([paths[r] for r in rows])
    for pairs in (1 << 20, 3):
        monkeypatch.setattr(divergence, "PAIRS", pairs)
        total = Counter()
        for a, b, value in zip(*divergence.tree_sums(lens, at, n, p, z[at], m)):
            total[int(a), int(b)] += int(value)
        assert {k: v for k, v in total.items() if v} == {k: v for k, v in want.items() if v}


def test_counts_of_any_size_stay_exact(spark):
    from pyspark.sql import functions as F

    n, total, terms = 10**15, 10**17 + 3, 10**9
    row = spark.range(1).select(divergence.share(F.lit(n), F.lit(total), F.lit(terms)).alias("p")).first()
    assert row.p == 1 + 10**9 * (n + 2) // (total + 2 * terms)

"""Filter interactions against filters applied one after the other."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

from tidemark.llm import interactions


def plain_fails(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, source in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = ("A" if len(w) < 50 else "") + ("B" if 100 * len(set(w)) < 65 * len(w) else "")
        fails += "C" if 100 * len(re.findall("[A-Z]", text)) > 5 * len(text) else ""
        fails += "D" if re.search(r"[#$%&*|]", text) else ""
        yield i, source or "", set(fails + ("E" if i is not None and i > first[text] else ""))


def plain(rows, labels):
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    failed, out = list(plain_fails(rows)), {}
    shapley = defaultdict(Counter)
    for part in {s for _, s, _ in failed}:
        for order in permutations("ABCDE"):
            kept = [(i, f) for i, s, f in failed if s == part]
            all_docs = kept
            for step, x in enumerate(order, 1):
                gone = [(i, f) for i, f in kept if x in f]
                kept = [(i, f) for i, f in kept if x not in f]
                out[part, "".join(order), step] = [
                    len(kept), len(gone), sum(x in f for _, f in all_docs) - len(gone), sum(f == {x} for _, f in all_docs),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), x,
                ]
                shapley[part][x] += len(gone)
    return {key: (*v[:6], shapley[key[0]][v[6]], v[6]) for key, v in out.items()}


def got(docs, labels):
    rows = interactions.interactions(docs, labels).collect()
    found = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley, r.filter) for r in rows}
    assert len(found) == len(rows)
    return found


LABELS = "doc_id long, quality int, toxic int"


def test_equals_filters_in_turn(make, spark, prose):
    rng = random.Random(4)
    texts = [prose(80), prose(60).title(), "word " * 70, "A # b", "", None, prose(20) + " $", " \x0b\x1c ", "É" * 60, prose(5000), "Same text again " * 30]
    rows = [(i, rng.choice(texts), rng.choice(["a", "b", "", None])) for i in range(250)]
    rows += [(None, rng.choice(texts), "a") for _ in range(40)]
    rows += [(300, texts[0], "a")] * 60 + [(301, texts[0], "b")] * 60  # repeated rows
    rows += [(302, texts[1], "c"), (302, texts[2], "c")]  # one id, two texts
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 303, 2)] + [(4, 1, 1), (None, 1, 1), (9999, 1, 1)]
    docs = make([(i, t, "en", s) for i, t, s in rows], parts=6)
    marks = spark.createDataFrame(labels, LABELS).selectExpr("*", "1 AS n", "2 AS mask", "'x' AS part")
    assert got(docs, marks) == plain(rows, labels)


def test_empty_tables(make, spark):
    nothing = spark.createDataFrame([], LABELS)
    assert got(make([(1, "a", "en", "a")]).where("false"), nothing) == {}
    found = got(make([(1, None, "en", None)]), nothing)
    assert found == plain([(1, None, None)], []) and len(found) == 600


def test_shapley_by_definition():
    rng = random.Random(6)
    for n in (2, 3, 5):
        sets = [(rng.randrange(1 << n), rng.randint(1, 9)) for _ in range(12)]
        v = [sum(k for mask, k in sets if mask & s) for s in range(1 << n)]
        weights = interactions.shapley_weights(n)
        for i in range(n):
            want = 0
            for order in permutations(range(n)):
                before = sum(1 << j for j in order[: order.index(i)])
                want += v[before | 1 << i] - v[before]
            assert sum(w * x for w, x in zip(weights[i], v)) == want

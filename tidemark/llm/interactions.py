"""How filters interact: what each removes after every set of others, and its Shapley share."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from fractions import Fraction
from itertools import permutations
from math import comb, factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged

WORD = r"[^\x20\x09-\x0D]+"


def few_words(text: Column, least: int = 50) -> Column:
    return F.regexp_count(text, F.lit(WORD)) < least


def few_distinct_words(text: Column, percent: int = 65) -> Column:
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return 100 * F.size(F.array_distinct(words)).cast("long") < percent * F.size(words).cast("long")


def many_capitals(text: Column, percent: int = 5) -> Column:
    capitals = F.regexp_count(text, F.lit("[A-Z]")).cast("long")
    return 100 * capitals > percent * F.length(text).cast("long")


def has_symbol(text: Column, symbols: str = "[#$%&*|]") -> Column:
    return text.rlike(symbols)


#: Whether a text fails each filter. ``COPY`` is the filter that looks at other documents.
CHECKS: Mapping[str, Callable[[Column], Column]] = {
    "A": few_words, "B": few_distinct_words, "C": many_capitals, "D": has_symbol,
}
COPY = "E"


def shapley_weights(n: int) -> list[list[int]]:
    """``n!`` times the weight of each coalition's removals in each filter's Shapley value.

    The value is the constrained least-squares fit of an additive model to all coalitions: the normal
    equations of ``sum w(S) (v(S) - sum of x_i in S)^2`` with the kernel ``w``, bordered by the
    condition that the x add up to ``v`` of all filters. They are solved in rationals, once, with one
    right-hand side per coalition (a bit set), so that the result is a linear form in ``v``.
    """
    full = (1 << n) - 1
    inside = lambda s: [s >> i & 1 for i in range(n)]
    rows = [[Fraction(0)] * (n + 1 + full + 1) for _ in range(n + 1)]
    for s in range(1, full):
        size, x = s.bit_count(), inside(s)
        kernel = Fraction(n - 1, comb(n, size) * size * (n - size))
        for i in range(n):
            rows[i][n + 1 + s] += kernel * x[i]
            for j in range(n):
                rows[i][j] += kernel * x[i] * x[j]
    for i in range(n):
        rows[i][n] = rows[n][i] = Fraction(1)
    rows[n][n + 1 + full] = Fraction(1)
    for c in range(n + 1):
        pivot = next(r for r in range(c, n + 1) if rows[r][c])
        rows[c], rows[pivot] = rows[pivot], rows[c]
        rows[c] = [value / rows[c][c] for value in rows[c]]
        for r in range(n + 1):
            if r != c and rows[r][c]:
                rows[r] = [a - rows[r][c] * b for a, b in zip(rows[r], rows[c])]
    scaled = [[value * factorial(n) for value in row[n + 1 :]] for row in rows[:n]]
    assert all(value.denominator == 1 for row in scaled for value in row)
    return [[int(value) for value in row] for row in scaled]


def failures(
    docs: DataFrame, labels: DataFrame, checks: Mapping[str, Callable[[Column], Column]] = CHECKS,
    doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Documents counted by ``part`` and ``mask``, the set of filters they fail (bit i is filter i, the
    copy filter last): ``n``, of them ``good`` and ``toxic`` by their labels.

    A document fails the copy filter if a document with a smaller id has the same text. Texts are
    compared by their SHA-256, which is all that moves of them; copies never meet in one task: the
    smallest id per text is a combinable minimum, joined back on text and id together.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    bits = [F.when(fails(F.col("_text")), 1 << i).otherwise(0) for i, fails in enumerate(checks.values())]
    read = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(source).cast("string"), F.lit("")).alias("part"), body.alias("_text"))
    mask = sum(bits, F.lit(0))
    judged = read.select("id", "part", mask.alias("mask"), F.unhex(F.sha2("_text", 256)).alias("hash"))
    rows = staged(judged.groupBy("id", "hash", "part", "mask").agg(F.count("*").alias("n")))

    named, nameless = rows.where("id is not null"), rows.where("id is null")
    first = named.groupBy("hash").agg(F.min("id").alias("id")).withColumn("_first", F.lit(True))
    copy = F.when(F.col("_first").isNull(), 1 << len(checks)).otherwise(0)
    settled = named.join(first, ["hash", "id"], "left").select("id", "part", (F.col("mask") + copy).alias("mask"), "n")
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    marked = settled.join(marks, "id", "left").select("part", "mask", "n", "good", "toxic")
    none = F.lit(None).cast("int")
    everything = marked.unionByName(nameless.select("part", "mask", "n", none.alias("good"), none.alias("toxic")))
    among = lambda mark: F.sum(F.col("n") * F.coalesce(mark, F.lit(0)))
    return everything.groupBy("part", "mask").agg(F.sum("n").alias("n"), among("good").alias("good"), among("toxic").alias("toxic"))


def coalitions(counted: DataFrame, n: int) -> DataFrame:
    """Per part the total and, for each of the ``2^n`` sets of filters, what the set removes: arrays
    ``removed``, ``good`` and ``toxic`` with the set's bits as index; ``alone`` by filter."""
    hit = lambda s, of: F.sum(F.when(F.col("mask").bitwiseAND(s) != 0, F.col(of)).otherwise(0))
    table = lambda of: F.array(*[hit(s, of) for s in range(1 << n)])
    alone = F.array(*[F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)) for i in range(n)])
    return counted.groupBy("part").agg(
        F.sum("n").alias("total"), table("n").alias("removed"), table("good").alias("good"),
        table("toxic").alias("toxic"), alone.alias("alone"))


def interactions(
    docs: DataFrame, labels: DataFrame, checks: Mapping[str, Callable[[Column], Column]] = CHECKS,
    copy: str = COPY, doc_id: str = "doc_id", text: str = "text", source: str = "source",
) -> DataFrame:
    """Per part, order of the filters and step: what the step's ``filter`` does there.

    ``kept`` documents after the step, ``removed`` by it, ``redundant`` (fail the filter, removed
    before), ``unique_fails`` (fail no other filter), ``good_lost`` and ``toxic_lost`` (removed with
    label quality = 1, toxic = 1), ``shapley`` (removed by the filter, summed over all orders). All are
    differences of coalitions: a step removes what the filters up to it remove together, less what
    those before it do.

    Null texts are empty, null sources the part ''. A document without an id has no labels, and is
    neither a copy nor the first of one; rows equal in id and text are copies of no smaller id, each is
    counted. Of several labels of one id any counts. An empty table gives no rows. Other columns of
    the tables are not looked at.
    """
    letters = [*checks, copy]
    n = len(letters)
    table = coalitions(failures(docs, labels, checks, doc_id, text, source), n)
    weights = shapley_weights(n)
    shares = F.array(*[sum((F.col("removed")[s] * w for s, w in enumerate(row) if w), F.lit(0)).cast("long") for row in weights])
    steps = []
    for order in permutations(range(n)):
        before, text_of = 0, "".join(letters[i] for i in order)
        for step, i in enumerate(order, 1):
            steps.append({"filter_order": text_of, "step": step, "i": i, "own": 1 << i, "before": before, "after": before | 1 << i})
            before |= 1 << i
    plan = F.from_json(F.lit(json.dumps(steps)), "array<struct<filter_order string, step int, i int, own int, before int, after int>>")
    rows = table.select("*", shares.alias("shares"), F.inline(plan))
    at = lambda of, place: F.col(of)[F.col(place)]
    gain = lambda of: at(of, "after") - at(of, "before")
    name = F.array(*[F.lit(x) for x in letters])[F.col("i")]
    return rows.select(
        "part", "filter_order", "step", (F.col("total") - at("removed", "after")).alias("kept"),
        gain("removed").alias("removed"), (at("removed", "own") - gain("removed")).alias("redundant"),
        at("alone", "i").alias("unique_fails"), gain("good").alias("good_lost"), gain("toxic").alias("toxic_lost"),
        at("shares", "i").alias("shapley"), name.alias("filter"))

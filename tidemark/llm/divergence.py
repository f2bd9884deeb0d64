"""How far the sources of a language differ in their use of terms: a frequent-pattern tree of term rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import sliced, staged, word_tokens

#: Probabilities are whole numbers of this part.
UNIT = 1_000_000_000
#: Letters A-Z in lower case, bytes of non-ASCII characters as they are, all others a space.
LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalpha() else 32 for c in range(256))
#: Items of a path by which it is dealt to a task.
HEAD_ITEMS = 4
#: Node and ancestor pairs handled at once.
PAIRS = 1 << 20


def letters_only(text: pa.Array) -> pa.Array:
    text = pc.fill_null(text.cast(pa.string()), "")
    valid, offsets, data = text.buffers()
    if data is None:
        return text
    return pa.Array.from_buffers(pa.string(), len(text), [valid, offsets, pa.py_buffer(data.to_pybytes().translate(LETTERS))], offset=text.offset)


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents, summed over parts of the texts here and
    over all of them by a combinable aggregate. ``docs`` has lang, source and text, none of them null."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            plain = whole.set_column(2, "text", letters_only(whole.column("text")))
            for batch in sliced(plain, "text"):
                offsets, codes, words = word_tokens(batch.column("text"), lower=False)
                if not len(codes):
                    continue
                lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
                group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
                row = np.repeat(np.arange(len(group)), np.diff(offsets))
                here, often = np.unique(row * len(words) + codes, return_counts=True)
                row, code = np.divmod(here, len(words))
                keys, back = np.unique(group[row] * len(words) + code, return_inverse=True)
                n = np.bincount(back, often, len(keys)).astype(np.int64)
                group, code = np.divmod(keys, len(words))
                g, s = np.divmod(group, len(source.dictionary))
                yield pa.RecordBatch.from_arrays(
                    [lang.dictionary.take(pa.array(g)), source.dictionary.take(pa.array(s)), pa.array(words, pa.binary()).cast(pa.string()).take(pa.array(code)),
                     pa.array(n), pa.array(np.bincount(back, minlength=len(keys)))], ["lang", "source", "term", "n", "docs"])

    parts = docs.mapInArrow(count, "lang string, source string, term string, n bigint, docs bigint")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (n + 2) / (total + 2 * terms)), in whole numbers of any size."""
    wide = "decimal(28,0)"
    top, below = (n + 2).cast(wide) * F.lit(UNIT).cast("decimal(10,0)"), (total + 2 * terms).cast(wide)
    return F.lit(1).cast("long") + F.call_function("div", top, below)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def corrections(paths: DataFrame) -> DataFrame:
    """(lang, a, b, value): what term rows add to the pair of sources a < b beyond terms that only one of
    them has. ``paths`` are the distinct term rows of a language: ``path`` lists (at: number of the
    source, n, p, z) in order of sources, ``m`` is the number of terms that share it.

    Rows are dealt by range in the order of their paths and inserted into a tree: rows that begin alike
    share the nodes of that beginning, and a node has the multiplicity of all rows below it. Each node
    is compared once with each of its ancestors, times its multiplicity. A beginning that goes over a
    border between batches has a node in each, with the multiplicity it has there; sums are the same.
    """

    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, rows in by_language(batch):
                lists = batch.column("path").slice(rows.start, rows.stop - rows.start)
                items, m = lists.flatten(), batch.column("m").to_numpy()[rows]
                lens = pc.list_value_length(lists).to_numpy()
                found = tree_sums(lens, *(items.field(c).to_numpy().astype(np.int64) for c in ("at", "n", "p", "z")), m)
                a, b, value = found
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(a), pa.string()), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.int64())], ["lang", "a", "b", "value"])

    # The ranges are made from a sample of keys; the first items tell paths apart well enough, and what
    # they do not tell apart is spread by a hash.
    head = F.transform(F.slice("path", 1, HEAD_ITEMS), lambda x: F.struct(x["at"], x["n"]))
    ordered = paths.repartitionByRange("lang", head, F.xxhash64("path")).sortWithinPartitions("lang", "path")
    sums = ordered.select("lang", "path", "m").mapInArrow(grow, "lang string, a bigint, b bigint, value bigint")
    return sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, slice]]:
    if not batch.num_rows:
        return
    codes = batch.column("lang").dictionary_encode()
    cuts = [0, *(np.flatnonzero(np.diff(codes.indices.to_numpy())) + 1).tolist(), batch.num_rows]
    for x, y in zip(cuts[:-1], cuts[1:]):
        yield codes[x].as_py(), slice(x, y)


def tree_sums(lens, at, n, p, z, m) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums over the tree of rows in the order of their paths (flat items, ``lens`` of each row)."""
    begin = np.concatenate([[0], np.cumsum(lens)[:-1]]).astype(np.int64)
    shared = np.zeros(len(lens) + 1, np.int64)  # items a row has in common with the one before it
    depth, open_rows = 0, np.arange(1, len(lens))
    while len(open_rows):
        open_rows = open_rows[(lens[open_rows] > depth) & (lens[open_rows - 1] > depth)]
        x, y = begin[open_rows] + depth, begin[open_rows - 1] + depth
        open_rows = open_rows[(at[x] == at[y]) & (n[x] == n[y])]
        depth += 1
        shared[open_rows] = depth
    out = ([], [], [])
    top = int(at.max(initial=0)) + 1
    for depth in range(1, int(lens.max(initial=0))):
        first = np.flatnonzero(shared[:-1] <= depth)  # rows that do not go on with the node before
        count = np.add.reduceat(m, first)
        new = lens[first] > depth
        nodes, count = first[new], count[new]
        for x in range(0, len(nodes), max(1, PAIRS // depth)):
            some, times = nodes[x : x + max(1, PAIRS // depth)], count[x : x + max(1, PAIRS // depth), None]
            node = (begin[some] + depth)[:, None]
            above = begin[some][:, None] + np.arange(depth)
            f = lambda u, v: (u - v) ** 2 // (u + v)
            gain = f(p[node], p[above]) - f(z[node], p[above]) - f(p[node], z[above]) + f(z[node], z[above])
            keys, back = np.unique((at[above] * top + at[node]).ravel(), return_inverse=True)
            value = np.zeros(len(keys), np.int64)
            np.add.at(value, back, (gain * times).ravel())
            for column, part in zip(out, (*np.divmod(keys, top), value)):
                column.append(part)
    if not out[0]:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(column) for column in out)


def audit(
    docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text",
    least_docs: int = 10, top: int = 10,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) on every group of a language and a source.

    Terms are runs of letters and non-ASCII characters, A-Z in lower case, in at least ``least_docs``
    documents of the language. A group gives a term of ``n`` occurrences the share ``p`` (see ``share``);
    the distance of two shares is ``(p - q)^2 / (p + q)``, rounded down. Part ``pair``: the sum over all
    terms for each other source of the language. Part ``term``: the ``top`` terms that the group has
    more of than its language, by distance from it.

    A pair's sum is that of two sources without any term, plus for each term that one of them has its
    difference from that (by the distinct shares of a source), plus what terms that both have differ
    from the two together (``corrections``).

    Null language, source and text are empty. Repeated rows are documents each. Groups without a term
    have pairs; in a language without terms their value is 0. An empty table gives no rows. Per
    language the number of sources, which the result has the square of, is held in an array; terms,
    documents and occurrences are not bounded by anything.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    read = docs.select(blank(lang).alias("lang"), blank(source).alias("source"), F.col(text).cast("string").alias("text"))
    listed = F.array_sort(F.collect_list(F.struct("source", "n")))
    rows = term_counts(read).groupBy("lang", "term").agg(listed.alias("items"), F.sum("docs").alias("docs"), F.sum("n").alias("all"))
    rows = staged(rows.where(F.col("docs") >= least_docs).select("lang", "term", "items", "all"))

    # One row per group and one per language: their sizes, and the share of a term they do not have.
    langs = rows.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all").alias("lang_total"))
    totals = rows.select("lang", F.inline("items")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    at = F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long")
    groups = read.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left")
    groups = groups.na.fill(0, ["total", "terms", "lang_total"]).withColumn("at", at)
    groups = staged(groups.withColumn("z", F.when(F.col("terms") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))).otherwise(1)))

    cells = rows.select("lang", "term", "all", F.inline("items")).join(groups, ["lang", "source"])
    cells = cells.withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    over = cells.withColumn("q", share(F.col("all"), F.col("lang_total"), F.col("terms"))).where("p > q")
    over = over.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = over.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)

    path = F.array_sort(F.collect_list(F.struct("at", "n", "p", "z")))
    paths = staged(cells.groupBy("lang", "term").agg(path.alias("path")).groupBy("lang", "path").agg(F.count("*").alias("m")))

    shares = paths.select("lang", "m", F.inline("path")).groupBy("lang", "at", "p", "z").agg(F.sum("m").alias("m"))
    other = groups.select("lang", F.col("at").alias("b"), F.col("z").alias("zb"))
    met = shares.withColumnRenamed("at", "a").join(other, "lang").where("a <> b")
    single = (distance(F.col("p"), F.col("zb")) - distance(F.col("z"), F.col("zb"))) * F.col("m")
    low, high = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
    singles = met.select("lang", low, high, single.alias("value"))
    mine = groups.select("lang", F.col("at").alias("a"), F.col("z").alias("za"), "terms")
    base = mine.join(other, "lang").where("a < b").select("lang", "a", "b", (distance(F.col("za"), F.col("zb")) * F.col("terms")).alias("value"))
    sums = base.unionByName(singles).unionByName(corrections(paths)).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))

    sums = staged(sums)
    both = sums.unionByName(sums.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    name = lambda col, to: groups.select("lang", F.col("at").alias(col), F.col("source").alias(to))
    pairs = both.join(name("a", "source"), ["lang", "a"]).join(name("b", "item"), ["lang", "b"])
    pairs = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(terms)

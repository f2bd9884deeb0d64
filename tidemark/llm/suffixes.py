"""Repeated passages across documents, found with sparse suffix arrays."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import drop_staged, gram_hashes, sliced, staged, word_hashes, word_tokens

SECOND_BASE = 0xD1342543DE82EF95


def minimisers(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions of the smallest gram of every run of ``window`` grams, the rightmost among equals.

    What is picked depends on the grams of the run alone, so two equal passages of ``window`` grams
    have the same relative position picked.
    """
    if len(grams) < window:
        return np.zeros(0, np.int64)
    runs = np.lib.stride_tricks.sliding_window_view(grams[::-1], window)
    picked = np.empty(len(runs), np.int64)
    for at in range(0, len(runs), 65_536):
        picked[at : at + 65_536] = runs[at : at + 65_536].argmin(1) + np.arange(at, min(at + 65_536, len(runs)))
    return np.unique(len(grams) - 1 - picked)


def _geometry(min_words: int, gram: int, window: int) -> int:
    """Words of a suffix that every repeated passage of ``min_words`` has right of its anchor."""
    depth = min_words - window + 1
    if depth < gram:
        raise ValueError("min_words must be at least window + gram - 1")
    return depth


def suffixes(docs: DataFrame, min_words: int, gram: int, window: int) -> DataFrame:
    """Sparse suffix array entries (suffix: binary, rank, x, at) of rows (rank, x, text).

    A suffix is kept at each minimiser that has enough words behind it, as the sequence of 16-bit
    hashes of its next words, big-endian, so that bytes sort like sequences.
    """
    depth = _geometry(min_words, gram, window)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, "text"):
                offsets, codes, words = word_tokens(batch.column("text"))
                h = word_hashes(words)
                keys, rows, ats = [], [], []
                for i in range(batch.num_rows):
                    own = h[codes[offsets[i] : offsets[i + 1]]]
                    if len(own) < min_words:
                        continue
                    at = minimisers(gram_hashes(own, gram)[: len(own) - gram + 1], window)
                    at = at[at + depth <= len(own)]
                    short = (own >> np.uint64(48)).astype(">u2")
                    keys.append(short[at[:, None] + np.arange(depth)])
                    rows.append(np.full(len(at), i))
                    ats.append(at)
                if keys:
                    flat = np.concatenate(keys)
                    start = np.arange(len(flat) + 1, dtype=np.int32) * (2 * depth)
                    binary = pa.Array.from_buffers(pa.binary(), len(flat), [None, pa.py_buffer(start), pa.py_buffer(np.ascontiguousarray(flat))])
                    which = np.concatenate(rows)
                    yield pa.RecordBatch.from_arrays([binary, batch.column("rank").take(which), batch.column("x").take(which), pa.array(np.concatenate(ats).astype(np.int32))], ["suffix", "rank", "x", "at"])

    return docs.select("rank", "x", "text").mapInArrow(pick, "suffix binary, rank bigint, x bigint, at int")


def neighbours(array: DataFrame) -> DataFrame:
    """Anchors (rank, x, at) whose suffix equals the one before or after it in sorted order.

    The array is dealt by range of (suffix, rank, x, position), so even one suffix with very many
    copies spreads over tasks. The first and last entry of a task may have its twin in the next task;
    they are passed on unseen, at most two a task, because the extension that follows is exact.
    """
    order = ["suffix", "rank", "x", "at"]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, first = None, True  # the last entry waits for its successor
        for b in batches:
            if not b.num_rows:
                continue
            if tail is not None:
                b = pa.Table.from_batches([tail, b]).combine_chunks().to_batches()[0]
            keys = np.array(b.column("suffix").to_pylist(), dtype=object)
            same = np.zeros(len(keys) + 1, bool)
            same[1:-1] = keys[1:] == keys[:-1]
            same[0] = first or waiting  # noqa: F821
            flag = (same[:-1] | same[1:])[:-1]
            yield b.slice(0, len(flag)).select(order[1:]).filter(pa.array(flag))
            tail, waiting, first = b.slice(len(flag)), bool(same[-2]), False
        if tail is not None:
            yield tail.select(order[1:])

    ordered = array.repartitionByRange(*order).sortWithinPartitions(*order)
    return ordered.mapInArrow(compare, "rank bigint, x bigint, at int")


def windows(anchored: DataFrame, min_words: int, window: int) -> DataFrame:
    """Passages of ``min_words`` that reach left and right of the anchors of rows (rank, x, text,
    anchors): two hashes (a, b), rank, x and the first word."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in sliced(whole, "text"):
                offsets, codes, words = word_tokens(batch.column("text"))
                h, anchors, out = word_hashes(words), batch.column("anchors").to_pylist(), []
                for i in range(batch.num_rows):
                    own = h[codes[offsets[i] : offsets[i + 1]]]
                    reach = (np.asarray(anchors[i], np.int64)[:, None] - np.arange(window)).ravel()
                    start = np.unique(reach[(reach >= 0) & (reach + min_words <= len(own))])
                    if len(start):
                        a, b = gram_hashes(own, min_words), gram_hashes(own, min_words, SECOND_BASE)
                        out.append((np.full(len(start), i), a[start], b[start] >> np.uint64(32), start))
                if out:
                    which, a, b, start = (np.concatenate(c) for c in zip(*out))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(a.view(np.int64)), pa.array(b.astype(np.uint32).view(np.int32)), batch.column("rank").take(which), batch.column("x").take(which), pa.array(start.astype(np.int32))],
                        ["a", "b", "rank", "x", "start"],
                    )

    return anchored.select("rank", "x", "text", "anchors").mapInArrow(extend, "a bigint, b int, rank bigint, x bigint, start int")


PLACE = ["rank", "x", "start"]
MARKED = "a bigint, b int, rank bigint, x bigint, start int, first struct<rank: bigint, x: bigint, start: int>, more boolean, opens boolean"


def first_places(passages: DataFrame) -> DataFrame:
    """(rank, x, start, source, removed) for every passage that stands in more than one place: the
    first place stays, the others are removed.

    Passages are dealt by range of hash and place and sorted, so one passage with very many places
    spreads over tasks and its first place comes first. Only the passage a task opens with may have
    begun in an earlier task: every task also tells the first place it saw of the passages it opens
    and closes with, two rows a task, and these settle the opening ones.
    """
    order = ["a", "b", *PLACE]
    kind = pa.struct([("rank", pa.int64()), ("x", pa.int64()), ("start", pa.int32())])
    names = [*order, "first", "more", "opens"]

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail = lead = head = None  # last row so far, first row of its passage, first row of all
        in_opening = earlier = False

        def rows(b: pa.Table, first: pa.Table, more: np.ndarray, opens: np.ndarray) -> pa.RecordBatch:
            place = pa.StructArray.from_arrays([first[n].combine_chunks().cast(kind.field(n).type) for n in PLACE], PLACE)
            return pa.RecordBatch.from_arrays([*[b[n].combine_chunks() for n in order], place, pa.array(more, pa.bool_()), pa.array(opens, pa.bool_())], names)

        for batch in batches:
            t = pa.Table.from_batches(([tail] if tail is not None else []) + [batch.select(order)])
            columns = [t[n].to_numpy() for n in order]
            same = np.zeros(t.num_rows, bool)
            same[1:] = (columns[0][1:] == columns[0][:-1]) & (columns[1][1:] == columns[1][:-1])
            again = same.copy()
            for c in columns[2:]:
                again[1:] &= c[1:] == c[:-1]
            if again.any():
                keep = ~again
                t, same = t.filter(pa.array(keep)), same[keep]
            if not t.num_rows:
                continue
            if head is None:
                head, lead, in_opening = t.slice(0, 1), t.slice(0, 1), True
            heads = np.where(same, 0, np.arange(t.num_rows))
            heads[0] = 0
            heads = np.maximum.accumulate(heads)
            group_zero = heads == 0
            whole = pa.concat_tables([lead, t])  # row 0 is the carried first place
            first = whole.take(np.where(group_zero, 0, heads + 1))
            opens = group_zero & in_opening
            more = np.append(same[1:], False) | same
            more[0] |= earlier
            n = t.num_rows - 1
            if n:
                yield rows(t.slice(0, n), first.slice(0, n), more[:n], opens[:n])
            lead, in_opening, earlier = first.slice(n), bool(opens[n]), bool(same[n] or (n == 0 and earlier))
            tail = t.slice(n).combine_chunks().to_batches()[0]
        if tail is not None:
            last = pa.Table.from_batches([tail])
            yield rows(last, lead, np.array([earlier]), np.array([True]))
            # What this task knows of the passages it opens and closes with, under a null start.
            ends = pa.concat_tables([head, last])
            told = rows(ends, pa.concat_tables([head, lead]), np.zeros(2, bool), np.ones(2, bool)).to_pylist()
            yield pa.RecordBatch.from_pylist([{**r, "start": None} for r in told], tail_schema)

    tail_schema = pa.schema([("a", pa.int64()), ("b", pa.int32()), ("rank", pa.int64()), ("x", pa.int64()), ("start", pa.int32()), ("first", kind), ("more", pa.bool_()), ("opens", pa.bool_())])
    ordered = passages.repartitionByRange(*order).sortWithinPartitions(*order)
    marked = ordered.mapInArrow(mark, MARKED)
    marked = staged(marked.where("more or opens"))
    told = marked.where("start is null").groupBy("a", "b").agg(F.min("first").alias("least"), F.max("first").alias("most"))
    # At most two rows a task of the sort, whatever the tables hold.
    ends = {(r["a"], r["b"]): (tuple(r["least"]), r["least"] != r["most"]) for r in told.toLocalIterator()}

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = batch.filter(batch.column("start").is_valid())
            rank, x, start = (b.column(n).to_numpy() for n in PLACE)
            first = [b.column("first").field(i).to_numpy().copy() for i in range(3)]
            keep = b.column("more").to_numpy(zero_copy_only=False).copy()
            opening = np.flatnonzero(b.column("opens").to_numpy(zero_copy_only=False))
            for i, key in zip(opening.tolist(), zip(b.column("a").take(pa.array(opening)).to_pylist(), b.column("b").take(pa.array(opening)).to_pylist())):
                least, several = ends[key]
                first[0][i], first[1][i], first[2][i] = least
                keep[i] |= several
            removed = (rank != first[0]) | (x != first[1]) | (start != first[2])
            keep |= removed
            columns = [rank, x, start, first[0], removed]
            yield pa.RecordBatch.from_arrays([pa.array(c[keep]) for c in columns], [*PLACE, "source", "removed"])

    return marked.mapInArrow(settle, "rank bigint, x bigint, start int, source bigint, removed boolean")


def count_words(text: Column) -> Column:
    @F.arrow_udf("bigint")
    def count(texts: pa.Array) -> pa.Array:
        return pa.array([len(t.encode("utf-8", "surrogatepass").split()) if t else 0 for t in texts.to_pylist()], pa.int64())

    return count(text)


SIDE = ["start", "last", "source"]
RUN = pa.struct([("start", pa.int64()), ("last", pa.int64()), ("source", pa.int64())])


def side_by_side(places: DataFrame) -> DataFrame:
    """Places (rank, x, start, source, removed) as one list of runs a text and ``removed``: the first and
    last of places side by side and their least source. A repeated page of a thousand words is one run, so
    lists stay short where a text has very many places."""
    text = ["rank", "x", "removed"]
    nth = F.dense_rank().over(Window.partitionBy(*text).orderBy("start"))
    runs = places.select(*text, "start", "source", (F.col("start") - nth).alias("run")).groupBy(*text, "run")
    runs = runs.agg(F.min("start").cast("long").alias("start"), F.max("start").cast("long").alias("last"), F.min("source").alias("source"))
    return runs.groupBy(*text).agg(F.collect_list(F.struct(*SIDE)).alias("runs"))


def merged(min_words: int):
    """Passages that touch or overlap as one: list of runs (start, last, source) to list of spans."""

    @F.arrow_udf("array<struct<first_word: bigint, n_words: bigint, source: bigint>>")
    def spans(runs: pa.Array) -> pa.Array:
        sizes = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False)
        flat = runs.flatten()
        start, last, source = (flat.field(i).to_numpy(zero_copy_only=False) for i in range(3))
        row = np.repeat(np.arange(len(sizes)), sizes)
        order = np.lexsort((start, row))
        start, last, source = start[order], last[order], source[order]
        new = np.ones(len(row), bool)
        new[1:] = (np.diff(row) > 0) | (start[1:] - last[:-1] > min_words)
        heads = np.flatnonzero(new)
        ends = last[np.append(heads[1:], len(row))[: len(heads)] - 1] + min_words
        least = np.minimum.reduceat(source, heads) if len(heads) else source
        found = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (start[heads], ends - start[heads], least)], ["first_word", "n_words", "source"])
        offsets = np.concatenate(([0], np.cumsum(np.bincount(row[heads], minlength=len(sizes)))))
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), found)

    return spans


def others(min_words: int):
    """The places of a text of so many words that are not in the runs ``gone``, as runs of source ``rank``."""

    @F.arrow_udf("array<struct<start: bigint, last: bigint, source: bigint>>")
    def places(gone: pa.Array, n_words: pa.Array, rank: pa.Array) -> pa.Array:
        out = []
        for runs, n, source in zip(gone, n_words.to_pylist(), rank.to_pylist()):
            left = np.ones(n - min_words + 1, bool)
            for run in runs.as_py() or []:
                left[run["start"] : run["last"] + 1] = False
            edge = np.flatnonzero(np.diff(np.concatenate(([False], left, [False]))))
            out.append([{"start": a, "last": b, "source": source} for a, b in zip(edge[::2].tolist(), (edge[1::2] - 1).tolist())])
        return pa.array(out, pa.list_(RUN))

    return places


#: Rank of rows without an id: after all ids.
NO_ID = (1 << 63) - 1


def repeated_passages(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = 50, gram: int = 5, window: int = 40) -> DataFrame:
    """One row per maximal repeated passage of a document: ``doc_id``, ``first_word``, ``n_words``,
    ``removed`` (false for an occurrence that stays), ``source_doc_id`` and ``x`` (hash of the text,
    which tells rows of equal id apart).

    Words stand between ASCII white space and compare with A-Z in lower case. A passage of
    ``min_words`` is repeated if the same words stand elsewhere, in another document or further on in
    the same one. Of all its places the one in the document with the smallest id (then the first place)
    stays; the others are removed, and passages that overlap are merged. ``source_doc_id`` is the
    smallest id that holds a kept place of the passage. Of documents with equal texts the one with the
    smallest id stands for all: what an earlier document holds of it is removed, the rest is kept, also
    where only its copies repeat it. The others are one removed passage each, and have the smallest id
    that keeps a part of them as source. Rows that agree in id and text count once, so they are no
    copies of one another. Rows without an id come after all ids and share the id null. Null, empty and short texts
    have no passage. An empty table gives no rows.

    Exact: a passage of ``min_words`` has a minimiser among its first ``window`` grams, so its equal
    places keep suffixes that share at least ``min_words - window + 1`` words and stand side by side in
    the sorted array. Their extensions to both sides are then compared as whole passages.
    """
    ids, texts = F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)), F.col(text).cast("string")
    rows = docs.select(ids.alias("rank"), F.xxhash64(texts).alias("x"), texts.alias("text")).where(F.octet_length("text") >= 2 * min_words - 1)
    copies = staged(rows.select("rank", "x", F.xxhash64(F.lit(7), "text").alias("y"), count_words(F.col("text")).alias("n_words")))
    groups = copies.groupBy("x", "y").agg(F.min("rank").alias("lead"), (F.min("rank") < F.max("rank")).alias("several"), F.max("n_words").alias("n_words"))
    leads = staged(groups.where(F.col("n_words") >= min_words))

    if not copies.groupBy("rank", "x", "y").count().where("count > 1").isEmpty():
        # Rows equal in id and text count once: they are folded before anything is gathered from them.
        rows = staged(rows.groupBy("rank", "x", F.xxhash64(F.lit(7), "text").alias("y")).agg(F.first("text").alias("text")).drop("y"))

    array = staged(suffixes(rows, min_words, gram, window))
    anchors = neighbours(array)
    by_row = anchors.groupBy("rank", "x").agg(F.collect_list("at").alias("anchors"))
    wanted = staged(by_row.join(leads.select(F.col("lead").alias("rank"), "x"), ["rank", "x"], "left_semi"))
    drop_staged(array)
    # Neither side has a size bound: rows with texts meet the list by merging, at every size alike.
    hits = first_places(windows(rows.join(wanted.hint("merge"), ["rank", "x"]), min_words, window))
    listed = staged(side_by_side(hits))

    # A text with copies keeps all its places but those an earlier document holds.
    first = leads.where("several").select(F.col("lead").alias("rank"), "x", "y", "n_words")
    held = listed.where("removed").select("rank", "x", F.col("runs").alias("gone"), F.array_min("runs.source").alias("source"))
    first = staged(first.join(held, ["rank", "x"], "left"))
    kept = first.select("rank", "x", F.lit(False).alias("removed"), others(min_words)("gone", "n_words", "rank").alias("runs"))
    own = listed.join(first.select("rank", "x", F.lit(False).alias("removed")), ["rank", "x", "removed"], "left_anti")
    parts = own.unionByName(kept).select("rank", "x", "removed", F.inline(merged(min_words)("runs")))

    source = F.least(F.col("lead"), F.coalesce("source", "lead"))
    copied = copies.join(first.select("x", "y", F.col("rank").alias("lead"), "source"), ["x", "y"]).where(F.col("rank") != F.col("lead"))
    whole = copied.select("rank", "x", F.lit(True).alias("removed"), F.lit(0).cast("long").alias("first_word"), "n_words", source.alias("source")).distinct()
    named = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return parts.unionByName(whole).select(named("rank").alias("doc_id"), "first_word", "n_words", "removed", named("source").alias("source_doc_id"), "x")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", n_chars: str | None = "n_chars", **how) -> DataFrame:
    """``docs`` with removed passages cut out of the text, words and the space after them.

    A document none of whose words is left goes; all others stay, with ``n_chars`` counted anew.
    """
    found = repeated_passages(docs, doc_id, text, **how).where("removed")
    cuts = staged(found.groupBy("doc_id", "x").agg(F.collect_list(F.struct("first_word", "n_words")).alias("_cuts")))
    cuts = cuts.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_rank"), F.col("x").alias("_x"), "_cuts")

    @F.arrow_udf("string")
    def without(texts: pa.Array, spans: pa.Array) -> pa.Array:
        return pa.array([cut_words(t, s) if s else t for t, s in zip(texts.to_pylist(), spans.to_pylist())], pa.string())

    here = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(NO_ID)).alias("_rank"), F.xxhash64(F.col(text).cast("string")).alias("_x"), F.struct(*docs.columns).alias("_row"))
    # Neither side has a size bound: rows with texts meet the list by merging, at every size alike.
    cut = here.join(cuts.hint("merge"), ["_rank", "_x"], "left").withColumn("_text", without.asNondeterministic()(F.col("_row")[text].cast("string"), "_cuts"))
    left = cut.where(F.col("_cuts").isNull() | F.regexp_like("_text", F.lit(r"[^ \t-\r]")))
    columns = {c: F.col("_row")[c] for c in docs.columns}
    columns[text] = F.col("_text")
    if n_chars in columns:
        columns[n_chars] = F.when(F.col("_cuts").isNull(), columns[n_chars]).otherwise(F.length("_text")).cast(docs.schema[n_chars].dataType)
    return left.select(*[value.alias(name) for name, value in columns.items()])


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and the white space that follows them."""
    starts = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    out, at = [], 0
    for a, e in sorted((s["first_word"], s["first_word"] + s["n_words"]) for s in spans):
        if starts[min(e, len(starts) - 1)] > at:
            out.append(text[at : max(at, starts[a])])
            at = starts[min(e, len(starts) - 1)]
    return "".join(out) + text[at:]

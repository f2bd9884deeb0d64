"""Benchmark passages in training text: rare n-gram seeds, then Smith-Waterman alignment."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import ceil
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import alnum_only, gram_hashes, sliced, staged, word_hashes, word_tokens
from tidemark.session import shared_folder
from tidemark.sources.tables import list_folder

SEED_WORDS = 3
#: Points of the alignment; a gap costs twice a mismatch.
MATCH, MISMATCH, GAP = 1, -1, -2
#: Items with fewer words must occur unchanged.
SHORT_ITEM = 8
#: Test items are handled in blocks of about so many words, each block in passes over all documents.
BLOCK_WORDS = 4_000_000
#: Cells of alignments worked on at once.
CELLS = 1 << 21


def needed(words: int, least: float) -> float:
    return 1.0 if words < SHORT_ITEM else least


def spare_seeds(words: int, least: float) -> int:
    """Seeds that may be passed over: a passage that reaches ``least`` keeps more seeds than that.

    An item of L words has L - 2 seeds. A lost point costs at most 1.5 seeds (a replaced word costs
    two points and three seeds), and at most (1 - least) L points may be lost.
    """
    if words < SHORT_ITEM:
        return max(0, words - SEED_WORDS)
    return max(0, ceil(words - SEED_WORDS + 1 - 1.5 * (1 - least) * words) - 1)


@dataclass
class Block:
    """Some test items with their seeds, sorted by hash: the state that travels with a task."""

    ids: list
    words: list[np.ndarray]
    seed: np.ndarray
    item: np.ndarray
    place: np.ndarray

    def chosen(self, keep: np.ndarray) -> Block:
        return Block(self.ids, self.words, self.seed[keep], self.item[keep], self.place[keep])


def make_block(ids: list, texts: list[str | None]) -> Block:
    offsets, codes, vocabulary = word_tokens(alnum_only(pa.array(texts, pa.string())))
    h = word_hashes(vocabulary)
    words = [h[codes[a:b]] for a, b in zip(offsets[:-1], offsets[1:])]
    seeds = [gram_hashes(w, min(SEED_WORDS, max(len(w), 1))) for w in words]
    item = np.repeat(np.arange(len(words)), [len(s) for s in seeds])
    place = np.concatenate([np.arange(len(s)) for s in seeds] or [np.zeros(0, np.int64)])
    seed = np.concatenate(seeds or [np.zeros(0, np.uint64)])
    order = np.argsort(seed, kind="stable")
    return Block(ids, words, seed[order], item[order], place[order])


def blocks(items: DataFrame, item_id: str, text: str, block_words: int = BLOCK_WORDS) -> Iterator[Block]:
    """The test items, a bounded number at a time, in order of id."""
    ids, texts, size = [], [], 0
    for row in items.select(F.col(item_id).alias("i"), F.col(text).cast("string").alias("t")).orderBy("i", "t").toLocalIterator():
        ids.append(row["i"])
        texts.append(row["t"])
        size += len((row["t"] or "").split())
        if size >= block_words:
            yield make_block(ids, texts)
            ids, texts, size = [], [], 0
    if ids:
        yield make_block(ids, texts)


def seed_hits(seeds: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``h`` where a distinct seed of 1 to ``SEED_WORDS`` words starts, and the seed's hash."""
    at, found = [], []
    for n in range(1, SEED_WORDS + 1):
        g = gram_hashes(h, n)
        if len(g) and len(seeds):
            where = np.flatnonzero(seeds[np.minimum(np.searchsorted(seeds, g), len(seeds) - 1)] == g)
            at.append(where)
            found.append(g[where])
    return (np.concatenate(at), np.concatenate(found)) if at else (np.zeros(0, np.int64), np.zeros(0, np.uint64))


def count_seeds(docs: DataFrame, text: str, block: Block) -> dict[int, int]:
    """How often each seed of the block stands in all documents; at most one number per seed."""
    seeds = np.unique(block.seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(seeds), np.int64)
        for whole in batches:
            for batch in sliced(whole, "text"):
                _, codes, words = word_tokens(alnum_only(batch.column("text")))
                if len(codes):
                    found = seed_hits(seeds, word_hashes(words)[codes])[1]
                    total += np.bincount(np.searchsorted(seeds, found), minlength=len(seeds))
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seeds[hit].view(np.int64)), pa.array(total[hit])], ["seed", "n"])

    counted = docs.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "seed bigint, n bigint")
    return {r["seed"] & ((1 << 64) - 1): r["n"] for r in counted.groupBy("seed").agg(F.sum("n").alias("n")).collect()}


def rare_seeds(block: Block, counts: dict[int, int], least: float) -> Block:
    """The block without each item's most frequent seeds, as many as can be spared."""
    n = np.array([counts.get(int(s), 0) for s in block.seed], np.int64)
    order = np.lexsort((block.place, -n, block.item))
    ranked = block.item[order]
    rank = np.arange(len(order)) - np.searchsorted(ranked, ranked)
    spare = np.array([spare_seeds(len(w), least) for w in block.words] or [0])
    keep = np.ones(len(order), bool)
    keep[order[rank < spare[ranked]]] = False
    return block.chosen(keep)


def align(items: list[np.ndarray], passages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Smith-Waterman of pairs of word sequences: best score, and the passage's first and last
    matched word (end exclusive), all pairs row by row at once."""
    count, long, wide = len(items), max(map(len, items)), max(map(len, passages))
    b = np.zeros((count, wide), np.uint64)
    real = np.zeros((count, wide), bool)
    for i, p in enumerate(passages):
        b[i, : len(p)], real[i, : len(p)] = p, True
    a = np.zeros((count, long), np.uint64)
    size = np.array([len(x) for x in items])
    for i, x in enumerate(items):
        a[i, : len(x)] = x
    step = np.arange(wide + 1) * -GAP
    above = np.zeros((count, wide + 1), np.int64)
    origin = np.tile(np.arange(wide + 1), (count, 1))  # where the alignment that ends here began
    best, start, end = np.zeros(count, np.int64), np.zeros(count, np.int64), np.zeros(count, np.int64)
    rows = np.arange(count)
    for r in range(long):
        same = np.where((b == a[:, r : r + 1]) & real, MATCH, MISMATCH)
        down, diagonal = above + GAP, above[:, :-1] + same
        now = np.maximum(down, 0)
        begun = np.where(down > 0, origin, np.arange(wide + 1))
        use = diagonal >= now[:, 1:]
        now[:, 1:] = np.where(use, diagonal, now[:, 1:])
        begun[:, 1:] = np.where(use & (diagonal > 0), origin[:, :-1], begun[:, 1:])
        lifted = now + step
        top = np.maximum.accumulate(lifted, axis=1)
        source = np.maximum.accumulate(np.where(lifted == top, np.arange(wide + 1), 0), axis=1)
        across = top - step
        now, begun = np.where(across > now, across, now), np.where(across > now, np.take_along_axis(begun, source, 1), begun)
        now[r >= size] = 0
        at = now.argmax(1)
        better = now[rows, at] > best
        best, end = np.where(better, now[rows, at], best), np.where(better, at, end)
        start = np.where(better, begun[rows, at], start)
        above, origin = now, begun
    return best, start, end


def find_in(block: Block, h: np.ndarray, offsets: np.ndarray, least: float) -> list[list[tuple]]:
    """Matches (item number, score, first word, words) of every text of a batch."""
    out: list[list[tuple]] = [[] for _ in range(len(offsets) - 1)]
    at, found = seed_hits(np.unique(block.seed), h)
    row = np.searchsorted(offsets, at, side="right") - 1
    lo, hi = np.searchsorted(block.seed, found), np.searchsorted(block.seed, found, side="right")
    times = hi - lo
    which = np.repeat(lo, times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    at, row, item = np.repeat(at, times), np.repeat(row, times), block.item[which]
    begin = at - block.place[which]
    order = np.lexsort((begin, item, row))
    row, item, begin = row[order], item[order], begin[order]
    lens = np.array([len(w) for w in block.words])
    slack = np.ceil(0.4 * lens[item]).astype(np.int64) + 1
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (begin[1:] - begin[:-1] > slack[1:])
    heads = np.flatnonzero(new)
    ends = np.append(heads[1:], len(row)) - 1
    pairs = []
    for s, e in zip(heads.tolist(), ends.tolist()):
        i, r = int(item[s]), int(row[s])
        w = block.words[i]
        a = max(int(begin[s] - slack[s]), int(offsets[r]))
        b = min(int(begin[e] + len(w) + slack[s]), int(offsets[r + 1]))
        # Matched words bound the score from above, window by window, so weak ones need no alignment.
        shared = np.concatenate(([0], np.cumsum(np.isin(h[a:b], w))))
        span = len(w) + int(slack[s])
        most = (shared[span:] - shared[:-span]).max() if len(shared) > span else shared[-1]
        if most >= needed(len(w), least) * len(w):
            pairs.append((r, i, a, b))
    pairs.sort(key=lambda p: (lens[p[1]], p[3] - p[2]))
    while pairs:
        take = max(1, CELLS // max(1, max(pairs[min(len(pairs), 512) - 1][3] - pairs[min(len(pairs), 512) - 1][2], 1)) // 8)
        some, pairs = pairs[: min(take, 512)], pairs[min(take, 512) :]
        best, start, end = align([block.words[i] for _, i, _, _ in some], [h[a:b] for _, _, a, b in some])
        for (r, i, a, _), score, s, e in zip(some, best.tolist(), start.tolist(), end.tolist()):
            if score >= needed(len(block.words[i]), least) * len(block.words[i]) - 1e-9:
                out[r].append((i, score / len(block.words[i]), a - int(offsets[r]) + s, e - s))
    return out


def match_column(text: Column, block: Block, least: float) -> Column:
    kind = pa.struct([("item_id", pa.string()), ("score", pa.float64()), ("first_word", pa.int64()), ("n_words", pa.int64())])
    names = [None if i is None else str(i) for i in block.ids]

    @F.arrow_udf("array<struct<item_id: string, score: double, first_word: bigint, n_words: bigint>>")
    def matches(texts: pa.Array) -> pa.Array:
        out = []
        for part in sliced(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            offsets, codes, words = word_tokens(alnum_only(part.column("text")))
            h = word_hashes(words)[codes] if len(codes) else np.zeros(0, np.uint64)
            out += find_in(block, h, offsets, least)
        rows = [[{"item_id": names[i], "score": s, "first_word": a, "n_words": n} for i, s, a, n in row] for row in out]
        return pa.array(rows, pa.list_(kind))

    # Not repeated below filters on its result, as the optimiser may do with a pure function.
    return matches.asNondeterministic()(text.cast("string"))


def match_columns(docs: DataFrame, items: DataFrame, text: str, item_text: str, item_id: str, least: float, block_words: int) -> Iterator[Column]:
    """The list of matches in a document, a column for each block of test items. A block is read, and its
    seeds are counted over all documents, when the column before it has been used."""
    id_type = items.schema[item_id].dataType.simpleString()
    kind = f"array<struct<item_id: {id_type}, score: double, first_word: bigint, n_words: bigint>>"
    for block in blocks(items, item_id, item_text, block_words):
        rare = rare_seeds(block, count_seeds(docs, text, block), least)
        yield match_column(F.col(text), rare, least).cast(kind)


def with_matches(docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id", least: float = 0.6, column: str = "matches", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with a list of (item_id, score, first_word, n_words): test items found in the text.

    Words are runs of ASCII letters (in lower case), digits and non-ASCII characters. ``score`` is the
    Smith-Waterman score against the item over that of the item with itself; pairs of at least
    ``least`` are reported, best place first for each region of the text. Items of fewer than 8 words
    must occur unchanged. Exact: each item drops only so many of its most frequent seeds that any
    passage of that score still holds one of the others. Test items are read in blocks of about
    ``block_words`` words, one after the other; each makes two passes over the documents, and between
    two of them the documents found so far are written, so that the driver and a task hold one block.
    Documents are never shuffled. Null and empty texts have an empty list, null and empty items match
    nothing, an item without an id is found under a null id, repeated rows are handled row by row, and
    without items every list is empty.
    """
    how = (text, item_text, item_id, least, block_words)
    found, first = None, True
    for matches in match_columns(docs, items, *how):
        if first:
            found, first = docs.withColumn(column, matches), False
        else:
            found = staged(found).withColumn(column, F.concat(column, matches))
    if found is None:
        id_type = items.schema[item_id].dataType.simpleString()
        return docs.withColumn(column, F.array().cast(f"array<struct<item_id: {id_type}, score: double, first_word: bigint, n_words: bigint>>"))
    return found


def contaminated(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_text: str = "text",
    item_id: str = "item_id", least: float = 0.6, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document and test item found in it: ``doc_id``, ``item_id``, the best ``score``, its
    ``first_word`` and ``n_words``, and the number of ``places``; ties go to the first place. Rows
    that share a doc_id, and items that share an item_id, also null ones, are one here. What is found
    by a block of items (see ``with_matches``) is written before the next block is read."""
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    parts, folder = [], f"{shared_folder(docs.sparkSession)}/tidemark-staged/{uuid4().hex}"
    for matches in match_columns(narrow, items, "text", item_text, item_id, least, block_words):
        for part in parts:  # a block came before: what it found is written
            part.write.mode("append").parquet(folder)
        parts = [narrow.select("doc_id", matches.alias("_found")).select("doc_id", F.inline("_found"))]
    found = parts[0] if parts else with_matches(narrow, items, "text", item_text, item_id, column="_found").select("doc_id", F.inline("_found"))
    if list_folder(docs.sparkSession, folder):
        found.write.mode("append").parquet(folder)
        found = docs.sparkSession.read.parquet(folder)
    best = F.struct("score", (-F.col("first_word")).alias("first"), "n_words")
    rows = found.groupBy("doc_id", "item_id").agg(F.max(best).alias("b"), F.count("*").alias("places"))
    return rows.select("doc_id", "item_id", F.col("b.score").alias("score"), (-F.col("b.first")).alias("first_word"), F.col("b.n_words").alias("n_words"), "places")


def drop_contaminated(
    docs: DataFrame, items: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
    least: float = 0.6, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """The documents in which no test item was found, all columns kept. Documents that a block of items
    leaves are written before the next block is read."""
    left, first = docs, True
    for matches in match_columns(docs, items, text, item_text, item_id, least, block_words):
        left = (left if first else staged(left)).withColumn("_matches", matches).where("size(_matches) = 0").drop("_matches")
        first = False
    return left

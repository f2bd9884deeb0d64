"""Language-model scores from a sharded Elias-Fano trie of n-grams."""

from __future__ import annotations

import os
import pickle
import tempfile
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import mixed, sliced, staged, word_hashes, word_tokens

#: Text in a block (scored together) and text per shard of the model, in bytes.
BLOCK_BYTES, SHARD_BYTES, LEAST_SHARDS = 6 << 20, 4 << 20, 8
#: Bits of an n-gram's key, and of the word before it relative to that n-gram.
KEY_BITS, LEFT_BITS = 48, 24
#: Words of a prior sample that the next shorter context may be worth, to two and to three words: the
#: pair is chosen under which training rows are likeliest, each token scored without its own occurrence.
PRIORS_2, PRIORS_3 = (20.0, 200.0, 2_000.0), (0.5, 2.0, 20.0, 200.0)
PRIORS = tuple((two, three) for two in PRIORS_2 for three in PRIORS_3)
#: Shards answered by one task, one after the other.
TASK_SHARDS = 4
START, END = np.uint64(0x5BD1E995A5A5A5A5), np.uint64(0x27D4EB2F165667C5)
BLOCK, WORDS, GRAMS = 0, 1, 2
LAYOUT = "block bigint, kind int, shard int, n bigint, data binary"
ZSTD = "zstd"


def pack(*arrays: np.ndarray) -> bytes:
    body = pickle.dumps([(a.dtype.str, a.tobytes()) for a in arrays])
    return len(body).to_bytes(8, "little") + pa.Codec(ZSTD).compress(body, asbytes=True)


def unpack(data: bytes) -> list[np.ndarray]:
    body = pa.Codec(ZSTD).decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)
    return [np.frombuffer(b, d) for d, b in pickle.loads(body)]


def quantised(counts: np.ndarray) -> np.ndarray:
    """Counts as 8-bit codes: exact to 127, then in steps of a fifth up to 2^40."""
    c = np.maximum(counts.astype(np.float64), 0)
    high = 128 + np.round(np.log2(np.maximum(c, 128) / 128) * (127 / 33))
    return np.where(c < 128, c, np.minimum(high, 255)).astype(np.uint8)


def restored() -> np.ndarray:
    """The count each code stands for."""
    return np.concatenate((np.arange(128.0), 128 * 2 ** (np.arange(128) * (33 / 127))))


class EliasFano:
    """A growing sequence of numbers below 2^bits: low bits in whole bytes, high bits in unary.

    The high part of element i sets bit (high + i); the zeros between end the buckets of equal high
    part. Finding zero number k by counting zeros a word at a time gives a bucket's range, the
    context's pointer pair, and the low parts in that range are searched for the successor. The arrays
    are written to a file and read through a memory map.
    """

    def __init__(self, values: np.ndarray, bits: int, low_bits: int, folder: str, name: str):
        self.low_bytes, self.low_bits = low_bits // 8, np.uint64(low_bits)
        buckets = 1 << (bits - low_bits)
        high = (values >> self.low_bits).astype(np.int64)
        upper = np.zeros(-(-(len(values) + buckets) // 64) * 64, np.uint8)
        upper[high + np.arange(len(values))] = 1
        words = np.packbits(upper, bitorder="little").view(np.uint64)
        zeros = np.concatenate(([0], np.cumsum(64 - np.bitwise_count(words).astype(np.int64))))
        low = values[:, None].view(np.uint8).reshape(-1, 8)[:, : self.low_bytes]
        self.size, self.buckets = len(values), buckets
        self.words, self.zeros, self.low = (mapped(a, folder, f"{name}.{i}") for i, a in enumerate((words, zeros, low)))

    def _zero(self, k: np.ndarray) -> np.ndarray:
        """Position of zero number k."""
        word = np.searchsorted(self.zeros, k, side="right") - 1
        rest = (k - self.zeros[word]).astype(np.int64)
        out = np.empty(len(k), np.int64)
        for at in range(0, len(k), 65_536):
            part = slice(at, at + 65_536)
            bits = np.unpackbits((~self.words[word[part]]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            out[part] = (np.cumsum(bits, axis=1, dtype=np.uint8) == (rest[part] + 1)[:, None]).argmax(1)
        return word * 64 + out

    def bounds(self, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First element and end of buckets."""
        end = self._zero(high) - high
        begin = np.where(high > 0, self._zero(np.maximum(high - 1, 0)) - (high - 1), 0)
        return begin, end

    def lows(self, at: np.ndarray) -> np.ndarray:
        out = np.zeros((len(at), 8), np.uint8)
        out[:, : self.low_bytes] = self.low[at]
        return out.view(np.uint64)[:, 0]

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Index of each (high, low), or -1: successor search among the low parts of the bucket."""
        if not self.size or not len(high):
            return np.full(len(high), -1)
        lo, end = self.bounds(high)
        hi = end.copy()
        while True:
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            less = self.lows(mid) < low[open_]
            lo[open_], hi[open_] = np.where(less, mid + 1, lo[open_]), np.where(less, hi[open_], mid)
        hit = (lo < end) & (self.lows(np.minimum(lo, self.size - 1)) == low)
        return np.where(hit, lo, -1)


def mapped(array: np.ndarray, folder: str, name: str) -> np.ndarray:
    array = np.ascontiguousarray(array)
    if not array.size:
        return array
    path = os.path.join(folder, name)
    array.tofile(path)
    return np.memmap(path, array.dtype, "r", shape=array.shape)


class Trie:
    """Two levels below the words: n-grams of two words by key, then the word left of each.

    The second level is one growing sequence of (node number, left word), so its high parts are node
    numbers and a node's children are one bucket, told apart by the left word alone. Nodes and
    children hold quantised counts.
    """

    def __init__(self, keys: np.ndarray, counts: np.ndarray, left: np.ndarray, left_counts: np.ndarray, folder: str):
        """``keys`` sorted; ``left`` sorted numbers (node << LEFT_BITS | left word)."""
        bits = max(int(len(keys)).bit_length(), 1)
        low = min(max((KEY_BITS - bits) // 8 * 8, 8), 40)
        self.low = np.uint64(low)
        self.nodes = EliasFano(keys, KEY_BITS, low, folder, "nodes")
        self.children = EliasFano(left, LEFT_BITS + bits, LEFT_BITS, folder, "children")
        self.codes = mapped(quantised(counts), folder, "codes"), mapped(quantised(left_counts), folder, "left_codes")

    def node(self, keys: np.ndarray) -> np.ndarray:
        return self.nodes.find((keys >> self.low).astype(np.int64), keys & ((np.uint64(1) << self.low) - np.uint64(1)))

    def code(self, node: np.ndarray) -> np.ndarray:
        return np.where(node >= 0, self.codes[0][np.maximum(node, 0)], 0).astype(np.uint8) if len(self.codes[0]) else np.zeros(len(node), np.uint8)

    def left_code(self, node: np.ndarray, left: np.ndarray) -> np.ndarray:
        out = np.zeros(len(node), np.uint8)
        known = np.flatnonzero(node >= 0)
        at = self.children.find(node[known], left[known])
        out[known[at >= 0]] = self.codes[1][at[at >= 0]] if len(self.codes[1]) else 0
        return out


def sequences(offsets: np.ndarray, codes: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per token, ends included: document number, word, word before, and the one before that."""
    docs = len(offsets) - 1
    first = offsets[:-1] + np.arange(docs)
    last = offsets[1:] + np.arange(docs)
    word = np.full(len(codes) + docs, END, np.uint64)
    inner = np.ones(len(word), bool)
    inner[last] = False
    word[inner] = hashes[codes]
    before = np.roll(word, 1)
    before[first] = START
    earlier = np.roll(before, 1)
    earlier[first] = START
    doc = np.repeat(np.arange(docs), np.diff(offsets) + 1)
    return doc, word, before, earlier


def gram_keys(word: np.ndarray, before: np.ndarray, earlier: np.ndarray):
    """Distinct two-word keys and (key number, left word) pairs of a block, each with its tokens."""
    key = mixed(before * np.uint64(0x9E3779B97F4A7C15) + word) >> np.uint64(64 - KEY_BITS)
    keys, at = np.unique(key, return_inverse=True)
    left = mixed(earlier) >> np.uint64(64 - LEFT_BITS)
    pairs, pair_at = np.unique((at.astype(np.uint64) << np.uint64(LEFT_BITS)) | left, return_inverse=True)
    return keys, at, pairs, pair_at


def shard_cuts(values: np.ndarray, bits: int, shards: int) -> np.ndarray:
    """Where the sorted values pass from one shard's range to the next."""
    edges = np.array([(i << bits) // shards for i in range(1, shards)], np.uint64)
    return np.concatenate(([0], np.searchsorted(values, edges), [len(values)])).astype(np.int64)


def narrow(counts: np.ndarray) -> np.ndarray:
    return counts.astype(np.uint8 if not len(counts) or counts.max() < 256 else np.uint64)


def make_blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """One row per block of documents: ids, which are held out, word codes and word hashes."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for whole in batches:
            for b in sliced(whole, "text", block_bytes):
                offsets, codes, words = word_tokens(b.column("text"))
                ids, held = b.column("doc_id"), b.column("held_out").to_numpy(zero_copy_only=False)
                data = pack(
                    ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), held, np.diff(offsets),
                    codes.astype(np.uint32), word_hashes(words),
                )
                tokens = int((np.diff(offsets) + 1)[~held].sum())
                yield pa.RecordBatch.from_arrays([pa.array([(part << 32) + number]), pa.array([BLOCK], pa.int32()), pa.array([int((~held).sum())], pa.int32()), pa.array([tokens]), pa.array([data], pa.binary())], ["block", "kind", "shard", "n", "data"])
                number += 1

    return docs.select("doc_id", "text", "held_out").mapInArrow(build, LAYOUT)


def opened(data: bytes):
    ids, null, held, sizes, codes, hashes = unpack(data)
    offsets = np.concatenate(([0], np.cumsum(sizes)))
    return ids, null, held, offsets, codes, hashes


def distinct_words(word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(word, return_inverse=True)


def key_rows(blocks: DataFrame, shards: int) -> DataFrame:
    """For every block and shard, the words and n-grams of the block that belong to the shard, with
    how often they stand in training documents: both what is counted and what is asked."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in zip(b.column("block").to_pylist(), b.column("data")):
                _, _, held, offsets, codes, hashes = opened(data.as_py())
                doc, word, before, earlier = sequences(offsets, codes, hashes)
                train = (~held[doc]).astype(np.float64)
                kinds, shard, out = [], [], []
                words, at = distinct_words(word)
                counts, cut = np.bincount(at, train, len(words)), shard_cuts(words, 64, shards)
                for s in np.flatnonzero(np.diff(cut)):
                    a, e = cut[s], cut[s + 1]
                    kinds.append(WORDS)
                    shard.append(s)
                    out.append(pack(words[a:e], narrow(counts[a:e])))
                del words, at, counts
                keys, at, pairs, pair_at = gram_keys(word, before, earlier)
                del word, before, earlier
                counts, cut = np.bincount(at, train, len(keys)), shard_cuts(keys, KEY_BITS, shards)
                pair_counts, node = np.bincount(pair_at, train, len(pairs)), (pairs >> np.uint64(LEFT_BITS)).astype(np.int64)
                children = np.bincount(node, minlength=len(keys))
                del at, pair_at, node
                child_cut = np.concatenate(([0], np.cumsum(children)))[cut]
                left = pairs[:, None].view(np.uint8).reshape(-1, 8)[:, : LEFT_BITS // 8]
                for s in np.flatnonzero(np.diff(cut)):
                    a, e, p, q = cut[s], cut[s + 1], child_cut[s], child_cut[s + 1]
                    steps = np.diff(keys[a:e], prepend=keys[a : a + 1])
                    steps[0] = keys[a]
                    columns = np.ascontiguousarray(steps[:, None].view(np.uint8).reshape(-1, 8)[:, : KEY_BITS // 8].T)
                    kinds.append(GRAMS)
                    shard.append(s)
                    out.append(pack(columns, narrow(counts[a:e]), narrow(children[a:e]), np.ascontiguousarray(left[p:q].T), narrow(pair_counts[p:q])))
                yield pa.RecordBatch.from_arrays([pa.array([block] * len(out), pa.int64()), pa.array(kinds, pa.int32()), pa.array(shard, pa.int32()), pa.array([0] * len(out), pa.int64()), pa.array(out, pa.binary())], ["block", "kind", "shard", "n", "data"])

    return blocks.mapInArrow(deal, LAYOUT)


def widened(columns: np.ndarray, rows: int, width: int) -> np.ndarray:
    out = np.zeros((rows, 8), np.uint8)
    out[:, :width] = columns.reshape(width, rows).T
    return out.view(np.uint64)[:, 0]


def answer_words(rows: list[list[np.ndarray]]) -> tuple[list[bytes], int]:
    """Exact training counts for every block's words, and how many distinct words have one."""
    words = np.concatenate([r[0] for r in rows])
    known, at = np.unique(words, return_inverse=True)
    counts = np.bincount(at, np.concatenate([r[1] for r in rows]).astype(np.float64), len(known))
    ends = np.cumsum([len(r[0]) for r in rows])[:-1]
    return [pack(c.astype(np.uint32 if c.max(initial=0) < 1 << 32 else np.uint64)) for c in np.split(counts[at], ends)], int((counts > 0).sum())


def answer_grams(rows: list[list[np.ndarray]]) -> list[bytes]:
    """Builds the shard's trie from all blocks' counts and looks every block's n-grams up in it."""
    sizes = [len(r[1]) for r in rows]
    keys = np.concatenate([np.cumsum(widened(r[0], n, KEY_BITS // 8), dtype=np.uint64) for r, n in zip(rows, sizes)])
    known, at = np.unique(keys, return_inverse=True)
    counts = np.bincount(at, np.concatenate([r[1] for r in rows]).astype(np.float64), len(known))
    trained = counts > 0
    number = np.cumsum(trained) - 1
    child = np.concatenate([np.repeat(np.arange(n), r[2].astype(np.int64)) + s for r, n, s in zip(rows, sizes, np.cumsum([0, *sizes[:-1]]))])
    left = np.concatenate([widened(r[3], len(r[4]), LEFT_BITS // 8) for r in rows])
    weight = np.concatenate([r[4] for r in rows]).astype(np.float64)
    use = weight > 0
    pairs, pair_at = np.unique((number[at[child[use]]].astype(np.uint64) << np.uint64(LEFT_BITS)) | left[use], return_inverse=True)
    pair_counts = np.bincount(pair_at, weight[use], len(pairs))
    del pair_at, use, weight
    with tempfile.TemporaryDirectory() as folder:
        trie = Trie(known[trained], counts[trained], pairs, pair_counts, folder)
        node = trie.node(known)[at]
        codes, left_codes = trie.code(node), trie.left_code(node[child], left)
        del trie
    ends, left_ends = np.cumsum(sizes)[:-1], np.cumsum([len(r[4]) for r in rows])[:-1]
    return [pack(a, b) for a, b in zip(np.split(codes, ends), np.split(left_codes, left_ends))]


def answer(key: tuple, group: pa.Table) -> pa.Table:
    _, kind, shard = (k.as_py() for k in key)
    rows = [unpack(d.as_py()) for d in group["data"]]
    data, distinct = answer_words(rows) if kind == WORDS else (answer_grams(rows), 0)
    blocks = group["block"].to_pylist()
    return pa.table({
        "block": pa.array([*blocks, -1], pa.int64()), "kind": pa.array([kind] * (len(blocks) + 1), pa.int32()),
        "shard": pa.array([shard] * (len(blocks) + 1), pa.int32()), "n": pa.array([0] * len(blocks) + [distinct], pa.int64()),
        "data": pa.array([*data, b""], pa.binary()),
    })


def likelihoods(one: np.ndarray, two: np.ndarray, three: np.ndarray, history: np.ndarray, longer: np.ndarray) -> Iterator[np.ndarray]:
    """Per pair of ``PRIORS`` the log10 probability of each token, from its probability as a word and the
    counts of its two- and three-word grams and of their contexts. Lowers counts above their context's in place."""
    np.minimum(two, history, out=two)
    np.minimum(three, longer, out=three)
    for prior_2 in PRIORS_2:
        by_two = (two + prior_2 * one) / (history + prior_2)
        for prior_3 in PRIORS_3:
            yield np.log10((three + prior_3 * by_two) / (longer + prior_3))


def score_block(tables: list[tuple[int, int, bytes]], tokens: int, distinct: int, documents: int) -> dict[str, np.ndarray]:
    """Scores of a block's documents under each pair of priors, from its own row and the shards' answers.
    ``fit`` is the same for training documents with every token's own occurrence taken out of the counts,
    0 for held-out ones."""
    parts: dict[int, list] = {BLOCK: [], WORDS: [], GRAMS: []}
    for kind, shard, data in sorted(tables, key=lambda r: r[:2]):
        parts[kind].append(data)
    ids, null, held, offsets, codes, hashes = opened(parts[BLOCK][0])
    doc, word, before, earlier = sequences(offsets, codes, hashes)
    _, at = distinct_words(word)
    count = np.concatenate([unpack(d)[0] for d in parts[WORDS]]).astype(np.float64)[at]
    _, key_at, _, pair_at = gram_keys(word, before, earlier)
    told, scale = [unpack(d) for d in parts[GRAMS]], restored()
    two = scale[np.concatenate([t[0] for t in told])[key_at]]
    three = scale[np.concatenate([t[1] for t in told])[pair_at]]
    del word, before, earlier, key_at, pair_at, told, at, codes, hashes, parts
    first = offsets[:-1] + np.arange(len(ids))
    history, longer = np.roll(count, 1), np.roll(two, 1)
    history[first] = longer[first] = documents
    total = tokens + 0.1 * (distinct + 1)
    one = (count + 0.1) / total
    add = lambda x: np.add.reduceat(x, first)
    scores = np.stack([add(x) for x in likelihoods(one, two, three, history, longer)], axis=1)
    out = {
        "doc_id": np.ma.array(ids, mask=null), "held_out": held, "n_tokens": np.diff(offsets) + 1,
        "n_known": add((count > 0).astype(np.int64)), "base_score": add(np.log10(one)), "scores": scores,
    }
    own = (~held[doc]).astype(np.float64)
    for counts in (count, two, three, history, longer):
        counts -= own
        np.maximum(counts, 0, out=counts)
    one = (count + 0.1) / max(total - 1, 0.1)
    out["fit"] = np.stack([add(x * own) for x in likelihoods(one, two, three, history, longer)], axis=1)
    return out


def score_documents(docs: DataFrame, held: Column, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (unigrams with exact counts) and ``score`` (log10 of the trigram model).

    Tokens are the words between ASCII white space, A-Z in lower case, then one end. The model learns
    from all rows where ``held`` is false. Each context length is mixed with the next shorter one as a
    prior of one weight, so probabilities of all words sum to one up to the quantisation of counts
    over 127. The weights are the pair of ``PRIORS`` under which all training tokens are likeliest when
    each is scored without its own occurrence (the first of equal pairs). Blocks of documents send their distinct words and n-grams, with counts, to the shard that
    owns each key; a shard adds the counts, builds its part of the trie and answers every block, so a
    frequent n-gram costs one entry per block, and no key, model or count table is ever whole in one
    place. Shards and blocks grow in number, not in size. Keys are hashes: of 48 bits for n-grams,
    whose rare collisions merge two counts, and of 64 bits for words. Null and empty texts are one end
    token; null ids and repeated rows are scored like any row; no rows give none.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), F.coalesce(held, F.lit(False)).alias("held_out"))
    blocks = staged(make_blocks(rows, block_bytes))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = max(LEAST_SHARDS, ceil(size / shard_bytes))
    asked = key_rows(blocks, shards).withColumn("task", F.expr(f"shard div {TASK_SHARDS}").cast("int"))
    dealt = asked.repartitionById(ceil(shards / TASK_SHARDS), "task")
    answers = staged(dealt.groupBy("task", "kind", "shard").applyInArrow(answer, LAYOUT))
    totals = blocks.agg(F.sum("n"), F.sum("shard")).first()
    tokens, documents = totals[0] or 0, totals[1] or 0
    distinct = answers.where("block < 0").agg(F.sum("n")).first()[0] or 0

    def score(group: pa.Table) -> pa.Table:
        got = score_block(list(zip(group["kind"].to_pylist(), group["shard"].to_pylist(), (d.as_py() for d in group["data"]))), tokens, distinct, documents)
        ids = got.pop("doc_id")
        lists = {k: pa.FixedSizeListArray.from_arrays(pa.array(got.pop(k).ravel()), len(PRIORS)).cast(pa.list_(pa.float64())) for k in ("scores", "fit")}
        return pa.table({"doc_id": pa.array(ids.data, pa.int64(), mask=np.asarray(np.ma.getmaskarray(ids))), **{k: pa.array(v) for k, v in got.items()}, **lists})

    together = blocks.unionByName(answers.where("block >= 0"))
    scored = staged(together.groupBy("block").applyInArrow(score, "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, scores array<double>, fit array<double>"))
    fits = scored.agg(*[F.sum(F.col("fit")[k]) for k in range(len(PRIORS))]).first()
    best = max(range(len(PRIORS)), key=lambda k: fits[k] or 0.0)
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score",
        F.col("scores")[best].alias("score"), F.lit(PRIORS[best][0]).alias("prior_2"), F.lit(PRIORS[best][1]).alias("prior_3"),
    )

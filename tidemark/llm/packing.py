"""Packing token ids into sequences of one length: descending by cost, cheapest sequence with room first."""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import sliced

#: Tokens of a sequence.
CAPACITY = 1024
#: Cost of n tokens that attend to one another: LINEAR * n + QUADRATIC * n * n. Relative floating-point
#: work of a layer of width 768: 24 * 768^2 a token, 4 * 768 a pair of tokens.
LINEAR, QUADRATIC = 4608, 1
#: Tokens packed together, about.
GROUP_TOKENS = 1 << 20
#: Characters given to the tokenizer at once.
CHUNK = 1 << 16
#: Where a text may be cut without a change of its ids: a run of letters ends at these characters.
BORDER = re.compile(r"(?<=[^\W\d_])(?=[\n !-&(-/:-?\[-`{-~])")


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """The text in parts of at least ``size`` characters, cut at borders between tokens only."""
    at = 0
    while len(text) - at > size:
        border = BORDER.search(text, at + size)
        if border is None:
            break
        yield text[at : border.start()]
        at = border.start()
    yield text[at:]


def ids_of(text: str, coder: tiktoken.Encoding, end: int) -> np.ndarray:
    """Token ids of a text and the ``end`` id after them."""
    parts = [np.array(coder.encode_ordinary(part), np.uint32) for part in chunks(text)]
    return np.concatenate([*parts, np.array([end], np.uint32)])


def capacities(tokens: int, capacity: int) -> np.ndarray:
    """Sequences that hold exactly so many tokens: as many whole ones as there can be, and the rest in
    sequences whose lengths are powers of two, which need no padding."""
    whole, rest = divmod(tokens, capacity)
    return np.array([capacity] * whole + [1 << b for b in reversed(range(capacity.bit_length())) if rest >> b & 1], np.int64)


def assign(lengths: list[int], rooms: np.ndarray, linear: int, quadratic: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece.

    Documents go in descending order, so by descending cost, each to the sequence of the lowest cost
    that has room for it. One that fits nowhere is cut: the sequence of the lowest cost with any room
    is filled up and the rest waits for its turn by its new length. ``rooms`` add up to ``lengths``.
    """
    room, used, cost = rooms.copy(), np.zeros(len(rooms), np.int64), np.zeros(len(rooms), np.int64)
    never = np.iinfo(np.int64).max
    waiting = [(-n, k, 0) for k, n in enumerate(lengths)]
    heapq.heapify(waiting)
    while waiting:
        left, k, start = heapq.heappop(waiting)
        n = -left
        to = int(np.where(room >= n, cost, never).argmin())
        if room[to] < n:
            to = int(np.where(room > 0, cost, never).argmin())
            heapq.heappush(waiting, (int(room[to]) - n, k, start + int(room[to])))
            n = int(room[to])
        yield k, start, n, to, int(used[to])
        room[to] -= n
        used[to] += n
        cost[to] += linear * n + quadratic * n * n


PIECES = ["start", "length", "ids", "doc_tokens", "sequence_id", "offset"]


def packed(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None, end: int = 0,
    capacity: int = CAPACITY, linear: int = LINEAR, quadratic: int = QUADRATIC, group_tokens: int = GROUP_TOKENS,
) -> DataFrame:
    """One row per piece: ``doc_id``, ``start`` (ids of the document before it), ``length``, ``ids``
    (unsigned 32-bit, little-endian), ``doc_tokens``, ``sequence_id`` and ``offset`` there.

    A document is the ids of its text and one ``end`` id; ``path`` is a vocabulary file of ranks. Whole
    sequences of a longer document are sequences of their own. What is left of it, less than
    ``capacity``, is packed with the rest of about ``group_tokens`` tokens read by one task, so texts
    never move between machines and a task holds one group. A group fills its sequences without a gap:
    all have ``capacity`` tokens but for at most one per smaller power of two.

    Null text is empty and has the ``end`` id alone. Null and repeated ids are kept as they are, each
    row is a document. A run of letters without a border is given to the tokenizer whole. An empty
    table gives no rows. Sequences are numbered by task and position, so a task that runs again on the
    same rows gives the same ones.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    assert capacity & (capacity - 1) == 0, "capacity is a power of two"

    def group(rests: list[tuple], first: int) -> tuple[list[tuple], int]:
        """Pieces (doc_id, start, ids, doc_tokens, sequence, offset) of the rests and the next number."""
        rooms = capacities(sum(len(r[2]) for r in rests), capacity)
        pieces = []
        for k, start, n, to, offset in assign([len(r[2]) for r in rests], rooms, linear, quadratic):
            doc, before, ids, total = rests[k]
            pieces.append((doc, before + start, ids[start : start + n], total, first + to, offset))
        return pieces, first + len(rooms)

    def pieces_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        coder = encoding(path)
        number = TaskContext.get().partitionId() << 40
        rests, held = [], 0
        for whole in batches:
            for batch in sliced(whole, "text"):
                for doc, body in zip(batch.column("doc_id"), batch.column("text")):
                    ids = ids_of(body.as_py() or "", coder, end)
                    for start in range(0, len(ids) - capacity + 1, capacity):
                        yield doc.as_py(), start, ids[start : start + capacity], len(ids), number, 0
                        number += 1
                    rest = len(ids) % capacity
                    if rest:
                        rests.append((doc.as_py(), len(ids) - rest, ids[len(ids) - rest :].copy(), len(ids)))
                        held += rest
                    if held >= group_tokens:
                        pieces, number = group(rests, number)
                        yield from pieces
                        rests, held = [], 0
        pieces, number = group(rests, number)
        yield from pieces

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(batches)
        while some := list(islice(pieces, 2048)):
            doc, start, ids, total, sequence, offset = zip(*some)
            lengths = pa.array([len(i) for i in ids], pa.int64())
            raw = pa.array([i.astype("<u4").tobytes() for i in ids], pa.binary())
            longs = [pa.array(column, pa.int64()) for column in (start, total, sequence, offset)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, kinds), longs[0], lengths, raw, longs[1], longs[2], longs[3]], ["doc_id", *PIECES])

    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    kind = narrow.schema["doc_id"].dataType
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}[kind.simpleString()]
    return narrow.mapInArrow(read, f"doc_id {kind.simpleString()}, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint")


def sequences(pieces: DataFrame, linear: int = LINEAR, quadratic: int = QUADRATIC) -> DataFrame:
    """The sequences to train on: ``sequence_id``, ``ids`` in order, ``lengths`` of the pieces (the
    blocks within which tokens attend to one another), their ``doc_ids`` and the ``cost``. A sequence
    has no more pieces than tokens, so a group stays small."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "length", "doc_id", "ids")))
    cost = F.sum(linear * F.col("length") + quadratic * F.col("length") * F.col("length"))
    rows = pieces.groupBy("sequence_id").agg(parts.alias("p"), cost.alias("cost"))
    joined = F.aggregate("p", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return rows.select("sequence_id", joined.alias("ids"), F.col("p.length").alias("lengths"), F.col("p.doc_id").alias("doc_ids"), "cost")

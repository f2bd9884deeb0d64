"""Pieces the operators share: reading tables, held-out rows, word tokens as arrays, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.staging import drop_staged, staged

__all__ = ["table", "staged", "drop_staged", "held_out", "word_tokens", "sliced", "gram_hashes", "mixed"]

#: Text handled at once inside a task; an Arrow batch is cut into pieces of about this size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a table; extra columns of any name are left behind."""
    return spark.read.parquet(f"{folder}/{name}.parquet").select(*columns)


def held_out(doc_id: str, parts: int) -> Column:
    """Whether crc32 of the id as text leaves remainder 0; a null id is hashed as empty text."""
    text = F.coalesce(F.col(doc_id).cast("string"), F.lit(""))
    return F.crc32(text.cast("binary")) % parts == 0


def sliced(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``limit`` bytes of text each, whole rows only."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes.astype(np.int64)) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


def word_tokens(text: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Words between ASCII white space, A-Z in lower case: (row offsets, codes, distinct words)."""
    low = pc.ascii_trim_whitespace(pc.fill_null(text.cast(pa.string()), ""))
    low = pc.ascii_lower(low) if lower else low
    lists = pc.ascii_split_whitespace(low)
    flat = lists.flatten()
    lens = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.equal(pc.binary_length(low), 0).to_numpy(zero_copy_only=False)
    if empty.any():  # empty text splits into one empty word
        flat = flat.filter(pc.greater(pc.binary_length(flat), 0))
        lens[empty] = 0
    coded = flat.dictionary_encode()
    words = [w.encode() for w in coded.dictionary.to_pylist()]
    offsets = np.zeros(len(lens) + 1, np.int64)
    np.cumsum(lens, out=offsets[1:])
    return offsets, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), words


def word_hashes(words: list[bytes], seed: int = 0) -> np.ndarray:
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(w, seed) for w in words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole 64-bit result."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def gram_hashes(h: np.ndarray, n: int, base: int = 0x9E3779B97F4A7C15) -> np.ndarray:
    """Hash of every run of ``n`` consecutive word hashes (none if there are fewer words)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    if n <= 8:
        out = h[: len(h) - n + 1].copy()
        for j in range(1, n):
            out = out * np.uint64(base) + h[j : len(h) - n + 1 + j]
        return mixed(out)
    size = len(h) + 1
    power = np.ones(size, np.uint64)
    power[1:] = np.cumprod(np.full(len(h), base, np.uint64))
    inverse = np.ones(size, np.uint64)
    inverse[1:] = np.cumprod(np.full(len(h), pow(base, -1, 1 << 64), np.uint64))
    sums = np.zeros(size, np.uint64)
    sums[1:] = np.cumsum(h * power[:-1])
    return mixed((sums[n:] - sums[:-n]) * inverse[: len(h) - n + 1])


#: ASCII other than letters and digits becomes a space, A-Z lower case, all other bytes stay.
ALNUM = bytes((c + 32 if 65 <= c <= 90 else c) if c > 127 or chr(c).isalnum() else 32 for c in range(256))


def alnum_only(text: pa.Array) -> pa.Array:
    """Text in which only ASCII letters in lower case, digits, spaces and non-ASCII characters are left."""
    text = pc.fill_null(text.cast(pa.string()), "")
    valid, offsets, data = text.buffers()
    if data is None:
        return text
    return pa.Array.from_buffers(pa.string(), len(text), [valid, offsets, pa.py_buffer(data.to_pybytes().translate(ALNUM))], offset=text.offset)

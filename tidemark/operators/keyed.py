"""A table kept in hash partitions of its key that split when they fill, rewritten only where touched.

A partition (bucket) ``d3b5`` holds the keys whose hash ends in the 3 bits of 5. One that grows beyond its
capacity gives way to buckets of more bits; the others, and their files, stay as they are (extendible
hashing). The directory of buckets is the list of partition folders. Rows without a key, which match
nothing, are appended to a bucket of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKET, NO_KEY = "_bucket", "nokey"
#: Rows of a bucket; one is split when it has more.
CAPACITY = 2_000_000
MOST_BITS = 40

Bucket = tuple[int, int]  # bits, their value


def name_of(bucket: Bucket) -> str:
    return f"d{bucket[0]}b{bucket[1]}"


def folder_of(bucket: Bucket) -> str:
    return f"{BUCKET}={name_of(bucket)}"


def parse(folders: Iterable[str]) -> list[Bucket]:
    found = (re.fullmatch(rf"{BUCKET}=d(\d+)b(\d+)", f) for f in folders)
    return sorted((int(m[1]), int(m[2])) for m in found if m)


def live(buckets: Iterable[Bucket]) -> list[Bucket]:
    """The buckets that hold the table. A split writes the new ones before it removes the old one, so
    after a crash both may be there: the old one counts until all of its range is covered by new ones."""
    present = set(buckets)
    above = {(b, value & (1 << b) - 1) for bits, value in present for b in range(bits)}

    def cover(bucket: Bucket) -> list[Bucket] | None:
        bits, value = bucket
        if bucket in above:
            halves = [cover((bits + 1, value)), cover((bits + 1, value | 1 << bits))]
            if None not in halves:
                return [b for half in halves for b in half]
        return [bucket] if bucket in present else None

    tops = [(bits, value) for bits, value in present if not any((b, value & (1 << b) - 1) in present for b in range(bits))]
    return sorted(b for top in tops for b in cover(top))


def hash_of(keys: Sequence[str]) -> Column:
    """Equal keys of different number types hash alike."""
    return F.xxhash64(*[F.col(k).cast("string") for k in keys])


def with_bucket(rows: DataFrame, keys: Sequence[str], buckets: Sequence[Bucket]) -> DataFrame:
    """``rows`` with the name of their bucket. The directory is one row per value of the longest bits."""
    bits = max(b for b, _ in buckets)
    listed = rows.sparkSession.createDataFrame([(name_of(b), b[0], b[1]) for b in buckets], f"{BUCKET} string, _bits int, _value bigint")
    step = F.pow(F.lit(2.0), F.col("_bits")).cast("long")
    slots = F.explode(F.sequence(F.col("_value"), F.lit((1 << bits) - 1).cast("long"), step))
    directory = listed.select(BUCKET, slots.alias("_slot"))
    slot = F.pmod(hash_of(keys), F.lit(1 << bits).cast("long"))
    return rows.withColumn("_slot", slot).join(directory, "_slot").drop("_slot")


def first_buckets(rows: int, capacity: int) -> list[Bucket]:
    """Buckets of equal bits for a new table, about half full."""
    bits = min(MOST_BITS, max(0, ceil(log2(max(1, 2 * rows / capacity)))))
    return [(bits, value) for value in range(1 << bits)]


def split(buckets: Sequence[Bucket], counts: dict[str, int], capacity: int) -> tuple[list[Bucket], list[Bucket]]:
    """The directory after a merge, and the buckets that gave way in it."""
    out, gone = [], []
    for bucket in buckets:
        bits, value = bucket
        rows = counts.get(name_of(bucket), 0)
        if rows <= capacity or bits >= MOST_BITS:
            out.append(bucket)
            continue
        gone.append(bucket)
        more = min(ceil(log2(2 * rows / capacity)), MOST_BITS - bits)
        out += [(bits + more, value | k << bits) for k in range(1 << more)]
    return sorted(out), gone

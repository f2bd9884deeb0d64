"""SimHash near-duplicates by covering locality-sensitive hashing."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import staged
from tidemark.llm.components import components
from tidemark.llm.shingles import hashed, kept_rows

BITS = 64
#: Buckets of up to this many fingerprints are compared pair by pair, larger ones through midpoints.
SMALL_BUCKET = 16


def simhash_of(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Fingerprint of one text: a bit is 1 if more than half of the shingle hashes have it."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    total, count, digest = np.zeros(BITS, np.int64), len(words) - width + 1, xxhash.xxh64_intdigest
    for at in range(0, count, 50_000):
        stop = min(count, at + 50_000)
        spans = zip(starts[at:stop].tolist(), ends[at + width - 1 : stop + width - 1].tolist())
        h = np.fromiter((digest(line[a:b], seed) for a, b in spans), np.uint64, stop - at)
        total += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * total > count, bitorder="little").view(np.uint64)[0])


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """SimHash of whole texts as a long; null and blank text give 0."""

    @F.arrow_udf("bigint")
    def simhash(texts: pa.Array) -> pa.Array:
        found = np.fromiter((simhash_of(t, shingle) for t in texts.to_pylist()), np.uint64, len(texts))
        return pa.array(found.view(np.int64), pa.int64())

    return simhash(text.cast("string"))


def covering_masks(radius: int) -> list[int]:
    """2^(radius+1) - 1 bit masks of which any ``radius`` differing bits leave at least one untouched.

    Every bit gets a nonzero vector of radius + 1 bits; mask v takes the bits whose vector has an odd
    inner product with v. The vectors of ``radius`` bits span less than the whole space, so a nonzero
    v is orthogonal to all of them and its mask holds none of these bits.
    """
    top = 1 << (radius + 1)
    vector = [i % (top - 1) + 1 for i in range(BITS)]
    return [sum(1 << i for i in range(BITS) if (vector[i] & v).bit_count() % 2) for v in range(1, top)]


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def near_links(prints: DataFrame, radius: int = 2, small_bucket: int = SMALL_BUCKET) -> DataFrame:
    """Edges (u, v) between distinct fingerprints (column ``fp``) that connect just those texts which
    differ in at most ``radius`` (1 or 2) bits, directly or in steps.

    Fingerprints that agree under a mask meet in a bucket. A small bucket is compared pair by pair. In
    a large one, two members are within two bits if and only if flipping at most one bit of each, out
    of those the mask leaves open, gives the same value; each member is tied to the smallest member
    with that value. A value has at most 65 members, so no bucket is ever paired out.
    """
    if radius not in (1, 2):
        raise ValueError("radius must be 1 or 2")
    masks = covering_masks(radius)
    keyed = prints.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(signed(m))) for m in masks])).alias("t", "key"))
    sizes = keyed.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    met = staged(keyed.join(sizes, ["t", "key"]))
    few = met.where(F.col("n") <= small_bucket)
    a, b = few.select("t", "key", F.col("fp").alias("u")), few.select("t", "key", F.col("fp").alias("v"))
    pairs = a.join(b, ["t", "key"]).where((F.col("u") > F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= radius))
    open_bits = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(signed(1 << i)) for i in range(BITS) if not m >> i & 1]) for m in masks])
    flipped = met.where(F.col("n") > small_bucket).select("fp", F.explode(F.element_at(open_bits, F.col("t") + 1)).alias("bit"))
    middles = flipped.select("fp", F.col("fp").bitwiseXOR(F.col("bit")).alias("middle")).distinct()
    if radius == 1:  # only a middle that is itself a member joins texts one bit apart
        middles = middles.join(prints.select(F.col("fp").alias("middle")), "middle", "left_semi")
    middles = staged(middles)
    least = middles.groupBy("middle").agg(F.min("fp").alias("v"))
    stars = middles.join(least, "middle").where("fp <> v").select(F.col("fp").alias("u"), "v")
    return pairs.select("u", "v").unionByName(stars)


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (long) and ``component_id``.

    ``component_id`` is the smallest id among all texts reachable by fingerprints within ``radius``
    bits. Equal fingerprints are folded to one before anything is compared. Null and blank texts have
    fingerprint 0 and link like any other. Rows that repeat keep one row each; a row without id takes
    part and gets its group's smallest id (null if no member has one). An empty table gives no rows.
    """
    marked = staged(docs.select(F.col(doc_id).alias("doc_id"), fingerprint(F.col(text), shingle).alias("fp")))
    prints = staged(marked.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(near_links(prints.select("fp"), radius)).withColumnRenamed("node", "fp")
    classed = prints.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = classed.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = staged(classed.join(named, "root").select("fp", "component_id"))
    return marked.join(classes, "fp").select("doc_id", "fp", "component_id")


def text_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """One row per distinct text: ``x`` (its hash, as in ``hashed``) and ``class``, equal for texts that
    fingerprints within ``radius`` bits connect, directly or in steps."""
    marked = staged(hashed(docs, doc_id, text).select("x", fingerprint(F.col("text"), shingle).alias("fp")).groupBy("x").agg(F.min("fp").alias("fp")))
    roots = components(near_links(marked.select("fp").distinct(), radius)).withColumnRenamed("node", "fp")
    return marked.join(roots, "fp", "left").select("x", F.coalesce("root", "fp").alias("class"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """The documents that stay: of each group the one with the smallest id, all columns kept.

    Rows that share id and text are one document; rows that share only the id are told apart by their
    texts. Rows without an id cannot be named by a group and stay.
    """
    marked = staged(hashed(docs, doc_id, text).select("doc_id", "x", fingerprint(F.col("text"), shingle).alias("node")))
    roots = components(near_links(marked.select(F.col("node").alias("fp")).distinct(), radius))
    least = marked.where("doc_id is not null").groupBy("node").agg(F.min(F.struct("doc_id", "x")).alias("least"))
    return kept_rows(docs, least, roots, doc_id, text)

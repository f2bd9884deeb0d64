"""Mixing sources to target weights by pivotal dependent rounding. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import staged

#: Documents whose fractions one task fold combines, on average; the fan-in of the reduction tree.
FAN_IN = 128
#: Documents of a source, on average, that are set aside to be decided last.
LAST = 32
#: Random draws in [0, 1) have so many steps.
DRAWS = 1 << 53


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def draw(*parts: Column) -> Column:
    """A number in [0, 1) fixed by its arguments, so that reruns agree."""
    return F.pmod(F.xxhash64(*parts), F.lit(DRAWS)) / F.lit(float(DRAWS))


def targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: float = 3.0) -> DataFrame:
    """``sizes`` (source, source_size) with ``target``: ``share`` of the total, dealt by weight, at
    most ``most`` times a source's size, what is above going to the others by weight.

    Sources take the weights in turn by code point, null last. Where the common level of size per
    weight ends is found from running sums over sources in order of ``most`` x size / weight: below the
    level a source is full. One row per source is ordered in one task; documents never are.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sizes.withColumn("weight", turn).withColumn("_top", F.lit(float(most)) * F.col("source_size"))
    order = Window.orderBy(F.col("_top") / F.col("weight"), F.col("source").isNull(), F.col("source").cast("binary"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    rows = rows.withColumns({
        "_full": F.coalesce(F.sum("_top").over(before), F.lit(0.0)),
        "_open": F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        "_want": F.sum("source_size").over(everything) * F.lit(float(share)),
    })
    # With all sources before this one full, the level the others reach; it holds at the first fit.
    level = F.greatest((F.col("_want") - F.col("_full")) / F.col("_open"), F.lit(0.0))
    rows = rows.withColumn("_level", F.when(level <= F.col("_top") / F.col("weight"), level))
    rows = rows.withColumn("_level", F.first("_level", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    reach = F.coalesce(F.col("_level") * F.col("weight"), F.col("_top"))
    return rows.select("source", "source_size", F.least("_top", reach).alias("target"))


def _fold(items: Column) -> Column:
    """Pairs the undecided documents of an array one after the other.

    An item has ``size`` words and an expected ``mass`` of them, 0 < mass < size. Two items pass mass
    between them at random, keeping the sum and each one's expectation, until one holds none or all of
    its words and is decided; the other goes on. At most one item is left undecided.
    """
    entry = lambda it, up: F.struct(it["id"].alias("id"), F.lit(up).alias("up"))

    def decided(acc: Column, it: Column, up: int, left: Column, mass: Column) -> Column:
        return F.struct(
            left["id"].alias("id"), left["size"].alias("size"), mass.alias("mass"),
            F.array_append(acc["done"], entry(it, up)).alias("done"),
        )

    def step(acc: Column, x: Column) -> Column:
        a, b, room_a, room_b = acc["mass"], x["mass"], acc["size"] - acc["mass"], x["size"] - x["mass"]
        gives, takes = F.least(a, room_b), F.least(room_a, b)  # what may pass to x, and from x
        return F.when(
            x["draw"] * (gives + takes) < takes,
            F.when(a <= room_b, decided(acc, acc, 0, x, a + b)).otherwise(decided(acc, x, 1, acc, a - room_b)),
        ).otherwise(
            F.when(room_a <= b, decided(acc, acc, 1, x, b - room_a)).otherwise(decided(acc, x, 0, acc, a + b))
        )

    first = items[0]
    none = F.array().cast("array<struct<id:struct<doc_id:bigint,key:bigint>,up:int>>")
    start = F.struct(first["id"].alias("id"), first["size"].alias("size"), first["mass"].alias("mass"), none.alias("done"))
    return F.aggregate(F.slice(items, 2, F.size(items)), start, step)


def _close(items: Column) -> Column:
    """Decides the last items of a source, largest first, so that their words come to the mass wanted.

    Each goes up with the share the mass still wanted has in the words still open, unless that is
    already more than wanted (then down) or the rest could no longer reach it (then up).
    """
    total = lambda name: F.aggregate(F.transform(items, lambda it: it[name]), F.lit(0.0), lambda a, x: a + x)
    none = F.array().cast("array<struct<id:struct<doc_id:bigint,key:bigint>,up:int>>")
    start = F.struct(total("mass").alias("want"), total("size").alias("open"), none.alias("done"))

    def step(acc: Column, x: Column) -> Column:
        up = F.when(x["size"] > acc["want"], 0).when(acc["open"] - x["size"] < acc["want"], 1).otherwise((x["draw"] * acc["open"] < acc["want"]).cast("int"))
        return F.struct(
            (acc["want"] - x["size"] * up).alias("want"), (acc["open"] - x["size"]).alias("open"),
            F.array_append(acc["done"], F.struct(x["id"].alias("id"), up.alias("up"))).alias("done"),
        )

    return F.aggregate(items, start, step, lambda acc: acc["done"])


def rounded(items: DataFrame, seed: int = 0, fan_in: int = FAN_IN, last: int = LAST) -> DataFrame:
    """(source, doc_id, key, up) for items (source, doc_id, key, size, mass) with 0 < mass < size:
    ``up`` is 1 for an item that takes all its words and 0 for one that takes none.

    Level by level, items of one source meet in groups of about ``fan_in``, each group decides all but
    one of its items, and these residuals meet in the next level. The last residual of a source meets
    about ``last`` items that were set aside (at most a quarter of the source), and these are decided
    largest first so that the source's words come to their sum but for the smallest items. Groups are
    dealt by hash and are as many as the source needs, so a source with a third of all rows is as
    spread as any.
    """
    left = items.select("source", F.struct("doc_id", "key").alias("id"), F.col("size").cast("double").alias("size"), "mass")

    def chance(level: int) -> Column:
        return draw(F.lit(seed), F.lit(level), F.col("id.key"), F.col("id.doc_id"))

    def counted(df: DataFrame) -> tuple[DataFrame, int]:
        per = staged(df.groupBy("source").agg(F.count("*").alias("_n")).withColumnRenamed("source", "_source"))
        return df.join(per, df["source"].eqNullSafe(per["_source"])).drop("_source"), per.agg(F.max("_n")).first()[0] or 0

    left, _ = counted(left)
    aside = F.pmod(F.xxhash64(F.lit(seed), "id.doc_id", "id.key"), F.greatest(F.lit(4).cast("long"), F.ceil(F.col("_n") / last))) == 0
    left = staged(left.withColumn("_aside", aside).drop("_n"))
    ends, left = left.where("_aside").drop("_aside"), left.where("not _aside").drop("_aside")
    done: list[DataFrame] = []
    level = 0
    while True:
        joined, largest = counted(left)
        if largest <= 1:
            break
        level += 1
        spread = F.pmod(F.xxhash64(F.lit(seed), F.lit(level), "id.doc_id", "id.key"), F.ceil(F.col("_n") / fan_in))
        packed = joined.select("source", spread.alias("_group"), F.struct(chance(2 * level).alias("order"), chance(2 * level + 1).alias("draw"), "id", "size", "mass").alias("it"))
        grouped = packed.groupBy("source", "_group").agg(F.array_sort(F.collect_list("it")).alias("items"))
        folded = staged(grouped.select("source", _fold(F.col("items")).alias("f")))
        done.append(folded.select("source", F.explode("f.done").alias("d")).select("source", "d.id", "d.up"))
        left = folded.select("source", "f.id", "f.size", "f.mass")
    largest_first = F.struct((-F.col("size")).alias("order"), chance(1).alias("draw"), "id", "size", "mass")
    closing = left.unionByName(ends).select("source", largest_first.alias("it")).groupBy("source").agg(F.array_sort(F.collect_list("it")).alias("items"))
    result = closing.select("source", F.explode(_close(F.col("items"))).alias("d")).select("source", "d.id", "d.up")
    for part in done:
        result = result.unionByName(part)
    return result.select("source", "id.doc_id", "id.key", "up")


#: Rows equal in id, source and text that one task unfolds.
SLOT_ROWS = 1024


def planned(docs: DataFrame, doc_id: str, text: str, source: str, weights: Sequence[float], share: float, most: int, seed: int) -> DataFrame:
    """One row per item, the rows that agree in id, source and text: ``doc_id``, ``source``, ``size``,
    ``key``, ``rows``, ``source_size``, ``target``, the ``base`` copies of each of its rows, and ``ups``,
    the number of its rows that take one more.

    Of ``n`` equal rows with a fraction f, floor(n f) go up for certain. What is left of n f is the
    fraction of one row, which the tree decides like any other document.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.xxhash64(text).alias("key"))
    items = staged(rows.groupBy("doc_id", "source", "size", "key").agg(F.count("*").alias("rows")))
    sums = items.groupBy("source").agg(F.sum(F.col("size") * F.col("rows")).alias("source_size"))
    wanted = staged(targets(sums, weights, share, most))
    named = wanted.withColumnRenamed("source", "_source")
    factor = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    plan = items.join(named, items["source"].eqNullSafe(named["_source"])).drop("_source").withColumn("factor", factor)
    many = (F.col("factor") - F.floor("factor")) * F.col("rows")
    plan = plan.withColumn("sure", F.when(F.col("size") > 0, F.floor(many)).otherwise(0).cast("long"))
    plan = plan.withColumn("part", many - F.floor(many))
    open_items = plan.where((F.col("size") > 0) & (F.col("part") > 0)).select("source", "doc_id", "key", F.col("size").cast("double").alias("size"), (F.col("part") * F.col("size")).alias("mass"))
    ups = rounded(staged(open_items), seed).where("up = 1").select(F.col("source").alias("_source"), F.col("doc_id").alias("_doc_id"), F.col("key").alias("_key"), "up")
    met = plan.join(
        ups, plan["doc_id"].eqNullSafe(ups["_doc_id"]) & (plan["key"] == ups["_key"]) & plan["source"].eqNullSafe(ups["_source"]), "left"
    )
    base = F.when(F.col("size") > 0, F.floor("factor")).otherwise(0).cast("long")
    return met.select(
        "doc_id", "source", "size", "key", "rows", "source_size", "target", base.alias("base"),
        (F.col("sure") + F.coalesce("up", F.lit(0))).alias("ups"),
    )


def unfolded(items: DataFrame) -> DataFrame:
    """``planned`` items as one row per document, with its ``copies``. Very many equal rows unfold in
    slots that are dealt over all tasks."""
    last = F.floor((F.col("rows") - 1) / SLOT_ROWS)
    once = items.where("rows = 1").withColumn("_number", F.lit(0).cast("long"))
    slots = items.where("rows > 1").withColumn("_slot", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    within = F.sequence(F.col("_slot") * SLOT_ROWS, F.least(F.col("_slot") * SLOT_ROWS + SLOT_ROWS, F.col("rows")) - 1)
    often = slots.repartition("key", "doc_id", "_slot").withColumn("_number", F.explode(within)).drop("_slot")
    copies = F.col("base") + (F.col("_number") < F.col("ups")).cast("long")
    return once.unionByName(often).withColumn("copies", copies).withColumn("taken", F.col("size") * F.col("copies"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id``, ``source``, ``size`` (words), ``source_size``, ``target``,
    ``copies``, ``taken`` (size x copies) and ``key`` (hash of the text).

    A source whose target is f times its size needs f copies of each of its documents: all take the
    whole part, and the fraction is rounded up or down by pivotal dependent rounding of the words, so
    that the words taken come to their sum but for the smallest documents. A document has at most ``most``
    copies. Documents without words take none. Rows that agree in id, source and text are documents
    each; which of them has a copy more is of no matter, as they are alike. Null text has size 0, null
    ids and sources are kept, ids are whole numbers or text of such, equal sizes need no order. The
    same rows and seed give the same mix. An empty table gives no rows.
    """
    found = unfolded(planned(docs, doc_id, text, source, weights, share, most, seed))
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", "taken", "key")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: Sequence[float] = (1, 2, 3), share: float = 1.0, most: int = 3, seed: int = 0) -> DataFrame:
    """The documents the mix takes, with all their columns and ``size``, ``copies``, ``taken`` and
    ``target``; documents of no copies are left out. Columns of these names are replaced. Rows that
    agree in id, source and text, of which some may have a copy more than others, all come with the
    other columns of one of them."""
    items = staged(planned(docs, doc_id, text, source, weights, share, most, seed))
    packed = docs.select(F.col(doc_id).cast("long").alias("_d"), F.col(source).alias("_s"), F.xxhash64(text).alias("_k"), F.struct(*docs.columns).alias("_row"))
    plain = [F.col("_row")[c].alias(c) for c in docs.columns if c not in ("size", "copies", "taken", "target")]

    def met(rows: DataFrame, found: DataFrame) -> DataFrame:
        chosen = found.where("copies > 0").select("doc_id", "source", "key", F.struct("size", "copies", "taken", "target").alias("_mix"))
        match = F.col("_d").eqNullSafe(F.col("doc_id")) & F.col("_s").eqNullSafe(F.col("source")) & (F.col("_k") == F.col("key"))
        # Neither side has a size bound: rows with texts meet the list by merging, at every size alike.
        return rows.join(chosen.hint("merge"), match).select(*plain, "_mix.*")

    alone = met(packed, unfolded(items.where("rows = 1")))
    if items.where("rows > 1").isEmpty():
        return alone
    return alone.unionByName(met(packed.dropDuplicates(["_d", "_s", "_k"]), unfolded(items.where("rows > 1"))))

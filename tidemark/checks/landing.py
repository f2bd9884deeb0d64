"""Queries of landed batches: what does not parse, the batch index, tables in partitions of their key."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.flow import LAST_SQL, UPSERT_SQL, _changes, _store, attempts
from tidemark.checks.registry import Tables, pages, query
from tidemark.operators import audit, batches, reconcile, rejects
from tidemark.operators.catalog import Catalog, Layout
from tidemark.operators.nested import stamp
from tidemark.operators.select import BATCH, is_empty, slice_by
from tidemark.operators.sinks import LEDGER
from tidemark.operators.staging import staged
from tidemark.plans import contracts, normalise
from tidemark.sources import fetch, incremental, ingest, tables

# -- rejects -------------------------------------------------------------------------------------

GOOD = """'{"contracts":[{"contractId":"' || o_orderkey || '","shipName":"' || o_orderstatus || '"},{"contractId":"0"}]}'"""
# Pages by kind: good, cut off, without the list, no list, odd records, blank, none, empty list.
PAGE_SQL = f"""CASE o_orderkey % 8 WHEN 0 THEN {GOOD} WHEN 1 THEN substr({GOOD}, 1, length({GOOD}) - 5)
  WHEN 2 THEN '{{"other":[]}}' WHEN 3 THEN '{{"contracts":' || o_custkey || '}}'
  WHEN 4 THEN '{{"contracts":[null,' || o_custkey || ',{{"contractId":"1"}}]}}' WHEN 5 THEN '  ' WHEN 7 THEN '{{"contracts":[]}}' END"""


@query(
    "rejected_pages",
    """SELECT CAST(o_orderkey AS VARCHAR) AS batch, 'not JSON' AS reason, 1 AS found FROM orders WHERE o_orderkey % 8 = 1
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'no list of records', 1 FROM orders WHERE o_orderkey % 8 IN (2, 3)
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'empty page', 1 FROM orders WHERE o_orderkey % 8 IN (5, 6)
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'null record', 1 FROM orders WHERE o_orderkey % 8 = 4
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'record is not an object', 1 FROM orders WHERE o_orderkey % 8 = 4
       UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'parsed', CASE o_orderkey % 8 WHEN 0 THEN 2 ELSE 1 END FROM orders WHERE o_orderkey % 8 IN (0, 4)""",
)
def rejected_pages(t: Tables) -> DataFrame:
    """A page per order, of eight kinds: records parsed, and pages and records rejected, by reason."""
    page = F.expr(PAGE_SQL)
    landed = t.orders.select(
        page.alias("Raw_data"), F.lit(None).cast("string").alias("Api_metadata"), F.col("o_orderkey").cast("string").alias(BATCH),
    )
    checked = contracts.checked_contracts(landed, ("header",))
    reason = F.coalesce("_reason", F.when(F.col("c").isNotNull(), F.lit("parsed")))
    return checked.groupBy(F.col(BATCH).alias("batch"), reason.alias("reason")).agg(F.count("*").cast("int").alias("found"))


@query(
    "rejected_batches",
    """SELECT 'n' || c_nationkey AS batch, CASE WHEN count(*) FILTER (c_custkey % 5 = 0) > 0 THEN 'partial' ELSE 'processed' END AS state,
         count(*) AS pages, count(*) FILTER (c_custkey % 5 <> 0) AS parsed, count(*) FILTER (c_custkey % 5 = 0) AS rejected
       FROM customer GROUP BY c_nationkey""",
)
def rejected_batches(t: Tables) -> DataFrame:
    """A batch per nation goes to silver, every fifth page broken: pages in are records out plus rejects."""
    store = _store(t)
    text = F.to_json(F.array(F.struct(F.col("c_custkey").alias("id"))))
    broken = F.when(F.col("c_custkey") % 5 == 0, F.substring(text, 1, 6)).otherwise(text)
    landed = t.customer.select(
        broken.alias("Raw_data"), F.lit(None).cast("string").alias("Api_metadata"), F.concat(F.lit("n"), "c_nationkey").alias(BATCH),
        F.lit(False).alias("_is_normalized"), F.lit("2024-01-31 00:00:00").cast("timestamp").alias("_ingestion_ts"),
    )
    store.append("pages", landed, partition_by=[BATCH])
    batches.recover(store, "pages")
    normalise.normalise_reviews(store, "pages", choose="all")
    count = lambda df, name: df.groupBy(F.col(BATCH).alias("batch")).agg(F.count("*").alias(name))
    found = batches.entries(store, "pages").select(F.col(BATCH).alias("batch"), "state", "pages")
    kept, lost = count(store.read("reviews"), "parsed"), count(store.read(normalise.REJECTED), "rejected")
    return found.join(kept, "batch", "left").join(lost, "batch", "left").na.fill(0)


# -- batch index -----------------------------------------------------------------------------------


def _landed(t: Tables):
    """Web pages landed in ten batches, of which three are done and one was superseded; every fourth page
    is no page to parse."""
    store = _store(t)
    number = F.col("page_id") % 10
    rows = t.pages.select(
        F.col("html").alias("Raw_data"), F.col("page_id"), (F.col("page_id") % 4 == 0).alias("_is_normalized"),
        F.concat(F.lit("b"), number).alias(BATCH), F.timestamp_seconds(F.lit(1_700_000_000) + (number * 7) % 10).alias("_ingestion_ts"),
    )
    store.append("pages", rows, partition_by=[BATCH])
    batches.recover(store, "pages")
    marks = t.spark.range(4).select(F.concat(F.lit("b"), "id").alias(BATCH), F.when(F.col("id") == 3, "superseded").otherwise("processed").alias("state"))
    store.mark_processed("pages", marks, state=F.col("state"))
    return store


INDEX_SQL = """SELECT 'b' || page_id % 10 AS batch, count(*) FILTER (page_id % 4 <> 0) AS pages,
  max(make_timestamp(1700000000000000 + ((page_id % 10) * 7) % 10 * 1000000)) FILTER (page_id % 4 <> 0) AS landed_at,
  CASE page_id % 10 WHEN 0 THEN 'processed' WHEN 1 THEN 'processed' WHEN 2 THEN 'processed' WHEN 3 THEN 'superseded' ELSE 'landed' END AS state
  FROM pages GROUP BY page_id % 10"""


@query("batch_index", INDEX_SQL)
def batch_index(t: Tables) -> DataFrame:
    found = batches.entries(_landed(t), "pages")
    return found.select(F.col(BATCH).alias("batch"), "pages", "landed_at", "state")


@query("batch_waiting", f"SELECT page_id FROM pages WHERE page_id % 4 <> 0 AND page_id % 10 > 3 AND page_id % 10 NOT IN (SELECT CAST(substr(batch, 2) AS INTEGER) FROM ({INDEX_SQL}) WHERE pages = 0)")
def batch_waiting(t: Tables) -> DataFrame:
    """The pages of all batches that wait, opened by the paths of their partitions."""
    return normalise.pages_to_do(_landed(t), "pages", "all").select("page_id")


@query("batch_newest", f"""SELECT page_id FROM pages WHERE page_id % 4 <> 0 AND 'b' || page_id % 10 =
  (SELECT batch FROM ({INDEX_SQL}) WHERE pages > 0 ORDER BY landed_at DESC, batch DESC LIMIT 1)""")
def batch_newest(t: Tables) -> DataFrame:
    """The pages of the newest batch, whether it is done or not, by the path of its partition."""
    store = _landed(t)
    top = [r[0] for r in batches.newest(batches.entries(store, "pages")).select(BATCH).collect()]
    return batches.read_batches(store, "pages", top).where("NOT _is_normalized").select("page_id")


# -- partitions of the key -------------------------------------------------------------------------


@query("upsert_keyed", UPSERT_SQL)
def upsert_keyed(t: Tables) -> DataFrame:
    """A merge into hash partitions of the key, small enough to split on the way."""
    target, source = _changes(t)
    store, how = _store(t), {"capacity": 400, "on_duplicate": "latest", "newest_by": ["version"]}
    store.merge_keyed("customers", target.where("c_custkey % 7 = 1"), ["c_custkey"], capacity=400)
    store.merge_keyed("customers", target.where("c_custkey % 7 <> 1"), ["c_custkey"], capacity=400)
    store.merge_keyed("customers", source, ["c_custkey"], **how)
    return store.read("customers").select("c_custkey", "c_name", "c_acctbal")


@query(
    "register_states",
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 2 ELSE 1 END AS teu FROM customer""",
)
def register_states(t: Tables) -> DataFrame:
    """The vessel register after two batches, the second with every third vessel."""
    store = _store(t)
    country = t.nation.select(F.col("n_name").alias("flag"), F.lit(None).cast("string").alias("mapped_flag"))
    for batch, rows in ((1, t.customer), (2, t.customer.where("c_custkey % 3 = 0"))):
        vessel = F.struct(F.col("c_custkey").cast("int").alias("vesselImo"), F.lit(batch).alias("vesselTeu"))
        page = F.struct(F.lit(1).alias("totalCount"), F.array(vessel).alias("results"))
        stamp = F.timestamp_seconds(F.lit(1_700_000_000 + batch))
        landed = pages(rows, page, batch=F.lit(f"b{batch}"), ts=stamp).withColumn("Api_metadata", F.lit('{"page_no": 1}'))
        batches.land(store, "axs", landed, f"b{batch}")
        normalise.normalise_vessels(store, "axs", country)
    assert store.read(LEDGER).count() == 2
    return store.read("vessel_register").select(F.col("imo").cast("bigint").alias("c_custkey"), "teu")


# -- marks -----------------------------------------------------------------------------------------


@query(
    "source_marks",
    """SELECT source, max(first) AS modified_since FROM (
         SELECT CAST(user_id AS VARCHAR) AS source, event_id % 7 AS batch, min(ts) AS first FROM events GROUP BY ALL)
       WHERE (source, batch) NOT IN (SELECT (CAST(user_id AS VARCHAR), event_id % 7) FROM events GROUP BY user_id, event_id % 7, day(ts)
         HAVING arg_max(event_type, event_id) IN ('error', 'view'))
       GROUP BY source""",
)
def source_marks(t: Tables) -> DataFrame:
    """Events as attempts of seven batches: each user's newest mark from a batch without a failed request."""
    tries = attempts(t).withColumn(BATCH, (F.col("attempt_number") % 7).cast("string"))
    return incremental.latest_marks(incremental.batch_marks(tries))


# -- tables by name --------------------------------------------------------------------------------


def _catalog(t: Tables) -> Catalog:
    return Catalog(t.spark, f"tidemark_{uuid4().hex}")


@query(
    "catalog_partitions",
    """SELECT o_orderkey, o_orderstatus, CASE o_orderstatus WHEN 'F' THEN NULL ELSE o_totalprice END AS o_totalprice,
         CASE o_orderstatus WHEN 'F' THEN o_orderpriority END AS o_orderpriority
       FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0""",
)
def catalog_partitions(t: Tables) -> DataFrame:
    """Orders by status, saved by name; then one status comes again, half as many and with other columns."""
    catalog, layout = _catalog(t), Layout(partition_by=["o_orderstatus"])
    catalog.append("orders", t.orders.select("o_orderkey", "o_totalprice", "o_orderstatus").where("o_orderkey % 3 = 0"), layout)
    catalog.append("orders", t.orders.select("o_orderstatus", "o_totalprice", "o_orderkey").where("o_orderkey % 3 <> 0"))
    again = t.orders.where("o_orderstatus = 'F' AND o_orderkey % 2 = 0").select("o_orderkey", "o_orderpriority", "o_orderstatus")
    catalog.replace_partitions("orders", again, layout, evolve=True)
    return catalog.read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")


@query(
    "catalog_bucketed_join",
    """SELECT o_orderkey, count(l_orderkey) AS line_count, sum(l_quantity) AS quantity FROM orders
       LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey""",
)
def catalog_bucketed_join(t: Tables) -> DataFrame:
    """Orders and lines, published by name in buckets of the order: joined and grouped without a shuffle."""
    catalog, buckets = _catalog(t), int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    layout = Layout(bucket_by=["o_orderkey"], buckets=buckets)
    catalog.replace("orders", t.orders.select("o_orderkey", "o_totalprice"), layout)
    catalog.replace("orders", catalog.read("orders").drop("o_totalprice"), layout)
    catalog.replace("lines", t.lineitem.select("l_orderkey", "l_quantity"), Layout(bucket_by=["l_orderkey"], buckets=buckets))
    orders, lines = catalog.read("orders"), catalog.read("lines").hint("merge")
    joined = orders.join(lines, F.col("l_orderkey") == F.col("o_orderkey"), "left")
    return joined.groupBy("o_orderkey").agg(F.count("l_orderkey").alias("line_count"), F.sum("l_quantity").alias("quantity"))


# -- counts ----------------------------------------------------------------------------------------


@query(
    "batch_reconciliation",
    """WITH p AS (SELECT c_nationkey AS n, c_custkey % 10 AS page, count(*) AS size FROM customer GROUP BY ALL),
         b AS (SELECT n, CAST(sum(size) FILTER (page <> 3) AS BIGINT) AS landed, count(*) FILTER (page <> 3) AS pages,
           CAST(sum(size) AS BIGINT) AS total, bool_or(page = 1) AS told, CAST(sum(CASE WHEN page = 7 AND n % 2 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS odd
           FROM p WHERE n % 3 <> 0 OR page <> 3 GROUP BY n)
       SELECT 'n' || n AS batch, CASE WHEN told THEN total END AS announced, coalesce(landed, 0) + odd AS landed, pages, coalesce(landed, 0) AS parsed, odd AS rejected,
         coalesce(landed, 0) AS published,
         CASE WHEN told AND coalesce(landed, 0) + odd < total THEN 'pages lost' WHEN odd > 0 THEN 'rejects' ELSE 'whole' END AS verdict
       FROM b WHERE pages > 0""",
)
def batch_reconciliation(t: Tables) -> DataFrame:
    """A batch of up to ten pages per nation; in two of three page 3 is lost, every second one has a record
    that is none. What was announced, landed, parsed, rejected and published, by batch."""
    store, page = _store(t), F.col("c_custkey") % 10
    key = F.col("c_nationkey")
    # A page of each nation and last digit: its customers, one JSON text each.
    sizes = t.customer.where((key % 3 != 0) | (page != 3)).groupBy(key.alias("n")).agg(F.count("*").alias("total"))
    record = F.to_json(F.struct(F.col("c_custkey").cast("string").alias("offhire_uuid")))
    rows = t.customer.where(page != 3).groupBy(key.alias("n"), page.alias("page")).agg(F.concat_ws(",", F.collect_list(record)).alias("held"))
    odd = F.when((F.col("page") == 7) & (F.col("n") % 2 == 0), ",5").otherwise("")
    body = F.concat(F.lit('{"totalCount":'), "total", F.lit(',"results":['), "held", odd, F.lit("]}"))
    landed = rows.join(sizes, "n").select(
        body.alias("Raw_data"), F.to_json(F.struct(F.col("page").alias("page_no"))).alias("Api_metadata"),
        F.lit(False).alias("_is_normalized"), F.concat(F.lit("n"), "n").alias(BATCH),
        F.lit("2024-01-31 00:00:00").cast("timestamp").alias("_ingestion_ts"),
    )
    store.append("pages", landed, partition_by=[BATCH])
    metrics = reconcile.page_metrics("$.results")
    told = store.read("pages").groupBy(BATCH).agg(*[c.alias(n) for n, c in metrics.items()])
    counts = told.unpivot([BATCH], list(metrics), "stage", "counted").withColumn("part", F.lit(""))
    reconcile.record_all(store, "pages", counts)
    reconcile.record_all(store, "pages", counts)  # what is written down twice counts once
    checked = staged(rejects.checked_records(store.read("pages"), "offhire_uuid string", "results"))
    silver = rejects.accepted(checked).select(BATCH, "c.offhire_uuid")
    store.replace("silver", silver)
    reconcile.record_all(store, "pages", reconcile.normalised(checked, {"silver": store.read("silver")}))
    return reconcile.reconcile(store, "pages").withColumnRenamed(BATCH, "batch")


# -- guards and gates ------------------------------------------------------------------------------


@query("failure_gate", f"SELECT source, page_no, CASE status WHEN 'FAILED' THEN 500 ELSE 200 END AS response_code FROM ({LAST_SQL}) WHERE status <> 'SUCCESS'")
def failure_gate(t: Tables) -> DataFrame:
    """The gate stops the run and leaves the list of what failed; it lets a run without failures pass."""
    store, tries = _store(t), attempts(t)
    audit.raise_on_failed(tries.where("status = 'SUCCESS'"), report=lambda failed: store.append("wrong", failed).path)
    try:
        audit.raise_on_failed(tries, report=lambda failed: store.append("failed", failed).path)
        found = audit.failed_requests(tries)
    except RuntimeError:
        found = store.read("failed")
    return found.select("source", "page_no", "response_code")


@query(
    "publish_together",
    """SELECT 'orders' AS name, o_orderkey AS key, o_totalprice + 1 AS amount FROM orders
       UNION ALL SELECT 'customers', c_custkey, c_acctbal + 1 FROM customer""",
)
def publish_together(t: Tables) -> DataFrame:
    """Two tables of one publication, beside an older one and one that ended between the two."""
    store = _store(t)
    orders = t.orders.select(F.lit("orders").alias("name"), F.col("o_orderkey").cast("bigint").alias("key"), F.col("o_totalprice").alias("amount"))
    customers = t.customer.select(F.lit("customers").alias("name"), F.col("c_custkey").cast("bigint").alias("key"), F.col("c_acctbal").alias("amount"))
    for more, fails in ((0, False), (1, False), (2, True)):
        try:
            with store.together() as group:
                group.replace("orders", orders.withColumn("amount", F.col("amount") + more))
                if fails:
                    raise InterruptedError
                group.replace("customers", customers.withColumn("amount", F.col("amount") + more))
        except InterruptedError:
            pass
    view = store.snapshot()
    return view.read("orders").unionByName(view.read("customers"))


@query(
    "guarded_tables",
    """SELECT 'orders' AS name, o_orderstatus AS status, true AS present, count(*) AS found FROM orders GROUP BY o_orderstatus
       UNION ALL SELECT 'orders', 'X', true, 0 UNION ALL SELECT 'no_such_table', NULL, false, 0""",
)
def guarded_tables(t: Tables) -> DataFrame:
    """Tables that are there are read, others passed over; a slice without rows is told from one with some."""
    rows = [("no_such_table", None, False, 0)]
    home = f"{t.folder}/orders.parquet"
    present = tables.table_exists(t.spark, home)
    assert not tables.table_exists(t.spark, f"{t.folder}/no_such_table.parquet")
    orders = tables.read_table(t.spark, home)
    if is_empty(slice_by(orders, "o_orderstatus", "X")):
        rows.append(("orders", "X", present, 0))
    guarded = tables.rows_to_df(t.spark, rows, "name string, status string, present boolean, found bigint")
    counts = orders.groupBy(F.col("o_orderstatus").alias("status")).agg(F.count("*").alias("found"))
    return guarded.unionByName(counts.select(F.lit("orders").alias("name"), "status", F.lit(present).alias("present"), "found"))


@query(
    "endpoint_requests",
    """SELECT 'nation:' || n_name AS source, 1 AS page_no, 'GET' AS http_method, 'https://x.test/' || n_nationkey AS api_url,
         CAST(NULL AS VARCHAR) AS input_value, CAST(NULL AS VARCHAR) AS request_body, TIMESTAMP '2024-06-01 00:00:00' AS _ingestion_ts FROM nation""",
)
def endpoint_requests(t: Tables) -> DataFrame:
    """First requests of a catalogue of endpoints, each with a table to land in, stamped with the load time."""
    catalogue = t.nation.select(F.concat(F.lit("nation:"), "n_name").alias("source"), F.concat(F.lit("https://x.test/"), "n_nationkey").alias("api_url"))
    seeds = fetch.seed(catalogue, F.col("source"), F.col("api_url"))
    ingest.require_tables(seeds, {"nation": "bronze_nation"})
    return stamp(seeds, F.lit("2024-06-01 00:00:00").cast("timestamp"))

"""Queries of page selection, lookups, fetch planning, audit and sink rules."""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.registry import Tables, as_of, dealt, pages, query
from tidemark.functions import scalars
from tidemark.functions.json import page_meta, to_json_text
from tidemark.operators import audit, batches, lookup, nested, pivot, select, sinks, skew
from tidemark.plans import normalise, ships
from tidemark.session import shared_folder
from tidemark.sources import fetch

# -- lookups -------------------------------------------------------------------------------------


@query(
    "country_lookup",
    """SELECT s_suppkey, CASE s_suppkey % 7 WHEN 0 THEN NULL ELSE
         CASE WHEN s_suppkey % 7 = 1 THEN 'Atlantis' WHEN n_regionkey = 0 THEN n_name
              ELSE n_name || ' flag' END END AS flag
       FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey""",
)
def country_lookup(t: Tables) -> DataFrame:
    """Suppliers under a flag: blank, unknown, known without a name, known with a name."""
    country = t.nation.select(
        F.col("n_name").alias("flag"),
        F.when(F.col("n_regionkey") != 0, F.concat("n_name", F.lit(" flag"))).alias("mapped_flag"),
    )
    api = (
        F.when(F.col("s_suppkey") % 7 == 0, F.lit(" "))
        .when(F.col("s_suppkey") % 7 == 1, F.lit("Atlantis"))
        .otherwise(F.concat(F.lit("NATION_"), F.col("s_nationkey")))
    )
    rows = t.supplier.select("s_suppkey", api.alias("vesselFlag"))
    found = lookup.country_lookup(rows, country, "vesselFlag", on_duplicate="error")
    return found.select("s_suppkey", "flag")


@query(
    "hull_to_imo",
    """SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN c_custkey + 5000000
         ELSE TRY_CAST(o_custkey AS BIGINT) END AS ship
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def hull_to_imo(t: Tables) -> DataFrame:
    dim = t.customer.where("c_custkey % 2 = 0").select(
        F.col("c_custkey").cast("string").alias("Hull_no"), (F.col("c_custkey") + 5_000_000).alias("imo")
    )
    rows = t.orders.select("o_orderkey", F.col("o_custkey").cast("string").alias("ship"))
    return lookup.resolve_id(rows, dim, "ship", "Hull_no", "imo")


@query(
    "composite_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
         CASE WHEN o_orderkey IS NOT NULL THEN o_orderpriority END AS fixture
       FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
         AND CAST(l_shipdate - INTERVAL 30 DAY AS DATE) = CAST(o_orderdate - INTERVAL 1200 MONTH + INTERVAL 1200 MONTH AS DATE)""",
)
def composite_lookup(t: Tables) -> DataFrame:
    """Lines whose order was placed 30 days before, the lookup's dates keyed a century early."""
    from tidemark.functions.dates import century_fix

    docs = t.orders.select(
        "o_orderkey", "o_orderpriority",
        F.add_months(F.col("o_orderdate").cast("date"), -1200).alias("keyed"),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    shipped = F.date_sub(F.col("l_shipdate").cast("date"), 30)
    return lookup.composite_lookup(
        rows, docs,
        [(F.col("l_orderkey"), F.col("o_orderkey")), (shipped, century_fix("keyed"))],
        {"fixture": "o_orderpriority"},
    ).drop("l_shipdate")


@query(
    "lookup_first",
    """SELECT s_suppkey, first_name FROM supplier LEFT JOIN
         (SELECT c_nationkey, min(c_name) AS first_name FROM customer GROUP BY c_nationkey)
       ON c_nationkey = s_nationkey""",
)
def lookup_first(t: Tables) -> DataFrame:
    """A lookup with many rows per key, of which the smallest counts."""
    side = lookup.unique_side(t.customer, ["c_nationkey"], ["c_name"], "first")
    found = lookup.composite_lookup(
        t.supplier.select("s_suppkey", "s_nationkey"), side,
        [(F.col("s_nationkey"), F.col("c_nationkey"))], {"first_name": "c_name"},
    )
    return found.drop("s_nationkey")


@query(
    "lookup_multiplies",
    "SELECT n_name, c_custkey FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey",
)
def lookup_multiplies(t: Tables) -> DataFrame:
    """Duplicate lookup keys multiply rows where no other policy is asked for."""
    side = lookup.unique_side(t.customer, ["c_nationkey"], ["c_custkey"])
    return lookup.composite_lookup(
        t.nation.select("n_name", "n_nationkey"), side,
        [(F.col("n_nationkey"), F.col("c_nationkey"))], {"c_custkey": "c_custkey"},
    ).drop("n_nationkey")


@query(
    "hot_key_join",
    """SELECT event_id, c_name FROM events LEFT JOIN customer
         ON c_custkey = CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN user_id END""",
)
def hot_key_join(t: Tables) -> DataFrame:
    """A third of all events under one key and a third under none, joined with salt."""
    key = F.expr("CASE WHEN event_id % 3 = 0 THEN 1 WHEN event_id % 3 = 1 THEN user_id END")
    left = t.events.select("event_id", key.alias("c_custkey"))
    right = t.customer.select("c_custkey", "c_name")
    return skew.left_join_unique(left, right, "c_custkey", hot_rows=200).select("event_id", "c_name")


# -- property lists ------------------------------------------------------------------------------


def property_pages(t: Tables) -> DataFrame:
    """One property list per order line: two properties each, kept under the supplier's number."""
    doc = F.expr(
        """named_struct('uuid', cast(l_orderkey as string), 'shipImoNr', l_suppkey,
          'lastUpdated', date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss"),
          'properties', array(
            named_struct('id', l_partkey % 30, 'title', CASE WHEN l_linenumber <> 7 THEN 't' END,
              'value', concat('v', l_partkey), 'isVerified', l_returnflag = 'A',
              'lastUpdated', date_format(l_shipdate, 'yyyy-MM-dd')),
            named_struct('id', (l_partkey + 1) % 30, 'title', 'u', 'value', l_linestatus,
              'isVerified', false, 'lastUpdated', date_format(l_shipdate, 'yyyy-MM-dd'))))"""
    )
    return pages(t.lineitem, doc)


def property_map(t: Tables) -> DataFrame:
    mapping = t.nation.select(
        F.col("n_nationkey").cast("string").alias("property_id"),
        F.regexp_replace("n_name", "_", " no. ").alias("crm_field"),
    )
    return pivot.with_fields(mapping, [f"NATION no. {i}" for i in range(25)])


LONG_SQL = """
SELECT l_suppkey AS ship, l_orderkey, l_shipdate, l_partkey % 30 AS pid, 'v' || l_partkey AS value,
  CAST(l_returnflag = 'A' AS INTEGER) AS verified, l_linenumber <> 7 AS titled FROM lineitem
UNION ALL SELECT l_suppkey, l_orderkey, l_shipdate, (l_partkey + 1) % 30, l_linestatus, 0, true
FROM lineitem
"""
FIELD_SQL = ", ".join(
    f'max(CASE WHEN pid = {i} THEN value END) AS "NATION_no__{i}"' for i in range(25)
)


@query(
    "pivot_properties",
    f"""SELECT CAST(ship AS VARCHAR) AS "shipImoNr", {FIELD_SQL}
        FROM ({LONG_SQL}) WHERE titled AND pid < 25 GROUP BY ship""",
)
def pivot_properties(t: Tables) -> DataFrame:
    base = pivot.map_properties(ships.ship_properties_long(property_pages(t)), property_map(t))
    return pivot.pivot_max(base, "shipImoNr", "crm_field", "value")


PIVOT_META_SQL = f"""
SELECT CAST(ship AS VARCHAR) AS "shipImoNr", {FIELD_SQL},
  max(CAST(l_orderkey AS VARCHAR)) AS uuid, max(l_shipdate) AS "lastUpdated",
  strftime(max(l_shipdate), '%Y-%m-%d') AS last_property_updated_at,
  max(verified) AS any_verified, 'batch-1' AS "_Batch_run_id"
FROM ({LONG_SQL}) WHERE titled AND pid < 25 GROUP BY ship
"""


@query("pivot_with_meta", PIVOT_META_SQL)
def pivot_with_meta(t: Tables) -> DataFrame:
    """Pivot and metadata as two aggregations and a join."""
    base = pivot.map_properties(ships.ship_properties_long(property_pages(t)), property_map(t))
    return pivot.attach_meta(
        pivot.pivot_max(base, "shipImoNr", "crm_field", "value"),
        pivot.group_meta(base, "shipImoNr"), "shipImoNr",
    )


@query("silver_ships_properties", PIVOT_META_SQL)
def silver_ships_properties(t: Tables) -> DataFrame:
    return ships.ship_properties(property_pages(t), property_map(t)).drop("_ingestion_ts")


# -- batch selection: events are landed pages, users are batches ------------------------------------


def bronze(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("props").alias("Raw_data"), "event_id",
        F.col("user_id").cast("string").alias("_Batch_run_id"),
        (F.col("event_type") == "view").alias("_is_normalized"), F.col("ts").alias("_ingestion_ts"),
    )


@query(
    "pending_rows", "SELECT event_id, props FROM events WHERE event_type <> 'view'"
)
def pending_rows(t: Tables) -> DataFrame:
    return select.pending(bronze(t)).select("event_id", F.col("Raw_data").alias("props"))


@query(
    "latest_row",
    """SELECT event_id, ts FROM events WHERE event_type <> 'view' ORDER BY ts DESC, event_id DESC LIMIT 1""",
)
def latest_row(t: Tables) -> DataFrame:
    top = select.latest_row(select.pending(bronze(t)), tie_break=["event_id"])
    return top.select("event_id", F.col("_ingestion_ts").alias("ts"))


@query(
    "latest_batch",
    """SELECT event_id, ts FROM events WHERE event_type <> 'view' AND user_id =
         (SELECT user_id FROM events WHERE event_type <> 'view'
          ORDER BY ts DESC, CAST(user_id AS VARCHAR) DESC LIMIT 1)""",
)
def latest_batch(t: Tables) -> DataFrame:
    rows = select.latest_batch(select.pending(bronze(t)))
    return rows.select("event_id", F.col("_ingestion_ts").alias("ts"))


@query(
    "pending_after_mark",
    """SELECT event_id FROM events WHERE event_type <> 'view' AND user_id NOT IN
         (SELECT user_id FROM events WHERE event_type = 'purchase' AND value > 100)""",
)
def pending_after_mark(t: Tables) -> DataFrame:
    """Users with a large purchase are the batches already written down."""
    done = t.events.where("event_type = 'purchase' AND value > 100").select(
        F.col("user_id").cast("string").alias("_Batch_run_id")
    )
    return select.all_pending(bronze(t), done).select("event_id")


@query(
    "mark_processed_flag",
    "SELECT event_id, event_type = 'view' OR user_id % 2 = 0 AS done FROM events",
)
def mark_processed_flag(t: Tables) -> DataFrame:
    even = F.col("_Batch_run_id").cast("bigint") % 2 == 0
    marked = sinks.mark_flag(bronze(t), even & ~F.col("_is_normalized"))
    return marked.select("event_id", F.col("_is_normalized").alias("done"))


@query(
    "distinct_accounts",
    "SELECT DISTINCT o_custkey, o_orderstatus FROM orders",
)
def distinct_accounts(t: Tables) -> DataFrame:
    return select.distinct_rows(t.orders, "o_custkey", "o_orderstatus")


@query(
    "fan_out_keys",
    """SELECT DISTINCT CASE WHEN user_id % 10 <> 0 THEN CAST(user_id % 50 AS VARCHAR)
         ELSE event_type END AS input_value
       FROM events WHERE user_id % 7 <> 0 AND (user_id % 10 = 0 OR user_id % 50 <> 0)""",
)
def fan_out_keys(t: Tables) -> DataFrame:
    known = t.events.select(
        F.expr("CASE WHEN user_id % 7 = 0 THEN NULL WHEN user_id % 10 = 0 THEN 0 ELSE user_id % 50 END")
        .alias("imoNr"),
        F.col("event_type").alias("provisionalId"),
    )
    return fetch.fan_out_keys(known)


@query(
    "in_force",
    """SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'O'
         OR o_orderdate <= TIMESTAMP '1998-06-01'""",
)
def in_force(t: Tables) -> DataFrame:
    period = F.expr("CASE o_orderstatus WHEN 'F' THEN 'past' WHEN 'O' THEN 'ongoing' ELSE 'upcoming' END")
    kept = select.in_force(t.orders, period, F.col("o_orderdate").cast("timestamp"), as_of())
    return kept.select("o_orderkey")


@query(
    "latest_per_key",
    """SELECT user_id, max(ts) AS ts, arg_max(event_type, ts) AS event_type FROM events GROUP BY user_id""",
)
def latest_per_key(t: Tables) -> DataFrame:
    return sinks.one_per_key(t.events.select("user_id", "ts", "event_type"), ["user_id"], "latest", ["ts"])


@query("max_where", "SELECT max(ts) AS ts FROM events WHERE event_type = 'purchase'")
def max_where(t: Tables) -> DataFrame:
    return select.max_where(t.events, "ts", F.col("event_type") == "purchase")


@query(
    "json_text",
    """SELECT o_orderkey, CAST(json_object('key', o_orderkey, 'status', o_orderstatus, 'note',
         CASE WHEN o_orderkey % 2 = 0 THEN o_orderpriority END) AS VARCHAR) AS doc FROM orders""",
)
def json_text(t: Tables) -> DataFrame:
    note = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderpriority"))
    doc = to_json_text(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), note.alias("note")
    )
    return t.orders.select("o_orderkey", doc.alias("doc"))


# -- fetch planning --------------------------------------------------------------------------------

TOTALS = "SELECT o_custkey, count(*) AS total FROM orders GROUP BY o_custkey"


@query(
    "page_plan",
    f"""SELECT o_custkey, page_no, CAST(ceil(total / 5.0) AS INTEGER) AS total_pages,
          '1998-06-01 00:00:00' AS modified_since
        FROM ({TOTALS}), range(2, 1000) AS r(page_no) WHERE page_no <= ceil(total / 5.0)""",
)
def page_plan(t: Tables) -> DataFrame:
    """Orders per customer as the total the first page reports, five to a page."""
    first = t.orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"))
    plan = fetch.plan_pages(first, 5, "total", modified_since="1998-06-01 00:00:00")
    return plan.select("o_custkey", "page_no", "total_pages", "modified_since")


@query(
    "fan_out_requests",
    """SELECT DISTINCT 'props:' || o_custkey AS source, CAST(1 AS INTEGER) AS page_no, 'GET' AS http_method,
         'https://x.test/ships/' || o_custkey || '/properties' AS api_url,
         CAST(o_custkey AS VARCHAR) AS input_value, CAST(NULL AS VARCHAR) AS request_body
       FROM orders WHERE o_custkey <> 0""",
)
def fan_out_requests(t: Tables) -> DataFrame:
    """One request per customer with an order."""
    known = t.orders.select(F.col("o_custkey").alias("imoNr"), F.lit(None).cast("string").alias("provisionalId"))
    return fetch.fan_out(fetch.fan_out_keys(known), "https://x.test/ships/{}/properties", "props")


@query(
    "page_label",
    """SELECT page_id, CASE WHEN page_id % 3 = 0 THEN '' ELSE page_id || '-' END
         || CAST(CAST(ceil(length(html) / 200.0) AS BIGINT) AS VARCHAR) AS label FROM pages""",
)
def page_label(t: Tables) -> DataFrame:
    no = F.when(F.col("page_id") % 3 != 0, F.col("page_id"))
    meta = page_meta(F.to_json(F.struct(F.lit("SUCCESS").alias("Status"), no.alias("page_no"))))
    label = scalars.concat_skip("-", meta["page_no"], scalars.page_count(F.length("html"), 200))
    return t.pages.select("page_id", label.alias("label"))


@query(
    "sentinel_pages",
    "SELECT doc_id FROM documents WHERE doc_id % 5 = 0 AND length(text) < 200",
)
def sentinel_pages(t: Tables) -> DataFrame:
    total = F.when(F.col("doc_id") % 5 == 0, F.lit(-1)).otherwise(F.length("text"))
    return t.documents.where(audit.is_sentinel(total, F.col("text"))).select("doc_id")


LINES = "string_split(text, chr(10))"
LONGER = f"list_filter({LINES}, lambda x: length(x) > 60)"


def line_pages(t: Tables, longer_than: int = -1) -> DataFrame:
    """Documents as pages whose records are their lines, or the longer ones of them."""
    lines = F.filter(F.split("text", "\n"), lambda x: F.length(x) > longer_than)
    return dealt(t.documents).select(
        "doc_id", F.to_json(F.struct(F.size(lines).alias("totalCount"), lines.alias("results")))
        .alias("Raw_data"),
    )


@query("non_empty_pages", f"SELECT doc_id FROM documents WHERE len({LONGER}) > 0")
def non_empty_pages(t: Tables) -> DataFrame:
    """Some documents have no longer line, so their pages are empty."""
    return audit.non_empty(line_pages(t, 60), "Raw_data", "$.results").select("doc_id")


@query("page_record_counts", f"SELECT doc_id, CAST(len({LINES}) AS BIGINT) AS records FROM documents")
def page_record_counts(t: Tables) -> DataFrame:
    return audit.page_record_counts(line_pages(t), "$.results", ["doc_id"])


def attempts(t: Tables) -> DataFrame:
    """Events as attempts of the request (user, day), numbered by their id."""
    return t.events.select(
        F.col("user_id").cast("string").alias("source"), F.dayofmonth("ts").alias("page_no"),
        F.lit("GET").alias("http_method"),
        F.concat(F.lit("https://x.test/p?token="), "event_type", F.lit("&n="), "event_id").alias("api_url"),
        F.lit(None).cast("string").alias("input_value"),
        F.concat(F.lit('{"token": "t'), "event_id", F.lit('", "page": 1}')).alias("request_body"),
        F.col("event_id").cast("int").alias("attempt_number"),
        F.col("ts").alias("request_timestamp"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("response_code"),
        F.concat(F.col("props"), F.lit(' {"access_token":"s'), "event_id", F.lit('"}')).alias("response_body"),
        F.floor(F.col("value") * 100).cast("bigint").alias("duration_ms"),
        F.when(F.col("event_type") == "error", "FAILED").when(F.col("event_type") == "view", "RETRY")
        .otherwise("SUCCESS").alias("status"),
        F.lit(None).cast("string").alias("error_message"),
    )


STATUS_SQL = "CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RETRY' ELSE 'SUCCESS' END"
LAST_SQL = f"""
SELECT CAST(user_id AS VARCHAR) AS source, CAST(day(ts) AS INTEGER) AS page_no,
  count(*) AS attempts, arg_max({STATUS_SQL}, event_id) AS status,
  arg_max(CASE WHEN event_type = 'error' THEN 500 ELSE 200 END, event_id) AS response_code
FROM events GROUP BY user_id, day(ts)
"""


@query("attempt_status", LAST_SQL)
def attempt_status(t: Tables) -> DataFrame:
    return audit.final_attempt(attempts(t))


@query("failed_pages", f"SELECT source, page_no, attempts FROM ({LAST_SQL}) WHERE status <> 'SUCCESS'")
def failed_pages(t: Tables) -> DataFrame:
    return audit.failed_requests(attempts(t)).select("source", "page_no", "attempts")


@query(
    "source_status",
    f"""SELECT source, ok, failed, ok AS landed, CASE WHEN failed > 0 AND ok > 0 THEN 'PARTIAL'
          WHEN failed > 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status
        FROM (SELECT source, count(*) FILTER (status = 'SUCCESS') AS ok,
                count(*) FILTER (status <> 'SUCCESS') AS failed FROM ({LAST_SQL}) GROUP BY source)""",
)
def source_status(t: Tables) -> DataFrame:
    return audit.source_status(attempts(t).withColumn("response_body", F.lit('[{"a": 1}]')))


AUDIT_SQL = f"""
SELECT 'run-' || user_id AS batch_run_id, 'REST' AS api_type, 'GET' AS http_method,
  'https://x.test/p?token=***&n=' || event_id AS api_url, CAST(NULL AS VARCHAR) AS input_value,
  '{{"token": "***", "page": 1}}' AS request_body, CAST(event_id AS INTEGER) AS attempt_number,
  ts AS request_timestamp, CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS response_code,
  {{body}} AS response_body, CAST(floor(value * 100) AS BIGINT) AS duration_ms,
  {STATUS_SQL} AS status, CAST(NULL AS VARCHAR) AS error_message,
  CAST(NULL AS VARCHAR) AS execution_context
FROM events
"""
MASKED = """props || ' {"access_token":"***"}'"""


def _audit(t: Tables, **how) -> DataFrame:
    batch = F.concat(F.lit("run-"), F.col("source"))
    return audit.attempts_to_audit(attempts(t), batch, **how).drop("EventID")


@query("redact_audit", AUDIT_SQL.replace("{body}", MASKED))
def redact_audit(t: Tables) -> DataFrame:
    return _audit(t, body_chars=None)


@query("audit_truncate", AUDIT_SQL.replace("{body}", f"substr({MASKED}, 1, 20)"))
def audit_truncate(t: Tables) -> DataFrame:
    return _audit(t, body_chars=20)


@query(
    "audit_flatten",
    f"""SELECT CAST(user_id AS VARCHAR) AS source, k AS attempt_number,
          CASE WHEN k = 3 THEN 'SUCCESS' ELSE 'RETRY' END AS status, event_id
        FROM events, range(1, 4) AS r(k) WHERE k <= 1 + event_id % 3""",
)
def audit_flatten(t: Tables) -> DataFrame:
    """Results that bring their attempts along, one to three each."""
    results = t.events.select(
        F.col("user_id").cast("string").alias("source"), "event_id",
        F.expr(
            """transform(sequence(1, cast(1 + event_id % 3 as int)), k -> named_struct(
                 'attempt_number', k, 'status', if(k = 3, 'SUCCESS', 'RETRY')))"""
        ).alias("attempts"),
    )
    return audit.explode_attempts(results)


@query(
    "audit_summary",
    """SELECT 'REST' AS api_type, CASE event_type WHEN 'error' THEN 'FAILED' WHEN 'view' THEN 'RETRY'
         ELSE 'SUCCESS' END AS status, count(*) AS attempts,
         min(CAST(floor(value * 100) AS BIGINT)) AS min_ms, max(CAST(floor(value * 100) AS BIGINT)) AS max_ms,
         CAST(sum(CAST(floor(value * 100) AS BIGINT)) AS BIGINT) AS total_ms FROM events GROUP BY 2""",
)
def audit_summary(t: Tables) -> DataFrame:
    return audit.audit_summary(_audit(t))


@query(
    "high_water_mark",
    "SELECT max(ts) AS modified_since FROM events WHERE event_type NOT IN ('error', 'view')",
)
def high_water_mark(t: Tables) -> DataFrame:
    return audit.high_water_mark(t.spark, _audit(t), strict=False)


@query(
    "high_water_mark_strict",
    """SELECT coalesce(max(ts), TIMESTAMP '1900-02-09 12:15:03') AS modified_since FROM events
       WHERE event_type NOT IN ('error', 'view') AND user_id NOT IN
         (SELECT user_id FROM events GROUP BY user_id HAVING
            arg_max(event_type, event_id) IN ('error', 'view'))""",
)
def high_water_mark_strict(t: Tables) -> DataFrame:
    """Only users whose last attempt ended well count."""
    log = _audit(t).withColumns({"api_url": F.lit("u"), "request_body": F.lit("b")})
    return audit.high_water_mark(t.spark, log)


@query(
    "bronze_pages",
    """SELECT html AS "Raw_data", 'SUCCESS' AS "Status", 200 AS "HttpStatus",
         CAST(page_id AS INTEGER) AS page_no, '2024-01-02T03:04:05.000000' AS "Timestamp", false AS "_is_normalized",
         'b' || page_id % 3 AS "_Batch_run_id" FROM pages WHERE page_id % 4 <> 0""",
)
def bronze_pages(t: Tables) -> DataFrame:
    return _bronze(t, keep_failures=False)


@query(
    "bronze_sentinel",
    """SELECT html AS "Raw_data", CASE WHEN page_id % 4 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS "Status",
         CASE WHEN page_id % 4 = 0 THEN 503 ELSE 200 END AS "HttpStatus",
         CAST(page_id AS INTEGER) AS page_no, '2024-01-02T03:04:05.000000' AS "Timestamp", page_id % 4 = 0 AS "_is_normalized",
         'b' || page_id % 3 AS "_Batch_run_id" FROM pages""",
)
def bronze_sentinel(t: Tables) -> DataFrame:
    return _bronze(t, keep_failures=True)


def _bronze(t: Tables, keep_failures: bool) -> DataFrame:
    """Web pages as fetched pages; every fourth request failed."""
    failed = F.col("page_id") % 4 == 0
    got = t.pages.select(
        F.col("page_id").cast("int").alias("page_no"), F.col("url").alias("input_value"),
        F.col("html").alias("response_body"),
        F.when(failed, 503).otherwise(200).alias("response_code"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("request_timestamp"),
        F.lit(None).cast("string").alias("error_message"),
    )
    batch = F.concat(F.lit("b"), (F.col("page_no") % 3).cast("string"))
    landed = audit.to_bronze(got, batch, F.col("request_timestamp"), keep_failures)
    meta = page_meta("Api_metadata")
    return landed.select(
        "Raw_data", meta["Status"].alias("Status"), meta["HttpStatus"].alias("HttpStatus"),
        meta["page_no"].alias("page_no"), meta["Timestamp"].alias("Timestamp"), "_is_normalized",
        "_Batch_run_id",
    )


# -- sinks ---------------------------------------------------------------------------------------


def _changes(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Four fifths of the customers in a table; the rest, and a third of all, come in, each one twice."""
    rows = t.customer.select("c_custkey", "c_name", "c_acctbal")
    change = rows.where("c_custkey % 3 = 0 OR c_custkey % 5 = 0")
    newer = change.withColumns({"c_acctbal": F.col("c_acctbal") + 1, "version": F.lit(2)})
    return rows.where("c_custkey % 5 <> 0"), change.withColumn("version", F.lit(1)).union(newer)


UPSERT_SQL = """SELECT c_custkey, c_name, CASE WHEN c_custkey % 3 = 0 OR c_custkey % 5 = 0
  THEN c_acctbal + 1 ELSE c_acctbal END AS c_acctbal FROM customer"""


@query("upsert_merge", UPSERT_SQL)
def upsert_merge(t: Tables) -> DataFrame:
    target, source = _changes(t)
    return sinks.upsert(target, source, ["c_custkey"], "latest", ["version"]).drop("version")


def _store(t: Tables) -> sinks.Store:
    return sinks.Store(t.spark, f"{shared_folder(t.spark)}/tidemark-staged/checks-{uuid4().hex}")


@query("upsert_slots", UPSERT_SQL)
def upsert_slots(t: Tables) -> DataFrame:
    """The same merge into a stored table kept in hash slots of the key."""
    target, source = _changes(t)
    store = _store(t)
    store.merge_slots("customers", target, ["c_custkey"], slots=16)
    store.merge_slots("customers", source, ["c_custkey"], 16, "latest", ["version"])
    return store.read("customers").select("c_custkey", "c_name", "c_acctbal")


@query(
    "upsert_null_keys",
    """SELECT CASE WHEN c_custkey % 4 <> 0 THEN c_custkey END AS k, c_name FROM customer
       UNION ALL SELECT c_custkey, 'kept' FROM customer WHERE c_custkey % 4 = 0""",
)
def upsert_null_keys(t: Tables) -> DataFrame:
    """A fourth of the rows that come in have no key: they match nothing and are added."""
    key = F.when(F.col("c_custkey") % 4 != 0, F.col("c_custkey"))
    source = t.customer.select(key.alias("k"), "c_name")
    target = t.customer.select(F.col("c_custkey").alias("k"), F.lit("kept").alias("c_name"))
    return sinks.upsert(target, source, ["k"])


@query("publish_refresh", "SELECT c_custkey, c_name FROM customer")
def publish_refresh(t: Tables) -> DataFrame:
    """A table written twice in full: the second version replaces the first, whatever it held."""
    store = _store(t)
    rows = t.customer.select("c_custkey", "c_name")
    store.publish("customers", rows.withColumn("c_name", F.lit("before")))
    done = store.publish("customers", rows)
    count = F.lit(done.rows)
    return store.read("customers").where(count == rows.count())


@query("publish_guarded", "SELECT c_custkey, c_name FROM customer")
def publish_guarded(t: Tables) -> DataFrame:
    """An empty result leaves a guarded table as it was."""
    store = _store(t)
    rows = t.customer.select("c_custkey", "c_name")
    store.publish("customers", rows)
    done = store.publish("customers", rows.where("c_custkey < 0"), skip_if_empty=True)
    return store.read("customers").where(F.lit(not done.wrote))


@query("publish_auto", UPSERT_SQL)
def publish_auto(t: Tables) -> DataFrame:
    """The first run overwrites, the next one merges."""
    target, source = _changes(t)
    store, how = _store(t), {"mode": "auto", "keys": ["c_custkey"]}
    store.publish("customers", target, **how)
    store.publish("customers", source, on_duplicate="latest", newest_by=["version"], **how)
    return store.read("customers").select("c_custkey", "c_name", "c_acctbal")


@query(
    "superseded_batches",
    """SELECT 'b' || n_regionkey AS batch, CASE WHEN n_regionkey = 4 THEN 'processed' ELSE 'superseded' END AS state,
         count(*) AS pages, 'b4' AS in_silver FROM nation GROUP BY n_regionkey""",
)
def superseded_batches(t: Tables) -> DataFrame:
    """Five batches wait, of which the newest goes to silver; a second run finds nothing to do."""
    store = _store(t)
    landed = t.nation.select(
        F.to_json(F.array(F.struct(F.col("n_name").alias("id")))).alias("Raw_data"), F.lit(False).alias("_is_normalized"),
        F.concat(F.lit("b"), "n_regionkey").alias("_Batch_run_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("n_regionkey")).alias("_ingestion_ts"),
    )
    store.append("pages", landed, partition_by=["_Batch_run_id"])
    batches.recover(store, "pages")
    normalise.normalise_reviews(store, "pages")
    assert normalise.normalise_reviews(store, "pages") == {}
    silver = store.read("reviews").agg(F.concat_ws(",", F.sort_array(F.collect_set("_Batch_run_id"))).alias("b"))
    states = store.read(sinks.LEDGER).select(F.col("_Batch_run_id").alias("batch"), "state")
    pages = landed.groupBy(F.col("_Batch_run_id").alias("batch")).agg(F.count("*").alias("pages"))
    return pages.join(states, "batch").withColumn("in_silver", silver.select("b").scalar())


@query(
    "evolve_append",
    """SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS segment FROM customer WHERE c_custkey % 2 = 0
       UNION ALL SELECT c_custkey, c_name, c_mktsegment FROM customer WHERE c_custkey % 2 = 1""",
)
def evolve_append(t: Tables) -> DataFrame:
    old = t.customer.where("c_custkey % 2 = 0").select("c_custkey", "c_name")
    new = t.customer.where("c_custkey % 2 = 1").select(
        F.col("c_mktsegment").alias("segment"), "c_name", "c_custkey"
    )
    return nested.union_aligned(old, new)

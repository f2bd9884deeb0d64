"""Queries of the scalar rules, over values derived from the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.registry import Tables, dealt, query
from tidemark.functions import dates, scalars
from tidemark.functions.json import is_json, json_decimal
from tidemark.operators import nested
from tidemark.operators.sinks import conform


@query(
    "label_map",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '5-LOW' THEN 'Low'
         ELSE o_orderpriority END AS label FROM orders""",
)
def label_map(t: Tables) -> DataFrame:
    labels = {"1-URGENT": "Urgent", "5-LOW": "Low"}
    return t.orders.select(
        "o_orderkey", scalars.label_map("o_orderpriority", labels).alias("label")
    )


CODES = "CASE WHEN o_orderkey % 10 <> 0 THEN CAST(1259 + o_custkey % 8 AS {text}) END"


@query(
    "code_map",
    f"""SELECT o_orderkey, CASE {CODES.format(text='VARCHAR')} WHEN '1260' THEN 'P' WHEN '1261' THEN 'T'
          WHEN '1262' THEN 'N' WHEN '1264' THEN 'I' WHEN '1265' THEN 'B'
          ELSE CASE WHEN o_orderkey % 10 <> 0 THEN '' END END AS class FROM orders""",
)
def code_map(t: Tables) -> DataFrame:
    from tidemark.plans.employees import CLASSES

    code = F.expr(CODES.format(text="string"))
    return t.orders.select("o_orderkey", scalars.code_map(code, CLASSES).alias("class"))


WORDS = """CASE o_orderkey % 6 WHEN 0 THEN 'true' WHEN 1 THEN '1' WHEN 2 THEN 'false'
  WHEN 3 THEN '0' WHEN 4 THEN 'yes' END"""


@query(
    "bool_to_int",
    """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 1 WHEN 1 THEN 1 WHEN 2 THEN 0 WHEN 3 THEN 0
         END AS word, CAST(o_totalprice > 100000 AS INTEGER) AS flag FROM orders""",
)
def bool_to_int(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey", scalars.bool_to_int(F.expr(WORDS)).alias("word"),
        scalars.bool_to_int(F.col("o_totalprice") > 100000).alias("flag"),
    )


@query(
    "yn_flag",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 1 ELSE 0 END AS yes FROM orders",
)
def yn_flag(t: Tables) -> DataFrame:
    word = F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'Y' WHEN 1 THEN 'N' END")
    return t.orders.select("o_orderkey", scalars.yn_flag(word).alias("yes"))


BLANKS = """CASE o_orderkey % 5 WHEN 0 THEN '' WHEN 1 THEN '   ' WHEN 2 THEN concat(' ', o_orderpriority)
  WHEN 3 THEN o_orderpriority END"""


@query(
    "blank_to_null",
    """SELECT o_orderkey, CASE o_orderkey % 5 WHEN 2 THEN concat(' ', o_orderpriority)
         WHEN 3 THEN o_orderpriority END AS text FROM orders""",
)
def blank_to_null(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", scalars.blank_to_null(F.expr(BLANKS)).alias("text"))


@query(
    "strip_ws",
    r"""SELECT doc_id, regexp_replace(text, '\s+', '', 'g') AS squeezed,
          coalesce(regexp_replace(CASE WHEN doc_id % 3 = 0 THEN source END, '\s+', '', 'g'), '') AS some
        FROM documents""",
)
def strip_ws(t: Tables) -> DataFrame:
    some = F.when(F.col("doc_id") % 3 == 0, F.col("source"))
    return t.documents.select(
        "doc_id", scalars.strip_ws("text").alias("squeezed"), scalars.strip_ws(some).alias("some")
    )


@query(
    "strip_zero_width",
    """SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_name || chr(8203)
         ELSE chr(8203) || p_name END AS title FROM part""",
)
def strip_zero_width(t: Tables) -> DataFrame:
    zero = F.lit(scalars.ZERO_WIDTH_SPACE)
    marked = (
        F.when(F.col("p_partkey") % 3 == 0, F.concat("p_name", zero))
        .when(F.col("p_partkey") % 3 == 1, F.concat("p_name", zero, zero))
        .otherwise(F.concat(zero, F.col("p_name")))
    )
    return t.part.select("p_partkey", scalars.strip_zero_width(marked).alias("title"))


@query(
    "concat_null",
    """SELECT p_partkey, CASE WHEN p_partkey % 4 <> 0 THEN p_brand || ' - ' || p_type END AS engine
       FROM part""",
)
def concat_null(t: Tables) -> DataFrame:
    brand = F.when(F.col("p_partkey") % 4 != 0, F.col("p_brand"))
    return t.part.select(
        "p_partkey", scalars.concat_strict(brand, F.lit(" - "), "p_type").alias("engine")
    )


NUMBERS = """CASE o_orderkey % 5 WHEN 0 THEN CAST(o_custkey AS {text}) WHEN 1 THEN '' WHEN 2 THEN 'n/a'
  WHEN 3 THEN '99999999999' END"""


@query(
    "numeric_casts",
    f"""SELECT o_orderkey, TRY_CAST(n AS DOUBLE) AS d, CAST(TRY_CAST(n AS DECIMAL(38,6)) AS DOUBLE) AS dec,
          TRY_CAST(n AS BIGINT) AS l, TRY_CAST(n AS INTEGER) AS i
        FROM (SELECT o_orderkey, {NUMBERS.format(text='VARCHAR')} AS n FROM orders)""",
)
def numeric_casts(t: Tables) -> DataFrame:
    n = F.expr(NUMBERS.format(text="string"))
    return t.orders.select(
        "o_orderkey", scalars.to_double(n).alias("d"), scalars.to_decimal(n).alias("dec"),
        scalars.to_long(n).alias("l"), scalars.to_int(n).alias("i"),
    )


@query(
    "conform_schema",
    """SELECT o_orderstatus, CAST(o_orderkey AS VARCHAR) AS o_orderkey,
         TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS urgency FROM orders""",
)
def conform_schema(t: Tables) -> DataFrame:
    rows = t.orders.select(
        F.substring("o_orderpriority", 1, 1).alias("urgency"), "o_orderkey", "o_orderstatus",
        "o_totalprice",
    )
    return conform(rows, "o_orderstatus string, o_orderkey string, urgency int")


# -- dates ---------------------------------------------------------------------------------------

STAMPS = """CASE o_orderkey % 6 WHEN 0 THEN date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss")
  WHEN 1 THEN concat(date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss"), 'Z')
  WHEN 2 THEN concat(date_format(o_orderdate, "yyyy-MM-dd'T'HH:mm:ss"), '+02:00')
  WHEN 3 THEN date_format(o_orderdate, 'yyyy-MM-dd') WHEN 4 THEN '' END"""
STAMPS_SQL = """CASE o_orderkey % 6 WHEN 0 THEN o_orderdate WHEN 1 THEN o_orderdate
  WHEN 2 THEN o_orderdate - INTERVAL 2 HOUR WHEN 3 THEN o_orderdate END"""


@query("iso_ts", f"SELECT o_orderkey, {STAMPS_SQL} AS ts FROM orders")
def iso_ts(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.iso_ts(F.expr(STAMPS)).alias("ts"))


UNSET = """CASE event_id % 6 WHEN 0 THEN NULL WHEN 1 THEN ' ' WHEN 2 THEN 'Unspecified'
  ELSE date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'") END"""


@query(
    "date_or_default",
    """SELECT event_id, CASE WHEN event_id % 6 < 3 THEN '1900-01-01 00:00:00.0000000'
         ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '.0000000' END AS logon FROM events""",
)
def date_or_default(t: Tables) -> DataFrame:
    return t.events.select("event_id", dates.date_or_default(F.expr(UNSET)).alias("logon"))


@query(
    "zone_minus_minute",
    """SELECT o_orderkey, strftime((o_orderdate AT TIME ZONE 'UTC') AT TIME ZONE 'America/Los_Angeles'
         - INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S') || '.0000000' AS expires
       FROM orders""",
)
def zone_minus_minute(t: Tables) -> DataFrame:
    text = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return t.orders.select("o_orderkey", dates.zone_minus_minute(text).alias("expires"))


# Order dates of every third order are moved before 1970.
MOVED = "CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate - INTERVAL 40 YEAR ELSE o_orderdate END"


@query(
    "tick_date",
    """SELECT event_id, CASE WHEN event_id % 5 = 0 THEN TIMESTAMP '1900-01-01' ELSE
         date_trunc('second', CASE WHEN event_id % 3 = 0 THEN ts - INTERVAL 60 YEAR ELSE ts END)
         END AS modified, date_trunc('second', ts) AS plain FROM events""",
)
def tick_date(t: Tables) -> DataFrame:
    early = F.expr("CASE WHEN event_id % 3 = 0 THEN ts - INTERVAL 60 YEAR ELSE ts END")

    def ticks(ts):
        return F.concat(F.lit("/Date("), F.unix_millis(ts.cast("timestamp")), F.lit("+0000)/"))

    some = F.when(F.col("event_id") % 5 != 0, ticks(early)).when(F.col("event_id") % 10 == 0, "")
    return t.events.select(
        "event_id", dates.tick_date(some).alias("modified"),
        dates.tick_date(ticks(F.col("ts")), legacy_sign=True).alias("plain"),
    )


def _millis(ts) -> F.Column:
    return F.concat(F.lit("/Date("), F.unix_millis(ts.cast("timestamp")), F.lit(")/"))


@query(
    "millis_date",
    f"""SELECT o_orderkey, strftime({MOVED}, '%Y-%m-%d') || 'T00:00:00+00:00' AS start,
          CASE WHEN o_orderkey % 4 = 0 THEN TIMESTAMP '1900-01-01' ELSE o_orderdate - INTERVAL 2 HOUR END
            AS shifted FROM orders""",
)
def millis_date(t: Tables) -> DataFrame:
    some = F.when(F.col("o_orderkey") % 4 != 0, _millis(F.col("o_orderdate")))
    return t.orders.select(
        "o_orderkey", dates.iso_midnight(dates.millis_date(_millis(F.expr(MOVED)))).alias("start"),
        dates.millis_date(some, zone_offset_ms=7_200_000).alias("shifted"),
    )


@query(
    "never_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'Never'
         ELSE strftime(o_orderdate, '%Y-%m-%d') || 'T00:00:00+00:00' END AS ends FROM orders""",
)
def never_date(t: Tables) -> DataFrame:
    far = F.expr("CASE WHEN o_orderkey % 4 = 0 THEN o_orderdate + INTERVAL 7950 YEAR ELSE o_orderdate END")
    return t.orders.select("o_orderkey", dates.iso_or_never(dates.millis_date(_millis(far))).alias("ends"))


@query(
    "century_fix",
    """SELECT o_orderkey, CAST(CAST(CASE WHEN d < TIMESTAMP '1990-01-01' THEN d + INTERVAL 1200 MONTH
         ELSE d END AS DATE) AS VARCHAR) AS fixed
       FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate - INTERVAL 1200 MONTH
             ELSE o_orderdate END AS d FROM orders)""",
)
def century_fix(t: Tables) -> DataFrame:
    day = F.expr(
        "CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate - INTERVAL 1200 MONTH ELSE o_orderdate END AS date)"
    )
    return t.orders.select("o_orderkey", dates.century_fix(day.cast("string")).alias("fixed"))


# -- arrays, structs and JSON fields ---------------------------------------------------------------


@query(
    "flatten_struct",
    """SELECT o_orderkey, c_name AS customer_name, c_acctbal AS balance,
         strftime(o_orderdate, '%Y-%m-%d') AS day
       FROM orders LEFT JOIN customer ON c_custkey = o_custkey""",
)
def flatten_struct(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    doc = joined.select(
        F.to_json(F.struct("o_orderkey", "o_orderdate", F.struct("c_name", "c_acctbal").alias("customer")))
        .alias("Raw_data")
    )
    parsed = nested.parse_object(
        doc, "Raw_data",
        "o_orderkey bigint, o_orderdate timestamp, customer struct<c_name:string,c_acctbal:double>",
    )
    return nested.flatten(
        parsed,
        {
            "o_orderkey": "_parsed.o_orderkey", "customer_name": "_parsed.customer.c_name",
            "balance": "_parsed.customer.c_acctbal", "day": dates.day_text("_parsed.o_orderdate"),
        },
    )


@query(
    "array_first",
    """SELECT doc_id, string_split(text, chr(10))[1] AS first_line,
         CASE WHEN doc_id % 2 = 0 THEN source END AS tag FROM documents""",
)
def array_first(t: Tables) -> DataFrame:
    lines = F.split("text", "\n")
    tags = F.when(
        F.col("doc_id") % 2 == 0, F.array(F.struct(F.col("source").alias("tag")))
    ).otherwise(F.array().cast("array<struct<tag:string>>"))
    return t.documents.select(
        "doc_id", scalars.first_of(lines).alias("first_line"), scalars.first_of(tags, "tag").alias("tag")
    )


@query(
    "filter_first",
    """SELECT conv_id, turn, CASE WHEN length(text) % 3 = 0 THEN role || '@a'
         WHEN length(text) % 3 = 1 THEN role || '@b' END AS email FROM conversations""",
)
def filter_first(t: Tables) -> DataFrame:
    def entry(kind: str, suffix: str):
        return F.struct(
            F.lit(kind).alias("emailType"), F.concat("role", F.lit(suffix)).alias("emailAddress")
        )

    n = F.length("text") % 3
    emails = (
        F.when(n == 0, F.array(entry("1", "@x"), entry("2624", "@a"), entry("2624", "@c")))
        .when(n == 1, F.array(entry("2624", "@b"))).otherwise(F.array(entry("1", "@x")))
    )
    email = scalars.first_where(emails, lambda x: x.emailType == "2624", "emailAddress")
    return t.conversations.select("conv_id", "turn", email.alias("email"))


@query(
    "explode_array_root",
    """SELECT doc_id, line FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line
       FROM documents)""",
)
def explode_array_root(t: Tables) -> DataFrame:
    """Whole texts as a JSON array of lines per document."""
    doc = dealt(t.documents).select(
        F.to_json(
            F.transform(F.split("text", "\n"), lambda x: F.struct(F.col("doc_id"), x.alias("line")))
        ).alias("Raw_data")
    )
    parsed = nested.parse_array(doc, "Raw_data", "struct<doc_id:bigint,line:string>")
    return nested.explode_parsed(parsed, ["_parsed"], into="x").select("x.doc_id", "x.line")


@query(
    "second_stage_json",
    """SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events""",
)
def second_stage_json(t: Tables) -> DataFrame:
    """A text member that is itself JSON: parsed as text first, then under its own schema."""
    doc = t.events.select(F.to_json(F.struct("event_id", "event_type", "props")).alias("Raw_data"))
    one = nested.parse_object(doc, "Raw_data", "event_id bigint, event_type string, props string")
    two = nested.parse_text_field(one, "_parsed.props", "k int", "_props")
    return two.select("_parsed.event_id", "_props.k", "_parsed.event_type")


@query(
    "json_path_decimal",
    """SELECT event_id, CAST(CAST(json_extract(props, '$.k') AS DECIMAL(38,6)) AS DOUBLE) AS amount,
         CAST(NULL AS DOUBLE) AS missing FROM events""",
)
def json_path_decimal(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", json_decimal("props", "$.k").alias("amount"),
        json_decimal("props", "$.none").alias("missing"),
    )


@query(
    "body_kind",
    """SELECT event_id, event_id % 2 = 0 AS json FROM events""",
)
def body_kind(t: Tables) -> DataFrame:
    body = F.when(F.col("event_id") % 2 == 0, F.col("props")).otherwise(F.col("event_type"))
    return t.events.select("event_id", is_json(body).alias("json"))


@query(
    "explode_map_bunker",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS key,
         CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN NULL ELSE 'roe' END AS roe,
         l_quantity AS price FROM lineitem
       UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'all', 'x', l_tax FROM lineitem
         WHERE l_linenumber <> 3""",
)
def explode_map_bunker(t: Tables) -> DataFrame:
    doc = dealt(t.lineitem).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.expr(
            """to_json(map_filter(map(
              l_returnflag, named_struct('roe', CASE l_linenumber WHEN 1 THEN '{"rates":[]}'
                 WHEN 2 THEN '' ELSE 'roe' END, 'price', cast(l_quantity as string)),
              'all', named_struct('roe', 'x', 'price', cast(l_tax as string))),
              (k, v) -> k <> 'all' OR l_linenumber <> 3))"""
        ).alias("Raw_data"),
    )
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    parsed = F.from_json("Raw_data", "map<string,struct<roe:string,price:string>>")
    rows = nested.explode_map(doc.select(*keys, parsed.alias("m")), "m", keys)
    return rows.select(
        *keys, "key",
        scalars.placeholder_to_null("value.roe", '{"rates":[]}', "").alias("roe"),
        scalars.to_double("value.price").alias("price"),
    )

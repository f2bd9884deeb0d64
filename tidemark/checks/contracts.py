"""Contract queries. Orders are contracts, order lines are their rates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.checks.registry import few_pages, Tables, as_of, pages, query
from tidemark.operators import nested, rates as rate_ops
from tidemark.operators.select import slice_by
from tidemark.operators.staging import staged
from tidemark.plans import contract_fields, contracts

ISO = "yyyy-MM-dd'T'HH:mm:ss"

# -- documents -----------------------------------------------------------------------------------

# Lines 6 carry an unreadable start and lines 7 none, so every branch of the resolution is met.
RATE_DOC = """
named_struct('contracts', array(named_struct(
  'contractId', l_orderkey,
  'rate_review_period', l_linestatus,
  'rates', array(named_struct(
    'rate', l_extendedprice, 'special', l_linenumber = 1, 'currency', l_returnflag,
    'rate_uuid', concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey),
    'valid_from', CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 'to be agreed'
                  ELSE date_format(l_shipdate, "yyyy-MM-dd'T'HH:mm:ss") END,
    'lump_sums', filter(array(
      named_struct('type', 'tax', 'ls_unit', 'share', 'ls_amount', l_tax,
                   'ls_currency', l_returnflag, 'rate_number', l_linenumber,
                   'lump_sum_uuid', concat_ws('-', 't', l_partkey)),
      named_struct('type', 'discount', 'ls_unit', 'share', 'ls_amount', l_discount,
                   'ls_currency', l_returnflag, 'rate_number', l_linenumber,
                   'lump_sum_uuid', concat_ws('-', 'd', l_partkey))), x -> x.ls_amount > 0)))
)))
"""


def rate_pages(t: Tables, by: tuple[str, ...] = ()) -> DataFrame:
    return pages(t.lineitem, F.expr(RATE_DOC), by=by)


def rate_rows(t: Tables) -> DataFrame:
    return contracts.rates(contracts.contract_records(rate_pages(t), ("rates",)))


PERIOD = "CASE o_orderstatus WHEN 'F' THEN 'past' WHEN 'O' THEN 'ongoing' ELSE 'upcoming' END"
TYPE = "CASE o_orderkey % 3 WHEN 0 THEN 'charterparty' WHEN 1 THEN 'extension' ELSE 'option' END"

# What the documents say for the columns that decide something; both engines read these alike.
SPECIAL = {
    "contractId": "o_orderkey",
    "contractType": TYPE,
    "period": PERIOD,
    "shipImoNr": "CASE WHEN o_custkey % 4 = 0 THEN concat('H', CAST(o_custkey AS {text})) "
    "ELSE CAST(9000000 + o_custkey AS {text}) END",
    "charterType": "CASE o_orderkey % 4 WHEN 0 THEN 'time_charter' WHEN 1 THEN 'bareboat_charter' "
    "WHEN 2 THEN 'voyage' END",
    "rate_type": "CASE o_orderkey % 5 WHEN 0 THEN 'fixed' WHEN 1 THEN 'contex' "
    "WHEN 2 THEN 'market_evaluation' WHEN 3 THEN 'other' END",
    "declarationType": "CASE o_custkey % 3 WHEN 0 THEN 'declared' WHEN 1 THEN 'open' END",
    "deliveryPortArea": "CASE o_orderkey % 4 WHEN 0 THEN '  ' WHEN 1 THEN '' WHEN 2 THEN ' Bay' END",
    "rbp": "CASE WHEN o_orderkey % 2 = 0 THEN concat('rbp ', CAST(o_orderkey % 7 AS {text})) END",
    "comment": "CASE o_orderkey % 3 WHEN 0 THEN ' ' WHEN 1 THEN 'per day' END",
    "crmd_name": "concat('FX-', CAST(o_custkey AS {text}))",
}


def _source(name: str, kind: str, k: int, text: str) -> str:
    """The raw value of a header member as SQL over orders; ``text`` is the engine's text type."""
    if name in SPECIAL:
        return SPECIAL[name].format(text=text)
    hole = f"(o_orderkey + {k}) % 11 = 0"
    value = {
        "flag": f"o_orderkey % {2 + k % 3} = 0",
        "long": f"o_custkey + {k}",
        "decimal": "o_totalprice",
        "amount": "o_orderkey % 500",
    }.get(kind, f"concat('{name} ', CAST(o_orderkey % {11 + k} AS {text}))")
    return f"CASE WHEN {hole} THEN NULL ELSE {value} END"


def _day(name: str, k: int) -> tuple[str, str]:
    """(days after the order date, condition for NULL) of a date member."""
    return str(k % 40), f"(o_orderkey + {k}) % {5 + k % 4} = 0"


def header_doc() -> str:
    """A struct with every header member, as Spark SQL over orders."""
    tree: dict = {}
    for k, (name, kind, path) in enumerate(contract_fields.lines()):
        if kind == "time" or name == "extensionDate":
            days, hole = _day(name, k)
            value = (
                f"CASE WHEN {hole} THEN NULL WHEN o_orderkey % 13 = {k % 13} THEN '' ELSE "
                f"date_format(o_orderdate + make_dt_interval({days}), \"{ISO}\") END"
            )
        else:
            value = _source(path if kind == "first_period" else name, kind, k, "string")
        if kind == "amount":
            value = f"named_struct('amount', {value})"
        if kind == "first_period":
            tree.setdefault("rateBillingPeriods", {})[path] = value
        elif "." in path:
            head, leaf = path.split(".")
            tree.setdefault(head, {})[leaf] = value
        else:
            tree[path] = value

    def text(node: dict) -> str:
        inner = ", ".join(
            f"'{n}', " + (v if isinstance(v, str) else wrap(n, text(v))) for n, v in node.items()
        )
        return f"named_struct({inner})"

    def wrap(name: str, struct: str) -> str:
        if name != "rateBillingPeriods":
            return struct
        return f"CASE WHEN o_orderkey % 6 = 5 THEN array() ELSE array({struct}) END"

    return f"named_struct('contracts', array({text(tree)}))"


def expected(name: str, kind: str, path: str, k: int) -> str:
    """The silver value of a header column as DuckDB SQL over orders, from the rules themselves."""
    if kind == "time" or name == "extensionDate":
        days, hole = _day(name, k)
        moment = f"o_orderdate + INTERVAL {days} DAY"
        if name == "extensionDate":
            blank, moment = "''", f"strftime({moment}, '%Y-%m-%dT%H:%M:%S')"
        else:
            blank = "NULL"
        return f"CASE WHEN {hole} THEN NULL WHEN o_orderkey % 13 = {k % 13} THEN {blank} ELSE {moment} END"
    raw = _source(path if kind == "first_period" else name, kind, k, "VARCHAR")
    some = "o_orderkey % 6 <> 5"
    match kind:
        case "flag":
            return f"CAST({raw} AS INTEGER)"
        case "decimal" | "amount":
            return f"CAST(CAST({raw} AS DECIMAL(38,6)) AS DOUBLE)"
        case "long":
            return f"CAST({raw} AS BIGINT)"
        case "blank":
            return f"CASE WHEN trim({raw}) <> '' THEN {raw} END"
        case "charter_type":
            return (
                f"CASE {raw} WHEN 'time_charter' THEN 'Time Charter' "
                f"WHEN 'bareboat_charter' THEN 'Bare Boat' ELSE {raw} END"
            )
        case "rate_type":
            return (
                f"CASE {raw} WHEN 'fixed' THEN 'Fixed' WHEN 'contex' THEN 'Contex' "
                f"WHEN 'market_evaluation' THEN 'Market' ELSE {raw} END"
            )
        case "first_period":
            full = f"trim({raw}) <> ''" if path == "comment" else "true"
            return f"CASE WHEN {some} AND {full} THEN {raw} END"
    return raw


def header_sql(where: str) -> str:
    columns = ",\n  ".join(
        f'{expected(name, kind, path, k)} AS "{name}"'
        for k, (name, kind, path) in enumerate(contract_fields.lines())
    )
    return f"SELECT {columns}\nFROM orders WHERE {where}"


def contract_pages(t: Tables, by: tuple[str, ...] = ()) -> DataFrame:
    return pages(t.orders, F.expr(header_doc()), by=by)


def header_records(t: Tables) -> DataFrame:
    return contracts.contract_records(contract_pages(t), ("header",))


META = ("_Batch_run_id", "_ingestion_ts")


def bare(df: DataFrame) -> DataFrame:
    return df.drop(*META)


# -- SQL twins -----------------------------------------------------------------------------------

RATES_SQL = """
SELECT l_orderkey AS "contractId", l_extendedprice AS rate, l_returnflag AS currency,
       l_linenumber AS ln, l_shipdate AS dated,
       CASE WHEN l_linenumber <= 5 THEN 'dated' WHEN l_linenumber = 7 THEN 'undated'
            ELSE 'unreadable' END AS how
FROM lineitem
"""


def resolved_sql(contracts_sql: str) -> str:
    """Rates in force by ranking, over contracts("contractId", period, fallback)."""
    return f"""
WITH c AS ({contracts_sql}), r AS ({RATES_SQL}),
x AS (
  SELECT c."contractId", c.period, r.rate, r.currency,
         CASE how WHEN 'dated' THEN dated WHEN 'undated' THEN fallback END AS start
  FROM r JOIN c USING ("contractId")
),
k AS (
  SELECT * FROM x WHERE period IN ('past', 'upcoming')
     OR (period = 'ongoing' AND start <= TIMESTAMP '1998-06-01')
),
n AS (
  SELECT *,
    row_number() OVER (PARTITION BY "contractId", period
      ORDER BY start DESC NULLS LAST, rate DESC, currency DESC) AS down,
    row_number() OVER (PARTITION BY "contractId", period
      ORDER BY start ASC NULLS FIRST, rate ASC, currency ASC) AS up
  FROM k
)
SELECT "contractId", period, rate AS final_rate, start AS rate_start, currency AS rate_currency
FROM n WHERE (period IN ('past', 'ongoing') AND down = 1) OR (period = 'upcoming' AND up = 1)
"""


FALLBACK = "CASE WHEN o_custkey % 5 <> 0 THEN o_orderdate WHEN o_custkey % 2 = 0 THEN o_orderdate + INTERVAL 30 DAY END"
PLAIN_CONTRACTS = f'SELECT o_orderkey AS "contractId", {PERIOD} AS period, {FALLBACK} AS fallback FROM orders'
OPTION_CONTRACTS = PLAIN_CONTRACTS + " WHERE o_orderkey % 3 = 2"


def plain_contracts(t: Tables) -> DataFrame:
    """Contracts with only what the resolution of rates needs, through JSON and back."""
    doc = F.expr(
        f"""named_struct('contracts', array(named_struct(
          'contractId', o_orderkey, 'period', {PERIOD}, 'contractType', {TYPE},
          'toDateIsPlanned', o_orderpriority IN ('1-URGENT', '2-HIGH'),
          'redeliveryDate', date_format(o_orderdate + make_dt_interval(90), "{ISO}"),
          'deliveryDate', CASE WHEN o_custkey % 5 <> 0 THEN date_format(o_orderdate, "{ISO}") END,
          'extensionDate', CASE WHEN o_custkey % 2 = 0
             THEN date_format(o_orderdate + make_dt_interval(30), "yyyy-MM-dd") END)))"""
    )
    return bare(contracts.contract_projection(
        contracts.contract_records(pages(t.orders, doc), ("header",))
    ))


CORE = contracts.RESOLUTION


@query("active_rate", resolved_sql(PLAIN_CONTRACTS))
def active_rate(t: Tables) -> DataFrame:
    return rate_ops.active_rate(rate_rows(t), plain_contracts(t).select(*CORE), as_of())


@query("active_rate_options", resolved_sql(OPTION_CONTRACTS))
def active_rate_options(t: Tables) -> DataFrame:
    chosen = slice_by(plain_contracts(t), "contractType", "option").select(*CORE)
    return rate_ops.active_rate(rate_rows(t), chosen, as_of())


WITH_RATE_SQL = f"""
SELECT c."contractId", c.period, a.final_rate, a.rate_start, a.rate_currency,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN o_orderdate + INTERVAL 90 DAY END
    AS "expectedRedeliveryDate"
FROM ({PLAIN_CONTRACTS}) c JOIN orders ON o_orderkey = c."contractId"
LEFT JOIN ({resolved_sql(PLAIN_CONTRACTS)}) a ON a."contractId" = c."contractId"
"""


@query("contracts_with_rate", WITH_RATE_SQL)
def contracts_with_rate(t: Tables) -> DataFrame:
    rated = rate_ops.contracts_with_rate(plain_contracts(t), rate_rows(t), as_of())
    return contracts.with_redelivery(rated).select(
        "contractId", "period", *rate_ops.RESULT, "expectedRedeliveryDate"
    )


@query("attach_rate", WITH_RATE_SQL)
def attach_rate(t: Tables) -> DataFrame:
    """The two-step form, which resolves rates per contract and period and then joins them."""
    own = plain_contracts(t)
    rated = rate_ops.attach_rate(own, rate_ops.active_rate(rate_rows(t), own.select(*CORE), as_of()))
    return contracts.with_redelivery(rated).select(
        "contractId", "period", *rate_ops.RESULT, "expectedRedeliveryDate"
    )


@query(
    "contracts_with_rate_hot_keys",
    f"""SELECT x.* FROM ({WITH_RATE_SQL}) x, range(1, 41) AS r(i) WHERE i = 1 OR "contractId" % 100 = 0""",
)
def contracts_with_rate_hot_keys(t: Tables) -> DataFrame:
    """The same where some ids have forty copies: those are hot and joined in slots."""
    copies = F.when(F.col("contractId") % 100 == 0, 40).otherwise(1)
    own = plain_contracts(t).withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    rated = rate_ops.contracts_with_rate(own, rate_rows(t), as_of(), hot_rows=10)
    return contracts.with_redelivery(rated).select(
        "contractId", "period", *rate_ops.RESULT, "expectedRedeliveryDate"
    )


@query(
    "expected_redelivery",
    """SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH')
         THEN o_orderdate + INTERVAL 90 DAY END AS expected FROM orders""",
)
def expected_redelivery(t: Tables) -> DataFrame:
    planned = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").cast("int")
    date = F.col("o_orderdate") + F.make_dt_interval(F.lit(90))
    return t.orders.select("o_orderkey", rate_ops.expected_redelivery(planned, date).alias("expected"))


# -- child lists ---------------------------------------------------------------------------------

RATE_LIST_SQL = """
SELECT l_orderkey AS "contractId", l_extendedprice AS rate, l_linenumber = 1 AS special,
  l_returnflag AS currency,
  concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rate_uuid,
  CASE l_linenumber WHEN 7 THEN NULL WHEN 6 THEN 'to be agreed'
    ELSE strftime(l_shipdate, '%Y-%m-%dT%H:%M:%S') END AS valid_from,
  l_orderkey AS lump_sums, l_linestatus AS rate_review_period
FROM lineitem
"""

LUMP_SQL = """
SELECT l_orderkey AS "contractId", kind AS type, 'share' AS ls_unit, amount AS ls_amount,
  l_returnflag AS ls_currency, CAST(l_linenumber AS VARCHAR) AS rate_number,
  concat_ws('-', substr(kind, 1, 1), l_partkey) AS lump_sum_uuid
FROM (SELECT *, 'tax' AS kind, l_tax AS amount FROM lineitem
      UNION ALL SELECT *, 'discount', l_discount FROM lineitem) WHERE amount > 0
"""


@query("silver_charterparties_rates", RATE_LIST_SQL)
def silver_rates(t: Tables) -> DataFrame:
    return bare(rate_rows(t))


@query("silver_charterparties_lump_sums", LUMP_SQL)
def silver_lump_sums(t: Tables) -> DataFrame:
    return bare(contracts.lump_sums(contracts.contract_records(rate_pages(t), ("rates",))))


# Contracts whose number of rates runs from none to four, with up to three lump sums each, made of
# each order's own values.
DEEP_DOC = """
named_struct('contracts', array(named_struct('contractId', o_orderkey, 'rates',
  CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE
  transform(filter(sequence(0L, o_custkey % 5), i -> i > 0), i -> named_struct(
    'rate', o_totalprice, 'currency', concat('C', i), 'lump_sums',
    transform(filter(sequence(0L, (o_custkey + i) % 4), j -> j > 0), j -> named_struct(
      'type', o_orderpriority, 'ls_amount', i * 10 + j, 'rate_number', i)))) END)))
"""


def deep_records(t: Tables) -> DataFrame:
    return contracts.contract_records(pages(t.orders, F.expr(DEEP_DOC)), ("rates",))


DEEP_RATES = """
SELECT o_orderkey AS "contractId", o_orderpriority, o_custkey, o_totalprice, i
FROM orders, range(1, 5) AS r(i) WHERE i <= o_custkey % 5
"""


@query(
    "explode_rates",
    f"""SELECT "contractId", o_totalprice AS rate, concat('C', i) AS currency,
        "contractId" AS lump_sums FROM ({DEEP_RATES})""",
)
def explode_rates(t: Tables) -> DataFrame:
    return contracts.rates(deep_records(t)).select("contractId", "rate", "currency", "lump_sums")


@query(
    "explode_lump_sums",
    f"""SELECT "contractId", o_orderpriority AS type, CAST(i * 10 + j AS DOUBLE) AS ls_amount,
        CAST(i AS VARCHAR) AS rate_number
        FROM ({DEEP_RATES}), range(1, 4) AS s(j) WHERE j <= (o_custkey + i) % 4""",
)
def explode_lump_sums(t: Tables) -> DataFrame:
    return contracts.lump_sums(deep_records(t)).select(
        "contractId", "type", "ls_amount", "rate_number"
    )


@query(
    "explode_outer_parents",
    f"""SELECT o_orderkey AS "contractId", concat('C', d.i) AS currency FROM orders
        JOIN ({DEEP_RATES}) d ON d."contractId" = o_orderkey
        UNION ALL SELECT o_orderkey, NULL FROM orders WHERE o_custkey % 5 = 0""",
)
def explode_outer_parents(t: Tables) -> DataFrame:
    rows = nested.explode_path(deep_records(t), ["c.rates"], ["c.contractId"], outer=True, into="r")
    return rows.select(F.col("contractId").cast("bigint").alias("contractId"), "r.currency")


CHILD_DOC = """
named_struct('contracts', array(named_struct(
  'contractId', o_orderkey,
  'atCost', transform(sequence(1L, 1 + o_custkey % 3), i -> named_struct(
     'at_cost_type', concat('type ', i), 'at_cost_unit', o_orderpriority,
     'at_cost_amount', CASE i WHEN 1 THEN cast(o_totalprice as string) WHEN 2 THEN ' ' END,
     'at_cost_comment', concat('order ', o_orderkey))),
  'brokerageCommission', array(
     named_struct('amount', '1.25', 'broker_id', cast(o_custkey as string), 'deduct_from_hire', true),
     named_struct('amount', '2.5', 'broker_id', cast(o_orderkey as string),
                  'deduct_from_hire', CAST(NULL AS boolean))),
  'deliveryNotices', transform(sequence(1L, 1 + o_orderkey % 3), i -> named_struct(
     'nr_days', i * 5, 'date_to_tender', date_format(o_orderdate, 'yyyy-MM-dd'), 'is_definite', i = 1)),
  'redeliveryNotices', CASE WHEN o_orderkey % 2 = 0 THEN array(
     named_struct('nr_days', 30, 'date_to_tender_formatted', o_orderstatus)) ELSE array() END,
  'premiums', array(named_struct('start', date_format(o_orderdate, 'yyyy-MM-dd'),
     'end', 'open', 'type', o_orderstatus, 'uuid', concat('p', o_orderkey),
     'amount', o_custkey, 'comment', o_orderpriority)))))
"""


def child_records(t: Tables, part: str) -> DataFrame:
    return contracts.contract_records(pages(t.orders, F.expr(CHILD_DOC)), (part,))


@query(
    "silver_charterparties_atcost",
    """SELECT o_orderkey AS "contractId", concat('type ', i) AS at_cost_type,
         o_orderpriority AS at_cost_unit, CASE WHEN i = 1 THEN o_totalprice END AS at_cost_amount,
         concat('order ', o_orderkey) AS at_cost_comment
       FROM orders, range(1, 4) AS r(i) WHERE i <= 1 + o_custkey % 3""",
)
def silver_at_cost(t: Tables) -> DataFrame:
    return bare(contracts.at_cost(child_records(t, "atCost")))


@query(
    "silver_brokerage_commission",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "contractId",
         CASE i WHEN 1 THEN '1.25' ELSE '2.5' END AS amount, CAST(NULL AS VARCHAR) AS end_date,
         CAST(CASE i WHEN 1 THEN o_custkey ELSE o_orderkey END AS VARCHAR) AS broker_id,
         CAST(NULL AS VARCHAR) AS absolute_payment, CAST(NULL AS VARCHAR) AS ceiling_currency,
         CASE i WHEN 1 THEN 'true' END AS deduct_from_hire,
         CAST(NULL AS VARCHAR) AS absolute_payment_currency,
         CAST(NULL AS VARCHAR) AS absolute_payment_rate_billing_period
       FROM orders, range(1, 3) AS r(i)""",
)
def silver_brokerage(t: Tables) -> DataFrame:
    return bare(contracts.brokerage_commission(child_records(t, "brokerageCommission")))


@query(
    "silver_delivery_notices",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "contractId", CAST(i * 5 AS VARCHAR) AS nr_days,
         strftime(o_orderdate, '%Y-%m-%d') AS date_to_tender,
         CAST(NULL AS VARCHAR) AS date_to_tender_formatted,
         CASE WHEN i = 1 THEN 'true' ELSE 'false' END AS is_definite
       FROM orders, range(1, 4) AS r(i) WHERE i <= 1 + o_orderkey % 3""",
)
def silver_delivery(t: Tables) -> DataFrame:
    return bare(contracts.delivery_notices(child_records(t, "deliveryNotices")))


@query(
    "silver_redelivery_notices",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "contractId", '30' AS nr_days,
         CAST(NULL AS VARCHAR) AS date_to_tender, o_orderstatus AS date_to_tender_formatted,
         CAST(NULL AS VARCHAR) AS is_definite
       FROM orders WHERE o_orderkey % 2 = 0""",
)
def silver_redelivery(t: Tables) -> DataFrame:
    return bare(contracts.redelivery_notices(child_records(t, "redeliveryNotices")))


@query(
    "silver_premiums",
    """SELECT CAST(o_orderkey AS VARCHAR) AS "contractId",
         strftime(o_orderdate, '%Y-%m-%d') AS start, 'open' AS "end", o_orderstatus AS type,
         concat('p', o_orderkey) AS uuid, CAST(o_custkey AS VARCHAR) AS amount,
         o_orderpriority AS comment FROM orders""",
)
def silver_premiums(t: Tables) -> DataFrame:
    return bare(contracts.premiums(child_records(t, "premiums")))


# -- header tables -------------------------------------------------------------------------------


@query("silver_charterparties_extension", header_sql("o_orderkey % 3 = 1"))
def silver_extension(t: Tables) -> DataFrame:
    return bare(contracts.extensions(header_records(t)))


# Lookups come from customers: hull numbers for every eighth, documents for every second.
def vessel_dim(t: Tables) -> DataFrame:
    return t.customer.where("c_custkey % 8 = 0").select(
        F.concat(F.lit("H"), F.col("c_custkey")).alias("Hull_no"),
        (F.col("c_custkey") + 7_000_000).alias("imo"),
    )


def documents(t: Tables) -> DataFrame:
    """Extension documents, one per extension of an even customer, half keyed a century too early."""
    k = [n for n, _, _ in contract_fields.lines()].index("extensionDate")
    days, _ = _day("extensionDate", k)
    day = F.expr(f"CAST(o_orderdate + make_dt_interval({days}) AS date)")
    return (
        t.orders.where("o_orderkey % 3 = 1 AND o_custkey % 2 = 0")
        .groupBy(
            F.concat(F.lit("FX-"), F.col("o_custkey")).alias("fixture_ID"),
            F.when(F.col("o_custkey") % 4 == 0, F.add_months(day, -1200)).otherwise(day)
            .cast("string").alias("extension_date"),
        )
        .agg(F.concat(F.lit("Fixture "), F.max("o_orderkey")).alias("crmd_name"))
    )


def _header_names() -> list[str]:
    return [n for n, _, _ in contract_fields.lines()]


def vessel_sql(column: str) -> str:
    """The vessel number as text: looked up for hulls known to the dimension."""
    return (
        f"CASE WHEN {column} LIKE 'H%' AND CAST(substr({column}, 2) AS BIGINT) % 8 = 0 "
        f"THEN CAST(CAST(substr({column}, 2) AS BIGINT) + 7000000 AS VARCHAR) ELSE {column} END"
    )


def combined_sql() -> str:
    names = _header_names()
    k = names.index("extensionDate")
    days, _ = _day("extensionDate", k)
    own = header_sql("o_orderkey % 3 = 0")
    ext = header_sql("o_orderkey % 3 = 1")
    ids = 'TRY_CAST({} AS BIGINT) AS "Vessel_IMO"'.format(vessel_sql('"shipImoNr"'))

    def columns(row: str) -> str:
        out = []
        for n in names:
            if n == "shipImoNr":
                out.append(ids)
            elif row == "ext" and n in contract_fields.EXTERNAL:
                kind = {"statuscode": "BIGINT", "finalizedrate": "DOUBLE",
                        "earliesttcenddateupdate": "TIMESTAMP"}.get(n, "VARCHAR")
                out.append(f'CAST(NULL AS {kind}) AS "{n}"')
            elif row == "ext" and n == "crmd_name":
                out.append("doc_name AS crmd_name")
            else:
                out.append(f'"{n}"')
        return ", ".join(out)

    docs = f"""SELECT concat('FX-', o_custkey) AS fixture,
          CAST(CASE WHEN o_custkey % 4 = 0
            THEN o_orderdate + INTERVAL {days} DAY - INTERVAL 1200 MONTH + INTERVAL 1200 MONTH
            ELSE o_orderdate + INTERVAL {days} DAY END AS DATE) AS day,
          concat('Fixture ', max(o_orderkey)) AS doc_name
        FROM orders WHERE o_orderkey % 3 = 1 AND o_custkey % 2 = 0 GROUP BY 1, 2"""
    both = f"""SELECT {columns('own')} FROM ({own}) UNION ALL
      SELECT {columns('ext')} FROM ({ext}) e LEFT JOIN ({docs}) d
        ON e.crmd_name = d.fixture AND TRY_CAST(e."extensionDate" AS DATE) = d.day"""
    return f"""
WITH both_ AS ({both}),
active AS ({resolved_sql('''SELECT "contractId", period,
   coalesce("deliveryDate", TRY_CAST("extensionDate" AS TIMESTAMP)) AS fallback FROM both_''')})
SELECT both_.*, a.final_rate, a.rate_start, a.rate_currency,
  CASE WHEN "toDateIsPlanned" = 1 THEN "redeliveryDate" END AS "expectedRedeliveryDate"
FROM both_ LEFT JOIN active a ON a."contractId" = both_."contractId"
"""


def option_sql() -> str:
    return f"""
WITH opt AS ({header_sql('o_orderkey % 3 = 2')}),
active AS ({resolved_sql('''SELECT "contractId", period,
   coalesce("deliveryDate", TRY_CAST("extensionDate" AS TIMESTAMP)) AS fallback FROM opt''')})
SELECT opt.*, a.final_rate, a.rate_start, a.rate_currency
FROM opt LEFT JOIN active a ON a."contractId" = opt."contractId"
"""


def all_sql() -> str:
    names = _header_names()
    tail = ["final_rate", "rate_start", "rate_currency", "expectedRedeliveryDate"]
    first = [f'CAST("Vessel_IMO" AS VARCHAR) AS "shipImoNr"' if n == "shipImoNr" else f'"{n}"'
             for n in [*names, *tail]]
    second = [
        f'{vessel_sql(chr(34) + "shipImoNr" + chr(34))} AS "shipImoNr"' if n == "shipImoNr"
        else ('CASE WHEN "toDateIsPlanned" = 1 THEN "redeliveryDate" END AS "expectedRedeliveryDate"'
              if n == "expectedRedeliveryDate" else f'"{n}"')
        for n in [*names, *tail]
    ]
    return f"""SELECT {', '.join(first)} FROM ({combined_sql()}) UNION ALL
SELECT {', '.join(second)} FROM ({option_sql()}) WHERE "declarationType" = 'declared'"""


def stored(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Records and rates written once and read by column, as the normaliser does it."""
    return staged(header_records(t)), staged(rate_rows(t))


def combined(t: Tables, records: DataFrame, rate_list: DataFrame) -> DataFrame:
    return contracts.charterparties(records, rate_list, documents(t), vessel_dim(t), as_of())


@query("silver_charterparties", combined_sql())
def silver_charterparties(t: Tables) -> DataFrame:
    return bare(combined(t, *stored(t)))


@query("silver_charterparties_option", option_sql())
def silver_option(t: Tables) -> DataFrame:
    return bare(contracts.options(*stored(t), as_of()))


@query("silver_charterparties_all", all_sql())
def silver_all(t: Tables) -> DataFrame:
    records, rate_list = stored(t)
    options = contracts.options(records, rate_list, as_of())
    return bare(contracts.contracts_all(combined(t, records, rate_list), options, vessel_dim(t)))


@query(
    "contract_slices",
    f"""SELECT o_orderkey AS "contractId", {TYPE} AS "contractType" FROM orders
        WHERE o_orderkey % 3 IN (0, 2)""",
)
def contract_slices(t: Tables) -> DataFrame:
    own = plain_contracts(t).select("contractId", "contractType")
    return slice_by(own, "contractType", "charterparty", "option")


@query(
    "union_contracts",
    f"""SELECT o_orderkey AS "contractId", o_totalprice AS price, CAST(NULL AS VARCHAR) AS status
        FROM orders WHERE o_orderkey % 3 = 0
        UNION ALL SELECT o_orderkey, NULL, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0""",
)
def union_contracts(t: Tables) -> DataFrame:
    key = F.col("o_orderkey").alias("contractId")
    a = t.orders.where("o_orderkey % 3 = 0").select(key, F.col("o_totalprice").alias("price"))
    b = t.orders.where("o_orderkey % 3 <> 0").select(F.col("o_orderstatus").alias("status"), key)
    return nested.union_aligned(a, b)


@query(
    "contracts_all",
    f"""SELECT CAST(o_orderkey AS VARCHAR) AS ship, {TYPE} AS kind, o_totalprice AS price FROM orders
        WHERE o_orderkey % 3 <> 2 OR o_custkey % 3 = 0""",
)
def contracts_all(t: Tables) -> DataFrame:
    """Two slices joined by name, the key of one turned to text first."""
    rows = t.orders.select("o_orderkey", F.expr(TYPE).alias("kind"), F.col("o_totalprice").alias("price"), "o_custkey")
    text = F.col("o_orderkey").cast("string").alias("ship")
    a = rows.where("kind <> 'option'").select("kind", "price", text)
    b = rows.where("kind = 'option' AND o_custkey % 3 = 0").select(text, "kind", "price")
    return nested.union_aligned(a, b)


@query(
    "null_when_type",
    f"""SELECT o_orderkey, {TYPE} AS kind, CASE WHEN o_orderkey % 3 <> 1 THEN o_totalprice END AS price,
        CASE WHEN o_orderkey % 3 <> 1 THEN o_orderpriority END AS priority FROM orders""",
)
def null_when_type(t: Tables) -> DataFrame:
    rows = t.orders.select(
        "o_orderkey", F.expr(TYPE).alias("kind"), F.col("o_totalprice").alias("price"),
        F.col("o_orderpriority").alias("priority"),
    )
    return nested.null_when(rows, F.col("kind") == "extension", ["price", "priority"])


# -- a few very large pages ----------------------------------------------------------------------


@query("silver_charterparties_extension_few_pages", header_sql("o_orderkey % 3 = 1"))
def silver_extension_few_pages(t: Tables) -> DataFrame:
    landed = few_pages(contract_pages(t, ("o_orderkey",)), "contracts")
    return bare(contracts.extensions(contracts.contract_records(landed, ("header",))))


@query("silver_charterparties_rates_few_pages", RATE_LIST_SQL)
def silver_rates_few_pages(t: Tables) -> DataFrame:
    landed = few_pages(rate_pages(t, ("l_orderkey", "l_linenumber")), "contracts")
    return bare(contracts.rates(contracts.contract_records(landed, ("rates",))))

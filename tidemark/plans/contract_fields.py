"""Contract documents: which fields exist, where they sit and how each becomes a silver column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions import dates, scalars
from tidemark.functions.json import json_decimal, strings, struct_of

# Silver column, kind, and the source path where it differs from the column name.
# The order is the order of the silver table.
FIELDS = """
contractId long
contractType text
contractPeriod text
shipImoNr text
shipName text
charterType charter_type
chartererId long
chartererName text
currentOwnerId long
ownerName text
brokerId long
brokerName text
brokerIsCompetitive flag
addendumDate text
addendumNumber text
bodApprovalDate text
bod_approval_date_charterer text
canDate time
cancellingDate time
cancellingDateIsUtc flag
charterPartyId text
cpDate time
created time
declarationDate time
declarationType text
deliveryDate time
deliveryPortArea blank
deliveryPortPlace text
deliveryStatus text
dryDockClauseComment text
etsClause flag
etsComment text
etsNotifyChartererWithin text
etsOptionToSettleEuaInCash text
etsOptionToSettleEuaInCashPeriod text
etsPaymentFulfilment text
etsReportingPeriod text
etsReportingPeriodSplit text
etsReportingRedelivery text
etsReportingRedeliveryDays text
etsReportingRedeliveryMonths text
etsSettlementRedelivery text
etsSettlementRedeliveryDays text
etsSettlementRedeliveryMonths text
etsTransferOfEuaToOwner text
etsTransferOfEuaToOwnerDate text
etsTransferOfEuaToOwnerNumeric text
extensionDate text
fixtureDate text
fromDate time
fromDateIsPlanned flag
fromDateTimezone text
toDate time
toDateIsPlanned flag
toDateTimezone text
hasPersistedLumpsums flag
hireInvoiceRequired flag
ifrsRelevant text
isDryDockClause flag
lastModified text
layDate time
layDateIsUtc flag
laydaysDate time
mainTermsDate text
optionToAddOffhireDays text
optionToAddOffhireDaysComment text
option_type text
period text
fixerEmail text
postfixerEmail text
rateBillingPeriod first_period rbp
rateBillingPeriodComment first_period comment
rate_ceiling text
rate_comment text
rate_discount_premium decimal
rate_floor text
rate_review_period text
rate_type rate_type
redeliveryDate time
redeliveryEndDate time
redeliveryPlan text
redeliveryPortPlace text
redeliveryRange text
redeliveryStartDate time
redeliveryStatus text
bunker_clause flag
bunker_clause_comment text
war_insurance_clause flag
war_insurance_arranged_by text
war_insurance_paid_by text
ciiClause flag
ciiComment text
ciiRatingAtDelivery text
ciiRatingAtRedelivery text
comments text
commentsForNextExtension text
addressCommissionAmount amount addressCommission
account_id text external_fields.account_id
crmd_commission text external_fields.crmd_commission
earliesttcenddateupdate time external_fields.crmd_earliesttcenddateupdate
finalizedrate decimal external_fields.crmd_finalizedrate
crmd_hull text external_fields.crmd_hull
crmd_name text external_fields.crmd_name
fixture_id text external_fields.fixture_id
rate_id text external_fields.rate_id
statuscode long external_fields.statuscode
statuscodeName text external_fields.statuscodeName
"""

# Labels of two coded columns.
CHARTER_TYPES = {"time_charter": "Time Charter", "bareboat_charter": "Bare Boat"}
RATE_TYPES = {"fixed": "Fixed", "contex": "Contex", "market_evaluation": "Market"}

# Columns filled from outside systems, which an extension does not own.
EXTERNAL = (
    "crmd_hull crmd_commission rate_id account_id fixture_id statuscode statuscodeName "
    "finalizedrate earliesttcenddateupdate"
).split()

# Members of the child lists; all of them text unless a type is given.
LUMP_SUM = "type ls_unit ls_amount ls_comment ls_currency rate_number lump_sum_uuid"
RATE = [
    ("rate", "string"), ("special", "boolean"), ("currency", "string"), ("rate_uuid", "string"),
    ("valid_from", "string"), ("lump_sums", f"array<{strings(LUMP_SUM)}>"),
]
AT_COST = "at_cost_type at_cost_unit at_cost_amount at_cost_comment"
COMMISSION = (
    "amount end_date broker_id absolute_payment ceiling_currency deduct_from_hire "
    "absolute_payment_currency absolute_payment_rate_billing_period"
)
NOTICE = "nr_days date_to_tender date_to_tender_formatted is_definite"
PREMIUM = "start end type uuid amount comment"
PERIODS = "rbp comment"

CHILDREN = {
    "rates": f"array<{struct_of(RATE)}>",
    # Lists of at-cost items arrive as text in some releases, so they are parsed in a second step.
    "atCost": "string",
    "brokerageCommission": f"array<{strings(COMMISSION)}>",
    "deliveryNotices": f"array<{strings(NOTICE)}>",
    "redeliveryNotices": f"array<{strings(NOTICE)}>",
    "premiums": f"array<{strings(PREMIUM)}>",
}

SOURCE_TYPES = {"long": "bigint", "flag": "boolean", "decimal": "double"}


def lines() -> list[tuple[str, str, str]]:
    """(column, kind, source path) of every header column."""
    out = []
    for line in FIELDS.split("\n"):
        if line:
            name, kind, *path = line.split()
            out.append((name, kind, path[0] if path else name))
    return out


def header_schema() -> list[tuple[str, str]]:
    """Parse schema of the header as (path, type). The id is read as text: see ``contract_id``."""
    fields = [
        (path, SOURCE_TYPES.get(kind, "string"))
        for _, kind, path in lines() if kind != "first_period" and path != "contractId"
    ]
    return [*fields, ("rateBillingPeriods", f"array<{strings(PERIODS)}>")]


def document_schema(parts: tuple[str, ...] = ("header", *CHILDREN)) -> str:
    """Schema of a contract holding only the parts asked for, so that nothing else is materialised."""
    fields = [("contractId", "string"), ("rate_review_period", "string")]
    for part in parts:
        fields += header_schema() if part == "header" else [(part, CHILDREN[part])]
    return struct_of(fields)


def column(kind: str, path: str, doc: str = "c") -> Column:
    """The silver expression of one header column."""
    c = F.col(f"{doc}.{path}") if kind != "first_period" else None
    match kind:
        case "long":
            return scalars.to_long(c)
        case "flag":
            return scalars.bool_to_int(c)
        case "time":
            return dates.iso_ts(c)
        case "blank":
            return scalars.blank_to_null(c)
        case "decimal":
            return scalars.to_decimal(c)
        case "amount":
            return json_decimal(c, "$.amount")
        case "charter_type":
            return scalars.label_map(c, CHARTER_TYPES)
        case "rate_type":
            return scalars.label_map(c, RATE_TYPES)
        case "first_period":
            value = scalars.first_of(F.col(f"{doc}.rateBillingPeriods"), path)
            return scalars.blank_to_null(value) if path == "comment" else value
    return c

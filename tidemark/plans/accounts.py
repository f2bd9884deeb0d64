"""Silver tables of directory accounts and cloud-directory accounts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.dates import date_or_default, zone_minus_minute
from tidemark.functions.json import struct_of, strings
from tidemark.functions.scalars import first_of, strip_ws
from tidemark.operators.nested import explode_parsed, page_records, parse_object, stamp
from tidemark.operators.select import distinct_rows

# Members of both account documents.
PROPERTIES = "givenName sn mail employeeID lastLogon whenCreated"
PERSON = "givenName surname displayName mail userPrincipalName createdDateTime"
SIGN_IN = (
    "lastSignInDateTime lastSignInRequestId lastNonInteractiveSignInDateTime "
    "lastNonInteractiveSignInRequestId lastSuccessfulSignInDateTime lastSuccessfulSignInRequestId"
)

ACCOUNT = struct_of(
    [
        ("dn", "string"), ("accountStatus.isDisabled", "boolean"),
        ("accountStatus.expirationDate", "string"),
        *[(f"properties.{name}", "array<string>") for name in PROPERTIES.split()],
    ]
)
CLOUD_ACCOUNT = struct_of(
    [
        *[(name, "string") for name in PERSON.split()], ("accountEnabled", "boolean"),
        ("id", "string"), ("signInActivity", strings(SIGN_IN)),
    ]
)
CLOUD_PAGE = struct_of([("value", f"array<{CLOUD_ACCOUNT}>")])


def directory_accounts(pages: DataFrame, load_ts: Column | None = None) -> DataFrame:
    """Distinct accounts of all pages given."""
    rows = parse_object(page_records(pages), "_text", ACCOUNT, "u")

    def first(name: str) -> Column:
        return first_of(f"u.properties.{name}")

    out = rows.select(
        "u.dn", first("givenName").alias("firstName"), first("sn").alias("lastName"),
        first("mail").alias("email"), strip_ws(first("employeeID")).alias("SFUserId"),
        date_or_default(first("lastLogon")).alias("lastLogon"),
        date_or_default(first("whenCreated")).alias("whenCreated"),
        "u.accountStatus.isDisabled",
        zone_minus_minute("u.accountStatus.expirationDate").alias("expirationDate"),
    )
    return stamp(distinct_rows(out), load_ts, "LoadDateUTC")


def cloud_accounts(pages: DataFrame, load_ts: Column | None = None) -> DataFrame:
    rows = explode_parsed(parse_object(pages, "Raw_data", CLOUD_PAGE), ["_parsed.value"], into="u")
    out = rows.select(
        *[f"u.{name}" for name in PERSON.split()],
        F.col("u.accountEnabled").cast("string").alias("accountEnabled"), "u.id",
        *[f"u.signInActivity.{name}" for name in SIGN_IN.split()],
    )
    return stamp(out, load_ts, "LoadDateUTC")

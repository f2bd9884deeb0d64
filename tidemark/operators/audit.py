"""Audit rows, bronze rows and the checks made on them."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.json import to_json_text
from tidemark.operators.select import exclude
from tidemark.plans.layers import ATTEMPT, names

# Members whose content never reaches a table.
SECRET_KEYS = "token access_token refresh_token assertion apikey api_key password client_secret"
MASK = "***"


def redact(df: DataFrame, columns: Sequence[str], keys: str = SECRET_KEYS) -> DataFrame:
    """Mask the values of secret members in JSON text and in url query strings."""
    words = "|".join(keys.split())
    in_json = rf'(?i)("(?:{words})"\s*:\s*)"(?:[^"\\]|\\.)*"'
    in_url = rf"(?i)([?&;](?:{words})=)[^&\s#\"]*"
    return df.withColumns(
        {
            c: F.regexp_replace(
                F.regexp_replace(F.col(c), in_json, rf'$1"{MASK}"'), in_url, rf"$1{MASK}"
            )
            for c in columns
        }
    )


def truncate_body(df: DataFrame, n: int | None, col: str = "response_body") -> DataFrame:
    return df if n is None else df.withColumn(col, F.substring(col, 1, n))


def attempts_to_audit(
    attempts: DataFrame, batch_id: str | Column, api_type: str | Column = "REST",
    context: str | Column | None = None, body_chars: int | None = None,
) -> DataFrame:
    """One audit row per request sent, secrets masked before the body is cut."""

    def col(c: str | Column | None) -> Column:
        return c if isinstance(c, Column) else F.lit(c).cast("string")

    safe = redact(attempts, ["api_url", "request_body", "response_body", "error_message"])
    full = truncate_body(safe, body_chars).withColumns(
        {
            "EventID": F.uuid(),
            "batch_run_id": col(batch_id),
            "api_type": col(api_type),
            "execution_context": col(context),
        }
    )
    return full.select(*names(ATTEMPT))


def explode_attempts(results: DataFrame, attempts: str = "attempts") -> DataFrame:
    """Results that carry their attempts as an array, as one row per attempt."""
    others = [c for c in results.columns if c != attempts]
    return results.select(*others, F.inline(attempts))


def has_records(body: str | Column, path: str | None = None) -> Column:
    """Whether a page holds records.

    Without ``path`` a page is empty if it is ``[]`` or an object whose ``value`` is ``[]``. With one,
    such as ``$.results``, the array there has to have elements.
    """
    text = F.col(body) if isinstance(body, str) else body
    if path:
        return F.coalesce(F.json_array_length(F.get_json_object(text, path)), F.lit(0)) > 0
    root = F.coalesce(F.json_array_length(text), F.lit(-1))
    value = F.coalesce(F.json_array_length(F.get_json_object(text, "$.value")), F.lit(-1))
    return (root != 0) & ((root > 0) | (value != 0))


def non_empty(df: DataFrame, body: str = "response_body", path: str | None = None) -> DataFrame:
    """Leave out pages without records."""
    return df.where(has_records(body, path))


def to_bronze(
    attempts: DataFrame, batch_id: str | Column, ingestion_ts: Column,
    keep_failures: bool = False, records_path: str | None = None, key: str | None = None,
) -> DataFrame:
    """One bronze row per successful page that has records, with the call summary as JSON.

    ``keep_failures`` also lands the last attempt of each failed request, flagged as normalised so
    that it is never parsed. ``key`` puts the request's input value in front under that name.
    """
    failed = F.col("status") == "FAILED"
    lands = (F.col("status") == "SUCCESS") & has_records("response_body", records_path)
    rows = attempts.where(lands | failed if keep_failures else lands)
    meta = to_json_text(
        F.col("status").alias("Status"), F.col("error_message").alias("ErrorMessage"),
        F.col("response_code").alias("HttpStatus"),
        F.date_format("request_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("Timestamp"),
        F.col("page_no"),
    )
    batch = batch_id if isinstance(batch_id, Column) else F.lit(batch_id)
    front = [F.col("input_value").alias(key)] if key else []
    return rows.select(
        *front,
        F.col("response_body").alias("Raw_data"),
        meta.alias("Api_metadata"),
        failed.alias("_is_normalized"),
        batch.alias("_Batch_run_id"),
        ingestion_ts.alias("_ingestion_ts"),
    )


def final_attempt(
    attempts: DataFrame, by: Sequence[str] = ("source", "page_no"),
    order: Sequence[str] = ("attempt_number", "request_timestamp"),
    take: Sequence[str] = ("status", "response_code"),
) -> DataFrame:
    """The last attempt of each request and how many there were."""
    last = F.max(F.struct(*order, *[F.col(c).alias(f"_{c}") for c in take]))
    return (
        attempts.groupBy(*by)
        .agg(last.alias("_last"), F.count(F.lit(1)).alias("attempts"))
        .select(*by, "attempts", *[F.col(f"_last._{c}").alias(c) for c in take])
    )


def failed_requests(
    attempts: DataFrame, by: Sequence[str] = ("source", "page_no"), **how
) -> DataFrame:
    return final_attempt(attempts, by, **how).where(F.col("status") != "SUCCESS")


def raise_on_failed(
    attempts: DataFrame, by: Sequence[str] = ("source", "page_no"), tolerate: int = 0,
    client_errors: range = range(400, 429), report: Callable[[DataFrame], str] | None = None,
) -> int:
    """Stop the run if more than ``tolerate`` requests failed; returns how many did.

    Called after the audit rows are written. ``report`` writes the list of failed requests to a table
    and returns its name for the message; without it the message itself lists them all.
    """
    failed = failed_requests(attempts, by)
    refused = F.col("response_code").between(client_errors.start, client_errors.stop - 1)
    row = failed.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(refused.cast("int")), F.lit(0)).alias("c")
    ).first()
    if row["n"] > tolerate:
        if report:
            where = f"listed in {report(failed)}"
        else:
            where = str([tuple(r[c] for c in by) for r in failed.select(*by).orderBy(*by).toLocalIterator()])
        raise RuntimeError(f"{row['n']} request(s) failed, {row['c']} of them refused by the service: {where}")
    return row["n"]


def source_status(
    attempts: DataFrame, source: str = "source", body: str = "response_body"
) -> DataFrame:
    """Outcome per source: SUCCESS, PARTIAL (some pages landed, then one failed), EMPTY or FAILED."""
    flagged = attempts.select(
        source, "page_no", "attempt_number", "request_timestamp", "status",
        has_records(body).alias("full"),
    )
    pages = final_attempt(flagged, (source, "page_no"), take=("status", "full"))
    good = F.col("status") == "SUCCESS"
    counted = pages.groupBy(source).agg(
        F.count_if(good).alias("ok"), F.count_if(~good).alias("failed"),
        F.count_if(good & F.col("full")).alias("landed"),
    )
    status = (
        F.when((F.col("failed") > 0) & (F.col("ok") > 0), "PARTIAL")
        .when(F.col("failed") > 0, "FAILED").when(F.col("landed") == 0, "EMPTY")
        .otherwise("SUCCESS")
    )
    return counted.withColumn("status", status)


def page_record_counts(
    pages: DataFrame, path: str | None, key: Sequence[str | Column], body: str = "Raw_data"
) -> DataFrame:
    """Records per page, without unfolding them."""
    text = F.col(body) if path is None else F.get_json_object(F.col(body), path)
    return pages.select(
        *key, F.coalesce(F.json_array_length(text), F.lit(0)).cast("bigint").alias("records")
    )


def is_sentinel(total: Column, body: Column, short: int = 200) -> Column:
    """A 'success' that is an error in disguise: total -1 and hardly any body."""
    return (total == -1) & (F.length(F.coalesce(body, F.lit(""))) < short)


def audit_summary(attempts: DataFrame, by: Sequence[str] = ("api_type", "status")) -> DataFrame:
    return attempts.groupBy(*by).agg(
        F.count(F.lit(1)).alias("attempts"), F.min("duration_ms").alias("min_ms"),
        F.max("duration_ms").alias("max_ms"), F.sum("duration_ms").alias("total_ms"),
    )


def high_water_mark(
    spark: SparkSession, audit: DataFrame | None, default: str = "1900-02-09 12:15:03",
    full_refresh: bool = False, strict: bool = True, batch: str = "batch_run_id",
    request: Sequence[str] = ("api_url", "input_value", "request_body"),
) -> DataFrame:
    """One row with the time of the last success, from which the next run asks for changes.

    With ``strict`` only batches count whose every request ended well, so that a run which lost a page
    does not move the mark past it. The default holds for a full refresh, and where the table is
    missing or has no success.
    """
    fallback = F.lit(default).cast("timestamp")
    if full_refresh or audit is None:
        return spark.range(1).select(fallback.alias("modified_since"))
    good = audit.where(F.col("status") == "SUCCESS")
    if strict:
        broken = failed_requests(audit, (batch, *request), take=("status",)).select(batch)
        good = exclude(good, broken, [batch])
    last = F.max("request_timestamp").cast("timestamp")
    return good.agg(F.coalesce(last, fallback).alias("modified_since"))

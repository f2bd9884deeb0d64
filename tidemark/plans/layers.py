"""Schemas of the audit and bronze layers. Column names and types of both tables."""

ATTEMPT = """
    EventID string, batch_run_id string, api_type string, http_method string, api_url string,
    input_value string, request_body string, attempt_number int, request_timestamp timestamp,
    response_code int, response_body string, duration_ms bigint, status string,
    error_message string, execution_context string
"""

BRONZE = """
    Raw_data string, Api_metadata string, _is_normalized boolean, _Batch_run_id string,
    _ingestion_ts timestamp
"""

# Attempts as they come from the executors: one row per request sent, with the position of the
# request in its source and the undivided body.
FETCHED = """
    source string, page_no int, http_method string, api_url string, input_value string,
    request_body string, attempt_number int, request_timestamp timestamp, response_code int,
    response_body string, duration_ms bigint, status string, error_message string
"""


def names(ddl: str) -> list[str]:
    return [part.split()[0] for part in ddl.replace("\n", " ").split(",")]

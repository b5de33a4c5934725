"""Column rules for requests and responses: outcomes, typed errors, retry timing, keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import strip

DAY_MS = 86_400_000

# The closed vocabulary of error types.
ERROR_TYPES = (
    "invalid_request_error",
    "authentication_error",
    "permission_error",
    "rate_limit_error",
    "internal_error",
    "configuration_error",
    "network_error",
    "api_error",
    "unknown_error",
)

# Type, code and message used when a body carries none.
STATUS_TYPES = {
    400: "invalid_request_error",
    401: "authentication_error",
    403: "permission_error",
    422: "invalid_request_error",
    429: "rate_limit_error",
}
STATUS_CODES = {
    400: "bad_request",
    401: "unauthorized",
    403: "forbidden",
    404: "not_found",
    422: "unprocessable_entity",
    429: "rate_limited",
}
STATUS_MESSAGES = {
    400: "Request was malformed.",
    401: "Authentication failed — check your publishable key + environment.",
    403: "Authenticated, but not permitted to perform this action.",
    404: "Endpoint not found.",
    422: "Request payload failed validation.",
    429: "Rate limit exceeded — back off and retry.",
}
SERVER_ERROR_MESSAGE = "Server error — the service will retry."


def classify_outcome(status: Column) -> Column:
    """success, permanent or retryable; no status at all is retryable."""
    lasting = status.between(400, 499) & ~status.isin(408, 429)
    return F.when(status.between(200, 299), "success").when(lasting, "permanent").otherwise("retryable")


def _by_status(status: Column, table: dict[int, str], server: Column, other: Column) -> Column:
    picked = F.create_map(*[F.lit(x) for pair in table.items() for x in pair])[status]
    return F.coalesce(picked, F.when(status.between(500, 599), server).otherwise(other))


def decode_error_envelope(
    status: Column, body: Column, header_request_id: Column, server_message: str = SERVER_ERROR_MESSAGE
) -> Column:
    """Struct of type, code, message, request_id, status from a response.

    Values in the JSON body's ``error`` object win; the rest follow from the status. An
    ``error`` object whose type is absent or unknown is an internal_error.
    """

    def given(field: str) -> Column:
        return F.nullif(F.get_json_object(body, f"$.error.{field}"), F.lit(""))

    has_error = F.get_json_object(body, "$.error").startswith("{")
    wire_type = F.get_json_object(body, "$.error.type")
    body_type = F.when(has_error, F.when(wire_type.isin(*ERROR_TYPES), wire_type).otherwise("internal_error"))
    internal = F.lit("internal_error")
    numbered = status.cast("string")
    return F.struct(
        F.coalesce(body_type, _by_status(status, STATUS_TYPES, internal, internal)).alias("type"),
        F.coalesce(
            given("code"),
            _by_status(status, STATUS_CODES, F.lit("server_error"), F.concat(F.lit("http_"), numbered)),
        ).alias("code"),
        F.coalesce(
            given("message"),
            _by_status(
                status,
                STATUS_MESSAGES,
                F.lit(server_message),
                F.concat(F.lit("Request failed with HTTP "), numbered, F.lit(".")),
            ),
        ).alias("message"),
        F.coalesce(given("request_id"), header_request_id).alias("request_id"),
        status.alias("status"),
    )


def parse_retry_after(value: Column, received_ms: Column) -> Column:
    """Milliseconds to wait: delta seconds, or an HTTP date measured from ``received_ms``."""
    raw = strip(value)
    seconds = F.when(raw.rlike("^[+-]?[0-9]+$"), raw.try_cast("bigint"))
    date = F.try_to_timestamp(
        F.regexp_replace(raw, "^[A-Za-z]{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss z")
    )
    wait = F.greatest(F.unix_millis(date) - received_ms, F.lit(0).cast("bigint"))
    return F.when(seconds.isNotNull(), F.when(seconds >= 0, F.try_multiply(seconds, F.lit(1000)))).when(date.isNotNull(), wait)


def retry_ceiling(
    retry_no: Column,
    retry_after_ms: Column,
    base_ms: int = 1000,
    max_ms: int = 30_000,
    max_attempts: int = 5,
) -> Column:
    """Longest wait before retry ``retry_no`` (from 0); null once retries are used up.

    A positive Retry-After wins, up to 24 hours; otherwise the doubling backoff, capped.
    """
    backoff = F.least(F.lit(base_ms) * F.pow(F.lit(2.0), F.least(retry_no, F.lit(30))), F.lit(float(max_ms)))
    return F.when(
        retry_no < max_attempts,
        F.when(retry_after_ms > 0, F.least(retry_after_ms, F.lit(DAY_MS))).otherwise(backoff.cast("bigint")),
    )


def format_as_uuid(digest: Column) -> Column:
    """First 32 hex digits as 8-4-4-4-12."""
    return F.regexp_replace(
        F.substring(digest, 1, 32), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", r"$1-$2-$3-$4-$5"
    )


def idempotency_key(rail: Column, signed_info: Column, token: Column, namespace: str) -> Column:
    """Stable key of a purchase sync; null when the rail has no identifier.

    ``namespace`` is the wire prefix both ends agree on.
    """
    identifier = F.nullif(F.when(rail == "apple", signed_info).when(rail == "google", token), F.lit(""))
    return format_as_uuid(F.sha2(F.concat(F.lit(f"{namespace}:purchases/sync:"), rail, F.lit(":"), identifier), 256))


def user_slot(user: Column) -> Column:
    """Hash that separates users' stored rows; one shared slot when there is no user."""
    return F.when(F.coalesce(user, F.lit("")) == "", "_anon").otherwise(F.sha2(user, 256))

"""Debug signals as counts.

Each function lists the counts one table yields, as aggregate columns named after the signal. Use them with
``observed`` on a batch or stream on its way to a sink, or in a plain ``agg``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

# The signal vocabulary.
SIGNALS = (
    "sdk.configured",
    "sdk.first_event_sent",
    "sdk.invalid_key",
    "sdk.no_identity",
    "sdk.entitlement_cache_used",
    "sdk.purchase_evidence_sent",
    "sdk.environment_mismatch",
    "sdk.sensitive_property_warning",
    "sdk.property_coerced",
    "sdk.queue_persisted",
    "sdk.queue_restored",
    "sdk.flush_retry_scheduled",
    "sdk.flush_permanent_failure",
    "sdk.consent_changed",
    "sdk.consent_denied",
    "sdk.consent_dnt_applied",
    "sdk.pii_scrubbed",
)


def _count(signal: str, when: Column) -> Column:
    name = f"sdk.{signal}"
    assert name in SIGNALS
    return F.count_if(F.coalesce(when, F.lit(False))).alias(signal)


def event_signals() -> list[Column]:
    """Of cleaned events (``clean_events``)."""
    redacted = F.contains("properties", F.lit("<email>")) | F.contains("properties", F.lit("<card>"))
    return [
        F.coalesce(F.sum(F.size("warnings")), F.lit(0)).alias("property_coerced"),
        _count("sensitive_property_warning", F.size("sensitive_keys") > 0),
        _count("no_identity", F.coalesce("developer_user_id", F.lit("")) == ""),
        _count("pii_scrubbed", redacted),
    ]


def gate_signals() -> list[Column]:
    """Of rows with the ``reject_code`` of ``ingest_gate``."""
    code = F.col("reject_code")
    return [_count("invalid_key", code == "invalid_secret_key"), _count("environment_mismatch", code == "env_mismatch")]


def session_signals() -> list[Column]:
    """Of process starts: ``restored_events`` is what the device had kept from before."""
    return [_count("configured", F.lit(True)), _count("queue_restored", F.col("restored_events") > 0)]


def consent_signals() -> list[Column]:
    """Of events with the consent of ``attach_consent``, before the gate."""
    is_error = F.col("name") == "$error"
    return [_count("consent_denied", F.when(is_error, ~F.col("consent_errors")).otherwise(~F.col("consent_analytics")))]


def consent_log_signals() -> list[Column]:
    """Of the consent log; ``do_not_track`` marks rows the device's setting caused."""
    return [_count("consent_changed", ~F.col("do_not_track")), _count("consent_dnt_applied", F.col("do_not_track"))]


def delivery_signals() -> list[Column]:
    """Of ``delivery_outcomes``."""
    state = F.col("state")
    return [
        _count("queue_persisted", state == "delivered"),
        _count("flush_retry_scheduled", state == "pending"),
        _count("flush_permanent_failure", state.isin("dropped_permanent", "retry_exhausted")),
    ]


def first_sent_signals() -> list[Column]:
    """Of ``first_event_sent``: one per scope."""
    return [_count("first_event_sent", F.lit(True))]


def entitlement_signals() -> list[Column]:
    """Of answered entitlement requests."""
    return [_count("entitlement_cache_used", F.col("entitled").isNotNull())]


def purchase_signals() -> list[Column]:
    """Of synced purchases (``billing_sync_result``)."""
    return [_count("purchase_evidence_sent", F.col("sync_error").isNull())]


def observed(df: DataFrame, name: str | Observation, signals: list[Column]) -> DataFrame:
    """Count signals on the way through. A named observation reaches listeners, an ``Observation`` the caller."""
    return df.observe(name, *signals)


class SignalTotals(StreamingQueryListener):
    """Adds up the observed signals of streaming queries."""

    def __init__(self):
        self.totals: dict[str, int] = {}

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for row in event.progress.observedMetrics.values():
            for name, count in row.asDict().items():
                self.totals[name] = self.totals.get(name, 0) + (count or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

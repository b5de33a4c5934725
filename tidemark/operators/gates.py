"""Row filters and rejections on the way in."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.privacy import PII_LABEL_WORDS, has_pii_label, is_opted_out, is_self_error
from .ordered import HOT_ROWS, as_of

# Names a deployment sets: publishable keys, the environment their prefix declares, and the mark that opts an element out.
KEY_PREFIX = "pub_"
LIVE_KEY_PREFIX = "pub_live_"
OPT_OUT_MARKER = "no-track"

# Keys of a contract-failure payload.
FAILURE_REQUIRED = ("contract_id", "sdk_version", "sdk_platform", "failure_reason", "run_context", "run_id")
FAILURE_OPTIONAL = ("test_file", "test_name", "device_class")


def ingest_gate(
    public_key: Column,
    environment: Column,
    app_id: Column,
    name: Column,
    key_prefix: str = KEY_PREFIX,
    live_prefix: str = LIVE_KEY_PREFIX,
) -> Column:
    """Reject code of a row, null if accepted. Start rules come before the event's own."""
    expected = F.when(public_key.startswith(live_prefix), "production").otherwise("sandbox")
    return (
        F.when(~F.coalesce(public_key.startswith(key_prefix), F.lit(False)), "invalid_secret_key")
        .when(~environment.eqNullSafe(expected), "env_mismatch")
        .when(F.coalesce(app_id, F.lit("")) == "", "missing_app_id")
        .when(F.coalesce(name, F.lit("")) == "", "missing_event_name")
    )


def split_rejects(df: DataFrame, reject_code: Column) -> tuple[DataFrame, DataFrame]:
    """Accepted rows, and rejected rows with their ``reject_code``."""
    marked = df.withColumn("reject_code", reject_code)
    return marked.filter("reject_code is null").drop("reject_code"), marked.filter("reject_code is not null")


def package_lock_gate(rows: DataFrame, apps: DataFrame, app: str = "app_id", claimed: str = "package_name") -> DataFrame:
    """Reject rows whose claimed package is empty or not the one registered for the app.

    ``apps`` has one row per app (``app``, ``registered_package``).
    """
    joined = rows.join(apps.select(app, "registered_package"), app, "left")
    same = (
        (F.coalesce("registered_package", F.lit("")) != "")
        & (F.coalesce(claimed, F.lit("")) != "")
        & F.col("registered_package").eqNullSafe(F.col(claimed))
    )
    return joined.withColumn("reject_code", F.when(~same, "package_name_not_allowed")).drop("registered_package")


def consent_gate(
    events: DataFrame,
    consent: DataFrame,
    opted_out: DataFrame | None = None,
    key: str = "dev",
    time: str = "ts_us",
    seq: str = "event_id",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Keep rows whose channel had consent when they happened; consent is granted by default.

    ``$error`` rows ask the errors channel, all others analytics. Devices in ``opted_out``
    (one row each) send nothing, whatever the log says later.
    """
    log = consent.select(key, time, seq, "analytics", "errors")
    held = as_of(events, {"__consent": log}, [key], time, seq, hot_rows)
    asked = F.when(F.col("name") == "$error", F.col("__consent.errors")).otherwise(F.col("__consent.analytics"))
    kept = held.filter(F.coalesce(asked, F.lit(True))).drop("__consent")
    return kept if opted_out is None else kept.join(opted_out.select(key), key, "left_anti")


def is_framework_screen(screen: Column) -> Column:
    hosts = screen.startswith("androidx.") | screen.startswith("android.") | screen.startswith("com.android.")
    preview = F.contains(screen, F.lit("ComposeActivity")) & F.contains(screen, F.lit("$Default"))
    return F.coalesce(hosts | preview, F.lit(False))


def drop_framework_screens(df: DataFrame, screen: str = "screen") -> DataFrame:
    return df.filter(~is_framework_screen(F.col(screen)))


def drop_pii_labels(df: DataFrame, description: str, words: Sequence[str] = PII_LABEL_WORDS) -> DataFrame:
    return df.filter(~has_pii_label(F.col(description), words))


def drop_opted_out(df: DataFrame, description: str, marker: str = OPT_OUT_MARKER) -> DataFrame:
    return df.filter(~is_opted_out(F.col(description), marker))


def drop_self_errors(df: DataFrame, host: str | None, messages: str = "messages") -> DataFrame:
    return df.filter(~is_self_error(F.col(messages), host))


def before_send(df: DataFrame, hook: Callable[[DataFrame], DataFrame] | None) -> DataFrame:
    """Let the caller drop or rewrite error rows; what the hook returns is what ships."""
    return df if hook is None else df.transform(hook)


HOOK_FAILED = "hook_failed"


def run_hook(df: DataFrame, hook: Callable[[dict], dict | None], error: str = "hook_error") -> DataFrame:
    """Let a function of one row drop (None) or rewrite each row; what it returns is what ships.

    A row for which the hook raises, or returns what is no row of these columns, comes out as it went in with ``error``
    set; all others have null there. Hand the result to ``to_dead_letter`` with that column. Rows reach the hook in
    Arrow batches, one dict each; columns that the hook leaves out are null.
    """
    schema = T.StructType([*df.schema.fields, T.StructField(error, T.StringType())])
    names = df.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.schema
            kept: list[dict] = []
            for at, row in enumerate(batch.to_pylist()):
                failed = None
                try:
                    made = hook(dict(row))
                    if made is None:
                        continue
                    made = {n: made.get(n) for n in names}
                    # A row that Arrow cannot take must not cost the batch.
                    pa.RecordBatch.from_pylist([made], schema=own)
                except Exception as raised:  # whatever a caller's code raises concerns its row alone
                    made, failed = batch.slice(at, 1).to_pylist()[0], f"{HOOK_FAILED}: {type(raised).__name__}"
                kept.append({**made, error: failed})
            yield pa.RecordBatch.from_pylist(kept, schema=own.append(pa.field(error, pa.string())))

    return df.mapInArrow(run, schema)


def lock_schema(
    payload: Column, required: Sequence[str] = FAILURE_REQUIRED, optional: Sequence[str] = FAILURE_OPTIONAL
) -> Column:
    """Struct of the payload with only allowed keys (null if none is left) and the required keys it lacks."""
    allowed = F.array_union(F.array(*map(F.lit, required)), F.array(*map(F.lit, optional)))
    kept = F.map_filter(payload, lambda k, _: F.array_contains(allowed, k))
    return F.struct(
        F.when(F.size(kept) > 0, kept).alias("payload"),
        F.array_except(F.array(*map(F.lit, required)), F.map_keys(kept)).alias("missing"),
        F.array_except(F.map_keys(payload), allowed).alias("refused"),
    )

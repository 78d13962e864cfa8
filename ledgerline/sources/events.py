"""Adapter: the generic ``events`` table -> the 10-field transaction stream.

Column rules (all integer / DECIMAL arithmetic, so every engine agrees):
k from props.k; status from event_type; category from k; channel, country and
the fraud label from integer hashes of event_id; currency from user_id; amount
from value. Works on batch and streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.timecols import wallclock_to_instant
from ledgerline.operators import shaping as S
from ledgerline.schemas import TRANSACTION_COLUMNS

# Fixed values (adapter): event_type -> status. Click rows keep a lower-case
# status so the upper-casing of the enrichment is exercised.
STATUS_BY_EVENT_TYPE = (("error", "FAILED"), ("signup", "PENDING"), ("click", "success"))
DEFAULT_STATUS = "SUCCESS"


def status_from_event_type(event_type="event_type") -> Column:
    c = F.col(event_type) if isinstance(event_type, str) else event_type
    expr = None
    for name, status in STATUS_BY_EVENT_TYPE:
        expr = F.when(c == name, status) if expr is None else expr.when(c == name, status)
    return expr.otherwise(F.lit(DEFAULT_STATUS))


def with_dimensions(events: DataFrame) -> DataFrame:
    """Adds k and the categorical columns."""
    # Parse props once; everything below refers to the k column.
    with_k = events.select("*", F.get_json_object("props", "$.k").try_cast("int").alias("k"))
    return with_k.select(
        "*",
        status_from_event_type().alias("status"),
        S.weighted_pick("k", S.CATEGORY_WEIGHTS).alias("merchant_category"),
        S.weighted_pick(S.hash_draw("event_id", S.CHANNEL_HASH, 100), S.CHANNEL_WEIGHTS).alias("channel"),
        S.weighted_pick(S.hash_draw("event_id", S.COUNTRY_HASH, 100), S.COUNTRY_WEIGHTS).alias("country"),
        S.pick_from_pool(F.col("user_id"), S.CURRENCIES).alias("currency"),
    )


def base_amount(value="value") -> Column:
    """Base amount before the category multiplier: value * 2 in DECIMAL.
    NaN, infinite or out-of-range values give null (no job failure)."""
    return F.col(value).try_cast("decimal(18,2)") * F.lit(2)


def keyed_transactions(events: DataFrame, seed: int | None = None) -> DataFrame:
    """Transactions plus the ``event_id`` key (needed by the uplift rule)."""
    dims = with_dimensions(events)
    shaped = dims.select(
        "*", S.shape_amount(base_amount(), "merchant_category").alias("amount")
    )
    return shaped.select(
        "event_id",
        S.transaction_id("event_id", seed).alias("transaction_id"),
        S.user_id(F.col("user_id")).alias("user_id"),
        "amount",
        "currency",
        "status",
        "merchant_category",
        "channel",
        "country",
        wallclock_to_instant("ts").alias("event_time"),
        S.fraud_label("event_id", S.fraud_probability_units()).alias("is_fraud"),
    )


def transactions_from_events(events: DataFrame, seed: int | None = None) -> DataFrame:
    """The 10-field transaction frame (event_time as TIMESTAMP, UTC wall clock)."""
    return keyed_transactions(events, seed).select(*TRANSACTION_COLUMNS)

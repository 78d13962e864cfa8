"""The older Kafka->Kafka job's semantics.

Case-sensitive status filter, flat 10 % discount, five-field payload whose
timestamp stays text. Different from ``enrich`` on purpose; both exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.params import DEFAULT_PARAMS, JobParams

LEGACY_TIMESTAMP_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def legacy(df: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """Keep status == 'SUCCESS' exactly; discounted_amount = amount * 0.9."""
    return df.filter(F.col("status") == F.lit("SUCCESS")).withColumn(
        "discounted_amount", F.col("amount") * F.lit(float(params.legacy_discount_factor))
    )


def legacy_records(transactions: DataFrame) -> DataFrame:
    """Five-field legacy records from transactions; timestamp as UTC ISO text."""
    from ledgerline.functions.timecols import instant_to_wallclock

    return transactions.select(
        "transaction_id",
        "user_id",
        "amount",
        "status",
        F.date_format(instant_to_wallclock("event_time"), LEGACY_TIMESTAMP_TEXT).alias("timestamp"),
    )

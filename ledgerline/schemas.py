"""Fixed schemas. Never inferred: one schema drives file reads and JSON parsing."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The wire format of a transaction record.
TRANSACTION = StructType(
    [
        StructField("transaction_id", StringType(), False),
        StructField("user_id", StringType(), False),
        StructField("amount", DoubleType(), False),
        StructField("currency", StringType(), True),
        StructField("status", StringType(), True),
        StructField("merchant_category", StringType(), True),
        StructField("channel", StringType(), True),
        StructField("country", StringType(), True),
        StructField("event_time", TimestampType(), False),
        StructField("is_fraud", DoubleType(), True),
    ]
)

ENRICHED = StructType(
    [
        StructField("transaction_id", StringType(), True),
        StructField("user_id", StringType(), True),
        StructField("event_time", TimestampType(), True),
        StructField("currency", StringType(), True),
        StructField("country", StringType(), True),
        StructField("merchant_category", StringType(), True),
        StructField("channel", StringType(), True),
        StructField("status", StringType(), True),
        StructField("gross_amount", DoubleType(), True),
        StructField("discount_rate", DoubleType(), True),
        StructField("net_amount", DoubleType(), True),
        StructField("is_fraud", DoubleType(), True),
        StructField("fraud_score", DoubleType(), True),
        StructField("is_flagged", BooleanType(), True),
    ]
)

WINDOWED = StructType(
    [
        StructField("window_start", TimestampType(), True),
        StructField("window_end", TimestampType(), True),
        StructField("event_count", LongType(), True),
        StructField("gross_value", DoubleType(), True),
        StructField("net_value", DoubleType(), True),
        StructField("flagged_count", LongType(), True),
        StructField("fraud_rate", DoubleType(), True),
    ]
)

# The older Kafka job's record, five fields; the timestamp stays text.
LEGACY_TRANSACTION = StructType(
    [
        StructField("transaction_id", StringType(), True),
        StructField("user_id", StringType(), True),
        StructField("amount", DoubleType(), True),
        StructField("status", StringType(), True),
        StructField("timestamp", StringType(), True),
    ]
)

ENRICHED_COLUMNS = [f.name for f in ENRICHED.fields]
TRANSACTION_COLUMNS = [f.name for f in TRANSACTION.fields]

# Timestamp text with microseconds and an explicit offset: lossless and
# independent of the reading session's time zone.
ISO_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def nullable(schema: StructType) -> StructType:
    """Same fields, all nullable: what file reads make of any declared schema."""
    return StructType([StructField(f.name, f.dataType, True, f.metadata) for f in schema.fields])


TRANSACTION_NULLABLE = nullable(TRANSACTION)

"""JSON payload encode / decode for message-bus records.

Works on any frame with a ``value`` column (binary or string), batch or
streaming, so the Kafka path is testable without a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.schemas import ISO_TIMESTAMP_FORMAT

JSON_OPTIONS = {"timestampFormat": ISO_TIMESTAMP_FORMAT}


def decode_json_payload(df: DataFrame, schema: StructType, column: str = "value", options=None) -> DataFrame:
    """value (binary/string) -> parsed struct -> flat columns. A malformed
    record becomes an all-null row (PERMISSIVE), as in the reference."""
    opts = dict(JSON_OPTIONS if options is None else options)
    parsed = F.from_json(F.col(column).cast("string"), schema, opts)
    return df.select(parsed.alias("_j")).select("_j.*")


def encode_json_payload(df: DataFrame, options=None, as_binary: bool = False) -> DataFrame:
    """Whole row -> JSON text in ``value`` (null fields omitted), no key."""
    opts = dict(JSON_OPTIONS if options is None else options)
    value = F.to_json(F.struct(*[F.col(c) for c in df.columns]), opts)
    return df.select((value.cast("binary") if as_binary else value).alias("value"))

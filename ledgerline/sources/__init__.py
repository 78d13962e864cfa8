"""Sources, sinks and payload codecs."""

from ledgerline.sources.events import transactions_from_events
from ledgerline.sources.payload import decode_json_payload, encode_json_payload
from ledgerline.sources.readers import (
    kafka_source_options,
    kafka_stream,
    ndjson_stream,
    parquet_stream,
    read_input,
    read_ndjson,
    read_output,
    read_transactions,
)
from ledgerline.sources.sinks import (
    append_metrics,
    kafka_sink_options,
    land_ndjson,
    start_debug_sink,
    start_kafka_sink,
    start_parquet_sink,
    write_full_copy,
)

__all__ = [
    "append_metrics",
    "decode_json_payload",
    "encode_json_payload",
    "kafka_sink_options",
    "kafka_source_options",
    "kafka_stream",
    "land_ndjson",
    "ndjson_stream",
    "parquet_stream",
    "read_input",
    "read_ndjson",
    "read_output",
    "read_transactions",
    "start_debug_sink",
    "start_kafka_sink",
    "start_parquet_sink",
    "transactions_from_events",
    "write_full_copy",
]

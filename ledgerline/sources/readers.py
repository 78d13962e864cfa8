"""Readers: streaming NDJSON directory, Kafka, Parquet table stream, output dirs.

S1 file source, S2 Kafka source, S5 source switch, S6 batch scan, S7 output
reader, S8 Parquet table as a stream.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamReader
from pyspark.sql.types import StructType

from ledgerline.params import DEFAULT_PARAMS, JobParams, byte_count
from ledgerline.schemas import ISO_TIMESTAMP_FORMAT, TRANSACTION
from ledgerline.sources.payload import decode_json_payload


def kafka_source_options(params: JobParams = DEFAULT_PARAMS) -> dict[str, str]:
    """Reader options; ``max_offsets_per_trigger`` bounds a micro-batch (the
    Kafka counterpart of ``maxFilesPerTrigger``)."""
    opts = {
        "kafka.bootstrap.servers": params.kafka_bootstrap,
        "subscribe": params.kafka_topic,
        "startingOffsets": params.starting_offsets,
    }
    if params.max_offsets_per_trigger:
        opts["maxOffsetsPerTrigger"] = str(int(params.max_offsets_per_trigger))
    return opts


def _bounded(reader: DataStreamReader, files: int | None, size: int | str | None) -> DataStreamReader:
    """Bound a file stream's micro-batch: by bytes if a size is given, else by files (None: no bound).

    By bytes a batch takes files while their sizes together stay within the bound, one
    file at least; Spark takes one of the two bounds."""
    if size:
        return reader.option("maxBytesPerTrigger", byte_count(size))
    return reader.option("maxFilesPerTrigger", int(files)) if files else reader


def ndjson_stream(
    spark: SparkSession,
    path: str,
    schema: StructType = TRANSACTION,
    max_files_per_trigger: int | None = 4,
    timestamp_format: str | None = None,
    max_bytes_per_trigger: int | str | None = None,
) -> DataFrame:
    """Streaming NDJSON directory with a fixed schema (never inferred).

    A micro-batch is bounded by files, or by bytes if ``max_bytes_per_trigger``
    (a number, or text like "512m") is given. Without ``timestamp_format``
    Spark's ISO fallback parser reads the text, so zone-less timestamps are read
    in the session zone (keep it UTC)."""
    reader = _bounded(spark.readStream.schema(schema), max_files_per_trigger, max_bytes_per_trigger)
    if timestamp_format:
        reader = reader.option("timestampFormat", timestamp_format)
    return reader.json(path)


def kafka_stream(spark: SparkSession, params: JobParams = DEFAULT_PARAMS, schema: StructType = TRANSACTION) -> DataFrame:
    """Kafka topic -> decoded flat transaction columns. Needs the
    spark-sql-kafka connector on the classpath (not bundled here)."""
    raw = spark.readStream.format("kafka").options(**kafka_source_options(params)).load()
    return decode_json_payload(raw, schema, options={})


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | str | None = None,
) -> DataFrame:
    """A Parquet table (directory or glob) as a stream, a micro-batch bounded by bytes, by files or not at all."""
    return _bounded(spark.readStream.schema(schema), max_files_per_trigger, max_bytes_per_trigger).parquet(path)


def read_transactions(
    spark: SparkSession,
    params: JobParams = DEFAULT_PARAMS,
    path: str | None = None,
    source: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame:
    """Source switch: 'kafka' (case-insensitive) -> Kafka; 'table' -> the
    Parquet transaction table at ``path`` as a stream; anything else -> the
    NDJSON directory at ``path``. The choice is an explicit argument with
    ``params.source`` as its default."""
    kind = (source or params.source or "file").lower()
    if kind == "kafka":
        return kafka_stream(spark, params)
    if kind == "table":
        if path is None:
            raise ValueError("table source needs a path")
        return parquet_stream(spark, path, TRANSACTION, params.max_files_per_trigger, params.max_bytes_per_trigger)
    if path is None:
        raise ValueError("file source needs a path")
    return ndjson_stream(
        spark, path, TRANSACTION, params.max_files_per_trigger, timestamp_format, params.max_bytes_per_trigger
    )


def read_input(
    spark: SparkSession,
    params: JobParams = DEFAULT_PARAMS,
    path: str | None = None,
    source: str | None = None,
    timestamp_format: str | None = None,
) -> DataFrame | None:
    """What :func:`read_transactions` streams, as a batch frame: for counting the
    real input. None for Kafka, whose topic may have lost what was read."""
    kind = (source or params.source or "file").lower()
    if kind == "kafka":
        return None
    if kind == "table":
        return spark.read.schema(TRANSACTION).parquet(path)
    reader = spark.read.schema(TRANSACTION)
    return (reader.option("timestampFormat", timestamp_format) if timestamp_format else reader).json(path)


def read_output(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Committed rows of a sink folder; an empty frame if nothing exists yet.

    For a streaming file sink Spark reads through its ``_spark_metadata``
    log, so files of uncommitted batches are never seen."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_ndjson(spark: SparkSession, path: str, schema: StructType = TRANSACTION) -> DataFrame:
    """Batch read of landed NDJSON with the lossless timestamp format."""
    return spark.read.schema(schema).option("timestampFormat", ISO_TIMESTAMP_FORMAT).json(path)

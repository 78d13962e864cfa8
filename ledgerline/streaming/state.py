"""What a window query holds back: its open windows, read from the checkpoint.

In append mode a window comes out once the watermark has passed its end; the
reference job never shows the others. Spark's state data source reads them from
the checkpoint of a query that has stopped or runs on.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, LongType, StructType

from ledgerline.functions.money import total_of
from ledgerline.operators.windows import MEASURES

_MONEY = ("gross_value", "net_value")


def _names(value: StructType) -> list[str]:
    """Names for the fields of a window's state, whose own names repeat.

    Counts, DECIMAL sums and double sums each come in the order in which the
    query's aggregates stand. Flags that are never null are counted with the rows.
    """
    counts = iter(("event_count", "flagged_count", "known_flags"))
    exact, rest = iter(_MONEY), iter(_MONEY)
    names, sums = [], ""
    for f in value.fields:
        if isinstance(f.dataType, LongType):
            names.append(next(counts))
        elif isinstance(f.dataType, DecimalType):
            sums = next(exact)
            names.append(f"{sums}_exact")
        elif isinstance(f.dataType, DoubleType):
            names.append(f"{next(rest)}_rest")
        else:  # whether the DECIMAL sum before it has seen no value
            names.append(f"{sums}_empty")
    return names


def open_windows(spark: SparkSession, checkpoint: str, batch: int | None = None) -> DataFrame:
    """The windows that the query of ``checkpoint`` holds in its state, with their measures so far.

    Rows look like those of the windowed sink; sink and state together hold every
    enriched row that was not dropped as late. ``batch`` reads the state as it was
    after that micro-batch (default: the last committed one).
    """
    reader = spark.read.format("statestore")
    state = (reader if batch is None else reader.option("batchId", int(batch))).load(checkpoint)
    value = state.schema["value"].dataType
    names = _names(value)
    # by position, as names repeat
    renamed = F.col("value").cast("struct<" + ",".join(f"{n}:{f.dataType.simpleString()}" for n, f in zip(names, value.fields)) + ">")
    flat = state.select(F.col("key.window").alias("window"), renamed.alias("v")).select("window", "v.*")

    def money(kind: str):
        total = F.when(~F.col(f"{kind}_empty"), F.col(f"{kind}_exact"))
        return total_of(total, F.col(f"{kind}_rest"), 2)

    known = F.col("known_flags" if "known_flags" in names else "event_count")
    measures = {kind: money(kind) for kind in _MONEY}
    measures["fraud_rate"] = F.when(known > 0, F.col("flagged_count") / known)
    return flat.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        *[measures.get(m, F.col(m)).alias(m) for m in MEASURES],
    )

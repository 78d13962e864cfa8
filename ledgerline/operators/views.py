"""Report / chart datasets (T1-T5, A7-A10, J2, P17, P18), computed on Spark.

The reference builds these in pandas on the driver after collecting the
outputs; here each is a distributed aggregation whose result is small.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.money import exact_sum
from ledgerline.params import DEFAULT_PARAMS, JobParams

# The status domain of the breakdown chart, in display order.
STATUS_DOMAIN = ("SUCCESS", "FAILED", "PENDING")

SAMPLE_ENRICHED_COLUMNS = (
    "transaction_id",
    "event_time",
    "merchant_category",
    "channel",
    "gross_amount",
    "discount_rate",
    "net_amount",
    "fraud_score",
    "is_flagged",
)


def throughput_series(windows: DataFrame) -> DataFrame:
    """Events per window, by window start."""
    return windows.select("window_start", "event_count").orderBy("window_start")


def flag_rate_series(windows: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """Flagged rate per window with the alert mark."""
    return windows.select(
        "window_start",
        "fraud_rate",
        (F.col("fraud_rate") >= F.lit(float(params.fraud_alert_rate))).alias("is_alert"),
    ).orderBy("window_start")


def net_value_by_category(enriched: DataFrame) -> DataFrame:
    """Net value per category, ascending by value then name."""
    return (
        enriched.groupBy("merchant_category")
        .agg(exact_sum("net_amount").alias("net_value"))
        .orderBy("net_value", "merchant_category")
    )


def flag_rate_by_channel(enriched: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """Mean flag per channel, descending, with the alert mark."""
    return (
        enriched.groupBy("channel")
        .agg(F.avg(F.col("is_flagged").cast("double")).alias("flagged_rate"))
        .select(
            "channel",
            "flagged_rate",
            (F.col("flagged_rate") >= F.lit(float(params.fraud_alert_rate))).alias("is_alert"),
        )
        .orderBy(F.col("flagged_rate").desc(), "channel")
    )


def by_category_and_channel(enriched: DataFrame) -> DataFrame:
    """Net value and mean flag by category and by channel from one pass:
    (dimension, value, net_value, flagged_rate)."""
    dimensions = ["merchant_category", "channel"]
    return (
        enriched.groupingSets([[d] for d in dimensions], *dimensions)
        .agg(
            F.when(F.grouping("channel") == 1, F.lit("merchant_category")).otherwise(F.lit("channel")).alias("dimension"),
            exact_sum("net_amount").alias("net_value"),
            F.avg(F.col("is_flagged").cast("double")).alias("flagged_rate"),
        )
        .select("dimension", F.coalesce(*dimensions).alias("value"), "net_value", "flagged_rate")
    )


def status_breakdown(full: DataFrame, enriched: DataFrame | None = None) -> DataFrame:
    """Raw status counts over the fixed domain, zero-filled (J2), plus the
    filtered share (full - enriched) / full, not clamped (A9).

    One pass with conditional counts, unpivoted to rows: no join, and the
    result has exactly len(STATUS_DOMAIN) rows whatever the input holds. Without
    ``enriched`` the same pass counts the rows that enrichment would keep.
    """
    own = F.count_if(F.upper("status") == F.lit(STATUS_DOMAIN[0]))
    counts = full.agg(
        F.count(F.lit(1)).alias("_total"),
        own.alias("_kept"),
        *[F.count_if(F.col("status") == F.lit(s)).alias(f"_n{i}") for i, s in enumerate(STATUS_DOMAIN)],
    )
    domain = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(s).alias("status"), F.col(f"_n{i}").alias("count"))
            for i, s in enumerate(STATUS_DOMAIN)
        ]
    )
    stacked = counts.select("_total", "_kept", F.inline(domain))
    kept = F.col("_kept") if enriched is None else enriched.agg(F.count(F.lit(1))).scalar()
    share = F.when(F.col("_total") > 0, (F.col("_total") - kept) / F.col("_total")).otherwise(F.lit(0.0))
    return stacked.select("position", "status", "count", share.alias("filtered_share")).orderBy("position")


def histograms(df: DataFrame, columns: Sequence[tuple[str, str]], bins: int = 34) -> DataFrame:
    """Equal-width histograms of several columns, each over its own [min, max],
    with numpy's rules: edges lo + i*step (last edge = hi), last bin closed,
    values nudged into the right bin when float rounding crosses an edge;
    lo == hi widens the range by 0.5 each side; null and NaN are skipped; an
    infinite value fails the query when it runs, as it has no finite range.

    ``columns`` is a list of (series name, column). Two passes over ``df``, as
    exact bounds need one of their own: bounds (a row per series, joined on its
    name), then a count per (series, bin), map-side combined, so each task
    ships at most len(columns) * bins rows. Every bin is returned; empty ones
    with count 0. Nothing runs while the plan is built.
    """
    vals = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("series"),
                        F.when(~F.isnan(F.col(c)), F.col(c)).cast("double").alias("x"),
                    )
                    for name, c in columns
                ]
            )
        )
    ).where("x is not null")
    endless = F.raise_error(F.concat(F.lit("histogram range is not finite: "), F.col("series"))).cast("double")
    finite = lambda end: F.when(F.abs(end) == float("inf"), endless).otherwise(end)
    bounds = vals.groupBy("series").agg(F.min("x").alias("lo0"), F.max("x").alias("hi0"))
    bounds = bounds.withColumns({"lo0": finite(F.col("lo0")), "hi0": finite(F.col("hi0"))})
    half = F.when(F.col("lo0") == F.col("hi0"), F.lit(0.5)).otherwise(F.lit(0.0))
    bounds = bounds.select("series", (F.col("lo0") - half).alias("lo"), (F.col("hi0") + half).alias("hi"))
    bounds = bounds.withColumn("step", (F.col("hi") - F.col("lo")) / F.lit(float(bins)))
    last = F.lit(bins - 1)

    def edge(i):
        return F.when(i == F.lit(bins), F.col("hi")).otherwise(i * F.col("step") + F.col("lo"))

    # ``bounds`` has one row per series: a fixed bound, safe to broadcast.
    per_unit = F.lit(float(bins)) / (F.col("hi") - F.col("lo"))
    placed = vals.join(F.broadcast(bounds), "series")
    placed = placed.withColumn("i", F.least(F.floor((F.col("x") - F.col("lo")) * per_unit), last))
    placed = placed.withColumn("i", F.when(F.col("x") < edge(F.col("i")), F.col("i") - 1).otherwise(F.col("i")))
    above = (F.col("i") != last) & (F.col("x") >= edge(F.col("i") + 1))
    placed = placed.withColumn("bin", F.when(above, F.col("i") + 1).otherwise(F.col("i")).cast("int"))
    series = ["series", "lo", "hi", "step"]
    counts = placed.groupBy(*series, "bin").agg(F.count(F.lit(1)).alias("n"))
    # at most ``bins`` entries a series
    filled = counts.groupBy(*series).agg(F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("n"))
    return filled.select(*series, "n", F.explode(F.sequence(F.lit(0), last)).alias("bin")).select(
        "series",
        "bin",
        (F.col("bin") * F.col("step") + F.col("lo")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce(F.try_element_at("n", F.col("bin")), F.lit(0)).cast("long").alias("count"),
    )


def histogram(df: DataFrame, column: str, bins: int = 34, series: str | None = None) -> DataFrame:
    """Histogram of one column (see ``histograms``)."""
    return histograms(df, [(series or column, column)], bins)


def amount_histogram(enriched: DataFrame, bins: int = 34) -> DataFrame:
    """Gross and net amount histograms, each over its own range (A10)."""
    return histograms(enriched, [("gross", "gross_amount"), ("net", "net_amount")], bins)


def first_n(df: DataFrame, order_cols: Sequence[str], n: int, columns: Sequence[str] | None = None) -> DataFrame:
    """Top-n by the given order (TakeOrdered: per-partition top-n, then merge)."""
    out = df.orderBy(*order_cols).limit(n)
    return out.select(*columns) if columns else out


def sample_enriched(enriched: DataFrame, n: int = 8, with_user: bool = False) -> DataFrame:
    """First n enriched events by event time; transaction id breaks ties.
    ``with_user`` gives the 10-column display variant (adds user_id)."""
    cols = list(SAMPLE_ENRICHED_COLUMNS)
    if with_user:
        cols.insert(1, "user_id")
    return first_n(enriched, ["event_time", "transaction_id"], n, cols)


def sample_windows(windows: DataFrame, n: int = 12) -> DataFrame:
    """First n windows by start (T4)."""
    return first_n(windows, ["window_start"], n)


class ReportDatasets(dict):
    """Datasets by name, and the cached frame that two of them share."""

    def __init__(self, shared: DataFrame, datasets: dict[str, DataFrame]) -> None:
        super().__init__(datasets)
        self.shared = shared

    def release(self) -> None:
        self.shared.unpersist()


def report_datasets(
    enriched: DataFrame, windows: DataFrame, full: DataFrame | None, params: JobParams = DEFAULT_PARAMS
) -> dict[str, DataFrame]:
    """The data behind every chart and report table (C6), as DataFrames. Without
    a ``full`` table of the input there is no status breakdown."""
    from ledgerline.operators.windows import alerts

    breakdown = {} if full is None else {"status_breakdown": status_breakdown(full)}
    # a row per category and channel, kept when the first of its two readers runs
    both = by_category_and_channel(enriched).cache()  # until ReportDatasets.release
    of = lambda dimension: both.where(F.col("dimension") == dimension).withColumnRenamed("value", dimension)
    alert = F.col("flagged_rate") >= F.lit(float(params.fraud_alert_rate))
    return ReportDatasets(both, breakdown | {
        "throughput_series": throughput_series(windows),
        "flag_rate_series": flag_rate_series(windows, params),
        "alert_windows": alerts(windows, params),
        "net_value_by_category": of("merchant_category").select("merchant_category", "net_value").orderBy("net_value", "merchant_category"),
        "amount_histogram": amount_histogram(enriched, params.histogram_bins),
        "flag_rate_by_channel": of("channel").select("channel", "flagged_rate", alert.alias("is_alert")).orderBy(F.col("flagged_rate").desc(), "channel"),
        "sample_enriched": sample_enriched(enriched, 8),
        "sample_windows": sample_windows(windows, 12),
    })


def write_report_datasets(datasets: dict[str, DataFrame], root: str) -> list[str]:
    """Write each dataset as Parquet under ``root/<name>`` (overwrite); what they share is released then."""
    paths = []
    for name, df in datasets.items():
        path = f"{root.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        paths.append(path)
    if isinstance(datasets, ReportDatasets):
        datasets.release()
    return paths

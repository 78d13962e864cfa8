"""Enrichment: keep successful transactions, add discount and fraud score.

Pure ``DataFrame -> DataFrame``: the same function serves a batch table and a
streaming source. No shuffle: filter and projection fuse into the scan's
whole-stage-codegen stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.scoring import (
    amount_risk,
    category_risk,
    channel_risk,
    cross_border_risk,
    discount_rate,
    fraud_score,
    latent_signal,
)
from ledgerline.params import DEFAULT_PARAMS, JobParams
from ledgerline.schemas import ENRICHED_COLUMNS

def successful(df: DataFrame) -> DataFrame:
    """status := upper(status); keep 'SUCCESS'. No trim: ' SUCCESS ' is dropped."""
    return df.withColumn("status", F.upper(F.col("status"))).filter(F.col("status") == F.lit("SUCCESS"))


def _project(df: DataFrame, rate: Column, params: JobParams) -> DataFrame:
    gross = F.col("amount").cast("double")
    score = fraud_score(
        high_value=params.high_value_amount, latent_weight=params.latent_weight
    ).cast("double")
    staged = df.select(
        "*",
        gross.alias("gross_amount"),
        rate.cast("double").alias("discount_rate"),
        score.alias("fraud_score"),
    )
    derived = {
        "net_amount": F.col("gross_amount") * (F.lit(1.0) - F.col("discount_rate")),
        "is_flagged": F.col("fraud_score") >= F.lit(float(params.fraud_threshold)),
    }
    return staged.select(*[derived[c].alias(c) if c in derived else F.col(c) for c in ENRICHED_COLUMNS])


def enriched_columns(df: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """Every row with the enriched columns, and ``_kept``: whether ``enrich`` keeps it."""
    upper = df.withColumn("status", F.upper("status"))
    rate = discount_rate("merchant_category", params.discount_rules)
    return _project(upper, rate, params).withColumn("_kept", F.coalesce(F.col("status") == "SUCCESS", F.lit(False)))


def enrich(df: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """14-column enriched frame."""
    return _project(successful(df), discount_rate("merchant_category", params.discount_rules), params)


def rules_frame(spark, rules) -> DataFrame:
    """Rule dict -> (merchant_category, discount_rate) frame of known size."""
    import pyarrow as pa

    pairs = dict(rules)
    names, rates = pa.array(pairs.keys(), pa.string()), pa.array(map(float, pairs.values()), pa.float64())
    return spark.createDataFrame(pa.table({"merchant_category": names, "discount_rate": rates}))


def enrich_with_rules(df: DataFrame, rules: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """Same result as ``enrich`` with the rates looked up in a rule *table*.

    Left equi-join on merchant_category; unmatched -> 0.0. Rule keys must be
    unique: a duplicated key (it would duplicate rows) fails the query when it
    runs. Spark picks the join by the rule table's bytes.
    """
    key = "merchant_category"
    twice = F.raise_error(F.concat(F.lit("discount rule table has duplicate merchant_category keys: "), F.col(key)))
    table = (
        rules.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.first("discount_rate").cast("double").alias("_rate"), F.count(F.lit(1)).alias("_n"))
        .select(key, F.when(F.col("_n") > 1, twice.cast("double")).otherwise(F.col("_rate")).alias("_rule_rate"))
    )
    joined = successful(df).join(table, on=key, how="left")
    return _project(joined, F.coalesce(F.col("_rule_rate"), F.lit(0.0)), params)


def score_components(df: DataFrame, params: JobParams = DEFAULT_PARAMS) -> DataFrame:
    """Each score component as a column, plus the clipped score."""
    return df.select(
        "*",
        amount_risk("amount", params.high_value_amount).alias("amount_risk"),
        category_risk().alias("category_risk"),
        channel_risk().alias("channel_risk"),
        cross_border_risk().alias("cross_border_risk"),
        latent_signal("is_fraud", params.latent_weight).alias("latent_signal"),
        fraud_score(high_value=params.high_value_amount, latent_weight=params.latent_weight)
        .cast("double")
        .alias("fraud_score"),
    )


def flagged(enriched: DataFrame) -> DataFrame:
    """Rows whose score reached the threshold."""
    return enriched.filter(F.col("is_flagged"))

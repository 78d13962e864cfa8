"""Discount and rule-based fraud-score expressions.

The score is a sum of component risks evaluated left to right in double
arithmetic (the order matters: 0.03+0.10+0.02+0.025+0.015+0.46 lands exactly on
0.65), then clipped to [0, 1].
"""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Score weights and groups; they must equal the reference's.
BASE_RISK = 0.03
AMOUNT_RISK_HIGH = 0.20
AMOUNT_RISK_MEDIUM = 0.10
AMOUNT_RISK_LOW = 0.02
MEDIUM_AMOUNT_FACTOR = 0.55
RISKY_CATEGORIES = ("electronics", "luxury")
CATEGORY_RISK_HIGH = 0.11
CATEGORY_RISK_LOW = 0.02
RISKY_CHANNELS = ("web", "api")
CHANNEL_RISK_HIGH = 0.09
CHANNEL_RISK_LOW = 0.025
HOME_COUNTRY = "US"
CROSS_BORDER_RISK_HIGH = 0.07
CROSS_BORDER_RISK_LOW = 0.015
LATENT_WEIGHT = 0.46


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def discount_rate(category="merchant_category", rules: Mapping[str, float] | None = None) -> Column:
    """Rate for the category from a rule map; unknown or null category -> 0.0."""
    if not rules:
        return F.lit(0.0)
    pairs = []
    for name, rate in rules.items():
        pairs += [F.lit(name), F.lit(float(rate))]
    return F.coalesce(F.create_map(*pairs)[_col(category)], F.lit(0.0))


def amount_risk(amount="amount", high_value: float = 450.0) -> Column:
    # high_value * 0.55 is computed in Python double: 247.50000000000003 at 450.
    a = _col(amount)
    return (
        F.when(a >= F.lit(float(high_value)), F.lit(AMOUNT_RISK_HIGH))
        .when(a >= F.lit(high_value * MEDIUM_AMOUNT_FACTOR), F.lit(AMOUNT_RISK_MEDIUM))
        .otherwise(F.lit(AMOUNT_RISK_LOW))
    )


def category_risk(category="merchant_category") -> Column:
    return F.when(_col(category).isin(*RISKY_CATEGORIES), F.lit(CATEGORY_RISK_HIGH)).otherwise(
        F.lit(CATEGORY_RISK_LOW)
    )


def channel_risk(channel="channel") -> Column:
    return F.when(_col(channel).isin(*RISKY_CHANNELS), F.lit(CHANNEL_RISK_HIGH)).otherwise(
        F.lit(CHANNEL_RISK_LOW)
    )


def cross_border_risk(country="country") -> Column:
    return F.when(_col(country) != F.lit(HOME_COUNTRY), F.lit(CROSS_BORDER_RISK_HIGH)).otherwise(
        F.lit(CROSS_BORDER_RISK_LOW)
    )


def latent_signal(is_fraud="is_fraud", weight: float = LATENT_WEIGHT) -> Column:
    return F.coalesce(_col(is_fraud), F.lit(0.0)) * F.lit(float(weight))


def fraud_score(
    amount="amount",
    category="merchant_category",
    channel="channel",
    country="country",
    is_fraud="is_fraud",
    high_value: float = 450.0,
    latent_weight: float = LATENT_WEIGHT,
) -> Column:
    raw = (
        F.lit(BASE_RISK)
        + amount_risk(amount, high_value)
        + category_risk(category)
        + channel_risk(channel)
        + cross_border_risk(country)
        + latent_signal(is_fraud, latent_weight)
    )
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), raw))

"""Column-expression building blocks (all JVM-side, no Python UDFs)."""

from ledgerline.functions.money import exact_sum
from ledgerline.functions.scoring import (
    amount_risk,
    category_risk,
    channel_risk,
    cross_border_risk,
    discount_rate,
    fraud_score,
    latent_signal,
)
from ledgerline.functions.timecols import instant_to_wallclock, wallclock_to_instant

__all__ = [
    "amount_risk",
    "category_risk",
    "channel_risk",
    "cross_border_risk",
    "discount_rate",
    "exact_sum",
    "fraud_score",
    "instant_to_wallclock",
    "latent_signal",
    "wallclock_to_instant",
]

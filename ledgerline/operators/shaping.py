"""Data-shaping rules of the synthetic transaction stream, as Spark expressions.

The reference draws these with a seeded random generator on the driver. Here
each random draw is replaced by an integer hash of a row key, so the rules run
on any number of executors and give the same answer in Spark and in SQL.
Money is shaped in DECIMAL (HALF_UP); double rounding of x*0.9 etc. is not
reproducible across engines.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Category / channel / country / status shares (percent), currency pool,
# amount multipliers and bounds, fraud-probability terms; they must equal the
# reference generator's.
CATEGORY_WEIGHTS = (
    ("grocery", 18),
    ("travel", 12),
    ("electronics", 13),
    ("dining", 18),
    ("fuel", 10),
    ("entertainment", 11),
    ("pharmacy", 10),
    ("luxury", 8),
)
CHANNEL_WEIGHTS = (("mobile", 45), ("web", 28), ("pos", 22), ("api", 5))
COUNTRY_WEIGHTS = (
    ("US", 72),
    ("CA", 7),
    ("GB", 5),
    ("DE", 4),
    ("FR", 3),
    ("JP", 3),
    ("BR", 3),
    ("IN", 3),
)
STATUS_WEIGHTS = (("SUCCESS", 88), ("FAILED", 8), ("PENDING", 4))
CURRENCIES = ("USD", "USD", "USD", "EUR", "GBP", "JPY", "CAD")
CATEGORY_MULTIPLIERS = (
    ("travel", "2.00"),
    ("electronics", "1.65"),
    ("luxury", "2.80"),
    ("fuel", "0.90"),
    ("pharmacy", "0.70"),
)
DEFAULT_MULTIPLIER = "1.00"
AMOUNT_MIN = "4.00"
AMOUNT_MAX = "4500.00"
# Fraud probability in units of 1/10,000: base 0.012, +0.035 above 300,
# +0.095 above 800, +0.035 risky category, +0.025 risky channel,
# +0.025 outside US, clipped to [0.005, 0.45].
FRAUD_UNITS = 10_000
FRAUD_BASE = 120
FRAUD_OVER_300 = 350
FRAUD_OVER_800 = 950
FRAUD_RISKY_CATEGORY = 350
FRAUD_RISKY_CHANNEL = 250
FRAUD_CROSS_BORDER = 250
FRAUD_MIN = 50
FRAUD_MAX = 4500
RISKY_CATEGORIES = ("electronics", "luxury")
RISKY_CHANNELS = ("web", "api")
# Uplift of labelled amounts: factor in [1.15, 2.2) in 1,000 steps.
UPLIFT_LOW = "1.15"
UPLIFT_STEP = "0.00105"
UPLIFT_STEPS = 1000

# Integer hashes standing in for the random draws: (multiplier, offset).
CHANNEL_HASH = (7919, 13)
COUNTRY_HASH = (104729, 7)
LABEL_HASH = (48271, 11)
UPLIFT_HASH = (31, 5)
STATUS_HASH = (15485863, 3)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _dec(text: str, precision: int, scale: int) -> Column:
    return F.lit(text).cast(f"decimal({precision},{scale})")


def hash_draw(key, mult_offset: tuple[int, int], modulus: int) -> Column:
    """Deterministic uniform-ish integer in [0, modulus) from a bigint key:
    (key * mult + offset) mod modulus. The key is reduced mod ``modulus``
    first (same residue), so the product cannot overflow for any key."""
    mult, offset = mult_offset
    reduced = F.pmod(_col(key), F.lit(modulus))
    return F.pmod(reduced * F.lit(mult) + F.lit(offset), F.lit(modulus))


def weighted_pick(draw, weights: Sequence[tuple[str, int]]) -> Column:
    """Label whose cumulative-weight interval contains ``draw``.

    Draws below 0 take the first label, draws at or above the weight total
    (and null draws) the last. One lookup into a table expanded from the
    weights (one entry per unit of weight), so ``draw`` is referenced once:
    no CASE chain that an optimizer could copy an expensive draw into.
    """
    if not weights:
        raise ValueError("weights must not be empty")
    table = [label for label, weight in weights for _ in range(int(weight))]
    last = F.lit(weights[-1][0])
    # A null draw is routed explicitly: greatest/least skip nulls, and the
    # optimizer treats element_at on a literal array as never null.
    d = _col(draw)
    idx = F.least(F.greatest(d, F.lit(0)), F.lit(len(table) - 1)) + F.lit(1)
    return F.when(d.isNull(), last).otherwise(F.element_at(string_array(table), idx.cast("int")))


def string_array(values: Sequence[str]) -> Column:
    """Literal ARRAY<STRING> built by one SQL parse (one JVM call instead of
    one per element when the array is assembled from ``F.lit`` columns)."""
    quoted = ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)
    return F.expr(f"array({quoted})")


def weighted_status(key) -> Column:
    """Status by its share, drawn by a hash of the row key."""
    return weighted_pick(hash_draw(key, STATUS_HASH, 100), STATUS_WEIGHTS)


def pick_from_pool(index, pool: Sequence[str]) -> Column:
    """pool[index mod len(pool)]."""
    i = F.pmod(_col(index), F.lit(len(pool)))
    expr = F.when(i == 0, F.lit(pool[0]))
    for n, label in enumerate(pool[1:], start=1):
        expr = expr.when(i == n, F.lit(label))
    return expr


def category_multiplier(category="merchant_category") -> Column:
    """DECIMAL(4,2) multiplier by category (map lookup, default 1.00)."""
    pairs = []
    for name, mult in CATEGORY_MULTIPLIERS:
        pairs += [F.lit(name), _dec(mult, 4, 2)]
    return F.coalesce(F.create_map(*pairs)[_col(category)], _dec(DEFAULT_MULTIPLIER, 4, 2))


def shape_amount(base, category="merchant_category") -> Column:
    """round(clip(base * category multiplier, 4, 4500), 2) in DECIMAL, as DOUBLE.

    ``base`` is a DECIMAL(18,2) column (the base amount before the multiplier).
    """
    scaled = F.round(_col(base) * category_multiplier(category), 2)
    clipped = F.greatest(_dec(AMOUNT_MIN, 6, 2), F.least(_dec(AMOUNT_MAX, 6, 2), scaled))
    # least/greatest skip nulls: keep a missing base amount missing.
    return F.when(scaled.isNotNull(), clipped).cast("double")


def fraud_probability_units(
    amount="amount", category="merchant_category", channel="channel", country="country"
) -> Column:
    """Additive fraud probability in 1/10,000 units, clipped (integer arithmetic)."""
    a = _col(amount)
    units = (
        F.lit(FRAUD_BASE)
        + F.when(a > F.lit(300.0), FRAUD_OVER_300).otherwise(0)
        + F.when(a > F.lit(800.0), FRAUD_OVER_800).otherwise(0)
        + F.when(_col(category).isin(*RISKY_CATEGORIES), FRAUD_RISKY_CATEGORY).otherwise(0)
        + F.when(_col(channel).isin(*RISKY_CHANNELS), FRAUD_RISKY_CHANNEL).otherwise(0)
        + F.when(_col(country) != F.lit("US"), FRAUD_CROSS_BORDER).otherwise(0)
    )
    return F.greatest(F.lit(FRAUD_MIN), F.least(F.lit(FRAUD_MAX), units))


def fraud_label(key, probability_units) -> Column:
    """Bernoulli draw re-aimed as an integer-hash draw: 1.0 when draw < p."""
    draw = hash_draw(key, LABEL_HASH, FRAUD_UNITS)
    return F.when(draw < _col(probability_units), F.lit(1.0)).otherwise(F.lit(0.0))


def uplift_factor(key) -> Column:
    h = hash_draw(key, UPLIFT_HASH, UPLIFT_STEPS).cast("decimal(4,0)")
    return _dec(UPLIFT_LOW, 6, 5) + _dec(UPLIFT_STEP, 6, 5) * h


def uplifted_amount(amount, key, is_fraud) -> Column:
    """Labelled rows: round(amount * factor, 2) in DECIMAL; others unchanged."""
    raised = F.round(_col(amount).cast("decimal(18,2)") * uplift_factor(key), 2).cast("double")
    return F.when(_col(is_fraud) == F.lit(1.0), raised).otherwise(_col(amount))


def zero_pad(idx, width: int) -> Column:
    """Python's ``f"{idx:0{width}d}"``: zero-padded to ``width`` characters
    (sign included), never truncated. lpad is used instead of format_string:
    it is about three times cheaper per row."""
    x = _col(idx)
    digits = F.abs(x).cast("string")
    pad_to = F.when(x < 0, F.lit(width - 1)).otherwise(F.lit(width))
    padded = F.when(F.length(digits) >= pad_to, digits).otherwise(F.lpad(digits, pad_to, "0"))
    return F.when(x < 0, F.concat(F.lit("-"), padded)).otherwise(padded)


def transaction_id(idx, seed: int | None = None) -> Column:
    """txn_{idx:07d} (or txn_{seed}_{idx:07d}); null id -> null."""
    prefix = "txn_" if seed is None else f"txn_{int(seed)}_"
    return F.concat(F.lit(prefix), zero_pad(idx, 7))


def user_id(idx) -> Column:
    return F.concat(F.lit("user_"), zero_pad(idx, 5))


def with_risk_probability(df: DataFrame) -> DataFrame:
    units = fraud_probability_units()
    return df.withColumn("fraud_probability_units", units).withColumn(
        "fraud_probability", F.col("fraud_probability_units") / F.lit(float(FRAUD_UNITS))
    )

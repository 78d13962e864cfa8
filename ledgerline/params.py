"""Job parameters (what the reference keeps in its config object)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace
from typing import Mapping

# Category discount rules; they must equal the reference's.
DEFAULT_DISCOUNT_RULES: Mapping[str, float] = {
    "grocery": 0.03,
    "travel": 0.05,
    "electronics": 0.08,
    "dining": 0.10,
    "fuel": 0.00,
    "entertainment": 0.06,
    "pharmacy": 0.02,
    "luxury": 0.04,
}


def byte_count(size: int | str) -> int:
    """A size in bytes: a number, or a number with k, m, g or t (powers of 1024)."""
    text = str(size).strip().lower()
    unit = "kmgt".find(text[-1:]) + 1 if text[-1:] else 0
    count = int(text[:-1] if unit else text) << 10 * unit
    if count < 1:
        raise ValueError(f"not a size: {size!r}")
    return count


@dataclass(frozen=True)
class JobParams:
    """Parameters of the enrichment, windowing and streaming jobs.

    ``discount_rules`` may be empty: every category then gets rate 0.0.
    ``max_files_per_trigger`` bounds a file-source micro-batch (None: no bound);
    ``max_bytes_per_trigger`` (a number, or text like "8g") bounds it by the
    files' bytes instead, whatever the sizes of the files.
    ``state_partitions``: shuffle partitions of the stateful window query
    (None: the session's setting). Its keys are the open windows (about
    delay/duration + 1), not the rows: a job whose open windows are few saves
    per-batch state-store commits by setting it to about their number. The
    number is fixed into the query's checkpoint at its first start.
    ``chained_files_per_trigger`` bounds a micro-batch of the windowed query
    in the chained layout, whose source is the enriched output.
    ``partition_enriched_by_date`` writes the enriched sink partitioned by
    ``event_date`` (UTC date of the event) so date-bounded readers prune files.
    """

    window_duration: str = "5 minutes"
    watermark_delay: str = "30 minutes"
    fraud_threshold: float = 0.65
    fraud_alert_rate: float = 0.08
    high_value_amount: float = 450.0
    latent_weight: float = 0.46
    discount_rules: Mapping[str, float] = field(
        default_factory=lambda: dict(DEFAULT_DISCOUNT_RULES)
    )
    legacy_discount_factor: float = 0.9
    max_files_per_trigger: int | None = 4
    max_bytes_per_trigger: int | str | None = None
    chained_files_per_trigger: int | None = 4
    batch_size: int = 250
    histogram_bins: int = 34
    source: str = "file"
    kafka_bootstrap: str = "localhost:9092"
    kafka_topic: str = "transactions"
    starting_offsets: str = "earliest"
    max_offsets_per_trigger: int | None = None
    state_partitions: int | None = None
    partition_enriched_by_date: bool = False

    def with_(self, **changes) -> "JobParams":
        return replace(self, **changes)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None, **changes) -> "JobParams":
        """Defaults with the source switch taken from SOURCE, KAFKA_BOOTSTRAP and
        KAFKA_TOPIC where these are set; ``changes`` that aren't None win."""
        env = os.environ if env is None else env
        named = {"source": "SOURCE", "kafka_bootstrap": "KAFKA_BOOTSTRAP", "kafka_topic": "KAFKA_TOPIC"}
        found = {name: env[key] for name, key in named.items() if env.get(key)}
        if "source" in found:
            found["source"] = found["source"].lower()
        return cls(**found | {k: v for k, v in changes.items() if v is not None})


DEFAULT_PARAMS = JobParams()

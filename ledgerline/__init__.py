"""ledgerline: transaction-stream analytics as plain Spark DataFrame jobs.

Every public function takes and returns a ``pyspark.sql.DataFrame`` (or
column expressions), so the same logic runs on batch tables and on
Structured Streaming frames.
"""

from ledgerline.params import DEFAULT_DISCOUNT_RULES, JobParams

__all__ = ["DEFAULT_DISCOUNT_RULES", "JobParams"]

"""Zone-free conversion between TIMESTAMP_NTZ wall clocks and TIMESTAMP instants.

``withWatermark`` only takes TIMESTAMP, while the stored tables are
TIMESTAMP_NTZ. A plain cast reads the wall clock in the session zone, which
shifts windows under a non-UTC session; interval arithmetic on TIMESTAMP adds
days in the session's calendar, which is off by the DST shift in summer. Micro-
second counts from the epoch are the same in every zone, so both directions go
through them.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def wallclock_to_instant(c) -> Column:
    """TIMESTAMP_NTZ read as UTC wall clock -> TIMESTAMP.

    NTZ - NTZ is an exact day-time interval; as INTERVAL SECOND cast to
    DECIMAL it is the epoch offset in seconds with microsecond fraction.
    (timestampdiff would cast the NTZ value through the session zone first,
    which moves wall clocks inside a DST gap by an hour.)"""
    offset = (_col(c) - F.expr(_EPOCH_NTZ)).cast("interval second").cast("decimal(20,6)")
    return F.timestamp_micros((offset * F.lit(1_000_000)).cast("long"))


def instant_to_wallclock(c) -> Column:
    """TIMESTAMP -> its UTC wall clock as TIMESTAMP_NTZ."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_col(c)), F.expr(_EPOCH_NTZ))

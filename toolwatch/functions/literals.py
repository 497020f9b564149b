"""Wall-clock literals.

A naive Python ``datetime`` passed to ``F.lit`` becomes an instant via the
*driver process's* time zone, then compares with columns in the *session*
zone; when the two differ, cut-offs shift by hours.  Parameters here are
wall-clock values, so they are built from their text as ``timestamp_ntz``
(no zone at all).  Against a zoned column the value is read in the session
zone, the same way the data was parsed.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(x) -> Column:
    """Timestamp literal without a time zone (columns pass through unchanged)."""
    if isinstance(x, Column):
        return x
    if isinstance(x, _dt.datetime):
        if x.tzinfo is not None:
            return F.lit(x)  # an explicit instant stays an instant
        return F.lit(x.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    if isinstance(x, _dt.date):
        return F.lit(x.isoformat()).cast("timestamp_ntz")
    return F.lit(x)

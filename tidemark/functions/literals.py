"""Literals that keep the driver tables' time-zone-free semantics.

The driver tables store `timestamp_ntz`. `F.lit(datetime)` would build a session-time-
zone timestamp (converted through the Python process's zone), so comparisons with NTZ
columns would shift whenever the zones differ. `lit` builds NTZ literals from naive
datetimes instead; everything else goes to `F.lit` unchanged.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def lit(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime) and value.tzinfo is None:
        return F.lit(value.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.lit(value)

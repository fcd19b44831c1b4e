"""Time-zone independent timestamp literals."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def ts_lit(value: _dt.datetime | _dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal built from text, so neither the Python process's
    nor the session's time zone can shift it."""
    if isinstance(value, _dt.datetime):
        text = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        text = value.strftime("%Y-%m-%d 00:00:00")
    else:
        text = str(value)
    return F.lit(text).cast("timestamp_ntz")

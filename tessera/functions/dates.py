"""Date features (F30, F31) with an explicit as-of date.

The as-of point is a parameter, never "now", so results do not drift.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two input formats (strptime spellings and Spark patterns).
UPDATED_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"     # %Y-%m-%dT%H:%M:%S.%f
PUBLICATION_FORMAT = "yyyy-MM-dd"                   # %Y-%m-%d
_MICROS_PER_DAY = 86_400_000_000


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def years_after(year_col, as_of_year: int) -> Column:
    """as_of_year − publication_year."""
    return (F.lit(int(as_of_year)) - _c(year_col).cast("long")).alias("num_years_after_publication")


def days_since(ts: Column, as_of: _dt.datetime) -> Column:
    """Whole days from ``ts`` to ``as_of`` (truncated toward zero); null stays null."""
    ref = F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")
    diff = F.unix_micros(ref.cast("timestamp")) - F.unix_micros(ts.cast("timestamp_ntz").cast("timestamp"))
    return (diff / F.lit(float(_MICROS_PER_DAY))).cast("long")


def parse_updated(s) -> Column:
    """``%Y-%m-%dT%H:%M:%S.%f`` strings → timestamp; malformed → null."""
    return F.try_to_timestamp(_c(s), F.lit(UPDATED_FORMAT)).cast("timestamp_ntz")


def parse_publication(s) -> Column:
    return F.try_to_timestamp(_c(s), F.lit(PUBLICATION_FORMAT)).cast("timestamp_ntz")


def date_features(updated_date, publication_date, as_of: _dt.datetime) -> list[Column]:
    """days_since_updated, days_since_publication (bad dates → null)."""
    return [days_since(parse_updated(updated_date), as_of).alias("days_since_updated"),
            days_since(parse_publication(publication_date), as_of).alias("days_since_publication")]

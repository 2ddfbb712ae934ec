"""Column functions on timestamps; sessions run in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def from_iso(text: Column) -> Column:
    """ISO-8601 text with Z, an offset or neither; null where it can't be read."""
    return text.try_cast("timestamp")


def to_iso(ts: Column) -> Column:
    """ISO-8601 text ending in Z, without a fraction where it is zero; null stays null."""
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000))
    return F.when(micros == 0, F.concat(plain, F.lit("Z"))).otherwise(F.concat(plain, F.lit("."), F.lpad(micros.cast("string"), 6, "0"), F.lit("Z")))


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)

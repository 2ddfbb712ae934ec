"""Column functions on numbers: shares, rates, units, container resources."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(x: Column, digits: int) -> Column:
    """Half up on the decimal form. Python rounds the binary value, which may differ by one in the last digit at a tie."""
    return F.round(x, digits)


def python_round(x: float, digits: int) -> float:
    """The exact binary value rounded half to even: the reference semantics, for checks."""
    return float(round(Decimal(x), digits))


def megabytes(x: Column) -> Column:
    return F.round(x / F.lit(1e6), 2)


def whole_seconds(ms: Column) -> Column:
    return F.floor(ms / 1000).cast("long")


def milliseconds(s: Column) -> Column:
    return s * 1000


def gigabytes_to_bytes(gb: Column) -> Column:
    return (gb * float(1 << 30)).cast("long")


def ratio(part: Column, whole: Column) -> Column:
    """part over whole, whole counting as 1 at least."""
    return part / F.greatest(whole, F.lit(1))


def cpu_percent(used: Column, used_before: Column, system: Column, system_before: Column, per_cpu: Column) -> Column:
    """Share of the host's processors between two samples; 0 unless both counters went up. A missing list counts as one processor."""
    own, all_ = F.coalesce(used, F.lit(0)) - F.coalesce(used_before, F.lit(0)), F.coalesce(system, F.lit(0)) - F.coalesce(system_before, F.lit(0))
    count = F.greatest(F.coalesce(F.size(per_cpu), F.lit(0)), F.lit(1))
    return F.when((own > 0) & (all_ > 0), own / all_ * count * 100.0).otherwise(0.0)


def memory_percent(usage: Column, limit: Column) -> Column:
    return F.when(F.coalesce(limit, F.lit(0)) > 0, F.coalesce(usage, F.lit(0)) / limit * 100.0).otherwise(0.0)


def human_size(n: Column) -> Column:
    """Bytes in the largest unit that leaves one or more, with one decimal."""
    n = F.coalesce(n, F.lit(0)).cast("double")
    out = F.concat(n.cast("long").cast("string"), F.when(n == 1, " byte").otherwise(" bytes"))
    for power, unit in enumerate(["KB", "MB", "GB", "TB", "PB"], 1):
        size = float(1 << (10 * power))
        out = F.when(n >= size, F.concat(F.format_string("%.1f", F.bround(n / size, 1)), F.lit(f" {unit}"))).otherwise(out)
    return out

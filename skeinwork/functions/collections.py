"""Column functions on arrays and maps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ENGINE_KEYS = ("crawlScope", "crawlLimits", "pageBehavior", "browserSettings")


def concatenated(*arrays: Column) -> Column:
    """All elements in order; a null array has none."""
    empty = F.array().cast("array<string>")
    return F.concat(*[F.coalesce(a, empty) for a in arrays])


def residual(document: Column, known=ENGINE_KEYS) -> Column:
    """The entries of a map whose keys aren't known."""
    return F.map_filter(document, lambda k, _: ~k.isin(*known))


def without_nulls(document: Column) -> Column:
    return F.map_filter(document, lambda _, v: v.isNotNull())


def merged(base: Column, changes: Column) -> Column:
    """Entries of both maps; changes win."""
    empty = F.create_map().cast("map<string,string>")
    base, changes = F.coalesce(base, empty), F.coalesce(changes, empty)
    keep = F.map_filter(base, lambda k, _: ~F.map_contains_key(changes, k))
    return F.map_concat(keep, changes)


def total(values: Column) -> Column:
    return F.aggregate(F.coalesce(values, F.array().cast("array<bigint>")), F.lit(0).cast("long"), lambda a, x: a + F.coalesce(x, F.lit(0)))


def network_total(networks: Column, field: str) -> Column:
    """Sum of a counter over a map of interfaces."""
    return total(F.transform(F.map_values(networks), lambda i: i[field]))


def block_total(entries: Column, op: str, any_case: bool = False) -> Column:
    """Sum of the values of one operation; exact in case unless any_case."""
    fits = (lambda e: F.lower(e["op"]) == op.lower()) if any_case else (lambda e: e["op"] == op)
    return total(F.transform(F.filter(entries, fits), lambda e: e["value"]))


def labels_and_values(counts: Column) -> Column:
    """A chart series of a map: its keys and values in key order."""
    entries = F.array_sort(F.map_entries(counts))
    return F.struct(F.transform(entries, lambda e: e["key"]).alias("labels"), F.transform(entries, lambda e: e["value"]).alias("values"))


def count_map(key: str, n: str) -> Column:
    """An aggregate: (key, n) rows as a map in key order."""
    return F.map_from_entries(F.array_sort(F.collect_list(F.struct(key, n))))

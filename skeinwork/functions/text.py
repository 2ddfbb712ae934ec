"""Column functions on text: JSON payloads in log lines, URLs, paths, lists in strings."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

UUID_LIKE = r"^[\p{XDigit}-]{32,36}$"


def payload(line: Column) -> Column:
    """A line from its first brace on; null where it has none."""
    at = F.instr(line, "{")
    return F.when(at > 0, F.substr(line, at))


@F.pandas_udf(BooleanType())
def is_json_object(text: pd.Series) -> pd.Series:
    """Whether the whole text is one JSON object, as a strict decoder sees it."""
    def check(t):
        try:
            return isinstance(json.loads(t), dict)
        except (TypeError, ValueError):
            return False

    return text.map(check)


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column whose value is worked out once a row. A plain column is inlined wherever a filter or a field of it is used, and parsed there again; a generator isn't."""
    return df.select(*[c for c in df.columns if c != name], F.explode(F.array(value)).alias(name))


def decode(df: DataFrame, text: str, schema: str, out: str = "record", strict: bool = False) -> DataFrame:
    """Adds the decoded object and drops rows that aren't one.

    The parser of Spark takes `{...} trailing` for an object; the closing brace at the end is asked for besides. strict also
    drops `{...} junk}`, at the price of a pass through Python.
    """
    whole = F.rtrim(F.col(text))
    held = df.where(whole.endswith("}"))
    if strict:
        held = held.where(is_json_object(F.col(text)))
    parsed = once(held, out, F.from_json(text, f"{schema}, __broken string", {"columnNameOfCorruptRecord": "__broken"}))
    return parsed.where(F.col(f"{out}.__broken").isNull() & F.col(out).isNotNull()).withColumn(out, F.col(out).dropFields("__broken"))


def strip(x: Column) -> Column:
    """All white space off both ends, not blanks alone."""
    return F.regexp_replace(x, r"^\s+|\s+$", "")


def byte_length(x: Column) -> Column:
    return F.octet_length(x)


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def url_extension(url: Column) -> Column:
    """Lower-case file extension with its dot; `html` where the path has none."""
    base = F.regexp_replace(F.regexp_extract(url_path(url), r"([^/]*)$", 1), r";.*$", "")
    found = F.lower(F.regexp_extract(base, r"^\.*[^.].*?(\.[^.]*)$", 1))
    return F.when(found == "", "html").otherwise(found)


def split_pipes(x: Column) -> Column:
    """The parts of an a|b|c text that aren't empty."""
    return F.filter(F.split(F.coalesce(x, F.lit("")), r"\|"), lambda p: p != "")


def join_pipes(x: Column) -> Column:
    return F.array_join(x, "|")


def contains_ignoring_case(x: Column, part: str) -> Column:
    """Wildcards in part stand for themselves."""
    return F.contains(F.lower(x), F.lit(part.lower()))


def or_default(x: Column, default) -> Column:
    """x, or the default where x is null or empty."""
    return F.coalesce(F.nullif(x, F.lit("")), F.lit(default))


def whole_number(x: Column) -> Column:
    return x.try_cast("bigint")


def uuid_like(x: Column) -> Column:
    return x.rlike(UUID_LIKE)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def join_path(*parts: Column) -> Column:
    return F.concat_ws("/", *[F.rtrim(p, F.lit("/")) for p in parts])


def has_suffix(name: Column, *suffixes: str) -> Column:
    test = F.lit(False)
    for s in suffixes:
        test = test | name.endswith(s)
    return test


def json_key(document: Column, *path: str) -> Column:
    """A key's value in a JSON text, without quotes; null where the document or the key is absent."""
    return F.get_json_object(document, "$." + ".".join(path))


def truthy(x: Column) -> Column:
    return x.isNotNull() & (x != "")


def scope_granted(claim: Column, scope: str) -> Column:
    return F.array_contains(F.split(F.coalesce(claim, F.lit("")), " "), scope)


def relative_replay_url(collection: Column, url: Column) -> Column:
    return F.concat(F.coalesce(collection.cast("string"), F.lit("None")), F.lit("/"), url)


def sha256_hex(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)

"""What requests bring along: parameters, JSON bodies, tokens."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def query_parameter(query: Column, name: str) -> Column:
    """The decoded value of a parameter of a query string; null where it is absent, empty where it has no value."""
    found = F.regexp_extract(query, f"(?:^|[?&]){name}=([^&#]*)", 1)
    there = query.rlike(f"(?:^|[?&]){name}=")
    return F.when(there, F.try_url_decode(F.replace(found, F.lit("+"), F.lit(" "))))


def json_body(body: Column, schema: str) -> Column:
    """The object of a request's body; a body that isn't one is null."""
    held = F.from_json(body, f"{schema}, __broken string", {"columnNameOfCorruptRecord": "__broken"})
    return F.when(held["__broken"].isNull() & F.trim(body).startswith("{"), held.dropFields("__broken"))


def claims(token: Column) -> Column:
    """The payload of a JSON web token as text. The signature is NOT verified: whoever passes a token on has done that. Null where there is none."""
    part = F.translate(F.get(F.split(token, r"\."), F.lit(1)), "-_", "+/")
    padded = F.concat(part, F.repeat(F.lit("="), F.pmod(-F.length(part), F.lit(4))))
    text = F.decode(F.try_to_binary(padded, F.lit("base64")), "UTF-8")
    return F.when(F.get_json_object(text, "$").startswith("{"), text)


class TokenSource:
    """A token that is fetched again when it has less than `margin` seconds left. fetch() gives the token and the seconds it lives."""

    def __init__(self, fetch: Callable[[], tuple[str, float]], margin: float = 30, clock: Callable[[], float] = time.monotonic):
        self.fetch, self.margin, self.clock = fetch, margin, clock
        self.token, self.ends = None, 0.0

    def get(self) -> str:
        if self.token is None or self.clock() >= self.ends - self.margin:
            self.token, lives = self.fetch()
            self.ends = self.clock() + lives
        return self.token

"""Column expressions that the operators share."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Names of bucket widths and of look-back windows.
GRANULARITY = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour", "1d": "1 day"}
WINDOW_HOURS = {"1h": 1, "6h": 6, "12h": 12, "24h": 24, "7d": 168, "30d": 720}


def _plain(c: Column) -> Column:
    """Whether a character is printable ASCII, so no white space of any script: a comparison of bytes, in place of a pattern."""
    return c.between("!", "~")


def strip(c: Column) -> Column:
    """Without white space of any script at either end."""
    clean = _plain(F.substring(c, 1, 1)) & _plain(F.substring(c, -1, 1))
    return F.when(clean, c).otherwise(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""))


def blank(c: Column) -> Column:
    return F.when(_plain(F.substring(c, 1, 1)), False).otherwise(c.isNull() | c.rlike(r"(?U)^\s*$"))


def bucket(ts: Column, width: str) -> Column:
    """The start of the bucket that ts lies in: closed on the left."""
    return F.window(ts, width)["start"]


def ntz(ts: Column) -> Column:
    return ts.cast("timestamp_ntz")


def ratio(a: Column, b: Column) -> Column:
    """a / b as doubles; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def rounded(c: Column, digits: int = 2) -> Column:
    """Half up, by the same double operations in every engine."""
    scale = float(10**digits)
    return F.floor(c * scale + 0.5).cast("double") / scale


def cents(c: Column) -> Column:
    """A sum of amounts, freed of what the order of summation adds."""
    return F.round(c * 100.0) / 100.0


def period_hours(token: str) -> int:
    """'24h' -> 24, '7d' -> 168."""
    m = re.fullmatch(r"(\d+)([dh])", token)
    if not m:
        raise ValueError(f"not a period: {token!r}")
    return int(m[1]) * (24 if m[2] == "d" else 1)


def since(ts: Column, as_of, hours: float) -> Column:
    """ts is at or after as_of less so many hours; there is no upper bound."""
    return ts >= F.lit(as_of) - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")


def usd(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def compact(c: Column) -> Column:
    """1234 -> 1.2k, 2500000 -> 2.5M."""
    return F.when(c >= 1_000_000, F.concat(F.format_number(c / 1_000_000, 1), F.lit("M"))).when(c >= 1_000, F.concat(F.format_number(c / 1_000, 1), F.lit("k"))).otherwise(F.format_number(c, 0))


def percent(c: Column) -> Column:
    return F.concat(F.format_number(c * 100, 1), F.lit("%"))

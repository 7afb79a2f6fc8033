"""Text expressions over request fields."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def entropy(column: Column) -> Column:
    """Base-2 Shannon entropy over the characters of a text; 0 for an empty one.

    Uses H = log2(n) - sum(c * log2(c)) / n over the distinct characters.
    """
    characters = F.filter(F.split(column, ""), lambda c: c != "")
    size = F.length(column).cast("double")

    def weight(char: Column) -> Column:
        count = F.size(F.filter(characters, lambda c: c == char)).cast("double")
        return count * F.log2(count)

    weights = F.aggregate(
        F.array_distinct(characters), F.lit(0.0), lambda total, char: total + weight(char)
    )
    return F.when(F.length(column) > 0, F.greatest(F.log2(size) - weights / size, F.lit(0.0))).otherwise(0.0)


def mask_password(json_text: Column) -> Column:
    """Replace the value of a top-level or nested "password" text field by 12 asterisks."""
    return F.regexp_replace(
        json_text, r'("password"\s*:\s*)"(?:[^"\\]|\\.)*"', '$1"************"'
    )


def client_ip(forwarded_for: Column, real_ip: Column, remote: Column) -> Column:
    """First forwarded address, else the proxy's address, else the peer, else 'unknown'."""
    def filled(column: Column) -> Column:
        return F.nullif(column, F.lit(""))

    return (
        F.when(filled(forwarded_for).isNotNull(), F.trim(F.split(forwarded_for, ",")[0]))
        .when(filled(real_ip).isNotNull(), F.trim(real_ip))
        .otherwise(F.coalesce(filled(remote), F.lit("unknown")))
    )


def log_level(status: Column) -> Column:
    return F.when(status >= 500, "error").when(status >= 400, "warning").otherwise("info")


def age_text(seconds: Column) -> Column:
    """Seconds as a short age: whole seconds, else one decimal of minutes, hours or days.

    ``format_number`` rounds the exact binary value, half to even.
    """
    def shown(pattern: str, divisor: float, unit: str) -> Column:
        value = seconds.cast("double") / F.lit(divisor)
        return F.concat(F.call_function("format_number", value, F.lit(pattern)), F.lit(unit))

    return (
        F.when(seconds.isNull(), "-")
        .when(seconds < 60, shown("0", 1.0, "s"))
        .when(seconds < 3600, shown("0.0", 60.0, "m"))
        .when(seconds < 86400, shown("0.0", 3600.0, "h"))
        .otherwise(shown("0.0", 86400.0, "d"))
    )

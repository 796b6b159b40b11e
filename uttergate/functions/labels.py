"""Small column helpers: path language, safe names, fixed-point labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from uttergate.functions.charclass import SP, WORD


def path_language(path: Column) -> Column:
    """The path segment after the first ``raw`` segment; null if absent or empty."""
    segment = F.regexp_extract(path, "(?:^|/)raw/([^/]*)", 1)
    return F.when(segment != "", segment)


def language_path_mismatch(path: Column, language: Column) -> Column:
    found = path_language(path)
    return F.coalesce(
        (language != "") & (F.lower(found) != F.lower(language)), F.lit(False)
    )


def safe_name(text: Column, max_length: int = 50) -> Column:
    """Words and hyphens only, white space as underscores, cut to a length."""
    kept = F.regexp_replace(text, f"[^{WORD}{SP}-]+", "")
    return F.substring(F.regexp_replace(kept, f"[{SP}]+", "_"), 1, max_length)


def fixed_point(value: Column, digits: int) -> Column:
    """Decimal text of a double, rounded on its exact binary value with ties to even.

    ``format_number`` and ``format_string`` round half up on the shortest decimal text instead.
    The rounding error of ``value * 10**digits`` is recovered exactly by splitting the factor,
    which holds for one or two digits and scaled magnitudes below 2**52. Larger values are whole numbers and get
    the digits of their shortest decimal text; beyond 37 digits, that text itself.
    """
    if digits not in (1, 2):
        raise ValueError("one or two digits")
    factor = float(10**digits)
    large = F.abs(value) * F.lit(factor) >= float(2**52)
    whole = F.concat(value.try_cast("decimal(38,0)").cast("string"), F.lit("." + "0" * digits))
    x = F.when(~large, F.abs(value))
    c = x * F.lit(134217729.0)
    high = c - (c - x)
    low = x - high
    product = x * F.lit(factor)
    error = (high * F.lit(factor) - product) + low * F.lit(factor)
    floor = F.floor(product).cast("double")
    beyond_half = (product - floor) - F.lit(0.5)
    round_up = (
        F.when(beyond_half != 0, beyond_half > 0)
        .when(error != 0, error > 0)
        .otherwise(floor % 2 == 1)
    )
    scaled = floor.cast("bigint") + F.when(round_up, 1).otherwise(0)
    unit = int(factor)
    # a negative zero keeps its sign
    negative = (value < 0) | (value.cast("string") == "-0.0")
    text = F.concat(
        F.when(negative, "-").otherwise(""),
        F.floor(scaled / unit).cast("bigint").cast("string"),
        F.lit("."),
        F.lpad((scaled % unit).cast("string"), digits, "0"),
    )
    return (
        F.when(F.isnan(value), "nan")
        .when(value == float("inf"), "inf")
        .when(value == float("-inf"), "-inf")
        .when(large, F.coalesce(whole, value.cast("string")))
        .otherwise(text)
    )


def format_duration(seconds: Column) -> Column:
    """``x.xs`` below a minute, ``x.xm`` below an hour, else ``x.xh``."""
    s = seconds.cast("double")
    under_minute = (s < 60) & ~F.isnan(s)
    under_hour = (s < 3600) & ~F.isnan(s)
    amount = F.when(under_minute, s).when(under_hour, s / 60).otherwise(s / 3600)
    unit = F.when(under_minute, "s").when(under_hour, "m").otherwise("h")
    return F.concat(fixed_point(amount, 1), unit)

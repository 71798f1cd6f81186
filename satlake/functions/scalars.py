"""Scalar expressions whose NULL, rounding or calendar rules need care.

All of them are built-in column expressions and stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from satlake.schemas import BALANCE

SATS_PER_COIN_DIGITS = 8


def concat_skip_null(*parts: Column) -> Column:
    """Concatenate text, treating NULL as empty."""
    return F.concat(*[F.coalesce(p, F.lit("")) for p in parts])


def distinct_array(col: Column) -> Column:
    """Aggregate: sorted distinct values, one trailing NULL if any input is NULL."""
    values = F.array_sort(F.collect_set(col))
    with_null = F.concat(values, F.array(F.lit(None).cast("string")))
    return F.when(F.max(col.isNull()), with_null).otherwise(values)


def percent_change(recent: Column, past: Column) -> Column:
    """Change in percent with two decimals; 0 when there is no base to compare with."""
    ratio = (recent - past) / F.nullif(past, F.lit(0).cast(BALANCE))
    rounded = F.round(ratio * F.lit(100), 2)
    return F.coalesce(rounded.cast("decimal(38,2)"), F.lit(0).cast("decimal(38,2)"))


def period_anchors(as_of: Column) -> Column:
    """The four comparison days before ``as_of``; months and years clamp to month end."""
    days = {
        "daily": F.date_sub(as_of, 1),
        "weekly": F.date_sub(as_of, 7),
        "monthly": F.add_months(as_of, -1),
        "yearly": F.add_months(as_of, -12),
    }
    return F.array(*[F.struct(F.lit(p).alias("period"), d.alias("date")) for p, d in days.items()])


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds since 1970 of a timestamp without zone, read as UTC."""
    days = F.date_diff(ts.cast("date"), F.lit("1970-01-01").cast("date")).cast("bigint")
    return days * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def end_of_day_seconds(day: Column) -> Column:
    """Epoch second of 23:59:59 UTC of a date."""
    return start_of_day_seconds(day) + F.lit(86399)


def start_of_day_seconds(day: Column) -> Column:
    return F.date_diff(day, F.lit("1970-01-01").cast("date")).cast("bigint") * 86400


def iso_from_epoch(seconds: Column) -> Column:
    """ISO text such as 2024-01-31T10:20:30 of an epoch second, in UTC."""
    moment = F.timestamp_seconds(seconds)
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")


# Up to 32 significant hex digits as a high and a low half of 16 digits each.
_HEX_HALVES = r"(?i)^\s*(?:0x)?0*([0-9a-f]{0,16}?)([0-9a-f]{1,16})\s*$"
_TWO_64 = "18446744073709551616"


def hex_uint(text: Column) -> Column:
    """Exact unsigned integer of a hex text as decimal(38,0).

    Two 64-bit halves are converted separately.  NULL when the text is not hex
    or the number has more than 38 decimal digits.  The text is written twice
    in the expression, not more: the halves of no number are empty, and an
    empty low half converts to NULL.
    """
    high = F.conv(F.concat(F.lit("0"), F.regexp_extract(text, _HEX_HALVES, 1)), 16, 10)
    low = F.conv(F.regexp_extract(text, _HEX_HALVES, 2), 16, 10)
    shifted = F.try_multiply(high.cast("decimal(20,0)"), F.lit(_TWO_64).cast("decimal(20,0)"))
    return F.try_add(shifted.cast("decimal(38,0)"), low.cast("decimal(20,0)")).cast("decimal(38,0)")


def is_hex_number(text: Column) -> Column:
    """The text is a hex number at all, whether or not it fits 38 digits."""
    return text.rlike(r"(?i)^\s*(0x)?[0-9a-f]+\s*$")


def shift_point(integer: Column, decimals: Column) -> Column:
    """``integer / 10**decimals`` as a balance, rounded half away from zero once.

    The number is read with a decimal exponent, so no digit is lost in a
    division; a value beyond the balance type gives NULL.
    """
    text = F.concat(integer.cast("string"), F.lit("E-"), decimals.cast("int").cast("string"))
    return text.try_cast(BALANCE)


def sats_to_coins(sats: Column) -> Column:
    """Hundred-millionths as a balance; exact for whole numbers below 10^28."""
    unit = F.lit("0.00000001").cast("decimal(9,8)")
    return (sats.cast("string").try_cast("decimal(28,0)") * unit).try_cast(BALANCE)


def pad_address(address: Column, strip: str = "all", lower: bool = True) -> Column:
    """Address as 64 hex digits without prefix; longer input is kept whole.

    ``strip="all"`` removes every ``0x``; ``strip="first"`` removes the first
    two characters whatever they are.
    """
    body = F.replace(address, F.lit("0x"), F.lit("")) if strip == "all" else F.substr(address, F.lit(3))
    if strip == "all" and lower:
        body = F.replace(F.lower(address), F.lit("0x"), F.lit(""))
    elif lower:
        body = F.lower(body)
    return F.lpad(body, F.greatest(F.length(body), F.lit(64)), F.lit("0"))


def split_exactly(text: Column, sep: str, parts: int, index: int) -> Column:
    """Piece ``index`` (from 0) of a text that must split into ``parts`` pieces, else NULL."""
    pieces = F.split(text, "[" + sep + "]")
    return F.when(F.size(pieces) == parts, F.get(pieces, F.lit(index)))


def symbol_of_slug(slug: Column) -> Column:
    """``wBTC`` of ``Project-wBTC_Network``."""
    return F.split_part(F.split_part(slug, F.lit("-"), F.lit(2)), F.lit("_"), F.lit(1))


def comma_list(text: Column) -> Column:
    """Array of the trimmed, non-blank entries of a comma separated text."""
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def metric_value(text: Column, prefix: str) -> Column:
    """Second word of the first line that starts with ``prefix``."""
    found = F.regexp_extract(text, r"(?m)^" + prefix + r"\S*[ \t]+(\S+)", 1)
    return F.nullif(found, F.lit(""))

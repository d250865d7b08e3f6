"""Column functions on message text."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes, in code-point order.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0 "
    "           "
    "    　"
)
# The line ends Python's str.splitlines() knows, as a pattern.
LINE_BREAK = r"\r\n|[\n\x0b\x0c\r\x1c\x1d\x1e\x{85}\x{2028}\x{2029}]"
# What credential masking must find and leave behind.
CREDENTIALS = r"://([^:@/]+):([^@]+)@"
CREDENTIALS_MASK = "://$1:****@"
SECRET_MASK = "***REDACTED***"


def strip(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(c, F.lit(WHITESPACE))


def has_text(c: Column) -> Column:
    """True when something other than whitespace is there; null counts as no text."""
    return F.coalesce(strip(c) != "", F.lit(False))


def join_parts(parts: Column) -> Column:
    """Concatenate the text of all parts, with nothing in between.

    ``array_join`` skips null texts and an empty text adds nothing, so no lambda
    is needed and the expression stays inside generated code.
    """
    return F.coalesce(F.array_join(parts.getField("text"), ""), F.lit(""))


def default_if_empty(c: Column, value: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(value))


def append_text(prior: Column, delta: Column) -> Column:
    """Prior text, newline, new text, stripped; only the new text if nothing was stored."""
    return F.when(
        F.coalesce(prior, F.lit("")) != "", strip(F.concat_ws("\n", prior, delta))
    ).otherwise(delta)


def moment(now: Column | datetime | str) -> Column:
    """A point in time given as a column, a datetime or text."""
    return now if isinstance(now, Column) else F.lit(now).cast("timestamp")


def iso_timestamp(ts: Column) -> Column:
    """ISO-8601 with offset; the fraction appears only when it is not zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ssxxx")
    micros = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(micros)


def mask_credentials(c: Column) -> Column:
    """Hide the password in every ``scheme://user:password@host``."""
    return F.regexp_replace(c, CREDENTIALS, CREDENTIALS_MASK)


def mask_secret(c: Column, secret: Column | str) -> Column:
    """Replace a known secret; an empty or missing secret leaves the text alone."""
    secret = F.lit(secret) if isinstance(secret, str) else secret
    return F.when(
        F.coalesce(secret, F.lit("")) != "", F.replace(c, secret, F.lit(SECRET_MASK))
    ).otherwise(c)

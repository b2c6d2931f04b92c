"""Link columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# No blank of any script and no backslash, to the very end of the text.
SAFE_LINK = (
    r"(?i)^https?://[^\s\\\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+\z"
)


def safe_url(url: Column) -> Column:
    """An absolute web link without blanks or backslashes, else empty."""
    return F.when(url.rlike(SAFE_LINK), url).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """Host of a safe link in lower case, without user part or port, else null."""
    found = F.regexp_extract(url, r"(?i)^https?://(?:[^/?#@\s\\]*@)?([^/?#:@\s\\]+)", 1)
    return F.when(url.rlike(SAFE_LINK) & (found != ""), F.lower(found))


def query_param(url: Column, key: str) -> Column:
    """First value of a query parameter, decoded; empty when absent.

    A percent sign that starts no escape stands for itself; a value that is no text when decoded stays
    as it is.
    """
    raw = F.regexp_extract(url, rf"^[^?#]*\?(?:[^#]*?&)?{key}=([^&#]*)", 1)
    escaped = F.regexp_replace(raw, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(escaped), raw, F.lit(""))

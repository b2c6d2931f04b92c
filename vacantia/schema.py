"""Explicit schemas of the landed and stored tables. Nothing is inferred."""

from pyspark.sql import types as T

_S, _B, _D = T.StringType(), T.BooleanType(), T.DateType()
_STRINGS = T.ArrayType(_S)


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


#: One row of a board document, dates still ISO text.
DOCUMENT_ROW = _struct(
    id=_S, type=_S, company=_S, role=_S, category=_S, location=_S, states=_STRINGS,
    remote=_B, clearance=_B, url=_S, date_added=_S, closed=_B, closed_date=_S,
)

#: One published board document.
DOCUMENT = _struct(
    categories=_STRINGS, new_days=T.IntegerType(), generated=_S, rows=T.ArrayType(DOCUMENT_ROW)
)

#: The stored listing table.
LISTING = _struct(
    id=_S, source=_S, platform=_S, board_key=_S, company=_S, role=_S, type=_S, category=_S,
    location=_S, locations=_STRINGS, states=_STRINGS, remote=_B, clearance=_B, url=_S,
    date_added=_D, closed=_B, closed_date=_D, reopened_date=_D,
)

EMPLOYER = _struct(
    platform=_S, name=_S, key=T.MapType(_S, _S), security_company=_B, apply_hosts=_STRINGS,
    search_terms=_STRINGS,
)

POSTING = _struct(
    platform=_S, board_key=_S, posting_id=_S, title=_S, location=_S, description=_S, url=_S,
    scan_ts=T.TimestampType(), scan_ok=_B,
)

PROBE = _struct(listing_id=_S, probe_ts=T.TimestampType(), outcome=_S)

SUBMISSION = _struct(
    issue_id=T.LongType(), company=_S, title=_S, location=_S, url=_S, category=_S, body=_S,
    labels=_STRINGS,
)

SCAN_EVENT = _struct(
    event_id=T.LongType(), ts=T.TimestampNTZType(), user_id=T.LongType(), event_type=_S,
    value=T.DoubleType(), props=_S,
)

"""Expressions over one access-log line. Malformed input gives nulls or empty text, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed


def is_access_line(line: Column) -> Column:
    return line.rlike(f"(?Ud){fixed.ACCESS_LINE}")


def tokens(line: Column) -> Column:
    return F.split(line, " ")


def client(parts: Column) -> Column:
    return F.get(parts, F.lit(0))


def event_time(line: Column) -> Column:
    return F.try_to_timestamp(F.regexp_extract(line, fixed.BRACKETED, 1), F.lit(fixed.TIME_FORMAT))


def verb(line: Column) -> Column:
    return F.regexp_extract(line, fixed.VERB, 1)


def url(line: Column) -> Column:
    return F.regexp_extract(line, fixed.URL, 1)


def protocol(line: Column) -> Column:
    return F.regexp_extract(line, fixed.PROTOCOL, 0)


def status_token(parts: Column) -> Column:
    return F.get(parts, F.lit(fixed.STATUS_TOKEN)).try_cast("int")


def size_token(parts: Column) -> Column:
    # A missing token reads as null, so no length test is needed.
    return F.get(parts, F.lit(fixed.SIZE_TOKEN)).try_cast("int")


def product_id(request_url: Column) -> Column:
    return F.regexp_extract(request_url, fixed.PRODUCT_ID, 1)


def status_after_request(line: Column) -> Column:
    """Number after the quoted request, 0 when there is none; one of more than 38 digits is the largest of 38."""
    digits = _status_digits(line)
    number = F.when(F.length(F.ltrim(digits, F.lit("0"))) > 38, "9" * 38).otherwise(digits)
    return F.coalesce(number.try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def _status_digits(line: Column) -> Column:
    return F.regexp_extract(line, f"(?Ud){fixed.STATUS_AFTER_REQUEST}", 1)


def severity(line: Column) -> Column:
    """Band of a line by its status; lines of another format are ``raw``."""
    status = status_after_request(line)
    return (
        F.when(~is_access_line(line), "raw")
        # also of any number of digits
        .when(status >= 500, "server_error")
        .when(status >= 400, "client_error")
        .when(status >= 300, "redirect")
        .when(status >= 200, "success")
        .otherwise("other")
    )

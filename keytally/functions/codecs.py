"""Scalar column functions: line codecs, time formats, labels, message templates.

All are built-in expressions (no Python UDF), so they compile into whole-stage codegen.
Times are taken as ``timestamp_ntz`` where possible: formatting and millisecond
arithmetic on ``timestamp_ntz`` do not depend on the session time zone.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from keytally import fixed_values as fv

DATE_FORMAT = "yyyy-MM-dd"
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"

AD_LINE_FIELDS = ("timestamp_ms", "area", "city", "user_id", "ad_id")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


# --- time ---------------------------------------------------------------------------

def ntz_to_millis(ts: Column | str) -> Column:
    """Milliseconds since 1970-01-01 of a ``timestamp_ntz`` (truncated), zone-free."""
    return F.timestamp_diff("MILLISECOND", _epoch_ntz(), _col(ts)).cast("bigint")


def millis_to_ntz(ms: Column | str) -> Column:
    """``timestamp_ntz`` at ``ms`` milliseconds after 1970-01-01 00:00:00, zone-free."""
    return F.timestamp_add("MILLISECOND", _col(ms), _epoch_ntz())


def current_millis() -> Column:
    """Wall-clock epoch millis (``System.currentTimeMillis``); fixed per query."""
    return F.unix_millis(F.current_timestamp())


def parse_date(day: str) -> Column:
    """``yyyy-MM-dd`` literal -> ``timestamp_ntz`` at midnight."""
    return F.to_timestamp_ntz(F.lit(day), F.lit(DATE_FORMAT))


def format_date(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATE_FORMAT)


def format_datetime(ts: Column | str) -> Column:
    return F.date_format(_col(ts), DATETIME_FORMAT)


# --- labels and messages --------------------------------------------------------------

def label(prefix: str, number: Column | str) -> Column:
    """``prefix + number`` (e.g. ``user_7``)."""
    return F.concat(F.lit(prefix), _col(number).cast("string"))


def message_text(number: Column | str, template: str = fv.MESSAGE_TEMPLATE) -> Column:
    """The producer demo's message body for sequence number ``number``."""
    n = _col(number)
    return F.format_string(template, n, n)


def letter(code: Column | str) -> Column:
    """Character of a code point (97..122 -> a..z)."""
    return F.char(_col(code).cast("bigint"))


# --- ad-click line codec ------------------------------------------------------------------

def _java_string(c: Column) -> Column:
    # Java string concatenation prints a null reference as "null".
    return F.coalesce(c.cast("string"), F.lit("null"))


def encode_ad_line(timestamp_ms: Column | str, area: Column | str, city: Column | str,
                   user_id: Column | str, ad_id: Column | str, delimiter: str = " ") -> Column:
    """``"timestamp area city userid adid"`` single-space line."""
    parts = [timestamp_ms, area, city, user_id, ad_id]
    return F.concat_ws(delimiter, *[_java_string(_col(p)) for p in parts])


def decode_ad_line(line: Column | str, delimiter: str = " ") -> Column:
    """Struct of the five fields of an ad-click line plus ``_corrupt``.

    Numbers are parsed with ``try_cast``; a line with the wrong number of fields or an
    unparsable number keeps its fields as far as they parse and carries the whole
    line in ``_corrupt`` (null for a good line).
    """
    text = _col(line)
    parts = F.split(text, re.escape(delimiter), -1)  # the delimiter is text, not a pattern
    ts = F.get(parts, 0).try_cast("bigint")
    area = F.get(parts, 1)
    city = F.get(parts, 2)
    user = F.get(parts, 3).try_cast("int")
    ad = F.get(parts, 4).try_cast("int")
    bad = ((F.size(parts) != F.lit(len(AD_LINE_FIELDS))) | ts.isNull() | user.isNull()
           | ad.isNull())
    return F.struct(ts.alias("timestamp_ms"), area.alias("area"), city.alias("city"),
                    user.alias("user_id"), ad.alias("ad_id"),
                    F.when(bad | text.isNull(), text).alias("_corrupt"))

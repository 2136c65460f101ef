"""The text line kept for a record that could not be delivered."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The five tab-separated fields of a line, in order.
LINE_FIELDS = ("failed_at", "topic", "key", "error", "value_b64")

# Characters that would break a line, and how they are written.
ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))


def rfc3339(ts: Column) -> Column:
    """RFC 3339 text in UTC, with the fraction's trailing zeros (or all of it) left out."""
    utc = F.to_utc_timestamp(ts, F.current_timezone())
    text = F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.concat(F.regexp_replace(text, r"\.?0+$", ""), F.lit("Z"))


def plain_base64(value: Column) -> Column:
    """Base64 without the line breaks that Spark puts after every 76 characters."""
    return F.translate(F.base64(value), "\r\n", "")


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    """Undo `escape`. Written backslashes part the text, so none of them is read twice."""

    def plain(part: Column) -> Column:
        for raw, written in ESCAPES[1:]:
            part = F.replace(part, F.lit(written), F.lit(raw))
        return part

    return F.array_join(F.transform(F.split(text, r"\\\\"), plain), "\\")


def dead_letter_line(failed_at: Column, topic: Column, key: Column, error: Column,
                     value: Column) -> Column:
    def text(col: Column) -> Column:
        return escape(F.coalesce(col, F.lit("")))

    return F.concat_ws(
        "\t", rfc3339(failed_at), text(topic), text(key.cast("string")), text(error),
        F.coalesce(plain_base64(value), F.lit("")))

"""Text clean-up and digests as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Characters trimmed around a framed payload, white space trimmed
# around a segment, and the byte-order mark.
FRAMING_CHARS = '" \t\r\n'
SEGMENT_SPACE = " \t\r\n\f\u000b"
BYTE_ORDER_MARK = "\ufeff"

# Up to four backslashes directly before r or n belong to the escape.
_ESCAPED_CR = r"(?:\\{4}|\\{2}|\\)r"
_ESCAPED_LF = r"(?:\\{4}|\\{2}|\\)n"


def presanitize(payload: Column) -> Column:
    """Strip framing, turn escaped line ends into real ones, use CR throughout.

    The regular expressions only run for texts that contain an escape.
    """
    text = F.btrim(payload, F.lit(FRAMING_CHARS))
    text = F.when(F.contains(text, F.lit("\\r")), F.regexp_replace(text, _ESCAPED_CR, "\r")).otherwise(text)
    text = F.when(F.contains(text, F.lit("\\n")), F.regexp_replace(text, _ESCAPED_LF, "\n")).otherwise(text)
    text = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\r")), F.lit("\n"), F.lit("\r"))
    return F.regexp_replace(text, f"^{BYTE_ORDER_MARK}", "")


def trim_space(text: Column) -> Column:
    return F.btrim(text, F.lit(SEGMENT_SPACE))


def plain_base64(value: Column) -> Column:
    """Base64 on one line; Spark breaks long output into lines."""
    return F.regexp_replace(F.base64(value), "[\r\n]", "")


def md5_base64(document: Column) -> Column:
    return F.base64(F.unhex(F.md5(document)))

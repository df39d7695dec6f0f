"""Tolerant text-to-type conversions of the landing columns: bad text becomes null, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted text forms.
US_DATE_START = r"^\s*\d{1,2}/"
US_TIMESTAMP = r"^\s*(\d{1,2})/(\d{1,2})/(\d{2,4})\s+(\d{1,2}):(\d{1,2}):(\d{1,2})\s*$"
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
RARE_NUMBER = r"^([+-]?(\d+\.?\d*|\.\d+)(e[+-]?\d+)?|[+-]?inf(inity)?|nan)$"
RARE_NUMBER_NOISE = r"(?<=\d)_(?=\d)|^[+-](?=nan$)"


def parse_us_timestamp(text: Column) -> Column:
    """``M/D/YYYY H:MM:SS`` (padded or not) as a timestamp without zone.

    The text is rewritten to ISO order and cast, which does not depend on the session time zone and, unlike
    a date-format parser, costs nothing extra on bad rows.  Text of any other form keeps its first slash, which no
    ISO timestamp has, and becomes null.  Years of two or three digits are taken literally, as
    ``strptime`` does: the two zeros make them long enough for the cast.
    """
    iso = F.regexp_replace(text, US_TIMESTAMP, "00$3-$1-$2 $4:$5:$6")
    return F.when(text.rlike(US_DATE_START), iso).try_cast("timestamp_ntz")


def parse_amount(text: Column) -> Column:
    """Number text as a double.

    Plain numbers take the direct cast.  The second branch handles the rare spellings: digit
    groups joined by ``_``, signed ``nan``, ``inf``.  Java-only forms (``5.0d``, ``5f``, hex) are null.
    """
    rare = F.regexp_replace(F.lower(F.trim(text)), RARE_NUMBER_NOISE, "")
    return F.when(text.rlike(PLAIN_NUMBER), text).when(rare.rlike(RARE_NUMBER), rare).try_cast("double")

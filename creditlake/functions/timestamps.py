"""Mixed-format timestamp parsing as one native expression (no Python UDF).

Order of attempts, first success wins:
1. a plain number is epoch seconds, kept only inside the closed range
   1990-01-01 .. 2050-01-01;
2. ISO text ``yyyy-M-d H:m:s``;
3. European text ``d-M-yyyy``;
4. US text ``M/d/yyyy H:m`` followed by an AM/PM marker. The marker must be
   present but, by default, does not change the hour (the original format pairs
   a 24-hour field with the marker, so ``02:30 PM`` is 02:30).
Anything else is NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditlake.schemas import (
    EPOCH_MAX_SECONDS,
    EPOCH_MIN_SECONDS,
    EU_PATTERN,
    ISO_PATTERN,
    US_PATTERN,
    US_PATTERN_MERIDIEM,
)

# A decimal number, optionally signed, with optional exponent and padding.
NUMBER_RE = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
MERIDIEM_RE = r"\s+[AaPp][Mm]$"

# Shapes a text must have before a pattern is tried. They only skip hopeless
# parse attempts (a failed attempt is costly); the pattern still validates.
ISO_SHAPE = r"^\d{4}-\d{1,2}-\d{1,2} \d{1,2}:\d{1,2}:\d{1,2}$"
EU_SHAPE = r"^\d{1,2}-\d{1,2}-\d{4}$"
US_SHAPE = r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2} [AaPp][Mm]$"


def parse_mixed_timestamp(col: Column | str, meridiem: str = "ignore") -> Column:
    """Parse a text column holding epoch seconds or one of three text shapes.

    ``meridiem='ignore'`` keeps the original behaviour (marker read, hour kept);
    ``meridiem='honour'`` reads the time as a 12-hour clock.
    """
    if meridiem not in ("ignore", "honour"):
        raise ValueError("meridiem must be 'ignore' or 'honour'")
    s = (F.col(col) if isinstance(col, str) else col).cast("string")

    seconds = F.when(s.rlike(NUMBER_RE), s.try_cast("double"))
    epoch = F.when(
        seconds.between(F.lit(EPOCH_MIN_SECONDS), F.lit(EPOCH_MAX_SECONDS)),
        F.timestamp_seconds(seconds),
    )
    # A space in the original formats matches any run of whitespace; edges must not have any.
    t = F.regexp_replace(s, r"\s+", " ")
    iso = F.when(t.rlike(ISO_SHAPE), F.try_to_timestamp(t, F.lit(ISO_PATTERN)))
    eu = F.when(t.rlike(EU_SHAPE), F.try_to_timestamp(t, F.lit(EU_PATTERN)))
    if meridiem == "ignore":
        us_text = F.regexp_replace(t, MERIDIEM_RE, "")
        us = F.when(t.rlike(US_SHAPE), F.try_to_timestamp(us_text, F.lit(US_PATTERN)))
    else:
        us = F.when(t.rlike(US_SHAPE), F.try_to_timestamp(F.upper(t), F.lit(US_PATTERN_MERIDIEM)))
    return F.coalesce(epoch, iso, eu, us)

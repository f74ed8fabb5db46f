"""Text clean-up expressions (missing-value tokens, Unicode strip, lower-case)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from creditlake.schemas import NA_TOKENS

# Code points Python's str.strip() removes (the Unicode White_Space
# set plus the four ASCII separators 0x1C-0x1F).
WHITESPACE_CODEPOINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
WHITESPACE_CHARS = "".join(chr(c) for c in WHITESPACE_CODEPOINTS)


def null_na_tokens(col: Column | str) -> Column:
    """Turn the CSV reader's missing-value tokens into NULL (exact, untrimmed match)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*NA_TOKENS), F.lit(None).cast("string")).otherwise(c)


def strip_unicode(col: Column | str) -> Column:
    """Remove leading and trailing Unicode whitespace (tabs, newlines, NBSP, ...)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.btrim(c, F.lit(WHITESPACE_CHARS))


def normalise_text(col: Column | str) -> Column:
    """Strip, then lower-case."""
    return F.lower(strip_unicode(col))

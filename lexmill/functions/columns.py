"""Column expressions used across the operators. All of them stay on the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points removed by a Unicode-aware strip of both ends.
STRIP_CODE_POINTS = (
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)
STRIP_CHARS = "".join(map(chr, STRIP_CODE_POINTS))

# Cell texts that a CSV reader takes as missing.
NA_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

KEY_SPACE = 1 << 32


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends (plain ``trim`` removes U+0020 only)."""
    return F.btrim(text, F.lit(STRIP_CHARS))


def na_to_null(text: Column) -> Column:
    return F.when(~text.isin(*NA_TEXTS), text)


def idiv(numerator: Column, denominator: int | Column) -> Column:
    """Whole-number division that never passes through a double."""
    return F.call_function("div", numerator, denominator if isinstance(denominator, Column) else F.lit(denominator))


def md5_key(*parts: Column | str | int) -> Column:
    """Hex digest of the parts joined by ``:``, the source of every repeatable random choice."""
    cols = [p if isinstance(p, Column) else F.lit(p) for p in parts]
    return F.md5(F.concat_ws(":", *[c.cast("string") for c in cols]))


def hex_prefix(digest: Column, digits: int) -> Column:
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("bigint")


def uniform_key(*parts: Column | str | int) -> Column:
    """Uniform whole number below 2^32. A function of its parts only, so retries repeat it."""
    return hex_prefix(md5_key(*parts), 8)

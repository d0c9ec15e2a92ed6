"""Stand-ins for missing values, codes and positions: column expressions only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What people enter where a value is missing (compared trimmed, lower case).
STAND_INS = ["", ".", "-", "--", "?", "-2", "n/a", "none", "null", "tbd", "unknown", "xxx", "not on file", "not available", "(blank)"]
ZIP_STAND_INS = [*STAND_INS, "00000"]


def squeezed(c: Column) -> Column:
    """Blanks at the ends removed and inner runs of blanks made one."""
    return F.trim(F.regexp_replace(c, r"[\s ]+", " "))


def usable(c: Column, stand_ins: list[str] = STAND_INS) -> Column:
    """Not null, blank or a stand-in. Never null itself."""
    return F.coalesce(~F.lower(squeezed(c.cast("string"))).isin(stand_ins), F.lit(False))


def stated(c: Column, stand_ins: list[str] = STAND_INS) -> Column:
    """The value where it is usable, else null."""
    return F.when(usable(c, stand_ins), c)


def digit_code(c: Column, width: int) -> Column:
    """A numeric code in any written form as exactly width digits; null if it has none or more."""
    d = F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), r"\.0+$", ""), r"\D", "")
    return F.when((F.length(d) > 0) & (F.length(d) <= width), F.lpad(d, width, "0"))


def zip5(c: Column) -> Column:
    """First five digits of a postal code with lost leading zeros restored; null for stand-ins."""
    z = F.nullif(F.regexp_extract(F.trim(c.cast("string")), r"^(\d{3,5})(?:\D.*)?$", 1), F.lit(""))
    return F.nullif(F.lpad(z, 5, "0"), F.lit("00000"))


def county_code(c: Column) -> Column:
    """Five digits, lost leading zeros restored; null where the value is no county code."""
    d = F.regexp_extract(F.trim(c.cast("string")), r"^(\d{1,5})(?:\.0+)?$", 1)
    return F.when(F.length(d) > 0, F.lpad(d, 5, "0"))

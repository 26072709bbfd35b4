"""Text predicates and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator controls, the set that stripping
# a text is expected to remove.
_BLANK = r"[\s\x1c-\x1f]"
_INK = r"(?U)[^\s\x1c-\x1f]"


def has_text(value: Column) -> Column:
    """True for a text with something other than white space in it, never null."""
    return F.coalesce(value.rlike(_INK), F.lit(False))


def strip(value: Column) -> Column:
    """``value`` without leading and trailing white space of any kind."""
    return F.regexp_replace(value, f"(?U)^{_BLANK}+|{_BLANK}+$", "")


def whole_number(value: Column) -> Column:
    """A text as BIGINT, or null if it is none or too large for one.

    The shape is looked at first because a failing ``try_cast`` costs an
    exception per row; leading zeros count for nothing, so only numbers of 19
    digits and more can still be too large.
    """
    return F.when(value.rlike("^[+-]?0*[0-9]{1,18}$"), F.regexp_replace(value, "^([+-]?)0+(?=[0-9])", "$1").cast("bigint")).when(
        value.rlike("^[+-]?0*[0-9]{19}$"), F.regexp_replace(value, "^([+-]?)0+(?=[0-9])", "$1").try_cast("bigint")
    )


def joined_messages(*messages: Column, separator: str = "; ") -> Column:
    """The non-null messages joined, or null when there is none."""
    return F.nullif(F.concat_ws(separator, *messages), F.lit(""))


def mebibytes(size: Column) -> Column:
    """Bytes as MiB with one decimal."""
    return F.round(size / F.lit(float(1024**2)), 1)


def gibibytes(size: Column) -> Column:
    """Bytes as GiB with two decimals."""
    return F.round(size / F.lit(float(1024**3)), 2)

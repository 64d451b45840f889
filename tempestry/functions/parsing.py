"""Text to typed values. Text that does not parse becomes null and never stops a job."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values ---
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0"
NUMBER = r"[+-]?(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)(?:[eE][+-]?[0-9]+)?"
DAMAGE_UNITS = "KMB"  # thousands, millions, billions
# --- end of fixed values ---


def strip(text: Column) -> Column:
    """``text`` without blanks, tabs and line ends on either side."""
    return F.btrim(text, F.lit(BLANKS))


def real_number(text: Column, single_precision: bool = False) -> Column:
    """[C3] Text to double; ``single_precision`` rounds through a 32-bit float first.

    The pattern comes before the cast on purpose: a cast that fails costs an
    exception per row, and Spark would read ``10F`` as the double 10.
    """
    number = text.try_cast("float" if single_precision else "double").cast("double")
    return F.when(text.rlike(rf"^\s*{NUMBER}\s*$"), number)


def whole_number(text: Column) -> Column:
    """[C2] Text to bigint, fractions cut towards zero, null where it is no number."""
    return real_number(text).try_cast("bigint")


# --- fixed values: letters of date patterns and the texts that can stand for them ---
_DATE_PARTS = {
    "d": r"(?:0?[1-9]|[12][0-9]|3[01])",
    "dd": r"(?:0[1-9]|[12][0-9]|3[01])",
    "M": r"(?:0?[1-9]|1[0-2])",
    "MM": r"(?:0[1-9]|1[0-2])",
    "MMM": r"(?i:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)",
    "yy": r"[0-9]{2}",
    "yyyy": r"[0-9]{4}",
    "H": r"(?:[01]?[0-9]|2[0-3])",
    "HH": r"(?:[01][0-9]|2[0-3])",
    "m": r"[0-5]?[0-9]",
    "mm": r"[0-5][0-9]",
    "s": r"[0-5]?[0-9]",
    "ss": r"[0-5][0-9]",
}
# --- end of fixed values ---


def date_gate(pattern: str) -> str | None:
    """A regular expression that every text of a date pattern matches, and few others.

    Each letter run is one of the known parts; None if the pattern has others.
    """
    parts = re.findall(r"([A-Za-z])(\1*)|([^A-Za-z]+)", pattern)
    if "'" in pattern or "[" in pattern:
        return None
    known = [_DATE_PARTS.get(a + b) if a else re.escape(c) for a, b, c in parts]
    return None if None in known else "^" + "".join(known) + "$"


def instant(text: Column, pattern: str) -> Column:
    """[C4, C5] Text to timestamp in the session's zone.

    Text that cannot be of the pattern is told by a regular expression first,
    as the parser throws and catches an exception for each.
    """
    value = F.try_to_timestamp(F.trim(text), F.lit(pattern))
    gate = date_gate(pattern)
    return value if gate is None else F.when(F.trim(text).rlike(gate), value)


def in_century_of(value: Column, year: Column) -> Column:
    """Move ``value`` by whole centuries to the one nearest to ``year``.

    A two-digit year is read as 20xx. Files of the last century need this to
    get their own dates back, also where an event runs past the turn of it.
    Without a ``year`` the value stays as it is.
    """
    centuries = F.round((year - F.year(value)) / F.lit(100)).cast("int")
    moved = value + F.make_interval(years=centuries * F.lit(100))
    return F.when(centuries != 0, moved).otherwise(value)


def damage_is_blank(text: Column) -> Column:
    return F.coalesce(strip(text) == "", F.lit(True))


def damage_dollars(text: Column) -> Column:
    """[C6, U1] ``10.00K``, ``1.5M``, ``2B`` or plain numbers to whole dollars.

    Missing or blank text is 0 dollars. Anything else that is no amount is
    null, see :func:`damage_is_bad`. The result is a bigint, as amounts pass
    the 32-bit range.
    """
    amount = strip(text)
    units = DAMAGE_UNITS + DAMAGE_UNITS.lower()
    number = F.rtrim(amount, F.lit(f"{units} ")).try_cast("double")
    factor = F.pow(F.lit(1000.0), F.instr(F.lit(DAMAGE_UNITS), F.upper(F.right(amount, F.lit(1)))))
    return F.when(damage_is_blank(text), F.lit(0).cast("bigint")).when(
        amount.rlike(f"^{NUMBER} *[{units}]?$"), (number * factor).try_cast("bigint")
    )


def damage_is_bad(text: Column) -> Column:
    """True where there is text but no amount can be read from it."""
    return ~damage_is_blank(text) & damage_dollars(text).isNull()


def damage_or_error(text: Column) -> Column:
    """As :func:`damage_dollars`, but bad text ends the job with a message that shows it."""
    return F.when(
        damage_is_bad(text), F.raise_error(F.concat(F.lit("not a damage amount: "), text)).cast("bigint")
    ).otherwise(damage_dollars(text))

"""Code and label canonical forms used when label sources are merged."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A plain decimal number: sign, digits before and after the point, exponent.
NUMBER_TEXT = r"^([+-]?)(?=\.?[0-9])([0-9]*)\.?([0-9]*)(?:[eE]([+-]?[0-9]+))?$"
# Exponents of more digits are no numbers of a code (the text would be longer than any code).
EXPONENT_DIGITS = 3


def strip_blanks(value: Column) -> Column:
    """Leading and trailing white space (any Unicode space) removed."""
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def normalize_code(value: Column) -> Column:
    """Canonical code: blanks stripped; an integral number becomes plain integer text.

    ``1111.0`` -> ``1111``, ``0111`` -> ``111``, ``1e3`` -> ``1000``, ``+7`` -> ``7``, ``10e-1`` ->
    ``1``; ``Z``, ``2A``, ``1.5`` stay as they are. Decided on the digits alone, so that numbers of
    any length and scale are exact: the exponent moves the point, then only zeros may follow it.
    """
    text = strip_blanks(value)

    def part(k: int) -> Column:
        return F.regexp_extract(text, NUMBER_TEXT, k)

    power = F.regexp_replace(part(4), "^([+-]?)0+(?=[0-9])", "$1")
    shift = F.coalesce(power.try_cast("int"), F.lit(0))
    fraction = F.regexp_replace(part(3), "0+$", "")
    digits = F.concat(part(2), fraction)
    after = F.length(fraction) - shift  # digits behind the point; negative: zeros to append
    whole = F.when(after <= 0, F.concat(digits, F.repeat(F.lit("0"), -after))).otherwise(
        F.left(digits, F.greatest(F.length(digits) - after, F.lit(0)))
    )
    behind = F.when(after <= 0, F.lit("")).otherwise(F.right(digits, F.least(after, F.length(digits))))
    plain = F.regexp_replace(whole, "^0+", "")
    number = F.when(plain == "", F.lit("0")).otherwise(
        F.concat(F.when(part(1) == "-", F.lit("-")).otherwise(F.lit("")), plain)
    )
    short = F.length(F.regexp_replace(power, "^[+-]", "")) <= EXPONENT_DIGITS
    integral = text.rlike(NUMBER_TEXT) & short & (F.regexp_replace(behind, "0+$", "") == "")
    return F.when(integral, number).otherwise(text)


def clean_label(value: Column) -> Column:
    """Label without stray double quotes, runs of white space collapsed, trimmed."""
    spaced = F.regexp_replace(F.translate(value, '"', " "), r"(?U)\s+", " ")
    return F.trim(spaced)


def is_blank(value: Column) -> Column:
    """NULL, empty or only white space."""
    return value.isNull() | (strip_blanks(value) == "")

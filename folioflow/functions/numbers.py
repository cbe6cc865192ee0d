"""Number, date and code parsing. Two number rules exist: tolerant amounts and strict line values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import bind, groups, or_empty, trim_blanks

_AMOUNT = r"^([+-]?)(\d[\d,]*(?:\.\d*)?|\.\d+)\s*([+-]?)\z"
_INTEGER = r"^[\t-\r ]*[+-]?\d+[\t-\r ]*\z"
_QUANTITY = r"^(\(?)([+-]?)((?:\d[\d,]*)?)(?:\.(\d*))?(?:[eE]([+-]?\d{1,2}))?\s*([+-]?)(\)?)\z"
# Already in the form quantities are written to the table.
_USUAL_QUANTITY = r"^(?:0|[1-9]\d{0,27})(?:\.\d+)?\z"


def tolerant_amount(text: Column) -> Column:
    """Amount as decimal(18,2); unreadable or blank text is 0, an amount too large is null.

    A single comma without any dot is a decimal comma, other commas are thousands marks.
    """
    dotted = bind(
        trim_blanks(or_empty(text)), lambda t: F.when(t.rlike(r"^[^.,]*,[^.,]*\z"), F.translate(t, ",", ".")).otherwise(t)
    )

    def value(parts: Column) -> Column:
        lead, body, trail = (F.get(parts, F.lit(i)) for i in range(3))
        sign = F.when(F.concat(lead, trail) == "-", "-").otherwise("")
        number = F.concat(sign, F.replace(body, F.lit(","), F.lit(""))).try_cast("decimal(18,2)")
        # No match, or a sign on both ends: not a number.
        unreadable = parts.isNull() | (F.length(F.concat(lead, trail)) > 1)
        return F.when(unreadable, F.lit(0).cast("decimal(18,2)")).otherwise(number)

    return bind(bind(dotted, lambda d: groups(d, _AMOUNT, 3)), value)


def whole_number(text: Column) -> Column:
    """32-bit integer with optional blanks and sign, null for anything else."""
    return F.when(text.rlike(_INTEGER), F.regexp_replace(text, r"[\t-\r ]", "")).try_cast("int")


def part_number(text: Column) -> Column:
    """Part number as plain integer text (leading zeros gone), null when it is no 32-bit integer."""
    return whole_number(text).cast("string")


def quantity_text(text: Column) -> Column:
    """Quantity as plain decimal text with its written scale kept, null when it is no number.

    Accepts blanks, a sign before or after, parentheses for negatives, thousands commas and an
    exponent. The text never passes through a decimal type, so ``1.000`` stays ``1.000``.
    """

    def plain(parts: Column) -> Column:
        opened, lead, whole, fraction, exponent, trail, closed = (F.get(parts, F.lit(i)) for i in range(7))
        marks = F.length(F.concat(opened, lead, trail))
        negative = F.contains(F.concat(opened, lead, trail), F.lit("-")) | (opened != "")
        digits = F.concat(F.replace(whole, F.lit(","), F.lit("")), fraction)
        scale = F.length(fraction) - F.coalesce(exponent.try_cast("int"), F.lit(0))
        valid = (digits != "") & (F.length(opened) == F.length(closed)) & (marks <= 1)
        number = F.struct(digits.alias("digits"), scale.alias("scale"), negative.alias("negative"))
        return bind(F.when(valid, number), placed)

    def placed(number: Column) -> Column:
        digits, scale = number["digits"], number["scale"]
        # Digits padded so that at least one stands before the point, then cut at the scale.
        padded = F.when(scale <= 0, F.concat(digits, F.repeat(F.lit("0"), -scale))).otherwise(
            F.lpad(digits, F.greatest(F.length(digits), scale + 1), F.lit("0"))
        )
        kept = F.greatest(scale, F.lit(0))
        return bind(padded, lambda p: written(number, p, kept))

    def written(number: Column, padded: Column, kept: Column) -> Column:
        before = F.regexp_replace(F.left(padded, F.length(padded) - kept), r"^0+(?=\d)", "")
        after = F.when(kept > 0, F.concat(F.lit("."), F.right(padded, kept))).otherwise("")
        sign = F.when(number["negative"] & number["digits"].rlike("[1-9]"), "-").otherwise("")
        return bind(before, lambda b: F.when(F.length(b) <= 28, F.concat(sign, b, after)))

    def usual_or_any(trimmed: Column) -> Column:
        return F.when(trimmed.rlike(_USUAL_QUANTITY), trimmed).otherwise(bind(groups(trimmed, _QUANTITY, 7), plain))

    return bind(trim_blanks(or_empty(text)), usual_or_any)


_CLOCK = r"(?:[T ]\s*(\d{1,2}):(\d{1,2})(?::(\d{1,2}(?:\.\d{1,6})?))?\s*([AaPp][Mm])?)?"
_YEAR_FIRST = rf"^(\d{{4}})[-/](\d{{1,2}})[-/](\d{{1,2}}){_CLOCK}\z"
_MONTH_FIRST = rf"^(\d{{1,2}})[-/](\d{{1,2}})[-/](\d{{4}}){_CLOCK}\z"


def loose_timestamp(text: Column) -> Column:
    """Date or date-time, year first or month first, with - or /; null for other layouts."""

    def made(parts: Column) -> Column:
        year, month, day, clock, minute, second, half = (F.get(parts, F.lit(i)) for i in range(7))
        hour = F.coalesce(clock.try_cast("int"), F.lit(0))
        hour = (
            F.when(half == "", hour)
            .when(hour.between(1, 12), hour % 12 + F.when(F.lower(half) == "pm", 12).otherwise(0))
        )
        return F.try_make_timestamp_ntz(
            year.try_cast("int"), month.try_cast("int"), day.try_cast("int"), hour,
            F.coalesce(minute.try_cast("int"), F.lit(0)),
            # Casting an empty string to decimal costs an exception per row.
            F.when(second == "", F.lit(0).cast("decimal(16,6)")).otherwise(second.try_cast("decimal(16,6)")),
        )

    parts = bind(
        trim_blanks(or_empty(text)),
        lambda t: F.coalesce(
            groups(t, _YEAR_FIRST, 7), groups(t, _MONTH_FIRST, 7, order=(3, 1, 2, 4, 5, 6, 7))
        ),
    )
    return bind(parts, made)

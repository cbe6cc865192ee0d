"""Text helpers shared by all parsers. Everything stays a JVM column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as the documents' producer counts it, every Unicode blank and line end.
BLANKS = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def trim_blanks(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def or_empty(text: Column) -> Column:
    """Missing text is an empty string everywhere in the target tables."""
    return F.coalesce(text, F.lit(""))


def is_blank(text: Column) -> Column:
    return trim_blanks(or_empty(text)) == ""


def fold_case(text: Column) -> Column:
    """Key used wherever names or paths are compared without regard to case."""
    return F.lower(text)


def clean_document(text: Column) -> Column:
    """Decoded file text: invalid bytes replaced, byte order mark dropped."""
    return F.regexp_replace(F.make_valid_utf8(text), "^\ufeff", "")


def compact_date(text: Column) -> Column:
    """Drop the dashes of a date; nothing is validated."""
    return F.replace(or_empty(text), F.lit("-"), F.lit(""))


def concat_present(*parts: Column) -> Column:
    """The non-null parts, in order, as one array."""
    return F.array_compact(F.array(*parts))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is evaluated once however often the body uses it.

    Inside array lambdas Spark does not share common subexpressions.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def groups(text: Column, pattern: str, count: int, order: tuple[int, ...] | None = None) -> Column:
    """All groups of an anchored pattern as one array, from one pass; null when it does not match.

    The text must not hold the separator, a unit separator character, where the pattern matches.
    """
    wanted = order or tuple(range(1, count + 1))
    template = "\x1f".join(f"${i}" for i in wanted)
    return F.when(text.rlike(pattern), F.split(F.regexp_replace(text, pattern, template), "\x1f"))

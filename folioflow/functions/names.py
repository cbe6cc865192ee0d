"""Keys and names derived from file names and paths."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.text import bind, is_blank


def file_name(path: Column) -> Column:
    return F.substring_index(F.replace(path, F.lit("\\"), F.lit("/")), "/", -1)


def _pdf_parts(name: Column) -> Column:
    return F.split(name, "-")


def _well_formed(parts: Column) -> Column:
    # Four dash-separated parts, the fourth (with whatever extension follows) at least 8 long.
    return (F.size(parts) >= 4) & (F.length(F.get(parts, F.lit(3))) >= 8)


def _correlative(parts: Column) -> Column:
    return F.substring(F.get(parts, F.lit(3)), 2, 7)


def guide_name(serie: Column, correlative: Column) -> Column:
    return F.concat(F.lit("GR-0"), serie, F.lit("-"), correlative)


def guide_key_from_pdf(name: Column) -> Column:
    """Guide key spelled by a PDF name, null when the name does not carry one."""
    return bind(
        _pdf_parts(name),
        lambda parts: F.when(_well_formed(parts), guide_name(F.get(parts, F.lit(2)), _correlative(parts))),
    )


def companion_of_pdf(name: Column) -> Column:
    """Name of the text record that belongs to a PDF, null when the PDF name is malformed."""

    def companion(parts: Column) -> Column:
        issuer, serie = F.get(parts, F.lit(0)), F.get(parts, F.lit(2))
        return F.when(
            _well_formed(parts),
            F.concat(issuer, F.lit("-"), serie, F.lit("-"), _correlative(parts), F.lit(".txt")),
        )

    return bind(_pdf_parts(name), companion)


def _stem_parts(txt_name: Column) -> Column:
    return F.split(F.regexp_replace(txt_name, r"\.[^.]*\z", ""), "-")


def is_companion_name(txt_name: Column) -> Column:
    """True for text names that can have a PDF: three parts, the last seven characters long."""
    parts = _stem_parts(txt_name)
    return ~is_blank(txt_name) & (F.size(parts) == 3) & (F.length(F.get(parts, F.lit(2))) == 7)


def pdf_pattern_of_companion(txt_name: Column) -> Column:
    """Glob that finds the PDFs of a text record, null when the name is not a companion name."""
    parts = _stem_parts(txt_name)
    return F.when(
        is_companion_name(txt_name),
        F.concat(
            F.get(parts, F.lit(0)), F.lit("-*-"), F.get(parts, F.lit(1)), F.lit("-?"),
            F.get(parts, F.lit(2)), F.lit("*.pdf"),
        ),
    )


def relative_to(path: Column, root: str) -> Column:
    """Path below ``root``, keeping the leading separator; other paths stay as they are.

    The prefix is compared without case and without looking for a separator after it.
    """
    prefix = root.rstrip("/\\")
    if not prefix.strip():
        return path
    return F.when(
        F.startswith(F.lower(path), F.lit(prefix.lower())), F.substring(path, len(prefix) + 1, 2**31 - 1)
    ).otherwise(path)

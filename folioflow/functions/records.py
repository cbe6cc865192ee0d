"""Key/value text records: attribute index, description fields and labelled values.

A record is one row holding the whole text, so every step is an array expression inside the
row: no shuffle, and a key repeated any number of times is settled without grouping rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import bind, clean_document, concat_present, trim_blanks
from folioflow.schemas import DESCRIPTION_MARKER


def record_lines(text: Column) -> Column:
    return F.split(clean_document(text), "\r\n|\r|\n")


def record_entries(lines: Column) -> Column:
    """Lines ``section;key;index;value`` with a non-empty key; the value may hold more semicolons."""
    columns = F.transform(lines, lambda line: F.split(line, ";", 4))
    entries = F.transform(
        columns,
        lambda c, i: F.struct(
            F.get(c, F.lit(1)).alias("key"),
            i.alias("line_no"),
            F.get(c, F.lit(0)).alias("section"),
            F.coalesce(F.get(c, F.lit(2)), F.lit("")).alias("idx"),
            trim_blanks(F.coalesce(F.get(c, F.lit(3)), F.lit(""))).alias("value"),
        ),
    )
    return F.filter(entries, lambda e: F.coalesce(e["key"], F.lit("")) != "")


def description_fields(lines: Column) -> Column:
    """Trimmed, non-empty pieces of the first line that mentions the description key."""
    first = F.get(F.filter(lines, lambda line: F.contains(line, F.lit(DESCRIPTION_MARKER))), F.lit(0))
    pieces = F.transform(F.split(first, r"\|"), trim_blanks)
    return F.coalesce(F.filter(pieces, lambda p: p != ""), F.array().cast("array<string>"))


def first_of_runs(ordered: Column) -> Column:
    """Elements of a sorted array of structs whose ``key`` differs from the one before."""
    return bind(
        ordered,
        lambda runs: F.filter(runs, lambda e, i: (i == 0) | (F.get(runs, i - 1)["key"] != e["key"])),
    )


def index_records(df: DataFrame, text: str = "value") -> DataFrame:
    """Add ``entries`` (first line of each key, by key), ``attributes`` (map) and ``fields``."""
    # Sorting by (key, line) puts the first line of each key at the head of its run.
    return (
        df.withColumn("lines", record_lines(F.col(text)))
        .withColumn("entries", first_of_runs(F.sort_array(record_entries(F.col("lines")))))
        .withColumn(
            "attributes",
            F.map_from_entries(F.transform("entries", lambda e: F.struct(e["key"], e["value"]))),
        )
        .withColumn("fields", description_fields(F.col("lines")))
    )


def attribute(attributes: Column, key: str) -> Column:
    return F.coalesce(F.element_at(attributes, F.lit(key)), F.lit(""))


def labelled_value(fields: Column, label: str) -> Column:
    """Rest of the first field that starts with the label and a blank; empty when there is none."""
    prefix = f"{label} "
    match = F.get(F.filter(fields, lambda f: F.startswith(f, F.lit(prefix))), F.lit(0))
    return F.coalesce(F.substring(match, len(prefix) + 1, 2**31 - 1), F.lit(""))


def missing_attributes(attributes: Column, keys: list[str]) -> Column:
    """One message per attribute the record lacks, in the order of ``keys``."""
    return concat_present(
        *(F.when(~F.map_contains_key(attributes, key), f"{key}:Attribute not found  ") for key in keys)
    )


def missing_labels(fields: Column, labels: list[str]) -> Column:
    """One message per label no field starts with, in the order of ``labels``."""
    def lacks(label: str) -> Column:
        return ~F.exists(fields, lambda f: F.startswith(f, F.lit(f"{label} ")))

    return concat_present(
        *(F.when(lacks(label), f"{label}:Description not found  ") for label in labels)
    )

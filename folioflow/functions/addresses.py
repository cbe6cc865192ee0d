"""Recipient lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioflow.functions.records import first_of_runs
from folioflow.functions.text import trim_blanks


def split_addresses(raw: Column) -> Column:
    """Addresses split at commas, semicolons and line ends; trimmed, empty ones dropped."""
    return F.filter(F.transform(F.split(raw, r"[,;\r\n]"), trim_blanks), lambda a: a != "")


def recipients(raw: Column) -> Column:
    """The distinct addresses of a list: compared without case, first spelling and order kept."""
    spelled = F.transform(
        split_addresses(raw),
        lambda a, i: F.struct(F.lower(a).alias("key"), i.alias("pos"), a.alias("address")),
    )
    firsts = F.transform(first_of_runs(F.array_sort(spelled)), lambda a: F.struct(a["pos"], a["address"]))
    return F.transform(F.array_sort(firsts), lambda a: a["address"])

"""Lookup of configured values in the shared parameter table (``tabla, parametro, valor``)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.text import fold_case, is_blank

# The parameter that names the invoice landing folder.
INVOICE_FOLDER_PARAMETER = ("IDOC", "I2CARPETA")


def lookup(requests: DataFrame, parameters: DataFrame) -> DataFrame:
    """Add ``valor`` to requests (``tabla, parametro``); null when there is none.

    Among several values the smallest is taken, so the answer does not depend on row order.
    """
    values = parameters.groupBy(
        fold_case(F.col("tabla")).alias("_tabla"), fold_case(F.col("parametro")).alias("_parametro")
    ).agg(F.min("valor").alias("valor"))
    return (
        requests.join(
            values,
            (fold_case(requests["tabla"]) == F.col("_tabla"))
            & (fold_case(requests["parametro"]) == F.col("_parametro")),
            "left",
        )
        .drop("_tabla", "_parametro")
    )


def with_folder(found: DataFrame) -> DataFrame:
    """Add ``folder``: the looked-up value, null where that is blank.

    Once there is a parameter table only its values count; what is configured elsewhere is for
    installations without one (:func:`invoice_folder`).
    """
    value = F.when(~is_blank(F.col("valor")), F.col("valor"))
    return found.withColumn("folder", F.regexp_replace(value, r"[/\\]+\z", ""))


def invoice_folder(parameters: DataFrame | None, configured: str | None) -> str | None:
    """Invoice landing folder. With a parameter table only its value counts, else the configured one."""
    if parameters is None:
        value = configured
    else:
        table, name = INVOICE_FOLDER_PARAMETER
        hit = (
            parameters.where((fold_case(F.col("tabla")) == table.lower()) & (fold_case(F.col("parametro")) == name.lower()))
            .agg(F.min("valor").alias("valor"))
            .first()
        )
        value = hit["valor"]
    return value.rstrip("/\\") if value and value.strip() else None

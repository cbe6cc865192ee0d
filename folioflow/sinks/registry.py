"""The guide and invoice tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.functions.text import fold_case
from folioflow.functions.times import moment
from folioflow.operators.guides import superseded
from folioflow.operators.invoices import header_rows, line_rows
from folioflow.operators.skew import keep_first
from folioflow.schemas import GUIDE_SCHEMA, HEADER_SCHEMA, LINE_SCHEMA
from folioflow.sinks.key_index import INDEX_TABLES, KeyIndex
from folioflow.sinks.ledger import partition_name


class GuideRegistry(KeyIndex):
    """Guides plus the marks that void them.

    Voiding adds a row to ``voids`` and rewrites nothing; readers merge the two, and
    :meth:`snapshot` folds the marks in when they have become many.
    """

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(
            spark, root,
            {"guides": f"row_id string, {GUIDE_SCHEMA}", "voids": "row_id string, voided_at timestamp_ntz", **INDEX_TABLES},
        )

    def keys(self) -> DataFrame:
        """Names only, voided guides included; needs no look at the void marks."""
        return self.stored("guides").select("greName")

    def read_rows(self) -> DataFrame:
        voids = self.stored("voids").groupBy("row_id").agg(F.min("voided_at").alias("_at"))
        guides = self.uncontested("guides", fold_case(F.col("greName")), "names").drop("batch_id")
        marked = guides.join(voids, "row_id", "left")
        voided = F.col("_at").isNotNull()
        return marked.withColumns(
            {
                "Auditoria_Deleted": F.col("Auditoria_Deleted") | voided,
                "Auditoria_DeletedAt": F.coalesce("Auditoria_DeletedAt", "_at"),
                "Auditoria_UpdatedAt": F.coalesce("_at", "Auditoria_UpdatedAt"),
            }
        ).drop("_at")

    def read(self) -> DataFrame:
        """The guide table."""
        return self.read_rows().drop("row_id")

    def append(self, batch_id: str, rows: DataFrame, as_of: dt.datetime, seen: int | None = None) -> bool:
        """Add new guides (unique names) and void the active ones of their deliveries, as one batch.

        ``seen`` is the ledger's last number from before the names were checked; of what other writers committed
        since, a guide that both hold stays theirs.
        """
        if self.committed(batch_id):
            return False
        row_id = F.concat(F.lit(f"{partition_name(batch_id)}/"), fold_case(F.col("greName")))
        self.write("guides", batch_id, rows.withColumn("row_id", row_id))
        added = self.written("guides", batch_id)
        self.write_names(batch_id, added.select("greName"))
        voids = superseded(self.read_rows(), added).select("row_id", moment(as_of).alias("voided_at"))
        self.write("voids", batch_id, voids)
        self.commit(batch_id, as_of, seen=seen)
        return True

    def snapshot(self, name: str, as_of: dt.datetime) -> None:
        """Write the merged table to a directory of its own; readers go on from it."""
        self.write("guides", name, self.read_rows())
        self.write_names(name, self.names().select("key"))
        self.write("voids", name, self.spark.createDataFrame([], self.tables["voids"]))
        self.commit(name, as_of, kind="snapshot")


class InvoiceRegistry(KeyIndex):
    """Invoice headers and their lines. Lines are written first; the commit shows both at once."""

    def __init__(self, spark: SparkSession, root: str):
        super().__init__(spark, root, {"lines": LINE_SCHEMA, "headers": HEADER_SCHEMA, **INDEX_TABLES})

    def _headers(self) -> DataFrame:
        return self.uncontested("headers", fold_case(F.col("NameFile")), "names")

    def headers(self) -> DataFrame:
        return self._headers().drop("batch_id")

    def lines(self) -> DataFrame:
        """Lines of the headers that are there. Lines know their invoice by its number only."""
        live = self._live()
        lines = self._rows("lines", live)
        if not live.where(F.coalesce("seen", F.col("sequence") - 1) < F.col("sequence") - 1).isEmpty():
            lines = lines.join(self._headers().select("batch_id", "FacInterno").distinct(), ["batch_id", "FacInterno"], "left_semi")
        return lines.drop("batch_id")

    def add(self, batch_id: str, headers: DataFrame, as_of: dt.datetime) -> bool:
        """Take over headers registered elsewhere, without lines."""
        if self.committed(batch_id):
            return False
        self.write("headers", batch_id, headers)
        self.write_names(batch_id, self.written("headers", batch_id).select("NameFile"))
        self.commit(batch_id, as_of)
        return True

    def append(self, batch_id: str, accepted: DataFrame, as_of: dt.datetime, seen: int | None = None) -> bool:
        """Add accepted documents whose file is neither registered nor twice in the batch (``seen``: as for guides)."""
        if self.committed(batch_id):
            return False
        self.write("lines", batch_id, line_rows(accepted))
        self.write("headers", batch_id, header_rows(accepted))
        self.write_names(batch_id, self.written("headers", batch_id).select("NameFile"))
        self.commit(batch_id, as_of, seen=seen)
        return True


def first_of_each_file(accepted: DataFrame) -> DataFrame:
    """One document per file name (without case): the first by path."""
    return keep_first(
        accepted.withColumn("_file", fold_case(F.col("name_file"))), ["_file"], [F.col("path")]
    ).drop("_file")

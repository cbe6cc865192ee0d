"""PDFs and text records as two streams that meet in the state, whichever lands first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.names import file_name
from folioflow.functions.text import fold_case
from folioflow.operators.guides import with_names
from folioflow.operators.skew import spread_nulls


def matched_records(pdfs: DataFrame, records: DataFrame, within: str = "1 day", lateness: str = "0 seconds") -> DataFrame:
    """Each PDF with the text records that arrive at most ``within`` before or after it.

    Both streams hold ``path`` and ``arrived_at``, records also ``record`` (a struct of whatever is wanted of them).
    A PDF comes out once for every such record, as soon as both are there: a record that lands again
    brings its PDFs again. One without any comes out with a null ``record`` when the watermark, ``lateness`` behind
    the newest arrival of the slower stream, has passed its time. Rows later than that are dropped, so where file
    times say nothing about the order of arrival, ``arrived_at`` is the time the stream saw the file.

    Names are compared without case. Names that give no record name are keys of their own; so no key is hot unless a
    name is. State holds arrivals of about ``2 * within + lateness``.
    """
    key = spread_nulls(fold_case(F.col("companion")), F.col("path"))
    left = with_names(pdfs.withWatermark("arrived_at", lateness)).withColumn("_pdf", key)
    right = records.withWatermark("arrived_at", lateness).select(
        fold_case(file_name(F.col("path"))).alias("_txt"), F.col("arrived_at").alias("_landed"), "record"
    )
    near = F.expr(
        f"_landed >= arrived_at - interval {within} and _landed <= arrived_at + interval {within}"
    )
    return left.join(right, (F.col("_pdf") == F.col("_txt")) & near, "left").drop("_pdf", "_txt", "_landed")

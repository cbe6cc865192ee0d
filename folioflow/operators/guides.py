"""From a PDF and its text record to a row of the guide table."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioflow.functions.names import companion_of_pdf, file_name, guide_key_from_pdf, guide_name, is_companion_name
from folioflow.functions.numbers import loose_timestamp, whole_number
from folioflow.functions.records import attribute, index_records, labelled_value, missing_attributes, missing_labels
from folioflow.functions.text import fold_case, is_blank
from folioflow.functions.times import moment
from folioflow.operators.reconcile import Keys, mark_registered
from folioflow.operators.skew import keep_first, mark_winner, spread_nulls
from folioflow.session import cut_lineage
from folioflow.schemas import (
    ATTRIBUTE_KEYS, DEPARTMENTS, DESCRIPTION_LABELS, ROUTE_DEFAULT, ROUTE_SERIE_T004, ROUTE_THIRD_PARTY,
    THIRD_PARTY_SALE,
)


def with_names(pdfs: DataFrame) -> DataFrame:
    """Add the guide key the PDF name spells and the name of its text record."""
    name = file_name(F.col("path"))
    return pdfs.withColumn("guide_key", guide_key_from_pdf(name)).withColumn("companion", companion_of_pdf(name))


def join_records(pdfs: DataFrame, records: DataFrame) -> DataFrame:
    """Each PDF with its text record, ``text`` null when there is none.

    ``records`` holds ``path`` and ``value`` of non-empty files, each name (without case) once, as
    ``companion_records`` gives them. Malformed PDF names keep out of the join's way.
    """
    texts = records.select(fold_case(file_name(F.col("path"))).alias("_txt"), F.col("value").alias("text"))
    key = spread_nulls(fold_case(F.col("companion")), F.col("path"))
    return pdfs.withColumn("_key", key).join(texts, F.col("_key") == F.col("_txt"), "left").drop("_key", "_txt")


def pdfs_of_arrived_records(records: DataFrame, pdfs: DataFrame) -> DataFrame:
    """All PDFs waiting for the text records that arrived, with the record's name.

    Rows carry the PDF's write time: a record's PDFs are processed oldest first.
    """
    arrived = records.select(file_name(F.col("path")).alias("txt_name")).where(is_companion_name(F.col("txt_name")))
    arrived = keep_first(arrived.withColumn("_txt", fold_case(F.col("txt_name"))), ["_txt"], [F.col("txt_name")])
    waiting = with_names(pdfs).where(F.col("companion").isNotNull()).withColumn("_pdf", fold_case(F.col("companion")))
    return waiting.join(arrived, F.col("_pdf") == F.col("_txt")).drop("_pdf", "_txt")


def read_fields(joined: DataFrame) -> DataFrame:
    """Parse the record text into typed guide columns plus ``parse_errors``; the text itself ends here."""
    parsed = index_records(joined, "text")
    attributes, fields = F.col("attributes"), F.col("fields")
    read = {key: attribute(attributes, key) for key in ATTRIBUTE_KEYS}
    labels = {column: labelled_value(fields, label) for label, column in DESCRIPTION_LABELS.items()}
    flat = parsed.select(
        *(column for column in joined.columns if column != "text"),
        F.col("text").isNotNull().alias("has_record"),
        *(value.alias(key) for key, value in read.items()),
        *(value.alias(column) for column, value in labels.items()),
        F.concat(
            missing_attributes(attributes, ATTRIBUTE_KEYS), missing_labels(fields, list(DESCRIPTION_LABELS))
        ).alias("parse_errors"),
    )
    return flat.withColumns(
        {
            "gre_name": guide_name(F.col("Serie"), F.col("Correlativo")),
            "motive": whole_number(F.col("MotivoTraslado")),
            "city": whole_number(F.left(F.col("DirLlegUbiGeo"), F.lit(2))),
            "transfer_start": loose_timestamp(F.col("FechInicioTraslado")),
        }
    )


def decode_state(df: DataFrame, code: str = "city", out: str = "state_code") -> DataFrame:
    """State code of a department number; a number without a department keeps its digits."""
    codes = df.sparkSession.createDataFrame(DEPARTMENTS, "_code int, department string, _state string")
    return (
        df.join(F.broadcast(codes.select("_code", "_state")), F.col(code) == F.col("_code"), "left")
        .withColumn(out, F.coalesce("_state", F.col(code).cast("string")))
        .drop("_code", "_state")
    )


def route(motive: Column, serie: Column) -> Column:
    """Folder a guide's PDF goes to."""
    return (
        F.when(motive.isNull() | (motive != THIRD_PARTY_SALE), ROUTE_DEFAULT)
        .when(serie == "T004", ROUTE_SERIE_T004)
        .otherwise(ROUTE_THIRD_PARTY)
    )


def judge(guides: DataFrame) -> DataFrame:
    """Add ``status`` and ``reason``: the first rule a guide breaks.

    Needs ``key_registered`` and ``content_registered``. A broken rule skips the file; only a
    PDF name no record name can be made from fails it.
    """
    postal = F.col("DirLlegUbiGeo")
    reason = F.coalesce(
        F.when(F.col("key_registered"), "already_registered"),
        F.when(F.col("companion").isNull(), "bad_file_name"),
        F.when(~F.col("has_record"), "record_missing"),
        F.when(is_blank(F.col("Serie")) | is_blank(F.col("Correlativo")), "serie_or_correlative_missing"),
        F.when(F.col("content_registered"), "already_registered"),
        F.when(F.col("motive").isNull(), "bad_motive"),
        F.when(is_blank(postal) | (F.length(postal) < 2) | F.col("city").isNull(), "bad_postal_code"),
        F.when(F.col("transfer_start").isNull(), "bad_transfer_date"),
    )
    status = F.when(reason.isNull(), "accepted").when(reason == "bad_file_name", "failed").otherwise("skipped")
    return guides.withColumn("reason", reason).withColumn("status", status)


def evaluate(pdfs: DataFrame, records: DataFrame, keys: Keys) -> DataFrame:
    """PDF listing and text records to judged guides, one row per PDF.

    ``keys`` are the registered keys as of the start of the batch (``registered_keys``), or what finds them. The key
    from the file name is checked first, so the text of registered PDFs is never parsed.
    """
    named = mark_registered(with_names(pdfs), F.col("guide_key"), keys).withColumnRenamed(
        "registered", "key_registered"
    )
    wanted = named.withColumn("companion", F.when(~F.col("key_registered"), F.col("companion")))
    joined = join_records(wanted, records).withColumn("companion", named_companion(F.col("path")))
    fields = read_fields(joined)
    if callable(keys):
        # Names are looked up and then joined: the texts are parsed once for both.
        fields = cut_lineage(fields)
    checked = mark_registered(fields, content_key(), keys).withColumnRenamed(
        "registered", "content_registered"
    )
    return decode_state(judge(checked)).withColumn("route", route(F.col("motive"), F.col("Serie")))


def content_key() -> Column:
    """Guide name a record spells, null where it spells none.

    Without a record, as registered PDFs are here, or without its fields all names are the same, and one task would
    get every such row. An earlier rule decides about them.
    """
    named = F.col("has_record") & ~is_blank(F.col("Serie")) & ~is_blank(F.col("Correlativo"))
    return F.when(named, F.col("gre_name"))


def named_companion(path: Column) -> Column:
    return companion_of_pdf(file_name(path))


def first_of_each_guide(accepted: DataFrame, time: str = "effective_time") -> DataFrame:
    """One accepted row per guide name: the oldest file; later copies are already registered."""
    return keep_first(
        accepted.withColumn("_guide", fold_case(F.col("gre_name"))), ["_guide"], [F.col(time), F.col("path")]
    ).drop("_guide")


def supersede_within(accepted: DataFrame, time: str = "effective_time") -> DataFrame:
    """Add ``is_current``: within a batch only the last guide of a delivery stays active.

    An empty delivery is a delivery like any other.
    """
    return mark_winner(accepted, ["delivery"], [F.col(time), F.col("path")], "path", "is_current", last=True)


def superseded(registered: DataFrame, accepted: DataFrame) -> DataFrame:
    """Active registered guides whose delivery is in the new batch."""
    deliveries = accepted.select("delivery").distinct()
    return registered.where(~F.col("Auditoria_Deleted")).join(deliveries, "delivery", "left_semi")


def guide_rows(accepted: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Rows of the guide table for accepted guides marked with ``is_current``."""
    now = moment(as_of)
    voided = ~F.col("is_current")
    none = {
        "statusBee": "string", "substatusBee": "string", "delivered_in_clientBee": "boolean",
        "statusDate": "timestamp_ntz", "estimatedDeliveryDate": "timestamp_ntz",
        "actualDeliveryDate": "timestamp_ntz", "shipmentStatus": "string",
    }
    return accepted.select(
        F.col("gre_name").alias("greName"),
        "ordenCompra", "notaVenta", "delivery", "facturaSAP", "facturaSUNAT",
        F.col("RUCTranspor").alias("rucTranspor"),
        F.col("RazoTrans").alias("razoTrans"),
        F.col("motive").alias("motivoTraslado"),
        F.col("transfer_start").alias("fechaInicioTraslado"),
        now.alias("Auditoria_CreatedAt"),
        now.alias("Auditoria_UpdatedAt"),
        F.when(voided, now).alias("Auditoria_DeletedAt"),
        voided.alias("Auditoria_Deleted"),
        *(F.lit(None).cast(kind).alias(name) for name, kind in none.items()),
        "city",
        F.col("state_code").alias("stateCode"),
        F.col("DirLlegUbiGeo").alias("destinationPostCode"),
        F.lit(None).cast("string").alias("StatusUrbano"),
        F.lit(None).cast("string").alias("SubstatusUrbano"),
    )

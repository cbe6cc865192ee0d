"""Queries on text records and guides, with their SQL counterparts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import synthetic as syn
from folioflow.catalog.listing_queries import sql_time, text_time
from folioflow.functions.names import file_name
from folioflow.functions.records import index_records, labelled_value, missing_attributes, missing_labels, attribute
from folioflow.functions.text import fold_case
from folioflow.functions.times import moment
from folioflow.operators import guides, reconcile
from folioflow.operators.listing import non_empty, with_effective_time
from folioflow.session import cut_lineage
from folioflow.schemas import ATTRIBUTE_KEYS, DESCRIPTION_LABELS

AS_OF = dt.datetime(2002, 1, 1, 8, 0, 0)


def _records(spark: SparkSession, folder: str) -> DataFrame:
    return syn.text_records(syn.orders(spark, folder))


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    orders = syn.orders(spark, folder)
    keys = reconcile.registered_keys(syn.registered_guides(orders), "greName")
    pdfs = with_effective_time(non_empty(syn.pdf_listing(orders)))
    return guides.evaluate(pdfs, non_empty(syn.text_records(orders)), keys)


def _accepted(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """Accepted guides once each. Judged guides are written first, as the job does: later steps use them twice.

    The first of each guide is picked as a whole row, so only the ``columns`` asked for go along; all, if none are.
    """
    accepted = cut_lineage(_judged(spark, folder)).where(F.col("status") == "accepted")
    return guides.first_of_each_guide(accepted.select("gre_name", "effective_time", "path", *columns) if columns else accepted)


def record_attributes(spark: SparkSession, folder: str) -> DataFrame:
    indexed = index_records(_records(spark, folder))
    return indexed.select("record_id", F.explode_outer("entries").alias("e")).where(F.col("e").isNotNull()).select(
        "record_id", "e.key", F.col("e.value").alias("value"), (F.col("e.line_no") + 1).cast("long").alias("line_no")
    )


def record_lookup(spark: SparkSession, folder: str) -> DataFrame:
    indexed = index_records(_records(spark, folder))
    attributes = F.col("attributes")
    return indexed.select(
        "record_id",
        attribute(attributes, "Serie").alias("serie"),
        attribute(attributes, "RUCTranspor").alias("carrier_id"),
        attribute(attributes, "RazoTrans").alias("carrier"),
        attribute(attributes, "Inexistente").alias("absent"),
        F.array_join(missing_attributes(attributes, [*ATTRIBUTE_KEYS, "Inexistente"]), "").alias("errors"),
    )


def record_fields(spark: SparkSession, folder: str) -> DataFrame:
    indexed = index_records(_records(spark, folder))
    exploded = indexed.select("record_id", F.posexplode_outer("fields").alias("position", "piece"))
    return exploded.where(F.col("piece").isNotNull()).withColumn("position", (F.col("position") + 1).cast("long"))


def record_labels(spark: SparkSession, folder: str) -> DataFrame:
    indexed = index_records(_records(spark, folder))
    fields = F.col("fields")
    return indexed.select(
        "record_id",
        *(labelled_value(fields, label).alias(column) for label, column in DESCRIPTION_LABELS.items()),
        labelled_value(fields, "Factura").alias("prefix_only"),
        F.array_join(missing_labels(fields, list(DESCRIPTION_LABELS)), "").alias("errors"),
    )


def guide_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder).select("path", "status", "reason")


def guide_outcome_counts(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder).groupBy("status", "reason").agg(F.count("*").alias("files"))


def guide_run_counters(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.outcome_counters(_judged(spark, folder))


def guide_rows(spark: SparkSession, folder: str) -> DataFrame:
    accepted = _accepted(
        spark, folder, "ordenCompra", "notaVenta", "delivery", "facturaSAP", "facturaSUNAT", "RUCTranspor", "RazoTrans",
        "motive", "transfer_start", "city", "state_code", "DirLlegUbiGeo",
    )
    rows = guides.guide_rows(guides.supersede_within(accepted), AS_OF)
    return rows.select(
        "greName", "ordenCompra", "notaVenta", "delivery", "facturaSAP", "facturaSUNAT", "rucTranspor", "razoTrans",
        F.col("motivoTraslado").cast("long").alias("motivoTraslado"),
        text_time("fechaInicioTraslado").alias("fechaInicioTraslado"),
        F.col("city").cast("long").alias("city"), "stateCode", "destinationPostCode", "Auditoria_Deleted",
        text_time("Auditoria_DeletedAt").alias("Auditoria_DeletedAt"),
    )


def guide_parse_errors(spark: SparkSession, folder: str) -> DataFrame:
    return _accepted(spark, folder, "parse_errors").select("gre_name", F.array_join("parse_errors", "").alias("errors"))


def routed_guides(spark: SparkSession, folder: str) -> DataFrame:
    return _accepted(spark, folder, "route", "length").groupBy("route").agg(
        F.count("*").alias("guides"), F.sum("length").alias("bytes")
    )


def records_arrived(spark: SparkSession, folder: str) -> DataFrame:
    """PDFs waiting for each arrived record, oldest first."""
    orders = syn.orders(spark, folder)
    waiting = guides.pdfs_of_arrived_records(
        non_empty(syn.text_records(orders)), non_empty(syn.pdf_listing(orders))
    )
    return waiting.select(
        "path", fold_case(F.col("txt_name")).alias("txt_name"), text_time("modificationTime").alias("written")
    )


def matched_records(spark: SparkSession, folder: str) -> DataFrame:
    """Which PDFs have their text record."""
    orders = syn.orders(spark, folder)
    joined = guides.join_records(guides.with_names(syn.pdf_listing(orders)), non_empty(syn.text_records(orders)))
    return joined.groupBy(F.col("companion").isNull().alias("bad_name"), F.col("text").isNotNull().alias("found")).agg(
        F.count("*").alias("files")
    )


def registered_check(spark: SparkSession, folder: str) -> DataFrame:
    orders = syn.orders(spark, folder)
    keys = reconcile.registered_keys(syn.registered_guides(orders), "greName")
    marked = reconcile.mark_registered(reconcile.with_guide_keys(syn.pdf_listing(orders)), F.col("guide_key"), keys)
    return marked.select("path", "registered")


def last_of_delivery(spark: SparkSession, folder: str) -> DataFrame:
    marked = guides.supersede_within(_accepted(spark, folder, "delivery"))
    return marked.select("gre_name", "delivery", "is_current")


def superseded_guides(spark: SparkSession, folder: str) -> DataFrame:
    registered = syn.registered_guides(syn.orders(spark, folder))
    return guides.superseded(registered, _accepted(spark, folder, "delivery")).select("greName", "delivery")


def registry_after_batch(spark: SparkSession, folder: str) -> DataFrame:
    """The guide table a batch leaves behind: old rows, some voided now, plus the new ones."""
    accepted = guides.supersede_within(_accepted(spark, folder, "delivery"))
    now = moment(AS_OF)
    registered = syn.registered_guides(syn.orders(spark, folder))
    hit = accepted.select("delivery").distinct().withColumn("hit", F.lit(True))
    old = registered.join(hit, "delivery", "left").select(
        "greName", "delivery",
        (F.col("Auditoria_Deleted") | F.coalesce("hit", F.lit(False))).alias("voided"),
        F.coalesce("Auditoria_DeletedAt", F.when(F.col("hit"), now)).alias("voided_at"),
    )
    new = accepted.select(
        F.col("gre_name").alias("greName"), "delivery", (~F.col("is_current")).alias("voided"),
        F.when(~F.col("is_current"), now).alias("voided_at"),
    )
    both = old.unionByName(new)
    return both.select("greName", "delivery", "voided", text_time("voided_at").alias("voided_at"))


def state_codes(spark: SparkSession, folder: str) -> DataFrame:
    """State code per department number of the customers, known or not."""
    customers = syn.table(spark, folder, "customer").select((F.col("c_custkey") % 30).cast("int").alias("city"))
    return guides.decode_state(customers).groupBy(F.col("city").cast("long").alias("city"), "state_code").agg(
        F.count("*").alias("customers")
    )


QUERIES = {
    f.__name__: f
    for f in (
        record_attributes, record_lookup, record_fields, record_labels, guide_outcomes, guide_outcome_counts,
        guide_run_counters, guide_rows, guide_parse_errors, routed_guides, records_arrived, matched_records,
        registered_check, last_of_delivery, superseded_guides, registry_after_batch, state_codes,
    )
}

_RECORDS = f"{syn.PDF_SQL}, {syn.RECORD_SQL}"


def _attribute(key: str) -> str:
    return f"coalesce(max(a.value) filter (key = '{key}'), '')"


def _missing(keys: list[str]) -> str:
    return " || ".join(
        f"case when count(*) filter (key = '{key}') = 0 then '{key}:Attribute not found  ' else '' end" for key in keys
    )


def _label(label: str) -> str:
    return (
        f"coalesce(arg_min(substr(piece, {len(label) + 2}), position) filter (starts_with(piece, '{label} ')), '')"
    )


def _missing_labels() -> str:
    return " || ".join(
        f"case when count(*) filter (starts_with(piece, '{label} ')) = 0 then '{label}:Description not found  ' else '' end"
        for label in DESCRIPTION_LABELS
    )


_STATE_CODES = (
    "['AM','AN','AP','AR','AY','CA','CL','CU','HV','HU','IC','JU','LL','LA','LI','LO','MD','MO','PA','PI','PU','SM',"
    "'TA','TU','UC']"
)


def _state(code: str) -> str:
    return f"case when {code} between 1 and 25 then {_STATE_CODES}[{code}] else {code}::varchar end"


_GUIDES = f"""{syn.PDF_KEYS_SQL}, {syn.RECORD_SQL}, {syn.REGISTERED_SQL},
keys as (select distinct lower("greName") as key from registered),
found_attributes as (
  select t.record_id, {", ".join(f'{_attribute(key)} as "{key}"' for key in ATTRIBUTE_KEYS)},
    {_missing(ATTRIBUTE_KEYS)} as attribute_errors
  from txt t left join attributes a using (record_id) group by t.record_id
),
found_labels as (
  select t.record_id, {", ".join(f'{_label(label)} as "{column}"' for label, column in DESCRIPTION_LABELS.items())},
    {_missing_labels()} as label_errors
  from txt t left join pieces p using (record_id) group by t.record_id
),
record as (
  select t.record_id, lower(regexp_extract(t.path, '[^/]*$')) as txt_name, a.* exclude (record_id), l.* exclude (record_id)
  from txt t join found_attributes a using (record_id) join found_labels l using (record_id) where t.value <> ''
),
joined as (
  select k.*, r.*, r.record_id is not null as has_record,
    'GR-0' || r."Serie" || '-' || r."Correlativo" as gre_name,
    case when regexp_matches(r."MotivoTraslado", '^[+-]?[0-9]+$') then r."MotivoTraslado"::integer end as motive,
    try_cast(left(r."DirLlegUbiGeo", 2) as integer) as city,
    coalesce(try_strptime(r."FechInicioTraslado", '%Y-%m-%d'), try_strptime(r."FechInicioTraslado", '%-m/%-d/%Y')) as start,
    least(mtime, coalesce(ctime, mtime)) as effective
  from keyed k left join record r on lower(k.companion) = r.txt_name
  where k.length > 0
),
judged as (
  select *, case
    when guide_key is not null and lower(guide_key) in (select key from keys) then 'already_registered'
    when companion is null then 'bad_file_name'
    when not has_record then 'record_missing'
    when "Serie" = '' or "Correlativo" = '' then 'serie_or_correlative_missing'
    when lower(gre_name) in (select key from keys) then 'already_registered'
    when motive is null then 'bad_motive'
    when length("DirLlegUbiGeo") < 2 or city is null then 'bad_postal_code'
    when start is null then 'bad_transfer_date'
    end as reason
  from joined
),
outcome as (
  select *, case when reason is null then 'accepted' when reason = 'bad_file_name' then 'failed' else 'skipped' end as status
  from judged
),
accepted as (
  select *, row_number() over (partition by delivery order by effective desc, path desc) = 1 as is_current,
    case when motive <> 3 then 'dirPDFs' when "Serie" = 'T004' then 'dirHpmps' else 'dirEcommerce' end as route
  from (
    select *, row_number() over (partition by lower(gre_name) order by effective, path) as copy
    from outcome where status = 'accepted'
  ) where copy = 1
)"""

ORACLE = {
    "record_attributes": f"with {_RECORDS} select record_id, key, value, first_line as line_no from attributes",
    "record_lookup": f"""
with {_RECORDS}
select t.record_id, {_attribute('Serie')} as serie, {_attribute('RUCTranspor')} as carrier_id,
  {_attribute('RazoTrans')} as carrier, {_attribute('Inexistente')} as absent,
  {_missing([*ATTRIBUTE_KEYS, 'Inexistente'])} as errors
from txt t left join attributes a using (record_id) group by t.record_id""",
    "record_fields": f"with {_RECORDS} select record_id, position, piece from pieces",
    "record_labels": f"""
with {_RECORDS}
select t.record_id, {", ".join(f'{_label(label)} as "{column}"' for label, column in DESCRIPTION_LABELS.items())},
  {_label('Factura')} as prefix_only, {_missing_labels()} as errors
from txt t left join pieces p using (record_id) group by t.record_id""",
    "guide_outcomes": f"with {_GUIDES} select path, status, reason from outcome",
    "guide_outcome_counts": f"with {_GUIDES} select status, reason, count(*) as files from outcome group by 1, 2",
    "guide_run_counters": f"""
with {_GUIDES}
select count(*) filter (status <> 'failed') as processed, count(*) filter (status = 'failed') as failed from outcome""",
    "guide_rows": f"""
with {_GUIDES}
select gre_name as "greName", "ordenCompra", "notaVenta", delivery, "facturaSAP", "facturaSUNAT",
  "RUCTranspor" as "rucTranspor", "RazoTrans" as "razoTrans", motive::bigint as "motivoTraslado",
  {sql_time('start')} as "fechaInicioTraslado", city::bigint as city, {_state('city')} as "stateCode",
  "DirLlegUbiGeo" as "destinationPostCode", not is_current as "Auditoria_Deleted",
  case when not is_current then '{AS_OF}' end as "Auditoria_DeletedAt"
from accepted""",
    "guide_parse_errors": f"with {_GUIDES} select gre_name, attribute_errors || label_errors as errors from accepted",
    "routed_guides": f"""
with {_GUIDES} select route, count(*) as guides, sum(length)::bigint as bytes from accepted group by 1""",
    "records_arrived": f"""
with {syn.PDF_KEYS_SQL}, {syn.TXT_SQL}
select k.path, t.name as txt_name, {sql_time('k.mtime')} as written
from keyed k join (select lower(regexp_extract(path, '[^/]*$')) as name from txt where value <> '') t
  on lower(k.companion) = t.name
where k.length > 0""",
    "matched_records": f"""
with {syn.PDF_KEYS_SQL}, {syn.TXT_SQL}
select k.companion is null as bad_name, t.name is not null as found, count(*) as files
from keyed k left join (select lower(regexp_extract(path, '[^/]*$')) as name from txt where value <> '') t
  on lower(k.companion) = t.name
group by 1, 2""",
    "registered_check": f"""
with {syn.PDF_KEYS_SQL}, {syn.REGISTERED_SQL}
select path, coalesce(lower(guide_key) in (select lower("greName") from registered), false) as registered from keyed""",
    "last_of_delivery": f"with {_GUIDES} select gre_name, delivery, is_current from accepted",
    "superseded_guides": f"""
with {_GUIDES}
select "greName", delivery from registered where not deleted and delivery in (select delivery from accepted)""",
    "registry_after_batch": f"""
with {_GUIDES}
select "greName", delivery, deleted or delivery in (select delivery from accepted) as voided,
  case when deleted then {sql_time('deleted_at')}
    when delivery in (select delivery from accepted) then '{AS_OF}' end as voided_at
from registered
union all
select gre_name, delivery, not is_current, case when not is_current then '{AS_OF}' end from accepted""",
    "state_codes": f"""
select city, {_state('city')} as state_code, count(*) as customers
from (select c_custkey % 30 as city from customer) group by 1, 2""",
}

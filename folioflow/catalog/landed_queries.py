"""The jobs on real files: the derived documents are written below the shared folder and go through listing,
exact reads, copies and registries. The SQL is that of the operators, on write times, as files have no others."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import guide_queries as gq
from folioflow.catalog import synthetic as syn
from folioflow.catalog.listing_queries import sql_time, text_time
from folioflow.functions.names import companion_of_pdf, file_name
from folioflow.functions.text import fold_case
from folioflow.functions.times import seconds_of
from folioflow.operators import reconcile
from folioflow.operators.listing import non_empty
from folioflow.plans.jobs import DailyRun, Folders, companion_records, register_guides, register_landed_invoices
from folioflow.schemas import GUIDE_SCHEMA, HEADER_SCHEMA
from folioflow.session import scratch_path, settle
from folioflow.sinks.copies import write_files
from folioflow.sinks.registry import GuideRegistry, InvoiceRegistry
from folioflow.sources.contents import read_files, read_texts
from folioflow.sources.landing import PDF_FILES, TXT_FILES, XML_FILES, list_files
from folioflow.streaming import ingest

AS_OF = gq.AS_OF
BEFORE = AS_OF - dt.timedelta(days=1)


def _land(rows: DataFrame, folder: str, content: Column) -> None:
    """A file for each row of a listing, under its own name and write time; a length of zero makes it empty."""
    files = rows.select(
        F.concat(F.lit(f"{folder}/"), file_name(F.col("path"))).alias("target"),
        F.when(F.col("length") > 0, content).alias("content"),
        seconds_of(F.col("modificationTime")).alias("modified"),
    )
    # Only failures are looked at: the outcomes, a digest for each file, need not lie there for the rest of the job.
    failed = settle(lambda: write_files(files).where("error is not null"))
    if not failed.isEmpty():
        raise RuntimeError(f"could not land a file: {failed.first()}")


def _pdf_text() -> Column:
    return F.rpad(file_name(F.col("path")), F.col("length").cast("int"), ".")


def land(spark: SparkSession, folder: str, kinds: tuple[str, ...]) -> Folders:
    """Folders with a file for every order and kind; a kind that isn't asked for has an empty folder."""
    root = scratch_path(spark, "landing")
    orders = syn.orders(spark, folder)
    folders = Folders(*(f"{root}/{name}" for name in ("pdf", "txt", "xml", "routed")))
    made = {"pdf": (syn.pdf_listing(orders), folders.pdf, _pdf_text())}
    made["txt"] = (syn.text_records(orders).withColumn("modificationTime", F.lit("2001-01-01").cast("timestamp_ntz")), folders.txt, F.col("value"))
    # Document and listing are of one row: no join moves the documents.
    documents = syn.invoice_documents(orders, **syn.invoice_file()).where("path is not null")
    made["xml"] = (documents, folders.xml, F.col("value"))
    for kind, (rows, target, content) in made.items():
        _land(rows if kind in kinds else rows.limit(0), target, content)
    return folders


def _filled(rows: DataFrame, schema: str) -> DataFrame:
    """Rows with all columns of a table, null where there is nothing to say."""
    columns = [part.split() for part in schema.split(", ")]
    return rows.select(*((F.col(n) if n in rows.columns else F.lit(None)).cast(kind).alias(n) for n, kind in columns))


def _guide_registry(spark: SparkSession, folder: str) -> GuideRegistry:
    registry = GuideRegistry(spark, scratch_path(spark, "guides"))
    registry.append("before", _filled(syn.registered_guides(syn.orders(spark, folder)), GUIDE_SCHEMA), BEFORE)
    return registry


def _invoice_registry(spark: SparkSession, folder: str) -> InvoiceRegistry:
    registry = InvoiceRegistry(spark, scratch_path(spark, "invoices"))
    registry.add("before", _filled(syn.registered_invoices(syn.orders(spark, folder)), HEADER_SCHEMA), BEFORE)
    return registry


def read_wanted_files(spark: SparkSession, folder: str) -> DataFrame:
    """The text records of PDFs that are not registered: only these files are opened."""
    folders = land(spark, folder, ("pdf", "txt"))
    pdfs = non_empty(list_files(spark, folders.pdf, PDF_FILES))
    pending = reconcile.pending_guides(pdfs, syn.registered_guides(syn.orders(spark, folder)))
    needed = pending.select(fold_case(companion_of_pdf(file_name(F.col("path")))).alias("name")).distinct()
    records = non_empty(list_files(spark, folders.txt, TXT_FILES)).withColumn("name", fold_case(file_name(F.col("path"))))
    found = read_texts(records.join(needed, "name", "left_semi"), "name")
    return found.select("name", F.length("value").cast("long").alias("characters"), F.md5("value").alias("md5"), "error")


def routed_files(spark: SparkSession, folder: str) -> DataFrame:
    """What lies in the folder of each route after a batch: the copies' names, sizes and contents' digests."""
    folders = land(spark, folder, ("pdf", "txt"))
    registry = _guide_registry(spark, folder)
    pdfs = list_files(spark, folders.pdf, PDF_FILES)
    register_guides(registry, pdfs, companion_records(spark, folders.txt, pdfs), AS_OF, "b1", folders)
    listed = list_files(spark, f"{folders.routed}/*", PDF_FILES)
    copies = read_files(listed)
    return copies.select(
        F.element_at(F.split("path", "/"), -2).alias("route"), file_name(F.col("path")).alias("name"),
        F.length("content").cast("long").alias("bytes"), F.md5("content").alias("md5"),
    )


def landed_guides(spark: SparkSession, folder: str) -> DataFrame:
    """The guide registry after a batch of landed files, voided rows marked; the batch runs twice."""
    folders = land(spark, folder, ("pdf", "txt"))
    registry = _guide_registry(spark, folder)
    pdfs = list_files(spark, folders.pdf, PDF_FILES)
    for batch_id in ("b1", "b1", "b2"):
        register_guides(registry, pdfs, companion_records(spark, folders.txt, pdfs), AS_OF, batch_id, folders)
    return registry.read().select(
        "greName", "delivery", F.col("Auditoria_Deleted").alias("voided"), text_time("Auditoria_DeletedAt").alias("voided_at")
    )


def _registered_invoices(registry: InvoiceRegistry) -> DataFrame:
    """Headers with how many lines they have and what these say; headers from before have none."""
    said = F.concat_ws("|", "Cod_Material", "Descripcion", "Cantidad")
    lines = registry.lines().groupBy("FacInterno").agg(F.count("*").alias("lines"), F.array_join(F.sort_array(F.collect_list(said)), ";").alias("said"))
    return registry.headers().join(lines, "FacInterno", "left").select("NameFile", "FacInterno", "lines", "said")


def landed_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """Both invoice tables after landed files went through the job, twice."""
    folders = land(spark, folder, ("xml",))
    registry = _invoice_registry(spark, folder)
    listed = list_files(spark, folders.xml, XML_FILES)
    for batch_id in ("b1", "b2"):
        register_landed_invoices(registry, listed, folders.xml, AS_OF, batch_id)
    return _registered_invoices(registry)


def stream_landed_invoices(spark: SparkSession, folder: str) -> DataFrame:
    """The same through the file stream, in several micro-batches."""
    folders = land(spark, folder, ("xml",))
    registry = _invoice_registry(spark, folder)
    files = -(-syn.orders(spark, folder).count() // 3)
    state = scratch_path(spark, "stream")
    ingest.invoices_from_files(registry, folders, state, lambda: AS_OF, max_files=files).awaitTermination()
    return _registered_invoices(registry)


def daily_run(spark: SparkSession, folder: str) -> DataFrame:
    """Counters of the daily run over both kinds of files."""
    folders = land(spark, folder, ("pdf", "txt", "xml"))
    run = DailyRun(spark, folders, _guide_registry(spark, folder), _invoice_registry(spark, folder))
    return run.run(AS_OF)


def indexed_check(spark: SparkSession, folder: str) -> DataFrame:
    """Which PDFs are registered, asked of a registry's key index."""
    known = _guide_registry(spark, folder).known
    pdfs = reconcile.with_guide_keys(syn.pdf_listing(syn.orders(spark, folder)))
    return reconcile.mark_registered(pdfs, F.col("guide_key"), known).select("path", "registered")


QUERIES = {
    f.__name__: f
    for f in (indexed_check, read_wanted_files, routed_files, landed_guides, landed_invoices, stream_landed_invoices, daily_run)
}

_BY_WRITE_TIME = gq._GUIDES.replace("least(mtime, coalesce(ctime, mtime)) as effective", "mtime as effective")
_LINES = """
lines as (
  select invoice_id, count(*) as lines, list(material || '|' || description || '|' || quantity) as said
  from stock_line group by 1
)"""
_INVOICES = f"""
with {syn.INVOICE_SQL}, {_LINES}
select j.name_file as "NameFile", '99' || invoice_id as "FacInterno", lines, array_to_string(list_sort(said), ';') as said
from judged j join orders r on r.o_orderkey = j.invoice_id join lines using (invoice_id)
where not malformed and not bad_line and r.o_orderstatus <> 'F'
union all
select upper('/01_INV_F113_' || lpad(o_orderkey::varchar, 12, '0') || '.xml'), null, null, null
from orders where o_orderstatus = 'F'"""

ORACLE = {
    "indexed_check": gq.ORACLE["registered_check"],
    "read_wanted_files": f"""
with {syn.PDF_KEYS_SQL}, {syn.TXT_SQL}, {syn.REGISTERED_SQL}
select lower(regexp_extract(path, '[^/]*$')) as name, length(value) as characters, md5(value) as md5, null::varchar as error
from txt where value <> '' and lower(regexp_extract(path, '[^/]*$')) in (
  select lower(companion) from keyed where length > 0 and lower(guide_key) not in (select lower("greName") from registered)
)""",
    "routed_files": f"""
with {_BY_WRITE_TIME}
select route, regexp_extract(path, '[^/]*$') as name, length as bytes,
  md5(rpad(regexp_extract(path, '[^/]*$'), length::integer, '.')) as md5
from accepted""",
    "landed_guides": f"""
with {_BY_WRITE_TIME}
select "greName", delivery, deleted or delivery in (select delivery from accepted) as voided,
  case when deleted then {sql_time('deleted_at')}
    when delivery in (select delivery from accepted) then '{AS_OF}' end as voided_at
from registered
union all
select gre_name, delivery, not is_current, case when not is_current then '{AS_OF}' end from accepted""",
    "landed_invoices": _INVOICES,
    "stream_landed_invoices": _INVOICES,
    "daily_run": f"""
with guide as (
  with {_BY_WRITE_TIME}
  select count(*) filter (lower(guide_key) is null or lower(guide_key) not in (select key from keys)) as pending,
    count(*) filter (status = 'failed') as failed
  from outcome
),
invoice as (
  with {syn.INVOICE_SQL}
  select count(*) as pending, count(*) filter (malformed or bad_line) as failed
  from judged j join orders r on r.o_orderkey = j.invoice_id where r.o_orderstatus <> 'F'
)
select 'guide' as pipeline, pending, pending - failed as processed, failed, null::varchar as error from guide
union all
select 'invoice', pending, pending - failed, failed, null from invoice""",
}

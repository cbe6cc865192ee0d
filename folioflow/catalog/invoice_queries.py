"""Queries on invoices and parameters, with their SQL counterparts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioflow.catalog import synthetic as syn
from folioflow.functions.addresses import recipients as recipient_list
from folioflow.functions.numbers import tolerant_amount
from folioflow.operators import invoices, parameters, reconcile
from folioflow.schemas import HEADER_DEFAULTS, HEADER_SCHEMA
from folioflow.sinks.registry import first_of_each_file

_HEADER_COLUMNS = [part.split()[0] for part in HEADER_SCHEMA.split(", ")]


def _judged(spark: SparkSession, folder: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    documents = syn.invoice_documents(syn.orders(spark, folder)).select("invoice_id", "name_file", "value")
    return invoices.evaluate(documents, fields)


def _accepted(spark: SparkSession, folder: str, fields: tuple[str, ...] | None = None) -> DataFrame:
    return _judged(spark, folder, fields).where(F.col("status") == "accepted")


def invoice_headers(spark: SparkSession, folder: str) -> DataFrame:
    rows = invoices.header_rows(_accepted(spark, folder))
    return rows.select(
        *(
            F.col(c).cast("string").alias(c) if c in ("MontoDetraccion", "PorcentajeDet", "indNotificacion") else F.col(c)
            for c in _HEADER_COLUMNS
        )
    )


def invoice_lines(spark: SparkSession, folder: str) -> DataFrame:
    rows = invoices.line_rows(_accepted(spark, folder, ("FacInterno", "NumPed")), "invoice_id")
    return rows.withColumn("line_no", F.col("line_no").cast("long"))


def invoice_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return _judged(spark, folder, ()).select("invoice_id", "status", "reason")


def invoice_rows_affected(spark: SparkSession, folder: str) -> DataFrame:
    return invoices.rows_affected(_judged(spark, folder, ())).select(
        "invoice_id", F.col("rows_affected").cast("long").alias("rows_affected")
    )


def invoices_to_register(spark: SparkSession, folder: str) -> DataFrame:
    """Idempotent append: valid documents, not registered before, each file name once."""
    orders = syn.orders(spark, folder)
    # The registered check comes first and sees names only: contents of registered files are never read nor parsed, and
    # no document goes through the join's shuffle.
    keys = reconcile.registered_keys(syn.registered_invoices(orders), "NameFile")
    listed = orders.withColumns({"path": F.concat(F.lit("/landing/xml"), syn.invoice_name()), "name_file": syn.invoice_name()})
    unread = reconcile.not_registered(listed, F.col("name_file"), keys).drop("path", "name_file")
    tasks = syn.tasks_of(syn.table(spark, folder, "orders"))
    wanted = syn.invoice_documents(unread.repartition(tasks, "k")).select("path", "name_file", "value")
    accepted = invoices.evaluate(wanted, ()).where(F.col("status") == "accepted")
    counted = accepted.select("path", "name_file", F.size("checked_lines").cast("long").alias("lines"))
    return first_of_each_file(counted).select("name_file", "lines")


def amounts(spark: SparkSession, folder: str) -> DataFrame:
    """Tolerant amounts over line item prices written in several ways."""
    lines = syn.table(spark, folder, "lineitem")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    whole, rest = F.floor(cents / 100).cast("string"), F.lpad((cents % 100).cast("string"), 2, "0")
    written = (
        F.when(F.col("l_linenumber") % 5 == 0, F.concat(whole, F.lit(","), rest))
        .when(F.col("l_linenumber") % 5 == 1, F.concat(F.lit(" "), whole, F.lit("."), rest, F.lit("- ")))
        .when(F.col("l_linenumber") % 5 == 2, F.concat(F.lit("1,"), whole, F.lit("."), rest))
        .when(F.col("l_linenumber") % 5 == 3, F.concat(whole, F.lit("."), rest, F.lit(",0")))
        .otherwise(F.col("l_returnflag"))
    )
    return (
        lines.select("l_linenumber", tolerant_amount(written).alias("amount"))
        .groupBy(F.col("l_linenumber").cast("long").alias("l_linenumber"))
        .agg(F.sum("amount").cast("string").alias("total"), F.count("*").alias("n"))
    )


def parameter_values(spark: SparkSession, folder: str) -> DataFrame:
    """Folder per (segment, nation): the smallest stored value, null where it is blank or missing."""
    customers, nations = syn.table(spark, folder, "customer"), syn.table(spark, folder, "nation")
    stored = customers.select(
        F.col("c_mktsegment").alias("tabla"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("parametro"),
        F.when(F.col("c_custkey") % 4 == 0, " ").otherwise(F.concat(F.lit("/in/"), F.col("c_name"), F.lit("//"))).alias("valor"),
    )
    requests = nations.select(
        F.explode(F.array(*(F.lit(v) for v in ("building", "Machinery", "missing")))).alias("tabla"),
        F.concat(F.lit("p"), F.col("n_nationkey").cast("string")).alias("parametro"),
    )
    found = parameters.with_folder(parameters.lookup(requests, stored))
    return found.select("tabla", "parametro", "valor", "folder")


def recipients(spark: SparkSession, folder: str) -> DataFrame:
    customers = syn.table(spark, folder, "customer")
    key = F.col("c_custkey").cast("string")
    raw = customers.select(
        "c_custkey",
        F.concat(
            F.lit(" b"), key, F.lit("@x.com; A"), key, F.lit("@y.com,,B"), key, F.lit("@X.COM \r\n"),
            F.col("c_mktsegment"), F.lit("@z.com;a"), key, F.lit("@y.com,"),
        ).alias("raw"),
    )
    return raw.select("c_custkey", F.array_join(recipient_list(F.col("raw")), "|").alias("recipients"))


QUERIES = {
    f.__name__: f
    for f in (
        invoice_headers, invoice_lines, invoice_outcomes, invoice_rows_affected, invoices_to_register, amounts,
        parameter_values, recipients,
    )
}


def _tag(tag: str) -> str:
    text = f"regexp_extract(xml, '<ns0:{tag}>(.*?)</ns0:{tag}>', 1)"
    return f"case when trim({text}) = '' then '' else replace({text}, '&amp;', '&') end"


_AMOUNT = "['1.50', '1234567.89', '0.00', '0.00', '12.35', '0.00'][(invoice_id % 6)::integer + 1]"
_PERCENT = "['2.00', '-3.00', '-4.00'][(invoice_id % 3)::integer + 1]"
_TEXT_TAGS = {
    "TipDoc": "documentType", "Serie": "docNumber", "Numero": "sequentilaNumber", "Cod_SAP": "billToNumber",
    "CodVen": "salesMan", "Ruc": "customerTVAT", "Cliente": "billToName", "Moneda": "currencyCode",
    "NumPed": "orderNumber", "FacInterno": "SAPBillingDocumentNumber", "Monto": "totalTaxValue",
    "ConPag": "paymentMethod", "Contacto": "soldToEmailId", "paymentIssueTime": "paymentIssueTime",
    "orderReason": "salesOrderReason", "customerOrderNumber": "customerOrderNumber",
}

ORACLE = {
    "invoice_headers": f"""
with {syn.INVOICE_SQL}
select name_file as "NameFile", {", ".join(f'{_tag(tag)} as "{column}"' for column, tag in _TEXT_TAGS.items())},
  replace({_tag('invoiceDate')}, '-', '') as "Fecha", replace({_tag('paymentDueDate')}, '-', '') as "FecVenci",
  case when invoice_id % 4 in (1, 2) then {_tag('referenceDocNumber')} else '' end as "referenceDocNumber",
  {_AMOUNT} as "MontoDetraccion", {_PERCENT} as "PorcentajeDet",
  {", ".join(f"'{value}' as " + f'"{column}"' for column, value in HEADER_DEFAULTS.items())}
from judged where not malformed and not bad_line""",
    "invoice_lines": f"""
with {syn.INVOICE_SQL}
select '99' || invoice_id as "FacInterno", '71' || invoice_id as "NumPed", invoice_id, line_no, material as "Cod_Material",
  description as "Descripcion", quantity as "Cantidad"
from stock_line join (select invoice_id from judged where not bad_line) using (invoice_id)""",
    "invoice_outcomes": f"""
with {syn.INVOICE_SQL}
select invoice_id, case when malformed or bad_line then 'failed' else 'accepted' end as status,
  case when malformed then 'malformed_xml' when bad_line then 'bad_line' end as reason from judged""",
    "invoice_rows_affected": f"""
with {syn.INVOICE_SQL}
select invoice_id, case when malformed or bad_line then 0 else 1 + n_lines end as rows_affected from judged""",
    "invoices_to_register": f"""
with {syn.INVOICE_SQL}
select j.name_file, j.n_lines as lines from judged j join orders r on r.o_orderkey = j.invoice_id
where not malformed and not bad_line and r.o_orderstatus <> 'F'""",
    "amounts": """
with written as (
  select l_linenumber, cents, (cents // 100)::varchar as whole, lpad((cents % 100)::varchar, 2, '0') as rest
  from (select l_linenumber, round(l_extendedprice * 100)::bigint as cents from lineitem)
)
select l_linenumber::bigint as l_linenumber,
  sum(case l_linenumber % 5 when 0 then cents when 1 then -cents when 2 then ('1' || whole || rest)::bigint else 0 end
    ::decimal(18,0) * 0.01::decimal(3,2))::decimal(38,2)::varchar as total,
  count(*) as n
from written group by 1""",
    "parameter_values": """
with stored as (
  select lower(c_mktsegment) as tabla, 'p' || c_nationkey as parametro,
    case when c_custkey % 4 = 0 then ' ' else '/in/' || c_name || '//' end as valor from customer
),
requests as (
  select unnest(['building', 'Machinery', 'missing']) as tabla, 'p' || n_nationkey as parametro from nation
),
found as (
  select r.*, (select min(valor) from stored s where s.tabla = lower(r.tabla) and s.parametro = r.parametro) as valor
  from requests r
)
select tabla, parametro, valor,
  case when coalesce(trim(valor), '') <> '' then rtrim(valor, '/') end as folder from found""",
    "recipients": """
select c_custkey, 'b' || c_custkey || '@x.com|A' || c_custkey || '@y.com|' || c_mktsegment || '@z.com' as recipients
from customer""",
}

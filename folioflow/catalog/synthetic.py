"""Documents derived from the given tables, in Spark and, for the oracle, in SQL.

The tables hold no guides or invoices. Every order therefore becomes a PDF with its text record
and an invoice file, with broken and unusual variants spread over all orders; orders with status
F count as registered. ``number`` is the guide number: some orders are copies of an earlier one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

XML_ROOT = "/LANDING/xml/"

#: Rows of a table that a task makes documents of.
TASK_ROWS = 50_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _digits(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


def _every(key: Column, n: int) -> Column:
    return key % n == 0


def _plus(ts: Column, seconds: Column, days: Column | None = None) -> Column:
    moved = F.timestamp_add("SECOND", seconds, ts)
    return moved if days is None else F.timestamp_add("DAY", days, moved)


def _serie(number: Column) -> Column:
    return F.element_at(F.array(F.lit("T001"), F.lit("T002"), F.lit("T004")), (number % 3 + 1).cast("int"))


def tasks_of(df: DataFrame) -> int:
    """At least one task a core, and so many that none makes more than ``TASK_ROWS`` documents."""
    return max(df.sparkSession.sparkContext.defaultParallelism, -(-df.count() // TASK_ROWS))


def spread(df: DataFrame, key: str) -> DataFrame:
    """A table over all cores, and over so many tasks that none makes more than ``TASK_ROWS`` documents.

    A row is a few bytes and the document made of it thousands, so the splits that a table is read in say little
    about the work. One with enough partitions stays as it is read.
    """
    tasks = tasks_of(df)
    return df if df.rdd.getNumPartitions() >= tasks else df.repartition(tasks, key)


def orders(spark: SparkSession, folder: str) -> DataFrame:
    k = F.col("o_orderkey")
    return spread(table(spark, folder, "orders"), "o_orderkey").withColumn("k", k).withColumn(
        "number", F.when((k % 20 == 3), k - 3).otherwise(k)
    )


def pdf_listing(orders: DataFrame) -> DataFrame:
    k, n = F.col("k"), F.col("number")
    issuer = F.concat(F.lit("20"), _digits(n % 97, 9))
    name = F.when(_every(k, 53), F.concat(issuer, F.lit("-09-"), _serie(n), F.lit(".pdf"))).otherwise(
        F.concat(
            issuer, F.lit("-09-"), _serie(n), F.lit("-0"), _digits(n, 7), F.lit("-"), k.cast("string"), F.lit(".pdf")
        )
    )
    return orders.select(
        F.concat(F.lit("/landing/pdf/"), F.when(_every(k, 53), F.concat(k.cast("string"), F.lit("_"))).otherwise(""), name).alias("path"),
        _plus(F.col("o_orderdate"), k % 86400).alias("modificationTime"),
        F.when(~_every(k, 11), _plus(F.col("o_orderdate"), k * 7 % 86400, -(k % 3))).alias("creation_time"),
        F.when(_every(k, 101), 0).otherwise(1000 + k % 5000).cast("long").alias("length"),
    )


PDF_SQL = """
o as (
  select *, o_orderkey as k, case when o_orderkey % 20 = 3 then o_orderkey - 3 else o_orderkey end as number
  from orders
),
pdf as (
  select
    '/landing/pdf/' || case when k % 53 = 0
      then k::varchar || '_20' || lpad((number % 97)::varchar, 9, '0') || '-09-' || serie || '.pdf'
      else '20' || lpad((number % 97)::varchar, 9, '0') || '-09-' || serie || '-0' || lpad(number::varchar, 7, '0')
        || '-' || k::varchar || '.pdf' end as path,
    o_orderdate + to_seconds(k % 86400) as mtime,
    case when k % 11 <> 0 then o_orderdate + to_seconds(k * 7 % 86400) - to_days((k % 3)::integer) end as ctime,
    case when k % 101 = 0 then 0 else 1000 + k % 5000 end as length
  from (select *, ['T001', 'T002', 'T004'][(number % 3)::integer + 1] as serie from o)
)"""

# File name, its parts and the keys it spells; expects "pdf".
PDF_KEYS_SQL = PDF_SQL + """,
named as (
  select *, string_split(regexp_extract(path, '[^/]*$'), '-') as p from pdf
),
keyed as (
  select *,
    case when len(p) >= 4 and length(p[4]) >= 8 then 'GR-0' || p[3] || '-' || substr(p[4], 2, 7) end as guide_key,
    case when len(p) >= 4 and length(p[4]) >= 8
      then p[1] || '-' || p[3] || '-' || substr(p[4], 2, 7) || '.txt' end as companion
  from named
)"""


def registered_guides(orders: DataFrame) -> DataFrame:
    """Guides registered before: orders with status F, the names in mixed case."""
    k = F.col("k")
    name = F.concat(F.lit("GR-0"), _serie(k), F.lit("-"), _digits(k, 7))
    return orders.where(F.col("o_orderstatus") == "F").select(
        F.when(_every(k, 2), F.lower(name)).otherwise(name).alias("greName"),
        delivery(F.col("o_custkey")).alias("delivery"),
        _every(k, 5).alias("Auditoria_Deleted"),
        F.when(_every(k, 5), F.col("o_orderdate")).alias("Auditoria_DeletedAt"),
    )


REGISTERED_SQL = """
registered as (
  select case when k % 2 = 0 then lower(name) else name end as "greName", delivery, k % 5 = 0 as deleted,
    case when k % 5 = 0 then o_orderdate end as deleted_at
  from (
    select *, 'GR-0' || ['T001', 'T002', 'T004'][(k % 3)::integer + 1] || '-' || lpad(k::varchar, 7, '0') as name,
      case when o_custkey % 10 = 0 then '' else '81' || lpad(o_custkey::varchar, 8, '0') end as delivery
    from o where o_orderstatus = 'F'
  )
)"""


def delivery(customer: Column) -> Column:
    return F.when(_every(customer, 10), "").otherwise(F.concat(F.lit("81"), _digits(customer, 8)))


def text_records(orders: DataFrame) -> DataFrame:
    """One text record per order: ``path, length, value``; some are empty, some broken."""
    k, customer = F.col("k"), F.col("o_custkey")
    number = F.when(_every(k, 23), k + 60).otherwise(k)
    date = F.when(_every(k, 79), "soon").when(
        _every(k, 2), F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "M/d/yyyy"))
    motive = F.when(_every(k, 67), "X").otherwise(
        F.element_at(F.array(F.lit("01"), F.lit("03"), F.lit("3"), F.lit("04"), F.lit("99")), (k % 5 + 1).cast("int"))
    )
    postal = F.when(_every(k, 71), "XX0101").when(_every(k, 73), "7").otherwise(
        F.concat(_digits(customer % 30, 2), F.lit("0101"))
    )
    shipped = F.when(~_every(customer, 10), F.concat(F.lit("Documento Despacho 81"), _digits(customer, 8)))
    fields = F.concat_ws(
        "  |  ",
        F.concat(F.lit("E;DescripcionAdicsunat;1;"), _serie(k), F.lit("-"), _digits(k, 7)),
        F.concat(F.lit("Orden de Compra Cliente 32"), _digits(k * 31 % 10**8, 8)),
        F.when(~_every(k, 9), F.concat(F.lit("Nota de Venta SAP 71"), k.cast("string"))),
        shipped,
        F.concat(F.lit("Factura Sistema 99"), k.cast("string")),
        F.lit("Turno B"), F.lit(" Muelle 12 "),
        F.concat(F.lit("Documento Ref F113-"), _digits(k, 7)),
    )
    lines = F.array_compact(
        F.array(
            F.concat(F.lit("A;Serie;1;"), F.when(_every(k, 61), " ").otherwise(_serie(k))),
            F.concat(F.lit("A;Correlativo;1;"), _digits(number, 7)),
            F.lit("A;RznSocEmis;1;NORTHERN; S.A.C. "),
            F.lit(""),
            F.lit("A;Serie;2;REPEATED"),
            F.lit("X;SerieAnterior;1;T999"),
            F.lit("NOKEY"), F.lit("B;;1;EMPTY KEY"), F.lit("B;SinValor"),
            F.concat(F.lit("G;MotivoTraslado;1;"), motive),
            F.concat(F.lit("G;DirLlegUbiGeo;1;"), postal),
            F.concat(F.lit("G1;FechInicioTraslado;1;"), date),
            F.concat(F.lit("G1;RUCTranspor;1; 205"), _digits(customer, 8)),
            F.when(~_every(k, 7), F.concat(F.lit("G1;RazoTrans;1;\tCARRIER "), customer.cast("string"), F.lit(" "))),
            fields,
            F.lit("E;DescripcionAdicsunat;2;Orden de Compra Cliente IGNORED  |  Factura Sistema IGNORED"),
        )
    )
    name = F.concat(F.lit("20"), _digits(k % 97, 9), F.lit("-"), _serie(k), F.lit("-"), _digits(k, 7), F.lit(".txt"))
    return orders.select(
        k.alias("record_id"),
        F.concat(F.lit("/landing/txt/"), F.when(_every(k, 17), F.upper(name)).otherwise(name)).alias("path"),
        # Zero or not is all anyone asks of the length.
        F.when(_every(k, 13), 0).otherwise(1).alias("length"),
        F.when(_every(k, 13), "").otherwise(F.concat_ws("\r\n", lines)).alias("value"),
    )


TXT_SQL = """
txt as (
  select k as record_id,
    '/landing/txt/' || case when k % 17 = 0 then upper(name) else name end as path,
    case when k % 13 = 0 then '' else array_to_string(list_filter([
      'A;Serie;1;' || case when k % 61 = 0 then ' ' else serie end,
      'A;Correlativo;1;' || lpad((case when k % 23 = 0 then k + 60 else k end)::varchar, 7, '0'),
      'A;RznSocEmis;1;NORTHERN; S.A.C. ',
      '',
      'A;Serie;2;REPEATED',
      'X;SerieAnterior;1;T999',
      'NOKEY', 'B;;1;EMPTY KEY', 'B;SinValor',
      'G;MotivoTraslado;1;' || case when k % 67 = 0 then 'X'
        else ['01', '03', '3', '04', '99'][(k % 5)::integer + 1] end,
      'G;DirLlegUbiGeo;1;' || case when k % 71 = 0 then 'XX0101' when k % 73 = 0 then '7'
        else lpad((o_custkey % 30)::varchar, 2, '0') || '0101' end,
      'G1;FechInicioTraslado;1;' || case when k % 79 = 0 then 'soon'
        when k % 2 = 0 then strftime(o_orderdate, '%Y-%m-%d') else strftime(o_orderdate, '%-m/%-d/%Y') end,
      'G1;RUCTranspor;1; 205' || lpad(o_custkey::varchar, 8, '0'),
      case when k % 7 <> 0 then 'G1;RazoTrans;1;' || chr(9) || 'CARRIER ' || o_custkey::varchar || ' ' end,
      array_to_string(list_filter([
        'E;DescripcionAdicsunat;1;' || serie || '-' || lpad(k::varchar, 7, '0'),
        'Orden de Compra Cliente 32' || lpad((k * 31 % 100000000)::varchar, 8, '0'),
        case when k % 9 <> 0 then 'Nota de Venta SAP 71' || k::varchar end,
        case when o_custkey % 10 <> 0 then 'Documento Despacho 81' || lpad(o_custkey::varchar, 8, '0') end,
        'Factura Sistema 99' || k::varchar,
        'Turno B', ' Muelle 12 ',
        'Documento Ref F113-' || lpad(k::varchar, 7, '0')
      ], lambda x: x is not null), '  |  '),
      'E;DescripcionAdicsunat;2;Orden de Compra Cliente IGNORED  |  Factura Sistema IGNORED'
    ], lambda x: x is not null), chr(13) || chr(10)) end as value
  from (
    select *, '20' || lpad((k % 97)::varchar, 9, '0') || '-' || serie || '-' || lpad(k::varchar, 7, '0') || '.txt' as name
    from (select *, ['T001', 'T002', 'T004'][(k % 3)::integer + 1] as serie from o)
  )
)"""

# Attributes (first line of a key wins) and description pieces of every record; expects "txt".
RECORD_SQL = TXT_SQL + r""",
raw_lines as (
  select record_id, unnest(string_split(value, chr(13) || chr(10))) as line,
    generate_subscripts(string_split(value, chr(13) || chr(10)), 1) as line_no
  from txt
),
columns_of as (
  select record_id, line_no, line, string_split(line, ';') as c from raw_lines
),
attributes as (
  select record_id, key, first_line, value from (
    select record_id, c[2] as key, line_no as first_line,
      case when len(c) >= 4 then regexp_replace(array_to_string(c[4:], ';'), '^\s+|\s+$', '', 'g') else '' end as value,
      row_number() over (partition by record_id, c[2] order by line_no) as occurrence
    from columns_of where len(c) >= 2 and c[2] <> ''
  ) where occurrence = 1
),
description as (
  select record_id, arg_min(line, line_no) as line from raw_lines
  where contains(line, 'DescripcionAdicsunat') group by record_id
),
pieces as (
  select record_id, piece, row_number() over (partition by record_id order by position) as position from (
    select record_id, regexp_replace(unnest(string_split(line, '|')), '^\s+|\s+$', '', 'g') as piece,
      generate_subscripts(string_split(line, '|'), 1) as position
    from description
  ) where piece <> ''
)"""


def invoice_file() -> dict[str, Column]:
    """What the listing says of an order's invoice besides its path."""
    k = F.col("k")
    return {
        "modificationTime": _plus(F.col("o_orderdate"), k * 3 % 86400),
        "creation_time": _plus(F.col("o_orderdate"), k * 5 % 86400),
        "length": 500 + k % 900,
    }


def invoice_name() -> Column:
    return F.concat(F.lit("/01_INV_F113_"), _digits(F.col("k"), 12), F.lit(".xml"))


def invoice_listing(orders: DataFrame) -> DataFrame:
    path = F.concat(F.lit("/landing/xml/01_INV_F113_"), _digits(F.col("k"), 12), F.lit(".xml"))
    return orders.select(path.alias("path"), *(value.alias(name) for name, value in invoice_file().items()))


def registered_invoices(orders: DataFrame) -> DataFrame:
    """Invoice files registered before: orders with status F, names in upper case."""
    name = F.concat(F.lit("/01_INV_F113_"), _digits(F.col("k"), 12), F.lit(".xml"))
    return orders.where(F.col("o_orderstatus") == "F").select(F.upper(name).alias("NameFile"))


INVOICE_LISTING_SQL = """
xml_files as (
  select k, '/landing/xml/01_INV_F113_' || lpad(k::varchar, 12, '0') || '.xml' as path,
    o_orderdate + to_seconds(k * 3 % 86400) as mtime, o_orderdate + to_seconds(k * 5 % 86400) as ctime,
    o_orderstatus = 'F' as registered
  from o
)"""


def invoice_documents(orders: DataFrame, **more: Column) -> DataFrame:
    """One invoice XML per order: ``path, name_file, value``, and ``more``; some malformed, some with bad lines."""
    k, customer = F.col("k"), F.col("o_custkey")

    def tag(name: str, *text: Column | str) -> Column:
        body = F.concat(*(F.lit(t) if isinstance(t, str) else t for t in text))
        return F.concat(F.lit(f"<ns0:{name}>"), body, F.lit(f"</ns0:{name}>"))

    def pick(values: list[str], key: Column) -> Column:
        return F.element_at(F.array(*(F.lit(v) for v in values)), (key % len(values) + 1).cast("int"))

    day = F.date_format("o_orderdate", "yyyy-MM-dd")

    def line(i: int) -> Column:
        return F.concat(
            F.lit("<ns0:line><ns0:stocKLine>"),
            tag("partNumber", F.when(_every(k, 83) & F.lit(i == 1), "ABC").otherwise(_digits(k * 31 % 2_000_000_000 + i, 18))),
            tag("itemDescription", f"ITEM {i} &lt;ñ&gt;"),
            F.when(_every(k, 89) & F.lit(i == 0), "").otherwise(
                tag("quantity", pick(["1.000", "1,000.50", " 7 ", "1.5e2", "5-"], k + i))
            ),
            F.lit("</ns0:stocKLine></ns0:line>"),
        )

    # One to four lines, written out: a lambda over a sequence would be interpreted row by row.
    lines = F.concat(line(0), *(F.when(k % 4 >= i, line(i)).otherwise("") for i in (1, 2, 3)))
    text = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<ns0:Invoice xmlns:ns0="urn:invoice">\n<ns0:invoiceDetail>'),
        tag("invoiceDate", day), tag("paymentIssueTime", "17:05:00"), F.lit("<ns0:salesOrderReason/>"),
        tag("documentType", pick(["01", "07", "08", "03"], k)), tag("docNumber", "F113"),
        F.when(_every(k, 6), tag("sequentialNumber", _digits(k, 8))).otherwise(tag("sequentilaNumber", _digits(k, 8))),
        tag("paymentDueDate", day), tag("referenceDocNumber", "REF-", k.cast("string")),
        F.lit("<ns0:billToDetails>\n  "), tag("customerTVAT", "20", _digits(customer, 9)),
        tag("billToName", "A &amp; B ", customer.cast("string")), tag("billToNumber", customer.cast("string")),
        F.lit("\n</ns0:billToDetails>"),
        tag("orderNumber", "71", k.cast("string")), tag("customerOrderNumber", "32", k.cast("string")),
        tag("SAPBillingDocumentNumber", "99", k.cast("string")),
        tag("paymentMethod", F.when(_every(k, 5), " ").otherwise("30 días")),
        tag("salesMan", (k % 100).cast("string")),
        F.when(_every(k, 3), "").otherwise(tag("soldToEmailId", "c", customer.cast("string"), "@example.com")),
        tag("currencyCode", "PEN"), tag("currencyCode", "USD"),
        tag("totalTaxValue", (k % 1000).cast("string"), ".08"),
        tag("MontoDetraccion", pick(["1,5", "1,234,567.89", "abc", "", "12.345", "1.234,56"], k)),
        tag("PorcentajeDet", pick(["2,0", "-3", "4-"], k)),
        lines,
        F.when(_every(k, 97), "</ns0:broken>").otherwise("</ns0:invoiceDetail>"), F.lit("\n</ns0:Invoice>"),
    )
    name = invoice_name()
    return orders.select(
        k.alias("invoice_id"), F.concat(F.lit("/landing/xml"), name).alias("path"), name.alias("name_file"),
        text.alias("value"), *(column.alias(name) for name, column in more.items()),
    )


# The same documents in SQL, cut up with regular expressions.
INVOICE_SQL = r"""
o as (select *, o_orderkey as k from orders),
invoice as (
  select k as invoice_id, '/01_INV_F113_' || lpad(k::varchar, 12, '0') || '.xml' as name_file,
    '<ns0:invoiceDetail><ns0:invoiceDate>' || strftime(o_orderdate, '%Y-%m-%d') || '</ns0:invoiceDate>'
    || '<ns0:paymentIssueTime>17:05:00</ns0:paymentIssueTime><ns0:salesOrderReason/>'
    || '<ns0:documentType>' || ['01', '07', '08', '03'][(k % 4)::integer + 1] || '</ns0:documentType>'
    || '<ns0:docNumber>F113</ns0:docNumber>'
    || case when k % 6 = 0 then '<ns0:sequentialNumber>' || lpad(k::varchar, 8, '0') || '</ns0:sequentialNumber>'
       else '<ns0:sequentilaNumber>' || lpad(k::varchar, 8, '0') || '</ns0:sequentilaNumber>' end
    || '<ns0:paymentDueDate>' || strftime(o_orderdate, '%Y-%m-%d') || '</ns0:paymentDueDate>'
    || '<ns0:referenceDocNumber>REF-' || k::varchar || '</ns0:referenceDocNumber>'
    || '<ns0:customerTVAT>20' || lpad(o_custkey::varchar, 9, '0') || '</ns0:customerTVAT>'
    || '<ns0:billToName>A &amp; B ' || o_custkey::varchar || '</ns0:billToName>'
    || '<ns0:billToNumber>' || o_custkey::varchar || '</ns0:billToNumber>'
    || '<ns0:orderNumber>71' || k::varchar || '</ns0:orderNumber>'
    || '<ns0:customerOrderNumber>32' || k::varchar || '</ns0:customerOrderNumber>'
    || '<ns0:SAPBillingDocumentNumber>99' || k::varchar || '</ns0:SAPBillingDocumentNumber>'
    || '<ns0:paymentMethod>' || case when k % 5 = 0 then ' ' else '30 días' end || '</ns0:paymentMethod>'
    || '<ns0:salesMan>' || (k % 100)::varchar || '</ns0:salesMan>'
    || case when k % 3 = 0 then '' else '<ns0:soldToEmailId>c' || o_custkey::varchar || '@example.com</ns0:soldToEmailId>' end
    || '<ns0:currencyCode>PEN</ns0:currencyCode><ns0:currencyCode>USD</ns0:currencyCode>'
    || '<ns0:totalTaxValue>' || (k % 1000)::varchar || '.08</ns0:totalTaxValue>'
    || '<ns0:MontoDetraccion>' || ['1,5', '1,234,567.89', 'abc', '', '12.345', '1.234,56'][(k % 6)::integer + 1] || '</ns0:MontoDetraccion>'
    || '<ns0:PorcentajeDet>' || ['2,0', '-3', '4-'][(k % 3)::integer + 1] || '</ns0:PorcentajeDet>'
    || array_to_string(list_transform(range(0, k % 4 + 1), lambda i:
      '<ns0:line><ns0:stocKLine><ns0:partNumber>'
      || case when k % 83 = 0 and i = 1 then 'ABC' else lpad((k * 31 % 2000000000 + i)::varchar, 18, '0') end
      || '</ns0:partNumber><ns0:itemDescription>ITEM ' || i::varchar || ' &lt;ñ&gt;</ns0:itemDescription>'
      || case when k % 89 = 0 and i = 0 then ''
         else '<ns0:quantity>' || ['1.000', '1,000.50', ' 7 ', '1.5e2', '5-'][((k + i) % 5)::integer + 1] || '</ns0:quantity>' end
      || '</ns0:stocKLine></ns0:line>'), '') as xml,
    k % 97 = 0 as malformed
  from o
),
raw_line as (
  select invoice_id, unnest(regexp_extract_all(xml, '<ns0:stocKLine>(.*?)</ns0:stocKLine>', 1)) as stock,
    generate_subscripts(regexp_extract_all(xml, '<ns0:stocKLine>(.*?)</ns0:stocKLine>', 1), 1) - 1 as line_no
  from invoice where not malformed
),
stock_line as (
  select invoice_id, line_no,
    try_cast(regexp_extract(stock, '<ns0:partNumber>(.*?)</', 1) as integer)::varchar as material,
    replace(replace(regexp_extract(stock, '<ns0:itemDescription>(.*?)</', 1), '&lt;', '<'), '&gt;', '>') as description,
    case trim(regexp_extract(stock, '<ns0:quantity>(.*?)</', 1))
      when '1.000' then '1.000' when '1,000.50' then '1000.50' when '7' then '7' when '1.5e2' then '150'
      when '5-' then '-5' end as quantity
  from raw_line
),
judged as (
  select i.*, coalesce(l.bad, false) as bad_line, coalesce(l.n, 0) as n_lines
  from invoice i left join (
    select invoice_id, bool_or(material is null or quantity is null) as bad, count(*) as n from stock_line group by 1
  ) l using (invoice_id)
)"""


def error_events(events: DataFrame) -> DataFrame:
    """Log events from the event stream: one channel per event type, level and category from the value."""
    cents = F.round(F.col("value") * 100).cast("long")
    levels = F.array(*(F.lit(v) for v in ["Information", "Warning", "Error", "Error", "Critical"]))
    return events.select(
        F.col("event_type").alias("channel"),
        F.when(_every(cents, 11), F.concat(F.lit("Alerts.Mail."), F.col("event_type")))
        .otherwise(F.concat(F.lit("Intake.Worker"), (cents % 7).cast("string")))
        .alias("category"),
        F.element_at(levels, (cents % 5 + 1).cast("int")).alias("level"),
        F.col("props").alias("message"),
        "ts", "event_id",
    )


OWN_CATEGORY = "Alerts.Mail"

EVENT_SQL = """
log as (
  select event_type as channel, event_id, ts, props as message,
    case when cents % 11 = 0 then 'Alerts.Mail.' || event_type else 'Intake.Worker' || (cents % 7)::varchar end as category,
    ['Information', 'Warning', 'Error', 'Error', 'Critical'][(cents % 5)::integer + 1] as level
  from (select *, round(value * 100)::bigint as cents from events)
),
alert as (
  select *, epoch_us(ts) // 1000000 as second from log
  where level in ('Error', 'Critical') and not starts_with(category, 'Alerts.Mail')
)"""


def attempts(events: DataFrame) -> DataFrame:
    """Processing attempts from the event stream: one file per user, some types of event are failures."""
    path = F.concat(F.lit("/landing/xml/user_"), F.col("user_id").cast("string"), F.lit(".xml"))
    return events.select(
        F.when(_every(F.col("event_id"), 2), F.upper(path)).otherwise(path).alias("path"),
        "ts",
        F.col("event_id").alias("attempt_id"),
        (F.col("event_type") == "signup").alias("success"),
        F.concat(F.lit("failed on "), F.col("event_type")).alias("error"),
    )


def activity(events: DataFrame) -> DataFrame:
    """Watched files from the event stream: a source per event type, purchases still pending."""
    source = F.when(_every(F.col("user_id"), 2), F.upper("event_type")).otherwise(F.col("event_type"))
    return events.select(
        source.alias("source"),
        F.concat(F.lit("/landing/f"), (F.col("event_id") % 5000).cast("string")).alias("path"),
        F.col("ts").alias("arrived_at"),
        F.when(F.col("value") < 25, F.timestamp_add("SECOND", F.col("user_id") * 60, F.col("ts"))).alias("processed_at"),
        (F.col("event_type") != "view").alias("active"),
    )

"""Table layouts and code tables that other systems read: names and values are fixed."""

from __future__ import annotations

# Fixed column names and types of the registered-guide table (identity column left out).
GUIDE_SCHEMA = (
    "greName string, ordenCompra string, notaVenta string, delivery string, facturaSAP string, "
    "facturaSUNAT string, rucTranspor string, razoTrans string, motivoTraslado int, "
    "fechaInicioTraslado timestamp_ntz, Auditoria_CreatedAt timestamp_ntz, "
    "Auditoria_UpdatedAt timestamp_ntz, Auditoria_DeletedAt timestamp_ntz, Auditoria_Deleted boolean, "
    "statusBee string, substatusBee string, delivered_in_clientBee boolean, statusDate timestamp_ntz, "
    "estimatedDeliveryDate timestamp_ntz, actualDeliveryDate timestamp_ntz, shipmentStatus string, "
    "city int, stateCode string, destinationPostCode string, StatusUrbano string, SubstatusUrbano string"
)

# Fixed column names and types of the invoice header table (identity column left out).
HEADER_SCHEMA = (
    "NameFile string, TipDoc string, Serie string, Numero string, Fecha string, Cod_SAP string, "
    "CodVen string, Ruc string, Cliente string, Moneda string, NumPed string, FacInterno string, "
    "Monto string, FecVenci string, ConPag string, Contacto string, Sunat string, Estado string, "
    "EstCobranza string, Deli string, Situacion string, indNotificacion int, paymentIssueTime string, "
    "referenceDocNumber string, orderReason string, MontoDetraccion decimal(18,2), "
    "PorcentajeDet decimal(18,2), customerOrderNumber string"
)

# Fixed column names of the invoice line table.
LINE_SCHEMA = "FacInterno string, NumPed string, Cod_Material string, Descripcion string, Cantidad string"

# Department number, department, state code.
DEPARTMENTS = [
    (1, "AMAZONAS", "AM"), (2, "ANCASH", "AN"), (3, "APURIMAC", "AP"), (4, "AREQUIPA", "AR"),
    (5, "AYACUCHO", "AY"), (6, "CAJAMARCA", "CA"), (7, "CALLAO", "CL"), (8, "CUSCO", "CU"),
    (9, "HUANCAVELICA", "HV"), (10, "HUANUCO", "HU"), (11, "ICA", "IC"), (12, "JUNIN", "JU"),
    (13, "LALIBERTAD", "LL"), (14, "LAMBAYEQUE", "LA"), (15, "LIMA", "LI"), (16, "LORETO", "LO"),
    (17, "MADREDEDIOS", "MD"), (18, "MOQUEGUA", "MO"), (19, "PASCO", "PA"), (20, "PIURA", "PI"),
    (21, "PUNO", "PU"), (22, "SANMARTIN", "SM"), (23, "TACNA", "TA"), (24, "TUMBES", "TU"),
    (25, "UCAYALI", "UC"),
]

# Transfer motive.
THIRD_PARTY_SALE = 3

# Destination folders of a guide's PDF.
ROUTE_DEFAULT = "dirPDFs"
ROUTE_THIRD_PARTY = "dirEcommerce"
ROUTE_SERIE_T004 = "dirHpmps"

# Attribute keys read from a guide's text record, in reading order.
ATTRIBUTE_KEYS = [
    "Serie", "Correlativo", "RazoTrans", "RUCTranspor", "FechInicioTraslado", "DirLlegUbiGeo",
    "MotivoTraslado",
]

# Labels read from the description line, in reading order, and their target columns.
DESCRIPTION_LABELS = {
    "Orden de Compra Cliente": "ordenCompra",
    "Nota de Venta SAP": "notaVenta",
    "Documento Despacho": "delivery",
    "Factura Sistema": "facturaSAP",
    "Documento Ref": "facturaSUNAT",
}
DESCRIPTION_MARKER = "DescripcionAdicsunat"

# Invoice header tags (the source spells one of them "sequentilaNumber") and their columns.
HEADER_TAGS = {
    "ns0:documentType": "TipDoc",
    "ns0:docNumber": "Serie",
    "ns0:sequentilaNumber": "Numero",
    "ns0:invoiceDate": "Fecha",
    "ns0:billToNumber": "Cod_SAP",
    "ns0:customerTVAT": "Ruc",
    "ns0:billToName": "Cliente",
    "ns0:currencyCode": "Moneda",
    "ns0:totalTaxValue": "Monto",
    "ns0:SAPBillingDocumentNumber": "FacInterno",
    "ns0:paymentDueDate": "FecVenci",
    "ns0:paymentMethod": "ConPag",
    "ns0:soldToEmailId": "Contacto",
    "ns0:orderNumber": "NumPed",
    "ns0:paymentIssueTime": "paymentIssueTime",
    "ns0:salesMan": "CodVen",
    "ns0:salesOrderReason": "orderReason",
    "ns0:customerOrderNumber": "customerOrderNumber",
    "ns0:MontoDetraccion": "MontoDetraccion",
    "ns0:PorcentajeDet": "PorcentajeDet",
    "ns0:referenceDocNumber": "referenceDocNumber",
}
LINE_TAG = "ns0:stocKLine"
LINE_CHILD_TAGS = {
    "ns0:partNumber": "part_number",
    "ns0:itemDescription": "description",
    "ns0:quantity": "quantity",
}
REFERENCE_DOCUMENT_TYPES = ["07", "08"]

# What a new invoice header starts with.
HEADER_DEFAULTS = {
    "Sunat": "No procesado",
    "Estado": "Pendiente",
    "EstCobranza": "Sin Gestion",
    "Deli": "1",
    "Situacion": "Pendiente",
    "indNotificacion": 0,
}

# Log levels by rank.
LEVELS = ["Trace", "Debug", "Information", "Warning", "Error", "Critical"]

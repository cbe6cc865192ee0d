"""Landing files as the producers write them."""

from __future__ import annotations

import os
from pathlib import Path

from folioflow.plans.jobs import Folders

def record(serie="T001", number="0204617", motive="03", postal="150101", date="2026-04-07", delivery="8300456789"):
    """A guide's text record: what the jobs read, and lines of other kinds between."""
    pieces = [f"Factura Sistema {9000000000 + int(number)}", "Turno B", f"Documento Despacho {delivery}" if delivery else "Sin despacho",
              "Nota de Venta SAP 61", "Muelle 12", "Documento Ref F500-7", "Orden de Compra Cliente 52"]
    lines = [
        ("G", "DirLlegUbiGeo", 1, postal), ("G", "MotivoTraslado", 1, motive), ("X", "SerieAnterior", 1, "T999"),
        ("G1", "RazoTrans", 1, "RIVER FREIGHT; LTD"), ("G1", "FechInicioTraslado", 1, date), ("G1", "RUCTranspor", 1, "\t 20111 "),
        ("E", "DescripcionAdicsunat", 1, " | ".join(["pedido", *pieces])),
        ("A", "Correlativo", 1, number), ("A", "Serie", 1, serie), ("A", "Serie", 2, "T000"),
    ]
    return "".join(f"{';'.join(map(str, parts))}\n" for parts in lines)


def element(tag, *children):
    return f"<ns0:{tag}>{''.join(children)}</ns0:{tag}>"


def line(part="000000000007720345", text="LAMP BLUE", quantity="1.000"):
    children = {"quantity": quantity, "itemDescription": text, "partNumber": part}
    return element("line", element("stocKLine", *(element(t, v) for t, v in children.items() if v is not None)))


def invoice(lines=None, **tags):
    """An invoice with only what the tests look at; tags that are None are left out."""
    header = {
        "currencyCode": "USD", "totalTaxValue": "77.5", "SAPBillingDocumentNumber": "3141", "orderNumber": "2718",
        "paymentMethod": "30 días", "docNumber": "F500", "sequentilaNumber": "0000042", "documentType": "01",
        "invoiceDate": "2026-03-02", **tags,
    }
    fields = [element(tag, value) for tag, value in header.items() if value is not None]
    body = element("batch", *([line()] if lines is None else lines), *fields)
    return f'<ns0:Document xmlns:ns0="urn:test">{body}</ns0:Document>'


class Landing:
    """Landing folders below a temporary directory; files get increasing write times."""

    def __init__(self, root: Path):
        self.root = root
        self.clock = 1_775_000_000
        self.folders = Folders(*(str(root / name) for name in ("pdf", "txt", "xml", "routed")))
        for name in ("pdf", "txt", "xml", "routed"):
            (root / name).mkdir(parents=True)

    def put(self, kind: str, name: str, text: str, when: int | None = None) -> str:
        path = self.root / kind / name
        path.write_text(text, encoding="utf-8", newline="")
        self.clock += 60
        os.utime(path, (when or self.clock,) * 2)
        return str(path)

    def guide(self, number="0204617", serie="T001", issuer="20990011224", **fields) -> str:
        self.put("txt", f"{issuer}-{serie}-{number}.txt", record(serie=serie, number=number, **fields))
        return self.put("pdf", f"{issuer}-09-{serie}-0{number}.pdf", f"%PDF {serie} {number}")

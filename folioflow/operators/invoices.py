"""From invoice XML to header and line rows."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioflow.functions.numbers import part_number, quantity_text, tolerant_amount
from folioflow.functions.text import clean_document, compact_date
from folioflow.schemas import (
    HEADER_DEFAULTS, HEADER_SCHEMA, HEADER_TAGS, LINE_CHILD_TAGS, LINE_TAG, REFERENCE_DOCUMENT_TYPES,
)

_LINES_TYPE = "array<struct<part_number:string,description:string,quantity:string>>"


# Blanks that make up a text run XML readers drop.
_XML_BLANKS = " \t\r\n"
_DECLARATION = re.compile(r"xmlns(?::(\w+))?\s*=")


@functools.lru_cache(maxsize=64)
def _names_in(uri: str) -> tuple[dict[str, str], str, dict[str, str]]:
    """Header tags, line tag and line children as ElementTree names them."""
    def full(tag: str) -> str:
        return f"{{{uri}}}{tag.partition(':')[2]}"

    return (
        {full(tag): tag for tag in HEADER_TAGS},
        full(LINE_TAG),
        {full(tag): column for tag, column in LINE_CHILD_TAGS.items()},
    )


def _inner_text(element: ElementTree.Element) -> str:
    if len(element):
        return "".join(run for run in element.itertext() if run.strip(_XML_BLANKS))
    text = element.text or ""
    return text if text.strip(_XML_BLANKS) else ""


def flatten_document(text: str) -> tuple[dict[str, str], list[dict[str, str]]]:
    """Header tags (first anywhere) and stock lines (direct children) of one document.

    Tags are matched by prefix and local name as written. Text runs of nothing but blanks do not
    count. Raises ``ParseError`` or ``ExpatError`` on malformed documents and undeclared prefixes.
    """
    prefix = LINE_TAG.partition(":")[0]
    if [m.group(1) for m in _DECLARATION.finditer(text)] != [prefix]:
        return _flatten_any_prefix(text)
    # A single declaration, of our prefix: names by namespace are names by prefix.
    root = ElementTree.fromstring(text)
    uri = next((e.tag[1:].partition("}")[0] for e in root.iter() if e.tag[0] == "{"), "")
    header_tags, line_tag, child_tags = _names_in(uri)
    header: dict[str, str] = {}
    lines = []
    for element in root.iter():
        tag = header_tags.get(element.tag)
        if tag is not None and tag not in header:
            header[tag] = _inner_text(element)
        elif element.tag == line_tag:
            line = dict.fromkeys(LINE_CHILD_TAGS.values(), "")
            found = set()
            for child in element:
                column = child_tags.get(child.tag)
                if column is not None and column not in found:
                    found.add(column)
                    line[column] = _inner_text(child)
            lines.append(line)
    return header, lines


def _flatten_any_prefix(text: str) -> tuple[dict[str, str], list[dict[str, str]]]:
    """The same for documents with other or nested namespace declarations: prefixes tracked one by one."""
    parser = expat.ParserCreate(namespace_separator=" ")
    parser.namespace_prefixes = True
    header: dict[str, list[str]] = {}
    lines: list[dict[str, list[str]]] = []
    # One frame per open element: the text collectors it opened and its line, when it is one.
    collecting: list[list[str]] = []
    frames: list[tuple[int, dict[str, list[str]] | None]] = []

    run: list[str] = []

    def end_run() -> None:
        text_run = "".join(run)
        run.clear()
        if text_run.strip(_XML_BLANKS):
            for pieces in collecting:
                pieces.append(text_run)

    def opened(name: str, _attributes: dict[str, str]) -> None:
        end_run()
        parts = name.split(" ")
        tag = f"{parts[2]}:{parts[1]}" if len(parts) == 3 else parts[-1]
        before = len(collecting)
        parent = frames[-1][1] if frames else None
        if tag in HEADER_TAGS and tag not in header:
            header[tag] = []
            collecting.append(header[tag])
        if parent is not None and tag in LINE_CHILD_TAGS and tag not in parent:
            parent[tag] = []
            collecting.append(parent[tag])
        line: dict[str, list[str]] | None = None
        if tag == LINE_TAG:
            line = {}
            lines.append(line)
        frames.append((before, line))

    def closed(_name: str) -> None:
        end_run()
        del collecting[frames.pop()[0]:]

    def characters(data: str) -> None:
        if collecting:
            run.append(data)

    parser.StartElementHandler = opened
    parser.EndElementHandler = closed
    parser.CharacterDataHandler = characters
    parser.Parse(text, True)
    return (
        {tag: "".join(pieces) for tag, pieces in header.items()},
        [
            {column: "".join(line.get(tag, ())) for tag, column in LINE_CHILD_TAGS.items()}
            for line in lines
        ],
    )


_LINE_TYPE = pa.list_(pa.struct([(column, pa.string()) for column in LINE_CHILD_TAGS.values()]))


def _parse_batches(batches: Iterator[pa.RecordBatch], tags: tuple[str, ...] = tuple(HEADER_TAGS)) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        headers: list[list[str | None]] = [[] for _ in tags]
        lines, errors = [], []
        for text in batch.column("xml").to_pylist():
            try:
                found, stock = flatten_document(text or "")
                errors.append(None)
            except (ElementTree.ParseError, expat.ExpatError, ValueError) as error:
                found, stock = {}, []
                errors.append(str(error))
            for column, tag in zip(headers, tags):
                column.append(found.get(tag, ""))
            lines.append(stock)
        kept = [name for name in batch.schema.names if name != "xml"]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(name) for name in kept),
                *(pa.array(values, pa.string()) for values in headers),
                pa.array(lines, _LINE_TYPE),
                pa.array(errors, pa.string()),
            ],
            [*kept, *(HEADER_TAGS[tag] for tag in tags), "lines", "xml_error"],
        )


def parse_documents(
    documents: DataFrame, text: str = "value", keep: tuple[str, ...] = ("path",), fields: tuple[str, ...] | None = None
) -> DataFrame:
    """Parse whole XML documents in Arrow batches: one text column per tag, ``lines``, ``xml_error``.

    ``fields`` names the columns that are wanted of the tags; all, if None. A missing tag is an empty string. A malformed, empty or null document becomes a row with an error, it does
    not stop the job.
    """
    source = documents.select(*keep, clean_document(F.col(text)).alias("xml"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in documents.select(*keep).schema.fields)
    tags = tuple(tag for tag, column in HEADER_TAGS.items() if fields is None or column in fields)
    texts = "".join(f"{HEADER_TAGS[tag]} string, " for tag in tags)

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _parse_batches(batches, tags)

    return source.mapInArrow(parsed, f"{kept}, {texts}lines {_LINES_TYPE}, xml_error string")


def with_header_fields(parsed: DataFrame) -> DataFrame:
    """Amounts parsed, and the reference document kept only where the document type has one."""
    if "referenceDocNumber" in parsed.columns:
        kept = F.when(F.col("TipDoc").isin(REFERENCE_DOCUMENT_TYPES), F.col("referenceDocNumber")).otherwise("")
        parsed = parsed.withColumn("referenceDocNumber", kept)
    return parsed.withColumns(
        {
            "MontoDetraccion": tolerant_amount(F.col("MontoDetraccion")),
            "PorcentajeDet": tolerant_amount(F.col("PorcentajeDet")),
        }
    )


def with_checked_lines(documents: DataFrame) -> DataFrame:
    """Add ``checked_lines`` (strict part number and quantity, null where invalid) and ``status``.

    One bad line, malformed XML or an amount the table cannot hold fails the whole document.
    """
    checked = documents.withColumn(
        "checked_lines",
        F.transform(
            "lines",
            lambda line, i: F.struct(
                i.alias("line_no"),
                part_number(line["part_number"]).alias("Cod_Material"),
                line["description"].alias("Descripcion"),
                quantity_text(line["quantity"]).alias("Cantidad"),
            ),
        ),
    )
    bad_line = F.exists("checked_lines", lambda c: c["Cod_Material"].isNull() | c["Cantidad"].isNull())
    reason = F.coalesce(
        F.when(F.col("xml_error").isNotNull(), "malformed_xml"),
        F.when(bad_line, "bad_line"),
        F.when(F.col("MontoDetraccion").isNull() | F.col("PorcentajeDet").isNull(), "amount_out_of_range"),
    )
    return checked.withColumn("reason", reason).withColumn(
        "status", F.when(reason.isNull(), "accepted").otherwise("failed")
    )


#: Columns of the header that decide about a document.
_JUDGED = ("MontoDetraccion", "PorcentajeDet")


def evaluate(documents: DataFrame, fields: tuple[str, ...] | None = None) -> DataFrame:
    """Invoice files (``path``, ``name_file``, ``value``) to judged documents, one row per file.

    Of the header only ``fields`` and what decides go along; all, if None.
    """
    if fields is not None:
        fields = (*fields, *_JUDGED, *(("TipDoc",) if "referenceDocNumber" in fields else ()))
    parsed = parse_documents(documents, keep=tuple(c for c in documents.columns if c != "value"), fields=fields)
    return with_checked_lines(with_header_fields(parsed))


def header_rows(accepted: DataFrame) -> DataFrame:
    """Rows of the header table."""
    ready = accepted.withColumns(
        {
            "NameFile": F.col("name_file"),
            "Fecha": compact_date(F.col("Fecha")),
            "FecVenci": compact_date(F.col("FecVenci")),
            **{column: F.lit(value) for column, value in HEADER_DEFAULTS.items()},
        }
    )
    return ready.select(*(part.split()[0] for part in HEADER_SCHEMA.split(", ")))


def line_rows(accepted: DataFrame, *extra: str) -> DataFrame:
    """Rows of the line table, in document order; documents without lines give none."""
    # Outer, then filtered: a plain explode makes Spark test the array's size below, computing it twice.
    exploded = accepted.select("FacInterno", "NumPed", *extra, F.explode_outer("checked_lines").alias("_line"))
    return exploded.where(F.col("_line").isNotNull()).select("FacInterno", "NumPed", *extra, "_line.*")


def rows_affected(outcomes: DataFrame) -> DataFrame:
    """Rows a document adds: header and lines, 0 when it was registered before or failed."""
    return outcomes.withColumn(
        "rows_affected",
        F.when(F.col("status") == "accepted", 1 + F.size("checked_lines")).otherwise(0),
    )

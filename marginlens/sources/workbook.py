"""Spreadsheet (xlsx) source.

Spark has no workbook reader, and the usual Python one is not available, so
the workbooks are read as a Spark job: ``binaryFile`` lists and loads them
(one record per workbook) and ``mapInPandas`` decodes each record in a
worker.  An xlsx file is a zip of XML parts; only the standard library is
needed: the first sheet named in ``xl/workbook.xml``, its target from the
workbook relationships, the shared-string table, and the sheet's cells
(streamed with ``iterparse``, so a large sheet is never a whole DOM).

The first row must equal the schema's field names exactly and in order;
otherwise the task fails with the file name and both header lists.  Cell
values arrive as text: shared and inline strings as written, numbers as
their stored digits (a postal code ``2150`` stays ``"2150"``), booleans as
``TRUE``/``FALSE``.  Missing cells are NULL; fully empty rows are skipped.

A workbook is not splittable, so it is the unit of parallelism: a folder of
workbooks is read by as many tasks as there are files.
"""

from __future__ import annotations

import io
import posixpath
import sys
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marginlens.schemas import CUSTOMERS_SCHEMA
from marginlens.sources.files import SourceError, _load

# The decoder runs in Python workers.  Pickling this module's functions by
# value ships their code with each task, so executors do not need the
# package installed or on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"


def _column_index(ref: str) -> int:
    """``"C7"`` -> 2 (zero-based column of a cell reference)."""
    index = 0
    for ch in ref:
        if not ch.isalpha():
            break
        index = index * 26 + (ord(ch.upper()) - ord("A") + 1)
    return index - 1


def _first_sheet(z: zipfile.ZipFile) -> str:
    workbook = ET.fromstring(z.read("xl/workbook.xml"))
    sheet = workbook.find(f"{_MAIN}sheets/{_MAIN}sheet")
    if sheet is None:
        raise ValueError("workbook has no sheets")
    rel_id = sheet.get(f"{_REL}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels:
        if rel.get("Id") == rel_id:
            target = rel.get("Target", "")
            return target.lstrip("/") if target.startswith("/") else posixpath.normpath(f"xl/{target}")
    raise ValueError(f"sheet relationship {rel_id!r} not found")


def _shared_strings(z: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in z.namelist():
        return []
    root = ET.fromstring(z.read("xl/sharedStrings.xml"))
    # A rich-text entry is several runs; its text is the runs joined.
    return ["".join(t.text or "" for t in si.iter(f"{_MAIN}t")) for si in root.findall(f"{_MAIN}si")]


def _cell_value(cell: ET.Element, strings: list[str]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    value = cell.find(f"{_MAIN}v")
    if value is None or value.text is None:
        return None
    if kind == "s":
        return strings[int(value.text)]
    if kind == "b":
        return "TRUE" if value.text.strip() == "1" else "FALSE"
    return value.text


def iter_rows(content: bytes) -> Iterator[list[str | None]]:
    """Rows of the first sheet as lists of text (``None`` for missing cells)."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        strings = _shared_strings(z)
        with z.open(_first_sheet(z)) as sheet:
            for _, elem in ET.iterparse(sheet, events=("end",)):
                if elem.tag != f"{_MAIN}row":
                    continue
                values: dict[int, str | None] = {}
                for position, cell in enumerate(elem.findall(f"{_MAIN}c")):
                    ref = cell.get("r")
                    values[_column_index(ref) if ref else position] = _cell_value(cell, strings)
                elem.clear()
                width = max(values) + 1 if values else 0
                yield [values.get(i) for i in range(width)]


# Rows per pandas frame handed back to Spark: a large workbook streams out
# in chunks, so a task never holds all of its decoded rows at once.
CHUNK_ROWS = 10_000


def iter_workbook_frames(
    path: str, content: bytes, names: list[str], strict_header: bool = True, chunk_rows: int = CHUNK_ROWS
) -> Iterator[pd.DataFrame]:
    """Data rows of one workbook as pandas frames of at most ``chunk_rows`` rows."""
    rows = iter_rows(content)
    header = next(rows, [])
    while header and header[-1] is None:  # trailing empty cells are not columns
        header.pop()
    if strict_header and header != names:
        raise ValueError(f"{path}: header mismatch; expected {names}, got {header}")
    chunk: list[list[str | None]] = []
    for row in rows:
        if any(v is not None and v != "" for v in row):
            chunk.append((row + [None] * len(names))[: len(names)])
            if len(chunk) >= chunk_rows:
                yield pd.DataFrame.from_records(chunk, columns=names)
                chunk = []
    if chunk:
        yield pd.DataFrame.from_records(chunk, columns=names)


def decode_workbook(path: str, content: bytes, names: list[str], strict_header: bool = True) -> pd.DataFrame:
    """Data rows of one workbook as a single pandas frame with columns ``names``."""
    frames = list(iter_workbook_frames(path, content, names, strict_header))
    return pd.concat(frames, ignore_index=True) if frames else pd.DataFrame(columns=names)


def _text_schema(schema: StructType) -> list[str]:
    non_text = [f.name for f in schema.fields if f.dataType.simpleString() != "string"]
    if non_text:
        raise SourceError(f"workbook schema must be all text; cast after loading: {non_text}")
    return schema.fieldNames()


def decode_records(records: DataFrame, schema: StructType = CUSTOMERS_SCHEMA, strict_header: bool = True) -> DataFrame:
    """Decode a DataFrame of workbook records ``(path, content)`` into ``schema`` rows.

    This is the worker side of :func:`read_workbooks`; each record is decoded
    in the task that holds it.
    """
    names = _text_schema(schema)

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file_path, content in zip(batch["path"], batch["content"]):
                yield from iter_workbook_frames(file_path, content, names, strict_header)

    return records.select("path", "content").mapInPandas(decode, schema)


def read_workbooks(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType = CUSTOMERS_SCHEMA,
    strict_header: bool = True,
    glob: str = "*.xlsx",
) -> DataFrame:
    """The first sheet of every workbook under ``path`` as ``schema`` (all-text schemas).

    ``strict_header`` requires the first row to equal the schema names in
    order, as the reference does; with it off, columns bind by position.
    """
    _text_schema(schema)
    files = _load(
        "workbook", path, lambda: spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
    )
    return decode_records(files, schema, strict_header)


def read_customers(spark: SparkSession, path: str | list[str], strict_header: bool = True) -> DataFrame:
    """Customers from workbooks with the declared 11-column schema."""
    return read_workbooks(spark, path, CUSTOMERS_SCHEMA, strict_header)


# --- round-trip support -----------------------------------------------------
# The reference only reads workbooks.  To check the reader against the same
# tables as every other query, a text table can be encoded as workbooks of
# ``ENCODED_ROWS`` rows (inline strings, missing cells for NULL) and written
# through Spark's text writer, one per file.

ENCODED_ROWS = 10_000

def _cell_ref(column: int, row: int) -> str:
    letters = ""
    column += 1
    while column:
        column, rem = divmod(column - 1, 26)
        letters = chr(65 + rem) + letters
    return f"{letters}{row}"


def encode_workbook(header: list[str], rows: Iterator[list[str | None]]) -> bytes:
    """A one-sheet xlsx holding ``header`` and ``rows`` as inline strings."""
    from xml.sax.saxutils import escape

    main = _MAIN.strip("{}")
    rel = _REL.strip("{}")
    lines = []
    for r, row in enumerate([header, *rows], start=1):
        cells = "".join(
            f'<c r="{_cell_ref(c, r)}" t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>'
            for c, v in enumerate(row)
            if v is not None
        )
        lines.append(f'<row r="{r}">{cells}</row>')
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
                                      f'<sheet name="data" sheetId="1" r:id="rId1"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels",
                   '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                   f'<Relationship Id="rId1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/>'
                   "</Relationships>")
        z.writestr("xl/worksheets/sheet1.xml",
                   f'<worksheet xmlns="{main}"><sheetData>{"".join(lines)}</sheetData></worksheet>')
        z.comment = b"\n"  # the archive's last byte; a line end to a text writer
    return out.getvalue()


def to_workbook_records(df: DataFrame) -> DataFrame:
    """An all-text ``df`` as workbook records ``(path, content)`` of at most ``ENCODED_ROWS`` rows."""
    names = _text_schema(df.schema)

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, made, rows = TaskContext.get().partitionId(), 0, []

        def workbook() -> pd.DataFrame:
            return pd.DataFrame({"path": [f"part-{part:05d}-{made:05d}.xlsx"], "content": [encode_workbook(names, rows)]})

        for batch in batches:
            for row in batch.astype(object).where(batch.notna(), None).values.tolist():
                rows.append(row)
                if len(rows) == ENCODED_ROWS:
                    yield workbook()
                    made, rows = made + 1, []
        if rows or not made:
            yield workbook()

    return df.mapInPandas(encode, "path string, content binary")


def write_workbooks(df: DataFrame, path: str) -> None:
    """Workbook files of an all-text ``df`` under ``path``, one workbook per file."""
    content = F.expr("CAST(substring(content, 1, length(content) - 1) AS STRING)")
    to_workbook_records(df).select(content.alias("value")).write.option("maxRecordsPerFile", 1).text(path)

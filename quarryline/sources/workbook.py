"""Excel 2013+ workbooks as a partitioned source and sink.

Reading: one task per workbook over the ``binaryFile`` source. Writing: every task writes workbooks of
at most ``MAX_SHEET_ROWS`` rows each, and the driver publishes those of accepted attempts.
"""

from __future__ import annotations

import io
import re
import uuid
import zipfile
from collections.abc import Iterator
from datetime import date, datetime, timedelta
from decimal import Decimal
from xml.etree import ElementTree
from xml.sax.saxutils import escape

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    LongType,
    StringType,
    StructType,
    TimestampNTZType,
)

from quarryline.runtime import mark_complete, move_file, remove_output, ship_package, task_filesystem
from quarryline.sources.formats import SOURCE_FILE_COLUMN

# Fixed values of the file format: rows a sheet can hold (with its header), day zero of its
# calendar, built-in date formats, and its XML name spaces.
MAX_SHEET_ROWS = 1_048_576
_DAY_ZERO = datetime(1899, 12, 30)
_DATE_FORMATS = {*range(14, 23), *range(45, 48)}
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_ROW, _CELL, _VALUE = f"{_MAIN}row", f"{_MAIN}c", f"{_MAIN}v"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"

SHEET_NAME = "Sheet_name_1"

_BATCH_ROWS = 10_000

# --------------------------------------------------------------------------- reading


def _column_number(reference: str) -> int:
    number = 0
    for letter in re.match(r"[A-Z]+", reference).group(0):
        number = number * 26 + ord(letter) - 64
    return number - 1


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers that show a number as a date."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    dates = set(_DATE_FORMATS)
    for custom in root.iter(f"{_MAIN}numFmt"):
        plain = re.sub(r'"[^"]*"|\[[^\]]*\]', "", custom.get("formatCode", ""))
        if re.search(r"[ymdhs]", plain, re.IGNORECASE):
            dates.add(int(custom.get("numFmtId")))
    formats = root.find(f"{_MAIN}cellXfs")
    return {i for i, xf in enumerate(formats if formats is not None else []) if int(xf.get("numFmtId", 0)) in dates}


def _sheet_member(book: zipfile.ZipFile, sheet: str | int) -> str:
    """Archive member of a sheet given by name or by zero-based number."""
    sheets = list(ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"))
    chosen = sheets[sheet] if isinstance(sheet, int) else next((s for s in sheets if s.get("name") == sheet), None)
    if chosen is None:
        raise ValueError(f"the workbook has no sheet named {sheet!r}")
    for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        if link.get("Id") == chosen.get(_LINK):
            target = link.get("Target")
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    raise ValueError("the workbook does not say where its sheet is stored")


def _cell_value(cell, strings: list[str], date_styles: set[int]):
    kind, value = cell.get("t", "n"), cell.find(_VALUE)
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{_MAIN}t"))
    if value is None or value.text is None:
        return None
    if kind == "s":
        return strings[int(value.text)]
    if kind == "b":
        return value.text == "1"
    if kind in ("str", "d"):
        return value.text
    if kind == "e":
        return None
    if date_styles and int(cell.get("s", 0)) in date_styles:
        return _DAY_ZERO + timedelta(microseconds=round(float(value.text) * 86_400_000_000))
    return int(value.text) if value.text.lstrip("-").isdecimal() else float(value.text)


def sheet_rows(content: bytes, sheet: str | int = 0) -> Iterator[list]:
    """Rows of one sheet, read as a stream from the archive; the first one is the header."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        strings = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_MAIN}si"):
                strings.append("".join(t.text or "" for t in item.iter(f"{_MAIN}t")))
        dates = _date_styles(book)
        with book.open(_sheet_member(book, sheet)) as stream:
            for _, node in ElementTree.iterparse(stream):
                if node.tag != _ROW:
                    continue
                row: list = []
                for at, cell in enumerate(node.iter(_CELL)):
                    place = _column_number(cell.get("r")) if cell.get("r") else at
                    row.extend([None] * (place + 1 - len(row)))
                    row[place] = _cell_value(cell, strings, dates)
                node.clear()
                yield row


def _header(rows: Iterator[list]) -> list[str]:
    names = next(rows, [])
    return [f"Unnamed: {i}" if n is None else str(n) for i, n in enumerate(names)]


_TYPES = {
    kind.simpleString(): kind
    for kind in (BooleanType(), LongType(), DoubleType(), TimestampNTZType(), StringType())
}


def _kind(value) -> str:
    if isinstance(value, bool):
        return "boolean"
    if isinstance(value, int):
        return "bigint"
    if isinstance(value, float):
        return "double"
    return "timestamp_ntz" if isinstance(value, datetime) else "string"


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    ship_package(spark)
    files = reader.option("pathGlobFilter", "*.xls[xm]").load(paths)
    return files.select("content", F.col("_metadata.file_name").alias("name"))


def infer_workbook_schema(spark: SparkSession, paths: list[str], sheet: str | int = 0) -> StructType:
    """Column names and types over all workbooks; only distinct (name, type) pairs leave the tasks."""

    def kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                rows = sheet_rows(content, sheet)
                names = _header(rows)
                seen = {(at, name, "void") for at, name in enumerate(names)}
                for row in rows:
                    for at, value in enumerate(row[: len(names)]):
                        if value is not None:
                            seen.add((at, names[at], _kind(value)))
                yield pd.DataFrame(sorted(seen), columns=["at", "name", "kind"])

    found = _files(spark, paths).mapInPandas(kinds, "at int, name string, kind string")
    merged = found.groupBy("name").agg(F.min("at").alias("at"), F.collect_set("kind").alias("kinds"))
    schema = StructType()
    for row in merged.orderBy("at", "name").collect():
        real = set(row.kinds) - {"void"}
        if real == {"bigint", "double"}:
            real = {"double"}
        schema = schema.add(row.name, _TYPES[real.pop() if len(real) == 1 else "string"])
    return schema


def _converted(value, kind: str):
    if value is None or kind == "timestamp_ntz":
        return value
    if kind == "string" and not isinstance(value, str):
        return str(value)
    return float(value) if kind == "double" else value


def read_workbooks(
    spark: SparkSession, paths: list[str], sheet: str | int = 0, schema: StructType | str | None = None
) -> DataFrame:
    """Rows of one sheet of every workbook, by column name, with the source file of each row."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    schema = schema or infer_workbook_schema(spark, paths, sheet)
    kinds = {f.name: f.dataType.simpleString() for f in schema.fields}

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow_schema = to_arrow_schema(full)
        for batch in batches:
            for file in batch.to_pylist():
                rows = sheet_rows(file["content"], sheet)
                names, ready = _header(rows), []
                for row in rows:
                    record = {n: _converted(v, kinds[n]) for n, v in zip(names, row) if n in kinds}
                    ready.append({**record, SOURCE_FILE_COLUMN: file["name"]})
                    if len(ready) == _BATCH_ROWS:
                        yield pa.RecordBatch.from_pylist(ready, schema=arrow_schema)
                        ready = []
                yield pa.RecordBatch.from_pylist(ready, schema=arrow_schema)

    full = StructType(list(schema.fields)).add(SOURCE_FILE_COLUMN, "string")
    return _files(spark, paths).mapInArrow(rows_of, full)


# --------------------------------------------------------------------------- writing

_PARTS = {
    "[Content_Types].xml": (
        '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
        '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        '<Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.'
        'spreadsheetml.sheet.main+xml"/>'
        '<Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.'
        'spreadsheetml.styles+xml"/>'
        '<Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-'
        'officedocument.spreadsheetml.worksheet+xml"/></Types>'
    ),
    "_rels/.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
        'officeDocument" Target="xl/workbook.xml"/></Relationships>'
    ),
    "xl/_rels/workbook.xml.rels": (
        '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        '<Relationship Id="rId1" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
        'worksheet" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId2" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/'
        'styles" Target="styles.xml"/></Relationships>'
    ),
    "xl/workbook.xml": (
        '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
        'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
        f'<sheets><sheet name="{SHEET_NAME}" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/styles.xml": (
        '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
        '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders>'
        '<cellStyleXfs count="1"><xf/></cellStyleXfs>'
        '<cellXfs count="3"><xf/><xf numFmtId="14" applyNumberFormat="1"/>'
        '<xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'
    ),
}

_UNPRINTABLE = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _text_cell(text: str) -> str:
    return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(_UNPRINTABLE.sub("", text))}</t></is></c>'


def _cell(value) -> str:
    if value is None:
        return "<c/>"
    if isinstance(value, bool):
        return f'<c t="b"><v>{int(value)}</v></c>'
    if isinstance(value, datetime):
        days = (value.replace(tzinfo=None) - _DAY_ZERO) / timedelta(days=1)
        return f'<c s="2"><v>{days!r}</v></c>'
    if isinstance(value, date):
        return f'<c s="1"><v>{(datetime(value.year, value.month, value.day) - _DAY_ZERO).days}</v></c>'
    if isinstance(value, int) and abs(value) < 10**15:
        return f"<c><v>{value}</v></c>"
    if isinstance(value, float) and value == value and abs(value) != float("inf"):
        return f"<c><v>{value!r}</v></c>"
    if isinstance(value, Decimal):
        return f"<c><v>{value}</v></c>"
    return _text_cell(str(value))


class _OpenWorkbook:
    """One workbook being written, row by row, straight into a compressed stream."""

    def __init__(self, stream, names: list[str]):
        self.rows = 0
        self._archive = zipfile.ZipFile(stream, "w", zipfile.ZIP_DEFLATED)
        for member, xml in _PARTS.items():
            self._archive.writestr(member, '<?xml version="1.0" encoding="UTF-8"?>' + xml)
        self._sheet = self._archive.open("xl/worksheets/sheet1.xml", "w", force_zip64=True)
        self._sheet.write(
            b'<?xml version="1.0" encoding="UTF-8"?>'
            b'<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        )
        self.add(names)

    def add(self, values: list) -> None:
        self._sheet.write(f"<row>{''.join(map(_cell, values))}</row>".encode())
        self.rows += 1

    def close(self) -> None:
        self._sheet.write(b"</sheetData></worksheet>")
        self._sheet.close()
        self._archive.close()


def write_workbooks(df: DataFrame, path: str, max_rows: int = MAX_SHEET_ROWS) -> None:
    """Write a folder of workbooks, one or more per partition.

    Every task attempt writes below a folder of its own and reports its files. The reports that
    reach the driver are those of the attempts Spark accepted; only their files are published.
    """
    if not 2 <= max_rows <= MAX_SHEET_ROWS:
        raise ValueError(f"a sheet holds 2 to {MAX_SHEET_ROWS} rows, header included")
    spark, names = df.sparkSession, df.columns
    pending_root = f"{path}/_temporary-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        filesystem, root = task_filesystem(pending_root)
        attempt = f"attempt-{context.taskAttemptId()}"
        filesystem.create_dir(f"{root}/{attempt}", recursive=True)
        files, book, stream = [], None, None
        for batch in batches:
            for row in zip(*[column.to_pylist() for column in batch.columns]):
                if book is not None and book.rows >= max_rows:
                    book.close()
                    stream.close()
                    book = None
                if book is None:
                    files.append(f"part-{context.partitionId():05d}-{len(files):05d}.xlsx")
                    stream = filesystem.open_output_stream(f"{root}/{attempt}/{files[-1]}")
                    book = _OpenWorkbook(stream, names)
                book.add(list(row))
        if book is not None:
            book.close()
            stream.close()
        yield pa.RecordBatch.from_pydict({"attempt": [attempt] * len(files), "file": files})

    ship_package(spark)
    try:
        for row in df.mapInArrow(write, "attempt string, file string").collect():
            move_file(spark, f"{pending_root}/{row.attempt}/{row.file}", f"{path}/{row.file}")
    finally:
        remove_output(spark, pending_root)
    mark_complete(spark, path)

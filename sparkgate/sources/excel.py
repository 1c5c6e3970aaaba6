"""Excel workbooks as a distributed source: whole files to tasks, parsed there, rows to Spark.

The parser is a small helper over the standard library: the first sheet, one header row, one
record per further row. A sheet holds about a million rows at most, and rows are handed to Spark
in batches as the sheet's XML goes by, so a task holds one packed file and one batch.
"""

from __future__ import annotations

import io
import re
import sys
import zipfile
from collections.abc import Callable, Iterator
from datetime import datetime, timedelta
from typing import IO
from xml.etree import ElementTree
from xml.parsers import expat

import pandas as pd
import pyspark.sql.functions as F
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from sparkgate.errors import StorageReadError
from sparkgate.functions.conform import conform

# Ship these functions with the job: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

WORKBOOK_GLOB = "*.[xX][lL][sS][xX]"
BATCH_ROWS = 10_000
CHUNK_BYTES = 1 << 16

# Number formats the workbook format reserves for dates and times.
BUILT_IN_DATE_FORMATS = frozenset({14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47})


def read_workbooks(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    wanted: Column | None = None,
) -> DataFrame:
    """Rows of all workbooks under path and its subfolders, conformed to schema; none when there are no workbooks.

    wanted is a predicate on the column file_name; files it refuses are not opened.
    """
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", WORKBOOK_GLOB)
            .option("recursiveFileLookup", "true")
            .load(path)
        )
    except Exception as error:
        raise StorageReadError(f"cannot read {path}: {error}", location=path) from error
    name = F.col("_metadata.file_name")
    if wanted is not None:
        files = files.select("content", name.alias("file_name")).filter(wanted)
    return parse_workbooks(files, schema)


def parse_workbooks(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of the workbooks in the binary column content, batch or stream."""
    names = schema.fieldNames()
    as_text = T.StructType([T.StructField(n, T.StringType()) for n in names])

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for content in batch["content"]:
                for rows in _batched_rows(content, names):
                    yield pd.DataFrame(rows, columns=names, dtype=object)

    return conform(files.select("content").mapInPandas(parse, as_text), schema, loose_numbers=True)


def _batched_rows(content: bytes, names: list[str]) -> Iterator[list[list[str | None]]]:
    rows: list[list[str | None]] = []
    header: dict[int, int] | None = None
    for cells in sheet_rows(content):
        if header is None:
            place = {name: i for i, name in enumerate(names)}
            header = {
                column: place[text.strip()]
                for column, text in cells.items()
                if text is not None and text.strip() in place
            }
            continue
        if not cells:
            continue
        row: list[str | None] = [None] * len(names)
        for column, target in header.items():
            row[target] = cells.get(column)
        rows.append(row)
        if len(rows) == BATCH_ROWS:
            yield rows
            rows = []
    if rows:
        yield rows


def sheet_rows(content: bytes) -> Iterator[dict[int, str | None]]:
    """Rows of the first sheet as {column number: text}; empty cells are left out."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        parts = set(book.namelist())
        sheet, dates_from_1904 = _first_sheet(book)
        strings = _shared_strings(book) if "xl/sharedStrings.xml" in parts else []
        date_styles = _date_styles(book) if "xl/styles.xml" in parts else frozenset()

        def text_of(kind: str, style: str, value: str) -> str | None:
            return _cell_text(kind, style, value, strings, date_styles, dates_from_1904)

        with book.open(sheet) as stream:
            yield from _stream_rows(stream, text_of)


def _stream_rows(
    stream: IO[bytes], text_of: Callable[[str, str, str], str | None]
) -> Iterator[dict[int, str | None]]:
    """Rows of a sheet as its XML goes by, a chunk at a time."""
    rows: list[dict[int, str | None]] = []
    cells: dict[int, str | None] = {}
    numbers: dict[str, int] = {}
    pieces: list[str] = []
    kind = style = ""
    column = -1
    reading = filled = phonetic = False

    def start(name: str, attributes: dict[str, str]) -> None:
        nonlocal cells, kind, style, column, reading, filled, phonetic
        tag = name.rpartition(":")[2]
        if tag == "c":
            kind, style = attributes.get("t", "n"), attributes.get("s", "0")
            letters = attributes.get("r", "").rstrip("0123456789")
            if not letters:
                column += 1
            elif letters in numbers:
                column = numbers[letters]
            else:
                column = numbers[letters] = _column_number(letters)
            pieces.clear()
            filled = False
        elif tag == "v" or tag == "t":
            reading = not phonetic
            filled = True
        elif tag == "row":
            cells, column = {}, -1
        elif tag == "rPh":
            phonetic = True

    def characters(data: str) -> None:
        if reading:
            pieces.append(data)

    def end(name: str) -> None:
        nonlocal reading, phonetic
        tag = name.rpartition(":")[2]
        if tag == "v" or tag == "t":
            reading = False
        elif tag == "c":
            if filled:
                text = text_of(kind, style, "".join(pieces))
                if text is not None:
                    cells[column] = text
        elif tag == "row":
            rows.append(cells)
        elif tag == "rPh":
            phonetic = False

    parser = expat.ParserCreate()
    parser.buffer_text = True
    parser.StartElementHandler = start
    parser.CharacterDataHandler = characters
    parser.EndElementHandler = end
    while chunk := stream.read(CHUNK_BYTES):
        parser.Parse(chunk)
        yield from rows
        rows.clear()
    parser.Parse(b"", True)
    yield from rows


def _tag(element: ElementTree.Element) -> str:
    return element.tag.rpartition("}")[2]


def _text_of(element: ElementTree.Element) -> str:
    """Text runs joined, without phonetic hints."""
    pieces = []
    for child in element:
        if _tag(child) == "t":
            pieces.append(child.text or "")
        elif _tag(child) == "r":
            pieces.append(_text_of(child))
    return "".join(pieces)


def _first_sheet(book: zipfile.ZipFile) -> tuple[str, bool]:
    workbook = ElementTree.fromstring(book.read("xl/workbook.xml"))
    links = ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))
    targets = {link.get("Id"): link.get("Target") for link in links}
    dates_from_1904 = False
    sheet = None
    for element in workbook.iter():
        if _tag(element) == "workbookPr":
            dates_from_1904 = element.get("date1904") in ("1", "true")
        elif _tag(element) == "sheet" and sheet is None:
            link = next(v for k, v in element.attrib.items() if k.rpartition("}")[2] == "id")
            sheet = targets[link]
    if sheet is None:
        raise ValueError("workbook without sheets")
    return (sheet.lstrip("/") if sheet.startswith("/") else f"xl/{sheet}"), dates_from_1904


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    table = ElementTree.fromstring(book.read("xl/sharedStrings.xml"))
    return [_text_of(item) for item in table if _tag(item) == "si"]


def _date_styles(book: zipfile.ZipFile) -> frozenset[str]:
    """Numbers of the cell styles whose number format shows a date or time."""
    styles = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {}
    for element in styles.iter():
        if _tag(element) == "numFmt":
            code = re.sub(r'"[^"]*"|\\.|\[[^\]]*\]', "", element.get("formatCode", ""))
            custom[int(element.get("numFmtId"))] = bool(re.search("[dmyhs]", code, re.I))
    for element in styles:
        if _tag(element) == "cellXfs":
            formats = [int(style.get("numFmtId", "0")) for style in element]
            return frozenset(
                str(i)
                for i, number in enumerate(formats)
                if custom.get(number, number in BUILT_IN_DATE_FORMATS)
            )
    return frozenset()


def _column_number(letters: str) -> int:
    """Column of letters such as ``AB``, counted from 0."""
    number = 0
    for letter in letters:
        number = number * 26 + ord(letter.upper()) - ord("A") + 1
    return number - 1


def _cell_text(
    kind: str,
    style: str,
    value: str,
    strings: list[str],
    date_styles: frozenset[str],
    dates_from_1904: bool,
) -> str | None:
    if kind == "inlineStr" or kind == "str":
        return value
    if kind == "e" or not value:
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    if kind != "n":
        return value
    if style in date_styles:
        return _serial_to_text(float(value), dates_from_1904)
    if value.isdigit():
        return value
    number = float(value)
    if number.is_integer() and abs(number) < 2**53:
        return str(int(number))
    return value


def _serial_to_text(serial: float, dates_from_1904: bool) -> str:
    """ISO text of a date serial, rounded to the millisecond Excel shows."""
    epoch = datetime(1904, 1, 1) if dates_from_1904 else datetime(1899, 12, 30)
    if not dates_from_1904 and serial < 60:
        # Day 60 stands for a 29 February 1900 that never was; earlier serials are one day off.
        epoch += timedelta(days=1)
    return str(epoch + timedelta(milliseconds=round(serial * 86_400_000)))


"""Workbook copies of a frame, so that the Excel reader can be run over the given tables."""

from __future__ import annotations

import io
import sys
import zipfile
from collections.abc import Iterator
from datetime import date, datetime
from xml.sax.saxutils import escape

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Ship these functions with the job: executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_NS = "http://schemas.openxmlformats.org"
_WORKBOOK = (
    f'<workbook xmlns="{_NS}/spreadsheetml/2006/main" '
    f'xmlns:r="{_NS}/officeDocument/2006/relationships">'
    '<sheets><sheet name="data" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_LINKS = (
    f'<Relationships xmlns="{_NS}/package/2006/relationships"><Relationship Id="rId1" '
    f'Type="{_NS}/officeDocument/2006/relationships/worksheet" '
    'Target="worksheets/sheet1.xml"/></Relationships>'
)
_STYLES = (
    f'<styleSheet xmlns="{_NS}/spreadsheetml/2006/main">'
    '<cellXfs><xf numFmtId="0"/><xf numFmtId="22"/></cellXfs></styleSheet>'
)


def workbook_bytes(header: list[str], rows: Iterator[tuple]) -> bytes:
    """A one-sheet workbook: numbers as numbers, times as styled serials, the rest inline text."""
    lines = ["<row>" + "".join(_cell(name) for name in header) + "</row>"]
    lines += ["<row>" + "".join(_cell(value) for value in row) + "</row>" for row in rows]
    sheet = (
        f'<worksheet xmlns="{_NS}/spreadsheetml/2006/main"><sheetData>'
        + "".join(lines)
        + "</sheetData></worksheet>"
    )
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        book.writestr("xl/workbook.xml", _WORKBOOK)
        book.writestr("xl/_rels/workbook.xml.rels", _LINKS)
        book.writestr("xl/styles.xml", _STYLES)
        book.writestr("xl/worksheets/sheet1.xml", sheet)
    return out.getvalue()


def _cell(value: object) -> str:
    if value is None or value is pd.NaT or value != value:
        return "<c/>"
    if isinstance(value, date):
        moment = value if isinstance(value, datetime) else datetime(value.year, value.month, value.day)
        days = (moment - datetime(1899, 12, 30)).total_seconds() / 86400
        return f'<c s="1"><v>{days!r}</v></c>'
    if isinstance(value, str):
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'
    return f"<c><v>{value}</v></c>"


def as_workbooks(df: DataFrame) -> DataFrame:
    """Workbooks as a binary column content, each holding one batch of df's rows."""
    names = df.columns

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = batch.itertuples(index=False, name=None)
            yield pd.DataFrame({"content": [workbook_bytes(names, rows)]})

    return df.mapInPandas(write, "content binary")

"""Landing readers, workbooks, quarantine, metrics, staging."""

from __future__ import annotations

import io
import os
import zipfile
from datetime import date, datetime

import pyspark.sql.functions as F
import pytest
from pyspark.sql import types as T

from sparkgate.errors import StorageReadError
from sparkgate.functions.conform import conform, empty_frame, union_frames
from sparkgate.functions.names import (
    archive_folder,
    archive_key,
    bucket_name,
    is_items_workbook,
    is_orders_workbook,
    safe_execution_id,
)
from sparkgate.queries.workbook_copies import workbook_bytes
from sparkgate.schemas import ORDER_ITEMS_SCHEMA, ORDERS_SCHEMA, PRODUCTS_SCHEMA
from sparkgate.sources.excel import read_workbooks, sheet_rows
from sparkgate.sources.landing import (
    list_files,
    read_csv,
    read_json_lines,
    write_json_lines,
)
from sparkgate.sources.quarantine import read_quarantine, write_to_quarantine
from sparkgate.sources.run_metrics import emit_job_metrics, read_metrics
from sparkgate.sources.staging import StagingArea

HEADER = ORDERS_SCHEMA.fieldNames()
ORDER = (1, 101, 11, datetime(2025, 4, 1, 8, 15), 25.99, date(2025, 4, 1))


def put(folder, name, content):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(content if isinstance(content, bytes) else content.encode())
    return str(folder)


def test_csv_takes_only_csv_files_and_nulls_what_does_not_parse(spark, tmp_path):
    text = "product_id,department_id,department,product_name\n1,4,produce,Pears\nx,4,,Figs\n,5,\"\",\"a, b\"\n"
    folder = put(tmp_path, "products.csv", text)
    put(tmp_path, "orders.json", '{"product_id": 9}\n')
    rows = [tuple(r) for r in read_csv(spark, folder, PRODUCTS_SCHEMA).collect()]
    assert rows == [(1, 4, "produce", "Pears"), (None, 4, None, "Figs"), (None, 5, None, "a, b")]


def test_missing_folder(spark, tmp_path):
    for read in (
        lambda p: read_csv(spark, p, PRODUCTS_SCHEMA),
        lambda p: list_files(spark, p),
        lambda p: read_workbooks(spark, p, ORDERS_SCHEMA),
    ):
        with pytest.raises(StorageReadError) as caught:
            read(str(tmp_path / "nowhere")).count()
        assert "nowhere" in caught.value.location


def test_json_lines_keep_nulls(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.createDataFrame([(1, None), (None, "x")], "a int, b string")
    write_json_lines(df, path)
    lines = spark.read.text(path).collect()
    assert sorted(r.value for r in lines) == ['{"a":1,"b":null}', '{"a":null,"b":"x"}']
    assert sorted(map(tuple, read_json_lines(spark, path, df.schema).collect()), key=str) == [
        (1, None), (None, "x")]


def test_listing_reads_names_only_and_goes_into_subfolders(spark, tmp_path):
    assert list_files(spark, str(put(tmp_path / "in", "skip.txt", "x"))).count() == 1
    put(tmp_path / "in" / "deep", "Order_Items_1.XLSX", b"zz")
    put(tmp_path / "in", "orders.xlsx", b"z")
    found = list_files(spark, str(tmp_path / "in"), is_items_workbook(F.col("file_name")))
    assert [(r.file_name, r.length) for r in found.collect()] == [("Order_Items_1.XLSX", 2)]
    (tmp_path / "void").mkdir()
    assert list_files(spark, str(tmp_path / "void")).count() == 0


def test_workbooks_are_routed_by_name_and_typed(spark, tmp_path):
    put(tmp_path, "orders_apr.XLSX", workbook_bytes(HEADER, [ORDER, (2, None, 12, None, 1, None)]))
    put(tmp_path, "orders_may.xlsx", workbook_bytes(
        ["extra", "order_id", "total_amount"], [("x", 7, 3)]))
    put(tmp_path, "order_items.xlsx", workbook_bytes(["id", "order_id"], [(5, 101)]))
    orders = read_workbooks(
        spark, str(tmp_path), ORDERS_SCHEMA, wanted=is_orders_workbook(F.col("file_name")))
    assert orders.dtypes == [(f.name, f.dataType.simpleString()) for f in ORDERS_SCHEMA]
    assert sorted(map(tuple, orders.collect()), key=lambda r: r[4]) == [
        (2, None, 12, None, 1.0, None),
        (None, 7, None, None, 3.0, None),
        ORDER,
    ]
    items = read_workbooks(
        spark, str(tmp_path), ORDER_ITEMS_SCHEMA, wanted=is_items_workbook(F.col("file_name")))
    assert [(r.id, r.order_id, r.reordered) for r in items.collect()] == [(5, 101, None)]


def test_no_workbooks_means_no_rows(spark, tmp_path):
    folder = put(tmp_path, "products.csv", "a\n1\n")
    df = read_workbooks(spark, folder, ORDERS_SCHEMA)
    assert df.columns == HEADER and df.count() == 0
    assert empty_frame(spark, ORDERS_SCHEMA).dtypes == df.dtypes


def test_many_rows_come_in_batches(spark, tmp_path):
    rows = [(n, n) for n in range(25_000)]
    folder = put(tmp_path, "orders.xlsx", workbook_bytes(["order_num", "order_id"], rows))
    df = read_workbooks(spark, folder, ORDERS_SCHEMA)
    assert df.agg(F.count("*"), F.sum("order_id")).first() == (25_000, sum(range(25_000)))


def test_parser_reads_what_other_writers_produce():
    """Shared and rich strings, custom date formats, skipped cells, errors, the second sheet."""
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    parts = {
        "xl/workbook.xml": f'<workbook {main} {rel}><workbookPr/><sheets>'
        '<sheet name="b" sheetId="4" r:id="rId9"/><sheet name="a" sheetId="1" r:id="rId1"/>'
        "</sheets></workbook>",
        "xl/_rels/workbook.xml.rels": "<Relationships>"
        '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId9" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f"<sst {main}><si><t>plain</t></si>"
        "<si><r><t>ri</t></r><r><t>ch</t></r><rPh><t>no</t></rPh></si></sst>",
        "xl/styles.xml": f'<styleSheet {main}><numFmts><numFmt numFmtId="170" '
        'formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="171" formatCode="0.00&quot;days&quot;"/>'
        '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="170"/><xf numFmtId="171"/></cellXfs>'
        "</styleSheet>",
        "xl/worksheets/sheet1.xml": f"<worksheet {main}><sheetData/></worksheet>",
        "xl/worksheets/sheet2.xml": f"<worksheet {main}><sheetData>"
        '<row><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
        '<row><c r="B2" s="1"><v>45748</v></c><c r="D2" s="2"><v>2.5</v></c>'
        '<c r="AA2" t="b"><v>1</v></c><c r="AB2" t="e"><v>#N/A</v></c>'
        '<c r="AC2" t="str"><v>made</v></c><c r="AD2"><v>1.2E3</v></c>'
        '<c r="AE2" s="1"><v>59</v></c></row>'
        "</sheetData></worksheet>",
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as book:
        for name, content in parts.items():
            book.writestr(name, content)
    assert list(sheet_rows(out.getvalue())) == [
        {0: "plain", 2: "rich"},
        {1: "2025-04-01 00:00:00", 3: "2.5", 26: "true", 28: "made", 29: "1200",
         30: "1900-02-28 00:00:00"},
    ]


def test_conform_casts_fills_and_orders(spark):
    df = spark.createDataFrame(
        [("7", float("nan"), "no", 1), ("x", 3.0, "2025-04-01", 2)],
        "b string, a double, c string, spare int",
    )
    schema = T.StructType.fromDDL("a int, b bigint, c date, d double")
    assert [tuple(r) for r in conform(df, schema).collect()] == [
        (None, 7, None, None), (3, None, date(2025, 4, 1), None)]
    text = spark.createDataFrame([("12.5", "9007199254740993")], "a string, b string")
    assert tuple(conform(text, schema, loose_numbers=True).first())[:2] == (12, 9007199254740993)


def test_union_by_name(spark):
    left = spark.createDataFrame([(1, "x")], "a int, b string")
    right = spark.createDataFrame([("y", 2)], "b string, a int")
    only = spark.createDataFrame([(3,)], "a int")
    assert sorted(map(tuple, union_frames([left, right, only]).collect())) == [
        (1, "x"), (2, "y"), (3, None)]


def test_quarantine_appends_and_replaces(spark, tmp_path):
    base = str(tmp_path / "q")
    df = spark.createDataFrame(
        [(1, date(2025, 1, 1), "bad")], "id int, date date, __error_reason__ string")
    assert write_to_quarantine(df.limit(0), base, "t", "run:1/2", "2025-04-01") == 0
    assert not os.path.exists(base)
    assert write_to_quarantine(df, base, "t", "run:1/2", "2025-04-01") == 1
    assert os.path.isdir(f"{base}/table=t/run_date=2025-04-01/execution_id=run_1_2")
    write_to_quarantine(df, base, "t", "run:1/2", "2025-04-01")
    write_to_quarantine(df, base, "t", "other", "2025-04-01")
    assert read_quarantine(spark, base, "t").count() == 3
    # The same run again, a day later: its rejects are there once.
    write_to_quarantine(df, base, "t", "run:1/2", "2025-04-02", replace=True)
    back = read_quarantine(spark, base, "t").orderBy("execution_id").collect()
    assert [(r.execution_id, str(r.run_date), str(r.date)) for r in back] == [
        ("other", "2025-04-01", "2025-01-01"), ("run_1_2", "2025-04-02", "2025-01-01")]
    assert safe_execution_id("a:b/c") == "a_b_c"


def test_metrics_append(spark, tmp_path):
    path = str(tmp_path / "m")
    for rejected in (1, 2):
        emit_job_metrics(
            spark, path, job_name="j", environment="e", records_in=5, records_valid=5 - rejected,
            records_rejected=rejected, rows_inserted=1, rows_updated=2, duration_ms=3)
    assert sorted(r.records_rejected for r in read_metrics(spark, path).collect()) == [1, 2]


def test_staging_lies_in_the_checkpoint_folder_and_goes_away(spark):
    with StagingArea(spark, "test") as area:
        assert area.path.startswith(spark.conf.get("spark.checkpoint.dir"))
        back = area.write(spark.range(3).selectExpr("id", "id = 1 as odd"), "x", partition_by=["odd"])
        assert back.columns == ["id", "odd"] and back.count() == 3
        assert os.path.isdir(area.path.removeprefix("file:"))
    assert not os.path.isdir(area.path.removeprefix("file:"))


def test_name_columns(spark):
    keys = ["incoming/a+b%20c.xlsx", "plain", "bad%zz/x"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    day = F.lit("2025-04-09").cast("date")
    assert [r[0] for r in df.select(archive_key(F.col("k"), day)).collect()] == [
        "YYYY=2025/MM=04/DD=09/a b c.xlsx", "YYYY=2025/MM=04/DD=09/plain",
        "YYYY=2025/MM=04/DD=09/x"]
    assert archive_folder(date(2025, 4, 9)) == "YYYY=2025/MM=04/DD=09"
    bucket = spark.createDataFrame([("s3://b/",), ("b",)], "b string").select(bucket_name(F.col("b")))
    assert [r[0] for r in bucket.collect()] == ["b", "b"]


def test_a_scope_clears_what_was_staged_inside(spark, tmp_path):
    from sparkgate.sources.staging import StagingArea, staging_root, staging_scope

    def left():
        return {name for name in os.listdir(f"{staging_root(spark)}/sparkgate")}

    outer = StagingArea(spark, "outer")
    kept = outer.write(spark.range(3).toDF("n"), "kept")
    before = left()
    with staging_scope():
        inner = StagingArea(spark, "inner").write(spark.range(9).toDF("n"), "rows")
        with staging_scope():
            StagingArea(spark, "innermost").write(inner, "rows")
            assert len(left() - before) == 2
        assert len(left() - before) == 1
        result = outer.write(inner.filter("n > 5"), "result")
    assert left() == before and result.count() == kept.count() == 3
    with pytest.raises(ValueError, match="stop"):
        with staging_scope():
            StagingArea(spark, "inner").write(spark.range(2).toDF("n"), "rows")
            raise ValueError("stop")
    assert left() == before
    outer.drop("kept")
    assert os.listdir(outer.path) == ["result"]

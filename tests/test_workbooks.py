"""Native times of workbooks, and the active sheet."""

import io
import zipfile

from pyspark.sql import functions as F

from tracklane.functions import parse
from tracklane.sources import files

M = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
R = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"


def test_native_times_of_the_active_sheet(spark):
    cells = f'<c r="A1" s="1"><v>{172 / 86400}</v></c><c r="B1" s="2"><v>{172 / 1440}</v></c><c r="C1" s="3"><v>{172 / 86400}</v></c><c r="D1"><v>0.5</v></c><c r="E1" s="2"><v>45000</v></c>'
    parts = {
        "xl/workbook.xml": f'<workbook {M} xmlns:r="{R}"><bookViews><workbookView activeTab="1"/></bookViews><sheets><sheet name="a" r:id="r1"/><sheet name="b" r:id="r2"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/styles.xml": f'<styleSheet {M}><numFmts><numFmt numFmtId="164" formatCode="[mm]:ss"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="46"/><xf numFmtId="20"/><xf numFmtId="164"/></cellXfs></styleSheet>',
        "xl/worksheets/sheet1.xml": f"<worksheet {M}><sheetData><row><c><v>1</v></c></row></sheetData></worksheet>",
        "xl/worksheets/sheet2.xml": f"<worksheet {M}><sheetData><row>{cells}</row></sheetData></worksheet>",
    }
    book = io.BytesIO()
    with zipfile.ZipFile(book, "w") as z:
        for name, x in parts.items():
            z.writestr(name, x)
    got = files.sheet_cells(book.getvalue())
    assert got == [["0:02:52", "T02:52:00", "0:02:52", "0.5", "45000"]]
    rows = spark.createDataFrame([(x,) for x in got[0][:3]], "x string").select(parse.length_seconds_long(F.col("x")), parse.play_time_ampm(F.col("x"))).collect()
    assert [tuple(r) for r in rows] == [(172, "0:02:52"), (172, "02:52:00"), (172, "0:02:52")]

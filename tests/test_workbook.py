"""Workbooks: round trips, what other programs write, ranges, blank rows, write-back; Word documents."""

import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from firmlens.sources import files, workbook

SCHEMA = workbook.SCHEMA


def book(sheets, names=None, shared=None, styles=None, extra=""):
    """A workbook as other programs write it: sheets as XML rows."""
    out = io.BytesIO()
    names = names or [f"S{i}" for i in range(len(sheets))]
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="m" xmlns:r="r">{extra}<bookViews><workbookView activeTab="{len(sheets) - 1}"/></bookViews><sheets>' + "".join(f'<sheet name="{n}" sheetId="{i + 1}" r:id="rId{i}"/>' for i, n in enumerate(names)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", "<Relationships>" + "".join(f'<Relationship Id="rId{i}" Target="{"/xl/" if i else ""}worksheets/x{i}.xml"/>' for i in range(len(sheets))) + "</Relationships>")
        for i, rows in enumerate(sheets):
            z.writestr(f"xl/worksheets/x{i}.xml", f'<worksheet xmlns="m"><sheetData>{rows}</sheetData></worksheet>')
        if shared:
            z.writestr("xl/sharedStrings.xml", f'<sst xmlns="m">{shared}</sst>')
        if styles:
            z.writestr("xl/styles.xml", styles)
    return out.getvalue()


def read(body, sheet=-1):
    b = workbook.Workbook(io.BytesIO(body))
    return list(b.rows(b.sheets[sheet][1]))


def test_kinds_of_cells():
    styles = '<styleSheet xmlns="m"><numFmts><numFmt numFmtId="200" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="201" formatCode="0.0 &quot;days&quot;"/></numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="200"/><xf numFmtId="201"/></cellXfs></styleSheet>'
    shared = "<si><t>one</t></si><si><r><t>tw</t></r><r><t>o</t></r><rPh><t>x</t></rPh></si>"
    row = '<row r="2"><c r="B2" t="s"><v>0</v></c><c r="D2" t="s"><v>1</v></c><c t="n"><v>5</v></c><c><v>0.1</v></c><c><v>1E3</v></c><c t="b"><v>1</v></c><c t="e"><v>#N/A</v></c><c t="str"><f>A1</f><v>f</v></c><c s="1"><v>45292</v></c><c s="2"><v>45292.5</v></c><c s="3"><v>2</v></c><c r="AB2" t="inlineStr"><is><t> in </t></is></c></row>'
    ((number, cells),) = read(book([row], shared=shared, styles=styles))
    assert number == 2 and len(cells) == 28
    assert cells[:13] == [None, "one", None, "two", "5", "0.1", "1000.0", "True", "#N/A", "f", "2024-01-01 00:00:00", "2024-01-01 12:00:00", "2"] and cells[27] == " in "
    ((_, cells),) = read(book(['<row><c s="1"><v>0</v></c></row>'], styles=styles, extra='<workbookPr date1904="1"/>'))
    assert cells == ["1904-01-01 00:00:00"]


def test_letters_and_columns():
    assert [workbook._letters(i) for i in (0, 25, 26, 701, 702, 16383)] == ["A", "Z", "AA", "ZZ", "AAA", "XFD"]
    assert all(workbook._column(workbook._letters(i) + "7") == i for i in range(0, 16384, 37))


def table(rng, files=3):
    rows = []
    for f in range(files):
        for s in range(rng.randint(1, 3)):
            width = rng.randint(1, 4)
            rows.append((f"f{f}.xlsx", f"Übersicht & {s}", s, 1, [f"h{k}" for k in range(width)]))
            rows += [(f"f{f}.xlsx", f"Übersicht & {s}", s, n, [rng.choice(["", None, "<a & 'b'>", "ü\n x ", "12"]) for _ in range(width)]) for n in range(2, rng.randint(2, 40))]
    return rows


def test_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(workbook, "HELD", 100)
    rows = table(random.Random(1))
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    workbook.write_workbooks(df, f"file://{tmp_path}/w")
    assert sorted(p.name for p in (tmp_path / "w").iterdir()) == ["f0.xlsx", "f1.xlsx", "f2.xlsx"]
    trim = lambda cells: cells[: max((i + 1 for i, c in enumerate(cells) if c is not None), default=0)]  # noqa: E731  empty cells at a row's end aren't written
    want = sorted((f, s, i, n, tuple(trim(c)), ) for f, s, i, n, c in rows)
    for path in (f"file://{tmp_path}/w", f"{tmp_path}/w"):
        assert sorted((r.file, r.sheet, r.sheet_no, r.row_no, tuple(r.cells)) for r in workbook.sheet_rows(spark, path).collect()) == want
    one = workbook.sheet_rows(spark, f"{tmp_path}/w/f1.xlsx", sheet="Übersicht & 0", rows="3-5")
    assert sorted(r.row_no for r in one.collect()) == [n for n in (1, 4, 5, 6) if any(r[0] == "f1.xlsx" and r[2] == 0 and r[3] == n for r in rows)]
    with pytest.raises(Exception, match="no such sheet"):
        workbook.sheet_rows(spark, f"{tmp_path}/w/f1.xlsx", sheet="none").collect()
    with pytest.raises(Exception, match="1048576"):
        workbook.write_workbooks(spark.createDataFrame([("x.xlsx", "s", 0, 1 << 21, ["a"])], SCHEMA), f"{tmp_path}/x")


def cells(n, *values):
    return f'<row r="{n}">' + "".join(f'<c t="inlineStr"><is><t>{v}</t></is></c>' for v in values) + "</row>"


def test_smart_scan_of_the_active_sheet(spark, tmp_path):
    body = cells(1, " Company ", "Company", "") + cells(2, "a", "x", "1") + cells(3, "", " ", "") + cells(6, "b", "y") + cells(7, "c") + cells(10, "never")
    (tmp_path / "b.xlsx").write_bytes(book([cells(1, "no"), body]))
    path = str(tmp_path / "b.xlsx")
    got = workbook.read_workbook(spark, path, stop_blank=4)
    assert got.columns == ["row_id", "Company", "Company__2", "column_3"]
    assert sorted(map(tuple, got.collect())) == [(1, "a", "x", "1"), (5, "b", "y", ""), (6, "c", "", ""), (9, "never", "", "")]
    assert [r[0] for r in workbook.read_workbook(spark, path, stop_blank=3).collect()] == [1]
    assert [r[0] for r in workbook.read_workbook(spark, path, stop_blank=3, rows="5-").collect()] == [5, 6, 9]
    assert [r[0] for r in workbook.read_workbook(spark, path, stop_blank=2, rows="5-").collect()] == [5, 6]
    assert [r[0] for r in workbook.read_workbook(spark, path, stop_blank=3, rows="2-").collect()] == []
    assert workbook.read_workbook(spark, path, stop_blank=None).count() == 5
    assert workbook.read_workbook(spark, path, sheet="S0").columns == ["row_id", "no"]


def test_union_write_back_and_column(spark, tmp_path):
    rows = [("w.xlsx", "A", 0, 1, ["Name", "Website"]), ("w.xlsx", "A", 0, 2, ["a", "http://a"]), ("w.xlsx", "A", 0, 3, ["b", " "]), ("w.xlsx", "B", 1, 1, ["Website", "Extra"]), ("w.xlsx", "B", 1, 2, ["http://c"])]
    raw = spark.createDataFrame(rows, SCHEMA)
    got = workbook.union_sheets(raw)
    assert got.columns == ["SourceWorkbook", "SourceSheet", "SourceSheetRowNumber", "Name", "Website", "Extra"]
    assert sorted(map(tuple, got.collect()), key=repr) == [("w.xlsx", "A", 2, "a", "http://a", None), ("w.xlsx", "B", 2, None, "http://c", "")]
    assert workbook.union_sheets(raw, website=None).count() == 3
    res = spark.createDataFrame([("w.xlsx", "A", 3, "+49"), ("w.xlsx", "A", 3, "+41"), ("w.xlsx", "B", 2, "\x01+43"), ("w.xlsx", "B", 9, "x"), ("w.xlsx", "A", 1, "not the header")], "file string, sheet string, row_no long, phone string")
    back = workbook.append_columns(raw, res.where("row_no > 1"), ["phone"])
    assert {(r.sheet, r.row_no): r.cells for r in back.collect()} == {("A", 1): ["Name", "Website", "phone"], ("A", 2): ["a", "http://a", ""], ("A", 3): ["b", " ", "+49"], ("B", 1): ["Website", "Extra", "phone"], ("B", 2): ["http://c", None, "+43"]}
    own = workbook.set_column(raw, res, 1, "phone")
    assert {(r.sheet, r.row_no): r.cells for r in own.collect()} == {("A", 1): ["Name", "Website"], ("A", 2): ["a", "http://a"], ("A", 3): ["b", "+49"], ("B", 1): ["Website", "Extra"], ("B", 2): ["http://c", "+43"]}
    workbook.write_workbooks(back, f"{tmp_path}/o")
    assert workbook.union_sheets(workbook.sheet_rows(spark, f"{tmp_path}/o")).select("phone").where(F.col("phone") != "").count() == 1


def test_word_documents(spark, tmp_path):
    def doc(name, xml):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            z.writestr("word/document.xml", f'<w:document xmlns:w="w">{xml}</w:document>')

    par = lambda *ts: "<w:p>" + "".join(f"<w:r><w:t>{t}</w:t></w:r>" for t in ts) + "</w:p>"
    doc("B.docx", par("one ", "two") + par(" ") + par("x"))
    doc("a.docx", par("y" * 50))
    (tmp_path / "broken.docx").write_bytes(b"no zip")
    got = {r.path.rpartition("/")[2]: r.text for r in files.document_texts(spark, str(tmp_path)).collect()}
    assert got == {"B.docx": "one two\nx", "a.docx": "y" * 50, "broken.docx": None}
    texts = spark.createDataFrame([("p", n, t) for n, t in got.items()] + [("p", "c.docx", "later"), ("q", "z", "  ")], "partner string, file string, text string")
    whole = "=== FILE: a.docx ===\n" + "y" * 50 + "\n\n=== FILE: B.docx ===\none two\nx\n\n=== FILE: c.docx ===\nlater"
    for most in (10, 60, 71, 73, 100, len(whole), 1000):
        assert [tuple(r) for r in files.document_bundles(texts, "partner", most).collect()] == [("p", whole if len(whole) <= most else whole[:most] + "\n\n[TRUNCATED]")]


def test_texts_are_read_whole(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.txt").write_text('{\n "k": 1\n}\n')
    assert [r.text for r in files.read_texts(spark, str(tmp_path), "*.txt").collect()] == ['{\n "k": 1\n}\n']

"""Workbooks (.xlsx) as a Spark data source: rows of sheets are read and written as streams over zip and XML."""

from __future__ import annotations

import datetime
import re
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from firmlens.functions.text import blank_to_null, report_cell
from firmlens.shared import find_package, open_store
from firmlens.sources.delimited import parse_range, unique_names

SCHEMA = "file string, sheet string, sheet_no int, row_no long, cells array<string>"
ARROW = pa.schema([("file", pa.string()), ("sheet", pa.string()), ("sheet_no", pa.int32()), ("row_no", pa.int64()), ("cells", pa.list_(pa.string()))])
#: What the format allows in a sheet, rows that are read at a time, and bytes of a sheet's text that are held back before they go out.
MOST_ROWS, BATCH, HELD = 1_048_576, 2048, 1 << 20
#: Numbers of the built-in formats that show dates or times.
DATE_FORMATS = frozenset([*range(14, 23), *range(45, 48)])


# ---------------------------------------------------------------- reading

def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


class Workbook:
    """An open workbook: its sheets in order, and the rows of one as a stream."""

    def __init__(self, file):
        self.zip = zipfile.ZipFile(file)
        book = ElementTree.fromstring(self.zip.read("xl/workbook.xml"))
        targets = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(self.zip.read("xl/_rels/workbook.xml.rels"))}
        self.sheets, self.active, self.epoch = [], 0, datetime.datetime(1899, 12, 30)
        for e in book.iter():
            if _local(e.tag) == "sheet":
                target = targets[next(v for k, v in e.attrib.items() if _local(k) == "id")]
                self.sheets.append((e.get("name"), target.lstrip("/") if target.startswith("/") else f"xl/{target}"))
            elif _local(e.tag) == "workbookView":
                self.active = int(e.get("activeTab", 0))
            elif _local(e.tag) == "workbookPr" and e.get("date1904") in ("1", "true"):
                self.epoch = datetime.datetime(1904, 1, 1)
        self._strings: list[str] | None = None
        self._dates: list[bool] | None = None

    def _parts(self, name: str, tag: str) -> Iterator[ElementTree.Element]:
        """Elements of a tag, each forgotten when the next is asked for."""
        with self.zip.open(name) as f:
            stack: list[ElementTree.Element] = []
            for event, e in ElementTree.iterparse(f, ("start", "end")):
                if event == "start":
                    stack.append(e)
                    continue
                stack.pop()
                if _local(e.tag) == tag:
                    yield e
                    e.clear()
                    if stack:
                        stack[-1].remove(e)

    def strings(self) -> list[str]:
        """The strings that cells share."""
        if self._strings is None:
            found = "xl/sharedStrings.xml" in self.zip.namelist()
            self._strings = [_text(e) for e in self._parts("xl/sharedStrings.xml", "si")] if found else []
        return self._strings

    def dates(self) -> list[bool]:
        """Whether cells of each style show a date or time."""
        if self._dates is None:
            self._dates = []
            if "xl/styles.xml" in self.zip.namelist():
                styles = ElementTree.fromstring(self.zip.read("xl/styles.xml"))
                own = {int(e.get("numFmtId")): e.get("formatCode", "") for e in styles.iter() if _local(e.tag) == "numFmt"}
                shown = lambda n: n in DATE_FORMATS or bool(re.search("[dmyhs]", re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", own.get(n, "")), re.I) and own[n] != "General")
                cells = next((e for e in styles if _local(e.tag) == "cellXfs"), ())
                self._dates = [shown(int(e.get("numFmtId", 0))) for e in cells]
        return self._dates

    def value(self, cell: ElementTree.Element) -> str | None:
        """A cell's value as text; null for an empty one."""
        kind = cell.get("t", "n")
        if kind == "inlineStr":
            return next((_text(e) for e in cell if _local(e.tag) == "is"), None)
        raw = next((e.text for e in cell if _local(e.tag) == "v"), None)
        if raw is None:
            return None
        if kind == "s":
            return self.strings()[int(raw)]
        if kind == "b":
            return "True" if raw.strip() == "1" else "False"
        if kind != "n":
            return raw
        number = float(raw) if re.search("[.eE]", raw) else int(raw)
        style = int(cell.get("s", 0))
        if style < len(self.dates()) and self.dates()[style]:
            return str((self.epoch + datetime.timedelta(days=float(number))).replace(microsecond=0))
        return str(number)

    def rows(self, path: str) -> Iterator[tuple[int, list[str | None]]]:
        """Rows that a sheet holds, with their numbers from 1; rows that it doesn't mention are empty."""
        last = 0
        for row in self._parts(path, "row"):
            last = int(row.get("r", last + 1))
            cells: list[str | None] = []
            for c in row:
                if _local(c.tag) == "c":
                    at = _column(c.get("r")) if c.get("r") else len(cells)
                    cells += [None] * (at - len(cells) + 1)
                    cells[at] = self.value(c)
            yield last, cells


def _text(e: ElementTree.Element) -> str:
    """The text of a string with its runs, without reading aids."""
    return "".join((t.text or "") for part in e if _local(part.tag) in ("t", "r") for t in ([part] if _local(part.tag) == "t" else part) if _local(t.tag) == "t")


def _column(reference: str) -> int:
    """0 for A1, 27 for AB3."""
    n = 0
    for c in reference:
        if not c.isalpha():
            break
        n = n * 26 + ord(c.upper()) - 64
    return n - 1


def _letters(at: int) -> str:
    out = ""
    at += 1
    while at:
        at, rest = divmod(at - 1, 26)
        out = chr(65 + rest) + out
    return out


@dataclass
class Sheet(InputPartition):
    file: str
    name: str
    number: int
    path: str


class WorkbookReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path = options["path"]
        self.wanted = options.get("sheet", "*")
        self.low, self.high = parse_range(options.get("rows"))
        self.stop = int(options.get("stopblank") or options.get("stopBlank") or 0)

    def files(self) -> list[str]:
        fs, path = open_store(self.path)
        if fs.get_file_info(path).type == pafs.FileType.File:
            return [self.path]
        found = fs.get_file_info(pafs.FileSelector(path, recursive=True))
        prefix = self.path[: len(self.path) - len(path)] if self.path.endswith(path) else "file://" if isinstance(fs, pafs.LocalFileSystem) else self.path.split("://")[0] + "://"
        return sorted(prefix + f.path for f in found if f.type == pafs.FileType.File and f.base_name.lower().endswith(".xlsx") and f.base_name[0] not in "~_.")

    def partitions(self) -> list[Sheet]:
        """A sheet each. Only the directory and the list of sheets of each workbook are read here."""
        out, asked = [], None if self.wanted in ("*", "active") else [x.strip() for x in self.wanted.split(",")]
        for uri in self.files():
            fs, path = open_store(uri)
            with fs.open_input_file(path) as f:
                book = Workbook(f)
                names = [n for n, _ in book.sheets]
                if asked and (missing := [x for x in asked if x not in names]):
                    raise ValueError(f"no such sheet in {uri}: {missing}")
                for i, (name, at) in enumerate(book.sheets):
                    if (asked is None or name in asked) and (self.wanted != "active" or i == book.active):
                        out.append(Sheet(uri, name, i, at))
        return out

    def read(self, part: Sheet) -> Iterator[pa.RecordBatch]:
        fs, path = open_store(part.file)
        name = part.file.rpartition("/")[2]
        with fs.open_input_file(path) as f:
            held: list[tuple] = []
            expected = blank = 0
            for number, cells in Workbook(f).rows(part.path):
                if number == 1:
                    held.append((name, part.name, part.number, 1, cells))
                    continue
                data = number - 1  # rows of data count from below the header
                if self.high is not None and data > self.high:
                    break
                if data < self.low:
                    continue
                if self.stop:
                    blank += data - max(expected or self.low, self.low)  # rows that the sheet doesn't mention
                    expected = data + 1
                    if blank >= self.stop:
                        break
                    if not any((c or "").strip() for c in cells):
                        blank += 1
                        if blank >= self.stop:
                            break
                        continue
                    blank = 0
                held.append((name, part.name, part.number, number, cells))
                if len(held) >= BATCH:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held), ARROW)], schema=ARROW)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*held), ARROW)], schema=ARROW)


# ---------------------------------------------------------------- writing

_XML = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_DOC = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPE = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_CONTROL = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f￾￿]")


class WorkbookWriter:
    """Writes a workbook front to back: rows come by sheet and number, nothing but a sheet's last lines is held."""

    def __init__(self, out):
        self.zip = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
        self.sheets: list[str] = []
        self.entry, self.lines, self.size = None, [], 0

    def row(self, sheet: str, number: int, cells: list[str | None]) -> None:
        if number > MOST_ROWS:
            raise ValueError(f"row {number} of {sheet}: a sheet has {MOST_ROWS} rows at most")
        if not self.sheets or self.sheets[-1] != sheet:
            self._end()
            if sheet in self.sheets:
                raise ValueError(f"rows of sheet {sheet} don't stand together")
            self.sheets.append(sheet)
            self.entry = self.zip.open(f"xl/worksheets/sheet{len(self.sheets)}.xml", "w", force_zip64=True)
            self.lines.append(f'{_XML}<worksheet xmlns="{_MAIN}"><sheetData>')
        text = "".join([f'<c r="{_letters(i)}{number}" t="inlineStr"><is><t xml:space="preserve">{escape(_CONTROL.sub("", c))}</t></is></c>' for i, c in enumerate(cells or []) if c is not None])
        self.lines.append(f'<row r="{number}">{text}</row>')
        self.size += len(text)
        if self.size > HELD:
            self._flush()

    def _flush(self) -> None:
        self.entry.write("".join(self.lines).encode())
        self.lines, self.size = [], 0

    def _end(self) -> None:
        if self.entry is not None:
            self.lines.append("</sheetData></worksheet>")
            self._flush()
            self.entry.close()
            self.entry = None

    def close(self) -> None:
        self._end()
        names = range(1, len(self.sheets) + 1)
        sheets = "".join([f'<sheet name={quoteattr(s)} sheetId="{i}" r:id="rId{i}"/>' for i, s in zip(names, self.sheets)])
        parts = {
            "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_DOC}"><bookViews><workbookView activeTab="0"/></bookViews><sheets>{sheets}</sheets></workbook>',
            "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}/relationships">' + "".join([f'<Relationship Id="rId{i}" Type="{_DOC}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in names]) + "</Relationships>",
            "_rels/.rels": f'<Relationships xmlns="{_PACKAGE}/relationships"><Relationship Id="rId1" Type="{_DOC}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
            "[Content_Types].xml": f'<Types xmlns="{_PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/>'
            f'<Override PartName="/xl/workbook.xml" ContentType="{_TYPE}.sheet.main+xml"/>' + "".join([f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{_TYPE}.worksheet+xml"/>' for i in names]) + "</Types>",
        }
        for name, body in parts.items():
            self.zip.writestr(name, _XML + body)
        self.zip.close()


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str]]


class WorkbookTaskWriter(DataSourceArrowWriter):
    """Each task writes the workbooks whose rows it has under names of its own; the driver renames them when all are whole."""

    def __init__(self, path: str):
        self.path = path

    def write(self, batches: Iterator[pa.RecordBatch]) -> Written:
        fs, folder = open_store(self.path)
        fs.create_dir(folder, recursive=True)
        done: list[tuple[str, str]] = []
        stream = book = None
        for batch in batches:
            for r in batch.to_pylist():
                if not done or done[-1][1] != r["file"]:
                    if book:
                        book.close()
                        stream.close()
                    if any(name == r["file"] for _, name in done):
                        raise ValueError(f"rows of {r['file']} don't stand together")
                    done.append((f"_{uuid.uuid4().hex}.part", r["file"]))
                    stream = fs.open_output_stream(f"{folder}/{done[-1][0]}", compression=None)
                    book = WorkbookWriter(stream)
                book.row(r["sheet"], r["row_no"], r["cells"])
        if book:
            book.close()
            stream.close()
        return Written(done)

    def commit(self, messages: list[Written | None]) -> None:
        fs, folder = open_store(self.path)
        for m in messages:
            for part, name in m.files if m else ():
                fs.move(f"{folder}/{part}", f"{folder}/{name}")

    def abort(self, messages: list[Written | None]) -> None:
        fs, folder = open_store(self.path)
        for m in messages:
            for part, _ in m.files if m else ():
                fs.delete_file(f"{folder}/{part}")


class WorkbookSource(DataSource):
    """format("workbook"). Reading: options path (a file or folder), sheet (`*`, `active` or names with commas), rows (a range of
    data rows) and stopBlank (drop blank rows and stop after so many). Writing: rows by file, sheet and row number."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> WorkbookReader:
        return WorkbookReader(self.options)

    def writer(self, schema, overwrite: bool) -> WorkbookTaskWriter:
        return WorkbookTaskWriter(self.options["path"])


# ---------------------------------------------------------------- tables

def sheet_rows(spark: SparkSession, path: str, *, sheet: str = "*", rows: str | None = None, stop_blank: int | None = None) -> DataFrame:
    """(file, sheet, sheet_no, row_no, cells) of workbooks: the header (row 1) and the data rows of the range. A task a sheet; a
    sheet that is larger than memory passes as a stream, a workbook's shared strings are held. Blank rows: see WorkbookSource."""
    find_package(spark)
    spark.dataSource.register(WorkbookSource)
    given = {"path": path, "sheet": sheet} | ({"rows": rows} if rows else {}) | ({"stopBlank": str(stop_blank)} if stop_blank else {})
    return spark.read.format("workbook").options(**given).load()


def union_sheets(raw: DataFrame, *, website: str | None = "Website") -> DataFrame:
    """The data rows of sheets as one table: SourceWorkbook, SourceSheet, SourceSheetRowNumber, then each column that some sheet
    has, by its header, first seen first; null where a sheet lacks it, '' for an empty cell. With website, rows without one go.

    Repeated names in a header get __2, __3, …; empty names are column_N. Headers, one row a sheet, are read first.
    """
    heads = raw.where("row_no = 1").select("file", "sheet_no", "sheet", "cells").collect()
    names = {(h["file"], h["sheet"]): unique_names([(c or "").removeprefix("﻿").strip() or f"column_{i + 1}" for i, c in enumerate(h["cells"])]) for h in sorted(heads, key=lambda h: (h["file"], h["sheet_no"]))}
    columns = list(dict.fromkeys(n for ns in names.values() for n in ns))
    spark = raw.sparkSession
    known = spark.createDataFrame([(f, s, ns) for (f, s), ns in names.items()], "file string, sheet string, names array<string>")
    held = F.expr("map_from_arrays(names, transform(names, (n, i) -> coalesce(get(cells, i), '')))")
    table = raw.where("row_no > 1").join(known, ["file", "sheet"]).withColumn("_held", held)
    out = table.select(F.col("file").alias("SourceWorkbook"), F.col("sheet").alias("SourceSheet"), F.col("row_no").alias("SourceSheetRowNumber"), *[F.col("_held")[F.lit(c)].alias(c) for c in columns])
    return out.where(blank_to_null(F.col(f"`{website}`")).isNotNull()) if website and website in columns else out


def read_workbook(spark: SparkSession, path: str, *, sheet: str = "active", rows: str | None = None, stop_blank: int | None = 3) -> DataFrame:
    """A workbook's sheet as a list, as read_delimited gives one: all columns text, row_id the place below the header; blank rows go,
    and all rows after stop_blank of them in a row."""
    table = union_sheets(sheet_rows(spark, path, sheet=sheet, rows=rows, stop_blank=stop_blank), website=None)
    return table.select((F.col("SourceSheetRowNumber") - 1).alias("row_id"), *[F.col(f"`{c}`") for c in table.columns[3:]])


def append_columns(raw: DataFrame, results: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of sheets with columns of results(file, sheet, row_no, …) of the same place behind their own: their names in the header,
    '' where there is no result; of several results of a place the greatest. Rows shorter than the header are filled up."""
    best = results.groupBy("file", "sheet", "row_no").agg(F.max(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in columns])).alias("_r"))
    width = raw.where("row_no = 1").select("file", "sheet", F.size("cells").alias("_width"))
    more = F.when(F.col("row_no") == 1, F.array(*[F.lit(c) for c in columns])).otherwise(F.array(*[F.coalesce(report_cell(F.col(f"_r.`{c}`")), F.lit("")) for c in columns]))
    padded = F.concat("cells", F.when(F.size("cells") < F.col("_width"), F.array_repeat(F.lit(None).cast("string"), F.col("_width") - F.size("cells"))).otherwise(F.array().cast("array<string>")))
    out = raw.join(best, ["file", "sheet", "row_no"], "left").join(width, ["file", "sheet"], "left")
    return out.select("file", "sheet", "sheet_no", "row_no", F.concat(F.when(F.col("_width").isNull(), F.col("cells")).otherwise(padded), more).alias("cells"))


def set_column(raw: DataFrame, results: DataFrame, index: int, value: str) -> DataFrame:
    """Rows of sheets with results(file, sheet, row_no, value) in the column of that index (from 0), where there is one; of several
    results of a place the greatest. Rows that are too short are filled up; the header stays."""
    best = results.where("row_no > 1").groupBy("file", "sheet", "row_no").agg(F.max(F.col(value).cast("string")).alias("_r"))
    full = F.concat("cells", F.array_repeat(F.lit(None).cast("string"), F.greatest(F.lit(0), F.lit(index + 1) - F.size("cells"))))
    new = F.transform(full, lambda c, i: F.when(i == index, report_cell(F.col("_r"))).otherwise(c))
    return raw.join(best, ["file", "sheet", "row_no"], "left").select("file", "sheet", "sheet_no", "row_no", F.when(F.col("_r").isNotNull(), new).otherwise(F.col("cells")).alias("cells"))


def write_workbooks(raw: DataFrame, folder: str) -> None:
    """Workbooks of rows(file, sheet, sheet_no, row_no, cells), one file a name. A workbook is one zip file, so one task writes it, row by
    row; the format bounds a sheet to MOST_ROWS. Files are seen under their names when all of them are whole."""
    find_package(raw.sparkSession)
    raw.sparkSession.dataSource.register(WorkbookSource)
    rows = raw.select("file", "sheet", F.col("sheet_no").cast("int").alias("sheet_no"), F.col("row_no").cast("long").alias("row_no"), F.col("cells").cast("array<string>").alias("cells"))
    dealt = rows.repartition("file").sortWithinPartitions("file", "sheet_no", "sheet", "row_no")
    dealt.write.format("workbook").mode("append").save(folder)

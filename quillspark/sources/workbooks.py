"""Workbooks (xlsx) as a data source: zipped XML, read and written row by row without another library.

    register(spark)
    spark.read.format("xlsx").option("sheet", "Statistics").load("run/final.xlsx")
    write_workbook({"Groups": groups, "Statistics": statistics}, "/shared/run/final.xlsx")

Reading: each workbook of a path or pattern is a task of its own, and its rows are streamed. The first row names the columns; a
header is probed on the driver, from the first workbook alone. Numbers are told as texts in their shortest form. Writing: a workbook has one file,
so its rows meet in one task, which streams them; a sheet holds no more than 1,048,576 rows with its header, and more raise an error:
such tables are exchanged as Parquet or CSV. Workbooks lie where executors and driver can open files (a shared mount).
"""

from __future__ import annotations

import glob
import os
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import StringType, StructField, StructType

from quillspark.functions.shipping import ship_package

#: Limits and name spaces of the format, and the fills of rows by their style.
MOST_ROWS, MOST_CHARS = 1_048_576, 32_767
MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
RELATIONS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
PACKAGE = "http://schemas.openxmlformats.org/package/2006"
FILLS = {"green": "FFC6EFCE", "orange": "FFFFD8A8", "yellow": "FFFFEB9C", "red": "FFFFC7CE", "blue": "FFBDD7EE"}
#: Characters that XML cannot hold.
UNSAID = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")


def local(path: str) -> str:
    return re.sub(r"\Afile:(?://)?(?=/)", "", path)


def column_name(i: int) -> str:
    """A, B, ... Z, AA, ..."""
    name = ""
    while i >= 0:
        name, i = chr(65 + i % 26) + name, i // 26 - 1
    return name


def column_number(reference: str) -> int:
    n = 0
    for c in re.match("[A-Z]+", reference).group():
        n = n * 26 + ord(c) - 64
    return n - 1


# --- reading


def sheet_file(book: zipfile.ZipFile, sheet: str | None) -> str | None:
    """The file of a sheet by its name, or of the first one; none if there is no such sheet."""
    targets = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
    for s in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{{{MAIN}}}sheet"):
        if sheet is None or s.get("name") == sheet:
            target = targets[s.get(f"{{{RELATIONS}}}id")]
            return target.lstrip("/") if target.startswith("/") else f"xl/{target}"
    return None


def shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    return ["".join(t.text or "" for t in item.iter(f"{{{MAIN}}}t")) for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml"))]


def cell_text(cell: ElementTree.Element, strings: list[str]) -> str | None:
    kind = cell.get("t")
    if kind == "inlineStr":
        return "".join(t.text or "" for t in cell.iter(f"{{{MAIN}}}t"))
    value = cell.findtext(f"{{{MAIN}}}v")
    if value is None or kind == "e":
        return None
    if kind == "s":
        return strings[int(value)]
    if kind == "b":
        return "true" if value == "1" else "false"
    return value


def sheet_rows(path: str, sheet: str | None) -> Iterator[list[str | None]]:
    """The rows of a sheet, empty ones left out; cells by their places."""
    with zipfile.ZipFile(local(path)) as book:
        name = sheet_file(book, sheet)
        if name is None:
            return
        strings = shared_strings(book)
        with book.open(name) as file:
            for _, row in ElementTree.iterparse(file):
                if row.tag != f"{{{MAIN}}}row":
                    continue
                cells: list[str | None] = []
                for i, cell in enumerate(row.iter(f"{{{MAIN}}}c")):
                    at = column_number(cell.get("r")) if cell.get("r") else i
                    cells += [None] * (at + 1 - len(cells))
                    cells[at] = cell_text(cell, strings)
                row.clear()
                if any(c is not None for c in cells):
                    yield cells


def header_of(path: str, sheet: str | None) -> list[str]:
    """The names of a sheet's columns; places without a name get one."""
    for row in sheet_rows(path, sheet):
        return [name if name else f"_c{i}" for i, name in enumerate(row)]
    return []


class Workbooks(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


class WorkbookReader(DataSourceReader):
    def __init__(self, paths: list[str], sheet: str | None, names: list[str]) -> None:
        self.paths, self.sheet, self.names = paths, sheet, names

    def partitions(self) -> list[Workbooks]:
        return [Workbooks(p) for p in self.paths]

    def read(self, partition: Workbooks) -> Iterator[tuple]:
        rows = sheet_rows(partition.path, self.sheet)
        own = next(rows, [])
        at = [own.index(n) if n in own else int(n[2:]) if re.fullmatch(r"_c\d+", n) else None for n in self.names]
        for row in rows:
            yield tuple(row[i] if i is not None and i < len(row) else None for i in at)


# --- writing


def style_sheet() -> str:
    """The fills as cell formats: 0 is plain, 1 a header, then the fills in their order."""
    fills = "".join(f'<fill><patternFill patternType="solid"><fgColor rgb="{c}"/></patternFill></fill>' for c in FILLS.values())
    formats = "".join(f'<xf numFmtId="0" fontId="0" fillId="{i + 2}" borderId="0" applyFill="1"/>' for i in range(len(FILLS)))
    return (
        f'<styleSheet xmlns="{MAIN}"><fonts count="2"><font/><font><b/></font></fonts><fills count="{len(FILLS) + 2}"><fill><patternFill patternType="none"/></fill>'
        f'<fill><patternFill patternType="gray125"/></fill>{fills}</fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs>'
        f'<cellXfs count="{len(FILLS) + 2}"><xf/><xf fontId="1" applyFont="1"/>{formats}</cellXfs></styleSheet>'
    )


def row_xml(number: int, cells: list[tuple[str | None, bool]], style: int) -> str:
    """A row of (text, whether it is a number) cells."""
    out = []
    for i, (text, numeric) in enumerate(cells):
        if text is None:
            continue
        at = f'<c r="{column_name(i)}{number}" s="{style}"'
        if numeric and re.fullmatch(r"-?\d+(\.\d+)?([eE][-+]?\d+)?", text):
            out.append(f"{at}><v>{text}</v></c>")
        else:
            if len(text) > MOST_CHARS:
                raise ValueError(f"a cell of row {number} has more than {MOST_CHARS} characters")
            out.append(f'{at} t="inlineStr"><is><t xml:space="preserve">{escape(UNSAID.sub(" ", text))}</t></is></c>')
    return f'<row r="{number}">{"".join(out)}</row>'


class WorkbookWriter(DataSourceWriter):
    """Writes rows (sheet, name, header, numeric, cells, style), sorted by sheet, into one workbook."""

    def __init__(self, path: str) -> None:
        self.path = path

    def write(self, rows: Iterator) -> WriterCommitMessage:
        first = next(rows, None)
        if first is None:
            return WriterCommitMessage()
        path, names = local(self.path), []
        os.makedirs(os.path.dirname(path) or ".", exist_ok=True)
        with zipfile.ZipFile(f"{path}.part", "w", zipfile.ZIP_DEFLATED) as book:
            row = first
            while row is not None:
                names.append(row["name"])
                row = self.write_sheet(book, len(names), row, rows)
            self.write_frame(book, names)
        os.replace(f"{path}.part", path)
        return WriterCommitMessage()

    def write_sheet(self, book: zipfile.ZipFile, n: int, row, rows: Iterator):
        """One sheet, from its header row; returns the first row of the next one."""
        numeric, number = row["numeric"], 1
        with book.open(f"xl/worksheets/sheet{n}.xml", "w", force_zip64=True) as file:
            file.write(f'<worksheet xmlns="{MAIN}"><sheetData>{row_xml(1, [(c, False) for c in row["cells"]], 1)}'.encode())
            for row in rows:
                if row["header"]:
                    break
                number += 1
                if number > MOST_ROWS:
                    raise ValueError(f"the sheet has more than {MOST_ROWS} rows: write it as Parquet or CSV")
                style = 2 + list(FILLS).index(row["style"]) if row["style"] in FILLS else 0
                file.write(row_xml(number, list(zip(row["cells"], numeric, strict=True)), style).encode())
            else:
                row = None
            file.write(b"</sheetData></worksheet>")
        return row

    def write_frame(self, book: zipfile.ZipFile, names: list[str]) -> None:
        """The files that tie the sheets together."""
        sheets = "".join(f'<sheet name={quoteattr(name)} sheetId="{i}" r:id="r{i}"/>' for i, name in enumerate(names, 1))
        book.writestr("xl/workbook.xml", f'<workbook xmlns="{MAIN}" xmlns:r="{RELATIONS}"><sheets>{sheets}</sheets></workbook>')
        links = "".join(f'<Relationship Id="r{i}" Type="{RELATIONS}/worksheet" Target="worksheets/sheet{i}.xml"/>' for i in range(1, len(names) + 1))
        style = f'<Relationship Id="s" Type="{RELATIONS}/styles" Target="styles.xml"/>'
        book.writestr("xl/_rels/workbook.xml.rels", f'<Relationships xmlns="{PACKAGE}/relationships">{links}{style}</Relationships>')
        book.writestr("_rels/.rels", f'<Relationships xmlns="{PACKAGE}/relationships"><Relationship Id="r" Type="{RELATIONS}/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/styles.xml", style_sheet())
        kind = "application/vnd.openxmlformats-officedocument.spreadsheetml"
        parts = "".join(f'<Override PartName="/xl/worksheets/sheet{i}.xml" ContentType="{kind}.worksheet+xml"/>' for i in range(1, len(names) + 1))
        book.writestr(
            "[Content_Types].xml",
            f'<Types xmlns="{PACKAGE}/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
            f'<Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="{kind}.sheet.main+xml"/>'
            f'<Override PartName="/xl/styles.xml" ContentType="{kind}.styles+xml"/>{parts}</Types>',
        )

    def abort(self, messages: list) -> None:
        if os.path.exists(f"{local(self.path)}.part"):
            os.remove(f"{local(self.path)}.part")


class WorkbookSource(DataSource):
    """Options: path (a file, a folder or a pattern), sheet (the first one without it)."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def paths(self) -> list[str]:
        path = local(self.options["path"])
        found = sorted(glob.glob(f"{path}/*.xlsx" if os.path.isdir(path) else path))
        if not found:
            raise FileNotFoundError(path)
        return found

    def schema(self) -> StructType:
        return StructType([StructField(n, StringType()) for n in header_of(self.paths()[0], self.options.get("sheet"))])

    def reader(self, schema: StructType) -> WorkbookReader:
        return WorkbookReader(self.paths(), self.options.get("sheet"), schema.names)

    def writer(self, schema: StructType, overwrite: bool) -> WorkbookWriter:
        return WorkbookWriter(self.options["path"])


def register(spark: SparkSession) -> None:
    ship_package(spark)
    spark.dataSource.register(WorkbookSource)


#: Types whose cells are numbers.
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def write_workbook(tables: dict[str, DataFrame], path: str, order: dict[str, tuple[str, ...]] | None = None, style: str = "style") -> None:
    """Tables as the sheets of one workbook, each in an order (columns by its name); the style column gives rows their fills and is not written."""
    spark = next(iter(tables.values())).sparkSession
    register(spark)
    parts = []
    for i, (name, df) in enumerate(tables.items()):
        shown = [c for c in df.columns if c != style]
        kinds = dict(df.dtypes)
        numeric = F.array(*[F.lit(kinds[c].startswith("decimal") or kinds[c] in NUMBERS) for c in shown])
        place = [F.lit(i).alias("sheet"), F.lit(name).alias("name")]
        head = spark.range(1).select(*place, F.lit(True).alias("header"), numeric.alias("numeric"), F.array(*[F.lit(c) for c in shown]).alias("cells"), F.lit(None).cast("string").alias("style"), F.lit(0).cast("long").alias("at"))
        # one task writes the file in any case, so one may number the sheet's rows, too
        sorted_ = df.orderBy(*(order or {}).get(name, ())) if (order or {}).get(name) else df
        told = F.col(style).cast("string") if style in df.columns else F.lit(None).cast("string")
        body = sorted_.select(*place, F.lit(False).alias("header"), numeric.alias("numeric"), F.array(*[F.col(f"`{c}`").cast("string") for c in shown]).alias("cells"), told.alias("style"), (F.monotonically_increasing_id() + 1).alias("at"))
        parts += [head, body]
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p)
    rows.repartition(1).sortWithinPartitions("sheet", "at").drop("sheet", "at").write.format("xlsx").mode("append").save(path)

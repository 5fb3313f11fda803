"""Spreadsheet scan (S1, S2, S7): many ``.xlsx`` files to one ``rows`` DataFrame.

The data source ``workbook`` opens each file's directory, no more, to plan one input
partition per sheet (neighbouring small sheets of a workbook share one), so the sheets of a
workbook are read by several tasks, each reading its own parts of the file. Filters on
``sheet`` and ``path`` are applied while planning; a schema of fewer columns than ``SCAN``
spares the others. With the option ``rows`` set to false a sheet gives a single row and none of its
rows is read: that is the listing.

A workbook or sheet that cannot be read gives one row with an ``error`` and does not stop the
others; what was read of such a sheet is left out (``sheet_rows``). A sheet without rows gives
one row without ``row_idx``, so the listing knows it. Files in the old ``.xls`` format are errors too.

A merged range stands once, on its first row, whatever it covers. The files must be in a store
that Python reads as well (local or mounted paths, or what pyarrow's file systems know); for
others ``scan_files`` takes the bytes from Spark's ``binaryFile`` source, a workbook in one task.
"""

from __future__ import annotations

import datetime as dt
import fnmatch
import io
import posixpath
import re
import zipfile
from collections import deque
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from xml.etree import ElementTree

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, In, InputPartition

from supplyview.functions.text import NA_STRINGS
from supplyview.operators.fill import merged_ranges
from supplyview.schemas import MERGED_RANGE
from supplyview.sources.folders import ingest_date_of

BATCH_ROWS = 4096
CHUNK_ROWS = 65_536
# Consecutive sheets of a workbook share a task up to so many bytes of XML.
PARTITION_BYTES = 4 << 20
# Beyond so many workbooks each is one partition, and the driver opens none of them.
PLANNED_FILES = 10_000
PLANNING_THREADS = 16
OLD_FORMAT = "OldFormat: .xls workbooks are not read, save as .xlsx"
PUSHDOWN_CONF = "spark.sql.python.filterPushdown.enabled"

SCAN = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("sheet", T.StringType()),
    T.StructField("sheet_pos", T.IntegerType()),
    T.StructField("row_idx", T.LongType()),
    T.StructField("cells", T.ArrayType(T.StringType())),
    T.StructField("merged", T.ArrayType(MERGED_RANGE)),
    T.StructField("error", T.StringType()),
])

ARROW_RANGE = pa.struct([
    ("left", pa.int32()), ("right", pa.int32()), ("last_row", pa.int64()), ("value", pa.string()),
])
ARROW_SCAN = pa.schema([
    ("path", pa.string()), ("sheet", pa.string()), ("sheet_pos", pa.int32()), ("row_idx", pa.int64()),
    ("cells", pa.list_(pa.string())), ("merged", pa.list_(ARROW_RANGE)), ("error", pa.string()),
])

# Built-in number formats that mean a date or time.
DATE_FORMAT_IDS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}
EPOCH = dt.datetime(1899, 12, 30)
REFERENCE = re.compile(r"([A-Z]+)([0-9]+)")
MERGE = re.compile(rb"<(?:\w+:)?mergeCell\s[^>]*?ref=[\"']([A-Z]+[0-9]+):([A-Z]+[0-9]+)[\"']")


def _local(tag: str) -> str:
    return tag.rsplit("}", 1)[-1]


def _position(reference: str) -> tuple[int, int]:
    """``B3`` to (row index from spreadsheet row 2, column index)."""
    letters, digits = REFERENCE.fullmatch(reference).groups()
    column = 0
    for letter in letters:
        column = column * 26 + ord(letter) - 64
    return int(digits) - 2, column - 1


def _text(element) -> str:
    """Joined text runs, without phonetic hints."""
    if _local(element.tag) == "rPh":
        return ""
    own = element.text or "" if _local(element.tag) == "t" else ""
    return own + "".join(_text(child) for child in element)


def _shared_strings(book: zipfile.ZipFile) -> list[str]:
    if "xl/sharedStrings.xml" not in book.namelist():
        return []
    strings = []
    with book.open("xl/sharedStrings.xml") as part:
        for _, element in ElementTree.iterparse(part):
            if _local(element.tag) == "si":
                strings.append(_text(element))
                element.clear()
    return strings


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Cell style numbers shown as dates."""
    if "xl/styles.xml" not in book.namelist():
        return set()
    root = ElementTree.fromstring(book.read("xl/styles.xml"))
    custom = {}
    for element in root.iter():
        if _local(element.tag) == "numFmt":
            code = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", element.get("formatCode", ""))
            custom[int(element.get("numFmtId"))] = bool(re.search("[ymdhs]", code.lower()))
    for element in root:
        if _local(element.tag) == "cellXfs":
            ids = [int(xf.get("numFmtId", "0")) for xf in element]
            return {i for i, n in enumerate(ids) if custom.get(n, n in DATE_FORMAT_IDS)}
    return set()


def _sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(sheet name, part name) in workbook order."""
    targets = {}
    for link in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels")):
        targets[link.get("Id")] = link.get("Target")
    found = []
    for element in ElementTree.fromstring(book.read("xl/workbook.xml")).iter():
        if _local(element.tag) != "sheet":
            continue
        link = next(v for k, v in element.attrib.items() if _local(k) == "id")
        target = targets[link]
        part = target.lstrip("/") if target.startswith("/") else posixpath.join("xl", target)
        found.append((element.get("name"), posixpath.normpath(part)))
    return found


def _merged_ranges(book: zipfile.ZipFile, part: str) -> list[tuple[int, int, int, int]]:
    """Merged ranges; they follow the rows in the file, so they are looked up first."""
    ranges, rest = [], b""
    with book.open(part) as stream:
        while chunk := stream.read(1 << 20):
            text = rest + chunk
            cut = text.rfind(b"<")
            for first, last in MERGE.findall(text[:cut]):
                top, left = _position(first.decode())
                bottom, right = _position(last.decode())
                ranges.append((top, left, bottom, right))
            rest = text[cut:]
    return sorted(ranges)


def _number(text: str, is_date: bool) -> str:
    value = float(text)
    if is_date:
        return str(EPOCH + dt.timedelta(seconds=round(value * 86400)))
    return str(int(value)) if value.is_integer() else repr(value)


def _value(cell, strings: list[str], dates: set[int]) -> str | None:
    kind = cell.get("t", "n")
    if kind == "inlineStr":
        return "".join(_text(part) for part in cell if _local(part.tag) == "is")
    raw = next((part.text for part in cell if _local(part.tag) == "v"), None)
    if raw is None:
        return None
    if kind == "s":
        return strings[int(raw)]
    if kind == "b":
        return "True" if raw == "1" else "False"
    if kind == "n":
        return _number(raw, int(cell.get("s", "0")) in dates)
    return raw  # formula text, ISO dates and error texts


def _sheet_rows(book, part, strings, dates, with_merged: bool = True) -> Iterator[tuple[int, list, list]]:
    """(row index, cells, merged ranges that start here) of every row, gaps filled with
    blank rows.

    NA texts become null here, and a row ends with its last value.
    """
    waiting = deque(_merged_ranges(book, part) if with_merged else [])
    expected = -1
    with book.open(part) as stream:
        parents = []
        for event, element in ElementTree.iterparse(stream, ("start", "end")):
            if event == "start":
                parents.append(element)
                continue
            parents.pop()
            if _local(element.tag) != "row":
                continue
            cells: dict[int, str | None] = {}
            anchors: dict[int, str | None] = {}
            for n, cell in enumerate(element):
                at = _position(cell.get("r"))[1] if cell.get("r") else n
                value = _value(cell, strings, dates)
                anchors[at] = value
                cells[at] = None if value in NA_STRINGS else value
            row = int(element.get("r")) - 2 if element.get("r") else expected
            # Read rows must not stay below their parent, or memory grows with the sheet.
            parents[-1].clear()
            for idx in range(expected, row + 1):
                here, first = (cells, anchors) if idx == row else ({}, {})
                starting = []
                while waiting and waiting[0][0] <= idx:
                    _, left, bottom, right = waiting.popleft()
                    starting.append({
                        "left": left, "right": right, "last_row": bottom, "value": first.get(left)
                    })
                width = max((c for c, v in here.items() if v is not None), default=-1) + 1
                yield idx, [here.get(c) for c in range(width)], starting
            expected = row + 1


def _book_rows(
    path: str, book: zipfile.ZipFile, sheets: Sequence[tuple[str, int, str]], with_merged: bool = True
) -> Iterator[tuple]:
    strings, dates = _shared_strings(book), _date_styles(book)
    for name, pos, part in sheets:
        empty = True
        try:
            for idx, cells, merged in _sheet_rows(book, part, strings, dates, with_merged):
                empty = False
                yield path, name, pos, idx, cells, merged, None
            if empty:
                yield path, name, pos, None, [], [], None
        except Exception as problem:  # one bad sheet must not stop the rest
            yield path, name, pos, None, [], [], f"{type(problem).__name__}: {problem}"


def _workbook_rows(path: str, content: bytes) -> Iterator[tuple]:
    try:
        with zipfile.ZipFile(io.BytesIO(content)) as book:
            yield from _book_rows(path, book, _wanted(_sheets(book), {}))
    except Exception as problem:
        yield path, None, None, None, [], [], f"{type(problem).__name__}: {problem}"


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    def frame(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=SCAN.fieldNames()).astype(
            {"row_idx": "Int64", "sheet_pos": "Int32"}
        )

    for files in batches:
        for path, content in zip(files["path"], files["content"]):
            held = []
            for row in _workbook_rows(path, content):
                held.append(row)
                if len(held) == BATCH_ROWS:
                    yield frame(held)
                    held = []
            if held:
                yield frame(held)


def scan_files(files: DataFrame) -> DataFrame:
    """Rows of the workbooks in a ``binaryFile`` DataFrame, errors included; for stores that only
    Spark reads."""
    return _named(files.select("path", "content").mapInPandas(_scan, SCAN))


@dataclass
class Sheets(InputPartition):
    """Sheets of one workbook, as (name, place, part); None: all it has."""

    path: str
    sheets: list[tuple[str, int, str]] | None = None
    error: str | None = None
    wanted: dict[str, list[str]] = field(default_factory=dict)


def _opened(path: str):
    """The file behind a path or URI, for reading anywhere in it."""
    if re.match(r"^[a-zA-Z][\w+.-]+:", path) and not path.startswith("file:"):
        system, inner = pa.fs.FileSystem.from_uri(path)
        return system.open_input_file(inner)
    return open(re.sub(r"^file:/*", "/", path), "rb")


def _pattern(glob: str) -> re.Pattern:
    """Hadoop's path patterns: * and ? within a folder's name, [..] and {a,b}."""
    out, depth = "", 0
    for c in glob:
        if c in "*?":
            out += "[^/]*" if c == "*" else "[^/]"
        elif c == "{":
            out, depth = out + "(?:", depth + 1
        elif c == "}" and depth:
            out, depth = out + ")", depth - 1
        elif c == "," and depth:
            out += "|"
        else:
            out += c if c in "[]" else re.escape(c)
    return re.compile(out + "(?:/.*)?")


def _files(root: str, pattern: str) -> list[str]:
    """Files at or below the paths that match ``root`` whose name matches ``pattern``."""
    scheme = re.match(r"^[a-zA-Z][\w+.-]+:", root)
    system: pa.fs.FileSystem = pa.fs.LocalFileSystem()
    prefix, inner = "file:", re.sub(r"^file:/*", "/", root)
    if scheme and scheme[0] != "file:":
        base = re.split(r"[*?\[{]", root)[0].rsplit("/", 1)[0]
        system, folder = pa.fs.FileSystem.from_uri(base)
        prefix, inner = base[: len(base) - len(folder)], folder + root[len(base) :]
    plain = re.split(r"[*?\[{]", inner)[0]
    base = plain.rstrip("/") if plain == inner else plain.rsplit("/", 1)[0]
    found = pa.fs.FileSelector(base or "/", allow_not_found=True, recursive=True)
    at = system.get_file_info(base or "/")
    infos = [at] if at.type == pa.fs.FileType.File else system.get_file_info(found)
    wanted = _pattern(inner.rstrip("/"))
    return sorted(
        prefix + x.path for x in infos
        if x.type == pa.fs.FileType.File and fnmatch.fnmatch(x.base_name, pattern)
        and wanted.fullmatch(x.path) and not re.search(r"/[._]", x.path[len(base) :])
    )


class WorkbookReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = schema.fieldNames()
        self.root, self.pattern = options["path"], options.get("pattern", "*.xlsx")
        self.rows = options.get("rows", "true").lower() == "true"
        self.partition_bytes = int(options.get("partitionbytes", PARTITION_BYTES))
        self.wanted: dict[str, list[str]] = {}

    def pushFilters(self, filters):
        for f in filters:
            if isinstance(f, EqualTo) and f.attribute in (("sheet",), ("path",)):
                self.wanted[f.attribute[0]] = [f.value]
            elif isinstance(f, In) and f.attribute in (("sheet",), ("path",)):
                self.wanted[f.attribute[0]] = list(f.value)
            # Spark filters again: a repeated column keeps one of its filters only.
            yield f

    def partitions(self) -> list[Sheets]:
        paths = _files(self.root, self.pattern)
        paths += [p for p in _files(self.root, "*.xls") if p not in set(paths)]
        paths = [p for p in paths if p in self.wanted.get("path", [p])]
        if len(paths) > PLANNED_FILES:
            planned = [[Sheets(p, wanted=self.wanted)] for p in paths]
        else:
            with ThreadPoolExecutor(PLANNING_THREADS) as threads:
                planned = list(threads.map(self._planned, paths))
        # A source without partitions would still be asked for one.
        return [x for each in planned for x in each] or [Sheets("", [])]

    def _planned(self, path: str) -> list[Sheets]:
        if path.endswith(".xls"):
            return [Sheets(path, error=OLD_FORMAT)]
        try:
            with _opened(path) as file, zipfile.ZipFile(file) as book:
                found = _wanted(_sheets(book), self.wanted)
                sizes = {i.filename: i.file_size for i in book.infolist()}
        except Exception as problem:
            return [Sheets(path, error=f"{type(problem).__name__}: {problem}")]
        if not self.rows:
            return [Sheets(path, found)]
        groups: list[list] = []
        room = 0
        for sheet in found:
            size = sizes.get(sheet[2], 0)
            if not groups or size > room:
                groups.append([])
                room = self.partition_bytes
            groups[-1].append(sheet)
            room -= size
        return [Sheets(path, group) for group in groups]

    def read(self, partition: Sheets) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([f for f in ARROW_SCAN if f.name in self.columns])
        schema = pa.schema([schema.field(c) for c in self.columns])
        held = []
        for row in self._rows(partition):
            held.append(dict(zip(SCAN.fieldNames(), row)))
            if len(held) == BATCH_ROWS:
                yield pa.RecordBatch.from_pylist(held, schema)
                held = []
        yield pa.RecordBatch.from_pylist(held, schema)

    def _rows(self, partition: Sheets) -> Iterator[tuple]:
        path = partition.path
        if partition.error or path.endswith(".xls"):
            yield path, None, None, None, [], [], partition.error or OLD_FORMAT
            return
        if partition.sheets == []:
            return
        try:
            with _opened(path) as file, zipfile.ZipFile(file) as book:
                sheets = partition.sheets
                if sheets is None:
                    sheets = _wanted(_sheets(book), partition.wanted)
                if self.rows:
                    yield from _book_rows(path, book, sheets, "merged" in self.columns)
                else:
                    for name, pos, _ in sheets:
                        yield path, name, pos, None, [], [], None
        except Exception as problem:
            yield path, None, None, None, [], [], f"{type(problem).__name__}: {problem}"


def _wanted(sheets: list[tuple[str, str]], wanted: dict[str, list[str]]) -> list[tuple[str, int, str]]:
    names = wanted.get("sheet")
    return [(name, pos, part) for pos, (name, part) in enumerate(sheets) if names is None or name in names]


class WorkbookSource(DataSource):
    """``spark.read.format("workbook").load(path)``: see the module."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self) -> T.StructType:
        return SCAN

    def reader(self, schema: T.StructType) -> WorkbookReader:
        return WorkbookReader(schema, dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set(PUSHDOWN_CONF, "true")
    spark.dataSource.register(WorkbookSource)


def _named(scanned: DataFrame) -> DataFrame:
    rest = [c for c in scanned.columns if c != "path"]
    return scanned.select(
        ingest_date_of(F.col("path")).alias("ingest_date"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("workbook"),
        *rest,
        "path",
    )


def scan_workbooks(
    spark: SparkSession,
    path: str,
    pattern: str = "*.xlsx",
    columns: Sequence[str] | None = None,
    sheets: Sequence[str] | None = None,
    partition_bytes: int = PARTITION_BYTES,
) -> DataFrame:
    """All rows of all workbooks below ``path``; row -1 is spreadsheet row 1.

    ``columns``: of ``SCAN`` beside the path, all by default. ``sheets``: only those of these
    names; no part of the others is read.
    """
    register(spark)
    schema = SCAN
    if columns is not None:
        schema = T.StructType([f for f in SCAN if f.name in {"path", "sheet", *columns}])
    scanned = (
        spark.read.format("workbook").schema(schema)
        .options(pattern=pattern, partitionBytes=str(partition_bytes)).load(path)
    )
    if sheets is not None:
        scanned = scanned.filter(F.col("sheet").isin(*sheets))
    return _named(scanned)


def list_sheets(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """(ingest_date, workbook, sheet, sheet_pos, error, path), read from the workbooks'
    directories alone."""
    register(spark)
    schema = T.StructType([f for f in SCAN if f.name in ("path", "sheet", "sheet_pos", "error")])
    return _named(
        spark.read.format("workbook").schema(schema).options(pattern=pattern, rows="false").load(path)
    )


def sheet_rows(scanned: DataFrame) -> DataFrame:
    """Rows of the sheets that were read whole; a half-read sheet is a reject."""
    failed = scanned.filter(F.col("error").isNotNull()).select("path", "sheet").distinct()
    return (
        scanned.filter(F.col("error").isNull() & F.col("row_idx").isNotNull())
        .join(failed, ["path", "sheet"], "left_anti")
        .select(*[c for c in scanned.columns if c not in ("error", "path")])
    )


def unreadable(scanned: DataFrame) -> DataFrame:
    """Workbooks and sheets that could not be read."""
    return scanned.filter(F.col("error").isNotNull()).select(
        "ingest_date",
        "workbook",
        "sheet",
        F.lit(None).cast("string").alias("table"),
        F.col("error").alias("reason"),
    )


def sheet_listing(rows: DataFrame, keys=("ingest_date", "workbook", "sheet")) -> DataFrame:
    """The sheets there are; of a scan those without rows too."""
    return rows.filter(F.col("sheet").isNotNull()).select(*keys).distinct()


def merged_cells(rows: DataFrame, keys=("ingest_date", "workbook", "sheet")) -> DataFrame:
    """S7 in long form: one row per cell inside a merged range. For looking at single sheets; the
    operators take ranges (``merged_ranges``)."""
    ranges = merged_ranges(rows, keys)
    down = F.explode(F.sequence("top", "last_row")).alias("row_idx")
    across = F.explode(F.sequence("left", "right")).alias("col_idx")
    return (
        ranges.select("*", down).repartition(*keys, "row_idx").select("*", across)
        .select(
            *keys, "row_idx", "col_idx", F.col("top").alias("anchor_row"),
            F.col("left").alias("anchor_col"), F.col("value").alias("anchor_value"), "last_row",
        )
    )


def cells_of(rows: DataFrame, keys=("ingest_date", "workbook", "sheet")) -> DataFrame:
    """The grid in long form: one row per non-null cell."""
    return rows.select(
        *keys, "row_idx", F.posexplode("cells").alias("col_idx", "value")
    ).filter(F.col("value").isNotNull())


def rows_of(cells: DataFrame, dims: DataFrame, keys=("ingest_date", "workbook", "sheet")) -> DataFrame:
    """Rows from a long grid and its ``sheet_dims(keys, n_rows, n_cols)``.

    Blank rows are restored; a row holds at most ``n_cols`` cells, so grouping by
    row is bounded however large the sheet is.
    """
    filled = cells.groupBy(*keys, "row_idx").agg(
        F.map_from_entries(F.collect_list(F.struct("col_idx", "value"))).alias("_by_col")
    )
    # Row numbers come in chunks that are spread first, so no task lists a whole sheet.
    zero, last = F.lit(0).cast("bigint"), F.col("n_rows").cast("bigint") - 1
    chunks = dims.filter(F.col("n_rows") > 0).select(
        *keys, "n_cols", "n_rows", F.explode(F.sequence(zero, last, F.lit(CHUNK_ROWS))).alias("_at")
    )
    here = F.sequence(F.col("_at"), F.least(F.col("_at") + CHUNK_ROWS - 1, last))
    every_row = chunks.repartition(*keys, "_at").select(
        *keys, "n_cols", F.explode(here).alias("row_idx")
    )
    return every_row.join(filled, [*keys, "row_idx"], "left").select(
        *keys,
        "row_idx",
        F.transform(
            F.sequence(F.lit(0), F.col("n_cols").cast("int") - 1),
            lambda c: F.try_element_at(F.col("_by_col"), c),
        ).alias("cells"),
    )

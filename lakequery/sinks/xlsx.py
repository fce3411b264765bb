"""``df.write.format("xlsx")``: every task writes the workbooks of its own rows."""

from __future__ import annotations

import re
import uuid
import zipfile
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import chain
from xml.sax.saxutils import escape

import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from lakequery.storage import open_filesystem

# Limits of the worksheet format.
MAX_ROWS = 1_048_576
MAX_COLUMNS = 16_384
MAX_CELL_CHARS = 32_767

# Rows handed to a workbook at a time.
SLICE = 4_096

MOVES_IN_FLIGHT = 16

_RARE = r"[\x00-\x08\x0b-\x1f\x{fffe}\x{ffff}]|_x[0-9A-Fa-f]{4}_"
_NOT_XML = re.compile("[\x00-\x08\x0b-\x1f\ufffe\uffff]|_(?=x[0-9A-Fa-f]{4}_)")

# The smallest set of package parts a workbook needs.
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_RELS = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006"
_TYPES = "application/vnd.openxmlformats-officedocument.spreadsheetml"
_HEAD = '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>\n'
_PARTS = {
    "[Content_Types].xml": (
        f'<Types xmlns="{_PACKAGE}/content-types">'
        '<Default Extension="rels" '
        'ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        '<Default Extension="xml" ContentType="application/xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{_TYPES}.sheet.main+xml"/>'
        f'<Override PartName="/xl/worksheets/sheet1.xml" ContentType="{_TYPES}.worksheet+xml"/>'
        "</Types>"
    ),
    "_rels/.rels": (
        f'<Relationships xmlns="{_PACKAGE}/relationships">'
        f'<Relationship Id="rId1" Type="{_RELS}/officeDocument" Target="xl/workbook.xml"/>'
        "</Relationships>"
    ),
    "xl/workbook.xml": (
        f'<workbook xmlns="{_MAIN}" xmlns:r="{_RELS}">'
        '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
    ),
    "xl/_rels/workbook.xml.rels": (
        f'<Relationships xmlns="{_PACKAGE}/relationships">'
        f'<Relationship Id="rId1" Type="{_RELS}/worksheet" Target="worksheets/sheet1.xml"/>'
        "</Relationships>"
    ),
}


class SheetLimitError(ValueError):
    """The rows do not fit the worksheet format."""


def column_letters(index: int) -> str:
    """0 is A, 26 is AA."""
    letters = ""
    index += 1
    while index:
        index, digit = divmod(index - 1, 26)
        letters = chr(65 + digit) + letters
    return letters


def escape_text(value: str) -> str:
    """XML text, with what XML cannot hold in the worksheet format's ``_xHHHH_`` form."""
    return escape(_NOT_XML.sub(lambda m: f"_x{ord(m.group()):04X}_", value))


def _escaped(texts: pa.StringArray) -> pa.StringArray:
    lengths = pc.utf8_length(texts)
    if (pc.max(lengths).as_py() or 0) > MAX_CELL_CHARS // 2:
        for value in texts.filter(pc.greater(lengths, MAX_CELL_CHARS // 2)).to_pylist():
            if len(value.encode("utf-16-le")) // 2 > MAX_CELL_CHARS:
                raise SheetLimitError(f"a cell holds at most {MAX_CELL_CHARS} characters of text")
    if pc.any(pc.match_substring_regex(texts, _RARE)).as_py():
        return pa.array([None if v is None else escape_text(v) for v in texts.to_pylist()], pa.string())
    for plain, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        texts = pc.replace_substring(texts, plain, entity)
    return texts


def _joined(*parts) -> pa.StringArray:
    return pc.binary_join_element_wise(*parts, "")


def text_cells(refs: pa.StringArray, texts: pa.StringArray) -> pa.StringArray:
    spaced = pc.any(pc.match_substring_regex(texts, r"^\s|\s$|\n|\t|  ")).as_py()
    text = '<t xml:space="preserve">' if spaced else "<t>"
    return _joined('<c r="', refs, f'" t="inlineStr"><is>{text}', _escaped(texts), "</t></is></c>")


def cells(letters: str, rows: pa.StringArray, values: pa.Array) -> pa.StringArray:
    """One column of cells, as XML; blank where the value is null."""
    refs = _joined(letters, rows)
    if pa.types.is_boolean(values.type):
        bits = pc.cast(values.cast(pa.int8()), pa.string())
        made = _joined('<c r="', refs, '" t="b"><v>', bits, "</v></c>")
    elif pa.types.is_string(values.type) or pa.types.is_large_string(values.type):
        made = text_cells(refs, values.cast(pa.string()))
    else:
        made = _joined('<c r="', refs, '"><v>', pc.cast(values, pa.string()), "</v></c>")
        if pa.types.is_floating(values.type) and not pc.all(pc.is_finite(values)).as_py():
            # How numbers without a JSON form are spelled.
            signed = pc.if_else(pc.greater(values, 0), "inf", "-inf")
            spelled = pc.if_else(pc.is_nan(values), "NaN", signed)
            made = pc.if_else(pc.is_finite(values), made, text_cells(refs, spelled))
    return pc.fill_null(made, "")


class Workbook:
    """One sheet streamed into one file."""

    def __init__(self, sink, names: list[str]):
        if len(names) > MAX_COLUMNS:
            raise SheetLimitError(f"a sheet holds {MAX_COLUMNS} columns, not {len(names)}")
        self._zip = zipfile.ZipFile(sink, "w", zipfile.ZIP_DEFLATED, compresslevel=1)
        for name, body in _PARTS.items():
            self._zip.writestr(name, _HEAD + body)
        self._sheet = self._zip.open("xl/worksheets/sheet1.xml", "w")
        self._letters = [column_letters(i) for i in range(len(names))]
        self.rows = 0
        self._write(f'{_HEAD}<worksheet xmlns="{_MAIN}"><sheetData>')
        self.add(pa.RecordBatch.from_arrays([pa.array([n], pa.string()) for n in names], names))

    def _write(self, text: str) -> None:
        self._sheet.write(text.encode("utf-8"))

    def add(self, batch: pa.RecordBatch) -> None:
        first = self.rows + 1
        self.rows += batch.num_rows
        rows = pc.cast(pa.array(range(first, self.rows + 1), pa.int64()), pa.string())
        columns = [cells(letters, rows, c) for letters, c in zip(self._letters, batch.columns)]
        lines = _joined('<row r="', rows, '">', *columns, "</row>")
        self._write("".join(lines.to_pylist()))

    @property
    def full(self) -> bool:
        return self.rows > MAX_ROWS - SLICE

    def close(self) -> None:
        self._write("</sheetData></worksheet>")
        self._sheet.close()
        self._zip.close()


@dataclass
class Written(WriterCommitMessage):
    files: list[str] = field(default_factory=list)


class XlsxWriter(DataSourceArrowWriter):
    """Tasks write under a temporary name; only files of tasks that won are moved into place."""

    def __init__(self, path: str, schema: StructType):
        self.path = path.rstrip("/")
        self.names = schema.fieldNames()
        self.temporary = f"{self.path}/_temporary-{uuid.uuid4().hex}"

    def _write_workbook(self, name: str, batches: Iterator[pa.RecordBatch]) -> None:
        """Fill one workbook, leaving in ``batches`` what does not fit."""
        fs, base = open_filesystem(self.temporary)
        fs.create_dir(base, recursive=True)
        try:
            with fs.open_output_stream(f"{base}/{name}") as sink:
                book = Workbook(sink, self.names)
                for batch in batches:
                    book.add(batch)
                    if book.full:
                        break
                book.close()
        except BaseException:
            fs.delete_file(f"{base}/{name}")
            raise

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        task = TaskContext.get()
        written = Written()
        slices = _slices(iterator)
        for first in slices:
            name = (
                f"part-{task.partitionId():05d}-{len(written.files):05d}"
                f"-{task.taskAttemptId()}-{uuid.uuid4().hex}.xlsx"
            )
            self._write_workbook(name, chain([first], slices))
            written.files.append(name)
        return written

    def commit(self, messages: list[Written | None]) -> None:
        names = [name for message in messages if message is not None for name in message.files]
        if not names:
            names = [f"part-00000-{uuid.uuid4().hex}.xlsx"]
            self._write_workbook(names[0], iter(()))
        fs, temporary = open_filesystem(self.temporary)
        target = open_filesystem(self.path)[1]
        with ThreadPoolExecutor(MOVES_IN_FLIGHT) as pool:
            list(pool.map(lambda name: fs.move(f"{temporary}/{name}", f"{target}/{name}"), names))
        fs.delete_dir(temporary)

    def abort(self, messages: list[Written | None]) -> None:
        fs, temporary = open_filesystem(self.temporary)
        if fs.get_file_info(temporary).type != pafs.FileType.NotFound:
            fs.delete_dir(temporary)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            yield batch.slice(start, SLICE)


class XlsxDataSource(DataSource):
    """Write-only source; the frame must hold booleans, longs, doubles and strings."""

    @classmethod
    def name(cls) -> str:
        return "xlsx"

    def writer(self, schema: StructType, overwrite: bool) -> XlsxWriter:
        if overwrite:
            raise ValueError("the xlsx source only adds files; replace old ones after it commits")
        return XlsxWriter(self.options["path"], schema)

"""Names, options and rules of the export formats."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakequery.storage import Storage

CSV, EXCEL, JSON, ORC, PARQUET = "csv", "excel", "json", "orc", "parquet"
OVERWRITE, APPEND = "overwrite", "append"

# Accepted format and mode names, and what an append refusal calls each format.
FORMAT_NAMES = {
    "csv": CSV,
    "excel": EXCEL,
    "xlsx": EXCEL,
    "json": JSON,
    "orc": ORC,
    "parquet": PARQUET,
}
MODE_NAMES = {"": OVERWRITE, "overwrite": OVERWRITE, "append": APPEND}
APPEND_REFUSED = {EXCEL: "excel/xlsx", ORC: "orc", PARQUET: "parquet"}

# Quotes are doubled, nothing else is escaped, null is an empty cell and spaces are kept.
CSV_OPTIONS = {
    "escape": '"',
    "nullValue": "",
    "emptyValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def csv_options(frame: DataFrame) -> dict[str, str]:
    """Options for a frame of cell texts; a lone empty cell is quoted, as a blank line is no row."""
    return CSV_OPTIONS | ({"emptyValue": '""'} if len(frame.columns) == 1 else {})


class ExportError(ValueError):
    """An export asked for something its format or target does not allow."""


@dataclass(frozen=True)
class SaveResult:
    path: str
    file_type: str
    row_count: int


def parse_format(file_type: str) -> str:
    name = file_type.strip().lower()
    if name not in FORMAT_NAMES:
        raise ExportError(f"no export format is called {name!r}; choose csv, excel, json, orc or parquet")
    return FORMAT_NAMES[name]


def parse_mode(mode: str | None) -> str:
    name = (mode or "").strip().lower()
    if name not in MODE_NAMES:
        raise ExportError(f"no export mode is called {name!r}; choose overwrite or append")
    return MODE_NAMES[name]


def check_append(spark: SparkSession, file_format: str, mode: str, path: str) -> None:
    """Refuse, before any job runs, to append where the format or the target forbids it."""
    if mode != APPEND or Storage(spark).is_empty(path):
        return
    if file_format in APPEND_REFUSED:
        label = APPEND_REFUSED[file_format]
        # Fixed value: how the refusal begins.
        raise ExportError(
            f"Append mode is not supported for {label} exports: {path} has data already. "
            "Overwrite it, or append as csv or json."
        )

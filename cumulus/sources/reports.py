"""Report matrices (one file per office and vehicle type) -> daily snapshot rows (SRC1-SRC3, C1).

A report is a Maker x Fuel matrix of month-to-date counts: a title line, two
more lines, the header on the 4th line (``S No``, maker, fuels..., an unnamed
last column holding the row total). Spreadsheet reports need a spreadsheet
codec that is not installed here, so reports are read as CSV exports of the
same sheet; ``.xlsx`` is parsed only when ``openpyxl`` is importable.

Plan: ``binaryFile`` lists and reads the files (many small files are packed
into one task up to ``spark.sql.files.maxPartitionBytes``); ``mapInArrow``
turns each sheet row into one row ``(path, title, row_no, maker, cells)``, where
``cells`` maps each column name to its text -- the only Python in the pipeline,
a per-file parser. Everything after it (name parsing, filters, whitelist,
district lookup, number coercion) is Spark SQL on that row: a measure is a map
lookup, so nothing is melted, shuffled or pivoted back, and a column that only
some files have is a measure like any other (:func:`sheet_measures`). A file
that fails to parse yields one quarantine row with the error instead of failing
the job. Each file is read whole into one row, which suits report sheets
(kilobytes each); bulk data belongs in Parquet/CSV tables.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import fmt_day_first, parse_report_filename, strip_ws, to_count
from ..functions.schema import FUEL_COLUMNS, q
from ..operators.dims import TARGET_MAKERS, UNKNOWN_DISTRICT
from ..operators.joins import bounded_broadcast

ROW_SCHEMA = "path string, title string, row_no int, maker string, cells map<string,string>, error string"
HEADER_ROW = 3  # zero-based: the 4th line holds the header


def _sheet(path: str, content: bytes) -> pd.DataFrame:
    if path.lower().endswith(".xlsx"):
        try:
            import openpyxl  # noqa: F401
        except ImportError as e:  # pragma: no cover - depends on the image
            raise RuntimeError("spreadsheet reports need openpyxl") from e
        return pd.read_excel(io.BytesIO(content), header=None, dtype=str)
    if not path.lower().endswith(".csv"):
        raise ValueError("not a report format")
    return pd.read_csv(io.BytesIO(content), header=None, dtype=str, keep_default_na=False, skip_blank_lines=False, names=range(_width(content)))


def _names(header: list[str]) -> list[str]:
    """Measure names: trimmed; an unnamed last column is the row total, a repeated name gets a number."""
    names: list[str] = []
    for k, cell in enumerate(header):
        name = cell.strip() or ("TOTAL" if k == len(header) - 1 else f"Unnamed: {k}")
        seen = sum(n == name or n.startswith(f"{name}.") for n in names)
        names.append(f"{name}.{seen}" if name in names else name)
    return names


def _parse_one(path: str, content: bytes) -> list[tuple]:
    """``(path, title, row_no, maker, cells, error)`` of every row below the header; one row without maker if there is none."""
    sheet = _sheet(path, content)
    title = _title(sheet)
    grid = sheet.astype(object).where(sheet.notna(), None)
    header = ["" if v is None else str(v) for v in grid.iloc[HEADER_ROW].tolist()]
    first = 1 if "S No" in header or header[0] == "" else 0  # serial-number column
    if len(header) <= first:
        raise ValueError("no columns after the serial number")
    names = _names(header[first + 1 :])
    rows = grid.iloc[HEADER_ROW + 1 :].itertuples(index=False, name=None)
    out = [(path, title, k, row[first], list(zip(names, row[first + 1 :])), None) for k, row in enumerate(rows)]
    return out or [(path, title, None, None, [], None)]


def _title(sheet: pd.DataFrame) -> str:
    """SC8: first non-blank cell of the first row, else of the top-left 5x5 window."""

    def first(cells) -> str:
        return next((str(v).strip() for v in cells if isinstance(v, str) and v.strip()), "")

    if not len(sheet):
        return ""
    return first(sheet.iloc[0].tolist()) or first(sheet.iloc[:5, :5].to_numpy().ravel().tolist())


def _width(content: bytes) -> int:
    """Fields of the widest row; commas inside quotes do not count."""
    return max(map(len, csv.reader(io.StringIO(content.decode("utf-8", errors="replace")))), default=1)


_CELLS = pa.map_(pa.string(), pa.string())
_ARROW = pa.schema([("path", pa.string()), ("title", pa.string()), ("row_no", pa.int32()), ("maker", pa.string()), ("cells", _CELLS), ("error", pa.string())])


def parse_report_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``mapInArrow`` body: (path, content) batches -> sheet rows, or one error row per bad file."""
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            try:
                rows = _parse_one(path, content or b"")
            except Exception as e:  # noqa: BLE001 - per-file isolation is the point
                rows = [(path, None, None, None, [], f"{type(e).__name__}: {e}")]
            yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*rows), _ARROW)], schema=_ARROW)


def read_report_rows(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """SRC1 + SRC3: every file of a folder as sheet rows (a file that cannot be read as a report is one error row)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(folder)
    return files.select("path", "content").mapInArrow(parse_report_batches, ROW_SCHEMA)


def sheet_measures(rows: DataFrame) -> list[str]:
    """PRJ7: the names of all measure columns that any sheet has, sorted (distinct map keys, one row for each name)."""
    return sorted(r[0] for r in rows.select(F.explode(F.map_keys("cells")).alias("name")).distinct().collect())


def run_date_from_path(path: Column | str = "path") -> Column:
    """Run date from a ``YYYY-MM-DD...`` parent folder name (one download folder per run)."""
    p = F.col(path) if isinstance(path, str) else path
    return F.try_to_date(F.regexp_extract(p, r"/(\d{4}-\d{2}-\d{2})[^/]*/[^/]*$", 1), "yyyy-MM-dd")


def consolidate_reports(
    rows: DataFrame,
    run_date: Column | None = None,
    district: DataFrame | None = None,
    makers: DataFrame | None = None,
    fuels: Sequence[str] = (*FUEL_COLUMNS, "TOTAL"),
    measures: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """C1 (SRC2, SC1-2, FLT1-2, JN5, SC10, PRJ4): sheet rows -> (wide daily snapshot, quarantine).

    The wide rows carry run date, data date (run - 1), state, office, office
    code, vehicle type, district (``Unknown`` when unmapped), maker and one
    count per measure: those of ``fuels`` first, always, then every other
    column that any sheet has (``measures``, found by :func:`sheet_measures`
    when not given). A column that a sheet lacks counts 0 there. One
    projection over the rows: no shuffle besides the district lookup.
    Quarantine = files that failed to parse or whose name does not parse.
    ``run_date`` defaults to the date in each file's folder name. ``district``
    has two columns, (upper-cased office name, district), matched on the
    upper-cased office of the file name; ``makers`` has a ``maker`` column.
    """
    spark = rows.sparkSession
    if measures is None:
        measures = sheet_measures(rows)
    columns = [*fuels, *[m for m in measures if m not in fuels]]
    if run_date is None:
        rows = rows.withColumn("__run", run_date_from_path("path"))
        run_date = F.col("__run")
    name = F.regexp_extract("path", r"([^/]*)$", 1)
    parsed = rows.withColumn("__f", parse_report_filename(name))
    bad = parsed.where(F.col("error").isNotNull() | F.col("__f").isNull()).select(
        "path", F.coalesce(F.col("error"), F.lit("file name does not parse")).alias("error")
    ).distinct()
    good = parsed.where(F.col("error").isNull() & F.col("__f").isNotNull())
    maker = strip_ws(F.col("maker"))
    good = good.where(F.col("maker").isNotNull() & ~maker.isin("Maker", "TOTAL", "")).withColumn("maker", maker)
    if makers is None:
        makers = spark.createDataFrame([(m,) for m in TARGET_MAKERS], "maker string")
    good = good.join(bounded_broadcast(makers.select("maker").distinct()), "maker", "left_semi")
    wide = good.select(
        fmt_day_first(run_date).alias("scrape_timestamp"),
        fmt_day_first(F.date_sub(run_date, 1)).alias("timestamp"),
        F.col("__f.state").alias("state"),
        F.col("__f.office").alias("rto"),
        F.col("__f.office_code").alias("rto_number"),
        F.col("__f.vehicle_type").alias("vehicle_type"),
        F.col("maker").alias("Maker"),
        *[to_count(F.col("cells")[c]).alias(c) for c in columns],
    )
    if district is not None:
        d = district.select(F.col(district.columns[0]).alias("__k"), F.col(district.columns[1]).alias("__district"))
        wide = wide.join(d, F.upper(wide["rto"]) == d["__k"], "left")
        where = F.coalesce("__district", F.lit(UNKNOWN_DISTRICT))
    else:
        where = F.lit(UNKNOWN_DISTRICT)
    ordered = ["scrape_timestamp", "timestamp", "state", "rto", "rto_number", "vehicle_type", "district", "Maker", *columns]
    return wide.withColumn("district", where).select(*[F.col(q(c)) for c in ordered]), bad

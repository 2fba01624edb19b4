"""Write report matrices derived from the driver tables, for the ingest queries.

One CSV per (office, vehicle type) of every month-end snapshot, in one
folder per run date (``<run date>_RTO_Files``, run date = data date + 1), in the report
layout (title, two lines, header on line 4, serial column, unnamed total
column, a trailing TOTAL row and a blank row); ``_`` in an office name is
written as a space, since it separates the vehicle type. Offices of MIDDLE EAST get a
file name without office code, so the reader must quarantine them. Files are
written by the tasks of one ``applyInPandas`` (one group = one file, named by
its key, so a retried task rewrites the same file) into a fresh folder under
the shared checkpoint directory, through Arrow's file systems, so that folder
may be a local mount or an object store. With ``extra`` the sheets of odd run
months carry one fuel column more (``EXTRA_FUEL``), before the total.
"""

from __future__ import annotations

import uuid

import pandas as pd
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from ..sources.reports import read_report_rows
from ..sources.tables import Tables
from . import domain as D


# --- Fixed value of the test domain: a fuel that only some sheets have ----
EXTRA_FUEL = "6-TRIAL"
# --------------------------------------------------------------------------


def _writer(folder: str, extra: bool):
    def write_group(pdf: pd.DataFrame) -> pd.DataFrame:
        r0 = pdf.iloc[0]
        fs, root = _open_folder(folder)
        run_dir = f"{root}/{r0['run_date']}_RTO_Files"
        fs.create_dir(run_dir, recursive=True)
        # "_" separates the vehicle type in a report name, so offices are written with spaces.
        office = str(r0["office"]).replace("_", " ")
        if r0["state"] == "MIDDLE EAST":
            name = f"{office}_{r0['vehicle_type']}.csv"
        else:
            name = f"{office} - {r0['office_code']}_{r0['vehicle_type']}.csv"
        fuels, counts = list(D.FUELS), [f"m{j}" for j in range(len(D.FUELS))]
        if extra and int(str(r0["run_date"])[5:7]) % 2:  # as many as the second fuel has
            fuels, counts = [*fuels, EXTRA_FUEL], [*counts, "m1"]
        lines = [
            f'"Maker Wise Fuel Data of {office} - {r0["office_code"]} , {r0["state"]} (2001)"',
            "Month to date",
            "",
            ",".join(["S No", "Maker", *[f'"{f}"' for f in fuels], ""]),
        ]
        pdf = pdf.sort_values("maker")
        for i, r in enumerate(pdf.itertuples(index=False), start=1):
            lines.append(",".join([str(i), r.maker, *[str(int(getattr(r, c))) for c in counts], str(int(r.total))]))
        lines.append(",".join(["", "TOTAL", *[str(int(pdf[c].sum())) for c in counts], str(int(pdf["total"].sum()))]))
        lines.append(",".join([""] * (len(fuels) + 3)))
        with fs.open_output_stream(f"{run_dir}/{name}") as out:
            out.write(("\n".join(lines) + "\n").encode())
        return pd.DataFrame({"file_name": [name], "rows": [len(pdf)]})

    return write_group


def _open_folder(folder: str):
    return pyarrow.fs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")


def write_named_files(files: DataFrame, folder: str) -> str:
    """Write every row ``(name, body)`` as a file of that name (a retried task rewrites the same files); returns the folder."""

    def write(batches):
        fs, root = _open_folder(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for name, body in zip(batch["name"], batch["body"]):
                with fs.open_output_stream(f"{root}/{name}") as out:
                    out.write(body.encode())
            yield batch[["name"]]

    files.select("name", "body").mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()
    return folder


def export_month_end_reports(spark: SparkSession, data_dir: str, extra: bool = False) -> str:
    """Write the reports of every month-end snapshot; return the landing folder. Runs one job."""
    t = Tables(spark, data_dir)
    days = D.checked_calendar(t)
    snap = D.mtd_snapshots(t, days=days)
    idx = F.broadcast(D.snapshot_index_for(days))
    last = snap.join(idx.where(F.col("next_date").isNull()).select("snapshot_date"), "snapshot_date", "left_semi")
    od = D.office_dim(t).select("office", "office_code", "state")
    rows = last.join(od, "office").select(
        F.date_format(F.date_add("snapshot_date", 1), "yyyy-MM-dd").alias("run_date"),
        "office", "office_code", "state", "vehicle_type", "maker",
        *[F.col(f"`{f}`").alias(f"m{j}") for j, f in enumerate(D.FUELS)], F.col("TOTAL").alias("total"),
    )
    folder = scratch_path(spark, f"reports-{uuid.uuid4().hex}")
    written = rows.groupBy("run_date", "office", "vehicle_type").applyInPandas(_writer(folder, extra), "file_name string, rows long")
    written.write.format("noop").mode("overwrite").save()
    return folder


def reports_fixture(spark: SparkSession, data_dir: str, extra: bool = False) -> DataFrame:
    """The sheet rows of the reports, parsed once and stored (two passes read them)."""
    return materialize(read_report_rows(spark, export_month_end_reports(spark, data_dir, extra)), "sheets")

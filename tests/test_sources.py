"""File sources and sinks: snapshot CSV folders, JSON maps/manifests, report matrices, CSV export."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cumulus.operators.delta import snapshot_delta
from cumulus.operators.dims import read_json_map
from cumulus.operators.quality import read_manifest
from cumulus.sources.files import read_snapshot_csv, write_csv_export
from cumulus.sources.reports import consolidate_reports, read_report_rows
from tests.conftest import rows

HEAD = "scrape_timestamp,timestamp,state,rto,rto_number,vehicle_type,district,OEM,PETROL,DIESEL,TOTAL\n"


def test_snapshot_folder_to_increments(spark, tmp_path):
    (tmp_path / "2026-05-02.csv").write_text(HEAD + "02-05-2026,01-05-2026,Kerala,ADOOR SRTO,KL26,motor_car,X,HONDA,1,0,1\n")
    (tmp_path / "2026-05-03.csv").write_text(
        HEAD + "03-05-2026,02-05-2026,Kerala,ADOOR SRTO,KL26,motor_car,X,HONDA,3,1,4\n"
        "03-05-2026,02-05-2026,Kerala,ALUVA SRTO,KL41,motor_car,Y,KIA,2,,2\n"
    )
    snaps = read_snapshot_csv(spark, str(tmp_path))
    assert {"RTO", "Maker", "snapshot_date", "source_file"} <= set(snaps.columns)
    assert rows(snaps.select("snapshot_date").distinct()) == [(dt.date(2026, 5, 1),), (dt.date(2026, 5, 2),)]
    delta = snapshot_delta(snaps.drop("source_file"), ["RTO", "vehicle_type", "Maker"])
    got = {(r.snapshot_date.day, r.RTO): (r.PETROL, r.DIESEL, r.TOTAL) for r in delta.collect()}
    assert got == {(1, "ADOOR SRTO"): (1, 0, 1), (2, "ADOOR SRTO"): (2, 1, 3), (2, "ALUVA SRTO"): (2, 0, 2)}


def test_snapshot_date_from_file_name_without_timestamp(spark, tmp_path):
    (tmp_path / "2026-05-04.csv").write_text("rto,vehicle_type,Maker,PETROL\nA,car,M,1\n")
    snaps = read_snapshot_csv(spark, str(tmp_path))
    assert snaps.first()["snapshot_date"] == dt.date(2026, 5, 3)


def test_json_map_and_manifest(spark, tmp_path):
    (tmp_path / "office_districts.json").write_text(json.dumps({"ADOOR SRTO": "Pathanamthitta", "CHECK POST": ""}))
    m = read_json_map(spark, str(tmp_path / "office_districts.json"), "office", "district")
    assert rows(m) == [("ADOOR SRTO", "Pathanamthitta"), ("CHECK POST", "")]
    (tmp_path / "manifest.json").write_text(json.dumps([" A - TN1_motor_car.xlsx", "", "B - KL2_motor_cab.xlsx "]))
    man = read_manifest(spark, str(tmp_path / "manifest.json"))
    assert rows(man, "name") == [("A - TN1_motor_car.xlsx",), ("B - KL2_motor_cab.xlsx",)]


REPORT = (
    '"Maker Wise Fuel Data of ADOOR SRTO - KL26 , Kerala (2026)"\n'
    "Month wise\n"
    "\n"
    "S No,Maker,PETROL,DIESEL,\n"
    "1, HONDA CARS INDIA LTD ,3,1,4\n"
    "2,UNLISTED MAKER,5,5,10\n"
    "3,KIA INDIA PRIVATE LIMITED,x,2.9,2\n"
    ",TOTAL,8,6,16\n"
    ",,,,\n"
)


def test_report_matrices_to_snapshot_rows(spark, tmp_path):
    day = tmp_path / "2026-05-03_RTO_Files"
    day.mkdir()
    (day / "ADOOR SRTO - KL26_motor_car.csv").write_text(REPORT)
    (day / "3f2a9c_motor_car.csv").write_text(REPORT)  # name without office code
    (day / "BROKEN - KL1_motor_car.csv").write_text("only one line\n")
    cells = read_report_rows(spark, str(tmp_path))
    district = spark.createDataFrame([("ADOOR SRTO", "Pathanamthitta")], "k string, d string")
    wide, bad = consolidate_reports(cells, None, district, fuels=["PETROL", "DIESEL", "TOTAL"])
    got = {r.Maker: (r.PETROL, r.DIESEL, r.TOTAL, r.district, r.state, r.rto_number, r.timestamp) for r in wide.collect()}
    assert got == {
        "HONDA CARS INDIA LTD": (3, 1, 4, "Pathanamthitta", "Kerala", "KL26", "02-05-2026"),
        "KIA INDIA PRIVATE LIMITED": (0, 2, 2, "Pathanamthitta", "Kerala", "KL26", "02-05-2026"),
    }
    reasons = {r.path.rsplit("/", 1)[-1]: r.error for r in bad.collect()}
    assert reasons["3f2a9c_motor_car.csv"] == "file name does not parse"
    assert "BROKEN - KL1_motor_car.csv" in reasons


def test_csv_export_per_month(spark, tmp_path):
    df = spark.createDataFrame([("2026-04", "a", ""), ("2026-05", "b", None)], "month string, k string, v string")
    out = str(tmp_path / "mtd")
    write_csv_export(df, out, ["month"])
    write_csv_export(df.where(F.col("month") == "2026-05").withColumn("k", F.lit("c")), out, ["month"])
    back = spark.read.option("header", True).csv(out).select("month", "k")
    assert rows(back) == [("2026-04", "a"), ("2026-05", "c")]


def test_observed_counts_and_sorted_write(spark, tmp_path):
    from cumulus.sources.files import observed, write_table

    df = spark.createDataFrame([(3, "b"), (1, "a"), (2, "a")], "v int, k string")
    df2, obs = observed(df, "out")
    write_table(df2, str(tmp_path / "t"), partition_by=["k"], sort_by=["v"])
    assert obs.get["rows"] == 3
    assert rows(spark.read.parquet(str(tmp_path / "t")), "k", "v") == [("a", 1), ("a", 2), ("b", 3)]


def test_no_snapshot_is_an_error(spark):
    import pytest

    from cumulus.operators.snapshots import latest_by, require_snapshots

    empty = spark.createDataFrame([], "snapshot_date date, k string")
    with pytest.raises(FileNotFoundError):
        require_snapshots(empty)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string")
    assert rows(latest_by(df, [F.col("v").desc()]), "v") == [(2,)]


def test_csv_edge_keeps_empty_string_and_null_apart(spark, tmp_path):
    df = spark.createDataFrame([("a", ""), ("b", None)], "k string, v string")
    out = str(tmp_path / "edge")
    write_csv_export(df, out)
    text = "".join(p.read_text() for p in (tmp_path / "edge").glob("*.csv"))
    assert 'a,""' in text and "b,\n" in text
    from cumulus.sources.files import read_csv_export

    back = read_csv_export(spark, out)
    assert rows(back, "k", "v") == [("a", ""), ("b", None)]


def test_report_title_from_the_top_left_window(spark, tmp_path):
    day = tmp_path / "2026-05-03_RTO_Files"
    day.mkdir()
    body = '\n,,"Maker Wise Fuel Data of ADOOR SRTO - KL26 , Kerala"\n\nS No,Maker,PETROL,\n1,HONDA CARS INDIA LTD,3,3\n'
    (day / "ADOOR SRTO - KL26_motor_car.csv").write_text(body)
    cells = read_report_rows(spark, str(tmp_path))
    assert {r.title for r in cells.collect()} == {"Maker Wise Fuel Data of ADOOR SRTO - KL26 , Kerala"}


def test_padded_title_keeps_the_total():
    from cumulus.sources.reports import _parse_one

    content = b'"Maker Wise, Kerala",,,\n,,,\n,,,\nS No,Maker,PETROL,\n1,ACME,4,10\n'
    assert [(r[3], dict(r[4])) for r in _parse_one("x.csv", content)] == [("ACME", {"PETROL": "4", "TOTAL": "10"})]


def test_unreadable_formats_are_quarantined(spark, tmp_path):
    from cumulus.sources.reports import read_report_rows

    (tmp_path / "a.txt").write_text("x")
    (tmp_path / "b.xlsx").write_bytes(b"no sheet")
    errors = {r.path.rsplit("/", 1)[1]: r.error for r in read_report_rows(spark, str(tmp_path)).collect()}
    assert set(errors) == {"a.txt", "b.xlsx"} and all(errors.values())


def test_each_snapshot_file_is_read_by_its_own_header(spark, tmp_path):
    (tmp_path / "2025-05-02_a.csv").write_text("State,PETROL,DIESEL\nKL,1,100\nTN,3,\n")
    (tmp_path / "2025-05-03_b.csv").write_text("State,DIESEL,PETROL\nKL,100,1\n")
    (tmp_path / "2025-05-04 [new].csv").write_text('\ufeffState, PETROL ,"GAS, LIQUID"\nKL,2,"7"\n')
    (tmp_path / "2025-05-05_empty.csv").write_text("")
    (tmp_path / "2025-05-06_bare.csv").write_text("State,PETROL,DIESEL\n")
    snaps = read_snapshot_csv(spark, str(tmp_path))
    got = {(r.snapshot_date.day, r.State): (r.PETROL, r.DIESEL, r["GAS, LIQUID"]) for r in snaps.collect()}
    assert got == {(1, "KL"): ("1", "100", None), (1, "TN"): ("3", None, None), (2, "KL"): ("1", "100", None), (3, "KL"): ("2", None, "7")}
    with pytest.raises(Exception):  # noqa: B017 - Spark's own error for a missing folder
        read_snapshot_csv(spark, str(tmp_path / "none"))


def test_newest_files_by_both_orders(spark, tmp_path):
    import os

    from cumulus.sources.files import newest_files, snapshot_files

    for name, when in (("2026-05-03.csv", 10**9), ("2026-05-02.csv", 2 * 10**9), ("export.csv", 1_790_000_000), ("old.csv", 10**9), ("x.txt", 0)):
        (tmp_path / name).write_text("a\n1\n")
        os.utime(tmp_path / name, (when, when))
    files = snapshot_files(spark, str(tmp_path))
    assert [r.name for r in newest_files(files, 3)] == ["2026-05-03.csv", "2026-05-02.csv", "export.csv"]
    assert [r.name for r in newest_files(files, 2, dated_first=False)] == ["export.csv", "2026-05-03.csv"]
    assert [r.name for r in newest_files(files.where("name_date is null"))] == ["export.csv"]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        newest_files(files.limit(0))


def test_manifest_must_be_an_array(spark, tmp_path):
    from cumulus.operators.quality import read_manifest

    (tmp_path / "m.json").write_text('{"a": "b"}')
    with pytest.raises(Exception, match="not a JSON array"):
        read_manifest(spark, str(tmp_path / "m.json")).collect()
    (tmp_path / "n.json").write_text('["a", " b ", ""]')
    assert [r.name for r in read_manifest(spark, str(tmp_path / "n.json")).orderBy("pos").collect()] == ["a", "b"]

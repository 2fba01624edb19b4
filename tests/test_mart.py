"""Mart (C4), audit (C5) and month-to-date (C6) with the vehicle-registration fixed maps."""

import datetime as dt

from cumulus.functions.schema import FUEL_COLUMNS
from cumulus.operators.dims import FUEL_GROUPS, MAKER_SHORT, ZONE_BY_STATE
from cumulus.operators.mart import audit_totals, build_mart, month_to_date
from tests.conftest import rows

IDS = ["scrape_timestamp", "timestamp", "state", "RTO", "rto_number", "vehicle_type", "district", "Maker"]


def _master(spark):
    def row(ts, state, rto, maker, **fuels):
        vals = [str(fuels.get(f.replace("/", "_").replace("(", "_").replace(")", "_").replace(" ", "_").replace("-", "_"), 0))
                for f in FUEL_COLUMNS]
        return ["x", ts, state, rto, "KA1", "motor_car", "D", maker, *vals, "0"]

    data = [
        row("02-05-2026", "Karnataka", "BAGALKOT  RTO", "MARUTI SUZUKI INDIA LTD", PETROL=3, PETROL_CNG=2, LPG_ONLY=5),
        row("03-05-2026", "Kerala", "ADOOR SRTO", "UNKNOWN MAKER", DIESEL=1, PURE_EV=4),
        row("30-04-2026", "Tamil Nadu", "UNMAPPED RTO", "TATA MOTORS LTD", STRONG_HYBRID_EV="2.9", PETROL="junk"),
    ]
    schema = ", ".join(f"`{c}` string" for c in [*IDS, *FUEL_COLUMNS, "TOTAL"])
    return spark.createDataFrame(data, schema)


def _office(spark):
    return spark.createDataFrame([("BAGALKOT  RTO", "North", "Bijapur", "AO1"), ("ADOOR SRTO", "South", "Pathanamthitta", "AO2")],
                                 "RTO string, cluster string, city string, AO string")


def test_mart_groups_maps_and_calendar(spark):
    mart = build_mart(spark, _master(spark), _office(spark), FUEL_GROUPS, MAKER_SHORT, ZONE_BY_STATE)
    got = rows(mart, "Date", "RTO", "FuelGroup", "Regn Vol", "maker_short", "cluster", "Zone", "FY", "month", "Qtr")
    assert got == [
        (dt.date(2026, 4, 30), "UNMAPPED RTO", "Strong-Hybrid", 2, "Tata", None, "S2", "2026-27", "April", "Q1"),
        (dt.date(2026, 5, 2), "BAGALKOT  RTO", "CNG", 2, "Maruti", "North", "S1", "2026-27", "May", "Q1"),
        (dt.date(2026, 5, 2), "BAGALKOT  RTO", "Petrol", 3, "Maruti", "North", "S1", "2026-27", "May", "Q1"),
        (dt.date(2026, 5, 3), "ADOOR SRTO", "Diesel", 1, None, "South", "S3", "2026-27", "May", "Q1"),
        (dt.date(2026, 5, 3), "ADOOR SRTO", "EV", 4, None, "South", "S3", "2026-27", "May", "Q1"),
    ]
    mtd = month_to_date(mart)
    assert {r.Date for r in mtd.collect()} == {dt.date(2026, 5, 2), dt.date(2026, 5, 3)}


def test_audit_reports_unmapped_fuel_loss(spark):
    a = audit_totals(_master(spark), _office(spark), FUEL_GROUPS).first()
    # LPG ONLY (5) is not in any fuel group; 2.9 counts as 2.9 before the mart truncates it.
    assert (a.initial_total, a.final_total, a.unmapped_fuel_rows, a.unmapped_fuel_volume) == (17, 12, 1, 5)
    assert a.missing_ao_rows == 1 and a.verdict == "loss"

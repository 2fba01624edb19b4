"""End to end: daily runs over report folders, replays, corrections, mart and checks."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from cumulus.jobs import Store, build_outputs, check_inputs, correct_month, increments_for_month, ingest_day, latest_period, ledger, read_facts
from cumulus.operators.quality import MissingFilesError
from tests.conftest import rows

FUELS = ["PETROL", "DIESEL", "PURE EV"]
MAY = dt.date(2026, 5, 1)


def write_report(folder, office, code, vt, makers):
    lines = [f'"Maker Wise Fuel Data of {office} - {code} , Kerala (2026)"', "Month to date", "",
             "S No,Maker," + ",".join(FUELS) + ","]
    for i, (maker, counts) in enumerate(makers.items(), start=1):
        vals = [counts.get(f, 0) for f in FUELS]
        lines.append(",".join([str(i), maker, *map(str, vals), str(sum(vals))]))
    lines.append(",TOTAL," + ",".join(["0"] * (len(FUELS) + 1)))
    (folder / f"{office} - {code}_{vt}.csv").write_text("\n".join(lines) + "\n")


def land(root, run, reports):
    folder = root / f"{run}_RTO_Files"
    folder.mkdir(parents=True, exist_ok=True)
    for f in folder.iterdir():
        f.unlink()
    for (office, code, vt), makers in reports.items():
        write_report(folder, office, code, vt, makers)
    return str(folder)


DAYS = {
    dt.date(2026, 5, 2): {("ADOOR SRTO", "KL26", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 2}}},
    dt.date(2026, 5, 3): {("ADOOR SRTO", "KL26", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 5, "DIESEL": 1}},
                          ("ALUVA SRTO", "KL41", "motor_car"): {"KIA INDIA PRIVATE LIMITED": {"PURE EV": 1}}},
    dt.date(2026, 5, 4): {("ADOOR SRTO", "KL26", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 6, "DIESEL": 1}},
                          ("ALUVA SRTO", "KL41", "motor_car"): {"KIA INDIA PRIVATE LIMITED": {"PURE EV": 3}}},
}


def month_sums(spark, store):
    facts = read_facts(spark, store)
    return rows(facts.groupBy("RTO", "Maker").agg(*[F.sum(F.col(f"`{f}`")).alias(f) for f in FUELS]))


def last_snapshot(spark, store):
    s = spark.read.parquet(store.path("snapshots"))
    last = s.where(F.col("snapshot_date") == s.agg(F.max("snapshot_date")).first()[0])
    return rows(last.select("RTO", "Maker", *[F.col(f"`{f}`") for f in FUELS]))


def test_daily_runs_replay_corrections_and_outputs(spark, tmp_path):
    store = Store(str(tmp_path / "store"))
    landing = tmp_path / "landing"
    counts = []
    for run, reports in DAYS.items():
        counts.append(ingest_day(spark, store, land(landing, run, reports), run))
        increments_for_month(spark, store, MAY)
    assert counts[-1] == {"snapshot_rows": 2, "quarantined_files": 0}
    assert month_sums(spark, store) == last_snapshot(spark, store)
    daily = rows(spark.read.parquet(store.path("facts")).where("RTO = 'ADOOR SRTO'").select("timestamp", "PETROL"))
    assert daily == [("01-05-2026", 2), ("02-05-2026", 3), ("03-05-2026", 1)]

    # Replaying a day leaves the tables unchanged.
    before = rows(spark.read.parquet(store.path("facts")))
    run = dt.date(2026, 5, 3)
    ingest_day(spark, store, land(landing, run, DAYS[run]), run)
    increments_for_month(spark, store, MAY)
    assert rows(spark.read.parquet(store.path("facts"))) == before

    # The portal revises the latest day; the correction makes the facts add up again, once.
    revised = {k: dict(v) for k, v in DAYS[dt.date(2026, 5, 4)].items()}
    revised[("ADOOR SRTO", "KL26", "motor_car")] = {"HONDA CARS INDIA LTD": {"PETROL": 8, "DIESEL": 1}}
    run = dt.date(2026, 5, 4)
    ingest_day(spark, store, land(landing, run, revised), run)
    for _ in range(2):
        assert correct_month(spark, store, MAY, dt.date(2026, 5, 4)) == 2  # one row per key, all-zero kept
        assert month_sums(spark, store) == last_snapshot(spark, store)
    fillers = ledger(spark, store).read()
    assert fillers.where("PETROL <> 0").select("RTO", "PETROL").collect()[0].asDict() == {"RTO": "ADOOR SRTO", "PETROL": 2}

    office_dim = spark.createDataFrame([("ADOOR SRTO", "C1", "Pathanamthitta", "AO1")], "RTO string, cluster string, city string, AO string")
    audit = build_outputs(spark, store, office_dim, export=str(tmp_path / "mtd")).first()
    assert audit.verdict == "preserved" and audit.initial_total == 12 and audit.missing_ao_rows > 0
    mart = spark.read.parquet(store.path("mart"))
    assert mart.agg(F.sum("Regn Vol")).first()[0] == 12
    assert spark.read.option("header", True).csv(str(tmp_path / "mtd")).count() == mart.count()


def test_check_inputs(spark, tmp_path):
    landing = tmp_path / "2026-05-03_RTO_Files"
    landing.mkdir()
    write_report(landing, "ADOOR SRTO", "KL26", "motor_car", {"HONDA CARS INDIA LTD": {"PETROL": 1}})
    (landing / "3f2a_motor_cab.csv").write_text('"Maker Wise Fuel Data of ALUVA SRTO - KL41 , Kerala"\nx\n\nS No,Maker,PETROL,\n')
    manifest = tmp_path / "files.json"
    manifest.write_text(json.dumps(["ADOOR SRTO - KL26_motor_car.csv", "ADOOR SRTO - KL26_motor_cab.csv", "ALUVA SRTO - KL41_motor_cab.csv"]))
    out = check_inputs(spark, str(landing), str(manifest), ext=".csv")
    assert rows(out["missing"], "name") == [("ADOOR SRTO - KL26_motor_cab.csv",), ("ALUVA SRTO - KL41_motor_cab.csv",)]
    assert rows(out["targets"], "rto_code", "vehicle_type", "state") == [("KL26", "motor_cab", "Kerala"), ("KL41", "motor_cab", "Kerala")]
    assert rows(out["totals"]) == [(3, 2, 2)]
    audit = {r.path.rsplit("/", 1)[-1]: (r.status, r.new_path) for r in out["headers"].collect()}
    assert audit["ADOOR SRTO - KL26_motor_car.csv"][0] == "ok"
    with pytest.raises(MissingFilesError, match="2 expected"):
        check_inputs(spark, str(landing), str(manifest), ext=".csv", fail_on_missing=True)
    assert audit["3f2a_motor_cab.csv"][0] == "mismatch" and audit["3f2a_motor_cab.csv"][1].endswith("/ALUVA SRTO - KL41_motor_cab.csv")


def test_compat_keys_merge_one_office_name_with_two_codes(spark, tmp_path):
    from cumulus.jobs import COMPAT_KEYS

    store = Store(str(tmp_path / "store"))
    landing = tmp_path / "landing"
    days = {
        dt.date(2026, 5, 2): {("STATE TRANSPORT AUTHORITY", "KA99", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 1}},
                              ("STATE TRANSPORT AUTHORITY", "TN999", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 4}}},
        dt.date(2026, 5, 3): {("STATE TRANSPORT AUTHORITY", "KA99", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 2}},
                              ("STATE TRANSPORT AUTHORITY", "TN999", "motor_car"): {"HONDA CARS INDIA LTD": {"PETROL": 4}}},
    }
    for run, reports in days.items():
        ingest_day(spark, store, land(landing, run, reports), run)
    increments_for_month(spark, store, MAY)  # default: the office code is part of the key
    by_code = rows(spark.read.parquet(store.path("facts")).where("timestamp = '02-05-2026'").select("rto_number", "PETROL"))
    assert by_code == [("KA99", 1), ("TN999", 0)]
    increments_for_month(spark, store, MAY, keys=COMPAT_KEYS)  # the source's key merges the two offices
    merged = rows(spark.read.parquet(store.path("facts")).where("timestamp = '02-05-2026'").select("RTO", "PETROL"))
    assert merged == [("STATE TRANSPORT AUTHORITY", 1)]


def test_late_correction_stays_in_the_month_it_corrects(spark, tmp_path):
    store, landing = Store(str(tmp_path / "store")), tmp_path / "landing"
    key = ("ADOOR SRTO", "KL26", "motor_car")
    reports = {dt.date(2026, 5, 31): 7, dt.date(2026, 6, 1): 9, dt.date(2026, 6, 2): 1, dt.date(2026, 6, 3): 2}
    for run, n in reports.items():
        ingest_day(spark, store, land(landing, run, {key: {"HONDA CARS INDIA LTD": {"PETROL": n}}}), run)
    for month in (MAY, dt.date(2026, 6, 1)):
        increments_for_month(spark, store, month)
    # May's last report is revised in June; May is corrected on the 3rd and again on the 10th.
    ingest_day(spark, store, land(landing, dt.date(2026, 6, 1), {key: {"HONDA CARS INDIA LTD": {"PETROL": 12}}}), dt.date(2026, 6, 1))
    for run in (dt.date(2026, 6, 3), dt.date(2026, 6, 10), dt.date(2026, 6, 3)):
        assert correct_month(spark, store, MAY, run) == 1
    kept = rows(ledger(spark, store).read().select("corrected_month", "run_date", "timestamp", "scrape_timestamp", "PETROL"))
    assert kept == [
        (MAY, dt.date(2026, 6, 3), "31-05-2026", "03-06-2026", 3),
        (MAY, dt.date(2026, 6, 10), "31-05-2026", "10-06-2026", 0),
    ]
    by_month = read_facts(spark, store).groupBy(F.substring("timestamp", 4, 7).alias("month")).agg(F.sum("PETROL").alias("n"))
    assert rows(by_month) == [("05-2026", 12), ("06-2026", 2)]
    assert correct_month(spark, store, dt.date(2026, 7, 1), dt.date(2026, 7, 2)) == 0  # no snapshot: no write

    # Only the touched period of the mart is read and rewritten.
    dim = spark.createDataFrame([("ADOOR SRTO", "C1", "P", "AO1")], "RTO string, cluster string, city string, AO string")
    build_outputs(spark, store, dim)
    files = {f for f in spark.read.parquet(store.path("mart")).inputFiles() if "period=2026-05" in f}
    audit = build_outputs(spark, store, dim, months=[dt.date(2026, 6, 1)]).first()
    assert (audit.initial_total, audit.final_total, audit.written_total, audit.verdict) == (2, 2, 2, "preserved")
    after = spark.read.parquet(store.path("mart"))
    assert files == {f for f in after.inputFiles() if "period=2026-05" in f}
    assert rows(after.groupBy("period").agg(F.sum("Regn Vol").alias("n"))) == [("2026-05", 12), ("2026-06", 2)]
    plan = latest_period(spark, store)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and "2026-06" in plan
    plan = read_facts(spark, store, [MAY])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PartitionFilters: []") == 0


def test_a_new_fuel_becomes_a_column(spark, tmp_path, monkeypatch):
    store, landing = Store(str(tmp_path / "store")), tmp_path / "landing"
    key = ("ADOOR SRTO", "KL26", "motor_car")
    for day, counts in ((2, {"PETROL": 2}), (3, {"PETROL": 3, "AMMONIA": 4}), (4, {"PETROL": 3, "AMMONIA": 6})):
        if "AMMONIA" in counts:
            monkeypatch.setitem(globals(), "FUELS", [*FUELS[:3], "AMMONIA"])
        run = dt.date(2026, 5, day)
        ingest_day(spark, store, land(landing, run, {key: {"HONDA CARS INDIA LTD": counts}}), run)
        increments_for_month(spark, store, MAY)
    facts = read_facts(spark, store)
    assert rows(facts, "timestamp", "PETROL", "AMMONIA", "TOTAL") == [("01-05-2026", 2, 0, 2), ("02-05-2026", 1, 4, 5), ("03-05-2026", 0, 2, 2)]
    assert correct_month(spark, store, MAY, dt.date(2026, 5, 4)) == 1
    dim = spark.createDataFrame([("ADOOR SRTO", "C1", "P", "AO1")], "RTO string, cluster string, city string, AO string")
    groups = {"Petrol": ["PETROL"], "New": ["AMMONIA"]}
    assert build_outputs(spark, store, dim, fuel_groups=groups).first().verdict == "preserved"
    mart = spark.read.parquet(store.path("mart"))
    assert rows(mart.groupBy("FuelGroup").agg(F.sum("Regn Vol").alias("n"))) == [("New", 6), ("Petrol", 3)]
    # a fuel that no group names is a loss, and an office that the dimension holds twice a gain
    audit = build_outputs(spark, store, dim, fuel_groups={"Petrol": ["PETROL"]}).first()
    assert (audit.verdict, audit.unmapped_fuel_rows, audit.unmapped_fuel_volume) == ("loss", 2, 6)
    audit = build_outputs(spark, store, dim.union(dim), fuel_groups=groups).first()
    assert (audit.verdict, audit.initial_total, audit.after_fuel_map_total, audit.final_total, audit.written_total) == ("gain", 9, 9, 18, 18)

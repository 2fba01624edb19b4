"""Scalar expressions (SC1-SC18) and schema helpers (PRJ1-PRJ9)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cumulus.functions import scalars as S
from cumulus.operators.reconcile import monthly_summary
from cumulus.functions.schema import conform, measure_columns, normalize_headers, numeric_columns


class spark_case_sensitive:
    """Build a frame with case-only duplicate names (needs case-sensitive resolution)."""

    def __init__(self, spark):
        self.spark = spark

    def __enter__(self):
        self.spark.conf.set("spark.sql.caseSensitive", "true")

    def __exit__(self, *exc):
        self.spark.conf.set("spark.sql.caseSensitive", "false")


def one(spark, expr, value, typ="string"):
    df = spark.createDataFrame([(value,)], f"x {typ}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "name,expected",
    [
        ("CHENNAI (NORTH-EAST) RTO - TN04_motor_car.xlsx", ("Tamil Nadu", "CHENNAI (NORTH-EAST) RTO", "TN04", "motor_car")),
        ("ADOOR SRTO - KL26_motor_cab.xlsx", ("Kerala", "ADOOR SRTO", "KL26", "motor_cab")),
        ("X - KA1.csv", ("Karnataka", "X", "KA1", "unknown")),
        ("Y - PY2_a_b.xlsx", ("Puducherry", "Y", "PY2", "a_b")),
        ("Z - MH12_motor_car.xlsx", ("Unknown", "Z", "MH12", "motor_car")),
    ],
)
def test_parse_report_filename(spark, name, expected):
    r = one(spark, S.parse_report_filename, name)
    assert (r.state, r.office, r.office_code, r.vehicle_type) == expected


def test_parse_report_filename_unparsable_is_null(spark):
    assert one(spark, S.parse_report_filename, "3f2a9c_motor_car.xlsx") is None
    assert one(spark, S.parse_report_filename, "office - tn4_motor_car.xlsx") is None


@pytest.mark.parametrize("text,value", [("12", 12.0), (" 2.9 ", 2.9), ("-3", -3.0), (".5", 0.5), ("1e3", 1000.0),
                                        ("1,234", None), ("", None), ("abc", None), ("nan", None), ("Infinity", None)])
def test_to_number(spark, text, value):
    assert one(spark, S.to_number, text) == value


def test_to_count_truncates_toward_zero(spark):
    assert one(spark, S.to_count, "2.9") == 2
    assert one(spark, S.to_count, "-2.9") == -2
    assert one(spark, S.to_count, "junk") == 0
    assert one(spark, S.to_count, None) == 0


@pytest.mark.parametrize(
    "text,expected",
    [("05-03-2026", dt.date(2026, 3, 5)), ("2026-03-05", dt.date(2026, 3, 5)), ("5/3/2026", dt.date(2026, 3, 5)),
     (" 05-03-2026\t", dt.date(2026, 3, 5)), ("31-02-2026", None), ("yesterday", None)],
)
def test_parse_day_first(spark, text, expected):
    assert one(spark, S.parse_day_first, text) == expected


def test_parse_day_first_strict_fails_on_bad_value(spark):
    df = spark.createDataFrame([("yesterday",)], "x string")
    with pytest.raises(Exception):
        df.select(S.parse_day_first_strict(F.col("x"))).collect()


@pytest.mark.parametrize(
    "day,fy,q",
    [(dt.date(2025, 4, 1), "2025-26", "Q1"), (dt.date(2026, 3, 31), "2025-26", "Q4"), (dt.date(2025, 12, 1), "2025-26", "Q3"),
     (dt.date(2000, 1, 31), "1999-00", "Q4"), (dt.date(2025, 7, 15), "2025-26", "Q2")],
)
def test_fiscal_year_and_quarter(spark, day, fy, q):
    assert one(spark, S.fiscal_year, day, "date") == fy
    assert one(spark, S.fiscal_quarter, day, "date") == q
    assert one(spark, S.month_name, dt.date(2026, 3, 5), "date") == "March"


def test_normalize_text_and_title(spark):
    assert one(spark, S.normalize_text, "  Chennai (North-East)   RTO ") == "chennai rto"
    title = "Maker Wise Fuel Data of BAGALKOT  RTO - KA29 , Karnataka (2026)"
    assert one(spark, S.office_from_title, title) == "BAGALKOT  RTO - KA29"
    assert one(spark, S.office_from_title, "MAKER WISE FUEL DATA OF X - KL1 , Kerala") == "X - KL1"
    assert one(spark, S.office_from_title, None) == ""


@pytest.mark.parametrize(
    "base,expected",
    [("A - TN1_motor_car", ("A - TN1", "motor_car")), ("A - TN1_MOTOR_CAB", ("A - TN1", "motor_cab")),
     ("A_B_other", ("A_B", "other")), ("plain", ("plain", ""))],
)
def test_split_vehicle_suffix(spark, base, expected):
    r = one(spark, S.split_vehicle_suffix, base)
    assert (r.office_part, r.vehicle_type) == expected


def test_file_identity_and_code(spark):
    r = one(spark, S.file_identity, "/x/y/Adoor SRTO (old) - kl26_motor_car.xlsx")
    assert (r.office_code, r.vehicle_type, r.office_norm) == ("KL26", "motor_car", "adoor srto - kl26")
    assert one(spark, S.extract_office_code, "no code here") == ""


def test_code_boundary(spark):
    df = spark.createDataFrame([("OFFICE - TN10", "TN1"), ("OFFICE - TN1", "TN1"), ("OFFICE - tn1 x", "TN1")], "t string, c string")
    got = [r[0] for r in df.select(S.code_boundary_match(F.col("t"), F.col("c"))).collect()]
    assert got == [False, True, True]


def test_strip_ws_keeps_inner_spaces(spark):
    assert one(spark, S.strip_ws, "\t BAGALKOT  RTO \n") == "BAGALKOT  RTO"


def test_normalize_headers_and_collision(spark):
    df = spark.createDataFrame([(1, 2, 3)], "`OEM ` int, `Vehicle Type` int, rto int")
    assert normalize_headers(df).columns == ["Maker", "vehicle_type", "RTO"]
    clash = spark.createDataFrame([(1, 2)], "OEM int, Maker int")
    with pytest.raises(ValueError):
        normalize_headers(clash)
    with spark_case_sensitive(spark):
        case_clash = spark.createDataFrame([(1, 2)], "state int, State int")
    with pytest.raises(ValueError):
        normalize_headers(case_clash)


def test_resolve_measure_numeric_conform(spark):
    df = spark.createDataFrame([("a", "x", "1", "junk", None)], "rto string, Maker string, PETROL string, note string, EV string")
    summed = monthly_summary(df.withColumn("timestamp", F.lit("01-05-2026")).drop("note"), measures=["PETROL"])
    assert [tuple(r) for r in summed.collect()] == [("a", "x", 1.0)]
    with pytest.raises(ValueError):
        monthly_summary(df.drop("rto").withColumn("timestamp", F.lit("01-05-2026")), measures=["PETROL"])
    assert measure_columns(df) == ["PETROL", "note", "EV"]  # ids match case-insensitively
    assert numeric_columns(df) == ["PETROL"]
    out = conform(df, ["Maker", "PETROL", "DIESEL"])
    assert out.columns == ["Maker", "PETROL", "DIESEL"]
    assert out.first()["DIESEL"] is None


def test_mixed_dates_of_every_layout(spark):
    may = "2026-05-01"
    given = {
        "01-05-2026": may, "1-5-2026": may, "1/5/2026": may, "01.05.2026": may, "2026/05/01": may, "2026-5-1": may, " 1 May 2026 ": may,
        "01-MAY-2026": may, "May 1, 2026": may, "may 1st, 2026": may, "1st of": None, "2026-05-01 00:00:00": may, "2026-05-01T10:11:12.5Z": may,
        "1-5-26": may, "5/13/2026": "2026-05-13", "13/5/2026": "2026-05-13", "31-12-99": "1999-12-31", "29-02-2024": "2024-02-29",
        "29-02-2025": None, "0-5-2026": None, "13-13-2026": None, "1-foo-2026": None, "": None, "20260501": None, "x": None, None: None,
    }
    df = spark.createDataFrame([(k,) for k in given], "t string")
    got = {r.t: r.d and str(r.d) for r in df.select("t", S.parse_mixed_dates(F.col("t")).alias("d")).collect()}
    assert got == given

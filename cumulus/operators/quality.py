"""Input completeness against a manifest (C10) and report header audit (C11)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import (
    KNOWN_VEHICLE_TYPES,
    STATE_BY_CODE_PREFIX_COMPLETENESS,
    extract_office_code,
    normalize_text,
    office_from_title,
    split_vehicle_suffix,
    state_from_code,
    strip_ws,
    without_extension,
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """SRC6: JSON array of expected file names -> ``(pos, name)``; blanks dropped, names trimmed.

    A file that is not a JSON array fails the query; an absent one fails when it is read.
    """
    raw = spark.read.text(path, wholetext=True)
    is_array = F.substring(strip_ws(F.col("value")), 1, 1) == "["
    parsed = F.when(is_array, F.from_json("value", "array<string>"))
    failed = F.raise_error(F.lit("the manifest is not a JSON array")).cast("array<string>")
    arr = F.when(parsed.isNull(), failed).otherwise(parsed)
    rows = raw.select(F.posexplode(arr).alias("pos", "name")).select("pos", strip_ws(F.col("name")).alias("name"))
    return rows.where(F.col("name") != "")


class MissingFilesError(RuntimeError):
    """Expected report files are not there; ``names`` holds the first of them in manifest order."""

    def __init__(self, count: int, names: list[str]):
        more = f" and {count - len(names)} more" if count > len(names) else ""
        super().__init__(f"{count} expected file(s) missing: {', '.join(names)}{more}")
        self.count, self.names = count, names


def require_complete(missing: DataFrame, shown: int = 20) -> None:
    """C10: raise :class:`MissingFilesError` when any expected file is missing.

    Only a count and the first ``shown`` names reach the driver, however many files are missing.
    """
    first = missing.select("pos", "name").orderBy("pos", "name").limit(shown).collect()
    if first:
        raise MissingFilesError(missing.count(), [r["name"] for r in first])


def _named(files: DataFrame, path: Column) -> DataFrame:
    """``files`` with ``__base`` (name without folder and extension) and ``__parts`` (office part, vehicle type).

    One projection a step: each regular expression is evaluated once a row and
    none stands inside another, so the generated code stays small.
    """
    staged = files.withColumn("__file", F.regexp_extract(path, r"([^/\\]*)$", 1))
    staged = staged.withColumn("__base", without_extension(F.col("__file")))
    return staged.withColumn("__parts", split_vehicle_suffix(F.col("__base"))).drop("__file")


def with_identity(files: DataFrame, name_col: str = "name") -> DataFrame:
    """SC4: add ``office_code``, ``vehicle_type`` (lower-cased) and ``office_norm`` from the file name."""
    return _named(files, F.col(name_col)).withColumns(
        {
            "office_code": extract_office_code(F.col("__base")),
            "vehicle_type": F.lower("__parts.vehicle_type"),
            "office_norm": normalize_text(F.col("__parts.office_part")),
        }
    ).drop("__base", "__parts")


def folder_index(present: DataFrame, name_col: str = "name", ext: str = ".xlsx") -> DataFrame:
    """AG11 as a relation: present report files keyed by (office_code, vehicle_type).

    Only names with the report extension, a code and a known vehicle type take part.
    """
    p = with_identity(present.where(F.lower(F.col(name_col)).endswith(ext)), name_col)
    return p.where((F.col("office_code") != "") & F.col("vehicle_type").isin(*KNOWN_VEHICLE_TYPES))


def missing_files(expected: DataFrame, present: DataFrame, ext: str = ".xlsx") -> DataFrame:
    """JN6: expected names matched neither by lower-cased exact name nor by (code, vehicle type).

    Two chained left-anti joins (each an equi-join, hash-partitioned or
    broadcast by the planner); an OR of both conditions would plan as a
    nested loop.
    """
    # One distinct listing (name, code, type) feeds both anti joins. A day's listing is
    # thousands of names, so each anti join's build side is small.
    # Columns without nulls: a null test inferred for the join would be carried down through
    # the staged projections, and nest them again.
    some = lambda c: F.coalesce(c, F.lit(""))
    listing = with_identity(present.where(F.lower("name").endswith(ext))).select(
        F.lower("name").alias("__lname"), some(F.col("office_code")).alias("__c"), some(F.col("vehicle_type")).alias("__v")
    ).distinct()
    exact = listing.select("__lname")
    by_code = listing.select("__c", "__v")
    e = with_identity(expected)
    step1 = e.join(exact, F.lower(e["name"]) == exact["__lname"], "left_anti")
    # Only files with a code and a known vehicle type take part in the code match. The others carry
    # a key that no listing holds, one for each name: they stay, and are spread over all tasks.
    indexable = (F.col("office_code") != "") & F.col("vehicle_type").isin(*KNOWN_VEHICLE_TYPES)
    alone = F.concat(F.lit("-"), F.xxhash64("name").cast("string"))
    step1 = step1.withColumn("__code", F.when(indexable, F.col("office_code")).otherwise(alone))
    step2 = step1.join(by_code, (F.col("__code") == F.col("__c")) & (F.col("vehicle_type") == F.col("__v")), "left_anti")
    return step2.drop("__code")


def rescrape_targets(missing: DataFrame, states: Mapping[str, str] = STATE_BY_CODE_PREFIX_COMPLETENESS) -> DataFrame:
    """DD1: one target per (code, vehicle type), first in manifest order; unknown state skipped."""
    known = (F.col("office_code") != "") & F.col("vehicle_type").isin(*KNOWN_VEHICLE_TYPES)
    m = missing.withColumn("state", F.when(known, state_from_code(F.col("office_code"), states, default=None)))
    # First per (code, vehicle type) as an aggregate: combined map-side, so a code
    # listed many times never piles up in one task (a window would). Files without a state leave
    # after it: a filter before would be pushed into the file names' regular expressions.
    first = m.groupBy(F.upper("office_code").alias("rto_code"), "vehicle_type").agg(
        F.min_by(F.struct("state", "name", "pos"), "pos").alias("first")
    ).where(F.col("first.state").isNotNull())
    return first.select(
        "rto_code", "vehicle_type", F.col("first.state").alias("state"), F.col("first.name").alias("expected_filename"),
        F.col("first.pos").alias("pos"),
    )


def targets_per_state(targets: DataFrame) -> DataFrame:
    """AG10: count of re-fetch targets per state (no per-state list is collected)."""
    return targets.groupBy("state").agg(F.count(F.lit(1)).alias("targets"))


def completeness_totals(expected: DataFrame, present: DataFrame, missing: DataFrame, ext: str = ".xlsx") -> DataFrame:
    """AG9: one row (expected, present, missing); three counts joined as scalar subqueries."""
    e = expected.select(F.count(F.lit(1)).alias("n")).scalar()
    p = present.where(F.lower("name").endswith(ext)).select(F.count(F.lit(1)).alias("n")).scalar()
    m = missing.select(F.count(F.lit(1)).alias("n")).scalar()
    return expected.sparkSession.range(1).select(e.alias("expected"), p.alias("present"), m.alias("missing"))


def header_audit(files: DataFrame, path_col: str = "path", title_col: str = "title") -> DataFrame:
    """C11 (SC5-SC9): compare the office in each report's title with its file name.

    ``status``: ``ok`` (normalised names equal), ``mismatch`` (a rename to
    ``new_name`` is proposed), ``no_header`` (no office in the title). A base
    name ``reporttable`` without a vehicle type defaults to ``motor_car``.
    No file is renamed: the result is the decision, for any file tool to apply.
    """
    # One projection a step, as in ``_named``.
    files = files.select(F.col(path_col).alias("path"), office_from_title(F.col(title_col)).alias("office"))
    named = _named(files, F.col("path"))
    base, parts, office = F.col("__base"), F.col("__parts"), F.col("office")
    is_report_table = F.lower(strip_ws(base)) == "reporttable"
    vt = F.when(is_report_table & (parts["vehicle_type"] == ""), F.lit("motor_car")).otherwise(parts["vehicle_type"])
    status = (
        F.when(office == "", "no_header")
        .when(normalize_text(parts["office_part"]) == normalize_text(office), "ok")
        .otherwise("mismatch")
    )
    told = named.withColumns(
        {
            "status": status,
            "new_base": F.regexp_replace(F.concat(office, F.lit("_"), vt), r"^_+|_+$", ""),
            "folder": F.regexp_extract("path", r"^(.*[/\\])", 1),
            "ext": F.regexp_extract("path", r"(\.[^./\\]*)$", 1),
        }
    )
    ext = F.when(F.col("ext") == "", F.lit(".xlsx")).otherwise(F.col("ext"))  # the file keeps its own extension
    mismatch = F.col("status") == "mismatch"
    return told.select(
        "path",
        "status",
        F.when(mismatch, office).alias("header_office"),
        F.when(mismatch, F.concat("folder", "new_base", ext)).alias("new_path"),
    )


def status_counts(audit: DataFrame) -> DataFrame:
    """AG8: files per status."""
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("files"))


def keep_last_per_target(audit: DataFrame) -> DataFrame:
    """WN2: where several files would end up under one name, the file renamed onto it last wins.

    A file that is renamed replaces the one that has the name already, whatever
    their order; of several renamed ones the last path in sorted order stays.

    Target = proposed new path for a mismatch, the file's own path otherwise.
    """
    target = F.coalesce(F.col("new_path"), F.col("path"))
    # An aggregate, not a window: many files aimed at one name are combined map-side.
    last = audit.groupBy(target.alias("target")).agg(F.max_by(F.struct("path", "status"), F.struct(F.col("new_path").isNotNull(), "path")).alias("w"))
    return last.select("target", F.col("w.path").alias("winner"), F.col("w.status").alias("status"))

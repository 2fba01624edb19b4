"""CSV/JSON edge formats: snapshot folders in, partitioned tables and CSV exports out."""

from __future__ import annotations

import csv
import re
from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalars import data_date, parse_day_first
from ..functions.schema import normalize_headers, null_tokens_to_null

DATED_NAME = r"(\d{4}-\d{2}-\d{2})"


def header_layouts(spark: SparkSession, path: str | Sequence[str]) -> list[tuple[list[str], list[str]]]:
    """The distinct headers of a folder's CSV files, each with its files: ``(column names, paths)``.

    The first line of every file is found where the file is read: of the lines
    of its first block the one with the least row number of its task, a minimum
    combined on the map side. What reaches the driver is one line a layout and
    the file names, which its file index holds anyway. Empty files have no
    header and no rows. A header is one line.
    """
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    lines = lines.where("block = 0").withColumn("at", F.monotonically_increasing_id())
    first = lines.groupBy("file").agg(F.min_by("value", "at").alias("header"))
    found = first.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("header").collect()
    return [(next(csv.reader([r.header.lstrip("\ufeff")]), []), [_as_path(f) for f in r.files]) for r in found]


def _as_path(uri: str) -> str:
    """A file's URI as a path that the readers take literally (decoded, glob characters escaped)."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", unquote(uri))


def read_snapshot_csv(spark: SparkSession, path: str | Sequence[str], date_col: str = "snapshot_date",
                      null_tokens: bool = True) -> DataFrame:
    """SRC4 + SNP1: a folder of daily snapshot CSVs as one table, each file read by its own header.

    Every column is read as text (no schema inference pass over the data;
    measures are parsed leniently downstream). Files are grouped by header, one
    scan for each distinct one, and the scans united by column name: order,
    accepted spellings and missing or added columns may differ from file to
    file, and a column that a file lacks is NULL in its rows. Headers are
    trimmed and aliased (PRJ1). ``date_col`` is the data date: the ``timestamp``
    column (day-first) when present and parsable, else the run date in a
    ``YYYY-MM-DD`` file name minus one day, else the file's modification day.
    With ``null_tokens`` the usual missing-value spellings (``NA``, ``None``,
    ``nan``, ...) become NULL, as in the source's reader.
    """
    parts = [_read_layout(spark, names, files, date_col, null_tokens) for names, files in header_layouts(spark, path)]
    if not parts:
        raise FileNotFoundError(f"no snapshot found in {path}")
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), parts)


def _read_layout(spark: SparkSession, names: list[str], files: list[str], date_col: str, null_tokens: bool) -> DataFrame:
    schema = StructType([StructField(name, StringType()) for name in names])
    raw = spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").csv(files)
    raw = raw.select("*", F.col("_metadata.file_name").alias("__file"), F.col("_metadata.file_modification_time").alias("__mtime"))
    df = normalize_headers(raw)
    if null_tokens:
        df = null_tokens_to_null(df, [c for c in df.columns if c not in ("__file", "__mtime")])
    run = F.try_to_date(F.regexp_extract(F.col("__file"), DATED_NAME, 1), "yyyy-MM-dd")
    from_ts = parse_day_first(F.col("timestamp")) if "timestamp" in df.columns else F.lit(None).cast("date")
    d = F.coalesce(from_ts, data_date(run), data_date(F.to_date("__mtime")))
    return df.withColumn(date_col, d).withColumnRenamed("__file", "source_file").drop("__mtime")


def snapshot_files(spark: SparkSession, path: str | Sequence[str], pattern: str = "*.csv") -> DataFrame:
    """SNP1, SNP3: the catalogue of a snapshot folder: ``path, name, length, modified, name_date``, from file metadata alone."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    files = files.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "length", F.col("modificationTime").alias("modified"))
    return files.withColumn("name_date", F.try_to_date(F.regexp_extract("name", DATED_NAME, 1), "yyyy-MM-dd"))


def newest_files(files: DataFrame, n: int = 1, dated_first: bool = True) -> list:
    """The newest ``n`` rows of :func:`snapshot_files`, newest first.

    ``dated_first`` (SNP3): a date in the name wins, modification times count
    among undated files only. Otherwise (SNP1) one order mixes both: the date
    in the name, else the modification time. Equal times go by name. SNP4: an
    empty catalogue is an error.
    """
    when = F.coalesce(F.col("name_date").cast("timestamp"), F.col("modified"))
    order = [F.col("name_date").isNotNull().desc()] if dated_first else []
    found = files.orderBy(*order, when.desc(), F.col("name").desc()).limit(n).collect()
    if not found:
        raise FileNotFoundError("no snapshot found")
    return found


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite", fmt: str = "parquet",
                sort_by: Sequence[str] = ()) -> None:
    """SNK1/SNK3: write a table; with partitions and ``overwrite`` only the partitions present are replaced.

    SO1: ``sort_by`` orders rows inside each output file (``sortWithinPartitions``,
    no global sort and no extra shuffle), which keeps files ordered by key for
    readers and improves Parquet min/max pruning.
    """
    if sort_by:
        df = df.sortWithinPartitions(*sort_by)
    w = df.write.mode(mode).format(fmt).option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored table with the columns of all its files: one that a file lacks is null there (PRJ7)."""
    return spark.read.option("mergeSchema", True).parquet(path)


def _folder(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def table_exists(spark: SparkSession, path: str) -> bool:
    folder, fs = _folder(spark, path)
    return fs.exists(folder)


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """Values of the first partition column of a stored table, sorted, from one folder listing (no data is read)."""
    folder, fs = _folder(spark, path)
    if not fs.exists(folder):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(folder)]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{column}="))


def drop_partition(spark: SparkSession, path: str, partition: str) -> None:
    """Delete one partition folder of a stored table, if it is there."""
    folder, fs = _folder(spark, f"{path}/{partition}")
    fs.delete(folder, True)


def write_csv_export(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """SNK1/SNK2 at the CSV edge: header, empty string kept distinct from NULL, one folder per partition.

    Used for the month-to-date export (``partition_by=["month"]``): each
    month's folder is replaced as the month grows, other months untouched.
    """
    w = (
        df.write.mode("overwrite")
        .option("header", True)
        .option("emptyValue", '""')
        .option("nullValue", "")
        .option("partitionOverwriteMode", "dynamic")
    )
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def observed(df: DataFrame, name: str):
    """AG7: attach a row-count ``Observation``; read ``obs.get`` after the first action.

    The count is gathered while the data is written or collected, so it costs
    no second job over the data.
    """
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def read_csv_export(spark: SparkSession, path: str) -> DataFrame:
    """Read a :func:`write_csv_export` folder back with ``""`` and NULL kept apart.

    Quoted ``""`` is an empty string and an unquoted empty field is NULL; the
    default reader folds both into NULL, so ``nullValue`` is set to a control
    character that never occurs in the data.
    """
    return spark.read.option("header", True).option("nullValue", "\u0001").csv(path)

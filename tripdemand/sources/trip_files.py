"""Trip file listing, per-file schema classification and scans."""

from __future__ import annotations

from collections.abc import Iterator
from urllib.parse import urlparse

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripdemand.schemas import GPS_SCHEMA, ZONE_CODED_SCHEMA, ZONE_HEADER_TOKEN

# Fixed value: trip files are the objects whose key starts with this prefix.
TRIP_FILE_PREFIX = "yellow"


def list_trip_files(spark: SparkSession, root: str, prefix: str = TRIP_FILE_PREFIX) -> list[str]:
    """Every file under ``root`` whose path relative to ``root`` starts with
    ``prefix`` (an object-store key prefix).

    Uses the file index of a text scan (a listing, no data read); Spark's
    own marker files (``_SUCCESS``, ``.crc``) are skipped by the index.
    """
    files = (spark.read.option("recursiveFileLookup", True).text(root).inputFiles())
    base = urlparse(root).path.rstrip("/") + "/"
    out = []
    for uri in files:
        path = urlparse(uri).path
        rel = path[path.find(base) + len(base):] if base in path else path.rsplit("/", 1)[-1]
        if rel.startswith(prefix):
            out.append(uri)
    return sorted(out)


# Settings of the session that reads first lines: a file is one split and one task
# (no file is that large), and rows come to Python in batches of a few.
_WHOLE_FILE = str(1 << 60)
HEADER_CONF = {"spark.sql.files.maxPartitionBytes": _WHOLE_FILE, "spark.sql.files.openCostInBytes": _WHOLE_FILE,
               "spark.sql.execution.arrow.maxRecordsPerBatch": "64"}
_ROWS_TO_END = 4096


def _first_row(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first row of a task's file; of a long file the rest is not asked for.

    A short one is read to its end, as a worker that stops early is not used again.
    """
    rows = 0
    for pdf in batches:
        if not rows and len(pdf):
            yield pdf.iloc[:1]
        rows += len(pdf)
        if rows >= _ROWS_TO_END:
            return


def header_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(file_path, header)``: the first line of each file, by one job for all of them
    (and Spark's own listing job where there are many).

    Each file is one task, which stops after the first rows, so the bytes read do
    not grow with the files. The scan runs in a session of its own (the same context), so that
    the caller's settings stay as they are. A file without a line has a NULL header.
    """
    if not paths:
        return spark.createDataFrame([], "file_path string, header string")
    reader = spark.newSession()
    for key, value in HEADER_CONF.items():
        reader.conf.set(key, value)
    first = (reader.read.text(paths).select(F.col("_metadata.file_path").alias("file_path"), F.col("value").alias("header"))
             .mapInPandas(_first_row, "file_path string, header string").collect())
    # One row per file, as its path is spelled by the scan; a file that gave none is listed as it was asked for.
    found = {r.file_path for r in first}
    empty = [(p, None) for p in paths if not _spelled(p) & found]
    return spark.createDataFrame([tuple(r) for r in first] + empty, "file_path string, header string")


def _spelled(path: str) -> set[str]:
    """A path as it may be reported: as given, and a bare local path with its scheme."""
    return {path, "file://" + path, path.replace("file:///", "file:/"), path.replace("file:/", "file:///", 1)}


def classify_headers(headers: DataFrame) -> DataFrame:
    """S3: ``location_type`` per file from its header line.

    Blank, missing or at most 8 fields -> NULL (file skipped); field 7 equal
    to ``PULocationID`` -> ``TAXIZONE``; otherwise ``GPS``.
    """
    h = F.trim(F.col("header"))
    toks = F.split(h, ",", -1)
    kind = (F.when(h.isNull() | (F.length(h) == 0) | (F.size(toks) <= 8), F.lit(None))
            .when(F.get(toks, F.lit(7)) == ZONE_HEADER_TOKEN, F.lit("TAXIZONE"))
            .otherwise(F.lit("GPS")))
    return headers.select(
        "file_path",
        F.regexp_extract("file_path", r"([^/]*)$", 1).alias("file_name"),
        kind.cast("string").alias("location_type"))


def classify_files(spark: SparkSession, root: str, prefix: str = TRIP_FILE_PREFIX) -> DataFrame:
    """S2 + S3: ``(file_path, file_name, location_type)`` for every trip file."""
    return classify_headers(header_lines(spark, list_trip_files(spark, root, prefix)))


def paths_by_kind(classified: DataFrame) -> dict[str, list[str]]:
    """File lists per kind (bounded by the number of files, not rows)."""
    out: dict[str, list[str]] = {"TAXIZONE": [], "GPS": []}
    for row in classified.where(F.col("location_type").isNotNull()).collect():
        out[row["location_type"]].append(row["file_path"])
    return out


def read_trip_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Raw lines ``(value STRING)`` of trip files, all files in one scan."""
    if not paths:
        return spark.createDataFrame([], "value string")
    return spark.read.text(paths)


def read_trip_csv(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """A typed scan of trip files of one kind (all columns as text).

    Only the columns a query selects are parsed (CSV column pruning).
    Empty fields stay empty strings; missing trailing fields are NULL.
    """
    schema = ZONE_CODED_SCHEMA if kind == "TAXIZONE" else GPS_SCHEMA
    if not paths:
        return spark.createDataFrame([], schema)
    return (spark.read.schema(schema).option("header", True)
            .option("nullValue", "\u0000").option("mode", "PERMISSIVE").csv(paths))

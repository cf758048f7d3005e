"""Raw ingestion: every source lands as strings, never inferred.

Typing, trimming and rejecting values is the job of the quality rules and
staging, not of the reader, so a bad cell becomes a quarantined row instead
of a load failure or a silent NULL.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

# The raw column contract of each source (names and order).
RAW_COLUMNS: dict[str, list[str]] = {
    "sites": ["site_id", "site_name", "country", "region", "business_unit",
              "headcount", "valid_from", "valid_to"],
    "metric_definitions": ["metric_code", "metric_name", "category",
                           "canonical_uom", "is_additive"],
    "uom_conversions": ["from_uom", "to_uom", "factor"],
    "readings": ["reading_id", "site_id", "period", "metric_code", "value", "uom",
                 "period_type", "source_system", "submitted_at"],
    "incidents": ["incident_id", "site_id", "incident_date", "incident_type",
                  "severity", "is_recordable", "lost_days", "reported_by"],
}

# Source manifest, table -> file name.
SOURCE_FILES: dict[str, str] = {
    "sites": "sites.csv",
    "metric_definitions": "metric_definitions.csv",
    "uom_conversions": "uom_conversions.csv",
    "readings": "readings.csv",
    "incidents": "incidents.csv",
}


def string_schema(columns: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def ingest_raw(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """All-string CSV read with a header row.

    The header is checked against ``columns`` (``enforceSchema=False``), no
    value is coerced, CRLF and LF files both work, and surrounding spaces
    are kept so that the quality rules see what the site actually sent.
    """
    return (spark.read
            .schema(string_schema(columns))
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "PERMISSIVE")
            .option("multiLine", False)
            .option("ignoreLeadingWhiteSpace", False)
            .option("ignoreTrailingWhiteSpace", False)
            .csv(path))


#: What can be wrong with a line: fewer fields than the header, more, or a quote that
#: is not closed on it.
SHORT, LONG, UNCLOSED = "SHORT", "LONG", "UNCLOSED"
CORRUPT = "corrupt_records"
CORRUPT_COLUMNS = ["table_name", "fault", "fields", "line"]

# A comma outside quotes: an even number of quotes follows.
_SEPARATOR = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def ingest_lines(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Every line but headers and blank ones, as the string columns of ``ingest_raw`` and
    ``_line``, the line as it stands, ``_fields``, its number of fields (null where a quote is
    open), and ``_fault``, null where the line is well-formed."""
    header = ",".join(columns)
    lines = spark.read.text(path).select(F.regexp_replace("value", "^\\x{FEFF}", "").alias("_line"))
    lines = lines.where((F.col("_line") != header) & (F.trim("_line") != ""))
    ddl = ", ".join(f"`{c}` string" for c in [*columns, "_bad"])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "ignoreLeadingWhiteSpace": "false",
               "ignoreTrailingWhiteSpace": "false"}
    quotes = F.length("_line") - F.length(F.replace(F.col("_line"), F.lit('"'), F.lit("")))
    rows = lines.select("_line", (quotes % 2 == 1).alias("_open"), F.from_csv("_line", ddl, options).alias("_row"))
    fields = F.when(~F.col("_open"), F.when(F.col("_row._bad").isNull(), F.lit(len(columns)))
                    .otherwise(F.size(F.split("_line", _SEPARATOR))))
    rows = rows.select("_row.*", "_line", "_open", fields.alias("_fields"))
    fault = (F.when(F.col("_open"), F.lit(UNCLOSED)).when(F.col("_fields") < len(columns), F.lit(SHORT))
             .when(F.col("_fields") > len(columns), F.lit(LONG)))
    return rows.select(*columns, "_line", "_fields", fault.alias("_fault"))


def check_headers(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Every file of ``path`` has the header; one aggregate over the lines."""
    is_header = F.regexp_replace("value", "^\\x{FEFF}", "") == ",".join(columns)
    files = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), is_header.alias("h"))
    without = files.groupBy("file").agg(F.max("h").alias("h")).where("NOT h").limit(5).collect()
    if without:
        raise ValueError(f"header {','.join(columns)} is missing in: " + ", ".join(r["file"] for r in without))


def ingest_with_corrupt(spark: SparkSession, path: str, columns: list[str], table: str) -> tuple[DataFrame, DataFrame]:
    """The well-formed rows, as ``ingest_raw`` reads them, and the malformed lines
    (``CORRUPT_COLUMNS``), which are not cut or filled to fit."""
    check_headers(spark, path, columns)
    lines = ingest_lines(spark, path, columns)
    bad = lines.where("_fault IS NOT NULL").select(
        F.lit(table).alias("table_name"), F.col("_fault").alias("fault"), F.col("_fields").alias("fields"), F.col("_line").alias("line"))
    return lines.where("_fault IS NULL").select(*columns), bad


def ingest_sources(spark: SparkSession, directory: str,
                   manifest: Mapping[str, str] = SOURCE_FILES,
                   columns: Mapping[str, list[str]] = RAW_COLUMNS, keep_corrupt: bool = False) -> dict[str, DataFrame]:
    """Read every file of the manifest; a missing file is an error naming
    all missing files at once. With ``keep_corrupt`` malformed lines of all files come as
    one more table, ``corrupt_records``; without, missing fields are null and surplus
    ones are left out, as the reader has it."""
    frames: dict[str, DataFrame] = {}
    missing: list[str] = []
    corrupt: list[DataFrame] = []
    for table, filename in manifest.items():
        path = f"{directory.rstrip('/')}/{filename}"
        try:
            if keep_corrupt:
                frames[table], bad = ingest_with_corrupt(spark, path, columns[table], table)
                corrupt.append(bad)
            else:
                frames[table] = ingest_raw(spark, path, columns[table])
        except AnalysisException as exc:  # PATH_NOT_FOUND is raised eagerly
            if "PATH_NOT_FOUND" in str(exc) or "does not exist" in str(exc):
                missing.append(path)
            else:
                raise
    if missing:
        raise FileNotFoundError("sources that cannot be found: " + ", ".join(missing))
    if keep_corrupt:
        frames[CORRUPT] = reduce(DataFrame.unionByName, corrupt)
    return frames


def source_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per raw table, as one DataFrame (one job, not one per table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out

"""Land raw files as text (S1-S5): every column is a string, types are decided later.

Event files are JSON arrays. ``arrays.py`` reads them by byte ranges and keeps what is damaged as unreadable records;
``read_events`` reads each file whole, in one task, and stops at the first damage. Landing writes Parquet once and
everything downstream reads that.

A damaged CSV file stops the landing, with its name: a row with more or fewer cells than the header, a file whose
header differs from the first one's. Values are never judged here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimloom.sources import arrays

# The declared fields of the event files and the headers of the reference files.
EVENT_FIELDS = {
    "claims": ["id", "npi", "ndc", "price", "quantity", "pbm_fee", "timestamp"],
    "reverts": ["id", "claim_id", "timestamp"],
    "lookups": ["id", "claim_id", "ndc", "partner", "channel", "timestamp"],
}
PHARMACY_FIELDS = ["npi", "chain"]
PARTNER_FIELDS = ["partner", "fee_cents", "fee_percentage"]
PRICE_HEADERS = {
    "NDC": "ndc",
    "NDC Description": "ndc_description",
    "NADAC Per Unit": "unit_price",
    "Effective Date": "effective_date",
    "As of Date": "as_of_date",
    "Pricing Unit": "pricing_unit",
    "Classification for Rate Setting": "classification",
    "OTC": "otc",
    "Corresponding Generic Drug NADAC Per Unit": "generic_unit_price",
}


def event_schema(source: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in EVENT_FIELDS[source]])


def lineage() -> list[Column]:
    return [F.col("_metadata.file_path").alias("_source_file"), F.current_timestamp().alias("_ingested_at")]


def read_events(spark: SparkSession, source: str, directory: str) -> DataFrame:
    """A directory of JSON array files. The schema is declared, so a field no file has is a NULL column."""
    files = (
        spark.read.schema(event_schema(source))
        .option("multiLine", True)
        .option("mode", "FAILFAST")
        .option("pathGlobFilter", "*.json")
        .json(directory)
    )
    return files.select(*EVENT_FIELDS[source], *lineage())


def read_arrays(spark: SparkSession, source: str, directory: str, spool: str) -> DataFrame:
    """As ``read_events``, but by byte ranges, with unreadable records as rows of their own, see ``arrays``."""
    files = arrays.read_arrays(spark, directory, event_schema(source), spool)
    ingested = F.current_timestamp().alias("_ingested_at")
    return files.select(*EVENT_FIELDS[source], "_source_file", ingested, arrays.CORRUPT, arrays.CORRUPT_AT)


def _read_csv(spark: SparkSession, path: str, columns: dict[str, str], pattern: str | None = None) -> DataFrame:
    # No schema on purpose: a CSV schema binds by position, these columns are taken by header name. A header that is
    # not there fails at once. All cells are parsed, not only the wanted ones, so that a ragged row is noticed.
    options = {"header": True, "quote": '"', "escape": '"', "mode": "FAILFAST", "columnPruning": False}
    if pattern:
        options["pathGlobFilter"] = pattern
    rows = spark.read.options(enforceSchema=False, **options).csv(path)
    return rows.select(*(F.col(f"`{header}`").alias(name) for header, name in columns.items()), *lineage())


def read_pharmacies(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, {c: c for c in PHARMACY_FIELDS}, "*.csv")


def read_partners(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, {c: c for c in PARTNER_FIELDS}, "*.csv")


def read_price_history(spark: SparkSession, path: str) -> DataFrame:
    """Nine of the file's columns under short names."""
    return _read_csv(spark, path, PRICE_HEADERS)


def read_raw(spark: SparkSession, paths: dict[str, str], spool: str | None = None) -> dict[str, DataFrame]:
    """All six sources; ``paths`` maps claims, reverts, lookups, pharmacies, partners, price_history to a path.

    With ``spool``, a folder for intermediate files, event files are read by byte ranges and damaged elements are rows;
    else a damaged file stops the landing.
    """
    read = read_events if spool is None else lambda s, source, path: read_arrays(s, source, path, f"{spool}/{source}")
    raw = {source: read(spark, source, paths[source]) for source in EVENT_FIELDS}
    raw["pharmacies"] = read_pharmacies(spark, paths["pharmacies"])
    raw["partners"] = read_partners(spark, paths["partners"])
    raw["price_history"] = read_price_history(spark, paths["price_history"])
    return raw

"""The organisation directory: a CSV without a heading line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Column names of the published data dictionary.
DIRECTORY_COLUMNS = (
    "Organisation code",
    "Name",
    "National grouping",
    "High level health geography",
    "Address line 1",
    "Address line 2",
    "Address line 3",
    "Address line 4",
    "Address line 5",
    "Postcode",
    "Open date",
    "Close date",
    "Null 1",
    "Null 2",
    "Null 3",
    "Null 4",
    "Null 5",
    "Contact telephone number",
    "Null 6",
    "Null 7",
    "Null 8",
    "Amended record indicator",
    "Null 9",
    "GOR code",
    "Null 10",
    "Null 11",
    "Null 12",
)
DIRECTORY_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in DIRECTORY_COLUMNS])


def read_directory(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """All columns as text; empty fields and "NA" are NULL.

    A record with more or fewer than 27 fields fails the job. Files are split
    at line breaks; multi_line allows line breaks inside quotes and reads each
    file in one task.
    """
    raw = (
        spark.read.schema(DIRECTORY_SCHEMA)
        .option("header", False)
        .option("escape", '"')
        .option("mode", "FAILFAST")
        .option("columnPruning", False)
        .option("multiLine", multi_line)
        .option("ignoreLeadingWhiteSpace", True)
        .option("ignoreTrailingWhiteSpace", True)
        .csv(path)
    )
    return raw.select(
        *[
            F.when(~F.col(f"`{c}`").isin("", "NA"), F.col(f"`{c}`")).alias(c)
            for c in DIRECTORY_COLUMNS
        ]
    )

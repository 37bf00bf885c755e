"""Readers of the register exports: explicit text schemas by position, source file and load time, failing fast."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The columns of the charities export that the pipeline reads, in lower case; others pass through.
CHARITIES = (
    "organisationid", "name", "othernames", "charityregistrationnumber", "nzbnnumber", "companiesofficenumber", "emailaddress1", "charityemailaddress",
    "telephone1", "websiteurl", "streetaddressline1", "streetaddressline2", "streetaddresssuburb", "streetaddresscity", "streetaddresspostcode",
    "postaladdressline1", "postaladdressline2", "postaladdresssuburb", "postaladdresscity", "postaladdresspostcode", "registrationstatus", "dateregistered",
)
COMPANIES = (
    "business_name", "nzbn", "registration_date", "entity_type", "act", "trading_as", "physical_address", "previously_known_as",
    "previously_trading_as", "status", "status_date", "export_file",
)
DONEES = ("organisation_name", "ceased_as_donee")


def text_schema(columns) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def first_match(pattern: str) -> str:
    """The first path of a local glob, or an error."""
    path = Path(pattern)
    found = sorted(path.parent.glob(path.name))
    if not found:
        raise FileNotFoundError(pattern)
    return str(found[0])


def read_csv(spark: SparkSession, path: str, columns) -> DataFrame:
    """A CSV export with a header, quoted fields and line breaks in them; every column as text, by position."""
    return (
        spark.read.schema(text_schema(columns))
        .options(header=True, quote='"', escape='"', multiLine=True, encoding="UTF-8", mode="FAILFAST", enforceSchema=True)
        .options(ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
        .csv(path)
        .select("*", F.col("_metadata.file_name").alias("_source_file"), F.localtimestamp().alias("_loaded_at"))
    )


def header_columns(spark: SparkSession, path: str) -> list[str]:
    return [c.strip().lower() for c in spark.read.options(header=True).csv(path).columns]


def read_charities(spark: SparkSession, path: str, columns=None) -> DataFrame:
    return read_csv(spark, path, columns or header_columns(spark, path))


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, COMPANIES)


def read_donees(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, DONEES)


def stack_exports(*exports: DataFrame) -> DataFrame:
    """Company exports one below the other, without rows that have no number; repeats stay."""
    out = exports[0]
    for e in exports[1:]:
        out = out.unionByName(e)
    return out.where(F.trim("nzbn") != "")


def read_workbook(spark: SparkSession, path: str, columns, first_header: str | None = None) -> DataFrame:
    """The first sheet of a workbook, read on the driver; needs pandas' Excel engines, which are optional."""
    import pandas as pd

    sheet = pd.read_excel(path, header=None, dtype=str)
    if first_header is not None:
        at = int((sheet[0].fillna("").str.strip() == first_header).idxmax())
        sheet = sheet.iloc[at + 1 :]
    sheet = sheet.iloc[:, : len(columns)]
    rows = [[None if pd.isna(v) else v for v in r] for r in sheet.itertuples(index=False)]
    return spark.createDataFrame(rows, text_schema(columns))


def convert(spark: SparkSession, df: DataFrame, path: str) -> int:
    """Write df as CSV with a header; the number of rows."""
    df.write.mode("overwrite").options(header=True, quote='"', escape='"').csv(path)
    return df.count()

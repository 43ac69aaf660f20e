"""The tables exchanged as CSV, under their column headers, read into library names."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, types as T

from . import schemas, tables

QUOTES_CSV = T.StructType([
    T.StructField("Product_ID", T.StringType()),
    T.StructField("Description", T.StringType()),
    T.StructField("approved_quote_price", T.DoubleType()),
    T.StructField("seq", T.LongType()),
])
QUOTE_NAMES = {"Product_ID": "product_id", "Description": "description"}


def _read(spark: SparkSession, path: str, schema: T.StructType, names: dict) -> DataFrame:
    return tables.read_csv(spark, path, schema).withColumnsRenamed(names)


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.CATALOG_CSV, schemas.CATALOG_NAMES)


def read_manual_offers(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.MANUAL_OFFERS_CSV, schemas.MANUAL_OFFER_NAMES)


def read_instructions(spark: SparkSession, path: str) -> DataFrame:
    return _read(spark, path, schemas.INSTRUCTIONS_CSV, schemas.INSTRUCTION_NAMES)


def read_quotes(spark: SparkSession, path: str) -> DataFrame:
    """Quotes with their order in the export, ``seq``: rows of a file have no order of their own."""
    header = tables.trimmed_headers(spark.read.option("header", True).csv(path))
    tables.require_columns(header, ["seq"])
    return _read(spark, path, QUOTES_CSV, QUOTE_NAMES)


def write_quotes(df: DataFrame, path: str) -> None:
    _write(df, path, QUOTE_NAMES, [f.name for f in QUOTES_CSV])


def read_offers(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_csv(spark, path, schemas.OFFERS)


def read_catalog_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """The catalogue's usable rows, and the lines that are not; see ``tables.read_csv_checked``."""
    rows, rejects = tables.read_csv_checked(spark, path, schemas.CATALOG_CSV)
    return rows.withColumnsRenamed(schemas.CATALOG_NAMES), rejects


def read_quotes_checked(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Quotes of well-formed lines, and the other lines."""
    rows, rejects = tables.read_csv_checked(spark, path, QUOTES_CSV)
    return rows.withColumnsRenamed(QUOTE_NAMES), rejects


def write_report(df: DataFrame, path: str) -> None:
    """The price report, under its column names."""
    tables.write_csv(df.select(*schemas.REPORT_COLUMNS), path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_csv(spark, path, schemas.REPORT)


def write_volume_offers(df: DataFrame, path: str) -> None:
    tables.write_csv(df.select(*schemas.VOLUME_OFFERS.names), path)


def read_volume_offers(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_csv(spark, path, schemas.VOLUME_OFFERS)


def write_unit_offers(df: DataFrame, path: str) -> None:
    tables.write_csv(df.select(*schemas.UNIT_OFFERS.names), path)


def read_unit_offers(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_csv(spark, path, schemas.UNIT_OFFERS)


def read_modifiers(spark: SparkSession, path: str) -> DataFrame | None:
    """Search modifiers per product type; None when there is no such file."""
    try:
        raw = tables.trimmed_headers(
            spark.read.option("header", True).option("escape", '"').csv(path)
        )
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    if not {f.name for f in schemas.MODIFIERS_CSV} <= set(raw.columns):
        return None
    return raw.select(*[f"`{f.name}`" for f in schemas.MODIFIERS_CSV]).withColumnsRenamed(
        {"Type of product": "type_of_product", "Search Modifiers": "search_modifiers"}
    )


def _write(df: DataFrame, path: str, names: dict[str, str], headers: list[str]) -> None:
    back = {name: header for header, name in names.items()}
    renamed = df.withColumnsRenamed(back)
    tables.write_csv(
        tables.with_missing_columns(renamed, headers).select(*[f"`{h}`" for h in headers]), path, bom=True
    )


def write_catalog(df: DataFrame, path: str) -> None:
    _write(df, path, schemas.CATALOG_NAMES, schemas.CATALOG_HEADERS)


def write_manual_offers(df: DataFrame, path: str) -> None:
    _write(df, path, schemas.MANUAL_OFFER_NAMES, schemas.MANUAL_OFFER_HEADERS)


def write_instructions(df: DataFrame, path: str) -> None:
    _write(df, path, schemas.INSTRUCTION_NAMES, schemas.INSTRUCTION_HEADERS)

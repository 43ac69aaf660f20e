"""Landed ERP tables to logical tables: filters and projections a scan can push down."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import price, text
from . import schemas, tables

# Fixed values.
EXCLUDED_SUBINDUSTRIES = ["Maritime", "Defense"]
EXCLUDED_TYPES = [
    "F12-Other consumables for FM",
    "P11-Other consumables for pets",
    "H13-Other products, consumables or kits for homes",
    "C5-Other transportation products or items",
]


def catalog(landed: DataFrame) -> DataFrame:
    """Active products outside the excluded groups; a product without a link drops out too.

    A column ``seq``, the order of the export, is kept where the landed table has it.
    """
    order = ["seq"] if "seq" in landed.columns else []
    names = {c: text.many_to_one_name(F.col(c)) for c in
             ("type_of_product_id", "subindustry_id", "industry_id")}
    return (
        landed.filter(F.col("status") == "active")
        .select(*schemas.ERP_CATALOG_COLUMNS, *order)
        .withColumns(names)
        .withColumnsRenamed({
            "type_of_product_id": "type_of_product",
            "subindustry_id": "subindustry",
            "industry_id": "industry",
        })
        .filter(~F.col("subindustry").isin(EXCLUDED_SUBINDUSTRIES)
                & ~F.col("type_of_product").isin(EXCLUDED_TYPES))
    )


def sale_lines(lines: DataFrame, orders: DataFrame, year: int) -> DataFrame:
    """Lines of confirmed orders of one calendar year that name a finished product.

    ``lines``: order_id, name, product_uom_qty, price_subtotal, seq;
    ``orders``: order_id, state, date_order.
    """
    wanted_orders = orders.filter(
        (F.col("state") == "sale")
        & (F.col("date_order") >= F.lit(f"{year}-01-01").cast("timestamp_ntz"))
        & (F.col("date_order") < F.lit(f"{year + 1}-01-01").cast("timestamp_ntz"))
    ).select("order_id")
    wanted_lines = lines.filter(
        (F.col("product_uom_qty") > 0)
        & (F.col("price_subtotal") > 0)
        & F.startswith(F.col("name"), F.lit("[FP-"))
    )
    return wanted_lines.join(wanted_orders, "order_id", "left_semi").select(
        "name", "product_uom_qty", "price_subtotal", "seq"
    )


def quotes(lines: DataFrame) -> DataFrame:
    """Unit price per quoted product; ``seq`` keeps the order of the lines."""
    return lines.select(
        text.product_code(F.col("name")).alias("product_id"),
        text.without_codes(F.col("name")).alias("description"),
        price.per_unit(F.col("price_subtotal"), F.col("product_uom_qty")).alias(
            "approved_quote_price"
        ),
        "seq",
    )


def manual_offers(landed: DataFrame) -> DataFrame:
    """Hand-entered competitor products with readable channel, unit and date."""
    full = tables.with_missing_columns(landed, schemas.ERP_COMPETITOR_COLUMNS)
    return full.select(
        F.date_format(F.to_date("date"), "dd/MM/yyyy").alias("date"),
        text.recode(F.col("product_channel"), text.CHANNEL_CODES).alias("channel"),
        text.many_to_one_name(F.col("classification_id")).alias("type_of_product"),
        "product_category",
        text.many_to_one_name(F.col("subindustry_id")).alias("subindustry"),
        text.many_to_one_name(F.col("industry_id")).alias("industry"),
        "generic_product_type",
        "total_quantity",
        text.recode(F.col("uom"), text.UOM_CODES).alias("unit_of_measurement"),
        F.col("price_unit_sar").cast("string").alias("price_sar"),
        "company",
    )

"""Training frames: trimmed competitor offers plus the own quotes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import price, text
from ..sources.schemas import TRAIN_UNIT_COLUMNS, TRAIN_VOLUME_COLUMNS
from ..sources.tables import materialize
from .joins import lookup_join

OWN_COMPANY = "Own brand"


def own_quotes(quotes: DataFrame, catalog: DataFrame, company: str = OWN_COMPANY) -> DataFrame:
    """Every quote with its product; one product may have many quotes.

    A much-quoted product is a hot join key: adaptive execution splits it when
    the catalogue is too large to broadcast.
    """
    return (
        quotes.filter(F.col("product_id").isNotNull())
        .join(catalog, "product_id")
        .withColumns({
            "company": F.lit(company), "channel": text.channel(F.col("subindustry")),
        })
    )


def competitor_rows(trimmed: DataFrame) -> DataFrame:
    return trimmed.withColumn("approved_quote_price", F.lit(0.0))


def volume_training(trimmed: DataFrame, own: DataFrame) -> DataFrame:
    quote = F.col("approved_quote_price")
    own_rows = own.filter(F.col("volume_liters") > 0).withColumns({
        "price_per_liter": price.per_unit(quote, F.col("volume_liters")),
        "price_sar": quote,
        "unit_of_measurement": F.when(F.col("volume_liters") < 1, "ml").otherwise("l"),
    })
    return (
        competitor_rows(trimmed).select(*TRAIN_VOLUME_COLUMNS)
        .unionByName(own_rows.select(*TRAIN_VOLUME_COLUMNS).dropna(subset=["price_per_liter"]))
    )


def unit_training(trimmed: DataFrame, own: DataFrame) -> DataFrame:
    quote = F.col("approved_quote_price")
    own_rows = own.filter(F.col("pack_quantity_units") > 0).withColumns({
        "price_per_item": price.per_unit(quote, F.col("pack_quantity_units")),
        "price_sar": quote,
        "total_quantity": F.col("pack_quantity_units").cast("double"),
        "unit_of_measurement": F.lit("units"),
    })
    return (
        competitor_rows(trimmed).select(*TRAIN_UNIT_COLUMNS)
        .unionByName(own_rows.select(*TRAIN_UNIT_COLUMNS).dropna(subset=["price_per_item"]))
    )


def predictable_products(catalog: DataFrame, types: DataFrame) -> DataFrame:
    """Catalogue products of a type the market data knows; the type is trimmed."""
    trimmed = catalog.withColumn("type_of_product", text.strip(F.col("type_of_product")))
    return lookup_join(
        trimmed, materialize(types, "types"), ["type_of_product"], "left_semi"
    )

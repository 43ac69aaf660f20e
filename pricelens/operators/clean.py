"""Offers to comparable prices: per litre or per item."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import price
from ..functions.text import strip
from ..sources.schemas import CLEAN_COLUMNS
from ..sources.tables import computed

# Fixed values. Grams and kilograms are weights: they belong to neither path.
VOLUMETRIC_UNITS = ["ml", "l", "fl oz", "g", "kg"]
WEIGHT_UNITS = ["g", "kg"]
LITERS_PER_FL_OZ = 0.0295735


def clean_offers(web: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """Web and manual offers as one table with numeric price and normal units.

    Only the two text columns change, so extra columns of ``web`` (a sequence,
    an offer id) are not carried: the result has the nine clean columns.
    """
    both = web.select(*CLEAN_COLUMNS)
    if manual is not None:
        both = both.unionByName(manual.select(*CLEAN_COLUMNS))
    cleaned = computed(both, {
        "price_sar": price.clean_price(F.col("price_sar")),
        "unit_of_measurement": F.lower(strip(F.col("unit_of_measurement"))),
    })
    return cleaned.withColumn(
        "total_quantity", F.col("total_quantity").try_cast("double")
    ).select(*CLEAN_COLUMNS)


def is_volumetric(unit: Column) -> Column:
    """A missing unit goes to the unit path."""
    return F.coalesce(unit.isin(VOLUMETRIC_UNITS), F.lit(False))


def liters(quantity: Column, unit: Column) -> Column:
    return (
        F.when(unit == "ml", quantity / 1000)
        .when(unit == "fl oz", quantity * LITERS_PER_FL_OZ)
        .when(unit == "l", quantity)
    )


def volume_offers(clean: DataFrame) -> DataFrame:
    """Volumetric offers with litres and price per litre; weights are left out."""
    unit = F.col("unit_of_measurement")
    return (
        clean.filter(is_volumetric(unit) & ~unit.isin(WEIGHT_UNITS))
        .withColumn("volume_liters", liters(F.col("total_quantity"), unit))
        .withColumn("price_per_liter", price.per_unit(F.col("price_sar"), F.col("volume_liters")))
        .dropna(subset=["volume_liters", "price_per_liter"])
    )


def unit_offers(clean: DataFrame) -> DataFrame:
    """Countable offers with price per item."""
    return (
        clean.filter(~is_volumetric(F.col("unit_of_measurement")))
        .filter(F.col("total_quantity") > 0)
        .withColumn("price_per_item", price.per_unit(F.col("price_sar"), F.col("total_quantity")))
        .dropna(subset=["price_per_item"])
    )


def route_counts(clean: DataFrame) -> DataFrame:
    """How many offers take each path, and how many are left out as weights."""
    unit = F.col("unit_of_measurement")
    path = (
        F.when(F.coalesce(unit.isin(WEIGHT_UNITS), F.lit(False)), "excluded_weight")
        .when(is_volumetric(unit), "volume")
        .otherwise("unit")
    )
    return clean.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("offers"))

"""Price suggestions: latest quote, market bounds, profit floor, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.schemas import REPORT_COLUMNS
from ..sources.tables import materialize
from .joins import lookup_join
from .training import OWN_COMPANY

# Fixed values.
PROFIT_FLOOR = 1.30


def latest_quotes(quotes: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Last quoted price per product.

    An aggregate, not a window: each task keeps one row per product, so a
    product with a third of all quotes costs no more than another. ``order``
    ends the sequence with the price itself, which settles equal positions.
    """
    position = F.struct(*(order or ["seq"]), "approved_quote_price")
    return (
        quotes.filter(F.col("product_id").isNotNull())
        .groupBy("product_id")
        .agg(F.max_by("approved_quote_price", position).alias("approved_quote_price"))
    )


def prediction_frame(
    products: DataFrame, latest: DataFrame, company: str = OWN_COMPANY
) -> DataFrame:
    """Catalogue products with their last quote (0 if none), company and channel."""
    return products.join(latest, "product_id", "left").withColumns({
        "approved_quote_price": F.coalesce("approved_quote_price", F.lit(0.0)),
        "company": F.lit(company),
        "channel": text.channel(F.col("subindustry")),
    })


def price_path(volume_liters: Column, pack_units: Column) -> Column:
    """'volume', 'unit', or 'none' for a product without a size."""
    return (
        F.when(volume_liters > 0, "volume").when(pack_units > 0, "unit").otherwise("none")
    )


def size_label(volume_liters: Column, pack_units: Column) -> Column:
    return F.when(
        volume_liters > 0, F.concat(volume_liters.cast("string"), F.lit(" L"))
    ).otherwise(F.concat(pack_units.cast("bigint").cast("string"), F.lit(" units")))


def both_stats(volume_stats: DataFrame, unit_stats: DataFrame) -> DataFrame:
    """Market statistics of both paths as one lookup table."""
    return volume_stats.withColumn("path", F.lit("volume")).unionByName(
        unit_stats.withColumn("path", F.lit("unit"))
    )


def price_report(predicted: DataFrame, stats: DataFrame) -> DataFrame:
    """The 15-column report.

    ``predicted``: catalogue columns plus ``predicted_price_per_unit`` and
    ``model_confidence``; ``stats``: see :func:`both_stats`.
    """
    liters, pack = F.col("volume_liters"), F.col("pack_quantity_units")
    path = price_path(liters, pack)
    size = F.when(path == "volume", liters).when(path == "unit", pack)
    sized = predicted.withColumns({"path": path, "size": size})
    lookup = materialize(
        stats.select("type_of_product", "path", "market_min", "market_max", "competitor_count"),
        "stats",
    )
    joined = lookup_join(sized, lookup, ["type_of_product", "path"], "left")
    cost = F.col("unit_cost_sar").cast("double")
    model_price = F.coalesce(
        F.col("predicted_price_per_unit") * F.col("size"), F.lit(0.0)
    )
    zero = F.lit(0.0)
    return (
        joined.withColumn("final_price", F.greatest(model_price, cost * PROFIT_FLOOR))
        .withColumns({
            "product_type": F.col("type_of_product"),
            "volume": size_label(liters, pack),
            "cost_per_unit": cost,
            "predicted_price": F.round("final_price", 2),
            "predicted_price_per_unit": F.round(
                F.coalesce(F.when(F.col("path") != "none", F.col("predicted_price_per_unit")), zero),
                2,
            ),
            "porcentaje_de_ganancia": F.when(
                cost > 0, F.round((F.col("final_price") - cost) / cost * 100, 2)
            ).otherwise(0.0),
            "model_confidence": F.coalesce(
                F.when(F.col("path") != "none", F.col("model_confidence")), zero
            ),
            "market_min_found": F.round(F.coalesce(F.col("market_min") * F.col("size"), zero), 2),
            "market_max_found": F.round(F.coalesce(F.col("market_max") * F.col("size"), zero), 2),
            "competitors_count": F.coalesce("competitor_count", F.lit(0)).cast("int"),
        })
        .select(*REPORT_COLUMNS)
    )


def loss_count(report: DataFrame) -> DataFrame:
    """Products whose suggested price does not exceed their cost."""
    return report.agg(
        F.count_if(F.col("predicted_price") <= F.col("cost_per_unit")).alias("loss_products"),
        F.count(F.lit(1)).alias("products"),
    )


def upload_records(report: DataFrame) -> DataFrame:
    """Report rows as upload records with ``reject_reason`` for those that cannot be sent."""
    number = text.number(F.split(F.col("volume"), " ")[0])
    return report.select(
        F.col("product_id").alias("product_id_str"),
        "product_type", "generic_product_type", "subindustry", "industry",
        number.alias("volume_units"),
        F.col("cost_per_unit").cast("double").alias("production_cost"),
        F.col("predicted_price").cast("double").alias("suggested_price"),
        F.col("porcentaje_de_ganancia").cast("double").alias("profit"),
        "product_name",
        F.col("predicted_price_per_unit").cast("double").alias("predicted_price_per_unit"),
        F.col("model_confidence").cast("double").alias("model_confidence"),
        F.col("market_min_found").cast("double").alias("market_min_found"),
        F.col("market_max_found").cast("double").alias("market_max_found"),
        F.col("competitors_count").cast("int").alias("competitors_count"),
        F.when(number.isNull(), "size is not a number")
        .when(F.col("competitors_count").isNull(), "competitor count is missing")
        .alias("reject_reason"),
    )

"""From catalogue to search plan: one row per product type, site and keyword."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import sites
from ..functions import text
from ..sources.tables import inline_table, require_columns

INSTRUCTION_KEYS = ["type_of_product", "subindustry", "industry", "generic_product_type"]


def instruction_list(
    catalog: DataFrame, modifiers: DataFrame | None = None, sequence: str | None = None
) -> DataFrame:
    """Distinct type/sub-industry/industry/generic combinations with their search modifiers.

    ``sequence`` names a column that orders the catalogue; the first value of
    each combination is kept as ``seq``.
    """
    require_columns(catalog, INSTRUCTION_KEYS)
    if sequence is None:
        combinations = catalog.select(*INSTRUCTION_KEYS).distinct()
    else:
        combinations = catalog.groupBy(*INSTRUCTION_KEYS).agg(F.min(sequence).alias("seq"))
    usable = modifiers is not None and {"type_of_product", "search_modifiers"} <= set(
        modifiers.columns
    )
    if not usable:
        return combinations.withColumn("search_modifiers", F.lit(""))
    return combinations.join(
        modifiers.select("type_of_product", "search_modifiers"), "type_of_product", "left"
    ).withColumn("search_modifiers", F.coalesce("search_modifiers", F.lit("")))


def target_table(spark: SparkSession) -> DataFrame:
    pairs = [(sub, site, i) for sub, names in sites.TARGETS.items() for i, site in enumerate(names)]
    return inline_table(spark, pairs, "subindustry string, site string, site_order int")


def exclusion_table(spark: SparkSession) -> DataFrame:
    pairs = [(site, keyword) for site, words in sites.EXCLUSIONS.items() for keyword in words]
    return inline_table(spark, pairs, "site string, base_keyword string")


def search_url(site: Column, keyword: Column) -> Column:
    """Search address of a site, with the keyword written the way the site wants it."""
    written = {
        "plus": F.replace(keyword, F.lit(" "), F.lit("+")),
        "percent": text.percent_encode(keyword),
        "slug": F.lower(F.replace(keyword, F.lit(" "), F.lit("-"))),
    }

    def branch(so_far, item):
        name, (template, style) = item
        head, tail = template.split("{}")
        return so_far.when(site == name, F.concat(F.lit(head), written[style], F.lit(tail)))

    return reduce(branch, sites.SEARCH_URLS.items(), F.when(F.lit(False), F.lit("")))


def search_plan(
    instructions: DataFrame,
    targets: DataFrame | None = None,
    exclusions: DataFrame | None = None,
) -> DataFrame:
    """Which keyword to search on which site, per instruction.

    The fan-out is a join with two dimensions; a sub-industry without sites
    drops out, and an excluded (site, keyword) pair is anti-joined away.
    """
    spark = instructions.sparkSession
    targets = target_table(spark) if targets is None else targets
    exclusions = exclusion_table(spark) if exclusions is None else exclusions

    product_type = F.col("type_of_product")
    parsed = (
        instructions.dropna(subset=["type_of_product", "subindustry"])
        .withColumns({
            "base_keyword": text.base_keyword(product_type),
            "search_mode": text.search_mode(product_type),
            "channel": text.channel(F.col("subindustry")),
            "items": text.modifier_items(F.col("search_modifiers")),
        })
        .withColumn(
            "general",
            F.transform(F.filter("items", lambda m: m["site"].isNull()), lambda m: m["keyword"]),
        )
        .withColumn(
            "general_keyword",
            F.trim(F.concat_ws(" ", "base_keyword", F.array_join("general", " "))),
        )
    )
    planned = (
        parsed.join(targets, "subindustry")
        .join(exclusions, ["site", "base_keyword"], "left_anti")
        .withColumn(
            "own",
            F.transform(
                F.filter("items", lambda m: m["site"] == F.col("site")), lambda m: m["keyword"]
            ),
        )
        .filter(
            ~F.col("site").isin(sites.KEYWORD_REQUIRED)
            | (F.size("own") > 0)
            | (F.size("general") > 0)
        )
        .withColumn(
            "search_keyword",
            F.explode(
                F.when(F.size("own") > 0, F.col("own")).otherwise(F.array("general_keyword"))
            ),
        )
        .withColumn("search_url", search_url(F.col("site"), F.col("search_keyword")))
    )
    kept = [c for c in ("seq",) if c in instructions.columns]
    return planned.select(
        *INSTRUCTION_KEYS, "base_keyword", "search_mode", "channel", "site", "search_keyword",
        "search_url", *kept,
    )

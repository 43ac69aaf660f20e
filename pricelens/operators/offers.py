"""Raw page fields to offers: interpret, validate, cap, assemble."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import sites
from ..functions import price, quantity, relevance
from ..functions.text import strip
from ..sources.tables import computed, materialize
from .extract import all_of, first_of, within
from .joins import lookup_join
from .searchplan import INSTRUCTION_KEYS


def _by_site(rules: dict[str, Column], default: Column | None = None) -> Column:
    site = F.col("site")
    items = iter(rules.items())
    name, rule = next(items)
    chain = reduce(lambda c, kv: c.when(site == kv[0], kv[1]), items, F.when(site == name, rule))
    return chain if default is None else chain.otherwise(default)


def _text(node: Column, separator: str = "") -> Column:
    return F.array_join(node["parts"], separator)


def _filled(value: Column) -> Column:
    return F.nullif(value, F.lit(""))


def _spec_rows(nodes: Column) -> Column:
    """Label/value pairs of header-and-cell rows."""

    def pair(row: Column) -> Column:
        inner = within(nodes, row)
        return F.struct(
            F.coalesce(_text(first_of(inner, "spec_label")), F.lit("")).alias("label"),
            F.coalesce(_text(first_of(inner, "spec_value")), F.lit("")).alias("value"),
        )

    return F.transform(all_of(nodes, "spec_row"), pair)


def _cell_rows(nodes: Column) -> Column:
    """Label/value pairs of rows made of exactly two like cells."""

    def cells(row: Column) -> Column:
        return F.transform(all_of(within(nodes, row), "spec_cell"), lambda c: _text(c))

    rows = F.filter(F.transform(all_of(nodes, "spec_row"), cells), lambda c: F.size(c) == 2)
    return F.transform(
        rows,
        lambda c: F.struct(F.get(c, F.lit(0)).alias("label"), F.get(c, F.lit(1)).alias("value")),
    )


def spec_value(rows: Column, field: str) -> Column:
    """Value of the last row whose label contains ``field``."""
    fitting = F.filter(rows, lambda r: F.contains(F.lower(r["label"]), F.lit(field)))
    return F.try_element_at(fitting, F.lit(-1))["value"]


def title_company(title: Column) -> Column:
    """Text before ' - ', else the first word."""
    return F.when(
        F.contains(title, F.lit(" - ")), strip(F.substring_index(title, " - ", 1))
    ).otherwise(strip(F.substring_index(title, " ", 1)))


def page_facts(raw: DataFrame) -> DataFrame:
    """Title, price text, company and specification rows of every page.

    A page with package variations becomes one row per variation.
    """
    nodes = F.col("nodes")
    site = F.col("site")
    variations = F.filter(
        F.transform(
            all_of(nodes, "variation"),
            lambda v: F.struct(
                strip(first_of(within(nodes, v), "package")["text"]).alias("package"),
                first_of(within(nodes, v), "price")["text"].alias("price"),
            ),
        ),
        lambda v: v["package"].isNotNull() & v["price"].isNotNull(),
    )
    no_variation = F.array(F.lit(None).cast("struct<package:string,price:string>"))
    split = raw.withColumn(
        "variation", F.explode(F.when(site == "aerosense", variations).otherwise(no_variation))
    )

    # First element of every field, and the parts found inside another element.
    title, shown_price = first_of(nodes, "title"), first_of(nodes, "price")
    price_box = F.coalesce(first_of(nodes, "price_box"), first_of(nodes, "price_box_2"))
    row_text = lambda row: _text(first_of(within(nodes, first_of(nodes, row)), "row_value"))
    first = computed(split, {
        "title_node": title,
        "price_node": shown_price,
        "numbers": all_of(within(nodes, price_box), "price_number"),
        "brand": F.when(site == "amazon", row_text("brand_row")),
        "item_volume": F.when(site == "amazon", row_text("item_row")),
        "spec_rows": F.when(site == "fine", _cell_rows(nodes)).otherwise(_spec_rows(nodes)),
    })
    numbers = F.col("numbers")
    with_digits = F.filter(numbers, lambda n: n["text"].rlike(r"\d"))
    second = first.withColumn(
        "number",
        F.coalesce(F.get(with_digits, F.lit(0)), F.try_element_at(numbers, F.lit(-1))),
    )
    title, shown_price, number = F.col("title_node"), F.col("price_node"), F.col("number")
    plain_title = _filled(_text(title))
    brand_rows = F.filter("spec_rows", lambda r: F.contains(r["label"], F.lit("Brand:")))
    facts = computed(second, {
        "title": _by_site(
            {
                "fine": F.coalesce(
                    plain_title,
                    _filled(_text(first_of(nodes, "title_2"))),
                    _filled(_text(first_of(nodes, "title_3"))),
                ),
                "aerosense": F.coalesce(strip(title["text"]), F.lit("Unknown Product")),
            },
            plain_title,
        ),
        "price_sar": F.coalesce(
            _by_site({
                "amazon": price.whole_and_fraction(
                    _text(first_of(nodes, "price_whole")), _text(first_of(nodes, "price_fraction"))
                ),
                "mumzworld": price.integer_price(_text(shown_price)),
                "saco": _text(shown_price, "."),
                "fine": price.after_sar(_text(shown_price, " ")),
                "gogreen": price.two_decimals(shown_price["text"]),
                "officesupply": price.superscript_price(
                    number["text"], first_of(within(nodes, number), "price_sup")["text"]
                ),
                "aerosense": price.euro_price(F.col("variation.price")).cast("string"),
            }),
            F.lit(price.NO_PRICE),
        ),
        "brand": F.when(
            site == "saco",
            F.get(F.filter(brand_rows, lambda r: r["value"] != ""), F.lit(0))["value"],
        ).otherwise(F.col("brand")),
        "package": F.col("variation.package"),
        # Handed on, not left behind: a column that only skips over this step is lost
        # by Spark 4.1 column pruning when a later step reads it.
        "item_volume": F.col("item_volume"),
        "spec_rows": F.col("spec_rows"),
    }).drop("title_node", "price_node", "numbers", "number")
    constant = _by_site({s: F.lit(c) for s, c in sites.COMPANIES.items()})
    unknown = _by_site({s: F.lit(c) for s, c in sites.COMPANY_UNKNOWN.items()})
    return facts.withColumn(
        "company",
        F.coalesce(
            constant,
            F.col("brand"),
            F.when(F.col("site") == "mumzworld", title_company(F.col("title"))),
            unknown,
        ),
    ).drop("nodes", "variation", "brand")


def with_quantity(facts: DataFrame) -> DataFrame:
    """Quantity, unit and status by the rule of each site and search mode.

    Needs ``site, search_mode, search_keyword, title, spec_rows, item_volume,
    package``. A title without a usable quantity gets 0 units.
    """
    title, mode = F.col("title"), F.col("search_mode")
    rows, package = F.col("spec_rows"), F.col("package")
    units = mode == "units"
    kind = quantity.QUANTITY_TYPE

    def plain(amount: Column, unit: str) -> Column:
        return F.when(
            amount.isNotNull(),
            F.struct(amount.alias("quantity"), F.lit(unit).alias("unit"), amount.alias("normalized")),
        )

    about_wipes = F.lower("search_keyword").rlike("wipes|rags")
    agreed = quantity.agreed_volume(title, spec_value(rows, "volume"), F.col("item_volume"))
    counted, volume = quantity.count(title), quantity.volume(title)
    with_packs = F.when(units, counted).otherwise(quantity.volume_with_multiplier(title))
    found = _by_site({
        "amazon": F.when(
            units & about_wipes, plain(_positive(quantity.wipes_total(title)), "units")
        ).when(units, counted),
        "mumzworld": quantity.listing_quantity(title, mode),
        "saco": F.when(units, F.coalesce(quantity.hyphen_count(title), counted)).otherwise(volume),
        "fine": quantity.spec_quantity(rows, title, mode),
        "gogreen": with_packs,
        "officesupply": with_packs,
        "aerosense": F.when(units, plain(quantity.package_units(package), "units")).otherwise(
            plain(quantity.package_volume_ml(package), "ml")
        ),
    }).cast(kind)
    from_two = (F.col("site") == "amazon") & (mode == "volume")
    status = (
        F.when(from_two, F.col("agreed.status"))
        .when((F.col("site") == "amazon") & F.col("found").isNotNull(),
              F.when(about_wipes, "Wipes Units").otherwise("From Title"))
        .when(F.col("site") == "amazon", "Not Found")
    )
    # A variation without a readable count keeps an empty quantity; other sites report 0.
    missing = F.when(F.col("site") != "aerosense", F.lit(0.0))
    return (
        computed(facts, {"found": found, "agreed": F.when(from_two, agreed)})
        .withColumns({
            "total_quantity": F.coalesce(F.col("agreed.quantity"), F.col("found.quantity"), missing),
            "unit_of_measurement": F.coalesce(
                F.col("agreed.unit"), F.col("found.unit"), F.lit("units")
            ),
            "status": status,
            "product": F.when(
                F.col("site") == "aerosense", F.concat_ws(" - ", title, package)
            ).otherwise(title),
        })
        .drop("found", "agreed", "spec_rows", "item_volume", "package", "title")
    )


def _positive(amount: Column) -> Column:
    return F.when(amount > 0, amount)


def with_reject_reason(offers: DataFrame) -> DataFrame:
    """First failed check of an offer, NULL for a valid one.

    One site also checks the price; one site's offers are taken as they are.
    """
    strict = F.col("site") == "fine"
    value = F.col("price_sar").try_cast("double")
    reason = (
        F.when(F.col("site") == "aerosense", F.lit(None).cast("string"))
        .when(strict & value.isNull(), "Invalid price format")
        .when(strict & (value <= 0), "Invalid price")
        .when(~(F.coalesce(F.col("total_quantity"), F.lit(0.0)) > 0), "Invalid quantity")
        .when(F.col("product").isNull(), "Product name not found")
    )
    return offers.withColumn("reject_reason", reason)


def valid_offers(offers: DataFrame) -> DataFrame:
    return with_reject_reason(offers).filter(F.col("reject_reason").isNull()).drop("reject_reason")


def relevant_offers(
    offers: DataFrame, threshold: float = relevance.THRESHOLD, words=None
) -> DataFrame:
    """Offers whose title fits the searched keyword; one site is not checked."""
    fits = relevance.is_relevant(
        F.col("product"), F.col("search_keyword"), threshold, words or relevance.WORDS
    )
    return offers.filter((F.col("site") == "aerosense") | fits)


def capped_offers(offers: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """First offers in page order, up to the site's limit per search.

    A search is a site, mode and keyword of one instruction, so two instructions
    that search alike have a limit each (``by``, the columns present of the default). The widest limit is a constant comparison,
    so Spark keeps that many rows per search in every task before it shuffles.
    """
    if by is None:
        wanted = ["site", "search_keyword", "search_mode", *INSTRUCTION_KEYS]
        by = [c for c in wanted if c in offers.columns]
    widest = max(sites.OFFER_LIMITS.values())
    limit = _by_site({s: F.lit(n) for s, n in sites.OFFER_LIMITS.items()})
    # Offers of a site without a limit each form a group of their own.
    alone = F.when(~F.col("site").isin(list(sites.OFFER_LIMITS)), F.monotonically_increasing_id())
    window = Window.partitionBy(*by, "_alone").orderBy(*order)
    return (
        offers.withColumn("_alone", alone)
        .withColumn("_rank", F.row_number().over(window))
        .filter(F.col("_rank") <= widest)
        .filter(F.col("_rank") <= F.coalesce(limit, F.lit(1)))
        .drop("_rank", "_alone")
    )


def first_industry(instructions: DataFrame) -> DataFrame:
    """Industry of the first instruction in each sub-industry."""
    return (
        instructions.dropna(subset=["type_of_product", "subindustry"])
        .groupBy("subindustry")
        .agg(F.min_by("industry", "seq").alias("industry"))
    )


def assembled_offers(offers: DataFrame, instructions: DataFrame, run_date: Column) -> DataFrame:
    """The 13-column offer row; industry is that of its sub-industry's first instruction."""
    industries = materialize(first_industry(instructions), "industries")
    return lookup_join(offers.drop("industry"), industries, ["subindustry"], "left").select(
        run_date.cast("date").alias("date"), "industry", "subindustry", "type_of_product",
        "generic_product_type", "product", "price_sar", "company",
        F.col("site").alias("source"), "url", "unit_of_measurement", "total_quantity", "channel",
    )


def page_offers(raw: DataFrame, order: list[str]) -> DataFrame:
    """All steps from raw page fields to accepted offers."""
    readable = raw.filter(F.col("error").isNull())
    described = with_quantity(page_facts(readable))
    return capped_offers(relevant_offers(valid_offers(described)), order)

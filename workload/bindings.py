"""The given tables seen as the library's logical tables.

Each binding is a deterministic projection of whole tables; ``oracle.py`` holds
the same projections in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens.sources.tables import spread_scan

SUBINDUSTRIES = ["Home", "Automotive", "Pets", "Hotels", "Gyms", "Healthcare"]
OFFER_UNITS = ["mL", " L ", "fl oz", "g", "Units"]
KINDS = [
    "Glass cleaner", "Leather cleaner", "Fabric refresher", "Disinfectant wipes",
    "Microfiber cloth", "Car air freshener", "Carpet shampoo", "Body wash gel", "Long brush",
]
MODIFIERS = [
    None,
    "fine:Foam ; gogreen:foam;GoGreen : glass/cleaner",
    "spray",
    "officesupply: wood ; heavy duty",
    " aerosense:Clean Kit;fine:Kit~1*",
    "",
]
QUOTE_YEAR = 1997


def table(spark: SparkSession, folder: str, name: str, spread: bool = False) -> DataFrame:
    """A given table; ``spread`` for heavy work, which a single split would do on one core."""
    scan = spark.read.parquet(f"{folder}/{name}.parquet")
    return spread_scan(scan) if spread else scan


def pick(position: Column, values: list[str | None]) -> Column:
    """Element of a fixed list by remainder."""
    choices = F.array(*[F.lit(v).cast("string") for v in values])
    return F.get(choices, F.pmod(position, F.lit(len(values))).cast("int"))


def text(*parts: Column | str) -> Column:
    """Concatenation where strings are literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


def money(amount: Column) -> Column:
    return amount.cast("decimal(18,2)").cast("string")


def product_type() -> Column:
    return text(F.col("p_brand"), "-", F.col("p_type"))


def catalog(spark: SparkSession, folder: str) -> DataFrame:
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part").select(
        text("FP-", key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        product_type().alias("type_of_product"),
        F.col("p_type").alias("generic_product_type"),
        pick(key, SUBINDUSTRIES).alias("subindustry"),
        text("Industry ", size % 5).alias("industry"),
        F.when(key % 3 != 0, size.cast("double") / 10).alias("volume_liters"),
        F.when(key % 3 == 0, size.cast("double")).alias("pack_quantity_units"),
        (F.col("p_retailprice") / 100).alias("unit_cost_sar"),
        key.alias("seq"),
    )


def web_offers(spark: SparkSession, folder: str) -> DataFrame:
    """Shop offers: one per order line, priced in text."""
    size = F.col("p_size")
    unit = F.when(size % 6 < 5, pick(size % 6, OFFER_UNITS))
    lines = table(spark, folder, "lineitem", spread=True).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"
    )
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_brand", "p_type", "p_size"
    )
    companies = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("company")
    )
    subindustry = pick(F.col("l_partkey"), SUBINDUSTRIES)
    return lines.join(parts, "l_partkey").join(companies, "l_suppkey").select(
        text("Industry ", size % 5).alias("industry"),
        subindustry.alias("subindustry"),
        product_type().alias("type_of_product"),
        F.col("p_type").alias("generic_product_type"),
        text("SAR ", money(F.col("l_extendedprice"))).alias("price_sar"),
        "company",
        unit.alias("unit_of_measurement"),
        F.col("l_quantity").alias("total_quantity"),
        F.when(F.lower(subindustry).isin("home", "automotive", "pets"), "B2C")
        .otherwise("B2B").alias("channel"),
    )


def erp_competitors(spark: SparkSession, folder: str) -> DataFrame:
    """Hand-entered competitor records as the ERP lands them; one per order."""
    key = F.col("o_orderkey")
    link = lambda name: F.when(key % 9 == 0, F.lit("false")).otherwise(
        text("[", key % 100, ', "', name, '"]')
    )
    return table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        pick(key, ["b2b", "retail", "ecommerce", None, "other"]).alias("product_channel"),
        link(text("Brand#", key % 25 + 1, "-PROMO")).alias("classification_id"),
        F.lit("Cleaning").alias("product_category"),
        link(pick(key, SUBINDUSTRIES)).alias("subindustry_id"),
        link(text("Industry ", key % 5)).alias("industry_id"),
        F.lit("PROMO").alias("generic_product_type"),
        (F.col("o_custkey") % 50).cast("double").alias("total_quantity"),
        pick(key, ["ml", "g", "units", "kg", None, "ml", "units"]).alias("uom"),
        F.col("o_totalprice").alias("price_unit_sar"),
        F.col("o_orderpriority").alias("company"),
    )


def erp_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue records as the ERP lands them, with links in JSON."""
    key, cost = F.col("p_partkey"), F.col("p_retailprice")
    link = lambda name: text("[", key % 1000, ', "', name, '"]')
    kind = (
        F.when(key % 17 == 0, F.lit("false"))
        .when(key % 13 == 0, link(F.lit("F12-Other consumables for FM")))
        .otherwise(link(product_type()))
    )
    sub = F.when(key % 19 == 0, link(F.lit("Maritime"))).otherwise(link(pick(key, SUBINDUSTRIES)))
    return table(spark, folder, "part").select(
        F.when(F.col("p_size") % 10 == 0, "archived").otherwise("active").alias("status"),
        F.lit("2025-01-15 08:30:00").cast("timestamp_ntz").alias("create_date"),
        text("FP-", key).alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.upper("p_name").alias("label_product_name"),
        F.lit("Bottle").alias("presentation"),
        F.when(key % 3 != 0, F.col("p_size").cast("double") / 10).alias("volume_liters"),
        F.when(key % 3 == 0, F.col("p_size").cast("double")).alias("pack_quantity_units"),
        kind.alias("type_of_product_id"),
        F.lit("Cleaning").alias("category"),
        F.col("p_type").alias("generic_product_type"),
        sub.alias("subindustry_id"),
        link(text("Industry ", F.col("p_size") % 5)).alias("industry_id"),
        *[
            (cost / divisor).alias(name)
            for name, divisor in (
                ("bottle_cost", 800), ("label_cost", 900), ("liquid_cost", 400),
                ("microfibers_cost", 1600), ("plastic_bag_cost", 3200), ("labor_cost", 500),
                ("shipping_cost", 600), ("other_costs", 1200), ("unit_cost_sar", 100),
            )
        ],
    )


def sale_lines(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem", spread=True).select(
        F.col("l_orderkey").alias("order_id"),
        text("[FP-", F.col("l_partkey"), "] line ", F.col("l_linenumber")).alias("name"),
        F.col("l_quantity").alias("product_uom_qty"),
        F.col("l_extendedprice").alias("price_subtotal"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("seq"),
    )


def sale_orders(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.when(F.col("o_orderstatus") == "F", "sale").otherwise("draft").alias("state"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("date_order"),
    )


def plan_catalog(spark: SparkSession, folder: str) -> DataFrame:
    """Catalogue with product types the search plan has rules for."""
    key = F.col("p_partkey")
    kind = F.when(key % 10 < 9, text(F.col("p_brand"), "-", pick(key % 10, KINDS))).otherwise(
        F.lit("Toilet cleaner")
    )
    sub = (
        F.when(key % 29 == 0, "Aviation").when(key % 31 == 0, "Shipyards")
        .otherwise(pick(key, SUBINDUSTRIES))
    )
    return table(spark, folder, "part").select(
        kind.alias("type_of_product"),
        sub.alias("subindustry"),
        text("Industry ", F.col("p_size") % 5).alias("industry"),
        F.col("p_type").alias("generic_product_type"),
        key.alias("seq"),
    )


def modifiers(spark: SparkSession, folder: str) -> DataFrame:
    """One modifier text per branded product type."""
    number = F.substring("p_brand", 7, 4).cast("int")
    return (
        table(spark, folder, "part")
        .filter(F.col("p_partkey") % 10 < 9)
        .select(
            text(F.col("p_brand"), "-", pick(F.col("p_partkey") % 10, KINDS)).alias(
                "type_of_product"
            ),
            pick(number, MODIFIERS).alias("search_modifiers"),
        )
        .distinct()
    )


def titles(spark: SparkSession, folder: str) -> DataFrame:
    """Product titles in the forms shops write quantities."""
    key, size, name = F.col("p_partkey"), F.col("p_size"), F.col("p_name")
    forms = [
        text(name, " ", size * 25, " ml"),
        text(name, " ", size, ".5 L"),
        text(name, " ", size, " fl oz"),
        text(name, " (", size, " pcs)"),
        text(name, " ", size, " Wipes, Pack of 3"),
        text(name, " 6 Pcs x ", size, " L"),
        text(name, " ", size, " kilograms"),
        name,
        text(name, " (12 bottles x ", size, ".25 Ltr) deal"),
        text(name, " 4 x ", size * 10, " ML"),
        text(size, "/box ", name),
        text(name, " box of ", size),
        text(name, " ", size, " - Piece set"),
        text(name, " ", size, "-pack x 12"),
        text(name, " ", size, ",5 l x 3"),
        text(name, " ", size, "s wet x2"),
        text("Family Pack 2 x (3 x ", size, " wipes) ", name),
        text("Wet rags, ", size, " Sheets, 3 Pack"),
        text(name, " wipes ", size, " wet wipes 2 x 4 pack"),
        text(name, " (carton of 4x", size, ") 7 bottles"),
    ]
    chosen = F.get(F.array(*forms), F.pmod(key, F.lit(len(forms))).cast("int"))
    return table(spark, folder, "part", spread=True).select(key.alias("p_partkey"), chosen.alias("title"))


def spec_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Title, search mode and specification rows of a product page."""
    key, size = F.col("p_partkey"), F.col("p_size")
    row = lambda label, value: F.struct(
        F.lit(label).alias("label"), value.cast("string").alias("value")
    )
    full = F.array(
        row("Color", F.lit("")),
        row("Brand", F.lit("ACME 100")),
        F.struct(
            F.lit("Volume").alias("label"),
            F.when(key % 4 == 0, text(size, " L")).when(key % 4 == 1, text(size, "0 ml"))
            .otherwise(F.lit("unknown")).alias("value"),
        ),
        row("Pack", text(size, " in a carton")),
        row("Label size", text("9 pieces of ", size, " oz")),
        F.struct(
            F.when(key % 5 < 3, "Number of sheets").otherwise("Sheets").alias("label"),
            F.when(key % 3 == 0, text("about ", size * 2, " pcs")).otherwise(F.lit("n/a"))
            .alias("value"),
        ),
        row("Refill", text("3 x ", size, " ml")),
    )
    return titles(spark, folder).join(
        table(spark, folder, "part").select("p_partkey", "p_size"), "p_partkey"
    ).select(
        "p_partkey", "title",
        F.when(key % 2 == 0, "units").otherwise("volume").alias("search_mode"),
        full.alias("spec_rows"),
    )


def quantity_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Three texts that state a volume, agreeing or not."""
    key, size = F.col("p_partkey"), F.col("p_size")
    return table(spark, folder, "part", spread=True).select(
        "p_partkey",
        F.when(key % 5 == 0, F.col("p_name")).otherwise(text(size * 25, " ml ", F.col("p_name")))
        .alias("title"),
        F.when(key % 7 == 0, F.lit(None)).when(key % 3 == 0, text(size, " oz"))
        .otherwise(text(size.cast("decimal(10,3)") / 40, " L")).alias("spec"),
        F.when(key % 4 == 0, text(size * 25, " Milliliters"))
        .when(key % 4 == 1, text(size, " fluid ounces")).alias("item"),
    )


def site_searches(spark: SparkSession, folder: str) -> DataFrame:
    """Found offers of a search: one per order line, in page order."""
    key = F.col("l_partkey")
    parts = table(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), "p_name", "p_size"
    )
    names = ["amazon", "mumzworld", "saco", "fine", "gogreen", "officesupply", "aerosense"]
    return table(spark, folder, "lineitem", spread=True).join(parts, "l_partkey").select(
        pick(F.col("l_suppkey"), names).alias("site"),
        F.element_at(F.split("p_name", " "), -1).alias("search_keyword"),
        F.when(F.col("l_linenumber") % 5 == 0, F.lit(None)).otherwise(F.col("p_name"))
        .alias("product"),
        F.when(F.col("l_linenumber") == 1, F.lit("n/a"))
        .when(F.col("l_linenumber") == 2, F.lit("0.00"))
        .otherwise(money(F.col("l_extendedprice"))).alias("price_sar"),
        (F.col("l_quantity") - F.when(F.col("l_quantity") < 5, F.col("l_quantity")).otherwise(0.0))
        .alias("total_quantity"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("position"),
        "l_extendedprice",
        key.alias("l_partkey"),
    )


def shop_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Product pages of every shop, built from the part table; one page per part."""
    key, size, name = F.col("p_partkey"), F.col("p_size"), F.col("p_name")
    site = pick(key, ["amazon", "mumzworld", "saco", "fine", "gogreen", "officesupply", "aerosense"])
    units = key % 2 == 0
    thousands = text("1,", F.lpad(size.cast("string"), 3, "0"))
    either = lambda a, b: F.when(units, a).otherwise(b)
    amazon = text(
        "<html><head><script>var x='<span id=\"productTitle\">no</span>';</script></head><body>",
        '<span id="productTitle" class="big"> ',
        either(text(name, " ", size, " wipes, pack of 3"), text(name, " ", size, " L")),
        ' </span><table><tr class="po-brand"><td><span>Brand</span></td><td>',
        '<span class="a-size po-break-word">', F.col("p_brand"), "</span></td></tr></table>",
        '<span class="a-price"><span class="a-price-whole">', thousands,
        '<span>.</span></span><span class="a-price-fraction">50</span></span>',
        '<table id="productDetails_techSpec_section_1"><tr><th>Weight</th><td>9 kg</td></tr>',
        "<tr><th> Liquid Volume </th><td> ",
        F.when(key % 5 == 0, text(size, " ml")).otherwise(text(size, "000 ml")),
        "<br></td></tr></table></body></html>",
    )
    mumzworld = text(
        '<body><h1 class="ProductDetails_productName__lcVK_">Acme - ', name, " ",
        either(text(size, "s x 2"), text(size, " ml x 2")),
        '</h1><span class="Price_integer__3ngZQ"> ', thousands, " </span></body>",
    )
    saco = text(
        '<h1 class="product-title">', name, " ",
        either(text(size, " - piece"), text(size, " Ltr")),
        '</h1><span class="discount-price"> ', size, " <sup>95</sup></span>",
        '<ul class="details-box"><li><label>Code:</label><span>77</span></li>',
        "<li><label>Brand: </label><span> ", F.col("p_brand"), " </span></li></ul>",
    )
    fine = text(
        "<h1>Shop</h1><div class='ecomz-product-name-style'><b>", name, "</b></div>",
        '<div class="ecomz-product-price-style">Now SAR <b>', thousands, ".25</b></div>",
        '<div class="product-tr"><div class="product-cell">',
        either(F.lit("Number of wipes"), F.lit("Volume")),
        '</div><div class="product-cell">', either(size.cast("string"), text(size, " ml")),
        '</div></div><div class="product-tr"><div class="product-cell">Pack</div>',
        '<div class="product-cell">4 in a box</div></div>',
    )
    gogreen = text(
        '<h1 class="h5 bold">', name, " ",
        either(text(size, " pcs"), text("12 Pcs x ", size, " LTR")),
        '</h1><span class="js-product-price">SAR ', thousands, ".50 only</span>",
    )
    officesupply = text(
        '<div class="ut2-pb__title"><h1>', name, " ",
        either(text(size, " sheets"), text("(6 bottles x ", size, " Ltr)")),
        '</h1></div><span class="ty-price"><bdi><span class="ty-price-num">SAR</span>',
        '<span class="ty-price-num">', size, "<sup>75</sup></span></bdi></span>",
    )
    item = lambda package, amount: text(
        '<div class="js-form-item"><span class="package"> ', package,
        ' </span><span class="variationprice">€ ', amount, "</span></div>",
    )
    aerosense = text(
        '<h1><div class="field--name-title"> ', name, " </div></h1>",
        '<div id="edit-purchased-entity-0-attributes-attribute-volume">',
        item(either(text("(", size, " pcs)"), text(size, " l x 2")), text(thousands, ".00")),
        item(either(text("6-pack x ", size), F.lit("5 ml")), F.lit("2.00")),
        '<div class="js-form-item"><span class="package">no price</span></div></div>',
    )
    html = (
        F.when(site == "amazon", amazon).when(site == "mumzworld", mumzworld)
        .when(site == "saco", saco).when(site == "fine", fine).when(site == "gogreen", gogreen)
        .when(site == "officesupply", officesupply).otherwise(aerosense)
    )
    return table(spark, folder, "part", spread=True).select(
        key.alias("p_partkey"),
        site.alias("site"),
        either(F.lit("units"), F.lit("volume")).alias("search_mode"),
        F.when(key % 11 == 0, F.lit("marble polish"))
        .when(units & (site == "amazon"), text(name, " wipes")).otherwise(name)
        .alias("search_keyword"),
        text("https://shop.example/", key).alias("url"),
        html.alias("html"),
    )


def listing_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Result pages with a good, a sponsored and an empty card; one page per part."""
    key, name = F.col("p_partkey"), F.col("p_name")
    site = pick(key, ["amazon", "mumzworld", "saco", "gogreen"])
    card = {
        "amazon": ('<div data-component-type="s-search-result"><a class="a-link-normal" href="', "</a></div>"),
        "mumzworld": ('<div class="ProductCard_productCard__kFgss"><a class="ProductCard_productName__Dz1Yx" href="', "</a></div>"),
        "saco": ('<div class="product-inner-container"><p class="product-name"><a href="', "</a></p></div>"),
        "gogreen": ('<div class="card card-product wide"><a class="css-thumbnail" href="', "</a></div>"),
    }

    def cards(shop: str) -> Column:
        head, tail = card[shop]
        one = lambda href, label: text(head, href, '">', label, tail)
        return text(
            "<body><a href='/home'>Home</a>",
            one(text("/p/", key), name),
            one(text("/spons/", key), text("ad ", name)),
            one(text("q?id=", key), F.lit(" ")),
            one(text("https://other.example/", key), F.lit("last")),
            head.replace(' href="', "") + ">no link" + tail + "</body>",
        )

    html = F.when(site == "amazon", cards("amazon")).when(site == "mumzworld", cards("mumzworld"))
    html = html.when(site == "saco", cards("saco")).otherwise(cards("gogreen"))
    return table(spark, folder, "part", spread=True).select(
        key.alias("p_partkey"), site.alias("site"),
        F.lit("https://shop.example/en/list").alias("url"), html.alias("html"),
    )

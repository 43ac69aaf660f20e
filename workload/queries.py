"""One registered query per operator or chain of operators."""

from __future__ import annotations

import datetime as dt
import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelens import sites
from pricelens.functions import price, quantity, relevance, text
from pricelens.operators import (
    clean, extract, forest, incremental, market, offers, pricing, searchplan, training,
)
from pricelens.sources import erp, files, store, tables

from . import bindings as b

QUERIES = {}


def query(function):
    """Register a query; a local session that names no shared folder gets one, any other must name its own."""

    @functools.wraps(function)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        local = spark.sparkContext.master.startswith("local")
        if local and spark.conf.get("spark.checkpoint.dir", None) is None:
            tables.use_folder(spark, _own_folder(spark.sparkContext.applicationId))
        return function(spark, folder)

    QUERIES[function.__name__] = run
    return function


@functools.cache
def _own_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix="pricelens-")


# Market statistics -----------------------------------------------------------


def _volume(spark, folder):
    return clean.volume_offers(clean.clean_offers(b.web_offers(spark, folder)))


def _units(spark, folder):
    return clean.unit_offers(clean.clean_offers(b.web_offers(spark, folder)))


def _written(offers_frame, *columns):
    """Cleaned offers as a table: the percentile steps read it several times."""
    wanted = offers_frame.select(*columns) if columns else offers_frame
    return tables.materialize(wanted, "offers")


@query
def market_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Market minimum, maximum and offer count per type after the percentile trim."""
    priced = _written(_volume(spark, folder), "type_of_product", "price_per_liter")
    trimmed = market.trim_outliers(priced, "price_per_liter")
    return market.market_stats(trimmed, "price_per_liter")


@query
def market_stats_units(spark, folder):
    priced = _written(_units(spark, folder), "type_of_product", "price_per_item")
    trimmed = market.trim_outliers(priced, "price_per_item")
    return market.market_stats(trimmed, "price_per_item")


@query
def percentile_bounds(spark, folder):
    priced = _written(_volume(spark, folder), "type_of_product", "price_per_liter")
    bounds = market.percentile_bounds(priced, "price_per_liter")
    return bounds.select(
        "type_of_product",
        F.round("lower_bound", 4).alias("lower_bound"),
        F.round("upper_bound", 4).alias("upper_bound"),
    )


@query
def outlier_trim(spark, folder):
    columns = ["type_of_product", "company", "price_sar", "total_quantity", "price_per_item"]
    return market.trim_outliers(
        _written(_units(spark, folder), *columns), "price_per_item"
    ).select(*columns)


def _both_paths(spark, folder):
    """Volume and unit offers cut from one written table of clean offers."""
    offers_table = _written(
        clean.clean_offers(b.web_offers(spark, folder)),
        "type_of_product", "unit_of_measurement", "total_quantity", "price_sar",
    )
    return clean.volume_offers(offers_table), clean.unit_offers(offers_table)


@query
def known_types(spark, folder):
    return market.known_types(*_both_paths(spark, folder))


# Cleaning --------------------------------------------------------------------


@query
def clean_offers(spark, folder):
    manual = erp.manual_offers(b.erp_competitors(spark, folder))
    return clean.clean_offers(b.web_offers(spark, folder), manual)


@query
def volume_offers(spark, folder):
    return _volume(spark, folder)


@query
def unit_price_items(spark, folder):
    return _units(spark, folder)


@query
def route_counts(spark, folder):
    return clean.route_counts(clean.clean_offers(b.web_offers(spark, folder)))


@query
def clean_price(spark, folder):
    amount = F.col("l_extendedprice")
    written = F.get(
        F.array(
            b.text("SAR ", b.money(amount)),
            b.text(" ", F.format_number(amount, 2), " SAR"),
            b.money(amount),
            F.lit("nan"),
            F.lit("1.5d"),
            b.text("SAR", F.floor(amount).cast("string"), "."),
            F.lit("call us"),
        ),
        F.pmod(F.col("l_linenumber") + F.col("l_suppkey"), F.lit(7)).cast("int"),
    )
    return b.table(spark, folder, "lineitem", spread=True).select(
        "l_orderkey", "l_linenumber", price.clean_price(written).alias("price")
    )


# ERP sources -----------------------------------------------------------------


@query
def catalog_scan(spark, folder):
    return erp.catalog(b.erp_catalog(spark, folder))


@query
def manual_offers(spark, folder):
    return erp.manual_offers(b.erp_competitors(spark, folder))


@query
def m2o_flatten(spark, folder):
    landed = b.erp_catalog(spark, folder)
    return landed.select(
        "product_id",
        text.many_to_one_name(F.col("type_of_product_id")).alias("type_of_product"),
        text.many_to_one_name(F.col("subindustry_id")).alias("subindustry"),
    )


@query
def recode(spark, folder):
    landed = b.erp_competitors(spark, folder)
    return landed.groupBy(
        text.recode(F.col("product_channel"), text.CHANNEL_CODES).alias("channel"),
        text.recode(F.col("uom"), text.UOM_CODES).alias("unit"),
    ).agg(F.count(F.lit(1)).alias("offers"))


def _quotes(spark, folder):
    lines = erp.sale_lines(b.sale_lines(spark, folder), b.sale_orders(spark, folder), b.QUOTE_YEAR)
    return erp.quotes(lines)


@query
def quote_prices(spark, folder):
    return _quotes(spark, folder)


@query
def csv_round_trip(spark, folder):
    """Quotes written as CSV and read again, commas, quotes, gaps and order included."""
    path = f"{tables.shared_folder(spark)}/quotes-{uuid.uuid4().hex}"
    key = F.col("seq")
    odd = F.when(key % 5 != 0, F.concat(F.lit('a "b", '), "description"))
    files.write_quotes(_quotes(spark, folder).withColumn("description", odd), path)
    return files.read_quotes(spark, path)


@query
def csv_rejects(spark, folder):
    """Quotes from a CSV in which every seventh price is not a number: usable rows, and why others are rejected."""
    path = f"{tables.shared_folder(spark)}/quotes-{uuid.uuid4().hex}"
    price = F.col("approved_quote_price").cast("string")
    broken = F.when(F.col("seq") % 7 == 0, F.concat(F.lit("n/a "), "seq")).otherwise(price)
    files.write_quotes(_quotes(spark, folder).withColumn("approved_quote_price", broken), path)
    rows, rejects = files.read_quotes_checked(spark, path)
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(
        rejects.select(F.array_join("reasons", "; ").alias("reason")), allowMissingColumns=True)


@query
def offer_runs(spark, folder):
    """The offer table after two runs, the second of which was repeated."""
    path = f"{tables.shared_folder(spark)}/offers-{uuid.uuid4().hex}"
    rows = _quotes(spark, folder).withColumn("date", F.lit("2025-01-02").cast("date"))
    for run_id, rest in (("r1", 0), ("r2", 1), ("r2", 1)):
        tables.write_offers(rows.filter(F.col("seq") % 2 == rest), path, run_id)
    return tables.read_offers(spark, path, ["r1", "r2"]).select("date", "product_id", "seq")


@query
def last_full_run(spark, folder):
    """Run log of one run per order, some full ones: the last full run and the runs since."""
    base = f"{tables.shared_folder(spark)}/state-{uuid.uuid4().hex}"
    state = store.RunState(spark, base)
    key = F.col("o_orderkey")
    state.record(b.table(spark, folder, "orders").select(
        b.text("r", key).alias("run_id"),
        F.when(key % 97 == 0, "full").otherwise("partial").alias("mode"),
        (F.col("o_orderdate").cast("timestamp_ntz") + F.make_dt_interval(secs=key % 86_400)).alias("finished_at"),
    ))
    return state.runs_since_full().withColumn("last_full", F.lit(state.last_full_run()))


@query
def new_products(spark, folder):
    products = b.table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("product_id"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("create_date"),
    )
    return incremental.new_products(products, dt.datetime(2000, 6, 1, 12, 30))


# Training and prediction -----------------------------------------------------


@query
def latest_quote(spark, folder):
    latest = pricing.latest_quotes(_quotes(spark, folder))
    return pricing.prediction_frame(b.catalog(spark, folder), latest).select(
        "product_id", "type_of_product", "subindustry", "channel", "company",
        "approved_quote_price",
    )


@query
def predictable_products(spark, folder):
    key = F.col("seq")
    catalog = b.catalog(spark, folder).withColumn(
        "type_of_product",
        F.when(key % 7 == 0, b.text("  ", F.col("type_of_product"), " "))
        .when(key % 11 == 0, b.text("X-", F.col("type_of_product")))
        .otherwise(F.col("type_of_product")),
    )
    types = market.known_types(*_both_paths(spark, folder))
    return training.predictable_products(catalog, types).select("product_id", "type_of_product")


def _own(spark, folder):
    return training.own_quotes(_quotes(spark, folder), b.catalog(spark, folder))


@query
def training_volume(spark, folder):
    trimmed = market.trim_outliers(_written(_volume(spark, folder)), "price_per_liter")
    return training.volume_training(trimmed, _own(spark, folder))


@query
def training_units(spark, folder):
    trimmed = market.trim_outliers(_written(_units(spark, folder)), "price_per_item")
    return training.unit_training(trimmed, _own(spark, folder))


def _forest(spark, folder, train, size, label, **options):
    path = f"{tables.shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    forest.save_model(forest.fit_forest(train, size, label, **options), path)
    return path


def _products(spark, folder):
    latest = pricing.latest_quotes(_quotes(spark, folder))
    return pricing.prediction_frame(b.catalog(spark, folder), latest)


@query
def forest_predict(spark, folder):
    """Volumetric products priced by a forest trained on the trimmed offers and quotes."""
    train = training_volume(spark, folder)
    path = _forest(spark, folder, train, "volume_liters", "price_per_liter")
    products = _products(spark, folder).filter(F.col("volume_liters") > 0)
    return forest.predict(products, path, "volume_liters").select(
        "product_id", "type_of_product", "predicted_price_per_unit", "model_confidence"
    )


@query
def forest_confidence(spark, folder):
    """How sure the unit model is, by sub-industry."""
    train = training_units(spark, folder)
    path = _forest(spark, folder, train, "total_quantity", "price_per_item")
    products = _products(spark, folder).filter(F.col("pack_quantity_units") > 0)
    sized = products.withColumn("total_quantity", F.col("pack_quantity_units"))
    predicted = forest.predict(sized, path, "total_quantity")
    return predicted.groupBy("subindustry").agg(
        F.count(F.lit(1)).alias("products"),
        F.min("model_confidence").alias("least"),
        F.max("model_confidence").alias("most"),
    )


@query
def forest_rows(spark, folder):
    """Every product with a size keeps its row: repeated, null ids and missing numbers included.

    Of the prices it tells whether they lie within the labels' range of training.
    """
    train = tables.materialize(training_volume(spark, folder), "labels")
    path = _forest(
        spark, folder, train, "volume_liters", "price_per_liter", trees=10, max_depth=10)
    key = F.col("seq")
    products = _products(spark, folder).withColumns({
        "volume_liters": F.when(key % 13 != 0, F.col("volume_liters")),
        "approved_quote_price": F.when(key % 17 != 0, F.col("approved_quote_price")),
        "product_id": F.when(key % 19 == 0, F.lit("FP-0")).when(key % 23 != 0, F.col("product_id")),
    })
    labels = train.agg(F.min("price_per_liter").alias("_least"), F.max("price_per_liter").alias("_most"))
    predicted = forest.predict(products, path, "volume_liters").join(F.broadcast(labels))  # one row
    price, sure = F.col("predicted_price_per_unit"), F.col("model_confidence")
    return predicted.select(
        "seq", "product_id", price.isNotNull().alias("priced"),
        F.when(price.isNotNull(), price.between(F.col("_least") - 1e-6, F.col("_most") + 1e-6)).alias("in_range"),
        F.when(sure.isNotNull(), sure.between(0, 100)).alias("sure_in_range"),
    )


@query
def forest_folds(spark, folder):
    """How many training rows each part of the trees leaves out: the folds of all quotes by key."""
    lines = b.table(spark, folder, "lineitem").select(
        F.concat_ws("/", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("key"))
    return lines.groupBy(forest.fold_of(F.col("key")).alias("fold")).agg(F.count(F.lit(1)).alias("rows_left_out"))


@query
def forest_score(spark, folder):
    """The unit forest's score by trees that never saw a row, beside every fold's number of rows."""
    train = training_units(spark, folder)
    model = forest.fit_forest(train, "total_quantity", "price_per_item")
    scored = tables.materialize(forest.out_of_bag(model), "out-of-bag")
    missed = F.col("label") - F.col("price")
    return scored.groupBy("fold").agg(
        F.count(F.lit(1)).alias("rows_scored"), F.sqrt(F.avg(missed * missed)).alias("error"),
        (1 - F.avg(missed * missed) / F.var_pop("label")).alias("r2"),
    )


@query
def encoded_features(spark, folder):
    """How the models see products: one flag per type known from training, none for others."""
    known = _products(spark, folder).filter((F.col("seq") % 3 == 0) & (F.col("subindustry") != "Pets"))
    train = known.select(
        F.col("pack_quantity_units").alias("total_quantity"), (F.col("seq") % 7 + 1.0).alias("price_per_item"),
        "approved_quote_price", *forest.CATEGORIES,
    )
    fitted = forest.fit_forest(train, "total_quantity", "price_per_item", trees=2, max_depth=2)
    path = f"{tables.shared_folder(spark)}/forest-{uuid.uuid4().hex}"
    forest.save_model(fitted, path)
    products = _products(spark, folder).withColumn(
        "type_of_product", F.when(F.col("seq") % 5 != 0, F.col("type_of_product")))
    return forest.flags(forest.load_model(path), products).select(
        "seq", F.length(F.replace("type_of_product_flags", F.lit("0"))).alias("types_flagged"),
        "subindustry_flags", "channel_flags",
    )


@query
def tree_confidence(spark, folder):
    """Mean, spread and confidence of given tree values: the prices of an order's lines."""
    values = b.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sort_array(F.collect_list("l_quantity")).alias("trees"))  # seven lines an order at most
    mean, spread = forest.tree_stats(F.col("trees"))
    return values.select(
        "l_orderkey", F.round(mean, 6).alias("tree_mean"), F.round(spread, 6).alias("tree_spread"),
        forest.confidence(mean, spread).alias("confidence"),
    )


# Price report ----------------------------------------------------------------


def _report(spark, folder):
    """The report for a given unit price, so that it can be checked without a model."""
    volume, units = _both_paths(spark, folder)
    stats = pricing.both_stats(
        market.market_stats(volume, "price_per_liter"),
        market.market_stats(units, "price_per_item"),
    )
    key = F.col("seq")
    predicted = b.catalog(spark, folder).withColumns({
        "volume_liters": F.when(key % 23 != 0, F.col("volume_liters")),
        "pack_quantity_units": F.when(key % 31 != 0, F.col("pack_quantity_units")),
        "unit_cost_sar": F.when(key % 37 == 0, 0.0).otherwise(F.col("unit_cost_sar")),
        "type_of_product": F.when(key % 41 == 0, "Z9-Unknown").otherwise(F.col("type_of_product")),
        "predicted_price_per_unit": F.col("unit_cost_sar") * (key % 5) / 4,
        "model_confidence": (key % 100).cast("double"),
    })
    return pricing.price_report(predicted, stats)


@query
def price_guardrails(spark, folder):
    return _report(spark, folder)


@query
def loss_products(spark, folder):
    return pricing.loss_count(_report(spark, folder))


@query
def upload_records(spark, folder):
    return pricing.upload_records(_report(spark, folder))


def _published(spark, folder, modes):
    """Publish the even, then the odd, then all products; return the store."""
    base = f"{tables.shared_folder(spark)}/store-{uuid.uuid4().hex}"
    suggestions = store.SuggestionStore(spark, base)
    records = pricing.upload_records(_report(spark, folder)).filter(
        F.col("reject_reason").isNull()
    )
    number = F.substring("product_id_str", 4, 20).cast("bigint")
    batches = [records.filter(number % 2 == 0), records.filter(number % 2 == 1), records]
    for day, (batch, mode) in enumerate(zip(batches, modes), start=1):
        suggestions.publish(batch, f"r{day}", mode, dt.datetime(2025, 1, day))
    return suggestions


@query
def publish_partial(spark, folder):
    """Two partial runs: the second adds to the first."""
    current = _published(spark, folder, ["partial", "partial"]).current()
    return current.select("product_id_str", "suggested_price", "create_date", "run_id")


@query
def publish_full(spark, folder):
    """Two partial runs and a full one: current rows and the archived ones."""
    suggestions = _published(spark, folder, ["partial", "partial", "full"])
    current = suggestions.current().select(
        F.lit("current").alias("part"), "product_id_str", "suggested_price",
        F.col("create_date").alias("created"),
    )
    archived = suggestions.history().select(
        F.lit("history").alias("part"), "product_id_str", "suggested_price",
        F.col("original_create_date").alias("created"),
    )
    return current.unionByName(archived)


# Search plan -----------------------------------------------------------------


def _instructions(spark, folder):
    return searchplan.instruction_list(
        b.plan_catalog(spark, folder), b.modifiers(spark, folder), "seq"
    )


@query
def instruction_list(spark, folder):
    return _instructions(spark, folder)


@query
def search_plan(spark, folder):
    return searchplan.search_plan(_instructions(spark, folder)).drop("search_url", "seq")


@query
def search_url(spark, folder):
    plan = searchplan.search_plan(_instructions(spark, folder))
    return plan.select("site", "search_keyword", "search_url").distinct()


@query
def first_industry(spark, folder):
    return offers.first_industry(
        searchplan.instruction_list(b.plan_catalog(spark, folder), sequence="seq")
    )


# Quantities ------------------------------------------------------------------


def _parsed(spark, folder, parse):
    parsed = b.titles(spark, folder).withColumn("q", parse(F.col("title")))
    return parsed.select("p_partkey", "q.quantity", "q.unit", "q.normalized")


@query
def parse_volume(spark, folder):
    return _parsed(spark, folder, quantity.volume)


@query
def parse_count(spark, folder):
    return _parsed(spark, folder, quantity.hyphen_or_plain_count)


@query
def parse_multiplier(spark, folder):
    return _parsed(spark, folder, quantity.volume_with_multiplier)


@query
def package_units(spark, folder):
    title = F.col("title")
    return b.titles(spark, folder).select(
        "p_partkey",
        quantity.package_units(title).alias("units"),
        quantity.package_volume_ml(title).alias("volume_ml"),
    )


@query
def listing_quantity(spark, folder):
    title = F.col("title")
    counted = b.titles(spark, folder).withColumns({
        "u": quantity.listing_quantity(title, F.lit("units")),
        "v": quantity.listing_quantity(title, F.lit("volume")),
    })
    return counted.select(
        "p_partkey", F.col("u.quantity").alias("units"), F.col("v.quantity").alias("volume"),
        F.col("v.unit").alias("volume_unit"),
    )


@query
def wipes_total(spark, folder):
    return b.titles(spark, folder).select(
        "p_partkey", quantity.wipes_total(F.col("title")).alias("wipes")
    )


@query
def spec_quantity(spark, folder):
    rows, title = F.col("spec_rows"), F.col("title")
    found = b.spec_pages(spark, folder).withColumn(
        "q", quantity.spec_quantity(rows, title, F.col("search_mode"))
    )
    return found.select(
        "p_partkey",
        quantity.spec_multiplier(rows).alias("spec_multiplier"),
        quantity.title_multiplier(title).alias("title_multiplier"),
        "q.quantity", "q.unit",
    )


@query
def agree_quantity(spark, folder):
    agreed = b.quantity_texts(spark, folder).withColumn(
        "q", quantity.agreed_volume(F.col("title"), F.col("spec"), F.col("item"))
    )
    return agreed.select("p_partkey", "q.quantity", "q.unit", "q.status")


@query
def site_price(spark, folder):
    """The seven ways shops write a price."""
    amount = F.col("l_extendedprice")
    lines = b.table(spark, folder, "lineitem", spread=True).select(
        "l_orderkey", "l_linenumber", "l_extendedprice",
        F.format_number(amount, 2).alias("grouped"),
    )
    grouped = F.col("grouped")
    shown = tables.computed(lines, {
        "whole": F.substring_index(grouped, ".", 1),
        "cents": F.substring_index(grouped, ".", -1),
        "has_cents": F.col("l_linenumber") % 3 > 0,
    })
    whole, cents, has_cents = F.col("whole"), F.col("cents"), F.col("has_cents")
    shown_cents = F.when(has_cents, cents)
    return shown.select(
        "l_orderkey", "l_linenumber",
        price.whole_and_fraction(b.text(whole, "."), shown_cents).alias("whole_fraction"),
        price.after_sar(b.text("Now Sar  ", grouped, " incl. VAT")).alias("after_sar"),
        price.two_decimals(b.text("only ", F.when(has_cents, grouped).otherwise(whole)))
        .alias("two_decimals"),
        price.integer_price(whole).alias("integer_price"),
        price.superscript_price(
            F.when(has_cents, b.text(whole, cents)).otherwise(whole), shown_cents
        ).alias("superscript_price"),
        text.joined_text(F.array(b.text(" ", F.floor(amount)), F.lit(" "), cents), ".")
        .alias("joined_price"),
        price.euro_price(b.text("€ ", grouped)).alias("from_euro"),
    )


# Pages and offers ------------------------------------------------------------


def _generic(spark, folder):
    pages = b.table(spark, folder, "pages", spread=True).withColumn("site", F.lit("*"))
    return extract.raw_fields(pages, {"*": sites.GENERIC_FIELDS})


@query
def page_fields(spark, folder):
    nodes = F.col("nodes")
    joined = lambda field: F.array_join(extract.first_of(nodes, field)["parts"], "")
    return _generic(spark, folder).select(
        "page_id", joined("heading").alias("heading"), joined("page_title").alias("page_title"),
        F.col("error").isNotNull().alias("failed"),
    )


@query
def page_links(spark, folder):
    return (
        _generic(spark, folder)
        .select("page_id", F.posexplode(extract.all_of(F.col("nodes"), "link")))
        .select(
            "page_id", F.col("pos").cast("bigint").alias("rank"), F.col("col.href").alias("url"),
            F.col("col.text").alias("label"),
        )
        .filter(F.col("url").isNotNull())
    )


@query
def listing_links(spark, folder):
    raw = extract.raw_fields(b.listing_pages(spark, folder), sites.LISTING_FIELDS)
    return extract.listing_links(raw).select(
        "p_partkey", "site", F.col("rank").cast("bigint").alias("rank"), "product_url", "link_text"
    )


@query
def page_offers(spark, folder):
    """Shop pages to accepted offers: extraction, prices, quantities, checks and caps."""
    raw = extract.raw_fields(b.shop_pages(spark, folder), sites.PAGE_FIELDS)
    accepted = offers.page_offers(raw, ["p_partkey", "product"])
    return accepted.select(
        "p_partkey", "site", "product", "price_sar", "company", "total_quantity",
        "unit_of_measurement",
    )


@query
def offer_validity(spark, folder):
    checked = offers.with_reject_reason(b.site_searches(spark, folder))
    return checked.groupBy("site", "reject_reason").agg(F.count(F.lit(1)).alias("offers"))


@query
def offer_cap(spark, folder):
    """Limits per instruction: each offer is found for two industries of one product type."""
    valid = offers.valid_offers(b.site_searches(spark, folder)).withColumns({
        "type_of_product": F.lit("T"), "subindustry": F.lit("Home"),
        "generic_product_type": F.lit("Cleaner"),
        "industry": F.explode(F.array(F.lit("Living"), F.lit("Working"))),
    })
    order = ["position", "l_partkey", "l_extendedprice"]
    return offers.capped_offers(valid, order).select(
        "industry", "site", "search_keyword", "position", "product", "price_sar", "total_quantity"
    )


@query
def query_relevance(spark, folder):
    """Titles against the product names as queries."""
    title, asked = F.col("title"), F.col("asked")
    key = F.col("p_partkey")
    extra = F.get(
        F.array(*[F.lit(x) for x in (
            "", " cleaner cloth", " + promo", " for marble floors", " car wax", " laundry bundle",
            " dishes and glass",
        )]),
        F.pmod(key, F.lit(7)).cast("int"),
    )
    wanted = F.get(
        F.array(*[F.lit(x) for x in (
            "", " cleaners", " for vehicle", " marble", " polish and wax", " wipes",
            " with microfiber", " for the glass", " waterless wash", " laundry",
        )]),
        F.pmod(key, F.lit(10)).cast("int"),
    )
    pairs = b.table(spark, folder, "part").select(
        "p_partkey", b.text(F.col("p_name"), extra).alias("title"),
        b.text(F.col("p_name"), wanted).alias("asked"),
    )
    return pairs.select(
        "p_partkey",
        F.round(relevance.coverage(title, asked), 4).alias("coverage"),
        relevance.is_relevant(title, asked).alias("relevant"),
    )


@query
def offer_assembly(spark, folder):
    """Accepted page offers as 13-column rows of their plan entry."""
    raw = extract.raw_fields(b.shop_pages(spark, folder), sites.PAGE_FIELDS)
    accepted = offers.page_offers(raw, ["p_partkey", "product"])
    instructions = searchplan.instruction_list(b.plan_catalog(spark, folder), sequence="seq")
    entries = b.plan_catalog(spark, folder).select(
        F.col("seq").alias("p_partkey"), "type_of_product", "subindustry",
        "generic_product_type", text.channel(F.col("subindustry")).alias("channel"),
    )
    planned = accepted.join(entries, "p_partkey")
    run_date = F.lit("2025-03-01")
    return offers.assembled_offers(planned, instructions, run_date)

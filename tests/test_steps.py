import datetime as dt

import pytest
from pyspark.sql import functions as F

from pricelens.operators import clean, incremental, offers, pricing, searchplan, training
from pricelens.sources import erp, files, schemas, tables

OFFER = (
    "industry string, subindustry string, type_of_product string, generic_product_type string, "
    "price_sar string, company string, unit_of_measurement string, total_quantity string, "
    "channel string"
)


def offers_of(spark, rows):
    full = [("I", "Home", "T", "G", p, "C", u, q, "B2C") for p, u, q in rows]
    return spark.createDataFrame(full, OFFER)


def test_paths_of_offers(spark):
    web = offers_of(spark, [
        ("SAR 10", " ML ", "500"), ("20", "l", "2"), ("30", "fl oz", "10"), ("5", "g", "100"),
        ("5", "kg", "1"), ("8", "Units", "4"), ("9", None, "3"), ("9", "units", "0"),
        ("9", "l", "0"), ("bad", "l", "1"), ("9", "units", "many"), ("7", "l", "-1"),
    ])
    cleaned = clean.clean_offers(web, offers_of(spark, [("1,000", "Unknown", "10")]))
    volume = sorted(r.price_per_liter for r in clean.volume_offers(cleaned).collect())
    assert volume == pytest.approx([-7.0, 10.0, 20.0, 30 / (10 * 0.0295735)])
    units = sorted(r.price_per_item for r in clean.unit_offers(cleaned).collect())
    assert units == [2.0, 3.0, 100.0]
    counts = {r.path: r.offers for r in clean.route_counts(cleaned).collect()}
    assert counts == {"excluded_weight": 2, "unit": 5, "volume": 6}


def test_litre_conversion_is_linear(spark):
    frame = spark.range(1, 50).select(F.col("id").cast("double").alias("q"))
    for unit in ("ml", "l", "fl oz"):
        one, two = (clean.liters(F.col("q") * k, F.lit(unit)) for k in (1, 2))
        assert all(r[0] == pytest.approx(2 * r[1]) for r in frame.select(two, one).collect())


def catalog_of(spark, rows):
    return spark.createDataFrame(
        rows,
        "product_id string, type_of_product string, subindustry string, industry string, "
        "generic_product_type string",
    )


def test_search_plan(spark):
    catalog = catalog_of(spark, [
        ("1", "H6-Leather cleaner", "Home", "Living", "Cleaner"),
        ("2", "H6-Leather cleaner", "Home", "Living", "Cleaner"),
        ("3", "F1-FM hand soap", "Hotels", "Stay", "Soap"),
        ("4", "F9-Wet wipes", "Gyms", "Sport", "Wipes"),
        ("5", "C1-Car air freshener", "Automotive", "Cars", "Fresh"),
        ("6", None, "Home", "Living", "X"),
        ("7", "X1-Thing", "Shipyards", "Sea", "X"),
    ])
    modifiers = spark.createDataFrame(
        [("F1-FM hand soap", "Fine:foam soap; gogreen:soap; gogreen:hand wash"),
         ("F9-Wet wipes", "gym ; big")],
        "type_of_product string, search_modifiers string",
    )
    plan = searchplan.search_plan(searchplan.instruction_list(catalog, modifiers, "product_id"))
    got = sorted((r.site, r.search_keyword, r.search_mode, r.channel) for r in plan.collect())
    assert got == [
        ("amazon", "car air freshener", "volume", "B2C"),
        ("amazon", "leather cleaner", "volume", "B2C"),
        ("fine", "foam soap", "volume", "B2B"),
        ("fine", "wet wipes gym big", "units", "B2B"),
        ("gogreen", "hand wash", "volume", "B2B"),
        ("gogreen", "soap", "volume", "B2B"),
        ("gogreen", "wet wipes gym big", "units", "B2B"),
        ("officesupply", "wet wipes gym big", "units", "B2B"),
        ("saco", "leather cleaner", "volume", "B2C"),
    ]
    urls = {r.site: r.search_url for r in plan.filter(F.col("search_keyword").contains("gym")).collect()}
    assert urls["fine"].endswith("/products?keyword=wet%20wipes%20gym%20big")


def test_instruction_list_needs_its_columns(spark):
    with pytest.raises(ValueError, match="industry"):
        searchplan.instruction_list(spark.createDataFrame([("a",)], "type_of_product string"))


def test_instruction_list_without_modifiers(spark):
    catalog = catalog_of(spark, [("1", "T", "Home", "I", "G"), ("2", "T", "Home", "I", "G")])
    assert [r.search_modifiers for r in searchplan.instruction_list(catalog).collect()] == [""]


def test_catalog_filters_and_links(spark):
    columns = ", ".join(f"{c} string" for c in ["status", *schemas.ERP_CATALOG_COLUMNS])
    base = dict.fromkeys(schemas.ERP_CATALOG_COLUMNS)
    link = lambda name: f'[1, "{name}"]'

    def row(status, kind, sub):
        return ("active" if status else "archived", *{
            **base, "type_of_product_id": kind, "subindustry_id": sub, "industry_id": "false"
        }.values())

    landed = spark.createDataFrame([
        row(True, link("H1-Soap"), link("Home")), row(False, link("H1-Soap"), link("Home")),
        row(True, link("H1-Soap"), link("Defense")), row(True, "false", link("Home")),
        row(True, link("P11-Other consumables for pets"), link("Pets")),
    ], columns)
    kept = erp.catalog(landed).collect()
    assert [(r.type_of_product, r.subindustry, r.industry) for r in kept] == [("H1-Soap", "Home", None)]


def test_manual_offers_fill_missing_columns(spark):
    landed = spark.createDataFrame(
        [("2025-02-03", "retail", '[1, "H1-Soap"]', "ml", 5.0)],
        "date string, product_channel string, classification_id string, uom string, "
        "price_unit_sar double",
    )
    row = erp.manual_offers(landed).first()
    assert (row.date, row.channel, row.type_of_product, row.unit_of_measurement, row.company) == (
        "03/02/2025", "B2C", "H1-Soap", "mL", None
    )


def test_quotes_and_latest(spark):
    lines = spark.createDataFrame([
        (1, "[FP-1] Soap", 2.0, 10.0, 1), (1, "[FP-1] Soap", 1.0, 7.0, 9), (2, "[FP-1] Soap", 1.0, 99.0, 20),
        (1, "Delivery", 1.0, 5.0, 3), (1, "[FP-2] Gel", 0.0, 5.0, 4), (3, "[FP-3] Old", 1.0, 5.0, 5),
    ], "order_id int, name string, product_uom_qty double, price_subtotal double, seq int")
    orders = spark.createDataFrame([
        (1, "sale", dt.datetime(2025, 12, 31, 23, 59, 59)), (2, "draft", dt.datetime(2025, 5, 1)),
        (3, "sale", dt.datetime(2026, 1, 1)),
    ], "order_id int, state string, date_order timestamp_ntz")
    quotes = erp.quotes(erp.sale_lines(lines, orders, 2025))
    assert sorted((r.product_id, r.description, r.approved_quote_price) for r in quotes.collect()) == [
        ("FP-1", "Soap", 5.0), ("FP-1", "Soap", 7.0)
    ]
    assert [tuple(r) for r in pricing.latest_quotes(quotes).collect()] == [("FP-1", 7.0)]


def test_training_rows(spark):
    catalog = spark.createDataFrame([
        ("FP-1", "T", "Home", "I", "G", 0.5, None), ("FP-2", "U", "Hotels", "I", "G", None, 4.0),
        ("FP-3", "U", "Hotels", "I", "G", 0.0, 0.0),
    ], "product_id string, type_of_product string, subindustry string, industry string, "
       "generic_product_type string, volume_liters double, pack_quantity_units double")
    quotes = spark.createDataFrame(
        [("FP-1", 5.0), ("FP-1", 6.0), ("FP-2", 8.0), ("FP-3", 9.0), ("FP-9", 1.0), (None, 2.0)],
        "product_id string, approved_quote_price double",
    )
    own = training.own_quotes(quotes, catalog, "Us")
    nothing = offers_of(spark, []).withColumns({
        "price_sar": F.lit(1.0), "volume_liters": F.lit(1.0), "price_per_liter": F.lit(1.0),
        "price_per_item": F.lit(1.0), "total_quantity": F.lit(1.0),
    })
    volume = training.volume_training(nothing, own).collect()
    assert sorted((r.price_per_liter, r.unit_of_measurement, r.channel, r.company) for r in volume) == [
        (10.0, "ml", "B2C", "Us"), (12.0, "ml", "B2C", "Us")
    ]
    units = training.unit_training(nothing, own).collect()
    assert [(r.price_per_item, r.total_quantity, r.channel) for r in units] == [(2.0, 4.0, "B2B")]


def test_report_paths_floor_and_rejects(spark):
    predicted = spark.createDataFrame([
        ("1", 2.0, None, 10.0, 20.0), ("2", None, 3.0, 10.0, 1.0), ("3", None, None, 10.0, 5.0),
        ("4", 0.0, 0.0, 0.0, 5.0), ("5", 1.0, 6.0, None, 5.0),
    ], "product_id string, volume_liters double, pack_quantity_units double, unit_cost_sar double, "
       "predicted_price_per_unit double").withColumns({
        "type_of_product": F.lit("T"), "product_name": F.lit("n"), "subindustry": F.lit("s"),
        "industry": F.lit("i"), "generic_product_type": F.lit("g"), "model_confidence": F.lit(80.0),
    })
    vol = spark.createDataFrame([("T", 1.0, 4.0, 7)], "type_of_product string, market_min double, market_max double, competitor_count long")
    none = vol.limit(0)
    report = pricing.price_report(predicted, pricing.both_stats(vol, none))
    rows = {r.product_id: r for r in report.collect()}
    got = {k: (r.volume, r.predicted_price, r.porcentaje_de_ganancia, r.market_max_found, r.competitors_count, r.model_confidence) for k, r in rows.items()}
    assert got == {
        "1": ("2.0 L", 40.0, 300.0, 8.0, 7, 80.0),
        "2": ("3 units", 13.0, 30.0, 0.0, 0, 80.0),
        "3": (None, 13.0, 30.0, 0.0, 0, 0.0),
        "4": ("0 units", 0.0, 0.0, 0.0, 0, 0.0),
        "5": ("1.0 L", 5.0, 0.0, 4.0, 7, 80.0),
    }
    rejected = pricing.upload_records(report).filter("reject_reason is not null").collect()
    assert [r.product_id_str for r in rejected] == ["3"]
    assert tuple(pricing.loss_count(report).first()) == (1, 5)


def test_run_mode():
    now = dt.datetime(2025, 3, 31, 12)
    assert incremental.months_before(now) == dt.datetime(2025, 3, 3, 12)
    assert incremental.run_mode(None, now) == "full"
    assert incremental.run_mode(dt.datetime(2025, 3, 1), now) == "full"
    assert incremental.run_mode(dt.datetime(2025, 3, 30), now) == "partial"


def test_new_products_are_strictly_newer(spark):
    at = dt.datetime(2025, 1, 1, 10)
    frame = spark.createDataFrame(
        [("old", at), ("new", at + dt.timedelta(seconds=1)), ("none", None)],
        "id string, create_date timestamp_ntz",
    )
    assert [r.id for r in incremental.new_products(frame, at).collect()] == ["new"]


def test_csv_by_name(spark, tmp_path):
    path = tmp_path / "catalog.csv"
    path.write_bytes(
        "﻿Product_ID , create_date,Volume_Liters,extra\nFP-1,2025-01-02 03:04:05,1.5,x\nFP-2,bad,\"a,b\",y\n"
        .encode()
    )
    rows = tables.read_csv(spark, str(path), schemas.CATALOG_CSV).collect()
    assert [(r.Product_ID, r.create_date, r.Volume_Liters, r.Industry) for r in rows] == [
        ("FP-1", dt.datetime(2025, 1, 2, 3, 4, 5), 1.5, None), ("FP-2", None, None, None)
    ]
    out = str(tmp_path / "out")
    tables.write_csv(spark.createDataFrame([("a", 1)], "n string, v int"), out)
    again = tables.read_csv(spark, out, spark.createDataFrame([], "v int, n string").schema)
    assert [tuple(r) for r in again.collect()] == [(1, "a")]


def test_csv_rejects(spark, tmp_path):
    """Every line is a row or a reject; too many, too few and untyped cells are rejected, gaps are not."""
    path = tmp_path / "quotes.csv"
    path.write_bytes(
        "\ufeffProduct_ID,Description,approved_quote_price,seq,extra\n"
        'FP-1,"a ""b"", c",1.5,1,x\nFP-2,b,dear,2,x\nFP-3,c,,3,x\nFP-4,d,1\nFP-5,e,1,5,x,y\nFP-6,f,oh,no,x\n'.encode()
    )
    rows, rejects = files.read_quotes_checked(spark, str(path))
    assert sorted((r.product_id, r.description, r.approved_quote_price, r.seq) for r in rows.collect()) == [
        ("FP-1", 'a "b", c', 1.5, 1), ("FP-3", "c", None, 3)]
    found = {r.line.split(",")[0]: r for r in rejects.collect()}
    assert {k: r.reasons for k, r in found.items()} == {
        "FP-2": ["approved_quote_price: dear"], "FP-4": ["cells"], "FP-5": ["cells"],
        "FP-6": ["approved_quote_price: oh", "seq: no"]}
    assert found["FP-5"].line == "FP-5,e,1,5,x,y" and found["FP-2"].line == "FP-2,b,dear,2,x"
    assert all(r.file.endswith("quotes.csv") for r in found.values())
    # Reading some columns only gives the same rows.
    assert rows.select("seq").count() == 2 and rejects.select("file").count() == 4
    (tmp_path / "empty.csv").write_text("Product_ID,create_date\n")
    assert [part.count() for part in files.read_catalog_checked(spark, str(tmp_path / "empty.csv"))] == [0, 0]
    (tmp_path / "old.csv").write_text("Product_ID,create_date\nFP-1,2025-01-02 03:04:05\nFP-2,yesterday\n")
    rows, rejects = files.read_catalog_checked(spark, str(tmp_path / "old.csv"))
    row = rows.first()
    assert (row.product_id, row.create_date, row.industry) == ("FP-1", dt.datetime(2025, 1, 2, 3, 4, 5), None)
    assert rejects.first().reasons == ["create_date: yesterday"]


def test_exchanged_tables_begin_with_a_mark(spark, tmp_path):
    path = tmp_path / "plan"
    plan = searchplan.instruction_list(catalog_of(spark, [("1", "T", "Home", "I", "G")]))
    files.write_instructions(plan, str(path))
    parts = [p for p in path.iterdir() if p.suffix == ".csv"]
    assert parts and all(p.read_bytes().startswith(b"\xef\xbb\xbfType of product,") for p in parts)


def test_report_and_cleaned_tables_as_files(spark, tmp_path):
    volume = spark.createDataFrame(
        [("I", "S", "T", "G", 2.5, "C, Inc", "mL", 500.0, "B2B", 0.5, 5.0)], schemas.VOLUME_OFFERS)
    units = spark.createDataFrame([("I", None, "T", "G", 2.5, 'the "C"', "units", 10.0, "B2B", 0.25)], schemas.UNIT_OFFERS)
    report = spark.createDataFrame(
        [("FP-1", 'Soap "x", 1 L', "T", "G", "S", "I", "1 L", 1.0, 2.0, 2.0, 100.0, 0.9, None, None, 3.0)], schemas.REPORT)
    for frame, write, read in ((volume, files.write_volume_offers, files.read_volume_offers),
                               (units, files.write_unit_offers, files.read_unit_offers),
                               (report, files.write_report, files.read_report)):
        path = str(tmp_path / write.__name__)
        write(frame.withColumn("more", F.lit(1)), path)
        assert read(spark, path).collect() == frame.collect()


def test_offer_limits(spark):
    rows = [("fine", "soap", i, "p") for i in range(50)] + [("aerosense", "soap", i, "p") for i in range(90)]
    rows += [("amazon", "soap", i, "p") for i in range(60)] + [("fine", "gel", 1, "p")]
    frame = spark.createDataFrame(rows, "site string, search_keyword string, position int, product string")
    capped = offers.capped_offers(frame, ["position"])
    counts = {(r.site, r.search_keyword): (r.n, r.last) for r in capped.groupBy("site", "search_keyword").agg(
        F.count("*").alias("n"), F.max("position").alias("last")).collect()}
    assert counts == {("fine", "soap"): (5, 4), ("aerosense", "soap"): (90, 89),
                      ("amazon", "soap"): (40, 39), ("fine", "gel"): (1, 1)}
    plan = capped._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # limited per task before the shuffle


def test_offer_limits_are_per_instruction(spark):
    rows = [(i, ind, gen) for i in range(9) for ind in ("I1", "I2") for gen in ("G1", "G2")]
    frame = spark.createDataFrame(rows, "position int, industry string, generic_product_type string").withColumns({
        "site": F.lit("fine"), "search_keyword": F.lit("soap"), "search_mode": F.lit("volume"),
        "type_of_product": F.lit("T"), "subindustry": F.lit("S"), "product": F.lit("p"),
    })
    counts = offers.capped_offers(frame, ["position"]).groupBy("industry", "generic_product_type").count().collect()
    assert [r["count"] for r in counts] == [5] * 4


def test_exchanged_files_keep_their_headers(spark, tmp_path):
    catalog = spark.createDataFrame(
        [("FP-1", "H1-Soap", "Home", 1.5, dt.datetime(2025, 1, 2, 3, 4, 5))],
        "product_id string, type_of_product string, subindustry string, volume_liters double, "
        "create_date timestamp_ntz",
    )
    path = str(tmp_path / "catalog")
    files.write_catalog(catalog, path)
    assert spark.read.option("header", True).csv(path).columns == schemas.CATALOG_HEADERS
    row = files.read_catalog(spark, path).first()
    assert (row.product_id, row.type_of_product, row.volume_liters, row.create_date, row.industry) == (
        "FP-1", "H1-Soap", 1.5, dt.datetime(2025, 1, 2, 3, 4, 5), None)

    plan = searchplan.instruction_list(catalog_of(spark, [("1", "T", "Home", "I", "G")]))
    files.write_instructions(plan, str(tmp_path / "plan"))
    assert files.read_instructions(spark, str(tmp_path / "plan")).first().generic_product_type == "G"

    manual = erp.manual_offers(spark.createDataFrame([(5.0, "ml")], "price_unit_sar double, uom string"))
    files.write_manual_offers(manual, str(tmp_path / "manual"))
    back = files.read_manual_offers(spark, str(tmp_path / "manual")).first()
    assert (back.price_sar, back.unit_of_measurement, back.channel) == ("5.0", "mL", "Unknown")


def test_quotes_keep_their_order_through_a_file(spark, tmp_path):
    quotes = spark.createDataFrame(
        [("FP-1", 'a "b", c', 5.5, 2), ("FP-1", None, 4.0, 10), ("FP-2", "d", 1.0, 1)],
        "product_id string, description string, approved_quote_price double, seq bigint")
    files.write_quotes(quotes, str(tmp_path / "quotes"))
    back = files.read_quotes(spark, str(tmp_path / "quotes"))
    assert sorted(map(tuple, back.collect()), key=lambda r: r[3]) == sorted(
        map(tuple, quotes.collect()), key=lambda r: r[3])
    latest = {r.product_id: r.approved_quote_price for r in pricing.latest_quotes(back).collect()}
    assert latest == {"FP-1": 4.0, "FP-2": 1.0}
    (tmp_path / "old.csv").write_text("Product_ID,Description,approved_quote_price\nFP-1,a,1\n")
    with pytest.raises(ValueError, match="seq"):
        files.read_quotes(spark, str(tmp_path / "old.csv"))


def test_modifiers_file_may_be_missing(spark, tmp_path):
    assert files.read_modifiers(spark, str(tmp_path / "none.csv")) is None
    (tmp_path / "odd.csv").write_text("a,b\n1,2\n")
    assert files.read_modifiers(spark, str(tmp_path / "odd.csv")) is None
    (tmp_path / "good.csv").write_text("Type of product,Search Modifiers\nH1-Soap,fine:x; y\nH2-Gel,\n")
    rows = files.read_modifiers(spark, str(tmp_path / "good.csv")).collect()
    assert [tuple(r) for r in rows] == [("H1-Soap", "fine:x; y"), ("H2-Gel", None)]

import pytest
from pyspark.sql import functions as F

from pricelens.functions import price, quantity as q, relevance, text

def values(spark, function, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    result = rows.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()
    return [tuple(r.v) if isinstance(r.v, tuple) else r.v for r in result]


def check(spark, function, cases):
    assert values(spark, function, [t for t, _ in cases]) == [e for _, e in cases]


def test_volume(spark):
    check(spark, q.volume, [
        ("Cleaner 750ML", (750.0, "ml", 750.0)),
        ("Cleaner 1.5 L bottle", (1.5, "L", 1500.0)),
        ("3 litres", (3.0, "L", 3000.0)),
        ("2 Ltr", (2.0, "L", 2000.0)),
        ("500 g powder", (500.0, "g", 500.0)),
        ("2 kilograms", (2.0, "kg", 2000.0)),
        ("1 kg", (1.0, "kg", 1000.0)),
        ("10 fl oz", (10.0, "fl oz", 295.735)),
        ("10 Fluid Ounces", (10.0, "fl oz", 295.735)),
        ("4 oz 200 ml", (4.0, "fl oz", 4 * 29.5735)),
        ("12 large", None), ("no number ml", None), (None, None), ("", None),
    ])


def test_count(spark):
    check(spark, q.count, [
        ("Wipes 80 / pack", (80.0, "units", 80.0)),
        ("30 wet wipes", (30.0, "units", 30.0)),
        ("Cloths, 6 pcs", (6.0, "units", 6.0)),
        ("box of 12", (12.0, "units", 12.0)),
        ("20/box of 5 pieces", (20.0, "units", 20.0)),
        ("40 sanitizing wipes", (40.0, "units", 40.0)),
        ("12 pcsx", None), (None, None),
    ])
    check(spark, q.hyphen_or_plain_count, [
        ("Set 30-Piece", (30.0, "units", 30.0)), ("12 pieces", (12.0, "units", 12.0)),
    ])


def test_volume_with_multiplier(spark):
    check(spark, q.volume_with_multiplier, [
        ("Soap (12 Bottles x 1.5 Ltr) box", (18.0, "L", 18000.0)),
        ("Degreaser 12PcsX1 LTR", (12.0, "L", 12000.0)),
        ("6 x 500 ml", (3000.0, "ml", 3000.0)),
        ("500 ml", (500.0, "ml", 500.0)),
        ("6 x sponge", None),
    ])


def test_packages(spark):
    check(spark, q.package_units, [
        ("Wipes (50 pcs)", 50.0), ("6-pack x 12", 72.0), ("(50 PCS)", None), ("none", None),
    ])
    check(spark, q.package_volume_ml, [
        ("5 l", 5000.0), ("0,5 L x 12", 6000.0), ("400ml", 400.0), ("2.5 l x 4", 10000.0),
        ("sample", 0.0),
    ])


def test_listing(spark):
    units = lambda t: q.listing_quantity(t, F.lit("units"))
    check(spark, units, [
        ("Brand - Baby wipes 80s", (80.0, "units", 80.0)),
        ("Wipes 40 pcs Pack of 3", (120.0, "units", 120.0)),
        ("Wipes 40 pcs x 2", (80.0, "units", 80.0)),
        ("Wipes", None),
    ])
    volume = lambda t: q.listing_quantity(t, F.lit("volume"))
    check(spark, volume, [("Soap 500 ml x 2", (1000.0, "ml", 1000.0))])


def test_title_multiplier(spark):
    check(spark, q.title_multiplier, [
        ("Soap x 6", 6.0), ("Soap ×4", 4.0), ("Roll (Carton of 6x12)", 12.0),
        ("Soap 3 bottles", 3.0), ("Soap", 1.0),
    ])


def rows_of(spark, pairs, title, mode):
    frame = spark.createDataFrame(
        [(pairs, title, mode)],
        "rows array<struct<label:string,value:string>>, title string, mode string",
    )
    found = q.spec_quantity(F.col("rows"), F.col("title"), F.col("mode"))
    value = frame.select(found.alias("q")).first().q
    return None if value is None else (value.quantity, value.unit)


@pytest.mark.parametrize("pairs,title,mode,expected", [
    ([("Volume", "500 ml"), ("Pack", "12 per carton")], "Soap", "volume", (6000.0, "ml")),
    ([("Volume", "unknown"), ("Material", "2 L")], "Soap", "volume", (2.0, "L")),
    ([("Pack", "6"), ("Case", "4")], "Soap 750 ml", "volume", (3000.0, "ml")),
    ([("Pack", "100"), ("Case", "1")], "Soap 750 ml", "volume", (750.0, "ml")),
    ([("Pack", "2")], "Soap x 6 750 ml", "volume", (4500.0, "ml")),
    ([("Number of wipes", "80 wipes"), ("Pack", "3")], "Wipes", "units", (240.0, "units")),
    ([("Number of wipes", "many")], "Wipes 40 pcs", "units", (1600.0, "units")),
    ([], "Tissue 10 sheets", "volume", (10.0, "units")),
    ([], "Tissue", "volume", None),
])
def test_spec_quantity(spark, pairs, title, mode, expected):
    assert rows_of(spark, pairs, title, mode) == expected


def test_agreed_volume(spark):
    cases = [
        ("A 500 ml", "0.5 L", None, (500.0, "ml", "Confirmed by Title & Volume")),
        ("A 500 ml", "2 L", "500 Milliliters", (500.0, "ml", "Confirmed by Title & Item_volume")),
        ("A", "2 L", "2000 ml", (2.0, "L", "Confirmed by Volume & Item_volume")),
        ("A 500 ml", "501 ml", None, (0.0, "units", "Not Found")),
        ("A 500 ml", None, None, (0.0, "units", "Not Found")),
    ]
    frame = spark.createDataFrame([c[:3] for c in cases], "a string, b string, c string")
    found = frame.select(q.agreed_volume(F.col("a"), F.col("b"), F.col("c")).alias("q")).collect()
    assert [tuple(r.q) for r in found] == [c[3] for c in cases]


def test_wipes_total(spark):
    check(spark, q.wipes_total, [
        ("Clorox Disinfecting Bleach Free Cleaning Wipes, 75 Wipes, Pack Of 3", 225.0),
        ("Armor All Car Disinfectant Wipes, 30 Wipes Each, 3 Pack", 90.0),
        ("Antibacterial Wet Rags, 20 Sheets", 20.0),
        ("Family Pack 2 x (3 x 80 wipes)", 480.0),
        ("Microfiber Cloths 6 Pack", 0.0),
        ("Wipes", 0.0),
    ])


RELEVANCE = [
    ("glass cleaner", "Microfiber cloth for glass", False),
    ("glass cleaner", "Go Green Promo Surface Cleaner 750 ML + Glass Cleaner 650 ML", False),
    ("fabric freshener for furnitures", "Loyal Fabric Softener & Freshener for Laundry", False),
    ("hardwood floor cleaner", "Mr. Clean Multi-Purpose Floor Cleaner", False),
    ("wax and floor polish", "Pledge Floor Gloss, Polish and Wax", True),
    ("car surface disinfectant wet rags", "Lysol Disinfecting Wipes, Multi-Surface Lemon Scent",
     False),
    ("microfiber for vehicle cleaning", "Armor All Car Cleaning Microfiber Towel", True),
    ("waterless car wash", "Meguiar's Gold Class Car Wash Shampoo & Conditioner", False),
    ("glass cleaner", None, False),
]


def test_relevance(spark):
    frame = spark.createDataFrame(RELEVANCE, "q string, t string, e boolean")
    rows = frame.select("e", relevance.is_relevant(F.col("t"), F.col("q")).alias("got")).collect()
    assert [r.got for r in rows] == [r.e for r in rows]


def test_relevance_words_can_be_extended(spark):
    words = {**relevance.WORDS, "surface": [*relevance.WORDS["surface"], "bamboo"]}
    frame = spark.createDataFrame([("bamboo floor cleaner", "floor cleaner deluxe")], "q string, t string")
    default = relevance.is_relevant(F.col("t"), F.col("q"))
    extended = relevance.is_relevant(F.col("t"), F.col("q"), words=words)
    assert tuple(frame.select(default, extended).first()) == (True, False)


def test_prices(spark):
    check(spark, price.clean_price, [
        ("SAR 1,234.50", 1234.5), (" 12 ", 12.0), ("0.00", 0.0), ("nan", None), ("1.5d", None),
        ("1e3", 1000.0), ("free", None), (None, None), ("-5", -5.0),
    ])
    check(spark, price.after_sar, [("Now sar 1,299.00 only", "1299.00"), ("$5", None)])
    check(spark, price.two_decimals, [("SAR 1,045.50", "1045.50"), ("SAR 45", None)])
    check(spark, price.euro_price, [("€ 1,000.00", 4390.0), ("€2", 8.78), ("n/a", None)])
    frame = spark.createDataFrame(
        [("1,299.", "50"), ("45", None), (None, "50")], "t string, f string"
    )
    got = frame.select(price.whole_and_fraction(F.col("t"), F.col("f")).alias("p")).collect()
    assert [r.p for r in got] == ["1299.50", "45", None]
    frame = spark.createDataFrame(
        [("SAR 1295", "95"), ("300", None), ("95", "95"), ("x", None), ("12", "7")],
        "t string, f string",
    )
    got = frame.select(price.superscript_price(F.col("t"), F.col("f")).alias("p")).collect()
    assert [r.p for r in got] == ["12.95", "300.00", "95.95", None, "12.7"]


def test_text(spark):
    check(spark, text.base_keyword, [
        ("H2-Glass cleaner", "glass cleaner"), ("P2-Pet-specific odor", "pet-specific odor"),
        ("Soap ", "soap"),
    ])
    check(spark, text.search_mode, [
        ("C7-Microfiber for cars", "units"), ("H1-Soap", "volume"), ("Long BRUSH", "units"),
    ])
    check(spark, text.many_to_one_name, [('[3, "Home"]', "Home"), ("false", None), (None, None)])
    check(spark, text.product_code, [("[FP-1] Soap", "FP-1"), ("Soap", None), ("[] x", None)])
    check(spark, text.without_codes, [("[FP-1]  Soap [x] y", "Soap y")])
    check(spark, text.percent_encode, [("a b/c~*&é", "a%20b/c~%2A%26%C3%A9")])
    check(spark, text.channel, [("HOME", "B2C"), ("Hotels", "B2B"), (None, "B2B")])
    check(spark, lambda t: text.recode(t, text.UOM_CODES), [
        ("ml", "mL"), ("kg", "Unknown"), (None, "Unknown"),
    ])
    items = values(spark, text.modifier_items, ["spray; fine: Foam:x ;;GoGreen:y", None])
    assert [[tuple(m) for m in row] for row in items] == [
        [(None, "spray"), ("fine", "Foam:x"), ("gogreen", "y")], []
    ]

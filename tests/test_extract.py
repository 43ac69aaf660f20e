from pyspark.sql import functions as F

from pricelens import sites
from pricelens.operators import extract, offers

PAGE = "site string, search_mode string, search_keyword string, url string, html string"


def accepted(spark, rows):
    frame = spark.createDataFrame([(*r[:3], "u", r[3]) for r in rows], PAGE)
    raw = extract.raw_fields(frame, sites.PAGE_FIELDS)
    return offers.with_quantity(offers.page_facts(raw))


def one(spark, site, mode, keyword, html):
    row = accepted(spark, [(site, mode, keyword, html)]).first()
    return (row["product"], row.price_sar, row.company, row.total_quantity,
            row.unit_of_measurement, row.status)


def test_amazon(spark):
    html = """<span id="productTitle">  Floor Cleaner 750 ml </span>
      <tr class="po-brand"><td><span class="po-break-word"> Acme </span></td></tr>
      <span class="a-price-whole">1,299<span>.</span></span><span class="a-price-fraction">50</span>
      <table id="productDetails_techSpec_section_1">
        <tr><th>Item Volume</th><td>0.75 Liters</td></tr><tr><th>Net Volume</th><td>750 ml</td></tr>
        <tr><th>Weight</th><td>1 kg</td></tr></table>"""
    assert one(spark, "amazon", "volume", "floor cleaner", html) == (
        "Floor Cleaner 750 ml", "1299.50", "Acme", 750.0, "ml", "Confirmed by Title & Volume")
    wipes = '<span id="productTitle">Wipes, 75 Wipes, Pack of 3</span>'
    assert one(spark, "amazon", "units", "floor wipes", wipes) == (
        "Wipes, 75 Wipes, Pack of 3", "0.00", "Company not found", 225.0, "units", "Wipes Units")
    assert one(spark, "amazon", "units", "brush", '<span id="productTitle">Brush 2 pcs</span>')[3:] == (
        2.0, "units", "From Title")
    assert one(spark, "amazon", "volume", "x", '<span id="productTitle">Soap 1 L</span>')[3:] == (
        0.0, "units", "Not Found")


def test_mumzworld(spark):
    html = """<h1 class="ProductDetails_productName__lcVK_">Acme Care - Wipes 80s x 3</h1>
      <span class="Price_integer__3ngZQ">1,045</span>"""
    assert one(spark, "mumzworld", "units", "wipes", html)[:5] == (
        "Acme Care - Wipes 80s x 3", "1045", "Acme Care", 240.0, "units")


def test_saco(spark):
    html = """<h1 class="product-title big">Cloth 30-Piece</h1>
      <span class="discount-price"> 45 <sup> 95 </sup></span>
      <ul class="details-box"><li><label>Model:</label><span>X</span></li>
      <li><label>Brand:</label> <span> Tough </span></li></ul>"""
    assert one(spark, "saco", "units", "cloth", html)[:5] == (
        "Cloth 30-Piece", "45.95", "Tough", 30.0, "units")
    assert one(spark, "saco", "volume", "x", "<p>gone</p>")[:5] == (
        None, "0.00", "Brand not found", 0.0, "units")


def test_fine(spark):
    html = """<h1>Fine &amp; Co 750 ml</h1><div class="ecomz-product-price-style">was<b>SAR</b> 12.50</div>
      <div class="product-tr"><div class="product-cell">Pack</div><div class="product-cell">6</div></div>
      <div class="product-tr"><div class="product-cell">alone</div></div>"""
    assert one(spark, "fine", "volume", "soap", html)[:5] == (
        "Fine & Co 750 ml", "12.50", "Fine", 4500.0, "ml")


def test_officesupply(spark):
    html = """<div class="ut2-pb__title"><h1>Tissue 10 sheets</h1></div><div class="ty-price"><bdi>
      <span class="ty-price-num">SAR</span><span class="ty-price-num">1,2<b>34</b><sup>50</sup></span></bdi></div>"""
    assert one(spark, "officesupply", "units", "tissue", html)[:5] == (
        "Tissue 10 sheets", "1234.50", "Brand not found", 10.0, "units")


def test_aerosense_variations(spark):
    item = '<div class="js-form-item"><i class="package">{}</i><i class="variationprice">{}</i></div>'
    html = ('<h1><div class="field--name-title">Kit</div></h1>'
            '<div id="edit-purchased-entity-0-attributes-attribute-volume">'
            + item.format("5 l x 2", "€1,000.00") + item.format("sample", "€2.00") + "</div>")
    rows = accepted(spark, [("aerosense", "volume", "kit", html)]).collect()
    assert sorted((r["product"], r.price_sar, r.total_quantity, r.unit_of_measurement) for r in rows) == [
        ("Kit - 5 l x 2", "4390.0", 10000.0, "ml"), ("Kit - sample", "8.78", 0.0, "ml")]
    assert accepted(spark, [("aerosense", "units", "kit", "<h1></h1>")]).count() == 0


def test_broken_and_odd_html(spark):
    frame = spark.createDataFrame([
        ("*", "https://a.example/x/", "<a href=y>one<br>two</a></p><a>no</a><script>'<a href=z>'</script>"),
        ("*", "https://a.example", None), ("*", None, "<a href='/q'>t <!-- c -->u</a><a href=//b.example/>"),
    ], "site string, url string, html string")
    raw = extract.raw_fields(frame, {"*": {"link": "a"}})
    found = raw.select("url", "error", F.transform("nodes", lambda n: n["href"]).alias("h"),
                       F.transform("nodes", lambda n: F.array_join(n["parts"], "|")).alias("t")).collect()
    assert [tuple(r) for r in found] == [
        ("https://a.example/x/", None, ["https://a.example/x/y", None], ["one|two", "no"]),
        ("https://a.example", None, [], []),
        (None, None, ["/q", "//b.example/"], ["t|u", ""]),
    ]


def test_a_failing_page_is_a_row(spark):
    frame = spark.createDataFrame(
        [("*", "http://[bad", "<a href='x'>t</a>"), ("*", "http://ok.example", "<a href='x'>t</a>")],
        "site string, url string, html string")
    rows = extract.raw_fields(frame, {"*": {"link": "a"}}).collect()
    assert rows[0].error.startswith("ValueError") and rows[0].nodes == []
    assert rows[1].error is None and rows[1].nodes[0].href == "http://ok.example/x"


def test_listing_links(spark):
    html = ("<div class='card card-product'><a href='/skip'>x</a><a class='css-thumbnail' href='/1'>A</a></div>"
            "<div class='card'><a class='css-thumbnail' href='/2'>B</a></div>"
            "<div class='card-product card'><a class='css-thumbnail'>C</a></div>"
            "<div class='card-product card'><a class='css-thumbnail' href='/4'>D</a></div>")
    frame = spark.createDataFrame([("gogreen", "https://g.example/list", html)],
                                  "site string, url string, html string")
    links = extract.listing_links(extract.raw_fields(frame, sites.LISTING_FIELDS)).collect()
    assert [(r.rank, r.product_url, r.link_text) for r in links] == [
        (0, "https://g.example/1", "A"), (2, "https://g.example/4", "D")]


def test_reject_reasons(spark):
    rows = [("fine", "x", "5", 1.0), ("fine", "x", "n/a", 1.0), ("fine", "x", "0", 1.0), ("fine", None, "5", 1.0),
            ("amazon", "x", "0.00", 1.0), ("amazon", None, "5", 1.0), ("saco", "x", "5", 0.0),
            ("aerosense", "x", "5", None)]
    frame = spark.createDataFrame(rows, "site string, product string, price_sar string, total_quantity double")
    assert [r.reject_reason for r in offers.with_reject_reason(frame).collect()] == [
        None, "Invalid price format", "Invalid price", "Product name not found", None,
        "Product name not found", "Invalid quantity", None]

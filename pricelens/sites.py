"""What is known about each shop site. All of this is data; the rules are fixed values."""

from __future__ import annotations

# Sub-industry -> sites worth searching.
TARGETS = {
    "Home": ["amazon", "mumzworld", "saco"],
    "Automotive": ["amazon", "saco"],
    "Pets": ["amazon"],
    "Aviation": ["aerosense"],
    "Airports": ["fine"],
    "Restaurants": ["fine"],
    "Facilities management": ["fine", "gogreen", "officesupply"],
    "Faith": ["fine", "gogreen", "officesupply"],
    "Gyms": ["fine", "gogreen", "officesupply"],
    "Land Transportation": ["fine", "gogreen"],
    "Spas and salons": ["fine", "gogreen", "officesupply"],
    "Hotels": ["fine", "gogreen", "officesupply"],
    "Healthcare": ["fine", "saco"],
    "Industrial facilities": ["fine", "gogreen", "officesupply"],
}

# Base keywords a site has no goods for.
EXCLUSIONS = {
    "mumzworld": [
        "oven and grill cleaner",
        "shower and tub cleaner",
        "mold and mildew remover",
        "general sanitizer for vegetable and salad washing",
        "tile and laminate cleaner",
        "wax and floor polish",
        "carpet shampoo",
        "spot remover for carpets",
        "leather cleaner",
    ],
    "saco": [
        "microfiber for vehicle cleaning",
        "long brush for seating cleaning",
        "general sanitizer for vegetable and salad washing",
        "fabric refresher",
        "car surface disinfectant wet rags",
        "car water spot remover",
        "car bug and poop remover",
        "waterless car wash product",
        "car surface disinfectant",
        "car gum remover",
        "car air freshener",
        "broad-spectrum disinfectant for surfaces, mattress and touchpoints",
        "body wash gel",
        "liquid dish soap",
        "makeup brush cleanser",
        "high performance waterless carpet cleaner",
        "surface disinfectant wet rags",
        "restroom deodorizer",
        "degreaser for food service areas",
        "sewage odor control spray",
        "non-slip floor cleaner for safety",
        "floor degreaser for kitchen areas",
        "grease trap odor treatment",
        "stainless steel polish and cleaner for fixtures and fittings",
        "escalator cleaner",
        "escalator tread brightener",
        "epoxy cleaner for heavy-traffic parking lot area",
        "hvac system cleaner",
        "hvac system deodorizer",
        "fabric refresher for linen, towels, curtains, mattresses and upholstery",
        "hard floor polish",
        "streak-free glass cleaner for large window areas",
        "general hard floor cleaner",
        "heavy-duty toilet and urinal cleaner",
        "food-safe surface sanitizers",
    ],
}

# Sites searched only with a keyword of their own or a general modifier.
KEYWORD_REQUIRED = ["fine", "gogreen", "officesupply", "aerosense"]

# Accepted offers per site and keyword; a site not listed has no limit.
OFFER_LIMITS = {
    "amazon": 40, "mumzworld": 7, "saco": 8, "fine": 5, "gogreen": 5, "officesupply": 8,
}

BASE_URLS = {
    "amazon": "https://www.amazon.sa",
    "mumzworld": "https://www.mumzworld.com/sa-en/",
    "saco": "https://www.saco.sa/en/",
    "fine": "https://ksa.finestore.com/en",
    "gogreen": "https://gogreen.com.sa/",
    "officesupply": "https://officesupply.sa/en/",
    "aerosense": "https://www.aero-sense.com/en/online-shop/cabin-and-exterior-cleaning",
}

# Search address and how the keyword is written into it.
SEARCH_URLS = {
    "amazon": ("https://www.amazon.sa/s?k={}&language=en_AE", "plus"),
    "mumzworld": ("https://www.mumzworld.com/sa-en/search?q={}", "percent"),
    "saco": ("https://www.saco.sa/en/search/{}", "percent"),
    "fine": ("https://ksa.finestore.com/en/products?keyword={}", "percent"),
    "gogreen": ("https://gogreen.com.sa/products?search={}", "percent"),
    "officesupply": (
        "https://officesupply.sa/en/?match=all&subcats=Y&pcode_from_q=Y&pshort=Y&pfull=Y"
        "&pname=Y&pkeywords=Y&search_performed=Y&dispatch=products.search&q={}",
        "percent",
    ),
    "aerosense": (
        "https://www.aero-sense.com/en/online-shop/cabin-and-exterior-cleaning/{}", "slug",
    ),
}

# Company named on every page of a one-brand shop, and the value when none is found.
COMPANIES = {"fine": "Fine", "gogreen": "GoGreen", "aerosense": "AeroSense"}
COMPANY_UNKNOWN = {
    "amazon": "Company not found", "mumzworld": "Not found", "saco": "Brand not found",
    "officesupply": "Brand not found",
}

# Field -> selector, per site: tag, #id, .class, [attr=value], blanks for descendants.
PAGE_FIELDS = {
    "amazon": {
        "title": "span#productTitle",
        "brand_row": "tr.po-brand",
        "item_row": "tr.po-item_volume",
        "row_value": "span.po-break-word",
        "price_whole": "span.a-price-whole",
        "price_fraction": "span.a-price-fraction",
        "spec_row": "table#productDetails_techSpec_section_1 tr",
        "spec_label": "th",
        "spec_value": "td",
    },
    "mumzworld": {
        "title": "h1.ProductDetails_productName__lcVK_",
        "price": "span.Price_integer__3ngZQ",
    },
    "saco": {
        "title": "h1.product-title",
        "price": "span.discount-price",
        "spec_row": "ul.details-box li",
        "spec_label": "label",
        "spec_value": "span",
    },
    "fine": {
        "title": "span.mg-l-0.f-xs-18",
        "title_2": "div.ecomz-product-name-style",
        "title_3": "h1",
        "price": "div.ecomz-product-price-style",
        "spec_row": "div.product-tr",
        "spec_cell": "div.product-cell",
    },
    "gogreen": {"title": "h1.h5", "price": "span.js-product-price"},
    "officesupply": {
        "title": "div.ut2-pb__title h1",
        "price_box": ".ty-price bdi",
        "price_box_2": "h1 bdi",
        "price_number": "span.ty-price-num",
        "price_sup": "sup",
    },
    "aerosense": {
        "title": "h1 div.field--name-title",
        "variation": "#edit-purchased-entity-0-attributes-attribute-volume .js-form-item",
        "package": ".package",
        "price": ".variationprice",
    },
}

# Result lists: the box of one hit and the link inside it.
LISTING_FIELDS = {
    "amazon": {"card": "div[data-component-type=s-search-result]", "link": "a.a-link-normal"},
    "mumzworld": {
        "card": "div.ProductCard_productCard__kFgss", "link": "a.ProductCard_productName__Dz1Yx",
    },
    "saco": {"card": "div.product-inner-container", "link": "p.product-name a"},
    "fine": {"card": "div.listing-page a.display-flex", "link": "div.listing-page a.display-flex"},
    "gogreen": {"card": "div.card.card-product", "link": "a.css-thumbnail"},
    "officesupply": {"card": "div.ut2-gl__body", "link": "a.product_icon_lnk"},
}

# Any page: heading, title and links.
GENERIC_FIELDS = {"page_title": "title", "heading": "h1", "link": "a"}

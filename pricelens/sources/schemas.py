"""Schemas of the logical tables."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(), "double": T.DoubleType(), "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def _schema(names: list[str], kinds: list[str]) -> T.StructType:
    return T.StructType([T.StructField(n, _TYPES[k]) for n, k in zip(names, kinds, strict=True)])


# Column headers of the exchanged tables (fixed values).
CATALOG_HEADERS = [
    "create_date", "Product_ID", "Product_Name", "Label_Product_Name", "Presentation",
    "Volume_Liters", "Pack_quantity_Units", "Type_of_product", "Category",
    "Generic product type", "SubIndustry", "Industry", "Bottle", "Label", "Liquid",
    "Microfibers", "Plastic bag", "Labor", "Shipping", "Other costs", "Unit_cost_SAR",
]
MANUAL_OFFER_HEADERS = [
    "Date", "Channel", "Type of product", "Product category", "Sub industry", "Industry",
    "Generic product type", "Total quantity", "Unit of measurement [mL,g,units]",
    "Price per unit SAR", "Company",
]
INSTRUCTION_HEADERS = [
    "Type of product", "Sub industry", "Industry", "Generic product type", "Search Modifiers",
]

CATALOG_CSV = _schema(
    CATALOG_HEADERS,
    ["timestamp_ntz"] + ["string"] * 4 + ["double"] * 2 + ["string"] * 5 + ["double"] * 9,
)
MANUAL_OFFERS_CSV = _schema(
    MANUAL_OFFER_HEADERS, ["string"] * 7 + ["double", "string", "string", "string"]
)
INSTRUCTIONS_CSV = _schema(INSTRUCTION_HEADERS, ["string"] * 5)
MODIFIERS_CSV = _schema(["Type of product", "Search Modifiers"], ["string"] * 2)

CATALOG_NAMES = {
    "Product_ID": "product_id", "Product_Name": "product_name",
    "Label_Product_Name": "label_product_name", "Presentation": "presentation",
    "Volume_Liters": "volume_liters", "Pack_quantity_Units": "pack_quantity_units",
    "Type_of_product": "type_of_product", "Category": "category",
    "Generic product type": "generic_product_type", "SubIndustry": "subindustry",
    "Industry": "industry", "Bottle": "bottle_cost", "Label": "label_cost",
    "Liquid": "liquid_cost", "Microfibers": "microfibers_cost",
    "Plastic bag": "plastic_bag_cost", "Labor": "labor_cost", "Shipping": "shipping_cost",
    "Other costs": "other_costs", "Unit_cost_SAR": "unit_cost_sar",
}
MANUAL_OFFER_NAMES = {
    "Date": "date", "Channel": "channel", "Type of product": "type_of_product",
    "Product category": "product_category", "Sub industry": "subindustry",
    "Industry": "industry", "Generic product type": "generic_product_type",
    "Total quantity": "total_quantity", "Unit of measurement [mL,g,units]": "unit_of_measurement",
    "Price per unit SAR": "price_sar", "Company": "company",
}
INSTRUCTION_NAMES = {
    "Type of product": "type_of_product", "Sub industry": "subindustry",
    "Industry": "industry", "Generic product type": "generic_product_type",
    "Search Modifiers": "search_modifiers",
}

# Raw ERP records: links are JSON text, ``[id, "name"]`` or ``false``.
ERP_CATALOG_COLUMNS = [
    "create_date", "product_id", "product_name", "label_product_name", "presentation",
    "volume_liters", "pack_quantity_units", "type_of_product_id", "category",
    "generic_product_type", "subindustry_id", "industry_id", "bottle_cost", "label_cost",
    "liquid_cost", "microfibers_cost", "plastic_bag_cost", "labor_cost", "shipping_cost",
    "other_costs", "unit_cost_sar",
]
ERP_COMPETITOR_COLUMNS = [
    "date", "product_channel", "classification_id", "product_category", "subindustry_id",
    "industry_id", "generic_product_type", "total_quantity", "uom", "price_unit_sar", "company",
]

OFFERS = _schema(
    [
        "date", "industry", "subindustry", "type_of_product", "generic_product_type", "product",
        "price_sar", "company", "source", "url", "unit_of_measurement", "total_quantity",
        "channel",
    ],
    ["date"] + ["string"] * 10 + ["double", "string"],
)
CLEAN_COLUMNS = [
    "industry", "subindustry", "type_of_product", "generic_product_type", "price_sar",
    "company", "unit_of_measurement", "total_quantity", "channel",
]
TRAIN_VOLUME_COLUMNS = [
    "industry", "subindustry", "type_of_product", "generic_product_type", "price_sar",
    "company", "unit_of_measurement", "channel", "volume_liters", "price_per_liter",
    "approved_quote_price",
]
TRAIN_UNIT_COLUMNS = [
    "industry", "subindustry", "type_of_product", "generic_product_type", "price_sar",
    "company", "unit_of_measurement", "total_quantity", "channel", "price_per_item",
    "approved_quote_price",
]
REPORT_COLUMNS = [
    "product_id", "product_name", "product_type", "generic_product_type", "subindustry",
    "industry", "volume", "cost_per_unit", "predicted_price", "predicted_price_per_unit",
    "porcentaje_de_ganancia", "model_confidence", "market_min_found", "market_max_found",
    "competitors_count",
]
SUGGESTION_COLUMNS = [
    "product_id_str", "product_type", "generic_product_type", "subindustry", "industry",
    "volume_units", "production_cost", "suggested_price", "profit", "product_name",
    "predicted_price_per_unit", "model_confidence", "market_min_found", "market_max_found",
    "competitors_count",
]
_CLEAN_KINDS = ["string"] * 4 + ["double"] + ["string"] * 2 + ["double", "string"]
VOLUME_OFFERS = _schema([*CLEAN_COLUMNS, "volume_liters", "price_per_liter"], [*_CLEAN_KINDS, "double", "double"])
UNIT_OFFERS = _schema([*CLEAN_COLUMNS, "price_per_item"], [*_CLEAN_KINDS, "double"])
REPORT = _schema(REPORT_COLUMNS, ["string"] * 7 + ["double"] * 8)

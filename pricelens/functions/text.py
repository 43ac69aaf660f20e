"""Text helpers and the small categorical rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
B2C_SUBINDUSTRIES = ["home", "automotive", "pets"]
UNIT_MODE_WORDS = ["wipes", "rags", "microfiber", "brush"]
CHANNEL_CODES = {"b2b": "B2B", "retail": "B2C", "ecommerce": "B2C"}
UOM_CODES = {"ml": "mL", "g": "g", "units": "Units"}

_WHITESPACE = " \t\n\r\f\u000b\u00a0"
_NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"


def strip(text: Column) -> Column:
    """Remove leading and trailing whitespace of any kind."""
    return F.trim(text, F.lit(_WHITESPACE))


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """First match of a group, NULL when there is none."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def number(text: Column) -> Column:
    """Text to double; anything but a plain decimal number becomes NULL.

    The guard keeps out what a bare cast would accept ('NaN', '1.5d'): NaN
    would later compare as larger than every price.
    """
    cleaned = strip(text)
    return F.when(cleaned.rlike(_NUMBER), cleaned.try_cast("double"))


def many_to_one_name(json: Column) -> Column:
    """Display name of an ERP ``[id, "name"]`` link; ``false`` becomes NULL."""
    return F.get_json_object(json, "$[1]")


def recode(code: Column, mapping: dict[str, str], default: str = "Unknown") -> Column:
    pairs = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.coalesce(F.create_map(*pairs)[code], F.lit(default))


def channel(subindustry: Column) -> Column:
    """Sales channel of a sub-industry, compared in lower case."""
    return F.when(F.lower(subindustry).isin(B2C_SUBINDUSTRIES), "B2C").otherwise("B2B")


def product_code(description: Column) -> Column:
    """Content of the first ``[...]``."""
    return matched(description, r"\[(.*?)\]")


def without_codes(description: Column) -> Column:
    """Remove every ``[...]`` and the blanks after it."""
    return F.regexp_replace(description, r"\[.*?\]\s*", "")


def base_keyword(product_type: Column) -> Column:
    """``H2-Glass cleaner`` -> ``glass cleaner``; whole text if it has no dash."""
    lowered = F.lower(product_type)
    dash = F.instr(lowered, "-")
    return strip(
        F.when(dash > 0, F.substring(lowered, dash + 1, F.length(lowered))).otherwise(lowered)
    )


def search_mode(product_type: Column) -> Column:
    """'units' for countable goods, 'volume' for the rest."""
    words = "|".join(UNIT_MODE_WORDS)
    return F.when(F.lower(product_type).rlike(words), "units").otherwise("volume")


def modifier_items(modifiers: Column) -> Column:
    """Split ``a; site:b`` into array<struct<site, keyword>>; site is NULL for general items."""
    items = F.transform(F.split(F.coalesce(modifiers, F.lit("")), ";"), strip)
    parsed = F.transform(
        items,
        lambda item: F.struct(
            F.when(F.contains(item, F.lit(":")), F.lower(strip(F.substring_index(item, ":", 1))))
            .alias("site"),
            F.when(
                F.contains(item, F.lit(":")),
                strip(F.substring(item, F.instr(item, ":") + 1, F.length(item))),
            ).otherwise(item).alias("keyword"),
        ),
    )
    return F.filter(parsed, lambda m: m["site"].isNotNull() | (m["keyword"] != ""))


def percent_encode(text: Column) -> Column:
    """URL path/query quoting with %20 for blanks and '/' left as it is."""
    encoded = F.url_encode(text)
    for java_form, url_form in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%2F", "/")):
        encoded = F.replace(encoded, F.lit(java_form), F.lit(url_form))
    return encoded


def joined_text(nodes: Column, separator: str = "") -> Column:
    """Strip every text node, drop the empty ones, join the rest."""
    parts = F.filter(F.transform(nodes, strip), lambda t: t != "")
    return F.array_join(parts, separator)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` written into the plan, and evaluated, only once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))

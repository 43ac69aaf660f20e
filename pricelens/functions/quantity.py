"""Quantities read from titles, package texts and specification rows.

Parsers return ``struct<quantity double, unit string, normalized double>`` or
NULL. ``normalized`` is in ml, g or pieces.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, matched

# Patterns and factors that decide the results.
VOLUME = (
    r"(?i)(\d+\.?\d*)\s*"
    r"(millilit(?:er|re)s?|ml|lit(?:er|re)s?|ltr|l|kilograms?|kg|grams?|g"
    r"|fluid\s?ounces?|fl\s?oz|ounces?|oz)\b"
)
COUNT_PER = r"(?i)(\d+)\s*/\s*(?:box|pack|count)\b"
COUNT_OF_ITEMS = r"(?i)(\d+)\s*(?:wet\s*)?(?:wipes|count|sheets|sachets|pack|pcs|pieces|pc)\b"
COUNT_PACK_OF = r"(?i)\b(?:pack|box)\s*of\s*(\d+)"
COUNT_LEADING = r"(?i)^(\d+)\s*(?:sanitizing\s*)?(?:wipes|count|sheets|sachets|pack|pcs|pieces|pc)\b"
HYPHEN_COUNT = r"(?i)(\d+)\s*-\s*(?:piece|wipes|rags)\b"
CASE_VOLUME = (
    r"(?i)\((\d+\.?\d*)\s+.*?\s*x\s*(\d+\.?\d*)\s*"
    r"(ltr|ml|l|liter|litre|liters|litres|milliliters|millilitres)\b.*\)"
)
PCS_VOLUME = (
    r"(?i)(\d+)\s*Pcs\s*x\s*(\d+\.?\d*)\s*"
    r"(ltr|ml|l|liter|litre|liters|litres|milliliters|millilitres)\b"
)
TIMES = r"(?i)(\d+)\s*x"
PCS_PACKAGE = r"\((\d+)\s*pcs\)"
PACK_TIMES = r"(\d+)-pack\s*x\s*(\d+)"
PACKAGE_VOLUME = r"(?i)(\d+[.,]?\d*)\s*(ml|l)"
PACKAGE_TIMES = r"(?i)x\s*(\d+)"
LISTING_COUNT = r"(?i)(\d+)\s*(?:wipes|count|sheets|sachets|pack|pcs|pieces|pc|s)\b"
LISTING_MULTIPLIER = r"(?i)(?:pack of|x|of)\s*(\d+)"
SPEC_SIZE_LABELS = [
    "number of sheets", "number of wipes", "number of pieces",
    "volume", "capacity", "content", "size",
]
SPEC_COUNT_LABELS = ["number of sheets", "number of wipes", "number of pieces", "count", "pcs"]
SPEC_VOLUME_VALUE = r"(?i)\d+\s*(?:ml|l|ltr|liter|liters|gallons?|fl\s?oz)\b"
TITLE_TIMES = r"(?i)[x×]\s*(\d+)\b"
TITLE_CARTON = r"(?i)\(carton of \d+x(\d+)\)"
TITLE_ITEMS = r"(?i)(\d+)\s+(?:bottles?|pieces?|units?|pcs?|pack)"
WIPES_WORDS = r"(?i)\b(?:wipes?|rags|sheets)\b"
WIPES_NESTED = r"(?i)\d+\s*x\s*\(\s*\d+\s*x\s*\d+[^)]*\)"
WIPES_BASE = r"(?i)(\d+)\s*(?:wet\s*)?(?:wipes?|rags|sheets|count)\b"
WIPES_PACKS = r"(?i)(?:pack\s+of\s+(\d+)|(\d+)[\s-]*pack\b|(\d+)\s*x\b)"
ML_PER_FL_OZ = 29.5735
SPEC_MULTIPLIER_RANGE = (2, 50)
AGREEMENT_TOLERANCE = 1.0

QUANTITY_TYPE = "struct<quantity:double,unit:string,normalized:double>"


def _quantity(quantity: Column, unit: Column, normalized: Column) -> Column:
    return F.struct(
        quantity.alias("quantity"), unit.alias("unit"), normalized.alias("normalized")
    )


def _pieces(count: Column) -> Column:
    return let(count, lambda n: F.when(n.isNotNull(), _quantity(n, F.lit("units"), n)))


def _times(found: Column, factor: Column) -> Column:
    """A parsed quantity, if any, multiplied."""
    both = F.struct(found.alias("q"), factor.alias("f"))
    return let(
        both,
        lambda x: F.when(
            x["q"].isNotNull(),
            _quantity(
                x["q"]["quantity"] * x["f"], x["q"]["unit"], x["q"]["normalized"] * x["f"]
            ),
        ),
    )


def _to_double(text: Column) -> Column:
    return text.try_cast("double")


def _number_at(text: Column, pattern: str, group: int = 1) -> Column:
    return _to_double(matched(text, pattern, group))


def _unit_label(word: Column) -> Column:
    """Canonical unit of a matched unit word; kilo is tested before gram."""
    return let(
        F.lower(word),
        lambda w: F.when(w.startswith("ml") | w.startswith("milli"), "ml")
        .when(w.startswith("l"), "L")
        .when(w.startswith("k"), "kg")
        .when(w.startswith("g"), "g")
        .when(w.isNotNull(), "fl oz"),
    )


def _unit_factor(label: Column) -> Column:
    return (
        F.when(label.isin("L", "kg"), 1000.0)
        .when(label == "fl oz", ML_PER_FL_OZ)
        .otherwise(1.0)
    )


def _measured(amount: Column, word: Column) -> Column:
    """Amount and unit word to a quantity, NULL without an amount."""
    found = F.struct(amount.alias("amount"), _unit_label(word).alias("unit"))
    return let(
        found,
        lambda f: F.when(
            f["amount"].isNotNull(),
            _quantity(f["amount"], f["unit"], f["amount"] * _unit_factor(f["unit"])),
        ),
    )


def volume(text: Column) -> Column:
    """First ``number unit`` of volume or weight."""
    return _measured(_number_at(text, VOLUME, 1), matched(text, VOLUME, 2))


def count(text: Column) -> Column:
    """Piece count; the first of four ordered patterns wins."""
    patterns = (COUNT_PER, COUNT_OF_ITEMS, COUNT_PACK_OF, COUNT_LEADING)
    return _pieces(F.coalesce(*[_number_at(text, p) for p in patterns]))


def hyphen_count(text: Column) -> Column:
    """``30-piece`` style counts."""
    return _pieces(_number_at(text, HYPHEN_COUNT))


def hyphen_or_plain_count(text: Column) -> Column:
    return F.coalesce(hyphen_count(text), count(text))


def _multiplied(text: Column, pattern: str) -> Column:
    total = _number_at(text, pattern, 1) * _number_at(text, pattern, 2)
    return _measured(total, matched(text, pattern, 3))


def volume_with_multiplier(text: Column) -> Column:
    """``(12 bottles x 1 L)``, then ``12 Pcs x 1 L``, then a volume times the first ``N x``."""
    times = F.coalesce(_number_at(text, TIMES), F.lit(1.0))
    return F.coalesce(
        _multiplied(text, CASE_VOLUME), _multiplied(text, PCS_VOLUME), _times(volume(text), times)
    )


def package_units(text: Column) -> Column:
    """``(50 pcs)`` or ``6-pack x 12``; the match is case-sensitive."""
    return F.coalesce(
        _number_at(text, PCS_PACKAGE),
        _number_at(text, PACK_TIMES, 1) * _number_at(text, PACK_TIMES, 2),
    )


def package_volume_ml(text: Column) -> Column:
    """Package volume in ml; comma or dot decimals, times ``x N``; 0 when unknown."""
    amount = _to_double(F.replace(matched(text, PACKAGE_VOLUME, 1), F.lit(","), F.lit(".")))
    factor = F.when(F.lower(matched(text, PACKAGE_VOLUME, 2)) == "l", 1000.0).otherwise(1.0)
    times = F.coalesce(_number_at(text, PACKAGE_TIMES), F.lit(1.0))
    return F.coalesce(amount * factor * times, F.lit(0.0))


def listing_count(text: Column) -> Column:
    """Count that also accepts a bare 's' suffix (``80s``)."""
    return _pieces(_number_at(text, LISTING_COUNT))


def listing_multiplier(text: Column) -> Column:
    return F.coalesce(_number_at(text, LISTING_MULTIPLIER), F.lit(1.0))


def listing_quantity(text: Column, mode: Column) -> Column:
    """Count or volume of a listing title times its pack multiplier."""
    base = F.when(mode == "units", listing_count(text)).otherwise(volume(text))
    return _times(base, listing_multiplier(text))


def _has_any(text: Column, words: list[str]) -> Column:
    return text.rlike("|".join(words))


def _usable_rows(rows: Column) -> Column:
    return F.filter(rows, lambda r: (r["label"] != "") & (r["value"] != ""))


def spec_volume(rows: Column) -> Column:
    """First volume among spec rows whose label contains an 'l'."""
    parsed = F.transform(
        F.filter(_usable_rows(rows), lambda r: F.contains(F.lower(r["label"]), F.lit("l"))),
        lambda r: volume(r["value"]),
    )
    return F.get(F.filter(parsed, lambda q: q.isNotNull()), F.lit(0))


def spec_multiplier(rows: Column) -> Column:
    """Last number within range in a row about neither size nor volume, else 1."""
    low, high = SPEC_MULTIPLIER_RANGE
    numbers = F.transform(
        F.filter(
            _usable_rows(rows),
            lambda r: ~_has_any(F.lower(r["label"]), SPEC_SIZE_LABELS)
            & ~r["value"].rlike(SPEC_VOLUME_VALUE),
        ),
        lambda r: _number_at(r["value"], r"\b(\d+)\b"),
    )
    fitting = F.filter(numbers, lambda n: n.between(low, high))
    return F.coalesce(F.try_element_at(fitting, F.lit(-1)), F.lit(1.0))


def spec_count(rows: Column, title: Column) -> Column:
    """Count from the first countable spec row, else from the title."""
    counts = F.transform(
        F.filter(rows, lambda r: _has_any(F.lower(r["label"]), SPEC_COUNT_LABELS)),
        lambda r: _number_at(r["value"], r"(\d+)"),
    )
    first = F.get(F.filter(counts, lambda n: n.isNotNull()), F.lit(0))
    return F.coalesce(_pieces(first), count(title))


def title_multiplier(title: Column) -> Column:
    return F.coalesce(
        *[_number_at(title, p) for p in (TITLE_TIMES, TITLE_CARTON, TITLE_ITEMS)], F.lit(1.0)
    )


def spec_quantity(rows: Column, title: Column, mode: Column) -> Column:
    """Spec or title quantity times the larger of the two multipliers."""
    found = F.when(mode == "units", spec_count(rows, title)).otherwise(
        F.coalesce(spec_volume(rows), volume(title), count(title))
    )
    return _times(found, F.greatest(spec_multiplier(rows), title_multiplier(title)))


def agreed_volume(title: Column, spec: Column, item: Column) -> Column:
    """Accept a volume only when two of three texts agree on it.

    Returns ``struct<quantity, unit, status>``; the first agreeing pair in the
    order title, volume, item volume decides.
    """
    names = ["Title", "Volume", "Item_volume"]
    volumes = F.struct(*[volume(t).alias(n) for t, n in zip((title, spec, item), names)])

    def decide(v: Column) -> Column:
        result = F
        for left, right in ((0, 1), (0, 2), (1, 2)):
            a, b = v[names[left]], v[names[right]]
            agrees = F.abs(a["normalized"] - b["normalized"]) < AGREEMENT_TOLERANCE
            status = F.lit(f"Confirmed by {names[left]} & {names[right]}")
            result = result.when(agrees, F.struct(
                a["quantity"].alias("quantity"), a["unit"].alias("unit"), status.alias("status")
            ))
        return result.otherwise(F.struct(
            F.lit(0.0).alias("quantity"), F.lit("units").alias("unit"),
            F.lit("Not Found").alias("status"),
        ))

    return let(volumes, decide)


def _product(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(1.0), lambda acc, n: acc * n)


def _doubles(texts: Column) -> Column:
    return F.transform(F.filter(texts, lambda t: t != ""), _to_double)


def wipes_total(title: Column) -> Column:
    """Wipes in a title times all its pack sizes; 0 when it is not about wipes."""
    nested = matched(title, WIPES_NESTED, 0)
    nested_total = _product(_doubles(F.regexp_extract_all(nested, F.lit(r"(\d+)"), F.lit(1))))
    packs = [
        _doubles(F.regexp_extract_all(title, F.lit(WIPES_PACKS), F.lit(g))) for g in (1, 2, 3)
    ]
    base = _number_at(title, WIPES_BASE)
    total = F.when(nested.isNotNull(), nested_total).otherwise(
        base * _product(F.concat(*packs))
    )
    return F.when(title.rlike(WIPES_WORDS), F.coalesce(total, F.lit(0.0))).otherwise(F.lit(0.0))

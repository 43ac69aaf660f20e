"""The registered queries in DuckDB SQL, written independently of the Spark code."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

SUB = """CASE {k} % 6 WHEN 0 THEN 'Home' WHEN 1 THEN 'Automotive' WHEN 2 THEN 'Pets'
 WHEN 3 THEN 'Hotels' WHEN 4 THEN 'Gyms' ELSE 'Healthcare' END"""


def sub(key: str) -> str:
    return SUB.format(k=key)


def round2(value: str) -> str:
    """Half-up rounding of the shortest decimal form."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38,18)), 2) AS DOUBLE)"


CHANNEL = "CASE WHEN lower(subindustry) IN ('home','automotive','pets') THEN 'B2C' ELSE 'B2B' END"

CATALOG = f"""catalog AS (
 SELECT 'FP-' || p_partkey AS product_id, p_name AS product_name,
  p_brand || '-' || p_type AS type_of_product, p_type AS generic_product_type,
  {sub('p_partkey')} AS subindustry, 'Industry ' || (p_size % 5) AS industry,
  CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS DOUBLE) / 10 END AS volume_liters,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) END AS pack_quantity_units,
  p_retailprice / 100 AS unit_cost_sar, p_partkey AS seq
 FROM part)"""

WEB = f"""web AS (
 SELECT 'Industry ' || (p_size % 5) AS industry, {sub('p_partkey')} AS subindustry,
  p_brand || '-' || p_type AS type_of_product, p_type AS generic_product_type,
  CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS price_sar, s_name AS company,
  CASE p_size % 6 WHEN 0 THEN 'ml' WHEN 1 THEN 'l' WHEN 2 THEN 'fl oz' WHEN 3 THEN 'g'
   WHEN 4 THEN 'units' END AS unit_of_measurement,
  l_quantity AS total_quantity,
  CASE WHEN p_partkey % 6 < 3 THEN 'B2C' ELSE 'B2B' END AS channel
 FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey)"""

VOLUME = WEB + """,
vol0 AS (
 SELECT *, CASE unit_of_measurement WHEN 'ml' THEN total_quantity / 1000
   WHEN 'fl oz' THEN total_quantity * 0.0295735e0 WHEN 'l' THEN total_quantity END AS volume_liters
 FROM web WHERE unit_of_measurement IN ('ml', 'l', 'fl oz')),
vol AS (
 SELECT *, price_sar / volume_liters AS price_per_liter FROM vol0
 WHERE price_sar / volume_liters IS NOT NULL)"""

UNIT = """unit AS (
 SELECT *, price_sar / total_quantity AS price_per_item FROM web
 WHERE (unit_of_measurement IS NULL OR unit_of_measurement = 'units') AND total_quantity > 0
  AND price_sar IS NOT NULL)"""


def trimmed(source: str, value: str) -> str:
    return f"""{source}_trim AS (
 SELECT t.* FROM {source} t JOIN (
  SELECT type_of_product, quantile_cont({value}, 0.1) AS lo, quantile_cont({value}, 0.9) AS hi
  FROM {source} GROUP BY type_of_product) b USING (type_of_product)
 WHERE t.{value} BETWEEN b.lo AND b.hi)"""


def stats(source: str, value: str) -> str:
    return f"""SELECT type_of_product, min({value}) AS market_min, max({value}) AS market_max,
 count({value}) AS competitor_count FROM {source} GROUP BY type_of_product"""


TRIM_VOLUME = f"WITH {VOLUME}, {trimmed('vol', 'price_per_liter')}"
TRIM_UNIT = f"WITH {WEB}, {UNIT}, {trimmed('unit', 'price_per_item')}"

ORACLE["market_stats"] = f"{TRIM_VOLUME} {stats('vol_trim', 'price_per_liter')}"
ORACLE["market_stats_units"] = f"{TRIM_UNIT} {stats('unit_trim', 'price_per_item')}"
ORACLE["percentile_bounds"] = f"""WITH {VOLUME}
SELECT type_of_product, round(quantile_cont(price_per_liter, 0.1), 4) AS lower_bound,
 round(quantile_cont(price_per_liter, 0.9), 4) AS upper_bound FROM vol GROUP BY type_of_product"""
ORACLE["outlier_trim"] = f"""{TRIM_UNIT}
SELECT type_of_product, company, price_sar, total_quantity, price_per_item FROM unit_trim"""
ORACLE["known_types"] = f"""WITH {VOLUME}, {UNIT}
SELECT type_of_product FROM vol UNION SELECT type_of_product FROM unit"""

LINK_GONE = "o_orderkey % 9 = 0"
MANUAL = f"""manual AS (
 SELECT strftime(o_orderdate, '%d/%m/%Y') AS date,
  CASE o_orderkey % 5 WHEN 0 THEN 'B2B' WHEN 1 THEN 'B2C' WHEN 2 THEN 'B2C' ELSE 'Unknown' END
   AS channel,
  CASE WHEN NOT {LINK_GONE} THEN 'Brand#' || (o_orderkey % 25 + 1) || '-PROMO' END
   AS type_of_product,
  'Cleaning' AS product_category,
  CASE WHEN NOT {LINK_GONE} THEN {sub('o_orderkey')} END AS subindustry,
  CASE WHEN NOT {LINK_GONE} THEN 'Industry ' || (o_orderkey % 5) END AS industry,
  'PROMO' AS generic_product_type, CAST(o_custkey % 50 AS DOUBLE) AS total_quantity,
  CASE o_orderkey % 7 WHEN 0 THEN 'mL' WHEN 1 THEN 'g' WHEN 2 THEN 'Units' WHEN 3 THEN 'Unknown'
   WHEN 4 THEN 'Unknown' WHEN 5 THEN 'mL' ELSE 'Units' END AS unit_of_measurement,
  o_totalprice, o_orderpriority AS company
 FROM orders)"""

ORACLE["clean_offers"] = f"""WITH {WEB}, {MANUAL}
SELECT * FROM web UNION ALL
SELECT industry, subindustry, type_of_product, generic_product_type, o_totalprice, company,
 lower(unit_of_measurement), total_quantity, channel FROM manual"""
ORACLE["volume_offers"] = f"WITH {VOLUME} SELECT * FROM vol"
ORACLE["unit_price_items"] = f"WITH {WEB}, {UNIT} SELECT * FROM unit"
ORACLE["route_counts"] = f"""WITH {WEB}
SELECT CASE WHEN unit_of_measurement = 'g' THEN 'excluded_weight'
 WHEN unit_of_measurement IN ('ml', 'l', 'fl oz') THEN 'volume' ELSE 'unit' END AS path,
 count(*) AS offers FROM web GROUP BY 1"""
ORACLE["clean_price"] = """
SELECT l_orderkey, l_linenumber, CASE (l_linenumber + l_suppkey) % 7
 WHEN 3 THEN NULL WHEN 4 THEN NULL WHEN 6 THEN NULL WHEN 5 THEN floor(l_extendedprice)
 ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) END AS price FROM lineitem"""

COSTS = ", ".join(
    f"p_retailprice / {divisor} AS {name}"
    for name, divisor in (
        ("bottle_cost", 800), ("label_cost", 900), ("liquid_cost", 400), ("microfibers_cost", 1600),
        ("plastic_bag_cost", 3200), ("labor_cost", 500), ("shipping_cost", 600),
        ("other_costs", 1200), ("unit_cost_sar", 100),
    )
)
ORACLE["catalog_scan"] = f"""
SELECT TIMESTAMP '2025-01-15 08:30:00' AS create_date, 'FP-' || p_partkey AS product_id,
 p_name AS product_name, upper(p_name) AS label_product_name, 'Bottle' AS presentation,
 CASE WHEN p_partkey % 3 <> 0 THEN CAST(p_size AS DOUBLE) / 10 END AS volume_liters,
 CASE WHEN p_partkey % 3 = 0 THEN CAST(p_size AS DOUBLE) END AS pack_quantity_units,
 p_brand || '-' || p_type AS type_of_product, 'Cleaning' AS category,
 p_type AS generic_product_type, {sub('p_partkey')} AS subindustry,
 'Industry ' || (p_size % 5) AS industry, {COSTS}
FROM part
WHERE p_size % 10 <> 0 AND p_partkey % 17 <> 0 AND p_partkey % 13 <> 0 AND p_partkey % 19 <> 0"""
ORACLE["manual_offers"] = f"""WITH {MANUAL}
SELECT * EXCLUDE (o_totalprice), CAST(o_totalprice AS VARCHAR) AS price_sar FROM manual"""
ORACLE["m2o_flatten"] = f"""
SELECT 'FP-' || p_partkey AS product_id, CASE WHEN p_partkey % 17 = 0 THEN NULL
 WHEN p_partkey % 13 = 0 THEN 'F12-Other consumables for FM'
 ELSE p_brand || '-' || p_type END AS type_of_product,
 CASE WHEN p_partkey % 19 = 0 THEN 'Maritime' ELSE {sub('p_partkey')} END AS subindustry
FROM part"""
ORACLE["recode"] = f"""WITH {MANUAL}
SELECT channel, unit_of_measurement AS unit, count(*) AS offers FROM manual GROUP BY 1, 2"""

QUOTES = """quotes AS (
 SELECT 'FP-' || l_partkey AS product_id, 'line ' || l_linenumber AS description,
  l_extendedprice / l_quantity AS approved_quote_price, l_orderkey * 8 + l_linenumber AS seq
 FROM lineitem JOIN orders ON l_orderkey = o_orderkey
 WHERE o_orderstatus = 'F' AND year(o_orderdate) = 1997 AND l_quantity > 0
  AND l_extendedprice > 0)"""
LATEST = """latest AS (
 SELECT product_id, approved_quote_price FROM quotes QUALIFY row_number() OVER (
  PARTITION BY product_id ORDER BY seq DESC, approved_quote_price DESC) = 1)"""
ORACLE["quote_prices"] = f"WITH {QUOTES} SELECT * FROM quotes"
ORACLE["new_products"] = """SELECT o_orderkey AS product_id, o_orderdate AS create_date
FROM orders WHERE o_orderdate > TIMESTAMP '2000-06-01 12:30:00'"""
ORACLE["latest_quote"] = f"""WITH {CATALOG}, {QUOTES}, {LATEST}
SELECT product_id, type_of_product, subindustry, {CHANNEL} AS channel, 'Own brand' AS company,
 coalesce(approved_quote_price, 0) AS approved_quote_price
FROM catalog LEFT JOIN latest USING (product_id)"""
ORACLE["predictable_products"] = f"""WITH {VOLUME}, {UNIT}, {CATALOG}
SELECT product_id, type_of_product FROM catalog
WHERE (seq % 7 = 0 OR seq % 11 <> 0) AND type_of_product IN (
 SELECT type_of_product FROM vol UNION SELECT type_of_product FROM unit)"""

OWN = f"""own AS (
 SELECT c.*, approved_quote_price, 'Own brand' AS company, {CHANNEL} AS channel
 FROM quotes JOIN catalog c USING (product_id))"""
ORACLE["training_volume"] = f"""{TRIM_VOLUME}, {CATALOG}, {QUOTES}, {OWN}
SELECT industry, subindustry, type_of_product, generic_product_type, price_sar, company,
 unit_of_measurement, channel, volume_liters, price_per_liter, 0.0e0 AS approved_quote_price
FROM vol_trim UNION ALL
SELECT industry, subindustry, type_of_product, generic_product_type, approved_quote_price, company,
 CASE WHEN volume_liters < 1 THEN 'ml' ELSE 'l' END, channel, volume_liters,
 approved_quote_price / volume_liters, approved_quote_price FROM own WHERE volume_liters > 0"""
ORACLE["training_units"] = f"""{TRIM_UNIT}, {CATALOG}, {QUOTES}, {OWN}
SELECT industry, subindustry, type_of_product, generic_product_type, price_sar, company,
 unit_of_measurement, total_quantity, channel, price_per_item, 0.0e0 AS approved_quote_price
FROM unit_trim UNION ALL
SELECT industry, subindustry, type_of_product, generic_product_type, approved_quote_price, company,
 'units', pack_quantity_units, channel, approved_quote_price / pack_quantity_units,
 approved_quote_price FROM own WHERE pack_quantity_units > 0"""

REPORT = f"""{CATALOG},
given AS (
 SELECT * REPLACE (CASE WHEN seq % 23 <> 0 THEN volume_liters END AS volume_liters,
   CASE WHEN seq % 31 <> 0 THEN pack_quantity_units END AS pack_quantity_units,
   CASE WHEN seq % 37 = 0 THEN 0 ELSE unit_cost_sar END AS unit_cost_sar,
   CASE WHEN seq % 41 = 0 THEN 'Z9-Unknown' ELSE type_of_product END AS type_of_product),
  unit_cost_sar * (seq % 5) / 4 AS unit_price, CAST(seq % 100 AS DOUBLE) AS confidence
 FROM catalog),
vs AS ({stats('vol', 'price_per_liter')}),
us AS ({stats('unit', 'price_per_item')}),
priced AS (
 SELECT g.*,
  coalesce(volume_liters, pack_quantity_units) AS size,
  CASE WHEN volume_liters > 0 THEN vs.market_min ELSE us.market_min END AS market_min,
  CASE WHEN volume_liters > 0 THEN vs.market_max ELSE us.market_max END AS market_max,
  CASE WHEN volume_liters > 0 THEN vs.competitor_count ELSE us.competitor_count END AS offers,
  greatest(coalesce(unit_price * coalesce(volume_liters, pack_quantity_units), 0),
   unit_cost_sar * 1.3e0) AS final_price
 FROM given g LEFT JOIN vs USING (type_of_product) LEFT JOIN us USING (type_of_product)),
report AS (
 SELECT product_id, product_name, type_of_product AS product_type, generic_product_type,
  subindustry, industry,
  CASE WHEN volume_liters > 0 THEN CAST(volume_liters AS VARCHAR) || ' L'
   ELSE CAST(CAST(pack_quantity_units AS BIGINT) AS VARCHAR) || ' units' END AS volume,
  CAST(unit_cost_sar AS DOUBLE) AS cost_per_unit,
  {round2('final_price')} AS predicted_price,
  CASE WHEN size IS NULL THEN 0 ELSE {round2('unit_price')} END AS predicted_price_per_unit,
  CASE WHEN unit_cost_sar > 0
   THEN {round2('(final_price - unit_cost_sar) / unit_cost_sar * 100')} ELSE 0 END
   AS porcentaje_de_ganancia,
  CASE WHEN size IS NULL THEN 0 ELSE confidence END AS model_confidence,
  {round2('coalesce(market_min * size, 0)')} AS market_min_found,
  {round2('coalesce(market_max * size, 0)')} AS market_max_found,
  CAST(CASE WHEN size IS NULL THEN 0 ELSE coalesce(offers, 0) END AS INTEGER) AS competitors_count
 FROM priced)"""
REPORT_WITH = f"WITH {VOLUME}, {UNIT}, {REPORT}"
ORACLE["price_guardrails"] = f"{REPORT_WITH} SELECT * FROM report"
ORACLE["loss_products"] = f"""{REPORT_WITH}
SELECT count(*) FILTER (WHERE predicted_price <= cost_per_unit) AS loss_products,
 count(*) AS products FROM report"""
ORACLE["upload_records"] = f"""{REPORT_WITH}
SELECT product_id AS product_id_str, product_type, generic_product_type, subindustry, industry,
 CAST(split_part(volume, ' ', 1) AS DOUBLE) AS volume_units, cost_per_unit AS production_cost,
 predicted_price AS suggested_price, porcentaje_de_ganancia AS profit, product_name,
 predicted_price_per_unit, model_confidence, market_min_found, market_max_found,
 competitors_count, CASE WHEN volume IS NULL THEN 'size is not a number' END AS reject_reason
FROM report"""
NUMBER = "CAST(substr(product_id, 4) AS BIGINT)"
ORACLE["publish_partial"] = f"""{REPORT_WITH}
SELECT product_id AS product_id_str, predicted_price AS suggested_price,
 CASE WHEN {NUMBER} % 2 = 0 THEN TIMESTAMP '2025-01-01' ELSE TIMESTAMP '2025-01-02' END
  AS create_date,
 CASE WHEN {NUMBER} % 2 = 0 THEN 'r1' ELSE 'r2' END AS run_id
FROM report WHERE volume IS NOT NULL"""
ORACLE["publish_full"] = f"""{REPORT_WITH}
SELECT 'current' AS part, product_id AS product_id_str, predicted_price AS suggested_price,
 TIMESTAMP '2025-01-03' AS created FROM report WHERE volume IS NOT NULL UNION ALL
SELECT 'history', product_id, predicted_price,
 CASE WHEN {NUMBER} % 2 = 0 THEN TIMESTAMP '2025-01-01' ELSE TIMESTAMP '2025-01-02' END
FROM report WHERE volume IS NOT NULL"""

KIND = """CASE {k} % 10 WHEN 0 THEN 'Glass cleaner' WHEN 1 THEN 'Leather cleaner'
 WHEN 2 THEN 'Fabric refresher' WHEN 3 THEN 'Disinfectant wipes' WHEN 4 THEN 'Microfiber cloth'
 WHEN 5 THEN 'Car air freshener' WHEN 6 THEN 'Carpet shampoo' WHEN 7 THEN 'Body wash gel'
 WHEN 8 THEN 'Long brush' END""".format(k="p_partkey")
PLAN_CATALOG = f"""plan_catalog AS (
 SELECT coalesce(p_brand || '-' || {KIND}, 'Toilet cleaner') AS type_of_product,
  CASE WHEN p_partkey % 29 = 0 THEN 'Aviation' WHEN p_partkey % 31 = 0 THEN 'Shipyards'
   ELSE {sub('p_partkey')} END AS subindustry,
  'Industry ' || (p_size % 5) AS industry, p_type AS generic_product_type, p_partkey AS seq,
  CAST(substr(p_brand, 7) AS INTEGER) % 6 AS rule, p_partkey % 10 < 9 AS branded
 FROM part)"""
INSTRUCTIONS = f"""{PLAN_CATALOG},
instructions AS (
 SELECT type_of_product, subindustry, industry, generic_product_type, min(seq) AS seq,
  CASE WHEN NOT any_value(branded) THEN -1 ELSE any_value(rule) END AS rule
 FROM plan_catalog GROUP BY 1, 2, 3, 4)"""
ORACLE["instruction_list"] = f"""WITH {INSTRUCTIONS}
SELECT type_of_product, subindustry, industry, generic_product_type, seq,
 CASE rule WHEN 1 THEN 'fine:Foam ; gogreen:foam;GoGreen : glass/cleaner' WHEN 2 THEN 'spray'
  WHEN 3 THEN 'officesupply: wood ; heavy duty' WHEN 4 THEN ' aerosense:Clean Kit;fine:Kit~1*'
  ELSE '' END AS search_modifiers
FROM instructions"""
SEARCH = f"""{INSTRUCTIONS},
site_of(subindustry, site) AS (VALUES
 ('Home', 'amazon'), ('Home', 'mumzworld'), ('Home', 'saco'), ('Automotive', 'amazon'),
 ('Automotive', 'saco'), ('Pets', 'amazon'), ('Aviation', 'aerosense'), ('Hotels', 'fine'),
 ('Hotels', 'gogreen'), ('Hotels', 'officesupply'), ('Gyms', 'fine'), ('Gyms', 'gogreen'),
 ('Gyms', 'officesupply'), ('Healthcare', 'fine'), ('Healthcare', 'saco')),
own_word(rule, site, word) AS (VALUES
 (1, 'fine', 'Foam'), (1, 'gogreen', 'foam'), (1, 'gogreen', 'glass/cleaner'),
 (3, 'officesupply', 'wood'), (4, 'aerosense', 'Clean Kit'), (4, 'fine', 'Kit~1*')),
general_word(rule, word) AS (VALUES (2, 'spray'), (3, 'heavy duty')),
plan0 AS (
 SELECT i.*, site, w.word AS own, g.word AS general,
  lower(CASE WHEN contains(type_of_product, '-')
   THEN regexp_extract(type_of_product, '^[^-]*-(.*)$', 1) ELSE type_of_product END) AS base_keyword
 FROM instructions i JOIN site_of USING (subindustry)
 LEFT JOIN own_word w USING (rule, site) LEFT JOIN general_word g USING (rule)),
plan AS (
 SELECT type_of_product, subindustry, industry, generic_product_type, base_keyword,
  CASE WHEN regexp_matches(lower(type_of_product), 'wipes|rags|microfiber|brush') THEN 'units'
   ELSE 'volume' END AS search_mode,
  {CHANNEL} AS channel, site,
  coalesce(own, base_keyword || coalesce(' ' || general, '')) AS search_keyword
 FROM plan0
 WHERE NOT (site = 'mumzworld' AND base_keyword IN ('carpet shampoo', 'leather cleaner'))
  AND NOT (site = 'saco' AND base_keyword IN (
   'fabric refresher', 'car air freshener', 'body wash gel'))
  AND (site IN ('amazon', 'mumzworld', 'saco') OR own IS NOT NULL OR general IS NOT NULL))"""
ORACLE["search_plan"] = f"WITH {SEARCH} SELECT * FROM plan"
ORACLE["search_url"] = f"""WITH {SEARCH}, quoted AS (
 SELECT DISTINCT site, search_keyword,
  replace(url_encode(search_keyword), '%2F', '/') AS word FROM plan)
SELECT site, search_keyword, CASE site
 WHEN 'amazon' THEN 'https://www.amazon.sa/s?k=' || replace(search_keyword, ' ', '+')
  || '&language=en_AE'
 WHEN 'mumzworld' THEN 'https://www.mumzworld.com/sa-en/search?q=' || word
 WHEN 'saco' THEN 'https://www.saco.sa/en/search/' || word
 WHEN 'fine' THEN 'https://ksa.finestore.com/en/products?keyword=' || word
 WHEN 'gogreen' THEN 'https://gogreen.com.sa/products?search=' || word
 WHEN 'officesupply' THEN 'https://officesupply.sa/en/?match=all&subcats=Y&pcode_from_q=Y'
  || '&pshort=Y&pfull=Y&pname=Y&pkeywords=Y&search_performed=Y&dispatch=products.search&q=' || word
 WHEN 'aerosense' THEN 'https://www.aero-sense.com/en/online-shop/cabin-and-exterior-cleaning/'
  || lower(replace(search_keyword, ' ', '-')) END AS search_url
FROM quoted"""
ORACLE["first_industry"] = f"""WITH {PLAN_CATALOG}
SELECT subindustry, arg_min(industry, seq) AS industry FROM plan_catalog GROUP BY subindustry"""

TITLES = """titles AS (
 SELECT p_partkey, p_size, CASE p_partkey % 20
  WHEN 0 THEN p_name || ' ' || (p_size * 25) || ' ml'
  WHEN 1 THEN p_name || ' ' || p_size || '.5 L'
  WHEN 2 THEN p_name || ' ' || p_size || ' fl oz'
  WHEN 3 THEN p_name || ' (' || p_size || ' pcs)'
  WHEN 4 THEN p_name || ' ' || p_size || ' Wipes, Pack of 3'
  WHEN 5 THEN p_name || ' 6 Pcs x ' || p_size || ' L'
  WHEN 6 THEN p_name || ' ' || p_size || ' kilograms'
  WHEN 7 THEN p_name
  WHEN 8 THEN p_name || ' (12 bottles x ' || p_size || '.25 Ltr) deal'
  WHEN 9 THEN p_name || ' 4 x ' || (p_size * 10) || ' ML'
  WHEN 10 THEN p_size || '/box ' || p_name
  WHEN 11 THEN p_name || ' box of ' || p_size
  WHEN 12 THEN p_name || ' ' || p_size || ' - Piece set'
  WHEN 13 THEN p_name || ' ' || p_size || '-pack x 12'
  WHEN 14 THEN p_name || ' ' || p_size || ',5 l x 3'
  WHEN 15 THEN p_name || ' ' || p_size || 's wet x2'
  WHEN 16 THEN 'Family Pack 2 x (3 x ' || p_size || ' wipes) ' || p_name
  WHEN 17 THEN 'Wet rags, ' || p_size || ' Sheets, 3 Pack'
  WHEN 18 THEN p_name || ' wipes ' || p_size || ' wet wipes 2 x 4 pack'
  ELSE p_name || ' (carton of 4x' || p_size || ') 7 bottles' END AS title
 FROM part)"""


def num(text: str, pattern: str, group: int = 1) -> str:
    return f"CAST(nullif(regexp_extract({text}, '{pattern}', {group}, 'i'), '') AS DOUBLE)"


UNIT_WORDS = (
    "milliliters?|millilitres?|ml|liters?|litres?|ltr|l|kilograms?|kg|grams?|g|"
    "fluid ?ounces?|fl ?oz|ounces?|oz"
)
VOLUME_RE = rf"(\d+\.?\d*)\s*({UNIT_WORDS})\b"


def unit_of(word: str) -> str:
    return f"""CASE WHEN {word} = '' THEN NULL WHEN {word} LIKE 'milli%' OR {word} = 'ml' THEN 'ml'
 WHEN {word} LIKE 'l%' THEN 'L' WHEN {word} LIKE 'k%' THEN 'kg' WHEN {word} LIKE 'g%' THEN 'g'
 ELSE 'fl oz' END"""


def factor_of(unit: str) -> str:
    return f"""CASE WHEN {unit} IN ('L', 'kg') THEN 1000.0e0 WHEN {unit} = 'fl oz' THEN 29.5735e0
 ELSE 1.0e0 END"""


def volume_cte(name: str, source: str, text: str) -> str:
    """CTE with amount, unit and normalized amount of the first volume in a text column."""
    return f"""{name} AS (
 SELECT *, amount * {factor_of('unit')} AS normalized FROM (
  SELECT *, {unit_of('word')} AS unit FROM (
   SELECT *, {num(text, VOLUME_RE)} AS amount,
    lower(regexp_extract({text}, '{VOLUME_RE}', 2, 'i')) AS word FROM {source})))"""


COUNT = f"""coalesce({num('title', r'(\d+)\s*/\s*(box|pack|count)\b')},
 {num('title', r'(\d+)\s*(?:wet\s*)?(wipes|count|sheets|sachets|pack|pcs|pieces|pc)\b')},
 {num('title', r'\b(pack|box)\s*of\s*(\d+)', 2)})"""
ORACLE["parse_volume"] = f"""WITH {TITLES}, {volume_cte('v', 'titles', 'title')}
SELECT p_partkey, amount AS quantity, unit, normalized FROM v"""
ORACLE["parse_count"] = rf"""WITH {TITLES}, c AS (
 SELECT p_partkey, coalesce({num('title', r'(\d+)\s*-\s*(piece|wipes|rags)\b')}, {COUNT}) AS n
 FROM titles)
SELECT p_partkey, n AS quantity, CASE WHEN n IS NOT NULL THEN 'units' END AS unit,
 n AS normalized FROM c"""
ORACLE["parse_multiplier"] = rf"""WITH {TITLES}, {volume_cte('v', 'titles', 'title')}, m AS (
 SELECT *, {num('title', r'\((\d+\.?\d*)\s+.*?\s*x\s*(\d+\.?\d*)\s*(ltr|ml|l)\b.*\)')}
  * {num('title', r'\((\d+\.?\d*)\s+.*?\s*x\s*(\d+\.?\d*)\s*(ltr|ml|l)\b.*\)', 2)} AS box,
  {num('title', r'(\d+)\s*pcs\s*x\s*(\d+\.?\d*)\s*(ltr|ml|l)\b')}
  * {num('title', r'(\d+)\s*pcs\s*x\s*(\d+\.?\d*)\s*(ltr|ml|l)\b', 2)} AS pcs,
  coalesce({num('title', r'(\d+)\s*x')}, 1) AS times FROM v)
SELECT p_partkey, coalesce(box, pcs, amount * times) AS quantity,
 CASE WHEN coalesce(box, pcs) IS NOT NULL THEN 'L' ELSE unit END AS unit,
 coalesce(box * 1000, pcs * 1000, normalized * times) AS normalized FROM m"""
ORACLE["package_units"] = rf"""WITH {TITLES}, p AS (
 SELECT *, regexp_extract(title, '(\d+[.,]?\d*)\s*(ml|l)', ['n', 'u'], 'i') AS f FROM titles)
SELECT p_partkey, CASE p_partkey % 20 WHEN 3 THEN CAST(p_size AS DOUBLE)
  WHEN 13 THEN p_size * 12.0e0 END AS units,
 CASE WHEN f.n = '' THEN 0 ELSE CAST(replace(f.n, ',', '.') AS DOUBLE)
  * CASE WHEN lower(f.u) = 'l' THEN 1000 ELSE 1 END
  * coalesce({num('title', r'x\s*(\d+)')}, 1) END AS volume_ml FROM p"""
ORACLE["listing_quantity"] = rf"""WITH {TITLES}, {volume_cte('v', 'titles', 'title')}, m AS (
 SELECT *, coalesce({num('title', r'(?:pack of|x|of)\s*(\d+)')}, 1) AS times,
  {num('title', r'(\d+)\s*(wipes|count|sheets|sachets|pack|pcs|pieces|pc|s)\b')} AS n FROM v)
SELECT p_partkey, n * times AS units, amount * times AS volume, unit AS volume_unit FROM m"""
ORACLE["wipes_total"] = """
SELECT p_partkey, CASE p_partkey % 20 WHEN 4 THEN p_size * 3.0e0 WHEN 16 THEN p_size * 6.0e0
 WHEN 17 THEN p_size * 3.0e0 WHEN 18 THEN p_size * 8.0e0 ELSE 0 END AS wipes FROM part"""

SPEC_ROWS = """spec_rows AS (
 SELECT p_partkey, unnest([
  {'o': 1, 'label': 'color', 'value': ''},
  {'o': 2, 'label': 'brand', 'value': 'ACME 100'},
  {'o': 3, 'label': 'volume', 'value': CASE WHEN p_partkey % 4 = 0 THEN p_size || ' L'
    WHEN p_partkey % 4 = 1 THEN p_size || '0 ml' ELSE 'unknown' END},
  {'o': 4, 'label': 'pack', 'value': p_size || ' in a carton'},
  {'o': 5, 'label': 'label size', 'value': '9 pieces of ' || p_size || ' oz'},
  {'o': 6, 'label': CASE WHEN p_partkey % 5 < 3 THEN 'number of sheets' ELSE 'sheets' END,
   'value': CASE WHEN p_partkey % 3 = 0 THEN 'about ' || (p_size * 2) || ' pcs' ELSE 'n/a' END},
  {'o': 7, 'label': 'refill', 'value': '3 x ' || p_size || ' ml'}]) AS r FROM part),
flat AS (SELECT p_partkey, r.o AS o, r.label AS label, r.value AS value FROM spec_rows)"""
ORACLE["spec_quantity"] = rf"""WITH {TITLES}, {SPEC_ROWS}, {volume_cte('f', 'flat', 'value')},
{volume_cte('tv', 'titles', 'title')},
g AS (SELECT *, {num('value', r'\b(\d+)\b')} AS n FROM f),
spec AS (
 SELECT p_partkey,
  arg_min(amount, o) FILTER (WHERE label LIKE '%l%' AND amount IS NOT NULL) AS vol,
  arg_min(unit, o) FILTER (WHERE label LIKE '%l%' AND amount IS NOT NULL) AS vol_unit,
  coalesce(arg_max(n, o) FILTER (WHERE value <> '' AND NOT regexp_matches(label,
    'number of sheets|number of wipes|number of pieces|volume|capacity|content|size')
    AND NOT regexp_matches(value, '\d+\s*(ml|l|ltr|liter|liters|gallons?|fl\s?oz)\b', 'i')
    AND n BETWEEN 2 AND 50), 1) AS mult,
  arg_min({num('value', r'(\d+)')}, o) FILTER (WHERE regexp_matches(label,
    'number of sheets|number of wipes|number of pieces|count|pcs')
    AND regexp_matches(value, '\d')) AS pieces
 FROM g GROUP BY p_partkey),
t AS (
 SELECT tv.*, {COUNT} AS counted, coalesce({num('title', r'[x×]\s*(\d+)\b')},
  {num('title', r'(\d+)\s+(bottles?|pieces?|units?|pcs?|pack)')}, 1) AS tm FROM tv),
q AS (
 SELECT p_partkey, mult, tm,
  CASE WHEN p_partkey % 2 = 0 THEN coalesce(pieces, counted) ELSE coalesce(vol, amount, counted)
   END AS base,
  CASE WHEN p_partkey % 2 = 0 THEN 'units' WHEN vol IS NOT NULL THEN vol_unit
   WHEN amount IS NOT NULL THEN unit ELSE 'units' END AS u
 FROM t JOIN spec USING (p_partkey))
SELECT p_partkey, mult AS spec_multiplier, tm AS title_multiplier,
 base * greatest(mult, tm) AS quantity, CASE WHEN base IS NOT NULL THEN u END AS unit FROM q"""
ORACLE["agree_quantity"] = f"""WITH texts AS (
 SELECT p_partkey,
  CASE WHEN p_partkey % 5 <> 0 THEN p_size * 25.0e0 END AS a,
  CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_size * 29.5735e0
   ELSE p_size / 40 * 1000 END AS b,
  CASE WHEN p_partkey % 7 <> 0 AND p_partkey % 3 <> 0 THEN p_size / 40 ELSE p_size END AS b_amount,
  CASE WHEN p_partkey % 3 = 0 THEN 'fl oz' ELSE 'L' END AS b_unit,
  CASE WHEN p_partkey % 4 = 0 THEN p_size * 25.0e0
   WHEN p_partkey % 4 = 1 THEN p_size * 29.5735e0 END AS c FROM part)
SELECT p_partkey,
 CASE WHEN abs(a - b) < 1 OR abs(a - c) < 1 THEN a WHEN abs(b - c) < 1 THEN b_amount ELSE 0 END
  AS quantity,
 CASE WHEN abs(a - b) < 1 OR abs(a - c) < 1 THEN 'ml' WHEN abs(b - c) < 1 THEN b_unit
  ELSE 'units' END AS unit,
 CASE WHEN abs(a - b) < 1 THEN 'Confirmed by Title & Volume'
  WHEN abs(a - c) < 1 THEN 'Confirmed by Title & Item_volume'
  WHEN abs(b - c) < 1 THEN 'Confirmed by Volume & Item_volume' ELSE 'Not Found' END AS status
FROM texts"""
ORACLE["site_price"] = f"""WITH t AS (
 SELECT l_orderkey, l_linenumber, l_linenumber % 3 > 0 AS cents,
  format('{{:.2f}}', l_extendedprice) AS plain FROM lineitem),
s AS (SELECT *, split_part(plain, '.', 1) AS whole, split_part(plain, '.', 2) AS part FROM t)
SELECT l_orderkey, l_linenumber, CASE WHEN cents THEN plain ELSE whole END AS whole_fraction,
 plain AS after_sar, CASE WHEN cents THEN plain END AS two_decimals, whole AS integer_price,
 CASE WHEN cents THEN plain ELSE whole || '.00' END AS superscript_price,
 plain AS joined_price, {round2('CAST(plain AS DOUBLE) * 4.39e0')} AS from_euro FROM s"""

ORACLE["page_fields"] = r"""
SELECT page_id,
 replace(replace(trim(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1)), '&quot;', '"'),
  '&amp;', '&') AS heading,
 replace(replace(trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)), '&quot;', '"'),
  '&amp;', '&') AS page_title, false AS failed FROM pages"""
ORACLE["page_links"] = r"""WITH links AS (
 SELECT page_id, url AS base,
  regexp_extract_all(html, '(?s)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1) AS href,
  regexp_extract_all(html, '(?s)<a [^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2) AS label FROM pages),
each_link AS (
 SELECT page_id, base, generate_subscripts(href, 1) - 1 AS rank, unnest(href) AS href,
  unnest(label) AS label FROM links)
SELECT page_id, rank, CASE WHEN regexp_matches(href, '^https?:') THEN href
  ELSE regexp_extract(base, '^(https?://[^/]+)', 1) || href END AS url, label FROM each_link"""
ORACLE["listing_links"] = """WITH hits AS (
 SELECT p_partkey, p_name, CASE p_partkey % 4 WHEN 0 THEN 'amazon' WHEN 1 THEN 'mumzworld'
  WHEN 2 THEN 'saco' ELSE 'gogreen' END AS site, unnest([
   {'rank': 0, 'url': 'https://shop.example/p/' || p_partkey, 'label': p_name},
   {'rank': 1, 'url': 'https://shop.example/spons/' || p_partkey, 'label': 'ad ' || p_name},
   {'rank': 2, 'url': 'https://shop.example/en/q?id=' || p_partkey, 'label': ''},
   {'rank': 3, 'url': 'https://other.example/' || p_partkey, 'label': 'last'}]) AS hit FROM part)
SELECT p_partkey, site, CAST(hit.rank AS BIGINT) AS rank, hit.url AS product_url,
 hit.label AS link_text FROM hits
WHERE NOT (site = 'amazon' AND hit.rank = 1) AND NOT (site = 'saco' AND hit.rank = 2)"""

PAGE_OFFERS = f"""shop AS (
 SELECT *, p_partkey % 2 = 0 AS u, '1' || lpad(CAST(p_size AS VARCHAR), 3, '0') AS thousands,
  CASE p_partkey % 7 WHEN 0 THEN 'amazon' WHEN 1 THEN 'mumzworld' WHEN 2 THEN 'saco'
   WHEN 3 THEN 'fine' WHEN 4 THEN 'gogreen' WHEN 5 THEN 'officesupply' ELSE 'aerosense' END AS site,
  CASE WHEN p_partkey % 11 = 0 THEN 'marble polish' ELSE p_name END AS word FROM part),
found AS (
 SELECT p_partkey, site, u, word, p_name || ' ' || p_size
   || CASE WHEN u THEN ' wipes, pack of 3' ELSE ' L' END AS product,
  thousands || '.50' AS price_sar, p_brand AS company,
  CASE WHEN u THEN CASE WHEN p_partkey % 11 <> 0 THEN p_size * 3.0e0 ELSE p_size END
   WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size END AS total_quantity,
  CASE WHEN u THEN 'units' ELSE 'L' END AS unit_of_measurement FROM shop WHERE site = 'amazon'
 UNION ALL
 SELECT p_partkey, site, u, word, 'Acme - ' || p_name || ' ' || p_size
   || CASE WHEN u THEN 's x 2' ELSE ' ml x 2' END, thousands, 'Acme', p_size * 2.0e0,
  CASE WHEN u THEN 'units' ELSE 'ml' END FROM shop WHERE site = 'mumzworld'
 UNION ALL
 SELECT p_partkey, site, u, word, p_name || ' ' || p_size
   || CASE WHEN u THEN ' - piece' ELSE ' Ltr' END, p_size || '.95', p_brand, p_size,
  CASE WHEN u THEN 'units' ELSE 'L' END FROM shop WHERE site = 'saco'
 UNION ALL
 SELECT p_partkey, site, u, word, p_name, thousands || '.25', 'Fine', p_size * 4.0e0,
  CASE WHEN u THEN 'units' ELSE 'ml' END FROM shop WHERE site = 'fine'
 UNION ALL
 SELECT p_partkey, site, u, word, p_name || CASE WHEN u THEN ' ' || p_size || ' pcs'
   ELSE ' 12 Pcs x ' || p_size || ' LTR' END, thousands || '.50', 'GoGreen',
  p_size * CASE WHEN u THEN 1.0e0 ELSE 12 END, CASE WHEN u THEN 'units' ELSE 'L' END
 FROM shop WHERE site = 'gogreen'
 UNION ALL
 SELECT p_partkey, site, u, word, p_name || CASE WHEN u THEN ' ' || p_size || ' sheets'
   ELSE ' (6 bottles x ' || p_size || ' Ltr)' END, p_size || '.75', 'Brand not found',
  p_size * CASE WHEN u THEN 1.0e0 ELSE 6 END, CASE WHEN u THEN 'units' ELSE 'L' END
 FROM shop WHERE site = 'officesupply'
 UNION ALL
 SELECT p_partkey, site, u, word, p_name || ' - ' || CASE WHEN u THEN '(' || p_size || ' pcs)'
   ELSE p_size || ' l x 2' END,
  CAST({round2('CAST(thousands AS DOUBLE) * 4.39e0')} AS VARCHAR), 'AeroSense',
  p_size * CASE WHEN u THEN 1.0e0 ELSE 2000 END, CASE WHEN u THEN 'units' ELSE 'ml' END
 FROM shop WHERE site = 'aerosense'
 UNION ALL
 SELECT p_partkey, site, u, word, p_name || ' - ' || CASE WHEN u THEN '6-pack x ' || p_size
   ELSE '5 ml' END, '8.78', 'AeroSense', CASE WHEN u THEN p_size * 6.0e0 ELSE 5 END,
  CASE WHEN u THEN 'units' ELSE 'ml' END FROM shop WHERE site = 'aerosense'),
accepted AS (
 SELECT *, row_number() OVER (PARTITION BY site, word, u ORDER BY p_partkey, product) AS rank
 FROM found WHERE total_quantity > 0 AND (word <> 'marble polish' OR site = 'aerosense'))"""
ACCEPTED = """accepted WHERE site = 'aerosense' OR rank <= CASE site WHEN 'amazon' THEN 40
 WHEN 'mumzworld' THEN 7 WHEN 'saco' THEN 8 WHEN 'officesupply' THEN 8 ELSE 5 END"""
ORACLE["page_offers"] = f"""WITH {PAGE_OFFERS}
SELECT p_partkey, site, product, price_sar, company, total_quantity, unit_of_measurement
FROM {ACCEPTED}"""
ORACLE["offer_assembly"] = f"""WITH {PAGE_OFFERS}, {PLAN_CATALOG}, first AS (
 SELECT subindustry, arg_min(industry, seq) AS industry FROM plan_catalog GROUP BY subindustry),
kept AS (SELECT * FROM {ACCEPTED})
SELECT DATE '2025-03-01' AS date, first.industry, c.subindustry, c.type_of_product,
 c.generic_product_type, product, price_sar, company, site AS source,
 'https://shop.example/' || p_partkey AS url, unit_of_measurement, total_quantity,
 CASE WHEN lower(c.subindustry) IN ('home','automotive','pets') THEN 'B2C' ELSE 'B2B' END AS channel
FROM kept JOIN plan_catalog c ON c.seq = p_partkey JOIN first USING (subindustry)"""

SEARCHES = """searches AS (
 SELECT CASE l_suppkey % 7 WHEN 0 THEN 'amazon' WHEN 1 THEN 'mumzworld' WHEN 2 THEN 'saco'
   WHEN 3 THEN 'fine' WHEN 4 THEN 'gogreen' WHEN 5 THEN 'officesupply' ELSE 'aerosense' END AS site,
  split_part(p_name, ' ', 2) AS search_keyword,
  CASE WHEN l_linenumber % 5 <> 0 THEN p_name END AS product,
  CASE l_linenumber WHEN 1 THEN 'n/a' WHEN 2 THEN '0.00'
   ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS price_sar,
  CASE WHEN l_quantity < 5 THEN 0 ELSE l_quantity END AS total_quantity,
  l_orderkey * 8 + l_linenumber AS position, l_partkey, l_extendedprice, l_linenumber
 FROM lineitem JOIN part ON l_partkey = p_partkey),
checked AS (
 SELECT *, CASE WHEN site = 'aerosense' THEN NULL
  WHEN site = 'fine' AND l_linenumber = 1 THEN 'Invalid price format'
  WHEN site = 'fine' AND l_linenumber = 2 THEN 'Invalid price'
  WHEN total_quantity <= 0 THEN 'Invalid quantity'
  WHEN product IS NULL THEN 'Product name not found' END AS reject_reason FROM searches)"""
ORACLE["offer_validity"] = f"""WITH {SEARCHES}
SELECT site, reject_reason, count(*) AS offers FROM checked GROUP BY 1, 2"""
ORACLE["offer_cap"] = f"""WITH {SEARCHES}, ranked AS (
 SELECT *, row_number() OVER (PARTITION BY industry, site, search_keyword
  ORDER BY position, l_partkey, l_extendedprice) AS rank
 FROM checked, (VALUES ('Living'), ('Working')) AS instruction(industry) WHERE reject_reason IS NULL)
SELECT industry, site, search_keyword, position, product, price_sar, total_quantity FROM ranked
WHERE rank <= CASE site WHEN 'amazon' THEN 40 WHEN 'mumzworld' THEN 7 WHEN 'saco' THEN 8
 WHEN 'fine' THEN 5 WHEN 'gogreen' THEN 5 WHEN 'officesupply' THEN 8 ELSE 1000000000 END"""


def words(text: str) -> str:
    return rf"""list_distinct(list_transform(list_filter(
 regexp_extract_all(lower({text}), '[a-z]{{3,}}'),
 lambda w: w NOT IN ('and', 'for', 'the', 'with', 'from')),
 lambda w: regexp_replace(w, '([^s])s$', '\1')))"""


def overlap(left: str, names: str) -> str:
    return f"list_has_any({left}, [{names}])"


def missing(asked: str, having: str, names: str) -> str:
    return (
        f"len(list_filter({asked}, lambda w: list_contains([{names}], w)"
        f" AND NOT list_contains({having}, w))) > 0"
    )


TOOLS = "'cloth', 'wipe', 'brush', 'brushe', 'mop', 'rag', 'sponge'"
CARS = "'car', 'vehicle', 'auto', 'automotive'"
ORACLE["query_relevance"] = f"""WITH pairs AS (
 SELECT p_partkey, p_name || CASE p_partkey % 7 WHEN 0 THEN '' WHEN 1 THEN ' cleaner cloth'
   WHEN 2 THEN ' + promo' WHEN 3 THEN ' for marble floors' WHEN 4 THEN ' car wax'
   WHEN 5 THEN ' laundry bundle' ELSE ' dishes and glass' END AS title,
  p_name || CASE p_partkey % 10 WHEN 0 THEN '' WHEN 1 THEN ' cleaners' WHEN 2 THEN ' for vehicle'
   WHEN 3 THEN ' marble' WHEN 4 THEN ' polish and wax' WHEN 5 THEN ' wipes'
   WHEN 6 THEN ' with microfiber' WHEN 7 THEN ' for the glass' WHEN 8 THEN ' waterless wash'
   ELSE ' laundry' END AS asked FROM part),
tok AS (SELECT p_partkey, title, {words('title')} AS t, {words('asked')} AS q FROM pairs),
scored AS (SELECT *, len(list_intersect(q, t)) / len(q) AS share FROM tok)
SELECT p_partkey, round(share, 4) AS coverage, share >= 0.6e0 AND NOT (
 ({overlap('t', TOOLS)} AND NOT {overlap('q', TOOLS + ", 'microfiber'")})
 OR {missing('t', 'q', "'laundry', 'dish', 'dishe'")}
 OR contains(title, '+') OR {overlap('t', "'promo', 'bundle', 'combo'")}
 OR {missing('q', 't', "'hardwood', 'marble', 'tile', 'granite', 'leather', 'carpet'")}
 OR {missing('q', 't', "'wax', 'polish', 'waterless'")}
 OR ({overlap('q', CARS)} AND NOT {overlap('t', CARS)})) AS relevant FROM scored"""

# Models ----------------------------------------------------------------------

ORACLE["forest_rows"] = f"""WITH {CATALOG}
SELECT seq,
 CASE WHEN seq % 19 = 0 THEN 'FP-0' WHEN seq % 23 <> 0 THEN product_id END AS product_id,
 volume_liters IS NOT NULL AND seq % 13 <> 0 AND seq % 17 <> 0 AS priced,
 CASE WHEN priced THEN true END AS in_range, CASE WHEN priced THEN true END AS sure_in_range
FROM catalog"""
ORACLE["tree_confidence"] = """WITH trees AS (
 SELECT l_orderkey, avg(l_quantity) AS mean, stddev_pop(l_quantity) AS spread FROM lineitem GROUP BY 1)
SELECT l_orderkey, round(mean, 6) AS tree_mean, round(spread, 6) AS tree_spread,
 CASE WHEN mean = 0 THEN 0 ELSE round(greatest(0, 1 - 2 * spread / mean) * 100, 2) END AS confidence
FROM trees"""
ORACLE["encoded_features"] = f"""WITH {CATALOG}, known AS (
 SELECT *, {CHANNEL} AS channel FROM catalog WHERE seq % 3 = 0 AND subindustry <> 'Pets'
 AND pack_quantity_units IS NOT NULL),
subs AS (SELECT DISTINCT subindustry FROM known), channels AS (SELECT DISTINCT channel FROM known)
SELECT seq, CASE WHEN seq % 5 <> 0 AND type_of_product IN (SELECT type_of_product FROM known)
  THEN 1 ELSE 0 END AS types_flagged,
 (SELECT string_agg(CASE WHEN s.subindustry = c.subindustry THEN '1' ELSE '0' END, '' ORDER BY s.subindustry DESC)
  FROM subs s) AS subindustry_flags,
 (SELECT string_agg(CASE WHEN h.channel = c.own THEN '1' ELSE '0' END, '' ORDER BY h.channel DESC)
  FROM channels h) AS channel_flags
FROM (SELECT *, {CHANNEL} AS own FROM catalog) c"""

# Files and logs --------------------------------------------------------------

ORACLE["csv_round_trip"] = f"""WITH {QUOTES}
SELECT product_id, CASE WHEN seq % 5 <> 0 THEN 'a "b", ' || description END AS description,
 approved_quote_price, seq FROM quotes"""
ORACLE["csv_rejects"] = f"""WITH {QUOTES}
SELECT product_id, description, approved_quote_price, seq, NULL AS reason FROM quotes WHERE seq % 7 <> 0
UNION ALL
SELECT NULL, NULL, NULL, NULL, 'approved_quote_price: n/a ' || seq FROM quotes WHERE seq % 7 = 0"""
ORACLE["offer_runs"] = f"""WITH {QUOTES} SELECT DATE '2025-01-02' AS date, product_id, seq FROM quotes"""
ORACLE["last_full_run"] = """WITH runs AS (
 SELECT 'r' || o_orderkey AS run_id, o_orderkey % 97 = 0 AS full_run,
  CAST(o_orderdate AS TIMESTAMP) + to_seconds(o_orderkey % 86400) AS finished_at FROM orders),
last AS (SELECT max(finished_at) AS last_full FROM runs WHERE full_run)
SELECT run_id, finished_at, last_full FROM runs, last WHERE finished_at >= last_full"""
ORACLE["forest_folds"] = """SELECT
 CAST(('0x' || substr(md5('42-' || l_orderkey || '/' || l_linenumber), 1, 8))::BIGINT % 8 AS BIGINT) AS fold,
 count(*) AS rows_left_out FROM lineitem GROUP BY 1"""

"""DuckDB twins of the derived catalogue tables, prefixed to each check query as CTEs."""

from __future__ import annotations

import re

from shelfweave.functions import fixed_values as fv
from shelfweave.sources.catalog import NATION_SPAN, PROPERTY_CODES, REGION_SPAN

_WHOLE = 8 * REGION_SPAN
_NATION_LEFT = f"CAST(4 + n_regionkey * {REGION_SPAN} + n_nationkey * {NATION_SPAN} AS BIGINT)"


def fold(x: str) -> str:
    out = f"translate({x}, '{fv.ACCENTS_FROM}', '{fv.ACCENTS_TO}')"
    for source, target in fv.LIGATURES:
        out = f"replace({out}, '{source}', '{target}')"
    return out


def slug(x: str) -> str:
    return f"trim(regexp_replace({fold(f'lower({x})')}, '[^a-z0-9]+', '-', 'g'), '-')"


def code(x: str) -> str:
    return f"replace(lower({x}), ' ', '_')"


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '[^\\p{{L}}\\p{{N}}]+'), lambda t: t <> '')"


def blanks(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, '\\s+'), lambda t: t <> '')"


def split_trim(x: str) -> str:
    return f"list_transform(string_split({x}, ','), lambda p: trim(p))"


def php_int(x: str) -> str:
    return f"coalesce(try_cast(nullif(regexp_extract({x}, '^\\s*([+-]?[0-9]+)', 1), '') AS BIGINT), 0)"


def image_path(x: str) -> str:
    d = f"coalesce(CAST({x} AS VARCHAR), '')"
    return f"concat('/p/', CASE WHEN {d} = '' THEN '/' ELSE regexp_replace({d}, '(.)', '\\1/', 'g') END, {d}, '.jpg')"


VIEWS: dict[str, str] = {
    "shop": "SELECT r_regionkey + 1 AS id_shop, r_name AS name FROM region",
    "lang": """SELECT CAST(row_number() OVER (ORDER BY iso) AS INT) AS id_lang, iso AS iso_code, iso <> 'es' AS active
        FROM (SELECT DISTINCT lang AS iso FROM documents) d""",
    "lang_shop": "SELECT id_lang, id_shop FROM lang CROSS JOIN shop WHERE (id_lang + id_shop) % 4 <> 0",
    "category": f"""SELECT *, CAST(id_category % 7 AS INT) AS position, DATE '2023-01-01' AS date_add,
            DATE '2024-01-01' + CAST(id_category % 50 AS INT) AS date_upd FROM (
        SELECT CAST(1 AS BIGINT) AS id_category, CAST(0 AS BIGINT) AS id_parent, 0 AS level_depth, CAST(1 AS BIGINT) AS nleft,
            CAST({_WHOLE + 10} AS BIGINT) AS nright, true AS active, 'Root' AS base_name
        UNION ALL SELECT 2, 1, 1, 2, {_WHOLE + 9}, true, 'Home'
        UNION ALL SELECT 10 + r_regionkey, 2, 2, 3 + r_regionkey * {REGION_SPAN}, 2 + (r_regionkey + 1) * {REGION_SPAN}, true, r_name FROM region
        UNION ALL SELECT 100 + n_nationkey, 10 + n_regionkey, 3, {_NATION_LEFT}, {_NATION_LEFT} + {NATION_SPAN - 1}, n_nationkey % 7 <> 0, n_name FROM nation
        UNION ALL SELECT 1000 + 16 * s_nationkey + b, 100 + s_nationkey, 4, {_NATION_LEFT} + 1 + 2 * b, {_NATION_LEFT} + 2 + 2 * b,
            (s_nationkey + b) % 11 <> 3, concat(n_name, ' ', CAST(b AS VARCHAR))
        FROM (SELECT DISTINCT s_nationkey, s_suppkey % 16 AS b FROM supplier) g JOIN nation ON s_nationkey = n_nationkey) tree""",
    "category_lang": """SELECT id_category, id_lang, concat(base_name, ' ', iso_code) AS name,
        concat(lower(replace(replace(base_name, '_', '-'), ' ', '-')), '-', iso_code) AS link_rewrite,
        concat(base_name, ' , ', iso_code, ',x') AS meta_keywords FROM category CROSS JOIN lang""",
    "category_product": """SELECT DISTINCT CAST(1000 + 16 * s_nationkey + s_suppkey % 16 AS BIGINT) AS id_category, l_partkey AS id_product
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey""",
    "manufacturer": """SELECT DISTINCT CAST(replace(p_brand, 'Brand#', '') AS INT) AS id_manufacturer, p_brand AS name,
        lower(replace(p_brand, '#', '-')) AS link_rewrite, p_brand <> 'Brand#13' AS active FROM part""",
    "product": """SELECT p_partkey AS id_product, concat('REF', CAST(1000000 + p_partkey AS VARCHAR)) AS reference,
        CAST(4000000000000 + p_partkey AS VARCHAR) AS ean13, CAST(replace(p_brand, 'Brand#', '') AS INT) AS id_manufacturer,
        CAST(100 + p_partkey % 25 AS BIGINT) AS id_category_default, p_size % 10 <> 0 AS active, p_type = 'PROMO' AS is_virtual,
        p_size % 4 = 0 AS on_sale, p_size % 9 = 0 AS online_only, p_size <> 13 AS show_price, p_size % 6 <> 0 AS available_for_order,
        p_size % 8 = 0 AS is_new, p_size % 12 = 0 AS customization_required, CAST(p_partkey % 3 AS INT) AS out_of_stock,
        1 + p_size % 3 AS minimal_quantity, CAST(p_size AS DOUBLE) / 2 AS weight,
        CASE WHEN p_size % 5 = 0 THEN 'used' ELSE 'new' END AS condition, p_size % 3 + 1 AS id_tax_rules_group,
        CAST(p_partkey % 50 AS BIGINT) AS id_supplier, DATE '2024-01-01' AS date_add, DATE '2024-01-01' + p_size AS date_upd FROM part""",
    "product_shop": """SELECT p_partkey AS id_product, r_regionkey + 1 AS id_shop, p_retailprice + r_regionkey AS price,
        (p_size + r_regionkey) % 10 <> 0 AS active, DATE '2024-01-01' + (p_size + r_regionkey) AS date_upd
        FROM part CROSS JOIN region WHERE (p_partkey + r_regionkey) % 3 <> 0""",
    "product_lang": """SELECT p_partkey AS id_product, id_lang, concat(p_name, ' ', iso_code) AS name,
        concat('Long text for ', p_name, ' in ', iso_code) AS description, p_name AS description_short,
        concat(replace(p_name, ' ', '-'), '-', iso_code) AS link_rewrite, concat(p_name, ' title') AS meta_title,
        CASE p_size % 4 WHEN 0 THEN concat(CAST(p_size AS VARCHAR), ' days') WHEN 1 THEN '0' WHEN 2 THEN '' ELSE 'soon' END AS available_now,
        CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) END AS available_later
        FROM part CROSS JOIN lang WHERE (p_partkey + id_lang) % 5 <> 0""",
    "order_detail": "SELECT l_partkey AS product_id, CAST(l_quantity AS INT) AS product_quantity FROM lineitem",
    "page": "SELECT 10 * p_partkey AS id_page, p_partkey AS id_object, CASE WHEN p_partkey % 11 = 0 THEN 'cms' ELSE 'product' END AS page_type FROM part",
    "page_viewed": "SELECT 10 * user_id AS id_page, CAST(json_extract_string(props, '$.k') AS BIGINT) AS counter FROM events WHERE event_type = 'view'",
    "stock_available": """SELECT 5000000 + p_partkey AS id_stock, p_partkey AS id_product, CAST((p_partkey * 7) % 23 - 3 AS INT) AS quantity,
        p_size % 4 AS supplier_qty, CAST(p_partkey % 3 AS INT) AS out_of_stock FROM part WHERE p_partkey % 17 <> 0""",
    "feature_product": """SELECT p_partkey AS id_product, id_lang, 1 AS position, 'Frame Size' AS name, CAST(p_size AS VARCHAR) AS value FROM part CROSS JOIN lang
        UNION ALL SELECT p_partkey, id_lang, 2, 'Material Kind', replace(p_name, ' ', ' , ') FROM part CROSS JOIN lang
        UNION ALL SELECT p_partkey, id_lang, 3, 'frame size', p_type FROM part CROSS JOIN lang WHERE p_size % 2 = 0
        UNION ALL SELECT p_partkey, id_lang, 4, 'Condition', 'hidden by a declared field' FROM part CROSS JOIN lang WHERE p_size % 7 = 0
        UNION ALL SELECT p_partkey, id_lang, 5, concat('Series ', replace(p_brand, '#', ' ')), p_type FROM part CROSS JOIN lang WHERE p_size % 3 = 0""",
    "attribute_group": """SELECT 1 AS id_attribute_group, 'Order Priority' AS name UNION ALL SELECT 2, 'Market Segment'
        UNION ALL SELECT 3, 'Part Type' UNION ALL SELECT 4, 'Empty Group'""",
    "attribute": """SELECT CAST(100 * g + row_number() OVER (PARTITION BY g ORDER BY v) AS INT) AS id_attribute, g AS id_attribute_group, v AS name,
        CAST(row_number() OVER (PARTITION BY g ORDER BY v DESC) AS INT) AS position
        FROM (SELECT DISTINCT 1 AS g, o_orderpriority AS v FROM orders UNION ALL SELECT DISTINCT 2, c_mktsegment FROM customer
              UNION ALL SELECT DISTINCT 3, p_type FROM part) a""",
    "attribute_group_lang": """SELECT g.id_attribute_group, lang.id_lang, concat(g.name, ' ', lang.iso_code) AS name FROM attribute_group g CROSS JOIN lang
        WHERE (g.id_attribute_group + lang.id_lang) % 5 <> 0""",
    "attribute_lang": """SELECT a.id_attribute, lang.id_lang, concat(a.name, ' ', lang.iso_code) AS name FROM attribute a CROSS JOIN lang
        WHERE (a.id_attribute + lang.id_lang) % 7 <> 0""",
    "attribute_group_shop": "SELECT g.id_attribute_group, shop.id_shop FROM attribute_group g CROSS JOIN (SELECT id_shop FROM shop) shop WHERE (g.id_attribute_group + shop.id_shop) % 4 <> 0",
    "attribute_shop": "SELECT a.id_attribute, shop.id_shop FROM attribute a CROSS JOIN (SELECT id_shop FROM shop) shop WHERE (a.id_attribute + shop.id_shop) % 3 <> 0",
    "group_named": """SELECT gs.id_shop, lang.id_lang, gl.id_attribute_group AS id, gl.name AS attribute_group, min(a.position) AS position
        FROM attribute_group ag JOIN attribute_group_shop gs ON gs.id_attribute_group = ag.id_attribute_group CROSS JOIN (SELECT * FROM lang WHERE active) lang
        LEFT JOIN attribute_group_lang gl ON gl.id_attribute_group = ag.id_attribute_group AND gl.id_lang = lang.id_lang
        LEFT JOIN attribute a ON a.id_attribute_group = ag.id_attribute_group
        LEFT JOIN attribute_lang al ON al.id_attribute = a.id_attribute AND al.id_lang = lang.id_lang
        JOIN attribute_shop ats ON ats.id_attribute = a.id_attribute AND ats.id_shop = gs.id_shop GROUP BY 1, 2, 3, 4""",
    "tax_rule": """SELECT s_suppkey AS id_tax_rule, CAST(s_suppkey // 8 AS INT) + 1 AS id_tax_rules_group, s_nationkey AS id_country,
        concat('N', CAST(s_nationkey AS VARCHAR)) AS country_iso, CAST(5 + (s_suppkey % 4) * 5 AS DOUBLE) AS rate FROM supplier""",
    "tax_rules_group": """SELECT id_tax_rules_group, concat('Tax group ', CAST(id_tax_rules_group AS VARCHAR)) AS name
        FROM (SELECT DISTINCT CAST(s_suppkey // 8 AS INT) + 1 AS id_tax_rules_group FROM supplier) g""",
    "supplier_name": "SELECT s_suppkey AS id_supplier, s_name AS supplier_name FROM supplier",
    "specific_price": "SELECT p_partkey AS id_product, CAST(p_size % 5 AS DOUBLE) / 10 AS reduction FROM part WHERE p_partkey % 4 = 0",
    "group_price": """SELECT p_partkey AS id_product, g AS id_group, p_retailprice - g AS price
        FROM part CROSS JOIN (SELECT 1 AS g UNION ALL SELECT 2 UNION ALL SELECT 3) x WHERE (p_partkey + g) % 4 <> 0""",
    "image": """SELECT 10 * p_partkey + k AS id_image, p_partkey AS id_product, k AS position, k = 1 AS cover, concat(p_name, ' ', CAST(k AS VARCHAR)) AS legend
        FROM part CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 UNION ALL SELECT 3) x WHERE k <= p_size % 4""",
    "logo_manifest": "SELECT id_manufacturer FROM manufacturer WHERE id_manufacturer % 3 <> 0",
    "cms_category": """SELECT CAST(replace(source, 'src', '') AS INT) + 1 AS id_cms_category, source AS name, 0 AS id_parent, source <> 'src7' AS active
        FROM (SELECT DISTINCT source FROM documents) s""",
    "cms": """SELECT doc_id AS id_cms, CAST(replace(source, 'src', '') AS INT) + 1 AS id_cms_category, lang AS iso_code, text AS content,
        concat('Page ', CAST(doc_id AS VARCHAR)) AS meta_title, n_chars > 50 AS active FROM documents""",
    "review": """SELECT event_id AS id, user_id AS id_product, value AS grade, concat('user', CAST(user_id AS VARCHAR)) AS customer_name, props AS content,
        user_id % 2 = 1 AS validate, event_id % 5 = 0 AS deleted, ts AS date_add FROM events WHERE event_type = 'purchase'""",
    "index_status": """SELECT ps.id_product AS id_entity, 'product' AS index, ps.id_shop, pl.id_lang,
        CASE WHEN ps.id_product % 4 = 1 THEN DATE '2023-06-01' ELSE ps.date_upd END AS date_upd,
        CASE WHEN ps.id_product % 8 = 5 THEN 'mapper failed' END AS error
        FROM product_shop ps JOIN product_lang pl ON ps.id_product = pl.id_product
        WHERE ps.id_product % 4 < 2 AND NOT (ps.id_product % 4 = 0 AND pl.id_lang = 3)""",
    "category_status": """SELECT c.id_category AS id_entity, 'category' AS index, CAST(shop.id_shop AS INT) AS id_shop, l.id_lang,
        CASE WHEN c.id_category % 4 = 1 THEN DATE '2023-06-01' ELSE c.date_upd END AS date_upd,
        CASE WHEN c.id_category % 8 = 5 THEN 'mapper failed' END AS error
        FROM category c JOIN category_lang l ON l.id_category = c.id_category CROSS JOIN (SELECT id_shop FROM shop) shop WHERE c.active AND c.id_category % 4 < 2""",
    "change_feed": """SELECT CASE event_type WHEN 'purchase' THEN 'manufacturer' WHEN 'signup' THEN 'category' WHEN 'click' THEN 'tax_rate' ELSE 'product' END AS entity,
        CASE event_type WHEN 'purchase' THEN 11 + user_id % 90 WHEN 'signup' THEN 1000 + user_id % 800 ELSE user_id END AS id_entity,
        CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op, ts, event_id AS change_id FROM events""",
    "entity_type": """SELECT concat('Builder', e) AS class_name, e AS entity_name,
        NOT (e = 'taxrule' AND id_shop = 2) AND NOT (e = 'product' AND id_shop = 4) AS enabled, id_shop
        FROM (SELECT unnest(['attribute', 'category', 'cmscategory', 'cms_page', 'manufacturer', 'product', 'taxrule']) AS e) t CROSS JOIN shop""",
    "bulk_result": """SELECT id_entity, concat('shop_', CAST(id_shop AS VARCHAR), '_', CAST(id_lang AS VARCHAR), '_7') AS route, index AS type,
        CASE WHEN id_entity % 9 = 0 THEN 400 WHEN id_entity % 10 = 0 THEN 503 ELSE 201 END AS status,
        CASE WHEN id_entity % 9 = 0 THEN 'bad field' END AS reason, CASE WHEN id_entity % 18 = 0 THEN 'not a number' END AS caused_by
        FROM index_status""",
    "feature_name": "SELECT DISTINCT name FROM feature_product",
    "meta_key": f"""SELECT CAST(o AS INT) AS ord, c AS code, 'property' AS meta_type
        FROM (SELECT unnest([{', '.join(f"'{c}'" for c in PROPERTY_CODES)}]) AS c, generate_subscripts([{', '.join(f"'{c}'" for c in PROPERTY_CODES)}], 1) AS o) p
        UNION ALL SELECT CAST(100 + row_number() OVER (ORDER BY c) AS INT), c, 'feature' FROM (SELECT DISTINCT {slug('name')} AS c FROM feature_name) f
        UNION ALL SELECT 900 + id_attribute_group, {slug('name')}, 'attribute' FROM attribute_group""",
    "meta": """SELECT ord AS id, CASE WHEN meta_type = 'property' THEN code ELSE concat(code, '_', meta_type) END AS alias, code, meta_type,
        CASE ord % 4 WHEN 0 THEN 'keyword' WHEN 1 THEN 'text' WHEN 2 THEN 'float' ELSE 'text' END AS elastic_type,
        ord % 5 <> 0 AS enabled, ord % 3 <> 0 AS searchable, ord % 2 = 0 AS aggregatable, CAST(ord % 4 + 1 AS FLOAT) AS weight,
        CASE WHEN ord % 6 = 0 THEN 0 ELSE ord END AS position, ord % 2 AS operator, ord % 5 + 1 AS display_type,
        CASE ord % 4 WHEN 0 THEN 3 WHEN 2 THEN 5 ELSE 0 END AS result_limit FROM meta_key""",
    "meta_lang": """SELECT id, id_lang, concat(upper(code), ' ', iso_code) AS name
        FROM (SELECT id, code FROM meta UNION ALL SELECT 9999, 'orphan') m CROSS JOIN lang WHERE (id + id_lang) % 3 <> 0""",
    "meta_edit": """SELECT p_partkey AS ord, concat(lower(replace(p_name, ' ', '_')), '_', CAST(p_size AS VARCHAR)) AS alias,
        concat(lower(replace(p_name, ' ', '_')), '_', CAST(p_size AS VARCHAR)) AS code,
        CASE WHEN p_size % 2 = 0 THEN 'feature' ELSE 'attribute' END AS meta_type, CASE WHEN p_size % 3 = 0 THEN 'keyword' ELSE 'text' END AS elastic_type,
        p_partkey % 2 = 0 AS enabled, p_partkey % 3 = 0 AS searchable, p_partkey % 5 = 0 AS aggregatable, CAST(p_partkey % 4 + 1 AS FLOAT) AS weight,
        CAST(p_partkey % 2 AS INT) AS operator, CAST(p_partkey % 5 + 1 AS INT) AS display_type, 0 AS result_limit FROM part""",
    "meta_store": """SELECT k + 1 AS id, code AS alias, code, meta_type, 'text' AS elastic_type, true AS enabled, false AS searchable, false AS aggregatable,
        CAST(1 AS FLOAT) AS weight, k + 500 AS position, 1 AS operator, 1 AS display_type, 0 AS result_limit
        FROM (SELECT concat(lower(replace(p_name, ' ', '_')), '_', CAST(p_size AS VARCHAR)) AS code,
                     CASE WHEN p_size % 2 = 0 THEN 'feature' ELSE 'attribute' END AS meta_type, min(p_partkey) AS k
              FROM part WHERE p_partkey % 10 = 0 GROUP BY 1, 2) m""",
    "label_json": """SELECT p_partkey AS id_file, concat('{"', lower(replace(p_name, ' ', '_')), '":{"en":"', p_name, '","nl":"', p_type,
        '"},"size_', CAST(p_size AS VARCHAR), '":{"en":"', CAST(p_size AS VARCHAR), '"}}') AS body FROM part""",
    "date_text": """SELECT o_orderkey AS id, CASE o_orderkey % 4 WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(o_orderdate, '%Y-%m-%d')
        WHEN 2 THEN CAST(epoch_ms(o_orderdate) AS VARCHAR) ELSE concat('on ', strftime(o_orderdate, '%Y-%m-%d')) END AS text FROM orders""",
    "title_text": "SELECT doc_id AS id, split_part(text, chr(10), 1) AS title FROM documents",
    "doc_token": f"SELECT doc_id, lang, unnest({words('lower(text)')}) AS token FROM documents",
    "stop_word": """SELECT t.lang, token FROM (SELECT lang, token, count(DISTINCT doc_id) AS n FROM doc_token GROUP BY 1, 2) t
        JOIN (SELECT lang, count(*) AS n_docs FROM documents GROUP BY 1) d ON t.lang = d.lang WHERE n * 10 >= n_docs * 3""",
    "stem_dict": f"""SELECT form, CASE WHEN form LIKE '%ing' THEN left(form, length(form) - 3) WHEN form LIKE '%en' THEN left(form, length(form) - 2)
            ELSE left(form, length(form) - 1) END AS stem
        FROM (SELECT DISTINCT unnest({blanks('lower(text)')}) AS form FROM documents) f
        WHERE length(form) > 4 AND (form LIKE '%ing' OR form LIKE '%s' OR form LIKE '%en')""",
    # Derived steps that several checks share.
    "ancestor": """SELECT x.id_category, c.id_category AS id_ancestor, c.level_depth, c.active
        FROM category x JOIN category c ON c.nleft <= x.nleft AND c.nright >= x.nright""",
    "path_any": """SELECT cl.id_category, cl.id_lang, coalesce(p.path, '') AS path FROM category_lang cl LEFT JOIN (
            SELECT a.id_category, n.id_lang, string_agg(n.name, ' /// ' ORDER BY a.level_depth) AS path
            FROM ancestor a JOIN category_lang n ON n.id_category = a.id_ancestor WHERE a.id_ancestor NOT IN (1, 2) GROUP BY 1, 2) p
        ON p.id_category = cl.id_category AND p.id_lang = cl.id_lang""",
    "path_active": """SELECT cl.id_category, cl.id_lang, coalesce(p.path, '') AS path FROM category_lang cl LEFT JOIN (
            SELECT a.id_category, n.id_lang, string_agg(n.name, ' /// ' ORDER BY a.level_depth) AS path
            FROM ancestor a JOIN category_lang n ON n.id_category = a.id_ancestor WHERE a.id_ancestor NOT IN (1, 2) AND a.active GROUP BY 1, 2) p
        ON p.id_category = cl.id_category AND p.id_lang = cl.id_lang""",
    "entity_row": """SELECT ps.id_product AS id_entity, ps.id_shop, pl.id_lang, ps.date_upd, ps.price AS base_price
        FROM product p JOIN product_shop ps ON ps.id_product = p.id_product JOIN product_lang pl ON pl.id_product = p.id_product WHERE ps.active""",
    "changed_row": """SELECT r.id_entity, r.id_shop, r.id_lang, r.date_upd FROM entity_row r
        LEFT JOIN index_status s ON s.id_entity = r.id_entity AND s.id_shop = r.id_shop AND s.id_lang = r.id_lang AND s.index = 'product'
        WHERE s.error IS NULL AND (s.date_upd IS NULL OR s.date_upd <> r.date_upd)""",
    "failure": """SELECT id_entity, type AS index, CAST(regexp_extract(route, '([a-zA-Z]+)_([0-9]+)_([0-9]+)', 2) AS INT) AS id_shop,
            CAST(regexp_extract(route, '([a-zA-Z]+)_([0-9]+)_([0-9]+)', 3) AS INT) AS id_lang,
            CASE WHEN reason IS NULL THEN 'Unknown error' ELSE concat_ws(' ', reason, caused_by) END AS error
        FROM bulk_result WHERE substring(CAST(status AS VARCHAR), 1, 1) <> '2'""",
    "price_part": """SELECT r.id_entity, r.id_shop, r.id_lang, r.base_price,
            CAST(r.base_price AS DECIMAL(18,4)) AS net, (CAST(100 AS DECIMAL(7,3)) + CAST(coalesce(t.rate, 0) AS DECIMAL(7,3))) * 0.01 AS gross,
            CAST(1 AS DECIMAL(5,4)) - CAST(coalesce(s.reduction, 0) AS DECIMAL(5,4)) AS part_left
        FROM entity_row r JOIN product p ON p.id_product = r.id_entity
        LEFT JOIN (SELECT id_tax_rules_group, arg_min(rate, id_tax_rule) AS rate FROM tax_rule GROUP BY 1) t ON t.id_tax_rules_group = p.id_tax_rules_group
        LEFT JOIN specific_price s ON s.id_product = r.id_entity""",
    "price": """SELECT id_entity, id_shop, id_lang, base_price AS price, base_price AS original_price,
            CAST(round(net * gross, 2) AS DOUBLE) AS original_price_incl_tax, CAST(round(net * part_left, 2) AS DOUBLE) AS special_price,
            CAST(round(net * part_left * gross, 2) AS DOUBLE) AS special_price_incl_tax FROM price_part""",
    "stock": """SELECT id_product, min(id_stock) AS id_stock, CAST(sum(quantity) AS BIGINT) AS quantity, CAST(sum(supplier_qty) AS BIGINT) AS supplier_qty
        FROM stock_available GROUP BY 1""",
    "sale": "SELECT product_id AS id_product, CAST(sum(product_quantity) AS BIGINT) AS ordered_qty, count(*) AS sales FROM order_detail GROUP BY 1",
    "hit": """SELECT id_object AS id_product, CAST(coalesce(sum(counter), 0) AS BIGINT) AS pageviews
        FROM page LEFT JOIN page_viewed ON page.id_page = page_viewed.id_page WHERE page_type = 'product' GROUP BY 1""",
    "gallery": f"""SELECT id_product, string_agg(concat({image_path('id_image')}, ':', CAST(position AS VARCHAR), ':', legend, ':image'), '|' ORDER BY position) AS gallery,
            min(CASE WHEN cover THEN id_image END) AS cover_image FROM image GROUP BY 1""",
    "cat_text": """SELECT cp.id_product, cl.id_lang, cp.id_category, c.active, c.level_depth, c.id_parent, cl.name, cl.link_rewrite AS slug, p.path
        FROM category_product cp JOIN category c ON c.id_category = cp.id_category JOIN category_lang cl ON cl.id_category = cp.id_category
        JOIN path_any p ON p.id_category = cp.id_category AND p.id_lang = cl.id_lang""",
    "cat_list": """SELECT id_product, id_lang, string_agg(CAST(id_category AS VARCHAR), ',' ORDER BY id_category) AS category_ids,
            string_agg(concat_ws(':', CAST(id_category AS VARCHAR), name, CAST(level_depth AS VARCHAR), slug, CAST(id_parent AS VARCHAR)), '|' ORDER BY id_category)
                FILTER (WHERE active) AS category,
            list_distinct(list(string_split(path, ' /// ')[-1] ORDER BY id_category) FILTER (WHERE path <> '')) AS leaves_any
        FROM cat_text GROUP BY 1, 2""",
    "leaf_list": """SELECT id_product, id_lang, string_agg(leaf, '|' ORDER BY k) AS categories_without_path FROM (
            SELECT id_product, id_lang, string_split(path, ' /// ')[-1] AS leaf, min(id_category) AS k FROM cat_text WHERE path <> '' GROUP BY 1, 2, 3) l
        WHERE leaf NOT IN ('', '0') GROUP BY 1, 2""",
    "feature_first": f"""SELECT id_product, id_lang, {code('name')} AS code, arg_min(value, position) AS value FROM feature_product GROUP BY 1, 2, 3""",
    "feature_text": f"""SELECT id_product, id_lang, string_agg(concat(code, '=', array_to_string({split_trim('lower(value)')}, ',')), '|' ORDER BY code) AS features
        FROM feature_first WHERE code NOT IN ('condition') GROUP BY 1, 2""",
    "spec_text": """SELECT id_product, id_lang, string_agg(concat(name, '=', value), '|' ORDER BY name) AS specs FROM (
            SELECT id_product, id_lang, name, arg_max(value, position) AS value FROM feature_product GROUP BY 1, 2, 3) s GROUP BY 1, 2""",
}


def with_views(body: str) -> str:
    """The query with the views it needs, and the views those need, as leading CTEs."""
    needed: set[str] = set()

    def visit(text: str) -> None:
        for word in set(re.findall(r"[a-z_]+", text)):
            if word in VIEWS and word not in needed:
                needed.add(word)
                visit(VIEWS[word])

    visit(body)
    # Definition order is dependency order, except that a name may also be a column; spare views do no harm.
    names = [n for n in VIEWS if n in needed]
    if not names:
        return body
    return "WITH " + ", ".join(f"{n} AS ({VIEWS[n]})" for n in names) + " " + body

"""Document builders and the product, category and brand facts they are made of."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv
from shelfweave.functions import scalars as S
from shelfweave.operators import category as C
from shelfweave.operators import entities as E
from shelfweave.operators import metas as M
from shelfweave.operators import product as P
from shelfweave.operators.registry import ENTITIES, schema_catalog
from shelfweave.plans import oracle_views as V
from shelfweave.plans.registry import query


def joined(values, separator: str = "|") -> Column:
    """Text of a list column, NULL for an empty list, so that it compares across engines."""
    text = F.array_join(values, separator)
    return F.when(F.size(values) > 0, text)


def pair_text(pairs) -> Column:
    """Sorted ``key=value`` text of a map column."""
    return joined(F.array_sort(F.transform(F.map_entries(pairs), lambda e: F.concat_ws("=", e["key"], e["value"]))))


def struct_text(items, names, separator: str = "|") -> Column:
    return joined(F.transform(items, lambda s: F.concat_ws(":", *[s[n].cast("string") for n in names])), separator)


def feature_text(features) -> Column:
    return joined(F.array_sort(F.transform(F.map_entries(features), lambda e: F.concat_ws("=", e["key"], F.array_join(e["value"], ",")))))


# --- product -------------------------------------------------------------------------------------

_CORE = ["sku", "name", "attribute_set_id", "status", "visibility", "type_id", "created_at", "updated_at", "required_options", "has_options",
         "tax_class_id", "minimal_quantity", "weight", "condition", "ean13", "url_key", "short_description", "description"]
_CORE_SQL = """p.reference AS sku, l.name, 0 AS attribute_set_id, 1 AS status, 3 AS visibility, 'simple' AS type_id, p.date_add AS created_at,
    r.date_upd AS updated_at, 0 AS required_options, false AS has_options, p.id_tax_rules_group AS tax_class_id, p.minimal_quantity, p.weight,
    p.condition, p.ean13, l.link_rewrite AS url_key, l.description_short AS short_description, l.description"""
_ROWS_SQL = """FROM entity_row r JOIN product p ON p.id_product = r.id_entity
    JOIN product_lang l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang"""
_ID_SQL = "r.id_entity AS id, r.id_lang AS elastic_id_lang, r.id_shop AS elastic_id_shop, 'product' AS elastic_type"
_ID = ["id", "elastic_id_lang", "elastic_id_shop", "elastic_type"]


@query("product_core", f"SELECT {_ID_SQL}, {_CORE_SQL} {_ROWS_SQL}")
def _(c):
    return P.product_documents(c, fields=_CORE).select(*_ID, *_CORE)


@query("product_flags", f"""SELECT {_ID_SQL}, p.is_virtual, p.on_sale, p.online_only, p.show_price, p.is_new AS new, p.available_for_order AS is_salable,
    p.customization_required, true AS is_active, l.available_now NOT IN ('', '0') AS available_now, coalesce(l.available_later NOT IN ('', '0'), false) AS available_later {_ROWS_SQL}""")
def _(c):
    flags = ["is_virtual", "on_sale", "online_only", "show_price", "new", "is_salable", "customization_required", "is_active"]
    docs = P.product_documents(c, fields=flags).select(*_ID, *flags)
    texts = c.product_lang.select(
        F.col("id_product").alias("id"), F.col("id_lang").alias("elastic_id_lang"), S.php_bool(F.col("available_now")).alias("available_now"),
        S.php_bool(F.col("available_later")).alias("available_later"),
    )
    return docs.join(texts, ["id", "elastic_id_lang"])


@query("product_prices", "SELECT id_entity AS id, id_shop AS elastic_id_shop, id_lang AS elastic_id_lang, price, original_price, original_price_incl_tax, special_price, special_price_incl_tax FROM price")
def _(c):
    prices = ["price", "original_price", "original_price_incl_tax", "special_price", "special_price_incl_tax"]
    return P.product_documents(c, fields=prices).select("id", "elastic_id_shop", "elastic_id_lang", *prices)


@query("product_pageviews", "SELECT id_product, pageviews FROM hit")
def _(c):
    return P.views(c.page, c.page_viewed)


@query("product_sales", "SELECT id_product, ordered_qty, sales FROM sale")
def _(c):
    return P.sales(c.order_detail)


@query("product_stock", f"""SELECT p.id_product, l.id_lang, s.id_stock AS stock_id, coalesce(s.quantity, 0) + coalesce(s.supplier_qty, 0) AS qty,
    coalesce(s.quantity, 0) AS qty_available_now, coalesce(s.supplier_qty, 0) AS qty_available_later,
    CAST(coalesce(s.quantity, 0) <> 0 OR p.out_of_stock = 1 AS INT) AS is_in_stock, true AS is_qty_decimal, 1 AS min_sale_qty, false AS manage_stock,
    {V.php_int('l.available_now')} AS handling_time, {V.php_int('l.available_later')} AS handling_time_oos
    FROM product p JOIN product_lang l ON l.id_product = p.id_product LEFT JOIN stock s ON s.id_product = p.id_product""")
def _(c):
    rows = c.product.join(P.stock(c.stock_available), "id_product", "left").join(c.product_lang, "id_product")
    return rows.select("id_product", "id_lang", P.stock_struct().alias("stock")).select(
        "id_product", "id_lang", *[f"stock.{n}" for n in ("stock_id", "qty", "qty_available_now", "qty_available_later", "is_in_stock", "is_qty_decimal", "min_sale_qty", "manage_stock", "handling_time", "handling_time_oos")]
    )


@query("product_media", f"""SELECT l.id_product, l.id_lang, g.gallery, {V.image_path('g.cover_image')} AS image,
    CASE WHEN g.cover_image IS NULL THEN 'en-default-large_default.jpg' ELSE concat('/', CAST(g.cover_image AS VARCHAR), '-large_default/', l.link_rewrite, '.jpg') END AS image_link_large,
    CASE WHEN g.cover_image IS NULL THEN 'en-default-small_default.jpg' ELSE concat('/', CAST(g.cover_image AS VARCHAR), '-small_default/', l.link_rewrite, '.jpg') END AS image_link_small
    FROM product_lang l LEFT JOIN gallery g ON g.id_product = l.id_product""")
def _(c):
    rows = c.product_lang.select("id_product", "id_lang", "link_rewrite").join(P.media(c.image), "id_product", "left")
    cover, slug = F.col("cover_image"), F.col("link_rewrite")
    return rows.select(
        "id_product", "id_lang", struct_text("gallery", ("image", "pos", "lab", "typ")).alias("gallery"), S.image_path(cover).alias("image"),
        S.cover_link(cover, slug, "large").alias("image_link_large"), S.cover_link(cover, slug, "small").alias("image_link_small"),
    )


@query("product_specs", "SELECT id_product, id_lang, specs FROM spec_text")
def _(c):
    lists = P.feature_lists(c.feature_product)
    rows = c.feature_product.select("id_product", "id_lang").distinct().join(lists, "id_product")
    return rows.select("id_product", "id_lang", pair_text(P.spec_map(P.features_in(F.col("features_all"), F.col("id_lang")))).alias("specs"))


@query("product_features", "SELECT r.id_entity AS id, r.id_lang AS elastic_id_lang, r.id_shop AS elastic_id_shop, f.features FROM entity_row r LEFT JOIN feature_text f ON f.id_product = r.id_entity AND f.id_lang = r.id_lang")
def _(c):
    return P.product_documents(c).select("id", "elastic_id_lang", "elastic_id_shop", feature_text("features").alias("features"))


@query("product_categories", """SELECT r.id_entity AS id, r.id_lang AS elastic_id_lang, r.id_shop AS elastic_id_shop, c.category
    FROM entity_row r LEFT JOIN cat_list c ON c.id_product = r.id_entity AND c.id_lang = r.id_lang""")
def _(c):
    docs = P.product_documents(c, fields=["category"])
    return docs.select("id", "elastic_id_lang", "elastic_id_shop", struct_text("category", ("category_id", "name", "level_depth", "slug", "id_parent")).alias("category"))


@query("product_category_ids", "SELECT id_product, string_agg(CAST(id_category AS VARCHAR), ',' ORDER BY id_category) AS category_ids FROM category_product GROUP BY 1")
def _(c):
    ids = P.category_ids(c.category_product)
    return ids.select("id_product", joined(F.transform("category_ids", lambda i: i.cast("string")), ",").alias("category_ids"))


@query("category_leaf_names", "SELECT r.id_entity AS id, r.id_lang, r.id_shop, l.categories_without_path FROM entity_row r LEFT JOIN leaf_list l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang")
def _(c):
    return P.product_documents(c, fields=["categories_without_path"]).select(
        "id", F.col("elastic_id_lang").alias("id_lang"), F.col("elastic_id_shop").alias("id_shop"), joined("categories_without_path").alias("categories_without_path")
    )


@query("product_brand", """SELECT p.id_product, cl.id_lang, m.name AS manufacturer, m.link_rewrite AS manufacturer_link, concat('/m/', CAST(p.id_manufacturer AS VARCHAR), '.jpg') AS manufacturer_logo,
    s.supplier_name, cl.name AS category_name FROM product p LEFT JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer
    LEFT JOIN supplier_name s ON s.id_supplier = p.id_supplier LEFT JOIN category_lang cl ON cl.id_category = p.id_category_default""")
def _(c):
    names = c.category_lang.select(F.col("id_category").alias("id_category_default"), "id_lang", F.col("name").alias("category_name"))
    rows = P.brand(c.product, c.manufacturer, c.supplier_name).join(names, "id_category_default", "left")
    logo = F.concat(F.lit("/m/"), F.col("id_manufacturer").cast("string"), F.lit(".jpg"))
    return rows.select("id_product", "id_lang", "manufacturer", "manufacturer_link", logo.alias("manufacturer_logo"), "supplier_name", "category_name")


@query("name_autocomplete", """SELECT r.id_entity AS id, r.id_lang, r.id_shop, concat(coalesce(l.name, ''), ' ', p.reference, ' ', p.ean13, ' ', CAST(r.id_entity AS VARCHAR), ' ', coalesce(m.name, '')) AS name_autocomplete
    FROM entity_row r JOIN product p ON p.id_product = r.id_entity JOIN product_lang l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang LEFT JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer""")
def _(c):
    return P.product_documents(c, fields=["name_autocomplete"]).select("id", F.col("elastic_id_lang").alias("id_lang"), F.col("elastic_id_shop").alias("id_shop"), "name_autocomplete")


@query("trimmed_reference", "SELECT id_product, substring(reference, 4) AS trimmed_reference FROM product")
def _(c):
    return c.product.select("id_product", F.substring("reference", 4, 1 << 30).alias("trimmed_reference"))


@query("product_links", """SELECT r.id_entity AS id, r.id_lang, r.id_shop, concat('/', CAST(r.id_lang AS VARCHAR), '/', CAST(r.id_entity AS VARCHAR), '-', l.link_rewrite, '.html') AS link
    FROM entity_row r JOIN product_lang l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang""")
def _(c):
    return P.product_documents(c, fields=["link"]).select("id", F.col("elastic_id_lang").alias("id_lang"), F.col("elastic_id_shop").alias("id_shop"), "link")


@query("group_price_pivot", """SELECT id_product, max(CASE WHEN id_group = 1 THEN price END) AS price_tax_excl_1, max(CASE WHEN id_group = 2 THEN price END) AS price_tax_excl_2,
    max(CASE WHEN id_group = 3 THEN price END) AS price_tax_excl_3 FROM group_price GROUP BY 1""")
def _(c):
    return P.group_price_pivot(c.group_price, [1, 2, 3])


_DOC_SQL = f"""SELECT {_ID_SQL}, {_CORE_SQL},
    concat(coalesce(l.name, ''), ' ', p.reference, ' ', p.ean13, ' ', CAST(r.id_entity AS VARCHAR), ' ', coalesce(m.name, '')) AS name_autocomplete,
    pr.price, pr.special_price, pr.special_price_incl_tax, pr.original_price, pr.original_price_incl_tax,
    c.category_ids, c.category, p.reference, p.available_for_order AS is_salable, true AS is_active, l.link_rewrite AS request_path, l.link_rewrite AS url_path,
    coalesce(s.quantity, 0) + coalesce(s.supplier_qty, 0) AS stock_total, coalesce(s.quantity, 0) <> 0 OR p.out_of_stock = 1 AS in_stock,
    {V.php_int('l.available_now')} AS handling_time, g.gallery AS media_gallery, {V.image_path('g.cover_image')} AS image, ll.categories_without_path,
    p.customization_required, p.date_add, r.date_upd, p.is_virtual,
    concat('/', CAST(r.id_lang AS VARCHAR), '/', CAST(r.id_entity AS VARCHAR), '-', l.link_rewrite, '.html') AS link, p.id_tax_rules_group,
    m.link_rewrite AS manufacturer_link, m.name AS manufacturer, concat('/m/', CAST(p.id_manufacturer AS VARCHAR), '.jpg') AS manufacturer_logo,
    p.id_manufacturer AS manufacturer_id, p.is_new AS new, p.show_price, p.on_sale, p.online_only, coalesce(sa.ordered_qty, 0) AS ordered_qty,
    coalesce(s.quantity, 0) AS stock_qty, coalesce(h.pageviews, 0) AS pageviews, coalesce(sa.sales, 0) AS sales, l.meta_title, sp.specs, f.features
    FROM entity_row r JOIN product p ON p.id_product = r.id_entity
    JOIN product_lang l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang
    JOIN price pr ON pr.id_entity = r.id_entity AND pr.id_shop = r.id_shop AND pr.id_lang = r.id_lang
    LEFT JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer LEFT JOIN stock s ON s.id_product = r.id_entity
    LEFT JOIN sale sa ON sa.id_product = r.id_entity LEFT JOIN hit h ON h.id_product = r.id_entity LEFT JOIN gallery g ON g.id_product = r.id_entity
    LEFT JOIN cat_list c ON c.id_product = r.id_entity AND c.id_lang = r.id_lang LEFT JOIN leaf_list ll ON ll.id_product = r.id_entity AND ll.id_lang = r.id_lang
    LEFT JOIN spec_text sp ON sp.id_product = r.id_entity AND sp.id_lang = r.id_lang LEFT JOIN feature_text f ON f.id_product = r.id_entity AND f.id_lang = r.id_lang"""


def flat_products(docs):
    """Product documents with their nested parts as text."""
    return docs.select(
        *_ID, *_CORE, "name_autocomplete", "price", "special_price", "special_price_incl_tax", "original_price", "original_price_incl_tax",
        joined(F.transform("category_ids", lambda i: i.cast("string")), ",").alias("category_ids"),
        struct_text("category", ("category_id", "name", "level_depth", "slug", "id_parent")).alias("category"),
        "reference", "is_salable", "is_active", "request_path", "url_path", F.col("stock.qty").alias("stock_total"), "in_stock",
        F.col("stock.handling_time").alias("handling_time"), struct_text("media_gallery", ("image", "pos", "lab", "typ")).alias("media_gallery"), "image",
        joined("categories_without_path").alias("categories_without_path"), "customization_required", "date_add", "date_upd", "is_virtual", "link",
        "id_tax_rules_group", "manufacturer_link", "manufacturer", "manufacturer_logo", "manufacturer_id", "new", "show_price", "on_sale", "online_only",
        "ordered_qty", "stock_qty", "pageviews", "sales", F.col("meta.title").alias("meta_title"), pair_text("specs").alias("specs"), feature_text("features").alias("features"),
    )


@query("product_documents", _DOC_SQL)
def _(c):
    """The flagship: whole product documents."""
    return flat_products(P.product_documents(c))


@query("product_blacklisted", f"SELECT * EXCLUDE (pageviews, sales, description) FROM ({_DOC_SQL}) d")
def _(c):
    """Without the hidden fields, then only the enabled ones (all but one here)."""
    flat = P.drop_hidden_fields(flat_products(P.product_documents(c)))
    return P.enabled_fields(flat, [f for f in flat.columns if f != "description"])


@query("documents_json", """SELECT r.id_entity AS id, r.id_shop, r.id_lang, CAST(to_json({'id': r.id_entity, 'elastic_id_lang': r.id_lang, 'elastic_id_shop': r.id_shop,
        'elastic_type': 'product', 'sku': p.reference, 'name': l.name, 'on_sale': p.on_sale, 'category_ids': coalesce(c.ids, [])}) AS VARCHAR) AS body
    FROM entity_row r JOIN product p ON p.id_product = r.id_entity JOIN product_lang l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang
    LEFT JOIN (SELECT id_product, list(id_category ORDER BY id_category) AS ids FROM category_product GROUP BY 1) c ON c.id_product = r.id_entity""")
def _(c):
    docs = P.product_documents(c, fields=["sku", "name", "on_sale", "category_ids"])
    body = F.to_json(F.struct(*_ID, "sku", "name", "on_sale", "category_ids"))
    return docs.select("id", F.col("elastic_id_shop").alias("id_shop"), F.col("elastic_id_lang").alias("id_lang"), body.alias("body"))


@query("documents_json_whole", _DOC_SQL)
def _(c):
    """Every field of every product document through its JSON text: what is read back from the text alone is the document."""
    docs = P.product_documents(c)
    body = docs.select(F.to_json(F.struct(*docs.columns)).alias("body"))
    return flat_products(body.select(F.from_json("body", docs.schema).alias("d")).select("d.*"))


@query("aggregatable_copies", f"""SELECT r.id_entity AS id, r.id_lang, r.id_shop, {V.slug('l.name')} AS name_agg, {V.slug('m.name')} AS manufacturer_agg, ll.agg AS categories_without_path_agg
    FROM entity_row r JOIN product p ON p.id_product = r.id_entity JOIN product_lang l ON l.id_product = r.id_entity AND l.id_lang = r.id_lang
    LEFT JOIN manufacturer m ON m.id_manufacturer = p.id_manufacturer
    LEFT JOIN (SELECT id_product, id_lang, array_to_string(list_transform(string_split(categories_without_path, '|'), lambda x: {V.slug('x')}), '|') AS agg FROM leaf_list) ll
        ON ll.id_product = r.id_entity AND ll.id_lang = r.id_lang""")
def _(c):
    docs = P.product_documents(c, fields=["sku", "name", "manufacturer", "categories_without_path", "price"]).withColumn("name_color_code", F.col("sku"))
    kinds = {"name": "text", "manufacturer": "string", "categories_without_path": "text", "name_color_code": "text", "price": "float"}
    copies = P.aggregatable_copies(docs, kinds)
    assert "name_color_code_agg" not in copies.columns and "price_agg" not in copies.columns
    return copies.select(
        "id", F.col("elastic_id_lang").alias("id_lang"), F.col("elastic_id_shop").alias("id_shop"), "name_agg", "manufacturer_agg",
        joined("categories_without_path_agg").alias("categories_without_path_agg"),
    )


# --- category ------------------------------------------------------------------------------------

@query("category_paths", "SELECT a.id_category, a.id_lang, a.path AS path_active, b.path AS path_any FROM path_active a JOIN path_any b ON a.id_category = b.id_category AND a.id_lang = b.id_lang")
def _(c):
    active = C.category_paths(c.category, c.category_lang, active_only=True).withColumnRenamed("path", "path_active")
    whole = C.category_paths(c.category, c.category_lang, active_only=False).withColumnRenamed("path", "path_any")
    return active.join(whole, ["id_category", "id_lang"])


@query("category_id_path", "SELECT id_category, string_agg(CAST(id_ancestor AS VARCHAR), '/' ORDER BY level_depth) AS path FROM ancestor GROUP BY 1")
def _(c):
    return C.id_paths(c.category)


@query("category_children", "SELECT id_parent AS id_category, string_agg(CAST(id_category AS VARCHAR), ',' ORDER BY id_category) AS children, CAST(count(*) AS INT) AS children_count FROM category WHERE active GROUP BY 1")
def _(c):
    return C.children(c.category)


@query("category_product_count", "SELECT id_category, count(DISTINCT id_product) AS product_count FROM category_product GROUP BY 1")
def _(c):
    return C.product_counts(c.category_product)


@query("category_filters", f"SELECT id_category, id_lang, array_to_string({V.split_trim('meta_keywords')}, '|') AS filters FROM category_lang")
def _(c):
    return c.category_lang.select("id_category", "id_lang", joined(C.filters_of(F.col("meta_keywords"))).alias("filters"))


@query("category_documents", f"""SELECT c.id_category AS id, l.id_lang AS elastic_id_lang, shop.id_shop AS elastic_id_shop, 'category' AS elastic_type,
    CAST(c.id_parent AS INT) AS parent_id, l.name, c.level_depth AS level, coalesce(n.n, 0) AS product_count, p.path, 1 AS include_in_menu, c.active AS is_active,
    l.link_rewrite AS url_key, l.link_rewrite AS request_path, l.meta_keywords AS keywords, array_to_string({V.split_trim('l.meta_keywords')}, '|') AS filters,
    coalesce(k.children, '') AS children, coalesce(k.n, 0) AS children_count
    FROM category c JOIN category_lang l ON l.id_category = c.id_category CROSS JOIN shop
    JOIN (SELECT id_category, string_agg(CAST(id_ancestor AS VARCHAR), '/' ORDER BY level_depth) AS path FROM ancestor GROUP BY 1) p ON p.id_category = c.id_category
    LEFT JOIN (SELECT cp.id_category, ps.id_shop, count(*) AS n FROM category_product cp JOIN product_shop ps ON ps.id_product = cp.id_product
        WHERE ps.active GROUP BY 1, 2) n ON n.id_category = c.id_category AND n.id_shop = shop.id_shop
    LEFT JOIN (SELECT id_parent, string_agg(CAST(id_category AS VARCHAR), ',' ORDER BY id_category) AS children, CAST(count(*) AS INT) AS n FROM category WHERE active GROUP BY 1) k
        ON k.id_parent = c.id_category WHERE c.active""")
def _(c):
    docs = C.category_documents(c.category, c.category_lang, c.category_product, c.product_shop, c.shop, nested=False)
    return docs.select(
        *_ID, "parent_id", "name", "level", "product_count", "path", "include_in_menu", "is_active", "url_key", "request_path",
        F.col("meta.keywords").alias("keywords"), joined("filters").alias("filters"), "children", "children_count",
    )


_NODE = "concat('{\"id\":', CAST(id_category AS VARCHAR), ',\"name\":', CAST(to_json(name) AS VARCHAR), ',\"children_count\":', CAST(n AS VARCHAR), ',\"children_data\":[', inside, ']}')"


def _tree_sql() -> str:
    parts = ["node AS (SELECT c.id_category, c.id_parent, c.level_depth, c.active, l.id_lang, l.name FROM category c JOIN category_lang l ON l.id_category = c.id_category)",
             f"t4 AS (SELECT *, {_NODE} AS tree FROM (SELECT *, 0 AS n, '' AS inside FROM node WHERE level_depth = 4) x)"]
    for level in (3, 2, 1, 0):
        parts.append(f"""t{level} AS (SELECT *, {_NODE} AS tree FROM (SELECT node.*, coalesce(k.n, 0) AS n, coalesce(k.inside, '') AS inside FROM node LEFT JOIN (
            SELECT id_parent, id_lang, CAST(count(*) AS INT) AS n, string_agg(tree, ',' ORDER BY id_category) AS inside FROM t{level + 1} WHERE active GROUP BY 1, 2) k
            ON k.id_parent = node.id_category AND k.id_lang = node.id_lang WHERE level_depth = {level}) x)""")
    union = " UNION ALL ".join(f"SELECT id_category, id_lang, n AS children_count, tree FROM t{level}" for level in range(5))
    return f"SELECT * FROM (WITH {', '.join(parts)} {union}) tree"


@query("category_tree", _tree_sql())
def _(c):
    return C.tree_json(c.category, c.category_lang)


def _nested_sql() -> str:
    """Whole documents inside each other: one step a level, fields in alphabetical order as the text of a VARIANT has them."""
    fields = {
        "children": "coalesce(kids, '')", "children_count": "CAST(coalesce(n_kids, 0) AS INT)", "children_data": "inside", "created_at": "strftime(date_add, '%Y-%m-%d')",
        "elastic_id_lang": "id_lang", "elastic_id_shop": "id_shop", "elastic_type": "'category'", "filters": V.split_trim("meta_keywords"), "id": "id_category",
        "include_in_menu": "1", "is_active": "active", "level": "level_depth", "meta": "{'description': NULL, 'keywords': meta_keywords, 'title': name}",
        "meta_title": "name", "name": "name", "parent_id": "id_parent", "path": "path", "position": "position", "product_count": "coalesce(n_products, 0)",
        "request_path": "link_rewrite", "slug": "link_rewrite", "updated_at": "strftime(date_upd, '%Y-%m-%d')", "url_key": "link_rewrite", "url_path": "link_rewrite",
    }
    node = "to_json({" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "})"
    parts = ["""node AS (SELECT c.*, l.id_lang, l.name, l.link_rewrite, l.meta_keywords, shop.id_shop, p.path, n.n AS n_products, k.kids, k.n_kids
        FROM category c JOIN category_lang l ON l.id_category = c.id_category CROSS JOIN (SELECT id_shop FROM shop) shop
        JOIN (SELECT id_category, string_agg(CAST(id_ancestor AS VARCHAR), '/' ORDER BY level_depth) AS path FROM ancestor GROUP BY 1) p ON p.id_category = c.id_category
        LEFT JOIN (SELECT cp.id_category, ps.id_shop, count(*) AS n FROM category_product cp JOIN product_shop ps ON ps.id_product = cp.id_product
            WHERE ps.active GROUP BY 1, 2) n ON n.id_category = c.id_category AND n.id_shop = shop.id_shop
        LEFT JOIN (SELECT id_parent AS parent, string_agg(CAST(id_category AS VARCHAR), ',' ORDER BY id_category) AS kids, count(*) AS n_kids FROM category WHERE active GROUP BY 1) k
            ON k.parent = c.id_category WHERE c.active)""",
        f"d4 AS (SELECT *, {node} AS doc FROM (SELECT *, CAST([] AS JSON[]) AS inside FROM node WHERE level_depth = 4) x)"]
    for level in (3, 2, 1, 0):
        parts.append(f"""d{level} AS (SELECT *, {node} AS doc FROM (SELECT node.*, coalesce(below.inside, CAST([] AS JSON[])) AS inside FROM node LEFT JOIN (
            SELECT id_parent AS parent, id_lang AS lang_of, id_shop AS shop_of, list(doc ORDER BY id_category) AS inside FROM d{level + 1} GROUP BY 1, 2, 3) below
            ON parent = node.id_category AND lang_of = node.id_lang AND shop_of = node.id_shop WHERE level_depth = {level}) x)""")
    union = " UNION ALL ".join(f"""SELECT id_category AS id, id_lang AS elastic_id_lang, id_shop AS elastic_id_shop, position, CAST(date_add AS VARCHAR) AS created_at,
        CAST(date_upd AS VARCHAR) AS updated_at, CAST(coalesce(n_kids, 0) AS INT) AS children_count, CAST(to_json(inside) AS VARCHAR) AS children_data FROM d{level}""" for level in range(5))
    return f"SELECT * FROM (WITH {', '.join(parts)} {union}) nested"


@query("category_nested", _nested_sql())
def _(c):
    """Category documents with the whole documents of their children, as JSON text."""
    docs = C.category_documents(c.category, c.category_lang, c.category_product, c.product_shop, c.shop)
    return docs.select(
        "id", "elastic_id_lang", "elastic_id_shop", "position", F.col("created_at").cast("string").alias("created_at"), F.col("updated_at").cast("string").alias("updated_at"),
        "children_count", F.to_json(F.to_variant_object("children_data")).alias("children_data"),
    )


# --- other entities ------------------------------------------------------------------------------

_EACH = "CROSS JOIN (SELECT * FROM lang WHERE active) g CROSS JOIN shop"


@query("attribute_documents", f"""SELECT a.id_attribute_group AS id, g.id_lang AS elastic_id_lang, shop.id_shop AS elastic_id_shop, 'attribute' AS elastic_type,
    {V.code('a.name')} AS attribute_code, 'select' AS frontend_input, a.name AS frontend_label, true AS is_searchable, true AS is_configurable, o.options
    FROM attribute_group a LEFT JOIN (SELECT id_attribute_group, string_agg(concat(CAST(id_attribute AS VARCHAR), ':', name), '|' ORDER BY position) AS options FROM attribute GROUP BY 1) o
    ON o.id_attribute_group = a.id_attribute_group {_EACH}""")
def _(c):
    docs = E.attribute_documents(c.attribute_group, c.attribute, c.lang, c.shop)
    return docs.select(
        F.col("id").cast("int").alias("id"), *_ID[1:], "attribute_code", "frontend_input", "frontend_label", "is_searchable", "is_configurable",
        struct_text("options", ("value", "label")).alias("options"),
    )


@query("taxrule_documents", f"""SELECT t.id_tax_rules_group AS id, g.id_lang AS elastic_id_lang, shop.id_shop AS elastic_id_shop, 'taxrule' AS elastic_type, t.name AS code,
    r.rates, r.tax_rates_ids, CAST(t.id_tax_rules_group AS VARCHAR) AS product_tax_class_ids FROM tax_rules_group t LEFT JOIN (
        SELECT id_tax_rules_group, string_agg(concat(CAST(id_tax_rule AS VARCHAR), ':', country_iso, ':0:', CAST(rate AS VARCHAR), ':*'), '|' ORDER BY id_tax_rule) AS rates,
            string_agg(CAST(id_tax_rule AS VARCHAR), ',' ORDER BY id_tax_rule) AS tax_rates_ids FROM tax_rule GROUP BY 1) r ON r.id_tax_rules_group = t.id_tax_rules_group {_EACH}""")
def _(c):
    docs = E.taxrule_documents(c.tax_rules_group, c.tax_rule, c.lang, c.shop)
    return docs.select(
        F.col("id").cast("int").alias("id"), *_ID[1:], "code", struct_text("rates", ("id", "tax_country_id", "tax_region_id", "rate", "tax_postcode")).alias("rates"),
        joined(F.transform("tax_rates_ids", lambda i: i.cast("string")), ",").alias("tax_rates_ids"),
        joined(F.transform("product_tax_class_ids", lambda i: i.cast("string")), ",").alias("product_tax_class_ids"),
    )


@query("manufacturer_documents", f"""SELECT m.id_manufacturer AS id, g.id_lang AS elastic_id_lang, shop.id_shop AS elastic_id_shop, 'manufacturer' AS elastic_type, m.name, m.link_rewrite AS url_key,
    m.active AS is_active, CASE WHEN o.id_manufacturer IS NULL THEN concat(g.iso_code, '-default') ELSE CAST(m.id_manufacturer AS VARCHAR) END AS image, coalesce(n.n, 0) AS product_count, m.name AS meta_title
    FROM manufacturer m LEFT JOIN logo_manifest o ON o.id_manufacturer = m.id_manufacturer
    LEFT JOIN (SELECT id_manufacturer, count(*) AS n FROM product GROUP BY 1) n ON n.id_manufacturer = m.id_manufacturer {_EACH} WHERE m.active""")
def _(c):
    docs = E.manufacturer_documents(c.manufacturer, c.product, c.logo_manifest, c.lang, c.shop)
    return docs.select(F.col("id").cast("int").alias("id"), *_ID[1:], "name", "url_key", "is_active", "image", "product_count", F.col("meta.title").alias("meta_title"))


@query("cms_documents", """SELECT d.id_cms AS id, g.id_lang AS elastic_id_lang, shop.id_shop AS elastic_id_shop, 'cms_page' AS elastic_type, d.active AS is_active, d.id_cms_category AS cms_category_id,
    d.meta_title AS title, d.content, concat('page-', CAST(d.id_cms AS VARCHAR), '-', d.iso_code) AS url_key
    FROM cms d JOIN (SELECT * FROM lang WHERE active) g ON g.iso_code = d.iso_code CROSS JOIN shop WHERE d.active""")
def _(c):
    return E.cms_documents(c.cms, c.lang, c.shop).select(*_ID, "is_active", "cms_category_id", "title", "content", "url_key")


@query("cms_category_documents", f"""SELECT m.id_cms_category AS id, g.id_lang AS elastic_id_lang, shop.id_shop AS elastic_id_shop, 'cmscategory' AS elastic_type, m.active AS is_active, m.id_parent AS parent_id,
    m.id_cms_category AS position, 1 AS level_depth, m.name, concat({V.code('m.name')}, '-', g.iso_code) AS slug FROM cms_category m {_EACH} WHERE m.active""")
def _(c):
    docs = E.cms_category_documents(c.cms_category, c.lang, c.shop)
    return docs.select(F.col("id").cast("int").alias("id"), *_ID[1:], "is_active", "parent_id", "position", "level_depth", "name", "slug")


@query("review_documents", """SELECT id, 0 AS elastic_id_lang, 0 AS elastic_id_shop, 'review' AS elastic_type, id_product AS product_id, 'product' AS review_entity,
    CAST(validate AND NOT deleted AS INT) AS review_status, date_add AS created_at, content AS detail, customer_name AS nickname, grade FROM review""")
def _(c):
    return E.review_documents(c.review).select(*_ID, "product_id", "review_entity", "review_status", "created_at", "detail", "nickname", "grade")


def _schema_sql() -> str:
    """The declarations as plain rows; which paths, analysers and formats follow from them is said here, from the rules, not by the code."""
    def text(v):
        return "NULL" if v is None else f"'{v}'"

    fields = [(e.name, a.name, None, a.type) for e in ENTITIES.values() for a in e.attributes if a.name != "id" and not a.children]
    fields += [(e.name, a.name, child, kind) for e in ENTITIES.values() for a in e.attributes for child, kind in a.children]
    rows = ", ".join("(" + ", ".join(text(v) for v in r) + ")" for r in fields)
    names = ", ".join(f"('{name}')" for name in ENTITIES)
    return f"""SELECT * FROM (WITH field AS (SELECT entity, CASE WHEN child IS NULL THEN top ELSE concat(top, '.', child) END AS path, top, child, type
            FROM (VALUES {rows}) v(entity, top, child, type) WHERE type IS NOT NULL),
        declared AS (
            SELECT entity, 'id' AS path, 'integer' AS type, NULL AS format, NULL AS analyzer, NULL AS search_analyzer FROM (VALUES {names}) e(entity)
            UNION ALL SELECT DISTINCT entity, top, 'nested', NULL, NULL, NULL FROM field WHERE child IS NOT NULL
            UNION ALL SELECT entity, path, type, CASE WHEN type = 'date' THEN '{fv.DATE_FORMATS}' END, NULL, NULL FROM field
            UNION ALL SELECT entity, concat(path, '.', variant), 'text', NULL, variant, CASE WHEN variant = 'autocomplete' THEN 'autocomplete_search' END FROM field
                CROSS JOIN (SELECT unnest(['trigram', 'reverse', 'lang_pl', 'lang_pl_ascii', 'lang_pl_trigram', 'autocomplete']) AS variant) w WHERE type IN ('text', 'keyword'))
    SELECT * FROM declared UNION ALL SELECT DISTINCT 'product', {V.code('name')}, 'keyword', NULL, NULL, NULL FROM feature_name
        WHERE {V.code('name')} NOT IN (SELECT path FROM declared WHERE entity = 'product')) s"""


@query("schema_catalog", _schema_sql())
def _(c):
    return schema_catalog(c.spark, ENTITIES, c.feature_name)


@query("attribute_groups", """SELECT g.id_attribute_group AS id, g.name AS attribute_group, m.position FROM attribute_group g
    LEFT JOIN (SELECT id_attribute_group, min(position) AS position FROM attribute GROUP BY 1) m ON m.id_attribute_group = g.id_attribute_group""")
def _(c):
    return M.attribute_groups(c.attribute_group, c.attribute).orderBy("attribute_group", "position")




@query("attribute_groups_named", "SELECT id_shop, id_lang, id, attribute_group, position FROM group_named")
def _(c):
    """Attribute groups of every shop in every active language."""
    return M.translated_groups(c.attribute_group, c.attribute_group_lang, c.attribute, c.attribute_group_shop, c.attribute_shop, c.lang)


@query("attribute_documents_named", f"""SELECT ag.id_attribute_group AS id, gl.id_lang AS elastic_id_lang, gs.id_shop AS elastic_id_shop, 'attribute' AS elastic_type,
        {V.code('gl.name')} AS attribute_code, gl.name AS frontend_label, coalesce(o.options, '') AS options
    FROM attribute_group ag JOIN attribute_group_shop gs ON gs.id_attribute_group = ag.id_attribute_group JOIN attribute_group_lang gl ON gl.id_attribute_group = ag.id_attribute_group
    LEFT JOIN (SELECT a.id_attribute_group, ats.id_shop, lang.id_lang, string_agg(concat(CAST(a.id_attribute AS VARCHAR), ':', coalesce(al.name, '')), '|' ORDER BY a.position, a.id_attribute) AS options
        FROM attribute a JOIN attribute_shop ats ON ats.id_attribute = a.id_attribute CROSS JOIN lang
        LEFT JOIN attribute_lang al ON al.id_attribute = a.id_attribute AND al.id_lang = lang.id_lang GROUP BY 1, 2, 3) o
    ON o.id_attribute_group = ag.id_attribute_group AND o.id_shop = gs.id_shop AND o.id_lang = gl.id_lang""")
def _(c):
    docs = E.translated_attribute_documents(c.attribute_group, c.attribute_group_lang, c.attribute, c.attribute_lang, c.attribute_group_shop, c.attribute_shop)
    text = F.array_join(F.transform("options", lambda o: F.concat_ws(":", o["value"].cast("string"), o["label"])), "|")
    return docs.select(F.col("id").cast("int").alias("id"), *_ID[1:], "attribute_code", "frontend_label", text.alias("options"))

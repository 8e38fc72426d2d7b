"""Rows, incremental selection, outcome, versions and completeness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweave.functions import scalars as S
from shelfweave.operators import publish as P
from shelfweave.operators import sync as Y
from shelfweave.operators.registry import default_updated_at, enabled_rows, registered
from shelfweave.operators.relational import first_per_key, spread
from shelfweave.operators.rows import active_entities, entity_rows
from shelfweave.plans.registry import query
from shelfweave.sources.catalog import Catalog

PREFIX = "shop"


def product_rows(c: Catalog) -> DataFrame:
    rows = entity_rows(
        c.product.select("id_product"), c.product_shop.select("id_product", "id_shop", "active", "date_upd", "price"),
        c.product_lang.select("id_product", "id_lang"), key="id_product", active_level="shop",
    )
    return rows.select(F.col("id_product").alias("id_entity"), "id_shop", "id_lang", "date_upd", F.col("price").alias("base_price"))


def changed_rows(c: Catalog) -> DataFrame:
    return Y.objects_to_index(product_rows(c).drop("base_price"), c.index_status, "product")


def batch_of(c: Catalog) -> DataFrame:
    """The rows a bulk load answered for, keyed like the status table."""
    return c.index_status.select("id_entity", "index", "id_shop", "id_lang", F.lit("2024-06-01").cast("date").alias("date_upd"))


@query("entity_rows", "SELECT id_entity, id_shop, id_lang, date_upd, base_price FROM entity_row")
def _(c):
    return product_rows(c)


@query("active_entities", """SELECT 'product' AS entity, id_product AS id, id_shop FROM product_shop WHERE active
    UNION ALL SELECT 'category', id_category, 0 FROM category WHERE active
    UNION ALL SELECT 'review', id, 0 FROM review""")
def _(c):
    product = active_entities(c.product.select("id_product"), c.product_shop.select("id_product", "id_shop", "active"), "id_product", "shop")
    category = active_entities(c.category, None, "id_category", "object")
    review = active_entities(c.review, None, "id", None)
    return S.union_by_name([
        product.select(F.lit("product").alias("entity"), F.col("id_product").alias("id"), "id_shop"),
        category.select(F.lit("category").alias("entity"), F.col("id_category").alias("id"), F.lit(0).alias("id_shop")),
        review.select(F.lit("review").alias("entity"), "id", F.lit(0).alias("id_shop")),
    ])


@query("nonmultilang_rows", "SELECT id_manufacturer, m.name, l.id_lang, l.iso_code FROM manufacturer m CROSS JOIN lang l WHERE m.active AND l.active")
def _(c):
    return entity_rows(c.manufacturer, None, c.lang, key="id_manufacturer", active_level="object", multilang=False).select(
        "id_manufacturer", "name", "id_lang", "iso_code"
    )


@query("registry_scan", """SELECT r.id_entity, r.id_shop, r.id_lang FROM entity_row r
    JOIN entity_type e ON e.entity_name = 'product' AND e.id_shop = r.id_shop WHERE e.enabled""")
def _(c):
    rows = product_rows(c).withColumn("elastic_type", F.lit("product"))
    return enabled_rows(rows, c.entity_type).select("id_entity", "id_shop", "id_lang")


@query("registry_exists", """SELECT coalesce(d.elastic_type, e.entity_name) AS elastic_type, coalesce(d.id_shop, e.id_shop) AS id_shop,
        coalesce(d.n, 0) AS documents, e.entity_name IS NOT NULL AS enabled
    FROM (SELECT 'product' AS elastic_type, id_shop, count(*) AS n FROM entity_row GROUP BY 2) d
    FULL JOIN (SELECT * FROM entity_type WHERE enabled) e ON e.entity_name = d.elastic_type AND e.id_shop = d.id_shop""")
def _(c):
    return registered(product_rows(c).withColumn("elastic_type", F.lit("product")), c.entity_type)


@query("objects_to_index", "SELECT id_entity, id_shop, id_lang, date_upd FROM changed_row")
def _(c):
    return changed_rows(c)


@query("index_chunk", "SELECT id_entity, id_shop, id_lang FROM changed_row ORDER BY id_entity, id_lang, id_shop LIMIT 100 OFFSET 200")
def _(c):
    return Y.objects_to_index(product_rows(c).drop("base_price"), c.index_status, "product", limit=100, offset=200).drop("date_upd")


@query("index_chunks", """SELECT id_entity, id_shop, id_lang,
        CAST((row_number() OVER (PARTITION BY id_shop, id_lang ORDER BY id_entity) - 1) // 100 AS BIGINT) AS chunk FROM changed_row""")
def _(c):
    rows = changed_rows(c).withColumn("elastic_type", F.lit("product"))
    return Y.assign_chunks(rows, 100).select("id_entity", "id_shop", "id_lang", "chunk")


@query("parse_route", """SELECT id_entity, route, regexp_extract(route, '([a-zA-Z]+)_([0-9]+)_([0-9]+)', 1) AS prefix,
    CAST(regexp_extract(route, '([a-zA-Z]+)_([0-9]+)_([0-9]+)', 2) AS INT) AS id_shop,
    CAST(regexp_extract(route, '([a-zA-Z]+)_([0-9]+)_([0-9]+)', 3) AS INT) AS id_lang FROM bulk_result""")
def _(c):
    return Y.parse_route(c.bulk_result).select("id_entity", "route", "prefix", "id_shop", "id_lang")


@query("bulk_outcome", """SELECT s.id_entity, s.index, s.id_shop, s.id_lang, f.error, f.error IS NULL AS ok FROM index_status s
    LEFT JOIN failure f ON f.id_entity = s.id_entity AND f.index = s.index AND f.id_shop = s.id_shop AND f.id_lang = s.id_lang""")
def _(c):
    return Y.bulk_outcome(batch_of(c), c.bulk_result).drop("date_upd")


@query("status_upsert", """SELECT coalesce(s.id_entity, n.id_entity) AS id_entity, coalesce(s.index, n.index) AS index,
        coalesce(s.id_shop, n.id_shop) AS id_shop, coalesce(s.id_lang, n.id_lang) AS id_lang,
        CASE WHEN n.id_entity IS NOT NULL AND (n.error IS NULL OR s.id_entity IS NULL) THEN n.date_upd ELSE s.date_upd END AS date_upd,
        CASE WHEN n.id_entity IS NOT NULL THEN n.error ELSE s.error END AS error
    FROM index_status s FULL JOIN (
        SELECT id_entity, 'product' AS index, id_shop, id_lang, date_upd, CASE WHEN id_entity % 7 = 3 THEN 'rejected' END AS error FROM changed_row) n
    ON s.id_entity = n.id_entity AND s.index = n.index AND s.id_shop = n.id_shop AND s.id_lang = n.id_lang""")
def _(c):
    outcome = changed_rows(c).withColumns({
        "index": F.lit("product"), "error": F.when(F.col("id_entity") % 7 == 3, F.lit("rejected")),
    })
    return Y.upsert_status(c.index_status, outcome)


@query("indexed_count", """SELECT s.id_shop, s.id_lang, count(*) AS indexed FROM index_status s
    JOIN product_shop p ON p.id_product = s.id_entity AND p.id_shop = s.id_shop
    WHERE s.error IS NULL AND s.date_upd = p.date_upd AND s.index = 'product' GROUP BY 1, 2""")
def _(c):
    objects = c.product_shop.select(F.col("id_product").alias("id_entity"), "id_shop", "date_upd")
    return Y.indexed_count(c.index_status, objects, "product")


@query("count_objects", "SELECT id_shop, count(*) AS total FROM product_shop WHERE active GROUP BY 1")
def _(c):
    return Y.count_objects(c.product_shop.filter("active"))


@query("nb_errors", "SELECT index, id_shop, id_lang, count(*) AS errors FROM index_status WHERE error IS NOT NULL GROUP BY 1, 2, 3")
def _(c):
    return Y.nb_errors(c.index_status)


@query("count_languages", "SELECT ls.id_shop, count(*) AS languages FROM lang_shop ls JOIN lang l ON l.id_lang = ls.id_lang WHERE l.active GROUP BY 1")
def _(c):
    return Y.count_languages(c.lang_shop, c.lang)


@query("total_counts", """SELECT e.id_shop, count(*) AS entity_types, CAST(sum(n) AS BIGINT) AS objects FROM (
        SELECT 'product' AS entity_name, id_shop, count(*) AS n FROM product_shop WHERE active GROUP BY 2
        UNION ALL SELECT o.entity_name, shop.id_shop, n FROM shop CROSS JOIN (
            SELECT 'category' AS entity_name, count(*) AS n FROM category WHERE active
            UNION ALL SELECT 'manufacturer', count(*) FROM manufacturer WHERE active
            UNION ALL SELECT 'cms_page', count(*) FROM cms WHERE active
            UNION ALL SELECT 'cmscategory', count(*) FROM cms_category WHERE active
            UNION ALL SELECT 'attribute', count(*) FROM attribute_group
            UNION ALL SELECT 'taxrule', count(*) FROM tax_rules_group) o) c
    JOIN entity_type e ON e.entity_name = c.entity_name AND e.id_shop = c.id_shop WHERE e.enabled GROUP BY 1""")
def _(c):
    """Objects per shop over all enabled entity types."""
    flat = {
        "category": c.category.filter("active"), "manufacturer": c.manufacturer.filter("active"), "cms_page": c.cms.filter("active"),
        "cmscategory": c.cms_category.filter("active"), "attribute": c.attribute_group, "taxrule": c.tax_rules_group,
    }
    shared = S.union_by_name([f.agg(F.count(F.lit(1)).alias("n")).withColumn("entity_name", F.lit(n)) for n, f in flat.items()])
    per_shop = Y.count_objects(c.product_shop.filter("active")).select("id_shop", F.lit("product").alias("entity_name"), F.col("total").alias("n"))
    counts = per_shop.unionByName(spread(shared, c.shop.select("id_shop")))
    enabled = c.entity_type.filter("enabled").select("entity_name", "id_shop")
    return counts.join(enabled, ["entity_name", "id_shop"], "left_semi").groupBy("id_shop").agg(
        F.count(F.lit(1)).alias("entity_types"), F.sum("n").alias("objects")
    )


@query("index_progress", """SELECT t.id_shop, t.total, coalesce(i.n, 0) AS indexed, coalesce(e.n, 0) AS errors, t.total * coalesce(l.n, 0) AS expected,
        round(CAST(coalesce(i.n, 0) AS DOUBLE) / nullif(CAST(t.total AS DOUBLE), 0) * 100, 2) AS percent, coalesce(i.n, 0) = t.total - coalesce(e.n, 0) AS done
    FROM (SELECT id_shop, count(*) AS total FROM product_shop WHERE active GROUP BY 1) t
    LEFT JOIN (SELECT s.id_shop, count(*) AS n FROM index_status s JOIN product_shop p ON p.id_product = s.id_entity AND p.id_shop = s.id_shop
               WHERE s.error IS NULL AND s.date_upd = p.date_upd GROUP BY 1) i ON i.id_shop = t.id_shop
    LEFT JOIN (SELECT id_shop, count(*) AS n FROM index_status WHERE error IS NOT NULL GROUP BY 1) e ON e.id_shop = t.id_shop
    LEFT JOIN (SELECT ls.id_shop, count(*) AS n FROM lang_shop ls JOIN lang l ON l.id_lang = ls.id_lang WHERE l.active GROUP BY 1) l ON l.id_shop = t.id_shop""")
def _(c):
    objects = c.product_shop.select(F.col("id_product").alias("id_entity"), "id_shop", "date_upd")
    indexed = Y.indexed_count(c.index_status, objects, "product").groupBy("id_shop").agg(F.sum("indexed").alias("indexed"))
    errors = Y.nb_errors(c.index_status).groupBy("id_shop").agg(F.sum("errors").alias("errors"))
    return Y.progress(indexed, Y.count_objects(c.product_shop.filter("active")), errors, Y.count_languages(c.lang_shop, c.lang))


@query("updated_at_default", """SELECT id_entity AS id, id_shop, id_lang, CASE WHEN id_entity % 3 = 0 THEN TIMESTAMP '2024-12-31 00:00:00' ELSE CAST(date_upd AS TIMESTAMP) END AS updated_at
    FROM entity_row""")
def _(c):
    rows = product_rows(c).select(
        F.col("id_entity").alias("id"), "id_shop", "id_lang", F.when(F.col("id_entity") % 3 != 0, F.col("date_upd").cast("timestamp_ntz")).alias("updated_at")
    )
    return default_updated_at(rows, F.lit("2024-12-31 00:00:00").cast("timestamp_ntz"))


@query("route_documents", """SELECT id_entity AS id, id_shop AS elastic_id_shop, id_lang AS elastic_id_lang,
    concat('shop_', CAST(id_shop AS VARCHAR), '_', CAST(id_lang AS VARCHAR), '_7') AS target, 'product' AS target_type, CAST(id_entity AS VARCHAR) AS target_id FROM entity_row""")
def _(c):
    return P.route(_documents(c), PREFIX, 7).select("id", "elastic_id_shop", "elastic_id_lang", "target", "target_type", "target_id")


def _documents(c: Catalog) -> DataFrame:
    return product_rows(c).select(
        F.col("id_entity").alias("id"), F.col("id_lang").alias("elastic_id_lang"), F.col("id_shop").alias("elastic_id_shop"), F.lit("product").alias("elastic_type")
    )


@query("new_version_plan", """SELECT shop.id_shop, lang.id_lang, 8 AS version, concat('shop_', CAST(shop.id_shop AS VARCHAR), '_', CAST(lang.id_lang AS VARCHAR), '_8') AS target,
        coalesce(k.n, 0) AS status_rows FROM shop CROSS JOIN lang
    LEFT JOIN (SELECT id_shop, id_lang, count(*) AS n FROM index_status WHERE id_shop <> 2 GROUP BY 1, 2) k ON k.id_shop = shop.id_shop AND k.id_lang = lang.id_lang
    WHERE lang.active""")
def _(c):
    """Targets of version 8, with the status rows that stay once shop 2 is cleared."""
    left = Y.erase_status(c.index_status, 2).groupBy("id_shop", "id_lang").agg(F.count(F.lit(1)).alias("status_rows"))
    plan = P.plan_new_version(c.shop, c.lang, PREFIX, 7)
    return plan.join(left, ["id_shop", "id_lang"], "left").withColumn("status_rows", F.coalesce("status_rows", F.lit(0).cast("bigint")))


def _pointers(c: Catalog) -> DataFrame:
    """Every target points at version 6, then shops 1 to 3 publish version 7."""
    pairs = c.lang_shop.select("id_shop", "id_lang")
    before = pairs.select(P.target_name(PREFIX, F.col("id_shop"), F.col("id_lang")).alias("alias"), F.lit(6).alias("version"))
    return P.publish(before, PREFIX, 7, pairs.filter("id_shop <= 3"))


@query("published_documents", """SELECT r.id_entity AS id, r.id_shop AS elastic_id_shop, r.id_lang AS elastic_id_lang, v.version FROM entity_row r
    CROSS JOIN (SELECT 6 AS version UNION ALL SELECT 7) v JOIN lang_shop ls ON ls.id_shop = r.id_shop AND ls.id_lang = r.id_lang
    WHERE v.version = CASE WHEN r.id_shop <= 3 THEN 7 ELSE 6 END""")
def _(c):
    versions = _documents(c).select("*", F.explode(F.array(F.lit(6), F.lit(7))).alias("version"))
    return P.published(versions, _pointers(c), PREFIX).select("id", "elastic_id_shop", "elastic_id_lang", "version")


@query("erase_plan", """SELECT DISTINCT s.id_shop, s.id_lang, v.version FROM index_status s CROSS JOIN (SELECT 5 AS version UNION ALL SELECT 6 UNION ALL SELECT 7) v
    WHERE v.version IN (5, 6) AND s.id_lang IN (SELECT id_lang FROM lang WHERE active) AND s.id_shop IN (SELECT id_shop FROM shop WHERE id_shop <> 4)""")
def _(c):
    targets = c.index_status.select("id_shop", "id_lang").distinct()
    existing = targets.select("*", F.explode(F.array(F.lit(5), F.lit(6), F.lit(7))).alias("version"))
    return P.plan_erase(existing, [5, 6], c.lang.filter("active"), c.shop.filter("id_shop <> 4"))


@query("change_feed_latest", """SELECT user_id AS id_entity, event_id AS change_id, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events) e WHERE k = 1""")
def _(c):
    """The last change of each entity."""
    events = c.raw("events").select("user_id", "ts", "event_id", "event_type")
    last = first_per_key(events, ["user_id"], [F.col("ts"), F.col("event_id")], keep_last=True)
    return last.select(
        F.col("user_id").alias("id_entity"), F.col("event_id").alias("change_id"),
        F.when(F.col("event_type") == "error", "delete").otherwise("upsert").alias("op"),
    )

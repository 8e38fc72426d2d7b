"""Change feed, status log, change propagation and incremental rounds; they write to a store of their own below the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from shelfweave.operators import hooks
from shelfweave.operators import sync as Y
from shelfweave.operators.registry import affected
from shelfweave.plans.registry import query
from shelfweave.plans.sync_queries import changed_rows
from shelfweave.session import checkpoint_root
from shelfweave.sources.catalog import Catalog
from shelfweave.sources.store import STATUS_KEY, Store
from shelfweave.streaming import incremental as I

BATCHES = 4


def _store(c: Catalog) -> Store:
    root = checkpoint_root(c.spark, "")
    if not root:
        if not c.spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = tempfile.mkdtemp(prefix="shelfweave-")
    store = Store(c.spark, f"{root.rstrip('/')}/store-{uuid.uuid4().hex}")
    store._fs().deleteOnExit(store._path())
    return store


_LAST = """last AS (SELECT entity, id_entity, op, change_id FROM (SELECT *, row_number() OVER (PARTITION BY entity, id_entity ORDER BY ts DESC, change_id DESC) AS k
    FROM change_feed) f WHERE k = 1)"""


@query("change_feed_replayed", f"SELECT * FROM (WITH {_LAST} SELECT entity, id_entity, op, change_id FROM last) l")
def _(c):
    """The feed in batches that are no order of time: the marks end where one batch of all ends."""
    store = _store(c)
    for batch in range(BATCHES):
        I.hear(store, c.change_feed.filter(F.pmod(F.xxhash64("change_id"), F.lit(BATCHES)) == batch), batch + 1)
    return store.marks.read().select("entity", "id_entity", "op", "change_id")


@query("status_log", """SELECT coalesce(s.id_entity, n.id_entity) AS id_entity, coalesce(s.index, n.index) AS index,
        coalesce(s.id_shop, n.id_shop) AS id_shop, coalesce(s.id_lang, n.id_lang) AS id_lang,
        CASE WHEN n.id_entity IS NOT NULL AND (n.error IS NULL OR s.id_entity IS NULL) THEN n.date_upd ELSE s.date_upd END AS date_upd,
        CASE WHEN n.id_entity IS NOT NULL THEN n.error ELSE s.error END AS error
    FROM index_status s FULL JOIN (
        SELECT id_entity, 'product' AS index, id_shop, id_lang, date_upd, CASE WHEN id_entity % 7 = 3 THEN 'rejected' END AS error FROM changed_row) n
    ON s.id_entity = n.id_entity AND s.index = n.index AND s.id_shop = n.id_shop AND s.id_lang = n.id_lang""")
def _(c):
    """The status after loads in batches: deltas of the keys of each, with a compaction on the way, equal the full rewrite."""
    log = _store(c).status
    outcome = changed_rows(c).withColumns({"index": F.lit("product"), "error": F.when(F.col("id_entity") % 7 == 3, F.lit("rejected"))})
    log.append(c.index_status, 1)
    for batch in range(BATCHES):
        some = outcome.filter(F.pmod(F.xxhash64(*STATUS_KEY), F.lit(BATCHES)) == batch)
        if batch == BATCHES - 1:
            log.compact(batch + 2, least=2)
        log.append(Y.upsert_status(log.read(batch + 2, some), some), batch + 2)
    return log.read()


@query("affected_documents", f"""SELECT * FROM (WITH {_LAST}, reached AS (
        SELECT 'product' AS entity, p.id_product AS id_entity FROM product p JOIN last l ON (l.entity = 'manufacturer' AND l.id_entity = p.id_manufacturer)
        UNION SELECT 'product', p.id_product FROM product p JOIN last l ON l.entity = 'supplier' AND l.id_entity = p.id_supplier
        UNION SELECT 'product', p.id_product FROM product p JOIN last l ON l.entity = 'taxrule' AND l.id_entity = p.id_tax_rules_group
        UNION SELECT 'product', cp.id_product FROM category_product cp JOIN ancestor a ON a.id_category = cp.id_category
            JOIN last l ON l.entity = 'category' AND l.id_entity = a.id_ancestor
        UNION SELECT 'category', a.id_ancestor FROM ancestor a JOIN last l ON l.entity = 'category' AND l.id_entity = a.id_category WHERE a.id_ancestor <> a.id_category
        UNION SELECT 'category', cp.id_category FROM category_product cp JOIN last l ON l.entity = 'product' AND l.id_entity = cp.id_product
        UNION SELECT 'taxrule', r.id_tax_rules_group FROM tax_rule r JOIN last l ON l.entity = 'tax_rate' AND l.id_entity = r.id_tax_rule
        UNION SELECT 'manufacturer', p.id_manufacturer FROM product p JOIN last l ON l.entity = 'product' AND l.id_entity = p.id_product)
    SELECT coalesce(l.entity, r.entity) AS entity, coalesce(l.id_entity, r.id_entity) AS id_entity, coalesce(l.op, 'upsert') AS op, r.entity IS NOT NULL AS forced
    FROM last l FULL JOIN reached r ON r.entity = l.entity AND r.id_entity = l.id_entity) a""")
def _(c):
    """Documents that the changes of a feed reach, over all declared dependencies."""
    return affected(c, I.latest_changes(c.change_feed))


@query("category_round", """SELECT c.id_category AS id_entity, 'category' AS index, CAST(shop.id_shop AS INT) AS id_shop, l.id_lang,
        CASE WHEN k.error IS NOT NULL THEN k.date_upd ELSE c.date_upd END AS date_upd, k.error,
        k.id_entity IS NULL OR (k.error IS NULL AND k.date_upd <> c.date_upd) AS written
    FROM category c JOIN category_lang l ON l.id_category = c.id_category CROSS JOIN (SELECT id_shop FROM shop) shop
    LEFT JOIN category_status k ON k.id_entity = c.id_category AND k.id_shop = shop.id_shop AND k.id_lang = l.id_lang WHERE c.active""")
def _(c):
    """An incremental round of categories on a status that knows some: what the status says after it, and which documents it wrote."""
    store = _store(c)
    store.status.append(c.category_status, 1)
    I.index_batch(c, store, 1, 2, entity="category")
    wrote = store.documents(1, "category").select(
        F.col("id").alias("id_entity"), F.col("elastic_id_shop").alias("id_shop"), F.col("elastic_id_lang").alias("id_lang"), F.lit(True).alias("_wrote"))
    return store.status.read().join(wrote, ["id_entity", "id_shop", "id_lang"], "left").withColumn("written", F.col("_wrote").isNotNull()).drop("_wrote")


@query("entity_totals", """SELECT entity, shop.id_shop, n AS total FROM shop CROSS JOIN (
        SELECT 'category' AS entity, count(*) AS n FROM category WHERE active UNION ALL SELECT 'manufacturer', count(*) FROM manufacturer WHERE active
        UNION ALL SELECT 'cmscategory', count(*) FROM cms_category WHERE active UNION ALL SELECT 'attribute', count(*) FROM attribute_group
        UNION ALL SELECT 'taxrule', count(*) FROM tax_rules_group
        UNION ALL SELECT 'cms_page', count(*) FROM cms JOIN lang ON lang.iso_code = cms.iso_code WHERE cms.active AND lang.active) o
    UNION ALL SELECT 'product', id_shop, count(DISTINCT id_entity) FROM entity_row GROUP BY 2 UNION ALL SELECT 'review', 0, count(*) FROM review""")
def _(c):
    """Objects per shop of every document type, each by its own count hook."""
    parts = [e.counter(c).select(F.lit(n).alias("entity"), F.col("id_shop").cast("int").alias("id_shop"), "total") for n, e in hooks.ENTITIES.items() if e.counter]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out

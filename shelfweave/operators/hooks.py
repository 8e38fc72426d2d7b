"""The hooks of the built-in document types: which rows exist, how documents of given rows are built, what they depend on."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfweave.operators import category as C
from shelfweave.operators import entities as E
from shelfweave.operators import product as P
from shelfweave.operators.registry import ENTITIES, Dependency, attach  # noqa: F401
from shelfweave.operators.relational import spread
from shelfweave.operators.rows import entity_rows

ROW = ["id_entity", "id_shop", "id_lang"]


def _cut(frame: DataFrame, key: str, rows: DataFrame | None) -> DataFrame:
    """The source rows that documents of ``rows`` are made of."""
    return frame if rows is None else frame.join(rows.select(F.col("id_entity").alias(key)).distinct(), key, "left_semi")


def _only(docs: DataFrame, rows: DataFrame | None) -> DataFrame:
    if rows is None:
        return docs
    named = rows.select(F.col("id_entity").alias("id"), F.col("id_shop").alias("elastic_id_shop"), F.col("id_lang").alias("elastic_id_lang")).distinct()
    return docs.join(named, ["id", "elastic_id_shop", "elastic_id_lang"], "left_semi")


def _keyed(rows: DataFrame, key: str, *more: str) -> DataFrame:
    return rows.select(F.col(key).cast("long").alias("id_entity"), F.col("id_shop").cast("int").alias("id_shop"), F.col("id_lang").cast("int").alias("id_lang"), *more)


def _everywhere(t, frame: DataFrame, key: str, *more: str) -> DataFrame:
    """Rows of an entity without translations of its own: in every active language and shop."""
    active = t.lang.filter("active").select("id_lang")
    return _keyed(spread(spread(frame.select(key, *more), active), t.shop.select("id_shop")), key, *more)


def _totals(rows):
    """Objects per shop, whatever the language."""
    return lambda t: rows(t).groupBy("id_shop").agg(F.count_distinct("id_entity").alias("total"))


# --- which rows should have a document ---------------------------------------------------------------

def product_rows(t) -> DataFrame:
    """Every active (product, language, shop) with the date that counts for change."""
    rows = entity_rows(
        t.product.select("id_product"), t.product_shop.select("id_product", "id_shop", "active", "date_upd"),
        t.product_lang.select("id_product", "id_lang"), key="id_product", active_level="shop",
    )
    return rows.select(F.col("id_product").alias("id_entity"), "id_shop", "id_lang", "date_upd")


def category_rows(t) -> DataFrame:
    named = t.category.filter("active").select("id_category", "date_upd").join(t.category_lang.select("id_category", "id_lang"), "id_category")
    return _keyed(spread(named, t.shop.select("id_shop")), "id_category", "date_upd")


def page_rows(t) -> DataFrame:
    pages = t.cms.filter("active").select("id_cms", "iso_code").join(t.lang.filter("active").select("id_lang", "iso_code"), "iso_code")
    return _keyed(spread(pages, t.shop.select("id_shop")), "id_cms")


def review_rows(t) -> DataFrame:
    return _keyed(t.review.select("id", F.lit(0).alias("id_shop"), F.lit(0).alias("id_lang")), "id")


def attribute_rows(t) -> DataFrame:
    return _everywhere(t, t.attribute_group, "id_attribute_group")


def taxrule_rows(t) -> DataFrame:
    return _everywhere(t, t.tax_rules_group, "id_tax_rules_group")


def manufacturer_rows(t) -> DataFrame:
    return _everywhere(t, t.manufacturer.filter("active"), "id_manufacturer")


def page_category_rows(t) -> DataFrame:
    return _everywhere(t, t.cms_category.filter("active"), "id_cms_category")


# --- what a change of another table reaches ----------------------------------------------------------

def _pairs(frame: DataFrame, source, entity) -> DataFrame:
    return frame.select(F.col(source).cast("long").alias("source_id"), F.col(entity).cast("long").alias("id_entity"))


def _products_below(t) -> DataFrame:
    """Products name the categories they are in, and those above them in their paths."""
    return _pairs(C.ancestors(t.category).join(t.category_product, "id_category"), "id_ancestor", "id_product").distinct()


def _categories_above(t) -> DataFrame:
    """A category document holds those of its children."""
    return _pairs(C.ancestors(t.category).filter("id_category <> id_ancestor"), "id_category", "id_ancestor")


attach("product", rows=product_rows, builder=P.product_documents, counter=_totals(product_rows), depends=(
    Dependency("manufacturer", lambda t: _pairs(t.product, "id_manufacturer", "id_product")),
    Dependency("supplier", lambda t: _pairs(t.product, "id_supplier", "id_product")),
    Dependency("taxrule", lambda t: _pairs(t.product, "id_tax_rules_group", "id_product")),
    Dependency("category", _products_below),
))
attach(
    "category", rows=category_rows, counter=_totals(category_rows),
    builder=lambda t, rows=None: _only(C.category_documents(t.category, t.category_lang, t.category_product, t.product_shop, t.shop), rows),
    depends=(Dependency("category", _categories_above), Dependency("product", lambda t: _pairs(t.category_product, "id_product", "id_category"))),
)
attach(
    "attribute", rows=attribute_rows, counter=_totals(attribute_rows),
    builder=lambda t, rows=None: _only(E.attribute_documents(_cut(t.attribute_group, "id_attribute_group", rows), t.attribute, t.lang, t.shop), rows),
    depends=(Dependency("attribute_option", lambda t: _pairs(t.attribute, "id_attribute", "id_attribute_group")),),
)
attach(
    "taxrule", rows=taxrule_rows, counter=_totals(taxrule_rows),
    builder=lambda t, rows=None: _only(E.taxrule_documents(_cut(t.tax_rules_group, "id_tax_rules_group", rows), t.tax_rule, t.lang, t.shop), rows),
    depends=(Dependency("tax_rate", lambda t: _pairs(t.tax_rule, "id_tax_rule", "id_tax_rules_group")),),
)
attach(
    "manufacturer", rows=manufacturer_rows, counter=_totals(manufacturer_rows),
    builder=lambda t, rows=None: _only(E.manufacturer_documents(_cut(t.manufacturer, "id_manufacturer", rows), t.product, t.logo_manifest, t.lang, t.shop), rows),
    depends=(Dependency("product", lambda t: _pairs(t.product, "id_product", "id_manufacturer")),),
)
attach(
    "cms_page", rows=page_rows, counter=_totals(page_rows),
    builder=lambda t, rows=None: _only(E.cms_documents(_cut(t.cms, "id_cms", rows), t.lang, t.shop), rows),
)
attach(
    "cmscategory", rows=page_category_rows, counter=_totals(page_category_rows),
    builder=lambda t, rows=None: _only(E.cms_category_documents(_cut(t.cms_category, "id_cms_category", rows), t.lang, t.shop), rows),
)
attach("review", rows=review_rows, counter=_totals(review_rows), builder=lambda t, rows=None: _only(E.review_documents(_cut(t.review, "id", rows)), rows))

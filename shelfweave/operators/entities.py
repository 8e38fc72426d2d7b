"""Documents of the smaller entity types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweave.functions.scalars import code_of
from shelfweave.operators.registry import Attribute, Entity, project, register_entity
from shelfweave.operators.relational import spread


def _is(column: str):
    return lambda: F.col(column)


def meta_struct(title: Column, description: Column | None = None, keywords: Column | None = None) -> Column:
    missing = F.lit(None).cast("string")
    return F.struct(
        title.alias("title"), (missing if description is None else description).alias("description"),
        (missing if keywords is None else keywords).alias("keywords"),
    )


CATEGORY = register_entity(Entity("category", key="id_category", attributes=(
    Attribute("id", "integer"), Attribute("parent_id", "integer"), Attribute("name", "text"), Attribute("position", "integer"),
    Attribute("level", "integer"), Attribute("product_count", "integer"), Attribute("created_at", "date"),
    Attribute("updated_at", "date"), Attribute("path", "text"), Attribute("include_in_menu", "integer", const=1),
    Attribute("is_active", "boolean"), Attribute("url_key", "keyword"), Attribute("slug", "keyword"),
    Attribute("url_path", "keyword"), Attribute("request_path", "text"), Attribute("meta"), Attribute("filters", "keyword"),
    Attribute("meta_title", "text"),
)))

ATTRIBUTE = register_entity(Entity("attribute", key="id_attribute_group", active_level=None, dated=False, attributes=(
    Attribute("id", "integer"),
    Attribute("attribute_id", "integer", lambda: F.col("id_entity").cast("int")),
    Attribute("attribute_code", "keyword", lambda: code_of(F.col("name"))),
    Attribute("frontend_input", "text", const="select"),
    Attribute("frontend_label", "text", _is("name")),
    Attribute("position", "integer", _is("id_entity")),
    Attribute("is_searchable", "boolean", const=True),
    Attribute("is_filterable", "boolean", const=True),
    Attribute("is_comparable", "boolean", const=True),
    Attribute("is_visible_on_front", "boolean", const=True),
    Attribute("is_configurable", "boolean", const=True),
    Attribute("frontend_input_renderer", "text", _is("name")),
    Attribute("options", None, children=(("value", "integer"), ("label", "text"))),
)))

TAXRULE = register_entity(Entity("taxrule", key="id_tax_rules_group", active_level=None, multilang=False, attributes=(
    Attribute("id", "integer"),
    Attribute("code", "keyword", _is("name")),
    Attribute("priority", "integer", lambda: F.lit(None).cast("int")),
    Attribute("position", "integer", lambda: F.lit(None).cast("int")),
    Attribute("calculate_subtotal", "integer", lambda: F.lit(None).cast("int")),
    Attribute("rates", None, children=(
        ("id", "integer"), ("tax_country_id", "keyword"), ("tax_region_id", "integer"), ("rate", "float"), ("tax_postcode", "text"),
        ("zip_is_range", "integer"), ("zip_from", "text"), ("zip_to", "text"))),
    Attribute("tax_rates_ids"),
    Attribute("created_at", "date", lambda: F.lit(None).cast("date")),
    Attribute("product_tax_class_ids", "integer", lambda: F.array("id_tax_rules_group")),
    Attribute("updated_at", "date", lambda: F.lit(None).cast("date")),
)))

MANUFACTURER = register_entity(Entity("manufacturer", key="id_manufacturer", attributes=(
    Attribute("id", "integer"),
    Attribute("name", "text"),
    Attribute("description", "text", lambda: F.lit(None).cast("string")),
    Attribute("short_description", "text", lambda: F.lit(None).cast("string")),
    Attribute("url_key", "keyword", _is("link_rewrite")),
    Attribute("is_active", "boolean", _is("active")),
    Attribute("image", "text"),
    Attribute("product_count", "integer", allowed_types=("integer",)),
    Attribute("meta", None, lambda: meta_struct(F.col("name"))),
    Attribute("created_at", "date", lambda: F.lit(None).cast("date")),
    Attribute("updated_at", "date", lambda: F.lit(None).cast("date")),
)))

CMS_PAGE = register_entity(Entity("cms_page", key="id_cms", dated=False, attributes=(
    Attribute("is_active", "boolean", _is("active")),
    Attribute("cms_category_id", "integer", lambda: F.col("id_cms_category").cast("int")),
    Attribute("position", "integer", lambda: F.lit(None).cast("int")),
    Attribute("level_depth", "integer", lambda: F.lit(None).cast("int")),
    Attribute("title", "text", _is("meta_title")),
    Attribute("content", "text"),
    Attribute("url_key", "keyword", _is("link_rewrite")),
    Attribute("identifier", "keyword", _is("link_rewrite")),
    Attribute("meta", None, lambda: meta_struct(F.col("meta_title"))),
)))

CMS_CATEGORY = register_entity(Entity("cmscategory", key="id_cms_category", multilang=False, attributes=(
    Attribute("id", "integer"),
    Attribute("is_active", "boolean", _is("active")),
    Attribute("parent_id", "integer", lambda: F.col("id_parent").cast("int")),
    Attribute("position", "integer", _is("id_cms_category")),
    Attribute("level_depth", "integer", lambda: F.lit(1)),
    Attribute("name", "text"),
    Attribute("description", "text", lambda: F.lit(None).cast("string")),
    Attribute("created_at", "date", lambda: F.lit(None).cast("date")),
    Attribute("updated_at", "date", lambda: F.lit(None).cast("date")),
    Attribute("slug", "keyword", _is("link_rewrite")),
    Attribute("meta", None, lambda: meta_struct(F.col("name"))),
)))

REVIEW = register_entity(Entity("review", key="id", dated=False, active_level=None, attributes=(
    Attribute("id", "integer"),
    Attribute("product_id", "integer", _is("id_product")),
    Attribute("review_entity", "keyword", const="product"),
    Attribute("review_status", "integer", lambda: review_status(F.col("validate"), F.col("deleted"))),
    Attribute("created_at", "date", _is("date_add")),
    Attribute("detail", "text", _is("content")),
    Attribute("nickname", "text", _is("customer_name")),
    Attribute("title", "text", lambda: F.lit(None).cast("string")),
    Attribute("grade", "float"),
)))


def review_status(validate: Column, deleted: Column) -> Column:
    """1 for a validated review that is not deleted, else 0."""
    return (F.coalesce(validate, F.lit(False)) & ~F.coalesce(deleted, F.lit(False))).cast("int")


def _rows(frame: DataFrame, key: str, langs: DataFrame, shops: DataFrame) -> DataFrame:
    both = spread(spread(frame, langs.filter(F.col("active")).select("id_lang", "iso_code")), shops.select("id_shop"))
    return both.withColumn("id_entity", F.col(key))


def attribute_documents(groups: DataFrame, options: DataFrame, langs: DataFrame, shops: DataFrame) -> DataFrame:
    """Variant attribute groups with their options in position order."""
    listed = options.groupBy("id_attribute_group").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "id_attribute", "name"))),
            lambda o: F.struct(o["id_attribute"].cast("int").alias("value"), o["name"].alias("label")),
        ).alias("options")
    )
    full = groups.join(listed, "id_attribute_group", "left")
    full = full.withColumn("options", F.coalesce("options", F.array().cast(full.schema["options"].dataType)))
    return project(_rows(full, "id_attribute_group", langs, shops), ATTRIBUTE)


def translated_attribute_documents(
    groups: DataFrame, group_lang: DataFrame, options: DataFrame, option_lang: DataFrame, group_shop: DataFrame, option_shop: DataFrame
) -> DataFrame:
    """Attribute groups per shop and language they have a name in, with the options of that shop by position, labelled in that language.

    An option without a name in the language has an empty label. Options are gathered per (group, shop, language): one document holds those of its group.
    """
    each = groups.select("id_attribute_group").join(group_shop, "id_attribute_group").join(group_lang.select("id_attribute_group", "id_lang", "name"), "id_attribute_group")
    there = options.select("id_attribute", "id_attribute_group", "position").join(option_shop, "id_attribute")
    keys = ["id_attribute_group", "id_shop", "id_lang"]
    pairs = each.select(*keys).join(there, ["id_attribute_group", "id_shop"]).join(option_lang.select("id_attribute", "id_lang", F.col("name").alias("_label")), ["id_attribute", "id_lang"], "left")
    listed = pairs.groupBy(*keys).agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("position", "id_attribute", F.coalesce("_label", F.lit("")).alias("label")))),
            lambda o: F.struct(o["id_attribute"].cast("int").alias("value"), o["label"].alias("label")),
        ).alias("options")
    )
    full = each.join(listed, keys, "left").withColumn("id_entity", F.col("id_attribute_group"))
    return project(full.withColumn("options", F.coalesce("options", F.array().cast(full.schema["options"].dataType))), ATTRIBUTE)


def taxrule_documents(groups: DataFrame, rules: DataFrame, langs: DataFrame, shops: DataFrame) -> DataFrame:
    """Tax groups with their nested rates, region 0 and postcode ``*`` throughout."""
    listed = rules.groupBy("id_tax_rules_group").agg(
        F.array_sort(F.collect_list(F.struct("id_tax_rule", "country_iso", "rate"))).alias("_rules")
    )
    full = groups.join(listed, "id_tax_rules_group", "left")
    rates = F.transform(
        "_rules",
        lambda r: F.struct(
            r["id_tax_rule"].alias("id"), r["country_iso"].alias("tax_country_id"), F.lit(0).alias("tax_region_id"), r["rate"].alias("rate"),
            F.lit("*").alias("tax_postcode"), F.lit(None).cast("int").alias("zip_is_range"), F.lit(None).cast("string").alias("zip_from"),
            F.lit(None).cast("string").alias("zip_to"),
        ),
    )
    full = full.withColumns({
        "rates": rates,
        "tax_rates_ids": F.transform("_rules", lambda r: r["id_tax_rule"].cast("int")),
    }).drop("_rules")
    full = full.withColumns({c: F.coalesce(c, F.array().cast(full.schema[c].dataType)) for c in ("rates", "tax_rates_ids")})
    return project(_rows(full, "id_tax_rules_group", langs, shops), TAXRULE)


def manufacturer_documents(makers: DataFrame, products: DataFrame, logos: DataFrame, langs: DataFrame, shops: DataFrame) -> DataFrame:
    """Active brands with product count and logo id; ``<language>-default`` where the logo manifest has none."""
    counts = products.groupBy("id_manufacturer").agg(F.count(F.lit(1)).alias("product_count"))
    have = logos.select("id_manufacturer", F.lit(True).alias("_logo")).distinct()
    full = makers.filter("active").join(counts, "id_manufacturer", "left").join(have, "id_manufacturer", "left").withColumn(
        "product_count", F.coalesce("product_count", F.lit(0).cast("bigint"))
    )
    rows = _rows(full, "id_manufacturer", langs, shops).withColumn(
        "image", F.when(F.col("_logo"), F.col("id_manufacturer").cast("string")).otherwise(F.concat("iso_code", F.lit("-default")))
    )
    return project(rows, MANUFACTURER)


def cms_documents(pages: DataFrame, langs: DataFrame, shops: DataFrame) -> DataFrame:
    """Content pages, each in its own language."""
    known = langs.filter(F.col("active")).select("id_lang", "iso_code")
    rows = spread(pages.filter(F.col("active")).join(known, "iso_code"), shops.select("id_shop"))
    rows = rows.withColumns({
        "id_entity": F.col("id_cms"),
        "link_rewrite": F.concat(F.lit("page-"), F.col("id_cms").cast("string"), F.lit("-"), F.col("iso_code")),
    })
    return project(rows, CMS_PAGE)


def cms_category_documents(categories: DataFrame, langs: DataFrame, shops: DataFrame) -> DataFrame:
    """Content categories in every active language."""
    rows = _rows(categories.filter(F.col("active")), "id_cms_category", langs, shops).withColumn(
        "link_rewrite", F.concat(code_of(F.col("name")), F.lit("-"), F.col("iso_code"))
    )
    return project(rows, CMS_CATEGORY)


def review_documents(reviews: DataFrame) -> DataFrame:
    """Reviews; language and shop are 0, they have neither."""
    rows = reviews.withColumns({"id_entity": F.col("id"), "id_lang": F.lit(0), "id_shop": F.lit(0)})
    return project(rows, REVIEW)

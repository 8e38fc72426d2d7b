"""Product documents: one pre-aggregated side frame per source, joined on the product id.

Every side is reduced to one row per product before it is joined, so the joins are 1:1, share the
hash partitioning on ``id_product``, and the fan-out to shops and languages comes last.
"""

from __future__ import annotations

from collections.abc import Collection, Sequence
from dataclasses import dataclass, replace
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv
from shelfweave.functions import scalars as S
from shelfweave.operators import category as C
from shelfweave.operators.registry import Attribute, Entity, project, register_entity
from shelfweave.operators.relational import split_join
from shelfweave.operators.rows import entity_rows


class ProductTables(Protocol):
    product: DataFrame
    product_shop: DataFrame
    product_lang: DataFrame
    category: DataFrame
    category_lang: DataFrame
    category_product: DataFrame
    manufacturer: DataFrame
    supplier_name: DataFrame
    order_detail: DataFrame
    page: DataFrame
    page_viewed: DataFrame
    stock_available: DataFrame
    feature_product: DataFrame
    tax_rule: DataFrame
    specific_price: DataFrame
    image: DataFrame


# --- side frames, each one row per product -------------------------------------------------------

def category_facts(category: DataFrame, category_lang: DataFrame, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES) -> DataFrame:
    """One row per category with its name, slug and path in every language."""
    named = C.category_paths(category, category_lang, hidden, active_only=False, keep=("name", "link_rewrite"))
    texts = named.groupBy("id_category").agg(
        F.array_sort(F.collect_list(F.struct("id_lang", "name", F.col("link_rewrite").alias("slug"), "path"))).alias("texts")
    )
    return category.select("id_category", "active", "level_depth", "id_parent").join(texts, "id_category", "left")


def categories(category_product: DataFrame, category: DataFrame, category_lang: DataFrame, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES) -> DataFrame:
    """Categories of each product in id order, with the texts of all languages.

    The id pairs alone go to their product first: of a tree that the planner sends to the tasks the texts cross no shuffle. A larger tree is joined by shuffle.
    """
    pairs = category_product.select("id_product", "id_category").repartition("id_product")
    rows = pairs.join(category_facts(category, category_lang, hidden), "id_category")
    return rows.groupBy("id_product").agg(
        F.array_sort(F.collect_list(F.struct("id_category", "active", "level_depth", "id_parent", "texts"))).alias("cats")
    )


#: A tree of up to so many categories and texts, all languages together, is looked up as one value; a larger one is joined (``categories``).
TREE_TEXTS = 8_192


@dataclass(frozen=True)
class CategoryBook:
    """A small category tree as one value: ``ids`` and ``active`` by place in id order, ``langs``, and by language and place ``cats``, ``nodes`` and ``leaves``.

    A product then carries only the places of its categories; the texts cross no shuffle, no sort and no list that is gathered.
    """

    value: Column

    def places(self, category_product: DataFrame) -> DataFrame:
        """(id_product, places, shown): where the categories of each product stand, in id order, and the active ones among them."""
        place = (F.array_position(self.value["ids"], F.col("id_category")) - 1).cast("int")
        pairs = category_product.select("id_product", place.alias("_place")).filter(F.col("_place") >= 0)
        marked = pairs.withColumn("_shown", F.when(F.get(self.value["active"], F.col("_place")), F.col("_place")))
        return marked.repartition("id_product").groupBy("id_product").agg(
            F.array_sort(F.collect_list("_place")).alias("places"), F.array_sort(F.collect_list("_shown")).alias("shown")
        )

    def joined(self, product_lang: DataFrame, places: DataFrame, how: str, fields: dict[str, tuple[str, str]]) -> DataFrame:
        """Translation rows with columns looked up on the page of their language: name -> (list of places, what stands there).

        Every part of the book is a column of its own that is used once, so the optimizer puts the value where it is looked up and no row carries it.
        """
        found = F.array_position(self.value["langs"], F.col("id_lang"))
        # The last page has no texts and is that of languages without any.
        page = F.when(found > 0, found - 1).otherwise(F.size(self.value["langs"])).cast("int")
        rows = product_lang.withColumn("_page", page).join(places, "id_product", how)
        open_book = rows.select("*", *[self.value[part].alias(f"_{name}") for name, (_, part) in fields.items()])

        def look_up(name: str, where: str, part: str) -> Column:
            at = (lambda p: F.get(f"_{name}", p)) if part == "ids" else (lambda p: F.get(F.get(f"_{name}", F.col("_page")), p))
            return F.transform(where, at).alias(name)

        return open_book.select(*product_lang.columns, *[look_up(name, where, part) for name, (where, part) in fields.items()])


def category_book(category: DataFrame, category_lang: DataFrame, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES) -> CategoryBook | None:
    """The tree as one value, or None if it has more than ``TREE_TEXTS`` categories and texts, which is asked of the tables when the plan is made."""
    if category.select(F.lit(1)).union(category_lang.select(F.lit(1))).limit(TREE_TEXTS + 1).count() > TREE_TEXTS:
        return None
    facts = category_facts(category, category_lang, hidden).agg(
        F.array_sort(F.collect_list(F.struct("id_category", "active", "level_depth", "id_parent", "texts"))).alias("facts")
    )
    langs = F.array_sort(F.array_distinct(F.flatten(F.transform(F.filter("facts", lambda f: f["texts"].isNotNull()), lambda f: F.transform(f["texts"], lambda t: t["id_lang"])))))
    paged = facts.select("facts", langs.alias("langs")).select(
        "facts", "langs", F.transform(F.concat("langs", F.array(F.lit(None).cast("int"))), lambda x: in_language(F.col("facts"), x)).alias("cats")
    )
    shown = F.transform("cats", lambda page: F.transform(page, _category_struct))
    leaves = F.transform("cats", lambda page: F.transform(page, lambda c: F.when(_is_path(c["text"]["path"]), C.leaf_name(c["text"]["path"]))))
    ids, active = (F.transform("facts", lambda f: f[n]) for n in ("id_category", "active"))  # noqa: B023
    value = F.struct(ids.alias("ids"), active.alias("active"), "langs", "cats", shown.alias("nodes"), leaves.alias("leaves"))
    return CategoryBook(paged.select(value.alias("book")).scalar())


def category_ids(category_product: DataFrame) -> DataFrame:
    return category_product.groupBy("id_product").agg(F.array_sort(F.collect_set("id_category")).alias("category_ids"))


def media(image: DataFrame) -> DataFrame:
    """Gallery in position order and the cover image id."""
    rows = image.groupBy("id_product").agg(
        F.array_sort(F.collect_list(F.struct("position", "id_image", "legend"))).alias("_all"),
        F.min(F.when(F.col("cover"), F.struct("position", "id_image"))).alias("_cover"),
    )
    gallery = F.transform(
        "_all",
        lambda i: F.struct(
            S.image_path(i["id_image"]).alias("image"), i["position"].alias("pos"), i["legend"].alias("lab"), F.lit("image").alias("typ")
        ),
    )
    return rows.select("id_product", gallery.alias("gallery"), F.col("_cover.id_image").alias("cover_image"))


def stock(stock_available: DataFrame) -> DataFrame:
    return stock_available.groupBy("id_product").agg(
        F.min("id_stock").alias("id_stock"), F.sum("quantity").alias("quantity"), F.sum("supplier_qty").alias("supplier_qty")
    )


def reductions(specific_price: DataFrame) -> DataFrame:
    return specific_price.groupBy("id_product").agg(F.max("reduction").alias("reduction"))


def tax_rates(tax_rule: DataFrame) -> DataFrame:
    """Rate of the first rule of each tax group."""
    return tax_rule.groupBy("id_tax_rules_group").agg(F.min_by("rate", "id_tax_rule").alias("rate"))


def with_rates(products: DataFrame, rates: DataFrame) -> DataFrame:
    """Products with the rate of their tax group. A few groups may take all products: the rows of those are dealt over tasks, to which only their rates are copied."""
    return split_join(products, rates, ["id_tax_rules_group"])


def views(page: DataFrame, page_viewed: DataFrame) -> DataFrame:
    """Page views of each product that has a page; view rows are summed per page before the join."""
    hits = page_viewed.groupBy("id_page").agg(F.sum("counter").alias("_hits"))
    return page.filter(F.col("page_type") == "product").join(hits, "id_page", "left").groupBy(
        F.col("id_object").alias("id_product")
    ).agg(F.coalesce(F.sum("_hits"), F.lit(0)).cast("bigint").alias("pageviews"))


def sales(order_detail: DataFrame) -> DataFrame:
    """Ordered quantity and number of sales, never below zero."""
    return order_detail.groupBy(F.col("product_id").alias("id_product")).agg(
        F.coalesce(F.sum("product_quantity"), F.lit(0)).cast("bigint").alias("ordered_qty"),
        F.greatest(F.count(F.lit(1)), F.lit(0)).alias("sales"),
    )


def feature_lists(feature_product: DataFrame) -> DataFrame:
    """All features of a product, every language, in position order."""
    return feature_product.groupBy("id_product").agg(
        F.array_sort(F.collect_list(F.struct("id_lang", "position", "name", "value"))).alias("features_all")
    )


def brand(product: DataFrame, manufacturer: DataFrame, supplier_name: DataFrame) -> DataFrame:
    """Product with the name and link of its brand and its supplier's name."""
    makers = manufacturer.select(
        "id_manufacturer", F.col("name").alias("manufacturer"), F.col("link_rewrite").alias("manufacturer_link")
    )
    return product.join(makers, "id_manufacturer", "left").join(supplier_name, "id_supplier", "left")


# --- per-row expressions -------------------------------------------------------------------------

def allows_backorder(out_of_stock: Column, shop_default: bool = False) -> Column:
    """Stock rule of a product: 1 allows, 2 asks the shop default, anything else denies."""
    return F.coalesce((out_of_stock == 1) | ((out_of_stock == 2) & F.lit(shop_default)), F.lit(False))


def in_stock(quantity: Column, backorder: Column) -> Column:
    """Any non-zero quantity counts, a negative one too."""
    return (F.coalesce(quantity, F.lit(0)) != 0) | backorder


# Stock settings that are the same for every product.
STOCK_DEFAULTS = (
    ("is_qty_decimal", True), ("show_default_notification_message", False), ("use_config_min_qty", False), ("min_qty", 0),
    ("use_config_min_sale_qty", False), ("min_sale_qty", 1), ("use_config_max_sale_qty", False), ("max_sale_qty", 0),
    ("use_config_backorders", False), ("backorders", 0), ("use_config_notify_stock_qty", False), ("notify_stock_qty", 1),
    ("use_config_qty_increments", False), ("qty_increments", 1), ("use_config_enable_qty_inc", False),
    ("enable_qty_increments", False), ("use_config_manage_stock", False), ("manage_stock", False),
    ("is_decimal_divided", False), ("stock_status_changed_auto", 0),
)


def stock_struct() -> Column:
    """The nested stock part of a document."""
    same = ", ".join(f"'{name}', {str(value).lower()}" for name, value in STOCK_DEFAULTS)
    counts = F.expr(
        "named_struct('item_id', id_product, 'product_id', id_product, 'stock_id', id_stock, "
        "'qty', coalesce(quantity, 0L) + coalesce(supplier_qty, 0L), 'qty_available_now', coalesce(quantity, 0L), "
        f"'qty_available_later', coalesce(supplier_qty, 0L), 'is_in_stock', 0, {same})"
    )
    available = in_stock(F.col("quantity"), allows_backorder(F.col("out_of_stock")))
    return (
        counts.withField("is_in_stock", available.cast("int"))
        .withField("handling_time", S.php_int(F.col("available_now")))
        .withField("handling_time_oos", S.php_int(F.col("available_later")))
    )


def in_language(cats: Column, id_lang: Column) -> Column:
    """Categories with their texts in one language."""

    def one(c: Column) -> Column:
        text = F.get(F.filter(c["texts"], lambda t: t["id_lang"] == id_lang), F.lit(0))
        return F.struct(*[c[n].alias(n) for n in ("id_category", "active", "level_depth", "id_parent")], text.alias("text"))

    return F.transform(cats, one)


def category_structs(cats: Column) -> Column:
    """Active categories as the nested part of a document."""
    return F.transform(F.filter(cats, lambda c: c["active"]), _category_struct)


def _category_struct(c: Column) -> Column:
    return F.struct(
        c["id_category"].alias("category_id"), c["text"]["name"].alias("name"), c["level_depth"].alias("level_depth"),
        c["text"]["slug"].alias("slug"), c["id_parent"].alias("id_parent"),
    )


def _is_path(path: Column) -> Column:
    return (path != "") & (path != "0")


def category_path_list(cats: Column) -> Column:
    """Non-empty paths of all categories, active or not."""
    return F.filter(F.transform(cats, lambda c: c["text"]["path"]), _is_path)


def leaf_names(paths: Column) -> Column:
    return C.distinct_names(F.transform(paths, lambda p: C.leaf_name(p)))


def features_in(features: Column, id_lang: Column) -> Column:
    return F.filter(features, lambda f: f["id_lang"] == id_lang)


def _first_of_key(entries: Column, key, value, value_type: str) -> Column:
    # map_from_entries rejects repeated keys, so the map grows entry by entry.
    empty = F.create_map().cast(f"map<string,{value_type}>")
    return F.aggregate(
        entries, empty, lambda m, e: F.when(F.map_contains_key(m, key(e)), m).otherwise(F.map_concat(m, F.create_map(key(e), value(e))))
    )


def spec_map(features: Column) -> Column:
    """Feature name -> value; the last of equal names wins."""
    return _first_of_key(F.reverse(features), lambda f: f["name"], lambda f: f["value"], "string")


def feature_map(features: Column) -> Column:
    """Field code -> list of lower-case values; the first of equal codes wins."""
    return _first_of_key(features, lambda f: S.code_of(f["name"]), lambda f: S.split_trim(F.lower(f["value"])), "array<string>")


def product_link(iso_or_lang: Column, id_product: Column, slug: Column) -> Column:
    """``/{language}/{id}-{slug}.html``."""
    return F.concat(F.lit("/"), iso_or_lang.cast("string"), F.lit("/"), id_product.cast("string"), F.lit("-"), slug, F.lit(".html"))


def _flag(column: str):
    return lambda: F.coalesce(F.col(column).cast("boolean"), F.lit(False))


def _is(column: str):
    return lambda: F.col(column)


# --- declaration ---------------------------------------------------------------------------------

_STOCK_CHILDREN = tuple(
    [(n, "integer") for n in ("item_id", "product_id", "stock_id", "qty", "qty_available_now", "qty_available_later")]
    + [("is_in_stock", "boolean")]
    + [(n, "boolean" if isinstance(v, bool) else "integer") for n, v in STOCK_DEFAULTS]
    + [("low_stock_date", "date"), ("handling_time", "integer"), ("handling_time_oos", "integer")]
)

#: Prices come from the shop row, the tax rate and the reduction.
_PRICES = ("rates", "reductions")

PRODUCT = register_entity(Entity(
    name="product",
    key="id_product",
    active_level="shop",
    attributes=(
        Attribute("sku", "keyword", _is("reference")),
        Attribute("name", "text"),
        Attribute("name_autocomplete", "text", lambda: S.autocomplete_text(
            F.col("name"), F.col("reference"), F.col("ean13"), F.col("id_product"), F.col("manufacturer")), needs=("brand",)),
        Attribute("attribute_set_id", "integer", const=0),
        Attribute("price", "float", allowed_types=("float",), needs=_PRICES),
        Attribute("special_price", "float", allowed_types=("float",), needs=_PRICES),
        Attribute("special_price_incl_tax", "float", allowed_types=("float",), needs=_PRICES),
        Attribute("original_price", "float", allowed_types=("float",), needs=_PRICES),
        Attribute("original_price_incl_tax", "float", allowed_types=("float",), needs=_PRICES),
        Attribute("status", "integer", const=1),
        Attribute("visibility", "integer", const=3),
        Attribute("type_id", "text", const="simple"),
        Attribute("created_at", "date", _is("date_add")),
        Attribute("updated_at", "date", _is("date_upd")),
        Attribute("tier_prices", None, lambda: F.array().cast("array<string>")),
        Attribute("required_options", "integer", const=0),
        Attribute("has_options", "boolean", const=False),
        Attribute("tax_class_id", "integer", lambda: F.col("id_tax_rules_group").cast("int")),
        Attribute("category_ids", "text", needs=("categories",)),
        Attribute("category", None, children=(
            ("category_id", "integer"), ("is_parent", "boolean"), ("is_virtual", "text"), ("name", "keyword"),
            ("position", "integer"), ("level_depth", "integer"), ("slug", "keyword"), ("id_parent", "integer")), needs=("categories",)),
        Attribute("reference", None),
        Attribute("ean13", "text"),
        Attribute("is_salable", "boolean", _flag("available_for_order")),
        Attribute("is_active", "boolean", _flag("active")),
        Attribute("request_path", "text", _is("link_rewrite")),
        Attribute("url_key", "keyword", _is("link_rewrite")),
        Attribute("url_path", "keyword", _is("link_rewrite")),
        Attribute("description", "text"),
        Attribute("short_description", "text", _is("description_short")),
        Attribute("stock", None, stock_struct, children=_STOCK_CHILDREN, needs=("stock",)),
        Attribute("media_gallery", None, _is("gallery"), children=(("image", "text"), ("pos", "integer"), ("lab", "text"), ("typ", "text")), needs=("media",)),
        Attribute("image", "text", lambda: S.image_path(F.col("cover_image")), needs=("media",)),
        Attribute("categories_without_path", "text", needs=("categories",)),
        Attribute("condition", "keyword"),
        Attribute("customization_required", "boolean", _flag("customization_required")),
        Attribute("date_add", "date"),
        Attribute("date_upd", "date"),
        Attribute("in_stock", "boolean", lambda: in_stock(F.col("quantity"), allows_backorder(F.col("out_of_stock"))), visible=False, needs=("stock",)),
        Attribute("is_virtual", "boolean", _flag("is_virtual"), allowed_types=("boolean",)),
        Attribute("link", "keyword", lambda: product_link(F.col("id_lang"), F.col("id_product"), F.col("link_rewrite")), visible=False, allowed_types=("keyword",)),
        Attribute("id_tax_rules_group", "integer", visible=False, allowed_types=("integer",)),
        Attribute("manufacturer_link", "keyword", needs=("brand",)),
        Attribute("manufacturer", "keyword", needs=("brand",)),
        Attribute("manufacturer_logo", "keyword", lambda: F.concat(F.lit("/m/"), F.col("id_manufacturer").cast("string"), F.lit(".jpg"))),
        Attribute("manufacturer_id", "keyword", _is("id_manufacturer")),
        Attribute("minimal_quantity", "integer", lambda: F.col("minimal_quantity").cast("int"), visible=False, allowed_types=("integer",)),
        Attribute("new", "boolean", _flag("is_new"), allowed_types=("boolean",)),
        Attribute("show_price", "boolean", _flag("show_price"), visible=False, allowed_types=("boolean",)),
        Attribute("on_sale", "boolean", _flag("on_sale"), allowed_types=("boolean",)),
        Attribute("online_only", "boolean", _flag("online_only"), allowed_types=("boolean",)),
        Attribute("ordered_qty", "integer", lambda: F.coalesce("ordered_qty", F.lit(0).cast("bigint")), visible=False, allowed_types=("integer",), needs=("sales",)),
        Attribute("stock_qty", "integer", lambda: F.coalesce("quantity", F.lit(0).cast("bigint")), visible=False, allowed_types=("integer",), needs=("stock",)),
        Attribute("weight", "float", visible=False, allowed_types=("float",)),
        Attribute("pageviews", "integer", lambda: F.coalesce("pageviews", F.lit(0).cast("bigint")), allowed_types=("integer",), needs=("views",)),
        Attribute("sales", "integer", lambda: F.coalesce("sales", F.lit(0).cast("bigint")), allowed_types=("integer",), needs=("sales",)),
        Attribute("meta", None, lambda: F.struct(
            F.col("meta_title").alias("title"), F.lit(None).cast("string").alias("description"), F.lit(None).cast("string").alias("keywords"))),
        Attribute("specs", needs=("features",)),
    ),
))


# --- assembly ------------------------------------------------------------------------------------

#: Columns of every document.
ENVELOPE = ("id", "elastic_id_lang", "elastic_id_shop", "elastic_type")


def _or_empty(frame: DataFrame, *columns: str) -> DataFrame:
    return frame.withColumns({c: F.coalesce(c, F.array().cast(frame.schema[c].dataType)) for c in columns})


def localized(product_lang: DataFrame, cats: DataFrame | None, features: DataFrame | None, book: CategoryBook | None = None) -> DataFrame:
    """The translation rows of products with all that depends on the language, worked out before shops multiply them.

    ``cats`` has the texts of a product's categories or, with ``book``, their places in it.
    """
    rows = product_lang
    if cats is not None and book is not None:
        fields = {"category_ids": ("places", "ids"), "category": ("shown", "nodes"), "categories_without_path": ("places", "leaves")}
        rows = _or_empty(book.joined(rows, cats, "left", fields), *fields).withColumn("categories_without_path", C.distinct_names(F.col("categories_without_path")))
    elif cats is not None:
        picked = rows.join(cats, "id_product", "left").withColumn("_cats", in_language(F.col("cats"), F.col("id_lang")))
        rows = _or_empty(picked, "_cats").withColumns({
            "category_ids": F.transform("_cats", lambda c: c["id_category"]),
            "category": category_structs(F.col("_cats")),
            "categories_without_path": leaf_names(category_path_list(F.col("_cats"))),
        }).drop("cats", "_cats")
    if features is not None:
        picked = rows.join(features, "id_product", "left").withColumn("_features", features_in(F.col("features_all"), F.col("id_lang")))
        rows = _or_empty(picked, "_features").withColumns({
            "specs": spec_map(F.col("_features")), "features": feature_map(F.col("_features")),
        }).drop("features_all", "_features")
    return rows


def with_categories(
    product_lang: DataFrame, category_product: DataFrame, category: DataFrame, category_lang: DataFrame, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES
) -> DataFrame:
    """Translation rows of the products that have categories, with those in their language as ``cats``."""
    book = category_book(category, category_lang, hidden)
    if book is None:
        found = categories(category_product, category, category_lang, hidden)
        return product_lang.join(found, "id_product").withColumn("cats", in_language(F.col("cats"), F.col("id_lang")))
    return book.joined(product_lang, book.places(category_product), "inner", {"cats": ("places", "cats")})


#: What a product document draws on beyond the product's own rows; fields name theirs (``Attribute.needs``).
PARTS = frozenset({"brand", "rates", "stock", "reductions", "views", "sales", "media", "categories", "features"})


def assemble(t: ProductTables, rows: DataFrame | None = None, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES, parts: Collection[str] = PARTS) -> DataFrame:
    """Everything a product document is projected from, one row per (product, language, shop).

    ``rows`` (id_entity, id_shop, id_lang) limits the work to those documents; its product ids cut
    every large source before its own aggregation. Only the sources of the given ``parts`` are read and joined.
    """
    only = None if rows is None else rows.select(F.col("id_entity").alias("_only")).distinct()

    def cut(frame: DataFrame, column: str = "id_product") -> DataFrame:
        return frame if only is None else frame.join(only, frame[column] == only["_only"], "left_semi")

    per_product = cut(t.product)
    if "rates" in parts:
        per_product = with_rates(per_product, tax_rates(t.tax_rule))
    if "brand" in parts:
        per_product = brand(per_product, t.manufacturer, t.supplier_name)
    sides = {
        "stock": lambda: stock(cut(t.stock_available)),
        "reductions": lambda: reductions(cut(t.specific_price)),
        "views": lambda: views(cut(t.page, "id_object"), t.page_viewed),
        "sales": lambda: sales(cut(t.order_detail, "product_id")),
        "media": lambda: media(cut(t.image)),
    }
    for part, side in sides.items():
        if part in parts:
            per_product = per_product.join(side(), "id_product", "left")
    if "media" in parts:
        per_product = _or_empty(per_product, "gallery")
    cats = book = None
    if "categories" in parts:
        book = category_book(t.category, t.category_lang, hidden)
        pairs = cut(t.category_product)
        cats = categories(pairs, t.category, t.category_lang, hidden) if book is None else book.places(pairs)
    texts = localized(cut(t.product_lang), cats, feature_lists(cut(t.feature_product)) if "features" in parts else None, book)
    # Price, active flag and change date are those of the shop row.
    shop = cut(t.product_shop).select("id_product", "id_shop", "active", F.col("price").alias("base_price"), "date_upd")
    fanned = entity_rows(per_product, shop, texts, key="id_product", active_level="shop")
    fanned = fanned.withColumn("id_entity", F.col("id_product"))
    if rows is not None:
        fanned = fanned.join(rows.select("id_entity", "id_shop", "id_lang").distinct(), ["id_entity", "id_shop", "id_lang"], "left_semi")
    priced = {"rates", "reductions"} <= set(parts)
    return fanned.withColumns(S.price_columns(F.col("base_price"), F.col("rate"), F.col("reduction"))) if priced else fanned


def product_documents(
    t: ProductTables, rows: DataFrame | None = None, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES, run_at: Column | None = None, fields: Collection[str] | None = None
) -> DataFrame:
    """Product documents; features of the data come as the map column ``features``.

    ``fields`` limits the documents to the envelope and those fields, and the work to the sources they are worked out from. Which features a document
    hides depends on all its fields, so ``features`` takes the whole document.
    """
    if fields is None or "features" in fields:
        docs = hide_declared(project(assemble(t, rows, hidden), PRODUCT_WITH_FEATURES, run_at))
        return docs if fields is None else docs.select(*ENVELOPE, *[a.name for a in PRODUCT_WITH_FEATURES.attributes if a.name in fields])
    chosen = replace(PRODUCT, attributes=tuple(a for a in PRODUCT.attributes if a.name in fields))
    unknown = set(fields) - {a.name for a in chosen.attributes}
    if unknown:
        raise ValueError(f"no such fields: {sorted(unknown)}")
    parts = {part for a in chosen.attributes for part in a.needs}
    return project(assemble(t, rows, hidden, parts), chosen, run_at if "updated_at" in fields else None)


PRODUCT_WITH_FEATURES = Entity(
    name="product", key="id_product", active_level="shop", attributes=PRODUCT.attributes + (Attribute("features"),)
)


def hide_declared(docs: DataFrame) -> DataFrame:
    """Leaves out features whose name is that of a filled declared field."""
    declared = [c for c in docs.columns if c != "features"]
    filled = F.expr("array_compact(array(" + ", ".join(f"CASE WHEN `{c}` IS NOT NULL THEN '{c}' END" for c in declared) + "))")
    return docs.withColumn("features", F.map_filter("features", lambda k, _: ~(k.isin(*declared) & F.array_contains(filled, k))))


def flatten_features(docs: DataFrame, codes: Sequence[str]) -> DataFrame:
    """The named features as top-level array columns."""
    return docs.withColumns({code: F.try_element_at("features", F.lit(code)) for code in codes})


def group_price_pivot(group_price: DataFrame, groups: Sequence[int], field: str = "price_tax_excl") -> DataFrame:
    """One price column per customer group; the explicit group list saves a pass over the data."""
    wide = group_price.groupBy("id_product").pivot("id_group", list(groups)).agg(F.min("price"))
    return wide.select("id_product", *[F.col(str(g)).alias(f"{field}_{g}") for g in groups])


def aggregatable_copies(docs: DataFrame, metas_types: dict[str, str]) -> DataFrame:
    """``<field>_agg`` slug copies of the text fields, elementwise for lists; colour codes are skipped."""
    kinds = dict(docs.dtypes)
    copies = {}
    for name, kind in metas_types.items():
        if kind not in ("text", "string") or name.endswith("_color_code") or name not in kinds:
            continue
        is_list = kinds[name].startswith("array")
        copies[f"{name}_agg"] = F.transform(name, S.slugify) if is_list else S.slugify(F.col(name))
    return docs.withColumns(copies)


def drop_hidden_fields(docs: DataFrame, hidden: str = fv.DEFAULT_HIDDEN_FIELDS) -> DataFrame:
    """Documents without the fields of a comma list."""
    return docs.drop(*[f.strip() for f in hidden.split(",") if f.strip()])


def enabled_fields(docs: DataFrame, enabled: Sequence[str]) -> DataFrame:
    """Envelope columns plus the enabled fields."""
    return docs.select(*ENVELOPE, *[c for c in enabled if c in docs.columns and c not in ENVELOPE])

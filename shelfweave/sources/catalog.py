"""The shop catalogue as DataFrames derived from the driver tables (definitions in FIXTURES.md)."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfweave.functions import scalars as S
from shelfweave.functions.analyzers import word_tokens
from shelfweave.operators.relational import literal_rows, spread, spread_rows

# Nested-set layout: 16 leaf groups per nation, 32 nation slots per region.
NATION_SPAN = 64
REGION_SPAN = 32 * NATION_SPAN
PROPERTY_CODES = (
    "name", "sku", "price", "manufacturer", "condition", "description", "on_sale", "weight", "stock_qty", "category",
)


class Catalog:
    """Lazily derived catalogue tables over one directory of parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._raw: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A driver table; its files are listed once per catalogue."""
        if name not in self._raw:
            self._raw[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._raw[name]

    @cached_property
    def texts(self) -> DataFrame:
        """The documents, spread over the cores when they come in fewer splits."""
        return spread_rows(self.raw("documents"))

    def _ordered_values(self, frame: DataFrame, column: str, ordinal: str) -> DataFrame:
        """Distinct values of a configuration column with their ordinal; reduces in every task first."""
        packed = frame.agg(F.array_sort(F.collect_set(column)).alias("v"))
        return packed.select(F.posexplode("v").alias("p", column)).select(
            (F.col("p") + 1).cast("int").alias(ordinal), column
        )

    @cached_property
    def shop(self) -> DataFrame:
        return self.raw("region").selectExpr("r_regionkey + 1 AS id_shop", "r_name AS name")

    @cached_property
    def lang(self) -> DataFrame:
        isos = self._ordered_values(self.raw("documents").select(F.col("lang").alias("iso_code")), "iso_code", "id_lang")
        return isos.select("id_lang", "iso_code", (F.col("iso_code") != "es").alias("active"))

    @cached_property
    def lang_shop(self) -> DataFrame:
        pairs = spread(self.lang.select("id_lang"), self.shop.select("id_shop"))
        return pairs.filter((F.col("id_lang") + F.col("id_shop")) % 4 != 0)

    @cached_property
    def category(self) -> DataFrame:
        whole = 8 * REGION_SPAN
        region, nation, supplier = self.raw("region"), self.raw("nation"), self.raw("supplier")
        top = literal_rows(
            self.spark, [(1, 0, 0, 1, whole + 10, True, "Root"), (2, 1, 1, 2, whole + 9, True, "Home")],
            "id_category long, id_parent long, level_depth int, nleft long, nright long, active boolean, base_name string",
        )
        regions = region.selectExpr(
            "CAST(10 + r_regionkey AS BIGINT) AS id_category", "2L AS id_parent", "2 AS level_depth",
            f"3 + r_regionkey * {REGION_SPAN}L AS nleft", f"2 + (r_regionkey + 1) * {REGION_SPAN}L AS nright",
            "true AS active", "r_name AS base_name",
        )
        nation_left = f"4 + n_regionkey * {REGION_SPAN}L + n_nationkey * {NATION_SPAN}L"
        nations = nation.selectExpr(
            "CAST(100 + n_nationkey AS BIGINT) AS id_category", "CAST(10 + n_regionkey AS BIGINT) AS id_parent",
            "3 AS level_depth", f"{nation_left} AS nleft", f"{nation_left} + {NATION_SPAN - 1}L AS nright",
            "n_nationkey % 7 <> 0 AS active", "n_name AS base_name",
        )
        groups = supplier.selectExpr("s_nationkey", "CAST(s_suppkey % 16 AS INT) AS b").distinct()
        leaves = groups.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
            "CAST(1000 + 16 * s_nationkey + b AS BIGINT) AS id_category", "CAST(100 + s_nationkey AS BIGINT) AS id_parent",
            "4 AS level_depth", f"{nation_left} + 1 + 2 * b AS nleft", f"{nation_left} + 2 + 2 * b AS nright",
            "(s_nationkey + b) % 11 <> 3 AS active", "concat(n_name, ' ', CAST(b AS STRING)) AS base_name",
        )
        return S.union_by_name([top, regions, nations, leaves]).selectExpr(
            "*", "CAST(id_category % 7 AS INT) AS position", "DATE '2023-01-01' AS date_add",
            "date_add(DATE '2024-01-01', CAST(id_category % 50 AS INT)) AS date_upd",
        )

    @cached_property
    def category_lang(self) -> DataFrame:
        return spread(
            self.category.select("id_category", "base_name"), self.lang.select("id_lang", "iso_code")
        ).selectExpr(
            "id_category", "id_lang", "concat(base_name, ' ', iso_code) AS name",
            "concat(lower(replace(replace(base_name, '_', '-'), ' ', '-')), '-', iso_code) AS link_rewrite",
            "concat(base_name, ' , ', iso_code, ',x') AS meta_keywords",
        )

    @cached_property
    def category_product(self) -> DataFrame:
        seller = self.raw("supplier").selectExpr("s_suppkey", "CAST(1000 + 16 * s_nationkey + s_suppkey % 16 AS BIGINT) AS id_category")
        return self.raw("lineitem").join(seller, F.col("l_suppkey") == F.col("s_suppkey")).selectExpr(
            "id_category", "l_partkey AS id_product"
        ).distinct()

    @cached_property
    def manufacturer(self) -> DataFrame:
        return self.raw("part").select("p_brand").distinct().selectExpr(
            "CAST(replace(p_brand, 'Brand#', '') AS INT) AS id_manufacturer", "p_brand AS name",
            "lower(replace(p_brand, '#', '-')) AS link_rewrite", "p_brand <> 'Brand#13' AS active",
        )

    @cached_property
    def product(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "p_partkey AS id_product", "concat('REF', CAST(1000000 + p_partkey AS STRING)) AS reference",
            "CAST(4000000000000 + p_partkey AS STRING) AS ean13",
            "CAST(replace(p_brand, 'Brand#', '') AS INT) AS id_manufacturer",
            "CAST(100 + p_partkey % 25 AS BIGINT) AS id_category_default", "p_size % 10 <> 0 AS active",
            "p_type = 'PROMO' AS is_virtual", "p_size % 4 = 0 AS on_sale", "p_size % 9 = 0 AS online_only",
            "p_size <> 13 AS show_price", "p_size % 6 <> 0 AS available_for_order", "p_size % 8 = 0 AS is_new",
            "p_size % 12 = 0 AS customization_required", "CAST(p_partkey % 3 AS INT) AS out_of_stock",
            "1 + p_size % 3 AS minimal_quantity", "CAST(p_size AS DOUBLE) / 2 AS weight",
            "CASE WHEN p_size % 5 = 0 THEN 'used' ELSE 'new' END AS condition",
            "p_size % 3 + 1 AS id_tax_rules_group", "CAST(p_partkey % 50 AS BIGINT) AS id_supplier",
            "DATE '2024-01-01' AS date_add", "date_add(DATE '2024-01-01', p_size) AS date_upd",
        )

    @cached_property
    def product_shop(self) -> DataFrame:
        return spread(
            self.raw("part").select("p_partkey", "p_size", "p_retailprice"), self.raw("region").select("r_regionkey")
        ).filter("(p_partkey + r_regionkey) % 3 <> 0").selectExpr(
            "p_partkey AS id_product", "r_regionkey + 1 AS id_shop", "p_retailprice + r_regionkey AS price",
            "(p_size + r_regionkey) % 10 <> 0 AS active", "date_add(DATE '2024-01-01', p_size + r_regionkey) AS date_upd",
        )

    @cached_property
    def product_lang(self) -> DataFrame:
        return spread(
            spread_rows(self.raw("part").select("p_partkey", "p_name", "p_size")), self.lang.select("id_lang", "iso_code")
        ).filter("(p_partkey + id_lang) % 5 <> 0").selectExpr(
            "p_partkey AS id_product", "id_lang", "concat(p_name, ' ', iso_code) AS name",
            "concat('Long text for ', p_name, ' in ', iso_code) AS description", "p_name AS description_short",
            "concat(replace(p_name, ' ', '-'), '-', iso_code) AS link_rewrite", "concat(p_name, ' title') AS meta_title",
            "CASE p_size % 4 WHEN 0 THEN concat(CAST(p_size AS STRING), ' days') WHEN 1 THEN '0' WHEN 2 THEN '' ELSE 'soon' END AS available_now",
            "CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS STRING) END AS available_later",
        )

    @cached_property
    def order_detail(self) -> DataFrame:
        return self.raw("lineitem").selectExpr("l_partkey AS product_id", "CAST(l_quantity AS INT) AS product_quantity")

    @cached_property
    def page(self) -> DataFrame:
        return self.raw("part").selectExpr(
            "10 * p_partkey AS id_page", "p_partkey AS id_object",
            "CASE WHEN p_partkey % 11 = 0 THEN 'cms' ELSE 'product' END AS page_type",
        )

    @cached_property
    def page_viewed(self) -> DataFrame:
        return self.raw("events").filter("event_type = 'view'").selectExpr(
            "10 * user_id AS id_page", "CAST(get_json_object(props, '$.k') AS BIGINT) AS counter"
        )

    @cached_property
    def stock_available(self) -> DataFrame:
        return self.raw("part").filter("p_partkey % 17 <> 0").selectExpr(
            "5000000 + p_partkey AS id_stock", "p_partkey AS id_product",
            "CAST((p_partkey * 7) % 23 - 3 AS INT) AS quantity", "p_size % 4 AS supplier_qty",
            "CAST(p_partkey % 3 AS INT) AS out_of_stock",
        )

    @cached_property
    def feature_product(self) -> DataFrame:
        rows = spread(self.raw("part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"), self.lang.select("id_lang"))
        return rows.selectExpr(
            "p_partkey", "id_lang",
            "explode(filter(array("
            "struct(1 AS position, 'Frame Size' AS name, CAST(p_size AS STRING) AS value, true AS kept), "
            "struct(2 AS position, 'Material Kind' AS name, replace(p_name, ' ', ' , ') AS value, true AS kept), "
            "struct(3 AS position, 'frame size' AS name, p_type AS value, p_size % 2 = 0 AS kept), "
            "struct(4 AS position, 'Condition' AS name, 'hidden by a declared field' AS value, p_size % 7 = 0 AS kept), "
            "struct(5 AS position, concat('Series ', replace(p_brand, '#', ' ')) AS name, p_type AS value, p_size % 3 = 0 AS kept)), f -> f.kept)) AS f",
        ).selectExpr("p_partkey AS id_product", "id_lang", "f.position", "f.name", "f.value")

    @cached_property
    def attribute_group(self) -> DataFrame:
        names = [(1, "Order Priority"), (2, "Market Segment"), (3, "Part Type"), (4, "Empty Group")]
        return literal_rows(self.spark, names, "id_attribute_group int, name string")

    @cached_property
    def attribute(self) -> DataFrame:
        sources = [(1, "orders", "o_orderpriority"), (2, "customer", "c_mktsegment"), (3, "part", "p_type")]
        parts = []
        for group, table, column in sources:
            values = self.raw(table).agg(F.array_sort(F.collect_set(column)).alias("v"))
            parts.append(values.select(F.size("v").alias("n"), F.posexplode("v").alias("p", "name")).select(
                (F.lit(100 * group) + F.col("p") + 1).alias("id_attribute"), F.lit(group).alias("id_attribute_group"),
                "name", (F.col("n") - F.col("p")).alias("position"),
            ))
        return S.union_by_name(parts)

    @cached_property
    def attribute_group_lang(self) -> DataFrame:
        return spread(self.attribute_group, self.lang.select("id_lang", "iso_code")).filter("(id_attribute_group + id_lang) % 5 <> 0").selectExpr(
            "id_attribute_group", "id_lang", "concat(name, ' ', iso_code) AS name")

    @cached_property
    def attribute_lang(self) -> DataFrame:
        return spread(self.attribute, self.lang.select("id_lang", "iso_code")).filter("(id_attribute + id_lang) % 7 <> 0").selectExpr(
            "id_attribute", "id_lang", "concat(name, ' ', iso_code) AS name")

    @cached_property
    def attribute_group_shop(self) -> DataFrame:
        return spread(self.attribute_group, self.shop.select("id_shop")).filter("(id_attribute_group + id_shop) % 4 <> 0").select("id_attribute_group", "id_shop")

    @cached_property
    def attribute_shop(self) -> DataFrame:
        return spread(self.attribute, self.shop.select("id_shop")).filter("(id_attribute + id_shop) % 3 <> 0").select("id_attribute", "id_shop")

    @cached_property
    def tax_rule(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey AS id_tax_rule", "CAST(floor(s_suppkey / 8) AS INT) + 1 AS id_tax_rules_group", "s_nationkey AS id_country",
            "concat('N', CAST(s_nationkey AS STRING)) AS country_iso", "CAST(5 + (s_suppkey % 4) * 5 AS DOUBLE) AS rate",
        )

    @cached_property
    def tax_rules_group(self) -> DataFrame:
        return self.raw("supplier").selectExpr("CAST(floor(s_suppkey / 8) AS INT) + 1 AS id_tax_rules_group").distinct().selectExpr(
            "id_tax_rules_group", "concat('Tax group ', CAST(id_tax_rules_group AS STRING)) AS name",
        )

    @cached_property
    def supplier_name(self) -> DataFrame:
        return self.raw("supplier").selectExpr("s_suppkey AS id_supplier", "s_name AS supplier_name")

    @cached_property
    def specific_price(self) -> DataFrame:
        return self.raw("part").filter("p_partkey % 4 = 0").selectExpr(
            "p_partkey AS id_product", "CAST(p_size % 5 AS DOUBLE) / 10 AS reduction"
        )

    @cached_property
    def group_price(self) -> DataFrame:
        return self.raw("part").selectExpr("p_partkey", "p_retailprice", "explode(array(1, 2, 3)) AS g").filter(
            "(p_partkey + g) % 4 <> 0"
        ).selectExpr("p_partkey AS id_product", "g AS id_group", "p_retailprice - g AS price")

    @cached_property
    def image(self) -> DataFrame:
        return self.raw("part").selectExpr("p_partkey", "p_name", "p_size", "explode(array(1, 2, 3)) AS k").filter(
            "k <= p_size % 4"
        ).selectExpr(
            "10 * p_partkey + k AS id_image", "p_partkey AS id_product", "k AS position", "k = 1 AS cover",
            "concat(p_name, ' ', CAST(k AS STRING)) AS legend",
        )

    @cached_property
    def logo_manifest(self) -> DataFrame:
        return self.manufacturer.filter("id_manufacturer % 3 <> 0").selectExpr("id_manufacturer")

    @cached_property
    def cms_category(self) -> DataFrame:
        return self.raw("documents").select("source").distinct().selectExpr(
            "CAST(replace(source, 'src', '') AS INT) + 1 AS id_cms_category", "source AS name", "0 AS id_parent",
            "source <> 'src7' AS active",
        )

    @cached_property
    def cms(self) -> DataFrame:
        return self.raw("documents").selectExpr(
            "doc_id AS id_cms", "CAST(replace(source, 'src', '') AS INT) + 1 AS id_cms_category", "lang AS iso_code",
            "text AS content", "concat('Page ', CAST(doc_id AS STRING)) AS meta_title", "n_chars > 50 AS active",
        )

    @cached_property
    def review(self) -> DataFrame:
        return self.raw("events").filter("event_type = 'purchase'").selectExpr(
            "event_id AS id", "user_id AS id_product", "value AS grade",
            "concat('user', CAST(user_id AS STRING)) AS customer_name", "props AS content",
            "user_id % 2 = 1 AS validate", "event_id % 5 = 0 AS deleted", "ts AS date_add",
        )

    @cached_property
    def index_status(self) -> DataFrame:
        pairs = self.product_shop.select("id_product", "id_shop", "date_upd").join(
            self.product_lang.select("id_product", "id_lang"), "id_product"
        )
        return pairs.filter("id_product % 4 < 2 AND NOT (id_product % 4 = 0 AND id_lang = 3)").selectExpr(
            "id_product AS id_entity", "'product' AS index", "id_shop", "id_lang",
            "CASE WHEN id_product % 4 = 1 THEN DATE '2023-06-01' ELSE date_upd END AS date_upd",
            "CASE WHEN id_product % 8 = 5 THEN 'mapper failed' END AS error",
        )

    @cached_property
    def category_status(self) -> DataFrame:
        """What is known of category documents: some current, some stale, some failed, the rest not yet indexed."""
        pairs = spread(
            self.category.filter("active").select("id_category", "date_upd").join(self.category_lang.select("id_category", "id_lang"), "id_category"),
            self.shop.select("id_shop"),
        )
        return pairs.filter("id_category % 4 < 2").selectExpr(
            "id_category AS id_entity", "'category' AS index", "CAST(id_shop AS INT) AS id_shop", "id_lang",
            "CASE WHEN id_category % 4 = 1 THEN DATE '2023-06-01' ELSE date_upd END AS date_upd",
            "CASE WHEN id_category % 8 = 5 THEN 'mapper failed' END AS error",
        )

    @cached_property
    def change_feed(self) -> DataFrame:
        """Changes of products, brands, categories and tax rates, in no order of time."""
        return self.raw("events").selectExpr(
            "CASE event_type WHEN 'purchase' THEN 'manufacturer' WHEN 'signup' THEN 'category' WHEN 'click' THEN 'tax_rate' ELSE 'product' END AS entity",
            "CASE event_type WHEN 'purchase' THEN 11 + user_id % 90 WHEN 'signup' THEN 1000 + user_id % 800 ELSE user_id END AS id_entity",
            "CASE WHEN event_type = 'error' THEN 'delete' ELSE 'upsert' END AS op", "ts", "event_id AS change_id",
        )

    @cached_property
    def entity_type(self) -> DataFrame:
        names = self.spark.range(1).selectExpr(
            "explode(array('attribute', 'category', 'cmscategory', 'cms_page', 'manufacturer', 'product', 'taxrule')) AS entity_name"
        )
        return spread(names, self.shop.select("id_shop")).selectExpr(
            "concat('Builder', entity_name) AS class_name", "entity_name",
            "NOT (entity_name = 'taxrule' AND id_shop = 2) AND NOT (entity_name = 'product' AND id_shop = 4) AS enabled", "id_shop",
        )

    @cached_property
    def bulk_result(self) -> DataFrame:
        return self.index_status.selectExpr(
            "id_entity", "concat('shop_', CAST(id_shop AS STRING), '_', CAST(id_lang AS STRING), '_7') AS route", "index AS type",
            "CASE WHEN id_entity % 9 = 0 THEN 400 WHEN id_entity % 10 = 0 THEN 503 ELSE 201 END AS status",
            "CASE WHEN id_entity % 9 = 0 THEN 'bad field' END AS reason",
            "CASE WHEN id_entity % 18 = 0 THEN 'not a number' END AS caused_by",
        )

    @cached_property
    def feature_name(self) -> DataFrame:
        return self.feature_product.select("name").distinct()

    @cached_property
    def meta(self) -> DataFrame:
        """Stored field settings: declared properties, then features, then attribute groups."""
        codes = ", ".join(f"'{c}'" for c in PROPERTY_CODES)
        props = self.spark.range(1).selectExpr(f"posexplode(array({codes})) AS (p, code)").selectExpr(
            "p + 1 AS ord", "code", "'property' AS meta_type"
        )
        slugs = self.feature_name.select(S.slugify(F.col("name")).alias("code"))
        feats = self._ordered_values(slugs, "code", "ord").selectExpr("ord + 100 AS ord", "code", "'feature' AS meta_type")
        attrs = self.attribute_group.select(
            (F.col("id_attribute_group") + 900).alias("ord"), S.slugify(F.col("name")).alias("code"), F.lit("attribute").alias("meta_type")
        )
        return S.union_by_name([props, feats, attrs]).selectExpr(
            "ord AS id", "CASE WHEN meta_type = 'property' THEN code ELSE concat(code, '_', meta_type) END AS alias", "code", "meta_type",
            "CASE ord % 4 WHEN 0 THEN 'keyword' WHEN 1 THEN 'text' WHEN 2 THEN 'float' ELSE 'text' END AS elastic_type",
            "ord % 5 <> 0 AS enabled", "ord % 3 <> 0 AS searchable", "ord % 2 = 0 AS aggregatable",
            "CAST(ord % 4 + 1 AS FLOAT) AS weight", "CASE WHEN ord % 6 = 0 THEN 0 ELSE ord END AS position",
            "ord % 2 AS operator", "ord % 5 + 1 AS display_type",
            "CASE ord % 4 WHEN 0 THEN 3 WHEN 2 THEN 5 ELSE 0 END AS result_limit",
        )

    @cached_property
    def meta_lang(self) -> DataFrame:
        ids = self.meta.select("id", "code").unionByName(self.spark.range(1).selectExpr("9999 AS id", "'orphan' AS code"))
        return spread(ids, self.lang.select("id_lang", "iso_code")).filter("(id + id_lang) % 3 <> 0").selectExpr(
            "id", "id_lang", "concat(upper(code), ' ', iso_code) AS name"
        )

    @cached_property
    def meta_edit(self) -> DataFrame:
        """A submitted batch of field settings with repeated aliases, in submission order."""
        alias = "concat(lower(replace(p_name, ' ', '_')), '_', CAST(p_size AS STRING))"
        return self.raw("part").selectExpr(
            "p_partkey AS ord", f"{alias} AS alias", f"{alias} AS code",
            "CASE WHEN p_size % 2 = 0 THEN 'feature' ELSE 'attribute' END AS meta_type",
            "CASE WHEN p_size % 3 = 0 THEN 'keyword' ELSE 'text' END AS elastic_type", "p_partkey % 2 = 0 AS enabled",
            "p_partkey % 3 = 0 AS searchable", "p_partkey % 5 = 0 AS aggregatable", "CAST(p_partkey % 4 + 1 AS FLOAT) AS weight",
            "CAST(p_partkey % 2 AS INT) AS operator", "CAST(p_partkey % 5 + 1 AS INT) AS display_type", "0 AS result_limit",
        )

    @cached_property
    def meta_store(self) -> DataFrame:
        """What is already stored when ``meta_edit`` arrives."""
        return self.raw("part").filter("p_partkey % 10 = 0").selectExpr(
            "concat(lower(replace(p_name, ' ', '_')), '_', CAST(p_size AS STRING)) AS code",
            "CASE WHEN p_size % 2 = 0 THEN 'feature' ELSE 'attribute' END AS meta_type", "p_partkey",
        ).groupBy("code", "meta_type").agg(F.min("p_partkey").alias("k")).selectExpr(
            "k + 1 AS id", "code AS alias", "code", "meta_type", "'text' AS elastic_type", "true AS enabled", "false AS searchable",
            "false AS aggregatable", "CAST(1 AS FLOAT) AS weight", "k + 500 AS position", "1 AS operator", "1 AS display_type", "0 AS result_limit",
        )

    @cached_property
    def label_json(self) -> DataFrame:
        """Label files as JSON text: code -> (language -> label)."""
        return self.raw("part").selectExpr(
            "p_partkey AS id_file",
            "concat('{\"', lower(replace(p_name, ' ', '_')), '\":{\"en\":\"', p_name, '\",\"nl\":\"', p_type, '\"},\"size_', CAST(p_size AS STRING), '\":{\"en\":\"', CAST(p_size AS STRING), '\"}}') AS body",
        )

    @cached_property
    def date_text(self) -> DataFrame:
        return self.raw("orders").selectExpr(
            "o_orderkey AS id",
            "CASE o_orderkey % 4 WHEN 0 THEN date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') WHEN 1 THEN date_format(o_orderdate, 'yyyy-MM-dd') "
            "WHEN 2 THEN CAST((datediff(o_orderdate, DATE '1970-01-01') * 86400L + hour(o_orderdate) * 3600 + minute(o_orderdate) * 60 + second(o_orderdate)) * 1000 AS STRING) ELSE concat('on ', date_format(o_orderdate, 'yyyy-MM-dd')) END AS text",
        )

    @cached_property
    def title_text(self) -> DataFrame:
        """Free-text titles with accents, taken from the first line of every document."""
        return self.raw("documents").selectExpr("doc_id AS id", "split_part(text, '\\n', 1) AS title")

    @cached_property
    def doc_token(self) -> DataFrame:
        return self.texts.select("doc_id", "lang", F.explode(word_tokens(F.lower("text"))).alias("token"))

    @cached_property
    def stop_word(self) -> DataFrame:
        """Tokens that at least 3 in 10 documents of a language use; their number is bounded by text length, not corpus size."""
        sizes = self.raw("documents").groupBy("lang").agg(F.count(F.lit(1)).alias("n_docs"))
        uses = self.texts.select("lang", F.explode(F.array_distinct(word_tokens(F.lower("text")))).alias("token")) \
            .groupBy("lang", "token").agg(F.count(F.lit(1)).alias("n"))
        return uses.join(sizes, "lang").filter("n * 10 >= n_docs * 3").select("lang", "token")

    @cached_property
    def stem_dict(self) -> DataFrame:
        """Inflected form -> stem, derived from the vocabulary."""
        words = self.texts.select(F.explode(F.array_distinct(F.split(F.lower("text"), r"\s+"))).alias("form")) \
            .filter("length(form) > 4 AND (form LIKE '%ing' OR form LIKE '%s' OR form LIKE '%en')").distinct()
        return words.selectExpr(
            "form", "CASE WHEN form LIKE '%ing' THEN substring(form, 1, length(form) - 3) WHEN form LIKE '%en' THEN substring(form, 1, length(form) - 2) "
            "ELSE substring(form, 1, length(form) - 1) END AS stem",
        )

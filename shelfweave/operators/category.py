"""The category tree: ancestor paths, children, product counts and category documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfweave.functions import fixed_values as fv
from shelfweave.functions.scalars import split_trim
from shelfweave.operators.relational import containing_intervals, spread


def ancestors(category: DataFrame, hidden: Sequence[int] = (), active_only: bool = False) -> DataFrame:
    """(id_category, id_ancestor, ancestor_depth) pairs, each category included, by nested-set containment.

    Hidden ids (usually root and home, which contain everything) leave before the join.
    """
    side = category.filter(~F.col("id_category").isin(*hidden)) if hidden else category
    if active_only:
        side = side.filter(F.col("active"))
    around = side.select(
        F.col("id_category").alias("id_ancestor"), F.col("level_depth").alias("ancestor_depth"),
        F.col("nleft").alias("_low"), F.col("nright").alias("_high"),
    )
    inner = category.select("id_category", "nleft", "nright")
    pairs = containing_intervals(inner, "nleft", around, "_low", "_high")
    return pairs.filter(F.col("_high") >= F.col("nright")).select("id_category", "id_ancestor", "ancestor_depth")


def category_paths(
    category: DataFrame, category_lang: DataFrame, hidden: Sequence[int] = fv.HIDDEN_CATEGORIES,
    active_only: bool = True, separator: str = fv.PATH_SEPARATOR, keep: Sequence[str] = (),
) -> DataFrame:
    """Names from the top to each category, per language; '' where nothing is left to name. ``keep`` names further text columns."""
    names = category_lang.select(F.col("id_category").alias("id_ancestor"), "id_lang", "name")
    named = ancestors(category, hidden, active_only).join(names, "id_ancestor")
    grouped = named.groupBy("id_category", "id_lang").agg(
        F.array_sort(F.collect_list(F.struct("ancestor_depth", "id_ancestor", "name"))).alias("_steps")
    )
    paths = grouped.select(
        "id_category", "id_lang", F.array_join(F.transform("_steps", lambda s: s["name"]), separator).alias("path")
    )
    return category_lang.select("id_category", "id_lang", *keep).join(paths, ["id_category", "id_lang"], "left").withColumn(
        "path", F.coalesce("path", F.lit(""))
    )


def id_paths(category: DataFrame) -> DataFrame:
    """Ids from the root to each category, joined by ``/``."""
    grouped = ancestors(category).groupBy("id_category").agg(
        F.array_sort(F.collect_list(F.struct("ancestor_depth", "id_ancestor"))).alias("_steps")
    )
    return grouped.select(
        "id_category", F.array_join(F.transform("_steps", lambda s: s["id_ancestor"].cast("string")), "/").alias("path")
    )


def leaf_name(path: Column, separator: str = fv.PATH_SEPARATOR) -> Column:
    """Last step of a path."""
    return F.element_at(F.split(path, separator), -1)


def distinct_names(names: Column) -> Column:
    """Names in first-seen order without repeats, '' and '0'."""
    return F.filter(F.array_distinct(names), lambda n: (n != "") & (n != "0"))


def children(category: DataFrame) -> DataFrame:
    """Active children of each parent: ids as a comma list, and their number."""
    return category.filter(F.col("active")).groupBy(F.col("id_parent").alias("id_category")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("id_category")), lambda c: c.cast("string")), ",").alias("children"),
        F.count(F.lit(1)).cast("int").alias("children_count"),
    )


def product_counts(category_product: DataFrame) -> DataFrame:
    """Distinct products per category: repeats leave first, so both steps reduce before their shuffle."""
    return category_product.select("id_category", "id_product").distinct().groupBy("id_category").agg(
        F.count(F.lit(1)).alias("product_count")
    )


def shop_product_counts(category_product: DataFrame, product_shop: DataFrame) -> DataFrame:
    """Distinct products per (category, shop) that are active there."""
    shown = product_shop.filter("active").select("id_product", "id_shop")
    return category_product.select("id_category", "id_product").distinct().join(shown, "id_product").groupBy("id_category", "id_shop").agg(
        F.count(F.lit(1)).alias("product_count")
    )


def filters_of(meta_keywords: Column) -> Column:
    """Facet names a category lists in its keywords."""
    return split_trim(meta_keywords)


def category_documents(category: DataFrame, category_lang: DataFrame, category_product: DataFrame, product_shop: DataFrame, shops: DataFrame, nested: bool = True) -> DataFrame:
    """One document per (active category, language, shop), with the whole documents of its active children inside, theirs in them and so on.

    ``children_data`` is an array of VARIANT values, as its depth is that of the tree and no schema's. Without ``nested`` it is left out.
    """
    per_category = category.filter("active").join(id_paths(category), "id_category").join(children(category), "id_category", "left")
    rows = spread(per_category.join(category_lang, "id_category"), shops.select("id_shop"))
    rows = rows.join(shop_product_counts(category_product, product_shop), ["id_category", "id_shop"], "left")
    flat = rows.select(
        F.col("id_category").alias("id"), F.col("id_lang").alias("elastic_id_lang"), F.col("id_shop").alias("elastic_id_shop"),
        F.lit("category").alias("elastic_type"), F.col("id_parent").cast("int").alias("parent_id"), "name", "position",
        F.col("level_depth").cast("int").alias("level"),
        F.coalesce("product_count", F.lit(0).cast("bigint")).alias("product_count"),
        F.col("date_add").alias("created_at"), F.col("date_upd").alias("updated_at"), "path", F.lit(1).alias("include_in_menu"),
        F.col("active").alias("is_active"), F.col("link_rewrite").alias("url_key"), F.col("link_rewrite").alias("slug"),
        F.col("link_rewrite").alias("url_path"), F.col("link_rewrite").alias("request_path"),
        F.struct(
            F.col("name").alias("title"), F.lit(None).cast("string").alias("description"), F.col("meta_keywords").alias("keywords")
        ).alias("meta"),
        filters_of(F.col("meta_keywords")).alias("filters"), F.col("name").alias("meta_title"),
        F.coalesce("children", F.lit("")).alias("children"), F.coalesce("children_count", F.lit(0)).alias("children_count"),
    )
    if not nested:
        return flat
    # The depth of the tree is asked of the category table alone; documents are built once a level, from the lowest up.
    deepest = category.agg(F.max("level_depth")).first()[0] or 0
    return _with_children(flat, deepest)


def _with_children(flat: DataFrame, deepest: int) -> DataFrame:
    """Documents with those of their children: a level's rows meet what the level below was gathered to, one equi-join a level."""
    place, out, inside = ["elastic_id_lang", "elastic_id_shop"], None, None
    for level in range(deepest, -1, -1):
        here = flat.filter(F.col("level") == level)
        if inside is None:
            here = here.withColumn("children_data", F.expr("CAST(array() AS ARRAY<VARIANT>)"))
        else:
            here = here.join(inside, ["id", *place], "left").withColumn("children_data", F.coalesce("children_data", F.expr("CAST(array() AS ARRAY<VARIANT>)")))
        whole = F.to_variant_object(F.struct(*[c for c in here.columns]))
        kept = F.array_sort(F.collect_list(F.struct("id", whole.alias("doc"))), lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0))
        inside = here.groupBy(F.col("parent_id").cast("long").alias("_parent"), *place).agg(F.transform(kept, lambda k: k["doc"]).alias("children_data")).withColumnRenamed("_parent", "id")
        out = here if out is None else out.unionByName(here)
    return out


def _quoted(c: Column) -> Column:
    text = F.to_json(F.array(c))
    return F.substring(text, F.lit(2), F.length(text) - 2)


def tree_json(category: DataFrame, category_lang: DataFrame, depth: int | None = None) -> DataFrame:
    """Per (category, language) the nested active subtree as JSON text.

    Built from the deepest level up, one equi-join per level. A category row holds its own subtree,
    as the nested document does, so the tree must be of configuration size.
    """
    nodes = category.join(category_lang, "id_category").select("id_category", "id_parent", "level_depth", "active", "id_lang", "name")
    if depth is None:
        depth = category.agg(F.max("level_depth")).first()[0]
    done: list[DataFrame] = []
    below: DataFrame | None = None
    for level in range(depth, -1, -1):
        here = nodes.filter(F.col("level_depth") == level)
        if below is None:
            here = here.withColumns({"_inner": F.lit(""), "_n": F.lit(0)})
        else:
            nested = below.filter(F.col("active")).groupBy("id_parent", "id_lang").agg(
                F.array_sort(F.collect_list(F.struct("id_category", "tree"))).alias("_kids")
            ).select(
                F.col("id_parent").alias("id_category"), "id_lang",
                F.array_join(F.transform("_kids", lambda k: k["tree"]), ",").alias("_inner"), F.size("_kids").alias("_n"),
            )
            here = here.join(nested, ["id_category", "id_lang"], "left").withColumns(
                {"_inner": F.coalesce("_inner", F.lit("")), "_n": F.coalesce("_n", F.lit(0))}
            )
        below = here.withColumn(
            "tree",
            F.concat(
                F.lit('{"id":'), F.col("id_category").cast("string"), F.lit(',"name":'), _quoted(F.col("name")),
                F.lit(',"children_count":'), F.col("_n").cast("string"), F.lit(',"children_data":['), F.col("_inner"), F.lit("]}"),
            ),
        )
        done.append(below.select("id_category", "id_lang", F.col("_n").alias("children_count"), "tree"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out

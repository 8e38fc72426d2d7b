"""The field-settings catalogue: definitions from three sources, stored overrides, labels and saves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfweave.functions.scalars import slugify
from shelfweave.operators.registry import Entity
from shelfweave.operators.relational import first_per_key, literal_rows, numbered, spread

META_KEY = ["code", "meta_type"]
SETTINGS = [
    "alias", "code", "meta_type", "elastic_type", "enabled", "searchable", "aggregatable", "weight", "operator", "display_type", "result_limit",
]


def all_metas(metas: DataFrame, meta_lang: DataFrame, languages: DataFrame | None = None) -> DataFrame:
    """Every stored label with its field settings; labels without a field stay. ``languages`` limits the languages."""
    labels = meta_lang if languages is None else meta_lang.join(languages.select("id_lang"), "id_lang", "left_semi")
    return metas.join(labels, "id", "right")


def metas_by_language(metas: DataFrame, meta_lang: DataFrame, languages: DataFrame | None = None) -> DataFrame:
    """Per language the map code+type -> label; one row per language, sized by the number of fields."""
    rows = all_metas(metas, meta_lang, languages).filter(F.col("code").isNotNull())
    unique = first_per_key(
        rows.select("id_lang", F.concat("code", "meta_type").alias("k"), "id", "name"), ["id_lang", "k"], [F.col("id")], keep_last=True
    )
    return unique.groupBy("id_lang").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "name")))).alias("metas"))


def meta_names(metas: DataFrame, meta_lang: DataFrame) -> DataFrame:
    """(alias, language) -> label."""
    return metas.select("id", "alias").join(meta_lang, "id").select("alias", "id_lang", "name")


def attribute_groups(groups: DataFrame, attributes: DataFrame) -> DataFrame:
    """Attribute groups with the smallest position of their options, for ordering by (label, position)."""
    low = attributes.groupBy("id_attribute_group").agg(F.min("position").alias("position"))
    return groups.join(low, "id_attribute_group", "left").select(F.col("id_attribute_group").alias("id"), F.col("name").alias("attribute_group"), "position")


def translated_groups(groups: DataFrame, group_lang: DataFrame, options: DataFrame, group_shop: DataFrame, option_shop: DataFrame, languages: DataFrame) -> DataFrame:
    """(id_shop, id_lang, id, attribute_group, position): attribute groups of each shop with their name in each active language.

    Groups count in the shops they belong to, with options that belong there too; ``position`` is the smallest of those, for ordering by
    (name, position). A group without a name in a language has null for both its id and its name, as it comes from the name's side. Options reduce to
    one row per (group, shop) before languages multiply them; their own names add nothing to distinct groups.
    """
    low = options.join(option_shop, "id_attribute").groupBy("id_attribute_group", "id_shop").agg(F.min("position").alias("position"))
    present = groups.select("id_attribute_group").join(group_shop, "id_attribute_group").join(low, ["id_attribute_group", "id_shop"])
    each = spread(present, languages.filter("active").select("id_lang"))
    names = group_lang.select("id_attribute_group", "id_lang", F.col("name").alias("attribute_group"), F.col("id_attribute_group").alias("id"))
    named = each.join(names, ["id_attribute_group", "id_lang"], "left")
    return named.groupBy("id_shop", "id_lang", "id", "attribute_group").agg(F.min("position").alias("position"))


def property_definitions(spark: SparkSession, entity: Entity) -> DataFrame:
    """Declared fields of an entity as rows in declaration order."""
    rows = [(i, a.name, a.type, list(a.allowed_types) if a.allowed_types else None, a.visible, a.type_configurable) for i, a in enumerate(entity.attributes)]
    return literal_rows(spark, rows, "ord int, code string, type string, elastic_types array<string>, visible boolean, type_configurable boolean")


def effective_type(stored: Column, declared: Column, allowed: Column) -> Column:
    """The stored type where it is allowed, else the declared one, else the first allowed; 'text' by default."""
    wanted = F.coalesce(stored, F.lit("text"))
    return F.when(allowed.isNull() | F.array_contains(allowed, wanted), wanted).otherwise(F.coalesce(declared, F.get(allowed, F.lit(0))))


def all_properties(properties: DataFrame, features: DataFrame, groups: DataFrame, metas: DataFrame, meta_lang: DataFrame, id_lang: int, labelled: bool = False) -> DataFrame:
    """Every field definition with its overrides, unique by code: positioned ones first by position, then source order.

    ``features`` has ``name``; ``groups`` is the output of ``attribute_groups``. ``rank_in_source`` orders
    fields of equal standing. A field counts as stored for a language when it has a label in it.
    """
    missing = F.lit(None)
    declared = properties.select(
        F.lit(0).alias("source"), F.col("ord").cast("string").alias("within"), "code", F.lit("property").alias("meta_type"),
        F.col("code").alias("label"), "type", "elastic_types", "visible",
    ).withColumn("within", F.lpad("within", 9, "0"))
    by_code = properties.select("code", F.col("elastic_types").alias("_types"), F.col("visible").alias("_visible"))

    def sourced(frame: DataFrame, rank: int, kind: str, label: str, within: Column) -> DataFrame:
        coded = frame.select(
            F.lit(rank).alias("source"), within.alias("within"), slugify(F.col(label)).alias("code"), F.lit(kind).alias("meta_type"), F.col(label).alias("label"),
        )
        return coded.join(by_code, "code", "left").select(
            "source", "within", "code", "meta_type", "label", missing.cast("string").alias("type"), F.col("_types").alias("elastic_types"),
            F.coalesce("_visible", F.lit(True)).alias("visible"),
        )

    group_rank = F.concat_ws("|", "attribute_group", F.lpad(F.coalesce("position", F.lit(0)).cast("string"), 9, "0"))
    union = declared.unionByName(sourced(features, 1, "feature", "name", F.col("name"))).unionByName(
        sourced(groups, 2, "attribute", "attribute_group", group_rank)
    )
    stored = all_metas(metas, meta_lang.filter(F.col("id_lang") == id_lang)).filter(F.col("code").isNotNull()).select(
        *SETTINGS, "position", F.col("name").alias("stored_name")
    )
    joined = union.join(stored, META_KEY, "left")
    filled = joined.select(
        "source", "within", "code", "meta_type",
        F.coalesce("alias", F.lit("")).alias("alias"), F.coalesce("stored_name", "label").alias("name"),
        F.coalesce("position", F.lit(0)).alias("position"), F.coalesce("weight", F.lit(1.0).cast("float")).alias("weight"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("searchable", "enabled", "aggregatable")],
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("operator", "display_type", "result_limit")],
        F.when(F.col("meta_type") == "property", effective_type(F.col("elastic_type"), F.col("type"), F.col("elastic_types")))
        .otherwise(F.coalesce("elastic_type", F.lit("text"))).alias("elastic_type"),
        "visible", *(["label"] if labelled else []),
    )
    # Among fields with one code a positioned one wins, then the earlier source.
    order = [F.when(F.col("position") > 0, 0).otherwise(1), F.when(F.col("position") > 0, F.lit(0)).otherwise(F.col("source")), F.col("source"), F.col("within")]
    return first_per_key(filled, ["code"], order)


def ordered_properties(properties: DataFrame) -> DataFrame:
    """The fields with their ``place`` from 1: positioned ones by position, then the rest in source order. One row a field, so a short list."""
    order = Window.partitionBy(F.lit(0)).orderBy((F.col("position") == 0), "position", "source", "within", "code")
    return properties.withColumn("place", F.row_number().over(order))


def property_catalogue(
    properties: DataFrame, features: DataFrame, groups: DataFrame, metas: DataFrame, meta_lang: DataFrame, languages: DataFrame, id_lang: int
) -> DataFrame:
    """``all_properties`` of a language with the map of names in every active language, the declared types and the place in order.

    A name is the stored one of that language, else the label of the source. ``elastic_types`` and ``type_configurable`` are those declared for the
    code, null and false where none is.
    """
    found = ordered_properties(all_properties(properties, features, groups, metas, meta_lang, id_lang, labelled=True))
    declared = properties.select("code", "elastic_types", "type_configurable")
    found = found.join(declared, "code", "left").withColumn("type_configurable", F.coalesce("type_configurable", F.lit(False)))
    stored = metas.select("id", *META_KEY).join(meta_lang, "id").select(*META_KEY, "id_lang", F.col("name").alias("_stored"))
    each = spread(found.select(*META_KEY, "label"), languages.filter("active").select("id_lang")).join(stored, [*META_KEY, "id_lang"], "left")
    names = each.groupBy(*META_KEY).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("id_lang", F.coalesce("_stored", "label").alias("name"))))).alias("names"))
    return found.drop("label", "name").join(names, META_KEY)


def searchable_fields(metas: DataFrame, with_weights: bool = True, required: Sequence[str] = ("name",)) -> DataFrame:
    """Searchable text fields as ``alias^weight``, plus required ones that are not among them."""
    chosen = metas.filter(F.col("searchable") & (F.col("elastic_type") == "text")).select("alias", "weight")
    spark = metas.sparkSession
    missing = literal_rows(spark, [(r,) for r in required], "alias string").join(chosen, "alias", "left_anti")
    weight = F.col("weight")
    shown = F.when(weight == F.floor(weight), F.floor(weight).cast("string")).otherwise(weight.cast("string"))
    named = F.concat_ws("^", "alias", shown) if with_weights else F.col("alias")
    return chosen.select(named.alias("field")).unionByName(missing.select(F.col("alias").alias("field")))


def alias_lookup(metas: DataFrame, codes: Sequence[str], kind: str = "property") -> DataFrame:
    """One row with the map code -> alias of the given codes."""
    rows = metas.filter(F.col("code").isin(*codes) & (F.col("meta_type") == kind)).select("code", "alias").distinct()
    return rows.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("code", "alias")))).alias("aliases"))


def rename_by_alias(docs: DataFrame, metas: DataFrame, codes: Sequence[str], kind: str = "property") -> DataFrame:
    """Documents with the given fields renamed to their stored alias; a handful of names reach the driver."""
    found = alias_lookup(metas, codes, kind).first()["aliases"] or {}
    return docs.withColumnsRenamed({code: alias for code, alias in found.items() if alias and code in docs.columns})


def dedupe_metas(incoming: DataFrame) -> DataFrame:
    """A submitted batch, first of each alias only, numbered from 1 in submission order (``ord``)."""
    kept = first_per_key(incoming, ["alias"], [F.col("ord")])
    return numbered(kept, "ord", name="position").withColumn("position", F.col("position").cast("int"))


def save_metas(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """The stored settings after a save.

    Rows match on (code, type); a known row keeps its id and position and takes the other settings,
    a new row gets the next ids in submission order.
    """
    batch = dedupe_metas(incoming)
    # The update is a statement per row in batch order, so the last one for a (code, type) stays.
    latest = first_per_key(batch, META_KEY, [F.col("ord")], keep_last=True)
    new = latest.select(*META_KEY, *[F.col(c).alias(f"_{c}") for c in SETTINGS if c not in META_KEY], F.col("position").alias("_position"), "ord", F.lit(True).alias("_new"))
    joined = existing.select("id", *SETTINGS, "position").join(new, META_KEY, "full_outer")
    merged = joined.select(
        "id", *META_KEY,
        *[F.when(F.col("_new"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) for c in SETTINGS if c not in META_KEY],
        F.coalesce("position", "_position").alias("position"), "ord",
    )
    top = existing.agg(F.coalesce(F.max("id"), F.lit(0)).cast("bigint").alias("top")).scalar()
    added = numbered(merged.filter(F.col("id").isNull()), "ord", name="_k").withColumn("id", top + F.col("_k")).drop("_k")
    kept = merged.filter(F.col("id").isNotNull()).withColumn("id", F.col("id").cast("bigint"))
    return kept.unionByName(added).drop("ord")


def save_labels(stored: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, language) labels of a save, the id found by alias; labels of unknown aliases are left out."""
    ids = first_per_key(stored.select("alias", "id"), ["alias"], [F.col("id")])
    return labels.join(ids, "alias").select("id", "id_lang", "name")


def label_catalog(files: DataFrame, column: str = "body") -> DataFrame:
    """JSON label files (code -> language -> label) as (code, iso_code, label) rows."""
    parsed = files.select("id_file", F.from_json(column, "map<string,map<string,string>>").alias("m"))
    by_code = parsed.select("id_file", F.explode("m").alias("code", "labels"))
    return by_code.select("id_file", "code", F.explode("labels").alias("iso_code", "label"))


def facet_settings(metas: DataFrame) -> DataFrame:
    """Aggregatable fields with their facet settings."""
    return metas.filter(F.col("aggregatable")).select(F.col("code").alias("field"), "operator", "display_type", "result_limit")
